"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram of three
letters (a word's border is a letter too) binds its letters' vectors by multiplication after
rotating each by its place; a text bundles the vectors of its n-grams by addition. A language's
prototype bundles all its training texts. The prediction is the prototype of highest cosine.

Sums are whole numbers, so prototypes do not depend on the order of rows or tasks. One prototype
of `DIMENSIONS` numbers per language is all that reaches the driver and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from panelspark.llm.common import without

DIMENSIONS = 1024
SEED = 20240229
CHUNK_CHARS = 1 << 20
BLOCK = 4096
UNKNOWN = "und"
MAX_LANGUAGES = 4096  # prototypes that the driver holds: 32 MB
COMMON = 0x3000


class Letters:
    """Lower-cased letters of texts, and the letters' vectors."""

    def __init__(self):
        self.common = np.array([self._lower(c) for c in range(COMMON)], np.uint32)
        self.vectors: dict[int, np.ndarray] = {}

    @staticmethod
    def _lower(code: int) -> int:
        """The lower-cased letter, or zero if the code point is none."""
        low = chr(code).lower()
        return ord(low[0]) if low[0].isalpha() else 0

    def lowered(self, codes: np.ndarray) -> np.ndarray:
        out = self.common[np.minimum(codes, COMMON - 1)]
        rare = np.flatnonzero(codes >= COMMON)
        if len(rare):
            kinds, place = np.unique(codes[rare], return_inverse=True)
            out[rare] = np.array([self._lower(int(k)) for k in kinds], np.uint32)[place]
        return out

    def matrix(self, letters: np.ndarray) -> np.ndarray:
        for c in letters.tolist():
            if c not in self.vectors:
                draw = np.random.Generator(np.random.PCG64([SEED, c])).integers(0, 2, DIMENSIONS)
                self.vectors[c] = (2 * draw - 1).astype(np.int8)
        return np.stack([self.vectors[c] for c in letters.tolist()])


def ngrams(texts: list[str], groups: np.ndarray, letters: Letters):
    """Distinct (group, n-gram) with counts, and the letters that the n-grams number."""
    joined = "\0" + "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = letters.lowered(codes)
    middle = np.flatnonzero(low)  # the first and last code are borders
    used = np.unique(np.r_[np.uint32(0), low[middle]])
    n = len(used)
    number = np.searchsorted(used, low).astype(np.int64)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) + 1
    owner = groups[np.searchsorted(starts, middle, side="right") - 1]
    key = ((owner * n + number[middle - 1]) * n + number[middle]) * n + number[middle + 1]
    keys, counts = np.unique(key, return_counts=True)
    return keys // n**3, keys % n**3, counts, used


def bundle(texts: list[str], groups: np.ndarray, n_groups: int, letters: Letters) -> np.ndarray:
    """The sum of n-gram vectors of each group of texts, as whole numbers."""
    group, gram, counts, used = ngrams(texts, groups, letters)
    n = len(used)
    kind = np.float64 if counts.sum() >= 1 << 23 else np.float32  # exact whole numbers
    out = np.zeros((n_groups, DIMENSIONS), np.float64)
    if not len(gram):
        return out
    last = letters.matrix(used)
    first, second = np.roll(last, 2, axis=1), np.roll(last, 1, axis=1)
    grams, place = np.unique(gram, return_inverse=True)
    order = np.argsort(place, kind="stable")
    edges = np.searchsorted(place[order], np.arange(0, len(grams) + BLOCK, BLOCK))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        some = grams[i * BLOCK : (i + 1) * BLOCK]
        vectors = first[some // n**2] * second[some // n % n] * last[some % n]
        rows = order[a:b]
        table = np.zeros((n_groups, len(some)), kind)
        table[group[rows], place[rows] - i * BLOCK] = counts[rows]
        out += table @ vectors.astype(kind)
    return out


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    first, some, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if some and size + len(t) > CHUNK_CHARS:
            yield first, some
            first, some, size = i, [], 0
        some.append(t)
        size += len(t)
    if some:
        yield first, some


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The prototype of every non-null language, from all rows. Languages without a letter in any
    text have none; an empty table has none at all. More than MAX_LANGUAGES different values are no
    languages: ValueError, before any text is read.
    """
    named = labelled.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{lang}`")).distinct()
    if len(named.take(MAX_LANGUAGES + 1)) > MAX_LANGUAGES:
        raise ValueError(f"column {lang} has more than {MAX_LANGUAGES} values")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(), {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, texts in _chunks(batch.column(0).to_pylist()):
                names, group = np.unique(
                    np.array(langs[first : first + len(texts)], object).astype(str),
                    return_inverse=True,
                )
                found = bundle(texts, group, len(names), letters)
                for name, vector in zip(names.tolist(), found):
                    sums[name] = sums.get(name, 0) + vector.astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])],
                ["lang", "vector"],
            )

    rows = labelled.where(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")
    ).mapInArrow(run, "lang string, vector array<long>")
    total = (
        rows.selectExpr("lang", "posexplode(vector) AS (at, v)")
        .groupBy("lang", "at").agg(F.sum("v").alias("v"))
    )
    learned: dict[str, np.ndarray] = {}
    for r in total.collect():  # DIMENSIONS rows per language
        learned.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["at"]] = r["v"]
    return {name: v for name, v in learned.items() if v.any()}


def predict(docs: DataFrame, learned: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """Adds `lang_pred` and `score`, the cosine with that language's prototype, 0 at least.

    A text that is NULL or has no letter, or any text when no language was learned, is `und`
    with score 0. Of prototypes with equal cosine the first by name wins. Very long texts are
    bundled whole, repeated rows are judged alike, columns named as the results are replaced and
    others kept, and an empty table stays empty.
    """
    docs = without(docs, "lang_pred", "score")
    names = sorted(learned)
    stack = np.array([learned[n] / np.linalg.norm(learned[n]) for n in names])
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    schema = StructType([*docs.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            said, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for first, some in _chunks(texts) if names else ():
                vectors = bundle(some, np.arange(len(some)), len(some), letters)
                norms = np.linalg.norm(vectors, axis=1)
                likeness = vectors @ stack.T / np.maximum(norms, 1e-300)[:, None]
                best = likeness.argmax(axis=1)
                for i in np.flatnonzero(norms > 0).tolist():
                    said[first + i] = names[best[i]]
                    scores[first + i] = min(1.0, max(0.0, likeness[i, best[i]]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(said, pa.string()), pa.array(scores)],
                [*batch.schema.names, "lang_pred", "score"],
            )

    return docs.mapInArrow(run, schema)
