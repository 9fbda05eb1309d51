"""Groups of spelling variants: words one edit apart, and the frequent form that each leads to.

Candidates come from a Bloom-guided search of each word's neighbourhood. The vocabulary is kept
as blocked Bloom filters, one shard per word length (a large length in several, by hash), whose
blocks are single 64-bit words, so that a probe is one look-up. Tasks generate the edits of their
words as hashes, never as strings: a word is a polynomial over its code points, and the hash of
an edited word follows from the word's own prefix and suffix sums. Only what a filter lets
through is shuffled, to an exact join with the vocabulary on the hash and a comparison of the
strings, which removes false positives and collisions.

Being near is symmetric, so half the neighbourhood is enough: deletions (which find insertions
from the longer word) and replacements by a greater code point.

Filters are broadcast in passes of at most FILTER_BYTES. A pass reads only words whose edits can
have the lengths of its shards, so lengths in passes of their own generate no edit twice.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.sources.sinks import stage

MIN_LENGTH = 5
MIN_COUNT = 3
PLANTED = 97  # one occurrence in so many loses a code point, by its checksum
FORM_RATIO = 2  # a form is at least so many times as frequent

FILTER_BYTES = 16 << 20  # most that one pass broadcasts
BITS_PER_WORD = 16
LONGEST_SHARD = 64  # longer words share a shard
HELD_WORDS = 300_000  # distinct words that a task counts before it sends them on
PROBES = 1 << 20  # edits generated at once

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2 ** 64
_RUN = re.compile("[A-Za-z\u00C0-\u00FF]+")


def text_words(key: str, text: str, planted: int = PLANTED) -> Counter:
    """Words of a text and their counts. Every `planted`-th occurrence, by the checksum of the
    key and the run, is taken without one of its code points."""
    text = text.encode().lower().decode()  # bytes lower-case only A to Z
    counts: Counter = Counter()
    before = zlib.crc32(f"{key}:".encode())
    for run, n in Counter(_RUN.findall(text)).items():
        h = zlib.crc32(run.encode(), before)
        if h % planted == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        counts[run] += n
    return counts


def vocabulary(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, planted: int = PLANTED,
) -> DataFrame:
    """(word, n): the distinct words of all whole texts with at least `min_length` code points and
    `min_count` occurrences. Tasks count before anything moves.

    A NULL or empty text has no words, a NULL id is the empty key, repeated rows count each, texts
    of any length are read whole, other columns are ignored whatever their names, and an empty
    table has no words.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("string"), F.col(f"`{text}`").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counted():
            words = [w for w in held if len(w) >= min_length]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())],
                ["word", "n"],
            )

        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py()
                if body:
                    held.update(text_words(key or "", body, planted))
                if len(held) > HELD_WORDS:
                    yield counted()
                    held.clear()
        if held:
            yield counted()

    parts = rows.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {min_count}")


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def code_points(words: list[str], length: int) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(words), length).astype(np.uint64)


def hashes(points: np.ndarray) -> np.ndarray:
    return (points * powers(points.shape[1])).sum(axis=1, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a polynomial hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def probe_mask(m: np.ndarray) -> np.ndarray:
    """Four bits of a block."""
    mask = np.zeros(m.shape, np.uint64)
    for shift in (0, 6, 12, 18):
        mask |= np.uint64(1) << ((m >> np.uint64(shift)) & np.uint64(63))
    return mask


class Shards:
    """Where each shard's blocks lie in the filters, and in which pass each is broadcast."""

    def __init__(self, counts: dict[int, int], filter_bytes: int = FILTER_BYTES):
        self.most = max(1, filter_bytes // 8)
        self.of_length: dict[int, tuple[int, int]] = {}  # shards of a length, blocks of each
        self.place: dict[tuple[int, int], tuple[int, int]] = {}  # (pass, first block)
        self.passes, used = 0, self.most + 1
        for length, n in sorted(counts.items()):
            blocks = max(1, -(-n * BITS_PER_WORD // 64))
            shards = -(-blocks // self.most)
            blocks = -(-blocks // shards)
            self.of_length[length] = (shards, blocks)
            for s in range(shards):
                if used + blocks > self.most:
                    self.passes, used = self.passes + 1, 0
                self.place[length, s] = (self.passes - 1, used)
                used += blocks

    def lengths(self, number: int) -> set[int]:
        return {length for (length, _), (p, _) in self.place.items() if p == number}

    def blocks(self, number: int) -> int:
        """Blocks of a pass."""
        return max((first + self.of_length[key[0]][1]
                    for key, (p, first) in self.place.items() if p == number), default=0)

    def block(self, length: int, m: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(whether a hash belongs to this pass, its block) for words of one length."""
        shards, blocks = self.of_length[length]
        first = np.full(shards, -1, np.int64)
        for s in range(shards):
            p, at = self.place[length, s]
            if p == number:
                first[s] = at
        high = m >> np.uint64(24)
        start = first[(high % np.uint64(shards)).astype(np.int64)]
        at = ((high // np.uint64(shards)) % np.uint64(blocks)).astype(np.int64)
        return start >= 0, start + at


def shard_length(n: int) -> int:
    return min(n, LONGEST_SHARD)


def _by_length(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    held: dict[int, list[str]] = {}
    for w in words:
        held.setdefault(len(w), []).append(w)
    yield from held.items()


def edits(points: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple]:
    """(word's row, hash of the edited word, whether one code point shorter) of deletions and of
    replacements by a greater code point, some PROBES at a time. Of equal neighbours the last is
    deleted, so no edit comes twice."""
    rows, length = points.shape
    power = powers(length)
    terms = points * power
    own = terms.sum(axis=1, dtype=np.uint64)
    upto = np.cumsum(terms, axis=1, dtype=np.uint64)
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    step = max(1, PROBES // rows)
    for first in range(0, length, step):
        at = slice(first, min(length, first + step))
        shorter = upto[:, at] - terms[:, at] + (own[:, None] - upto[:, at]) * inverse
        following = np.zeros((rows, at.stop - at.start), bool)
        inner = min(at.stop, length - 1)
        following[:, : inner - first] = points[:, first:inner] == points[:, first + 1 : inner + 1]
        r, c = np.nonzero(~following)
        yield r, shorter[r, c], True
        for letter in alphabet:
            r, c = np.nonzero(points[:, at] < letter)
            if len(r):
                old = points[:, at][r, c]
                yield r, own[r] + (letter - old) * power[at][c], False


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(a, n_a, b, n_b): every pair of words of (word, n) that differ by one inserted, deleted or
    replaced code point, once. `words` has to be a staged table without repeated words."""
    counts = {
        r["k"]: r["n"] for r in words.groupBy(
            F.expr(f"least(length(word), {LONGEST_SHARD})").alias("k")
        ).agg(F.count(F.lit(1)).alias("n")).collect()  # at most LONGEST_SHARD rows
    }
    shards = Shards(counts, filter_bytes)
    letters = _letters(words)
    keyed = stage(_with_key(words))
    found = None
    for number in range(shards.passes):
        lengths = shards.lengths(number)
        if LONGEST_SHARD in lengths:
            wanted = f"least(length(word), {LONGEST_SHARD})"
        else:
            wanted = "length(word)"
        reach = sorted({k for n in lengths for k in (n, n + 1)})
        filters = _filters(keyed, shards, number, wanted, lengths)
        some = keyed.where(f"{wanted} IN ({', '.join(map(str, reach))})")
        positives = stage(_probe(some, shards, number, filters, letters))
        filters.unpersist()
        found = positives if found is None else found.unionByName(positives)
    if found is None:
        return words.selectExpr("word AS a", "n AS n_a", "word AS b", "n AS n_b").where("false")
    target = keyed.selectExpr("key AS to_key", "word AS b", "n AS n_b")
    source = keyed.selectExpr("key AS from_key", "word AS a", "n AS n_a")
    pairs = found.join(target, "to_key").join(source, "from_key").where("levenshtein(a, b, 1) = 1")
    return pairs.select("a", "n_a", "b", "n_b").distinct()


def _letters(words: DataFrame) -> np.ndarray:
    """The code points that words hold: one row each, of an alphabet."""
    found = words.select(F.explode(F.expr("array_distinct(split(word, ''))")).alias("c"))
    return np.array(sorted(ord(r["c"]) for r in found.distinct().collect() if r["c"]), np.uint64)


def _with_key(words: DataFrame) -> DataFrame:
    """Adds `key`, the polynomial hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = batch.column(0).to_pylist()
            key = {}
            for length, some in _by_length(body):
                key.update(zip(some, hashes(code_points(some, length)).view(np.int64).tolist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([key[w] for w in body], pa.int64())],
                ["word", "n", "key"],
            )

    return words.select("word", "n").mapInArrow(run, "word string, n long, key long")


def _filters(keyed: DataFrame, shards: Shards, number: int, wanted: str, lengths: set[int]):
    """The filters of a pass as one array. Executors merge the bits of a block; the driver gets
    at most one 64-bit word per block, FILTER_BYTES in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(1).to_numpy().view(np.uint64)
            length = batch.column(0).to_numpy()
            for n in np.unique(length).tolist():
                m = mixed(key[length == n])
                here, block = shards.block(n, m, number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[here]), pa.array(probe_mask(m)[here].view(np.int64))],
                    ["block", "bits"],
                )

    some = keyed.where(f"{wanted} IN ({', '.join(map(str, sorted(lengths)))})")
    bits = some.selectExpr(f"least(length(word), {LONGEST_SHARD}) AS k", "key").mapInArrow(
        run, "block long, bits long"
    ).groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    filters = np.zeros(shards.blocks(number), np.uint64)
    filters[bits.column("block").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return keyed.sparkSession.sparkContext.broadcast(filters)


def _probe(some: DataFrame, shards: Shards, number: int, filters, letters: np.ndarray):
    """(from_key, to_key) of the edits that the pass's filters let through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filters.value
        for batch in batches:
            for length, words in _by_length(batch.column(0).to_pylist()):
                step = max(1, PROBES // length)
                for first in range(0, len(words), step):
                    points = code_points(words[first : first + step], length)
                    own = hashes(points)
                    for r, h, shorter in edits(points, letters):
                        k = shard_length(length - shorter)
                        if k not in shards.of_length:
                            continue
                        m = mixed(h)
                        here, block = shards.block(k, m, number)
                        mask = probe_mask(m)
                        hit = here & ((bits[np.where(here, block, 0)] & mask) == mask)
                        if hit.any():
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[r[hit]].view(np.int64)),
                                 pa.array(h[hit].view(np.int64))],
                                ["from_key", "to_key"],
                            )

    return some.select("word").mapInArrow(run, "from_key long, to_key long")


def group_variants(
    words: DataFrame, ratio: int = FORM_RATIO, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n).

    `form` is the most frequent near word (ties: the first in code-point order) if it is at
    least `ratio` times as frequent, else NULL; `root` is where forms lead to in the end. As counts
    grow along the way it ends, after at most log(largest count) steps.
    """
    kept = stage(words)
    pairs = stage(near_pairs(kept, filter_bytes))
    both = pairs.selectExpr("a AS word", "b AS near", "n_b AS near_n").unionByName(
        pairs.selectExpr("b AS word", "a AS near", "n_a AS near_n")
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.expr("min(struct(-near_n AS below, near))").alias("m")
    )
    formed = kept.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near",
        f"CASE WHEN -m.below >= {ratio} * n THEN m.near END AS form",
        f"CASE WHEN -m.below >= {ratio} * n THEN -m.below END AS form_n",
    )
    formed = stage(formed)
    roots = _roots(formed.where("form IS NOT NULL").select("word", "form"))
    found = formed.join(roots, "word", "left")
    return found.selectExpr(
        "word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form, by doubling the step in every round."""
    state = stage(forms.withColumnRenamed("form", "at"))
    while True:
        ahead = state.selectExpr("word AS at", "at AS next")
        stepped = stage(state.join(ahead, "at", "left").selectExpr(
            "word", "coalesce(next, at) AS at", "next IS NOT NULL AS moved"
        ))
        state = stepped.select("word", "at")
        if not stepped.where("moved").head(1):
            return state.withColumnRenamed("at", "root")
