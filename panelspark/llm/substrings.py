"""Substring dedup by hashing lines and their parts.

A unit is a part of a line: lines are cut after words that end a sentence or repeat the word
before, and after the word whose hash with the word before is the least of any `WINDOW`
neighbours. So a passage falls into the same units wherever it stands, but for the words at its
ends: at most `WINDOW` + 1 at the front and `WINDOW` - 1 at the back, whatever its words are, where
its lines are the same. Such a passage of `MIN_WORDS` + 2 * `WINDOW` words (50) or more therefore
always has a run that is long enough. Normalised (lower-cased A-Z, words joined by one space), a
unit's 128-bit digest is grouped over all documents. In scripts that
are written without spaces (Han, kana, Thai, Lao, Burmese, Khmer) each code point is a word, with the
marks after it, and their own full stops end a sentence.

Short parts that any text may share don't count: an occurrence is a unit in a run of repeated
units with `MIN_WORDS` words at least. The earliest occurrence by document id (NULL last), text
digest and place stays. Runs of later ones with `MIN_WORDS` words are removed. Offsets of what is
removed are those of the original text. A bit table of fixed size tells beforehand which units
can be repeated, so that few are shuffled; what it lets through by chance is taken out exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from panelspark.llm.common import spread, without
from panelspark.llm.decontam import chunks, words_of
from panelspark.sources.sinks import stage

MIN_WORDS = 20
WINDOW = 15
FILTER_BITS = 26
ADDED = ["n_units", "n_removed", "removed"]


def _lowered() -> np.ndarray:
    """Byte to lower-cased word byte; zero for spaces."""
    to = np.arange(256, dtype=np.uint8)
    to[0] = 1
    to[0x41:0x5B] += 32
    to[[0x20, *range(0x09, 0x0E)]] = 0
    return to


# UTF-8 of the scripts without spaces between words, as ranges of the first two bytes.
UNSPACED = [(0xE0B8, 0xE0BB), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE381, 0xE383),
            (0xE390, 0xE9BF), (0xEFA4, 0xEFAB), (0xF0A0, 0xF0B3)]
MARKS = [(0xE380, 0xE380), (0xEFBC, 0xEFBC)]  # their punctuation
STOPS = [0xE38082, 0xEFBC81, 0xEFBC9F]


def _breaks(raw: np.ndarray) -> np.ndarray | None:
    """Where a word begins without a space before it."""
    if not len(raw) or raw.max() < 0xE0:
        return None
    start = np.flatnonzero((raw & 0xC0) != 0x80)
    pair = raw[start].astype(np.int64) << 8 | raw[np.minimum(start + 1, len(raw) - 1)]
    unspaced, mark = (
        np.any([(pair >= a) & (pair <= b) for a, b in ranges], axis=0) & (raw[start] >= 0xE0)
        for ranges in (UNSPACED, MARKS)
    )
    after = np.r_[False, (unspaced | mark)[:-1]]
    return start[unspaced | (after & ~mark)]


def _extreme(values: np.ndarray, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of each `WINDOW` neighbouring values, by doubling."""
    width, out = 1, values
    while width < WINDOW:
        step = min(width, WINDOW - width)
        out = pick(out[:-step], out[step:])
        width += step
    return out


def _least(pair: np.ndarray, together: np.ndarray) -> np.ndarray:
    """Where a value is the least of some `WINDOW` neighbours that lie in one text. Whether a place
    is chosen depends on its own text alone."""
    if len(pair) < WINDOW:
        return np.zeros(len(pair), bool)
    value = pair | np.uint64(1)
    # A pair across two texts is zero, so it is the least of all windows over it and is not chosen.
    value[~together] = 0
    least = _extreme(value, np.minimum)
    edge = np.zeros(WINDOW - 1, np.uint64)
    return (_extreme(np.r_[edge, least, edge], np.maximum) == value) & together


def units(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[list, list, list, bytes]]:
    """Per text: first byte and words of each unit, their ends, and the lower-cased bytes. A unit
    reaches to the next one, so that removing units leaves no gap."""
    breaks = _breaks(raw)
    words = words_of(raw, offsets, _lowered(), breaks)
    n = len(words.start)
    body = np.where(words.octets == 0, 32, words.octets).astype(np.uint8).tobytes()
    lines = np.r_[0, np.cumsum(raw == 10)]
    cut = np.zeros(n, bool)
    if n:
        cut |= np.isin(raw[words.stop - 1], np.frombuffer(b".!?", np.uint8))
        if breaks is not None:
            last = [raw[np.maximum(words.stop - k, 0)].astype(np.int64) for k in (3, 2, 1)]
            cut |= np.isin(last[0] << 16 | last[1] << 8 | last[2], STOPS)
        cut[:-1] |= lines[words.start[1:]] > lines[words.stop[:-1]]
        with np.errstate(over="ignore"):
            pair = words.hash[1:] * np.uint64(0x9E3779B97F4A7C15) + words.hash[:-1]
        together = words.text[1:] == words.text[:-1]
        cut[1:] |= (_least(pair, together) | (words.hash[1:] == words.hash[:-1])) & together
        cut[:-1] |= ~together
        cut[-1] = True
    last = np.flatnonzero(cut)
    first = np.r_[0, last[:-1] + 1] if len(last) else last
    borders = np.searchsorted(words.text[first], np.arange(len(offsets)))
    for t in range(len(offsets) - 1):
        a, b = borders[t], borders[t + 1]
        start = words.start[first[a:b]].tolist()
        end = [*start[1:], int(offsets[t + 1])] if start else []
        counts = (last[a:b] - first[a:b] + 1).tolist()
        yield start, end, counts, body


def _digests(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per text its number, the 128-bit digests of its units as two longs each, and their words."""
    n = 0
    for raw, offsets in chunks(texts):
        for start, end, words, body in units(raw, offsets):
            coded = b"".join(
                xxhash.xxh3_128_digest(b" ".join(body[a:b].split())) for a, b in zip(start, end)
            )
            yield n, np.frombuffer(coded, "<i8").reshape(-1, 2), np.array(words, np.int64)
            n += 1


def _place(high: np.ndarray) -> np.ndarray:
    return (high.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def repeated(docs: DataFrame, text: str) -> DataFrame:
    """(high) of every unit digest that occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, size = [], 0
            for _, digests, _ in _digests(batch.column(0)):
                some.append(digests[:, 0])
                size += len(digests)
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(some))], ["high"])
                    some, size = [], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(some))], ["high"])

    high = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "high long")
    return high.groupBy("high").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("high")


def bit_table(often: DataFrame) -> np.ndarray:
    """(1 << FILTER_BITS) bits, one set for each value, packed into bytes."""
    bits = often.selectExpr(
        f"shiftrightunsigned(high, {64 - FILTER_BITS}) AS at"
    ).groupBy(F.expr("at DIV 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(at % 64 AS INT)))").alias("mask")
    ).toArrow()  # at most (1 << FILTER_BITS) / 64 rows
    table = np.zeros((1 << FILTER_BITS) // 64, "<i8")
    table[bits.column(0).to_numpy()] = bits.column(1).to_numpy()
    return table.view(np.uint8)


def candidates(
    docs: DataFrame, often: DataFrame, id_column: str, text: str, min_words: int
) -> DataFrame:
    """(id, text_hash, unit, words, high, low) of the units in runs that the bit table passes."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(often))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), "text_hash", F.col(f"`{text}`").cast("string")
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            owners, places, sizes, found, size = [], [], [], [], 0

            def batch_of():
                at = pa.array(np.concatenate(owners))
                pair = np.concatenate(found)
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(np.concatenate(places)), pa.array(np.concatenate(sizes)),
                     pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())],
                    ["id", "text_hash", "unit", "words", "high", "low"],
                )

            for n, digests, words in _digests(batch.column(2)):
                bit = _place(digests[:, 0].copy())
                hit = table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1
                edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
                upto = np.r_[0, np.cumsum(words)]
                runs = [
                    (a, b) for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0))
                    if upto[b] - upto[a] >= min_words
                ]
                if not runs:
                    continue
                hit = np.concatenate([np.arange(a, b) for a, b in runs])
                owners.append(np.full(len(hit), n, np.int64))
                places.append(hit.astype(np.int32))
                sizes.append(words[hit].astype(np.int32))
                found.append(digests[hit])
                size += len(hit)
                if size > 100_000:
                    yield batch_of()
                    owners, places, sizes, found, size = [], [], [], [], 0
            if size:
                yield batch_of()

    return rows.mapInArrow(
        run, f"id {kind}, text_hash long, unit int, words int, high long, low long"
    )


def occurrences(found: DataFrame, often: DataFrame, min_words: int) -> DataFrame:
    """The candidates in runs of units that are truly repeated, each once per document."""
    true = found.join(often, "high", "left_semi").repartition(spread(found), "id", "text_hash")
    doc = "PARTITION BY id, text_hash"
    once = true.selectExpr(
        "*", f"row_number() OVER ({doc}, unit ORDER BY high, low) AS copy"
    ).where("copy = 1").drop("copy")
    runs = once.selectExpr("*", f"unit - row_number() OVER ({doc} ORDER BY unit) AS run")
    return runs.selectExpr(
        "*", f"sum(words) OVER ({doc}, run) AS run_words"
    ).where(f"run_words >= {min_words}").select("id", "text_hash", "unit", "high", "low")


def later_units(docs: DataFrame, id_column: str, text: str, min_words: int) -> DataFrame:
    """(id, text_hash, later): per document the occurrences that are not the earliest of their
    digest, with the id of the document that has the earliest."""
    often = stage(repeated(docs, text))
    found = stage(candidates(docs, often, id_column, text, min_words))
    found = stage(occurrences(found, often, min_words))
    # Staged, so that the join below shuffles both sides and a hot digest can be split.
    first = stage(found.groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("n"),
        F.expr("min(struct(id IS NULL AS without, id, text_hash, unit))").alias("first"),
    ).where("n > 1").selectExpr(
        "high", "low", "first.id AS first_id", "first.text_hash AS first_hash",
        "first.unit AS first_unit",
    ))
    later = found.join(first, ["high", "low"]).where(
        "NOT (id <=> first_id AND text_hash = first_hash AND unit = first_unit)"
    )
    return later.groupBy("id", "text_hash").agg(
        F.expr("array_sort(collect_set(struct(unit, first_id)))").alias("later")
    )


def _runs(marked: dict, words: list[int], min_words: int) -> Iterator[tuple[int, int, list]]:
    """[first, end) of neighbouring later units with enough words, and who keeps them."""
    first = None
    for k in range(len(words) + 1):
        if k < len(words) and k in marked:
            first = k if first is None else first
        elif first is not None:
            if sum(words[first:k]) >= min_words:
                ids = {marked[i] for i in range(first, k)}
                yield first, k, sorted(ids, key=lambda i: (i is None, i))
            first = None


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents without later repeats, `n_units`, `n_removed` and `removed`: [start, end) in
    code points of the original text, with the ids of the documents that keep the units.

    A NULL text stays NULL and has no units; an empty table gives an empty table; rows with the
    same id and text are one document and are treated alike; columns named as the results are
    replaced. A text of which every unit goes becomes what lies between its units.
    """
    docs = without(docs, *ADDED, "text_hash", "later", "of_id", "of_hash")
    keyed = docs.withColumn("text_hash", F.xxhash64(F.col(f"`{text}`")))
    later = later_units(keyed, id_column, text, min_words)
    later = later.withColumnRenamed("id", "of_id").withColumnRenamed("text_hash", "of_hash")
    joined = keyed.join(
        later,
        (F.col("text_hash") == F.col("of_hash")) & F.col(f"`{id_column}`").eqNullSafe(F.col("of_id")),
        "left",
    ).select(*[F.col(f"`{c}`") for c in docs.columns], "later")
    id_type = docs.schema[id_column].dataType
    span = StructType([
        StructField("start", LongType()), StructField("end", LongType()),
        StructField("first_ids", ArrayType(id_type)),
    ])
    schema = StructType([
        *docs.schema.fields, StructField("n_units", LongType()),
        StructField("n_removed", LongType()), StructField("removed", ArrayType(span)),
    ])
    arrow = to_arrow_schema(schema)
    names = list(docs.columns)
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
            texts, counts, gone, spans = [], [], [], []
            later = batch.column(batch.schema.get_field_index("later"))
            found = (u for raw, offsets in chunks(columns[text]) for u in units(raw, offsets))
            for t, marks, (start, end, words, _) in zip(columns[text], later, found):
                body = t.as_py()
                counts.append(len(start))
                out = []
                if marks.is_valid:
                    marked = {m["unit"]: m["first_id"] for m in marks.as_py()}
                    out = list(_runs(marked, words, min_words))
                gone.append(sum(b - a for a, b, _ in out))
                if out:
                    coded = body.encode("utf-8", "surrogatepass")
                    cuts = [(start[a] - start[0], end[b - 1] - start[0]) for a, b, _ in out]
                    base = len(coded) - (end[-1] - start[0])
                    points = np.r_[0, np.cumsum((np.frombuffer(coded, np.uint8) & 0xC0) != 0x80)]
                    spots = [(int(points[base + a]), int(points[base + b])) for a, b in cuts]
                    out = [
                        {"start": a, "end": b, "first_ids": ids}
                        for (a, b), (_, _, ids) in zip(spots, out)
                    ]
                    kept, last = [], 0
                    for a, b in spots:
                        kept.append(body[last:a])
                        last = b
                    body = "".join([*kept, body[last:]])
                texts.append(body)
                spans.append(out)
            columns[text] = pa.array(texts, arrow.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans, arrow.field(len(names) + 2).type)],
                schema=arrow,
            )

    return joined.mapInArrow(run, schema)
