"""Benchmark decontamination by a broadcast set of hashed word windows.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. Every byte of a
non-ASCII character is a word byte and every other word byte is a single character, so the words
are found on the UTF-8 bytes of many texts at once. A window is `size` consecutive words of an
item; an item of fewer words (but not none) is one window. Windows are hashed; a document window
whose hash is in the set is compared with the benchmark's words byte by byte before it counts.

The set is broadcast in blocks of at most `block_words` benchmark words, one scan of the documents
each: a block is built on the driver from its own words alone, its scan is staged, and its
broadcast is gone before the next one is made. An item longer than a block is cut into pieces that
overlap by a window less one word, so the driver and a task hold some 100 bytes per word of a
block, and no more whatever the benchmark's size. One block is the usual case, and then lazy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from panelspark.llm.common import without
from panelspark.sources.sinks import stage

WINDOW = 13
BLOCK_WORDS = 1_000_000
CHUNK_BYTES = 1 << 20
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
EVIDENCE = ["n_words", "n_hit", "items", "spans"]

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _lowered() -> np.ndarray:
    """Byte to lower-cased word byte; zero for bytes outside words."""
    to = np.zeros(256, np.uint8)
    for b in range(256):
        if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A:
            to[b] = b
        elif 0x41 <= b <= 0x5A:
            to[b] = b + 32
    return to


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """The words of several texts: lower-cased bytes, and per word start, stop and hash."""

    octets: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray
    text: np.ndarray  # number of the text of each word


def words_of(
    raw: np.ndarray, offsets: np.ndarray, lowered: np.ndarray, breaks: np.ndarray | None = None
) -> Words:
    """Words of the texts that lie in `raw` between consecutive `offsets`. A word also begins at
    each of `breaks`."""
    octets = lowered[raw]
    inside = octets != 0
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(raw)]
    if breaks is not None:
        borders = np.concatenate([borders, breaks])
    before[borders] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    after[borders[borders > 0] - 1] = False
    stop = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(raw) + 1, np.uint64)
    powers = _powers(len(raw) + 1, _BASE)
    with np.errstate(over="ignore"):
        np.cumsum(octets * powers[:-1], out=sums[1:])
        # The inverse power makes the hash independent of the place in the chunk.
        value = (sums[stop] - sums[start]) * _powers(len(raw) + 1, _INVERSE)[start]
        value ^= value >> np.uint64(29)
        value *= _STEP
    text = np.searchsorted(offsets, start, side="right") - 1
    return Words(octets, start, stop, value, text)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of `size` consecutive word hashes, for each first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out *= _STEP
            out += hashes[k : k + n]
        out ^= out >> np.uint64(31)
        out *= _BASE
    return out


def _buffers(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(coded) + 1, np.int64)
    np.cumsum([len(c) for c in coded], out=offsets[1:])
    return np.frombuffer(b"".join(coded), np.uint8), offsets


@dataclass
class WindowSet:
    """The distinct windows of a block of items, by window size."""

    octets: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    by_size: dict  # size -> (sorted hashes, first word of each window, its number)
    owner_starts: np.ndarray  # window number -> where its owners begin in `owners`
    owners: np.ndarray  # places in `items`
    items: list  # ids of the block's items as strings, None for an item without id

    def items_of(self, window: int) -> list[str]:
        places = self.owners[self.owner_starts[window] : self.owner_starts[window + 1]]
        return [self.items[i] for i in places.tolist() if self.items[i] is not None]


def window_set(items: list[tuple], size: int) -> WindowSet:
    """The set of a block of (item id, text). An item without id hits words but isn't listed."""
    raw, offsets = _buffers([t for _, t in items])
    words = words_of(raw, offsets, _lowered())
    counts = np.bincount(words.text, minlength=len(items))
    firsts = np.r_[0, np.cumsum(counts)]
    by_size, windows, owners, n = {}, [], [], 0
    for length in np.unique(np.minimum(counts[counts > 0], size)).tolist():
        chosen = np.flatnonzero(counts >= size if length == size else counts == length)
        spans = counts[chosen] - length + 1
        at = np.repeat(firsts[chosen] - np.r_[0, np.cumsum(spans)[:-1]], spans) + np.arange(spans.sum())
        value = window_hashes(words.hash, length)[at]
        order = np.lexsort((at, value))
        at, value = at[order], value[order]
        number = _number_alike(words, at, value, length)
        first = np.unique(number, return_index=True)[1]
        rank = np.argsort(value[first], kind="stable")
        by_size[length] = (value[first][rank], at[first][rank], n + rank)
        windows.append(n + number)
        owners.append(words.text[at])
        n += len(first)
    pairs = np.empty((0, 2), np.int64)
    if windows:
        pairs = np.unique(np.c_[np.concatenate(windows), np.concatenate(owners)], axis=0)
    starts = np.searchsorted(pairs[:, 0], np.arange(n + 1))
    names = [None if i is None else str(i) for i, _ in items]
    return WindowSet(words.octets, words.start, words.stop, by_size, starts, pairs[:, 1].copy(), names)


def _number_alike(words: Words, at: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """Numbers from 0 on for windows in the order of their hashes, alike for windows of the same
    words. Windows that only share a hash are told apart."""
    number = np.full(len(at), -1)
    n = 0
    while True:
        left = np.flatnonzero(number < 0)
        if not len(left):
            return number
        new = np.r_[True, value[left][1:] != value[left][:-1]]
        head = np.maximum.accumulate(np.where(new, np.arange(len(left)), 0))
        same = _same_words(words, at[left], words, at[left][head], size)
        number[left[same]] = n + (np.cumsum(new) - 1)[same]
        n += int(new.sum())


def _same_words(words: Words, at: np.ndarray, known, first: np.ndarray, size: int) -> np.ndarray:
    """Which document windows have the benchmark's words, byte by byte."""
    same = np.ones(len(at), bool)
    for k in range(size):
        a, b = words.start[at + k], known.start[first + k]
        length = words.stop[at + k] - a
        same &= length == known.stop[first + k] - b
        length = np.where(same, length, 0)
        ends = np.cumsum(length)
        if not len(ends) or not ends[-1]:
            continue
        step = np.arange(ends[-1]) - np.repeat(ends - length, length)
        unequal = words.octets[np.repeat(a, length) + step] != (
            known.octets[np.repeat(b, length) + step]
        )
        same[np.repeat(np.arange(len(at)), length)[unequal]] = False
    return same


def find_windows(words: Words, known: WindowSet) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(first word, position in items, size) of every verified window in the texts."""
    found = []
    for size, (hashes, first, position) in known.by_size.items():
        values = window_hashes(words.hash, size)
        whole = np.flatnonzero(words.text[: len(values)] == words.text[size - 1 :][: len(values)])
        low = np.searchsorted(hashes, values[whole])
        low[low == len(hashes)] = 0
        hit = hashes[low] == values[whole]
        at, row = whole[hit], low[hit]
        while len(at):  # windows with equal hashes follow one another
            same = _same_words(words, at, known, first[row], size)
            found.append((at[same], position[row[same]], size))
            more = (row + 1 < len(hashes)) & ~same
            more[more] = hashes[row[more] + 1] == hashes[row[more]]
            at, row = at[more], row[more] + 1
    return found


def chunks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """UTF-8 bytes and offsets of the texts in order, about CHUNK_BYTES at a time."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    for i in range(len(texts)):
        if offsets[i + 1] - offsets[first] >= CHUNK_BYTES or i == len(texts) - 1:
            a, b = offsets[first], offsets[i + 1]
            yield raw[a:b], offsets[first : i + 2] - a
            first = i + 1


def scan(texts: pa.Array, known: WindowSet, lowered: np.ndarray):
    """Per text: words, hit words, item ids, spans as [start, end) in code points."""
    for raw, offsets in chunks(texts):
        yield from _scan_chunk(raw, offsets, known, lowered)


def _scan_chunk(raw: np.ndarray, offsets: np.ndarray, known: WindowSet, lowered: np.ndarray):
    words = words_of(raw, offsets, lowered)
    n_texts = len(offsets) - 1
    counts = np.bincount(words.text, minlength=n_texts)
    marks = np.zeros(len(words.start) + 1, np.int64)
    items: dict[int, set] = {}
    for at, position, size in find_windows(words, known):
        np.add.at(marks, at, 1)
        np.add.at(marks, at + size, -1)
        many = len(known.owner_starts)
        pairs = np.unique(words.text[at] * many + position)
        for pair in pairs.tolist():
            text, window = divmod(pair, many)
            items.setdefault(text, set()).update(known.items_of(window))
    hit = np.cumsum(marks[:-1]) > 0
    hits = np.bincount(words.text[hit], minlength=n_texts)
    spans: dict[int, list] = {}
    if hit.any():
        points = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
        joined = np.flatnonzero(hit)
        new = np.r_[True, (np.diff(joined) > 1) | (np.diff(words.text[joined]) > 0)]
        last = np.r_[np.flatnonzero(new)[1:] - 1, len(joined) - 1]
        for a, b in zip(joined[new].tolist(), joined[last].tolist()):
            t = int(words.text[a])
            base = points[offsets[t]]
            spans.setdefault(t, []).append(
                {"start": int(points[words.start[a]] - base), "end": int(points[words.stop[b]] - base)}
            )
    for t in range(n_texts):
        yield int(counts[t]), int(hits[t]), sorted(items.get(t, ())), spans.get(t, [])


def _blocks(
    benchmark: DataFrame, item_id: str, text: str, block_words: int, size: int
) -> Iterator[list]:
    """The items, a bounded block at a time."""
    block, room = [], block_words
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).distinct()
    for row in rows.toLocalIterator():
        for piece in _pieces(row["t"] or "", block_words, size):
            words = len(piece) // 2 + 1  # a word takes a letter and a separator at least
            if block and words > room:
                yield block
                block, room = [], block_words
            block.append((row["i"], piece))
            room -= words
    yield block


def _pieces(text: str, block_words: int, size: int) -> Iterator[str]:
    """A text whole, or its words in pieces that share every window of theirs with the text."""
    if len(text) // 2 + 1 <= block_words:
        yield text
        return
    words = _WORD.findall(text)
    step = max(1, block_words - size + 1)
    for first in range(0, max(1, len(words) - size + 1), step):
        yield " ".join(words[first : first + step + size - 1])


def find(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", size: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Adds `n_words`, `n_hit`, `items` (ids as sorted strings) and `spans` (hit words joined,
    in code points) to the documents, replacing columns of those names.

    A NULL or empty text has no words; an empty benchmark hits nothing; a repeated item or
    document counts as it stands. Documents that are too long for a chunk are a chunk alone.
    """
    docs = without(docs, *EVIDENCE)
    blocks = _blocks(benchmark, item_id, item_text, block_words, size)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _find_block(docs, first, text, size)[0]
    row = "row_of_the_scan"
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()))
    parts = None
    for block in chain([first, second], blocks):
        found, shared = _find_block(numbered.select(row, text), block, text, size)
        found = stage(found.drop(text).where("n_hit > 0").drop("n_words", "n_hit"))
        shared.unpersist()
        parts = found if parts is None else parts.union(found)
    merged = parts.groupBy(row).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )
    return recount(numbered.join(merged, row, "left").drop(row), text)


def recount(found: DataFrame, text: str) -> DataFrame:
    """Joins overlapping spans of several blocks and counts their words."""
    kept = without(found, *EVIDENCE)
    schema = StructType([*kept.schema.fields, *_evidence_fields()])
    names = list(kept.columns)
    kinds = [f.type for f in to_arrow_schema(StructType(_evidence_fields()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lowered = _lowered()
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            spans, items, counts, hits = [], [], [], []
            for body, found_spans, found_items in zip(column[text], column["spans"], column["items"]):
                raw, offsets = _buffers([body.as_py()])
                words = words_of(raw, offsets, lowered)
                hit = np.zeros(len(words.start), bool)
                joined = []
                if found_spans.is_valid and len(found_spans.values):
                    points = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
                    starts = points[words.start]
                    mark = np.zeros(len(words.start) + 1, np.int64)
                    bounds = found_spans.values
                    # Spans begin and end with words.
                    np.add.at(mark, np.searchsorted(starts, bounds.field("start").to_numpy()), 1)
                    np.add.at(mark, np.searchsorted(starts, bounds.field("end").to_numpy()), -1)
                    hit = np.cumsum(mark[:-1]) > 0
                    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
                    joined = [
                        {"start": int(starts[a]), "end": int(points[words.stop[b - 1]])}
                        for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0))
                    ]
                spans.append(joined)
                items.append(found_items.as_py() or [])
                counts.append(len(hit))
                hits.append(int(hit.sum()))
            added = [pa.array(v, k) for v, k in zip((counts, hits, items, spans), kinds)]
            yield pa.RecordBatch.from_arrays(
                [*[column[n] for n in names], *added], [*names, *EVIDENCE]
            )

    return found.mapInArrow(run, schema)


def _evidence_fields() -> list[StructField]:
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    kinds = [LongType(), LongType(), ArrayType(StringType()), ArrayType(span)]
    return [StructField(n, k) for n, k in zip(EVIDENCE, kinds)]


def _find_block(docs: DataFrame, items: list, text: str, size: int):
    """The documents with the evidence of a block, and the broadcast behind it."""
    known = window_set(items, size)
    shared = docs.sparkSession.sparkContext.broadcast(
        (known.octets, known.start, known.stop, known.by_size, known.owner_starts, known.owners,
         known.items)
    )
    names = list(docs.columns)
    fields = _evidence_fields()
    schema = StructType([*docs.schema.fields, *fields])
    kinds = [f.type for f in to_arrow_schema(StructType(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lowered, known = _lowered(), WindowSet(*shared.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            rows = list(scan(column, known, lowered))
            added = [pa.array([r[i] for r in rows], kinds[i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*names, *EVIDENCE])

    return docs.mapInArrow(run, schema), shared


def is_contaminated(percent: int = 5) -> str:
    return f"(n_hit > 0 AND 100 * n_hit >= {percent} * n_words)"


def remove_documents(found: DataFrame, percent: int = 5) -> DataFrame:
    """Drops documents of which at least `percent` of the words were hit."""
    return found.where(f"NOT {is_contaminated(percent)}")


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Cuts the hit spans out of the texts; a NULL text stays NULL."""
    kept = "transform(spans, (s, i) -> substring({t}, CAST({a} AS INT) + 1, CAST(s.start - {a} AS INT)))"
    before = "coalesce(get(spans, i - 1).end, 0)"
    body = kept.format(t=f"`{text}`", a=before)
    tail = f"substring(`{text}`, CAST(coalesce(element_at(spans, -1).end, 0) AS INT) + 1)"
    cut = f"CASE WHEN size(spans) = 0 THEN `{text}` ELSE concat(array_join({body}, ''), {tail}) END"
    return found.withColumn(text, F.expr(cut))
