"""Mixture-controlled packing of documents into token sequences.

Every source is a queue of tokens. Windows are filled by deficit round-robin with a quantum of
one token: in each window a queue may send its share of the window, and what rounding withholds
is its deficit, carried into the next window. The number of tokens that a queue has sent after
any number of positions has a closed form (shares are rounded down along a balanced tree over the
queues, so counts never decrease and always add up), which carries the deficits across windows
and partitions: a task places its documents from its starting positions alone.

The number of queues on the driver is bounded: sources below 1/1024 of all tokens (and without a target)
share one queue. Inside it the same closed form places them one level down, in proportion to their
lengths: first a tree over hashed buckets of sources, then one over the sources of a bucket. The weights
on a source's way down these trees are a column of its tokens, so no list of sources is gathered.
"""

from __future__ import annotations

import json
import unicodedata
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import spread
from panelspark.sources.sinks import stage, stage_path

SEQUENCE = 2048
END = 1
SMALLEST_SHARE = 1024
BUCKET_SOURCES = 1000
MAX_BUCKETS = 4096
CACHED_WORDS = 500_000
CHUNK_BYTES = 4 << 20


# Printable bytes stand for themselves in a byte-level vocabulary, the others for
# the characters from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
PROBES = ["hello", "straße", "éaument", "niño", "ünd", "большой", "ﬀx", "a", "internationalization"]


# How a tokenizer file has to cut for its words to be encoded one by one. Pieces are
# runs of letters, single digits and runs of other marks; white space is dropped and nothing that
# is done before looks across it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]


def cuts_at_spaces(spec: dict) -> bool:
    """Whether a tokenizer file's pieces neither hold nor look across white space."""
    normalizer, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    first = (split.get("pretokenizers") or [{}])[0]
    added = [a for a in spec["added_tokens"] if a["lstrip"] or a["rstrip"] or a["single_word"]]
    return (
        normalizer.get("type") == "Sequence" and normalizer["normalizers"] == NORMALIZERS
        and split.get("type") == "Sequence" and first.get("type") == "Split"
        and first["pattern"] == {"Regex": SPLIT} and first["behavior"] == "Removed"
        and first["invert"] and not added and not spec.get("truncation")
    )


class WordTokenizer:
    """Token ids of many texts, as the library encodes them without adding special tokens.

    Where the tokenizer's pieces never hold or look across a space (`cuts_at_spaces`), texts are
    encoded through their distinct words. A word of letters alone is one piece and goes to the
    merge table directly, if that gives the same ids for PROBES; any other word goes through the
    whole tokenizer. Texts that hold a special token's string, and all texts of any other
    tokenizer, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_words = cuts_at_spaces(spec)
        self.specials = [a["content"] for a in spec["added_tokens"]]
        self.merge = self.tokenizer.model.tokenize
        others = [b for b in range(256) if b not in set(PRINTABLE)]
        self.as_byte = {b: chr(256 + i) for i, b in enumerate(others)}
        self.direct = self.by_words and all(self.letters(w) == self.encode(w) for w in PROBES)
        self.forget()

    def encode(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def letters(self, word: str) -> list[int]:
        """Ids of a word of letters, lower-cased and composed."""
        if not word.isascii():
            word = word.encode("utf-8").decode("latin-1").translate(self.as_byte)
        return [t.id for t in self.merge(word)]

    def word(self, word: str) -> list[int]:
        if self.direct:
            if word.isascii():
                if word.isalpha():
                    return self.letters(word.lower())
            elif "\u03a3" not in word and unicodedata.is_normalized("NFC", word):
                lowered = word.lower()
                if lowered.isalpha():
                    return self.letters(lowered)
        return self.encode(word)

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.used = 0

    def learn(self, words: list[str]) -> None:
        known = self.known
        new = [w for w in words if w not in known]
        if not new:
            return
        if len(known) + len(new) > CACHED_WORDS and known:
            self.forget()
            known, new = self.known, words
        coded, lengths = [], []
        for w in new:
            ids = self.word(w)
            coded += ids
            lengths.append(len(ids))
        total = self.used + len(coded)
        if total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * total)
        if len(known) + len(new) + 1 > len(self.starts):
            self.starts = np.resize(self.starts, 2 * (len(known) + len(new) + 1))
        self.flat[self.used : total] = coded
        first = len(known)
        self.starts[first + 1 : first + 1 + len(new)] = self.used + np.cumsum(lengths)
        known.update(zip(new, range(first, first + len(new))))
        self.used = total

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (NULL is empty)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = np.full(len(texts), not self.by_words)
        for special in self.specials:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        if whole.any():
            out: list = [None] * len(texts)
            for i in np.flatnonzero(whole).tolist():
                out[i] = np.array(self.encode(texts[i].as_py()), np.uint32)
            rest = np.flatnonzero(~whole)
            if len(rest):
                for i, ids in zip(rest.tolist(), self.ids(texts.take(pa.array(rest)))):
                    out[i] = ids
            return out
        if self.direct:  # a mark that ends a word of letters is a piece of its own
            texts = pc.replace_substring_regex(texts, r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,!?;:$*%#&|]+\s)", r"\1 \2")
        pieces = pc.ascii_split_whitespace(texts)
        offsets = pieces.offsets.to_numpy()
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn(words)
        known = self.known
        place = np.array([known[w] for w in words], np.int64)
        word = place[coded.indices.to_numpy()]
        lengths = self.starts[word + 1] - self.starts[word]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[word] - (ends - lengths), lengths)
        out = self.flat[at]
        cuts = np.r_[0, ends][offsets - offsets[0]]
        return [out[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about CHUNK_BYTES; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > CHUNK_BYTES:
            yield texts.slice(first, i - first)
            first, size = i, 0
        size += n
    yield texts.slice(first)


def tokenize(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text",
    source: str = "source", end: int = END,
) -> DataFrame:
    """(id, source, ids, n_tokens, part, nth, part_start): each document's ids and the end id, as
    little-endian unsigned 32-bit numbers, its source's number in its task's part, and its place
    in its source's part of the queue. A text of any length is encoded whole; its ids are one value."""
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        part, sent, number = TaskContext.get().partitionId(), {}, {}
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            done = 0
            for texts in _chunks(batch.column(2)) if batch.num_rows else ():
                ids = tokenizer.ids(texts)
                coded = [i.astype("<u4").tobytes() + last for i in ids]
                own = batch.slice(done, len(texts))
                done += len(texts)
                starts, nth = [], []
                for name, c in zip(own.column(1).to_pylist(), coded):
                    nth.append(number.setdefault(name, len(number)))
                    starts.append(sent.get(name, 0))
                    sent[name] = starts[-1] + len(c) // 4
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(coded, pa.binary()),
                     pa.array([len(c) // 4 for c in coded], pa.int64()),
                     pa.array([part] * len(coded), pa.int64()), pa.array(nth, pa.int32()),
                     pa.array(starts, pa.int64())],
                    ["id", "source", "ids", "n_tokens", "part", "nth", "part_start"],
                )

    return rows.mapInArrow(
        run, f"id {kind}, source string, ids binary, n_tokens long, part long, nth int,"
        " part_start long"
    )


def stage_by_part(tokens: DataFrame) -> DataFrame:
    """The tokens written once, bucketed by part: a task's part is one file, and a join on the part
    reads the ids where they are, without a shuffle or a sort of them."""
    spark, name = tokens.sparkSession, f"tokens_{uuid.uuid4().hex}"
    writer = tokens.write.format("parquet").option("path", stage_path(spark))
    writer.bucketBy(spread(tokens), "part").saveAsTable(name)
    staged = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its name: the files are outside the warehouse
    return staged


class Mixture:
    """How many tokens each queue has sent after x positions.

    A phase lasts until a queue is empty; the others go on in the proportion of their weights.
    With weights equal to the queues' lengths there is a single phase.
    """

    def __init__(self, lengths: list[int], weights: list[int]):
        self.total = sum(lengths)
        self.starts, self.phases, self.bases = [], [], []
        sent, at = [0] * len(lengths), 0
        while at < self.total:
            open_ = [q for q in range(len(lengths)) if sent[q] < lengths[q]]
            rest = [lengths[q] - sent[q] for q in range(len(lengths))]
            if not any(weights[q] for q in open_):
                weights = rest  # queues without a target fill up at the end
            cum = [0]
            for q, w in enumerate(weights):
                cum.append(cum[-1] + (w if rest[q] else 0))
            # Rounding along the tree moves a count by less than one at each of its levels, so only
            # queues that can be the first to be empty within that have to be looked at.
            weight, off = cum[-1], len(cum).bit_length() + 1
            own = {q: cum[q + 1] - cum[q] for q in open_ if cum[q + 1] > cum[q]}
            latest = min((rest[q] + off) * weight // w + 1 for q, w in own.items())
            first = [q for q, w in own.items() if (rest[q] - off) * weight // w <= latest]
            low, high = 0, min(sum(rest), latest)
            while low < high:
                x = (low + high + 1) // 2
                if all(self._in_phase(cum, q, x)[0] <= rest[q] for q in first):
                    low = x
                else:
                    high = x - 1
            self.starts.append(at)
            self.phases.append(cum)
            self.bases.append((list(sent), [0, *accumulate(sent)]))
            if low == 0:  # rounding gives the next token to a queue that has none left
                low, cum = sum(rest), [0, *np.cumsum(np.array(rest, object)).tolist()]
                self.phases[-1] = cum
            sent = [s + self._in_phase(cum, q, low)[0] for q, s in enumerate(sent)]
            at += low

    @staticmethod
    def _in_phase(cum: list[int], q: int, x: int) -> tuple[int, int]:
        """Of x positions, those of queue q and those of the queues before it."""
        low, high, before = 0, len(cum) - 1, 0
        while high - low > 1:
            mid = (low + high) // 2
            weight = cum[high] - cum[low]
            left = x * (cum[mid] - cum[low]) // weight if weight else 0
            if q < mid:
                high, x = mid, left
            else:
                low, x, before = mid, x - left, before + left
        return (x if cum[high] > cum[low] else 0), before

    def sent(self, q: int, x: int) -> tuple[int, int]:
        """Tokens of queue q, and of the queues before it, in the first x positions."""
        k = max(0, bisect_right(self.starts, x) - 1)
        own, before = self._in_phase(self.phases[k], q, x - self.starts[k])
        base, base_before = self.bases[k]
        return base[q] + own, base_before[q] + before


def way(cum: list[int], q: int) -> list[int]:
    """The weight of a balanced tree over queues with the sums `cum`, and for each node down to queue
    q the weight of its left side, doubled, plus one where q lies on the right."""
    low, high, found = 0, len(cum) - 1, [cum[-1] - cum[0]]
    while high - low > 1:
        mid = (low + high) // 2
        found.append(2 * (cum[mid] - cum[low]) + (q >= mid))
        low, high = (mid, high) if q >= mid else (low, mid)
    return found


def follow(steps: list[int], x: int) -> tuple[int, int]:
    """Of x positions, those of the queue that the steps of way() lead to and those before it."""
    weight, before = steps[0], 0
    for step in steps[1:]:
        side = step >> 1
        left = x * side // weight if weight else 0
        if step & 1:
            x, before, weight = x - left, before + left, weight - side
        else:
            x, weight = left, side
    return x, before


def ways(small: DataFrame) -> DataFrame:
    """(way_source, way) of every source of (source, n): from all of them down to the source."""
    wanted = max(1, min(MAX_BUCKETS, small.count() // BUCKET_SOURCES))
    dealt = small.withColumn("bucket", F.expr(f"CAST(pmod(xxhash64(source), {wanted}) AS INT)"))
    buckets = dealt.groupBy("bucket").agg(F.sum("n").alias("n")).orderBy("bucket").collect()
    cum = [0, *np.cumsum([r["n"] for r in buckets]).tolist()]
    to_bucket = {r["bucket"]: way(cum, i) for i, r in enumerate(buckets)}

    def inside(group: pa.Table) -> pa.Table:
        group = group.sort_by("source")
        cum = [0, *np.cumsum(group.column("n").to_numpy()).tolist()]
        head = to_bucket[group.column("bucket")[0].as_py()]
        rows = [head + way(cum, q)[1:] for q in range(len(group))]
        return pa.table([group.column("source"), pa.array(rows, pa.list_(pa.int64()))],
                        ["way_source", "way"])

    return dealt.groupBy("bucket").applyInArrow(inside, "way_source string, way array<bigint>")


def sequence_bounds(total: int, size: int) -> tuple[int, list[int]]:
    """Full sequences, and the ends of the last ones: what is left is cut at powers of two, so
    no sequence needs padding."""
    full, ends = total // size, [total // size * size]
    left = total - ends[0]
    for bit in reversed(range(left.bit_length())):
        if left >> bit & 1:
            ends.append(ends[-1] + (1 << bit))
    return full, ends


def pack(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text",
    source: str = "source", targets: dict | None = None, size: int = SEQUENCE, end: int = END,
) -> DataFrame:
    """(id, start, length, ids, doc_tokens, sequence_id, offset): one row per piece.

    `ids` are the piece's little-endian unsigned 32-bit ids. `targets` gives sources their share of
    every window (any positive whole numbers); sources without one follow when the others are
    empty. A target that is no such number, or names a source without documents, is an error. Without targets each source has its share of all tokens, so every window has the
    mixture of the corpus. A NULL text is its end id alone, a NULL source is a source, equal
    rows are documents of their own, a text of any length is cut like others, and an empty table
    has no pieces. Columns other than the three named are left out, whatever their names.

    Ids are written once and read where they lie: what a task needs to know of other tasks, one row
    per part, goes to the ids.
    """
    targets = None if targets is None else {
        None if k is None else str(k): v for k, v in targets.items()
    }
    wrong = [k for k, v in (targets or {}).items() if v != int(v) or v <= 0]
    if wrong:
        raise ValueError(f"targets must be positive whole numbers: {wrong}")
    tokens = stage_by_part(tokenize(docs, tokenizer_path, id_column, text, source, end))
    parts = stage(tokens.groupBy("source", "part").agg(
        F.sum("n_tokens").alias("n"), F.min("nth").alias("nth")
    ))
    total = parts.agg(F.sum("n")).first()[0] or 0
    by_source = parts.groupBy("source").agg(F.sum("n").alias("n"))
    named = F.col("n") * SMALLEST_SHARE >= F.lit(total)
    if targets:
        named |= F.coalesce(F.col("source").isin([k for k in targets if k is not None]), F.lit(False))
        if None in targets:
            named |= F.col("source").isNull()
    # At most SMALLEST_SHARE rows, as shares add up to one, and those of the targets.
    large = by_source.where(named).orderBy("source").collect()
    names = [r["source"] for r in large]
    lengths = [r["n"] for r in large] + [total - sum(r["n"] for r in large)]
    absent = [k for k in targets or () if k not in names]
    if absent and total:
        raise ValueError(f"targets name sources without documents: {absent}")
    if targets is None:
        weights = list(lengths)
    else:
        weights = [int(targets.get(n, 0)) for n in names] + [0]
    mixture = Mixture(lengths, weights)

    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    queues = docs.sparkSession.createDataFrame(
        list(zip(names, range(len(names)))), "queue_source string, queue long"
    )
    starts = parts.withColumn(
        "queue_start", F.coalesce(F.sum("n").over(earlier), F.lit(0))
    ).join(queues, F.col("source").eqNullSafe(F.col("queue_source")), "left")
    if lengths[-1]:
        down = stage(ways(by_source.where(~named)))
        starts = starts.join(down, F.col("source").eqNullSafe(F.col("way_source")), "left")
    else:
        starts = starts.withColumn("way", F.lit(None).cast("array<bigint>"))
    # One row per part, its sources by their number there: a row of tokens finds its own by place.
    of_part = starts.groupBy(F.col("part").alias("of_part")).agg(F.array_sort(F.collect_list(
        F.struct("nth", F.expr(f"coalesce(queue, {len(names)}L) AS queue"), "queue_start", "way")
    )).alias("starts"))
    placed = tokens.join(
        of_part.hint("shuffle_hash"), F.col("part") == F.col("of_part")
    ).selectExpr("id", "ids", "part_start", "get(starts, nth) AS s").selectExpr(
        "id", "ids", "s.queue", "s.queue_start + part_start AS queue_start", "s.way"
    )
    kind = placed.schema["id"].dataType.simpleString()
    full, tail = sequence_bounds(total, size)
    windows = full + len(tail) - 1

    def bound(w: int) -> int:
        return w * size if w <= full else tail[w - full]

    def sent(q: int, down: tuple, x: int) -> tuple[int, int]:
        own, before = mixture.sent(q, x)
        if down:
            own, inside = follow(down, own)
            before += inside
        return own, before

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = {}  # the last window of each source
        for batch in batches:
            row, pieces = [], []
            ids = batch.column(1)
            for n, (q, a, down, coded) in enumerate(zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist(),
                batch.column(4).to_pylist(), ids,
            )):
                octets = coded.as_buffer()
                length = octets.size // 4
                at, stop = a, a + length
                down = tuple(down or ())
                w, low, high, before, after = window.get((q, down), (-1, 0, 0, 0, 0))
                while at < stop:
                    if not low <= at < high:
                        near = w >= 0 and at == high
                        w = w + 1 if near else _find_window(sent, bound, q, down, at, windows)
                        low, before = sent(q, down, bound(w))
                        high, after = sent(q, down, bound(w + 1))
                        if at >= high:  # a window without tokens of this source
                            w = _find_window(sent, bound, q, down, at, windows)
                            low, before = sent(q, down, bound(w))
                            high, after = sent(q, down, bound(w + 1))
                    last = min(stop, high)
                    row.append(n)
                    pieces.append((
                        at - a, last - at, octets.slice(4 * (at - a), 4 * (last - at)).to_pybytes(),
                        length, w, after - before + at - low,
                    ))
                    at = last
                if len(window) > CACHED_WORDS:
                    window.clear()
                window[q, down] = (w, low, high, before, after)
            for first in range(0, len(pieces), 20_000):
                some = list(zip(*pieces[first : first + 20_000]))
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                owners = batch.column(0).take(pa.array(row[first : first + 20_000], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [owners, *[pa.array(c, k) for c, k in zip(some, kinds)]],
                    ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    return placed.mapInArrow(
        run,
        f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long,"
        " offset long",
    ).withColumnRenamed("id", id_column)


def _find_window(sent, bound, q: int, down: tuple, at: int, windows: int) -> int:
    """The last window that starts with at most `at` tokens of the source sent."""
    low, high = 0, windows - 1
    while low < high:
        mid = (low + high + 1) // 2
        if sent(q, down, bound(mid))[0] <= at:
            low = mid
        else:
            high = mid - 1
    return low
