"""Byte-level BPE encoding and decoding of whole texts, long unsplit text by tree concatenation.

Texts are cut where the tokenizer certainly splits (between a letter, digit or mark and the space
or line end after it); distinct units between such cuts are encoded once per task. A text of more
than PART characters is cut into parts that go to tasks of their own. Where it has no certain
split within a part, its exact pieces are cut into halves until they fit, the halves are encoded
in parallel, and the halves' ids are joined along a tree: a window of ids around the join is
encoded again and grows until its first and last ids are those of both sides.

Why that is exact: merges happen in the order of rank, then place, so ids are the encoding of their
text if and only if any two neighbours are the encoding of theirs. All neighbours inside a side
or inside the window are; those at the window's ends were neighbours before.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import spread, without
from panelspark.sources.sinks import stage

PART = 1 << 16  # characters of a text, or bytes of a piece, that one task encodes at once
LEAF = 1 << 12  # bytes of a piece that are encoded without halving
CACHED_UNITS = 1_000_000
CACHED_LENGTH = 256  # longer units are seldom seen again
FIRST_WINDOW = 4
CHUNK_CHARS = 1 << 20

# Printable bytes stand for themselves in a byte-level vocabulary, the others for
# the characters from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

# Characters that some reading of white space may hold: no cut after them.
_DOUBT = r"\s" + "".join(map(chr, (
    *range(0x1C, 0x20), 0x85, 0xA0, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030),
    *range(0x205F, 0x2070), 0x3000, 0xFEFF,
)))
_UNIT = re.compile(rf"[{_DOUBT}]*[^{_DOUBT}]+(?:(?![ \n])[{_DOUBT}]+[^{_DOUBT}]*)*|[{_DOUBT}]+")


class Plan:
    """What a tokenizer file has to be like for the method to be exact; ValueError otherwise."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        wrong = [k for k in ("dropout", "unk_token", "continuing_subword_prefix",
                             "end_of_word_suffix", "byte_fallback", "ignore_merges")
                 if model.get(k)]
        if spec.get("normalizer"):
            wrong.append("normalizer")
        if model["type"] != "BPE" or split.get("type") != "ByteLevel":
            wrong.append("model or pre_tokenizer")
        if not split.get("use_regex", True) or split.get("add_prefix_space"):
            wrong.append("pre_tokenizer options")
        self.added = [a["content"] for a in spec["added_tokens"]]
        flags = ("single_word", "lstrip", "rstrip")
        wrong += [a["content"] for a in spec["added_tokens"]
                  if any(a[k] for k in flags) or re.search(r"\s", a["content"])]
        if wrong:
            raise ValueError(f"not a plain byte-level BPE tokenizer: {wrong}")


class ByteTokenizer:
    """Ids and texts of one task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = self.tokenizer.model.tokenize
        others = [b for b in range(256) if b not in set(PRINTABLE)]
        shown = {**{chr(b): b for b in PRINTABLE}, **{chr(256 + i): b for i, b in enumerate(others)}}
        self.added = Plan(path).added
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len)[::-1])) or "$^")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.symbols = [""] * size
        for token, i in vocabulary.items():
            self.symbols[i] = token
        octets = [
            bytes(shown[c] for c in t) if all(c in shown for c in t) else t.encode()
            for t in self.symbols
        ]
        self.octet_starts = np.r_[0, np.cumsum([len(o) for o in octets])].astype(np.int64)
        self.octets = np.frombuffer(b"".join(octets), np.uint8)
        self.simple = re.compile(r" ?[A-Za-z]+").fullmatch
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.met: set[int] = set()  # hashes of units met once
        self.flat = np.empty(1 << 16, np.int32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.used = 0

    def unit(self, unit: str) -> list[int]:
        """Ids of text between certain splits. A word of ASCII letters, with or without a space
        before it, is one piece and goes to the merge table directly."""
        if self.simple(unit):
            return [t.id for t in self.merge(unit.replace(" ", "Ġ"))]
        if len(unit) > LEAF:
            return self.long_unit(unit).tolist()
        return self.tokenizer.encode(unit, add_special_tokens=False).ids

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, piece in the vocabulary's symbols) of a text, as the tokenizer splits it."""
        at = 0
        for m in [*self.special.finditer(text), None]:
            part = text[at : m.start() if m else len(text)]
            if part:
                for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    yield False, piece
            if m:
                yield True, m.group()
                at = m.end()

    def long_unit(self, unit: str) -> np.ndarray:
        found = []
        for special, piece in self.pieces(unit):
            if special:
                found.append(np.array([self.tokenizer.token_to_id(piece)], np.int32))
            else:
                found.append(self.piece(piece))
        return np.concatenate(found) if found else np.empty(0, np.int32)

    def piece(self, symbols: str) -> np.ndarray:
        """Ids of a piece, given in the vocabulary's symbols: one byte each."""
        if len(symbols) <= LEAF:
            return np.array([t.id for t in self.merge(symbols)], np.int32)
        half = len(symbols) // 2
        return self.join(self.piece(symbols[:half]), self.piece(symbols[half:]))

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of two encoded neighbours' text as one piece."""
        if not len(left) or not len(right):
            return right if len(right) else left
        size = FIRST_WINDOW
        while True:
            a, b = left[-size:], right[:size]
            window = "".join([self.symbols[i] for i in (*a.tolist(), *b.tolist())])
            ids = np.array([t.id for t in self.merge(window)], np.int32)
            whole_left, whole_right = size >= len(left), size >= len(right)
            if (whole_left or ids[0] == a[0]) and (whole_right or ids[-1] == b[-1]):
                return np.concatenate([left[: len(left) - len(a)], ids, right[len(b) :]])
            size *= 2

    def join_all(self, parts: list[np.ndarray]) -> np.ndarray:
        """Neighbours two by two, until one is left."""
        while len(parts) > 1:
            pairs = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
            parts = pairs
        return parts[0]

    def learn(self, units: list[str]) -> list[list[int]]:
        """Ids of units that are not known. Those met before are kept from now on: most units
        of a text are either common or never seen again."""
        coded = [self.unit(u) for u in units]
        met, kept = self.met, []
        for i, u in enumerate(units):
            h = hash(u)
            if h not in met:
                met.add(h)
            elif len(u) <= CACHED_LENGTH:
                kept.append(i)
        if len(met) > CACHED_UNITS:
            met.clear()
        if kept:
            ids = [x for i in kept for x in coded[i]]
            lengths = [len(coded[i]) for i in kept]
            total, first = self.used + len(ids), len(self.known)
            if total > len(self.flat):
                self.flat = np.resize(self.flat, 2 * total)
            if first + len(kept) + 1 > len(self.starts):
                self.starts = np.resize(self.starts, 2 * (first + len(kept) + 1))
            self.flat[self.used : total] = ids
            self.starts[first + 1 : first + 1 + len(kept)] = self.used + np.cumsum(lengths)
            self.known.update(zip([units[i] for i in kept], range(first, first + len(kept))))
            self.used = total
        return coded

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and where each text's ids start, with the end."""
        units, counts = [], [0]
        for text in texts:
            units += _UNIT.findall(text)
            counts.append(len(units))
        if len(self.known) > CACHED_UNITS:
            self.forget()
        size, used = len(self.known), self.used
        at = np.array(list(map(self.known.get, units, repeat(-1))), np.int64)
        flat, starts = self.flat, self.starts
        missing = np.flatnonzero(at < 0)
        if len(missing):  # they follow the known ones in this batch's table
            new: dict[str, int] = {}
            at[missing] = [new.setdefault(units[i], size + len(new)) for i in missing.tolist()]
            coded = self.learn(list(new))
            lengths = np.cumsum([len(c) for c in coded])
            flat = np.concatenate([flat[:used], np.array([x for c in coded for x in c], np.int32)])
            starts = np.concatenate([starts[: size + 1], used + lengths])
        lengths = starts[at + 1] - starts[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.arange(total) + np.repeat(starts[at] - (ends - lengths), lengths)]
        return ids, np.r_[0, ends][counts]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the byte-level decoder gives it, special tokens included."""
        lengths = self.octet_starts[ids + 1] - self.octet_starts[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.octet_starts[ids] - (ends - lengths), lengths)
        return self.octets[at].tobytes().decode("utf-8", "replace")


_LOADED: dict[str, ByteTokenizer] = {}


def loaded(path: str) -> ByteTokenizer:
    """One tokenizer per Python worker: the units that a task has learned serve the next ones."""
    if path not in _LOADED:
        _LOADED[path] = ByteTokenizer(path)
    return _LOADED[path]


def _chunks(texts: list[str]) -> Iterator[slice]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_CHARS:
            yield slice(first, i)
            first, size = i, 0
        size += len(t)
    yield slice(first, len(texts))


def _result(tokenizer: ByteTokenizer, keys: pa.Array, ids: np.ndarray, cuts: np.ndarray):
    texts = [tokenizer.decode(ids[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    return pa.RecordBatch.from_arrays(
        [keys, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32())),
         pa.array(texts, pa.string())],
        ["id", "ids", "decoded"],
    )


def cut_long(text: str, tokenizer: ByteTokenizer, part: int = PART):
    """(joins the part before, is text, content) of a long text's parts.

    A part of text is cut at certain splits. Where there is none within `part` characters, parts
    are exact pieces in the vocabulary's symbols, separated by spaces (which no symbol is); the
    first piece of a part that joins is the continuation of the last piece of the part before.
    """
    held, size = [], 0
    for m in _UNIT.finditer(text):
        unit = m.group()
        if size and size + len(unit) > part:
            yield False, True, "".join(held)
            held, size = [], 0
        if len(unit) <= part:
            held.append(unit)
            size += len(unit)
            continue
        pieces, count, joins = [], 0, False
        for special, piece in tokenizer.pieces(unit):
            if special:
                if pieces:
                    yield joins, False, " ".join(pieces)
                yield False, True, piece
                pieces, count, joins = [], 0, False
                continue
            for first in range(0, len(piece), part):
                some = piece[first : first + part]
                if first or count + len(some) > part:
                    if pieces:
                        yield joins, False, " ".join(pieces)
                    pieces, count, joins = [], 0, first > 0
                pieces.append(some)
                count += len(some)
        if pieces:
            yield joins, False, " ".join(pieces)
    if held:
        yield False, True, "".join(held)


def encode(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text",
    part: int = PART,
) -> DataFrame:
    """(id, ids, decoded): the token ids of every whole text, and the text they decode to.

    Strings of special tokens inside a text are those tokens, as the tokenizer has it; nothing is
    added. A NULL text is an empty one and has no ids. Repeated rows are rows of their own, other
    columns are ignored whatever their names, an empty table has no rows. A text of any length is
    encoded whole: its parts by many tasks, its joins and its result by one.
    """
    Plan(tokenizer_path)
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    result = f"id {kind}, ids array<int>, decoded string"

    def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokenizer = loaded(tokenizer_path)
            for some in _chunks(texts) if texts else ():
                ids, cuts = tokenizer.encode(texts[some])
                yield _result(tokenizer, batch.column(0).slice(some.start, some.stop - some.start),
                              ids, cuts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            tokenizer = loaded(tokenizer_path)
            for r in range(batch.num_rows):
                key, row = (task << 32) + row, row + 1
                for place, (joins, plain, content) in enumerate(
                    cut_long(batch.column(1)[r].as_py(), tokenizer, part)
                ):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(r, 1), pa.array([key], pa.int64()),
                         pa.array([place], pa.int32()), pa.array([joins]), pa.array([plain]),
                         pa.array([content], pa.string())],
                        ["id", "key", "place", "joins", "plain", "content"],
                    )

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokenizer = loaded(tokenizer_path)
            for r in range(batch.num_rows):
                content = batch.column(5)[r].as_py()
                if batch.column(4)[r].as_py():
                    pieces = [tokenizer.encode([content])[0]]
                else:
                    pieces = [tokenizer.piece(p) for p in content.split(" ")]
                # Only a part's first and last piece can join its neighbours.
                ends = [pieces[0], np.concatenate([np.empty(0, np.int32), *pieces[1:-1]]),
                        pieces[-1] if len(pieces) > 1 else np.empty(0, np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(r, 1) for i in range(4)],
                     *[pa.array([e.tolist()], pa.list_(pa.int32())) for e in ends]],
                    ["id", "key", "place", "joins", "first", "middle", "last"],
                )

    def join_parts(group: pa.Table) -> pa.Table:
        tokenizer = loaded(tokenizer_path)
        group = group.sort_by("place")
        done, open_ = [], []  # open_: what the next part's first piece may join
        for r in range(len(group)):
            first, middle, last = (
                np.array(group.column(c)[r].as_py(), np.int32) for c in ("first", "middle", "last")
            )
            if not group.column("joins")[r].as_py() and open_:
                done.append(tokenizer.join_all(open_))
                open_ = []
            open_.append(first)
            if len(middle) or len(last):
                done += [tokenizer.join_all(open_), middle]
                open_ = [last]
        done.append(tokenizer.join_all(open_))
        ids = np.concatenate(done)
        found = _result(tokenizer, group.column("id").slice(0, 1).combine_chunks(), ids,
                        np.array([0, len(ids)]))
        return pa.Table.from_batches([found])

    short = rows.where(f"length(text) <= {part}").mapInArrow(direct, result)
    parts = stage(rows.where(f"length(text) > {part}").mapInArrow(
        cut, f"id {kind}, key long, place int, joins boolean, plain boolean, content string"
    ))
    encoded = parts.repartition(spread(docs), "key", "place").mapInArrow(
        encode_parts, f"id {kind}, key long, place int, joins boolean, first array<int>,"
        " middle array<int>, last array<int>"
    )
    long = encoded.groupBy("key").applyInArrow(join_parts, result)
    return short.unionByName(long).withColumnRenamed("id", id_column)
