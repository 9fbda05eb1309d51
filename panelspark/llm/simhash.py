"""SimHash near-duplicates: bit slices first, vantage points inside.

Fingerprints that differ in at most `max_bits` bits are linked, exactly. A vantage-point tree over whole
fingerprints would copy most points to both sides at each level, as distances of 64-bit
fingerprints to any point crowd around 32. Its upper levels are therefore replaced by slices: with the
64 bits cut into max_bits + 2 of them, two linked fingerprints agree on at least two, so cells of
equal pairs of slices do not overlap and hold every link. Vantage points do the rest: a cell that
still holds many fingerprints is split by whole-fingerprint distance to one into bands, a fingerprint
within `max_bits` above a band's upper border being copied into that band (the overlapping
border); and inside a cell, a task sorts by distance to a vantage point and compares only
fingerprints whose distances differ by at most `max_bits`, as the triangle bound allows.

A cell emits one edge per member to its smallest linked member, never all pairs. Edges are
joined into components by alternating star contraction, staged in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelspark.llm.common import spread, without
from panelspark.sources.sinks import stage

SEED = 42
CELL_LIMIT = 50_000
BAND = 8
IDLE_ROUNDS = 4
MOST_BITS = 30  # slices of two bits are the narrowest that still tell fingerprints apart


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit SimHash of a text, as an unsigned number; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(stops)
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        octets = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprint(
    docs: DataFrame, text: str = "text", shingle: int = 3, keep_text: bool = True
) -> DataFrame:
    """Adds `fingerprint` (a long holding the 64 bits), replacing a column of that name."""
    docs = without(docs, "fingerprint")
    kept = docs if keep_text else docs.drop(text)
    names = list(kept.columns)
    schema = StructType([*kept.schema.fields, StructField("fingerprint", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            prints = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in column), np.uint64, len(column)
            )
            kept_columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept_columns, pa.array(prints.view(np.int64))], [*names, "fingerprint"]
            )

    return docs.mapInArrow(run, schema)


def _masks(max_bits: int) -> list[int]:
    """Masks that keep two of max_bits + 2 slices, as signed longs."""
    if not 0 <= max_bits <= MOST_BITS:
        raise ValueError(f"max_bits must be between 0 and {MOST_BITS}")
    slices = max_bits + 2
    borders = [64 * i // slices for i in range(slices + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in zip(borders, borders[1:])]
    masks = [x | y for x, y in combinations(part, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def cells(prints: DataFrame, max_bits: int, limit: int = CELL_LIMIT) -> DataFrame:
    """(cell, fingerprint): every linked pair meets in at least one cell.

    Cells of more than `limit` members are split by distance to a vantage point, another member in
    every round, into bands that overlap by `max_bits`. That goes on until cells are small; one
    that no vantage point of IDLE_ROUNDS in a row splits is one dense ball, which a task
    searches as it is, in memory proportional to its members. Each round is staged.
    """
    keys = [f"xxhash64({i}, fingerprint & {m}L)" for i, m in enumerate(_masks(max_bits))]
    rows = prints.selectExpr(f"explode(array({', '.join(keys)})) AS cell", "fingerprint")
    band = max(BAND, 2 * max_bits)
    done, level, idle, largest = None, 0, 0, None
    while True:
        large = stage(rows.groupBy("cell").agg(
            F.count(F.lit(1)).alias("members"),
            F.max_by("fingerprint", F.xxhash64("fingerprint", F.lit(level))).alias("vantage"),
        ).where(f"members > {limit}"))
        total = large.agg(F.max("members"), F.sum("members")).first()
        idle = idle + 1 if total == largest else 0
        if total[0] is None or idle >= IDLE_ROUNDS:
            return rows if done is None else done.unionByName(rows)
        largest = total
        marked = stage(rows.join(large, "cell", "left"))
        small = marked.where("vantage IS NULL").select("cell", "fingerprint")
        done = small if done is None else done.unionByName(small)
        apart = "bit_count(fingerprint ^ vantage)"
        home = f"xxhash64(cell, {level}, {apart} DIV {band})"
        below = f"xxhash64(cell, {level}, {apart} DIV {band} - 1)"
        rows = marked.where("vantage IS NOT NULL").selectExpr(
            f"explode(CASE WHEN {apart} % {band} < {max_bits} AND {apart} >= {band}"
            f" THEN array({home}, {below}) ELSE array({home}) END) AS cell",
            "fingerprint",
        )
        level += 1


def link_cell(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """Position of the smallest member that each member of a cell reaches.

    `prints` are distinct, ascending, unsigned. Members are sorted by distance to a vantage
    point; from each newly reached member only those are compared whose distance differs by
    at most `max_bits`.
    """
    n = len(prints)
    root = np.arange(n)
    if n == 2:
        if np.bitwise_count(prints[0] ^ prints[1]) <= max_bits:
            root[1] = 0
        return root
    far = np.bitwise_count(prints ^ prints[0])
    order = np.argsort(far, kind="stable")
    far, sorted_prints = far[order].astype(np.int64), prints[order]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    bounds = np.searchsorted(far, np.arange(66 + max_bits))
    free = np.ones(n, bool)
    for start in range(n):
        if not free[place[start]]:
            continue
        free[place[start]] = False
        todo = [place[start]]
        while todo:
            at = todo.pop()
            low = bounds[max(0, far[at] - max_bits)]
            high = bounds[far[at] + max_bits + 1]
            near = low + np.flatnonzero(
                free[low:high]
                & (np.bitwise_count(sorted_prints[low:high] ^ sorted_prints[at]) <= max_bits)
            )
            free[near] = False
            root[order[near]] = start
            todo.extend(near.tolist())
    return root


def edges(rows: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): each fingerprint with the smallest one that it reaches inside a cell."""

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        """The members of one cell after the other; only the last cell read is held."""
        held, of = [], None
        for batch in batches:
            cell = batch.column(0).to_numpy()
            prints = batch.column(1).to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else cell
            stops = np.r_[starts[1:], len(cell)][: len(starts)]
            alone = stops - starts == 1  # with a neighbour on both sides: a whole cell
            alone[:1] = alone[-1:] = False
            for a, b in zip(starts[~alone].tolist(), stops[~alone].tolist()):
                if held and cell[a] != of:
                    yield np.concatenate(held)
                    held = []
                held.append(prints[a:b])
                of = cell[a]
        if held:
            yield np.concatenate(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0

        def batch_of():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([f[i] for f in found])) for i in (0, 1)], ["a", "b"]
            )

        for members in cells_of(batches):
            if len(members) < 2:
                continue
            members = np.unique(members)
            if len(members) < 2:
                continue
            root = link_cell(members, max_bits)
            moved = np.flatnonzero(root != np.arange(len(root)))
            if len(moved):
                found.append((members[moved].view(np.int64), members[root[moved]].view(np.int64)))
                size += len(moved)
            if size > 100_000:
                yield batch_of()
                found, size = [], 0
        if found:
            yield batch_of()

    together = rows.repartition(spread(rows), "cell").sortWithinPartitions("cell")
    return together.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every linked node but the roots with the smallest node of its component.

    Alternating star contraction: every round hangs each node's larger neighbours on its
    smallest neighbour, then its smaller neighbours, until nothing changes. A round is staged,
    so a lost executor costs one round at most.
    """
    now = stage(links.selectExpr(f"greatest({a}, {b}) AS u", f"least({a}, {b}) AS v")
                .where("u <> v").distinct())
    state = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if mark == state or not mark["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = mark
        both = now.union(now.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        outward = both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()
        least = outward.groupBy("u").agg(F.min("v").alias("m"))
        inward = outward.join(least, "u").selectExpr(
            "inline(array(struct(u AS u, m AS v), struct(v AS u, m AS v)))"
        ).where("u <> v").distinct()
        now = stage(inward)


def near_duplicates(prints: DataFrame, id_column: str = "doc_id", max_bits: int = 3) -> DataFrame:
    """Adds `component` (its smallest fingerprint) and `component_id`, the smallest id among all
    rows that a row reaches through links.

    `prints` has the id and `fingerprint` and is read more than once: stage it first. Rows
    without an id are linked like others; a component of such rows only has a NULL
    component_id. Equal fingerprints are always one component. Texts without words have
    fingerprint zero and are linked as any other. An empty table gives an empty table.
    """
    prints = without(prints, "component_id", "component")
    classes = stage(prints.groupBy("fingerprint").agg(F.min(id_column).alias("first_id")))
    members = components(edges(cells(classes.select("fingerprint"), max_bits), max_bits))
    rooted = classes.join(members.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = rooted.withColumn("component", F.coalesce("root", "fingerprint"))
    smallest = rooted.groupBy("component").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(smallest, "component").select("fingerprint", "component", "component_id")
    return prints.join(stage(labels), "fingerprint")


def one_per_component(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """The documents, one of each component: the row with the smallest id.

    Of rows with that id the one with the smallest fingerprint stays, then the smallest hash of
    the whole row, then any of rows that are alike. Rows without an id give way to rows with one;
    of a component without any id one row stays. Columns named `fingerprint`, `row_number` or
    `row_hash` are left out, others are kept. An empty table gives an empty table.
    """
    kept = without(docs, "fingerprint", "row_number", "row_hash")
    numbered = with_fingerprint(kept, text, shingle).withColumns({
        "row_hash": F.xxhash64(*[F.col(f"`{c}`") for c in kept.columns]),
        "row_number": F.monotonically_increasing_id(),
    })
    prepared = stage(numbered)  # fixes the row numbers
    labelled = near_duplicates(
        prepared.select(id_column, "fingerprint", "row_hash", "row_number"), id_column, max_bits
    )
    chosen = labelled.groupBy("component").agg(F.expr(
        f"min(struct(`{id_column}` IS NULL AS without, `{id_column}`, fingerprint, row_hash,"
        " row_number)).row_number AS row_number"
    ))
    return prepared.join(chosen, "row_number", "left_semi").select(
        *[F.col(f"`{c}`") for c in kept.columns]
    )
