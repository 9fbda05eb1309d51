"""Merkle manifest of a dataset, kept as postorder append logs.

Rows are leaves, ordered inside their group; every FAN consecutive nodes become one, until one
is left: the group's subroot. The subroots, ordered by group, become the root the same way.

Builders are aligned: one takes the BLOCK = FAN ** BLOCK_LEVELS leaves of an aligned block and
appends every node to the block's log when it is complete, a leaf at once and a parent after its
last child. Their tops are the leaves of the next round's builders, so the tree of a group of n
rows takes log(n) / log(BLOCK) rounds and no task ever holds more than one block. A node's place
in such a log follows from the sizes of the subtrees before it alone (`positions`), so a proof is
read straight from the logs, block by block from the root down, without an index of nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.sources.sinks import stage

FAN = 16
BLOCK_LEVELS = 3
BLOCK = FAN**BLOCK_LEVELS
DIGEST = 32
PROOF = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.binary())]))
PROOF_SQL = "array<struct<place: int, siblings: binary>>"


def leaf_text(columns: dict[str, str]) -> str:
    """What a leaf digests: per column `-` for NULL, else its UTF-8 length, a colon, its text.
    `columns` maps names to the SQL expressions of their values."""
    parts = [
        f"CASE WHEN ({e}) IS NULL THEN '-' ELSE"
        f" concat(octet_length(CAST({e} AS STRING)), ':', CAST({e} AS STRING)) END"
        for e in columns.values()
    ]
    return f"concat({', '.join(parts)})"


def height(n: int) -> int:
    """Levels above n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def positions(level: int, leaves: int, levels: int) -> np.ndarray:
    """Places in the log of all nodes of a level: node j is complete with its last leaf, after all
    nodes up to its level that end there or earlier, and the higher ones that end before it."""
    j = np.arange(-(-leaves // FAN**level))
    done = np.minimum(leaves, (j + 1) * FAN**level)
    at = np.full(len(j), -1)
    for m in range(levels + 1):
        at += -(-done // FAN**m) if m <= level else j // FAN ** (m - level)
    return at


def append_log(leaves: list[bytes], levels: int) -> bytes:
    """All nodes over these leaves, in the order of their completion; the top comes last."""
    log = bytearray()
    open_runs: list[list[str]] = [[] for _ in range(levels)]
    last = len(leaves) - 1
    for i, node in enumerate(leaves):
        log += node
        for run in open_runs:
            run.append(node.hex())
            if len(run) < FAN and i < last:
                break
            node = sha256("".join(run).encode()).digest()
            run.clear()
            log += node
    return bytes(log)


def log_proofs(log: bytes, leaves: int, levels: int) -> list[list[tuple[int, bytes]]]:
    """For every level of a block's log, (place in its run, siblings) of every node there."""
    nodes = np.frombuffer(log, np.uint8).reshape(-1, DIGEST)
    found = []
    for level in range(levels):
        row = nodes[positions(level, leaves, levels)].tobytes()
        here = []
        for first in range(0, len(row), DIGEST * FAN):
            run = row[first : first + DIGEST * FAN]
            here += [(k // DIGEST, run[:k] + run[k + DIGEST :]) for k in range(0, len(run), DIGEST)]
        found.append(here)
    return found


def fold(leaf: bytes, proof) -> bytes:
    """The root that a leaf and its proof, (place, siblings as hexadecimal text) per level, lead to."""
    node = leaf.hex()
    for place, siblings in proof:
        at = 2 * DIGEST * place
        node = sha256((siblings[:at] + node + siblings[at:]).encode()).hexdigest()
    return bytes.fromhex(node)


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds `index`, the place of a row in its group, and `n`, the rows of the group.

    Rows are dealt out in ranges of (grp, sort, digest, row), so a group of any size, and equal
    rows too, are spread; only counts per range and group are summed up over a group.
    """
    order = [F.asc_nulls_first("grp"), F.asc_nulls_first("sort"), "digest", "row"]
    kept = stage(rows.withColumn("row", F.monotonically_increasing_id()))
    dealt = stage(kept.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    whole = Window.partitionBy("of_grp")
    before = whole.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(F.col("part").alias("of_part"), F.col("grp").alias("of_grp")).agg(
        F.count(F.lit(1)).alias("c")
    )
    counts = counts.select(
        "of_part", "of_grp", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"),
        F.sum("c").over(whole).alias("n"),
    )
    inside = Window.partitionBy("part", "grp").orderBy(*order[1:])
    joined = dealt.join(
        counts, (F.col("part") == F.col("of_part")) & F.col("grp").eqNullSafe(F.col("of_grp"))
    )
    index = F.col("start") + F.row_number().over(inside) - 1
    return joined.withColumn("index", index).drop("of_part", "of_grp", "start", "part", "row")


def _build(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """One row per aligned block of (grp, index, n, digest, *payload): its members and its log."""
    members = F.array_sort(F.collect_list(F.struct("index", "digest", *payload)))
    blocks = nodes.groupBy(
        "grp", F.expr(f"index DIV {BLOCK}").alias("block")
    ).agg(F.max("n").alias("n"), members.alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = []
            for n, one in zip(batch.column(2).to_pylist(), batch.column(3)):
                digests = one.values.field("digest").to_pylist()
                logs.append(append_log(digests, min(BLOCK_LEVELS, height(n))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(logs, pa.binary()),
                 pa.array([x[-DIGEST:] for x in logs], pa.binary())],
                [*batch.schema.names, "log", "top"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema)
    return stage(blocks.mapInArrow(run, f"{kinds}, log binary, top binary"))


def _climb(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """The logs of every round, leaves first."""
    rounds = [_build(nodes, payload)]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > BLOCK:
        tops = rounds[-1].where(f"n > {BLOCK}").selectExpr(
            "grp", "block AS index", f"CAST(ceil(n / {BLOCK}D) AS BIGINT) AS n", "top AS digest"
        )
        rounds.append(_build(tops, []))
    return rounds


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """(grp, top, last_round) of every tree."""
    found = None
    for r, blocks in enumerate(rounds):
        one = blocks.where(f"n <= {BLOCK}").selectExpr("grp", "top", f"{r} AS last_round")
        found = one if found is None else found.unionByName(one)
    return found


def _with_proof(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The blocks of a round with the proof of their top; both sides have one row per block."""
    of = above.select(F.col("grp").alias("of_grp"), F.col("block").alias("of_block"), "proof", "subroot")
    return blocks.join(
        of, F.col("grp").eqNullSafe(F.col("of_grp")) & (F.col("block") == F.col("of_block"))
    ).drop("of_grp", "of_block")


def _expand(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(grp, block, proof, subroot) of the blocks one round below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                leaves, levels = r["leaves"], min(BLOCK_LEVELS, height(r["n"]))
                levels_of = log_proofs(r["log"], leaves, levels)
                upper = [(p["place"], p["siblings"]) for p in r["proof"]]
                proofs = [
                    [dict(zip(("place", "siblings"), step)) for step in
                     [*(levels_of[m][i // FAN**m] for m in range(levels)), *upper]]
                    for i in range(leaves)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["grp"]] * leaves, batch.schema.field("grp").type),
                     pa.array(range(r["block"] * BLOCK, r["block"] * BLOCK + leaves), pa.int64()),
                     pa.array(proofs, PROOF), pa.array([r["subroot"]] * leaves, pa.binary())],
                    ["grp", "block", "proof", "subroot"],
                )

    given = _with_proof(blocks, above).selectExpr(
        "grp", "block", "n", "size(members) AS leaves", "log", "proof", "subroot"
    )
    kind = blocks.schema["grp"].dataType.simpleString()
    return given.mapInArrow(
        run, f"grp {kind}, block long, proof {PROOF_SQL}, subroot binary"
    )


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Proofs of the blocks of the first round. `above` has (grp, last_round, proof, subroot)."""
    proofs = None
    for r in reversed(range(len(rounds))):
        here = above.where(f"last_round = {r}").selectExpr("grp", "0L AS block", "proof", "subroot")
        if proofs is not None:
            here = here.unionByName(_expand(rounds[r + 1], proofs))
        proofs = here
    return proofs


def audit(
    df: DataFrame, columns: list[str], group: str, order: str, claims: dict | None = None
) -> DataFrame:
    """The manifest's proof of every row, and what it says of a copy of the rows.

    `columns` are digested, in this order; leaves ascend by `order` inside each value of `group`
    (NULL first in both; rows equal in both ascend by digest). `claims` maps columns to the SQL
    expression of their value in the copy to verify; without it the rows verify themselves.

    Returns `order`'s column, leaf, subroot, root, proof (siblings as raw digests, left to right,
    with the node's place among them, per level from the leaf up; no level for a lone leaf, and
    no siblings in a run of one), folded_root (from the copy's leaf and the proof) and verified.
    Every row is a leaf, repeated ones too. NULLs and empty or very long texts are values like
    others, other columns are ignored whatever their names, an empty table has no rows.
    """
    own = {c: f"`{c}`" for c in columns}
    copy = leaf_text({**own, **(claims or {})})
    leaf = "unhex(sha2({}, 256))"
    rows = df.selectExpr(
        f"CAST(`{group}` AS STRING) AS grp", f"`{order}` AS sort",
        f"{leaf.format(leaf_text(own))} AS digest",
        f"CASE WHEN {' OR '.join(f'NOT (({e}) <=> {own[c]})' for c, e in claims.items())}"
        f" THEN {leaf.format(copy)} END AS claimed" if claims else
        "CAST(NULL AS BINARY) AS claimed",
    )
    rounds = _climb(_numbered(rows), ["sort", "claimed"])
    groups = stage(_tops(rounds))
    trees = groups.selectExpr("0 AS grp", "grp AS sort", "top AS digest", "last_round")
    group_rounds = _climb(_numbered(trees), ["sort", "last_round"])
    found = _tops(group_rounds).first()
    root = found["top"] if found is not None else b""
    last = len(group_rounds) - 1
    start = df.sparkSession.createDataFrame([(0, last, [], b"")], f"grp int, last_round int,"
                                            f" proof {PROOF_SQL}, subroot binary")
    above = _leaf_proofs(group_rounds[0], _descend(group_rounds, start), root, keep="last_round")
    above = stage(above.selectExpr(
        "sort AS grp", "last_round", "proof", "leaf AS subroot"
    ))
    proved = _leaf_proofs(rounds[0], _descend(rounds, above), root, keep="claimed")
    hexed = {c: f"lower(hex({c})) AS {c}" for c in ("leaf", "subroot", "folded_root")}
    return proved.selectExpr(
        f"sort AS `{order}`", hexed["leaf"], hexed["subroot"], f"'{root.hex()}' AS root", "proof",
        hexed["folded_root"], f"folded_root = unhex('{root.hex()}') AS verified",
    )


def _leaf_proofs(blocks: DataFrame, above: DataFrame, root: bytes, keep: str) -> DataFrame:
    """(sort, leaf, subroot, proof, folded_root and `keep`) of every leaf of the first round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            column = {c: batch.column(names.index(c)) for c in names}
            for b in range(batch.num_rows):
                members = column["members"][b].values
                leaves, n = len(members), column["n"][b].as_py()
                levels = min(BLOCK_LEVELS, height(n))
                found = log_proofs(column["log"][b].as_py(), leaves, levels)
                upper = [(p["place"], p["siblings"]) for p in column["proof"][b].as_py()]
                steps = [*found, *[[s] for s in upper]]
                shown = [[(place, s.hex()) for place, s in level] for level in steps]
                span = [FAN**m if m < levels else BLOCK for m in range(len(steps))]
                digests = members.field("digest").to_pylist()
                claimed = members.field(keep).to_pylist() if keep == "claimed" else digests
                folded = [
                    fold(c or d, [s[i // w] for s, w in zip(shown, span)])
                    for i, (c, d) in enumerate(zip(claimed, digests))
                ]
                places = [s[i // w][0] for i in range(leaves) for s, w in zip(steps, span)]
                siblings = [s[i // w][1] for i in range(leaves) for s, w in zip(steps, span)]
                proof = pa.ListArray.from_arrays(
                    pa.array(np.arange(leaves + 1) * len(steps), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(places, pa.int32()), pa.array(siblings, pa.binary())],
                        ["place", "siblings"],
                    ),
                )
                yield pa.RecordBatch.from_arrays(
                    [members.field("sort"), members.field("digest"),
                     pa.array([column["subroot"][b].as_py()] * leaves, pa.binary()), proof,
                     pa.array(folded, pa.binary()), members.field(keep)],
                    ["sort", "leaf", "subroot", "proof", "folded_root", keep],
                )

    given = _with_proof(blocks, above).select("n", "members", "log", "proof", "subroot")
    member = {f.name: f.dataType.simpleString() for f in blocks.schema["members"].dataType.elementType}
    return given.mapInArrow(
        run, f"sort {member['sort']}, leaf binary, subroot binary, proof {PROOF_SQL},"
        f" folded_root binary, {keep} {member[keep]}"
    )
