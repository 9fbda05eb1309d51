"""Order over a whole frame without a one-task window.

Rows are dealt out by ranges of their order, as many as the session's shuffle partitions, and only
ever ordered inside a range; what ranges owe each other follows from one row of totals per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.columns import aggregate, known
from panelspark.sources.sinks import stage

SALT = "_range_salt"
BUCKET = "bucket"


def in_ranges(df: DataFrame, order: list, ranges: int | None = None) -> DataFrame:
    """The rows with `bucket`, the number of their range in the order of `order`. Staged, so that
    every retry sees the same ranges."""
    count = [] if ranges is None else [ranges]
    dealt = df.repartitionByRange(*count, *order)
    return stage(dealt.withColumn(BUCKET, F.spark_partition_id()))


def _edges(totals) -> dict[str, list]:
    """Per range: rows before it, and for its lowest and highest value the rows below that value
    and its copies, wherever they are. Only these values can lie in more than one range."""
    known_totals = {r[BUCKET]: r for r in totals if r["n"]}
    copies, below = {}, {}
    before = 0
    rows = []
    for b in range(max((r[BUCKET] for r in totals), default=-1) + 1):
        r = known_totals.get(b)
        rows.append((before, r))
        if r is None:
            continue
        found = {r["lo"]: (r["lo_n"], before)}
        found.setdefault(r["hi"], (r["hi_n"], before + r["n"] - r["hi_n"]))
        for value, (n, under) in found.items():
            copies[value] = copies.get(value, 0) + n
            below.setdefault(value, under)
        before += r["n"]
    out = {name: [] for name in ("before", "lo", "lo_below", "lo_n", "hi", "hi_below", "hi_n")}
    for start, r in rows:
        lo, hi = (r["lo"], r["hi"]) if r else (None, None)
        for name, value in zip(out, (start, lo, below.get(lo, 0), copies.get(lo, 0), hi,
                                     below.get(hi, 0), copies.get(hi, 0))):
            out[name].append(value)
    return out


def ranked(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """Adds `rank` (1 = highest, ties share the lowest) and `percentile` (ascending average
    rank over the non-null count, 0-100). NULL where the value is NULL.

    Ranges are of (value, salt): the copies of a value, or NULLs, that fill many ranges are dealt
    out evenly like any other rows. Ranks come from a window inside the range; for the values at
    a range's ends, which may go on in others, from the totals of the ranges, one row each.
    """
    number = f"CAST({column} AS DOUBLE)"
    salted = df.withColumn(SALT, F.monotonically_increasing_id())
    dealt = in_ranges(salted, [F.asc_nulls_last(column), F.asc(SALT)], ranges)
    counts = aggregate(
        dealt.selectExpr(BUCKET, f"{number} AS v"), [BUCKET, "v"], {"n": "count(v)"}
    )
    totals = aggregate(counts, [BUCKET], {
        "n": "sum(n)", "lo": "min(v)", "lo_n": "min_by(n, v)", "hi": "max(v)",
        "hi_n": "max_by(n, v)",
    }).collect()  # one row per range; a range of NULLs alone has n = 0
    total = sum(r["n"] for r in totals)
    edges = _edges(totals)

    def of_range(name: str, kind: str) -> str:
        values = ", ".join("NULL" if v is None else f"{kind}('{v!r}')" for v in edges[name])
        return f"element_at(CAST(array({values}) AS ARRAY<{kind}>), {BUCKET} + 1)"

    def at_an_end(inside: str, what: str) -> str:
        return (
            f"CASE WHEN {number} = {of_range('lo', 'DOUBLE')} THEN {of_range('lo_' + what, 'BIGINT')}"
            f" WHEN {number} = {of_range('hi', 'DOUBLE')} THEN {of_range('hi_' + what, 'BIGINT')}"
            f" ELSE {inside} END"
        )

    window = f"PARTITION BY {BUCKET} ORDER BY {column} NULLS LAST"
    # A task for each range: by hash, some tasks would get several and others none.
    spread = dealt.repartitionById(max(len(edges["before"]), 1), F.col(BUCKET))
    placed = spread.selectExpr(
        "*",
        f"rank() OVER ({window}) - 1 AS _below",
        f"count(1) OVER ({window} RANGE BETWEEN CURRENT ROW AND CURRENT ROW) AS _copies",
    ).selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"{at_an_end(of_range('before', 'BIGINT') + ' + _below', 'below')} AS _below",
        f"{at_an_end('_copies', 'n')} AS _copies",
    )
    return placed.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"CASE WHEN {column} IS NOT NULL THEN"
        f" (_below + (_copies + 1) / 2D) / {max(total, 1)}D * 100D END AS percentile",
        f"CASE WHEN {column} IS NOT NULL THEN {total} - _below - _copies + 1 END AS rank",
    )


MOMENTS = ["n", "mean", "m2", "m3", "m4", "steps"]


def merge_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Count, mean and centred power sums of second to fourth order of two sets together, and
    their sums of squared steps. Merged centred, so no order cancels another."""
    n, d = a[0] + b[0], b[1] - a[1]
    if not a[0] or not b[0]:
        return np.array(a if a[0] else b)
    p, q = a[0], b[0]
    return np.array([
        n,
        a[1] + d * q / n,
        a[2] + b[2] + d * d * p * q / n,
        a[3] + b[3] + d**3 * p * q * (p - q) / n**2 + 3 * d * (p * b[2] - q * a[2]) / n,
        a[4] + b[4] + d**4 * p * q * (p * p - p * q + q * q) / n**3
        + 6 * d * d * (p * p * b[2] + q * q * a[2]) / n**2 + 4 * d * (p * b[3] - q * a[3]) / n,
        a[5] + b[5],
    ])


def _moments(values: np.ndarray) -> np.ndarray:
    mean = values.mean()
    c = values - mean
    return np.array([len(values), mean, *[(c**k).sum() for k in (2, 3, 4)],
                     (np.diff(values) ** 2).sum()])


def ordered_moments(
    df: DataFrame, order: list[str], value: str, ranges: int | None = None
) -> DataFrame:
    """One row (n, mean, m2, m3, m4, steps) over the non-null values: centred power sums, and the sum
    of squared differences between neighbours in the order of `order`. NULL but for n = 0
    where there is no value.

    Lazy, one pass: each range reduces its ordered rows to one row with its first and last value,
    and these rows, one per range, are merged in order. All order columns set the ranges, so an id
    with many rows is many ranges.
    """
    count = [] if ranges is None else [ranges]
    kept = known(df.selectExpr(*order, f"CAST({value} AS DOUBLE) AS v"), "v")
    dealt = kept.repartitionByRange(*count, *order).sortWithinPartitions(*order).select("v")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, head, tail = np.zeros(len(MOMENTS)), None, None
        for batch in batches:
            values = batch.column(0).to_numpy()
            if not len(values):
                continue
            if head is None:
                head = values[0]
            else:
                total[-1] += (values[0] - tail) ** 2
            total, tail = merge_moments(total, _moments(values)), values[-1]
        if head is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()),
                 *[pa.array([float(x)]) for x in (*total, head, tail)]],
                [BUCKET, *MOMENTS, "head", "tail"],
            )

    fields = ", ".join(f"{m} double" for m in [*MOMENTS, "head", "tail"])
    by_range = dealt.mapInArrow(reduce, f"{BUCKET} int, {fields}")
    whole = by_range.agg(
        F.array_sort(F.collect_list(F.struct(BUCKET, *MOMENTS, "head", "tail"))).alias("ranges")
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ranges_ in batch.column(0).to_pylist():
                total, tail = np.zeros(len(MOMENTS)), None
                for r in ranges_:
                    if tail is not None:
                        total[-1] += (r["head"] - tail) ** 2
                    total, tail = merge_moments(total, np.array([r[m] for m in MOMENTS])), r["tail"]
                shown = [float(x) if tail is not None or m == "n" else None
                         for m, x in zip(MOMENTS, total)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.float64()) for x in shown], MOMENTS
                )

    return whole.mapInArrow(merge, ", ".join(f"{m} double" for m in MOMENTS))
