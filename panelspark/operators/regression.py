"""Least squares from triangular factors, with its diagnostics.

Each task reduces its rows (1, X, y) to a triangular factor per group; factors are merged along a
tree, first those of many tasks together, then these. The matrix is never squared, so drivers that
are nearly collinear keep their digits, and what the factor leaves of a driver after the others
are taken out tells whether it is independent at all. Solving a factor of k + 2 rows per group is
all that is left, and it happens in a task for many groups at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from panelspark.config import COST_DRIVERS
from panelspark.functions.columns import (
    add_columns,
    known,
    named,
    number,
    require_columns,
    row,
)
from panelspark.functions.distributions import f_pvalue
from panelspark.functions.tails import t_critical, t_two_sided
from panelspark.operators.ordering import ordered_moments

OUTCOME = "om_total"
CONSTANT = "const"

MERGE_TASKS = 64  # first-level merges of a group's factors
HELD_VALUES = 4 << 20  # numbers that a task holds for its groups before it sends them on

# A driver is taken for a combination of others if less than this part of it is its own: RANK of its
# spread, or what rounding of values so far from zero can make up.
RANK = 1e-12
ROUNDING = 64 * np.finfo(float).eps


def triangles(stacks: list[np.ndarray], width: int) -> np.ndarray:
    """Triangular factors of many matrices at once, width x width each (rows of zeros below)."""
    out = np.zeros((len(stacks), width, width))
    sizes = np.array([len(s) for s in stacks], dtype=int)
    # Matrices of up to a power of two of rows are padded to it and factored together.
    for size in np.unique(np.maximum(width, 2 ** np.ceil(np.log2(np.maximum(sizes, 1)))).astype(int)):
        some = np.flatnonzero(
            np.maximum(width, 2 ** np.ceil(np.log2(np.maximum(sizes, 1)))).astype(int) == size
        )
        step = max(1, HELD_VALUES // (size * width))
        for first in range(0, len(some), step):
            chosen = some[first : first + step]
            padded = np.zeros((len(chosen), size, width))
            for i, at in enumerate(chosen.tolist()):
                padded[i, : sizes[at]] = stacks[at]
            out[chosen] = np.linalg.qr(padded, mode="r")
    return out


class _Held:
    """The rows of a task's groups, reduced to factors when they are many."""

    def __init__(self, width: int):
        self.width, self.held, self.values = width, {}, 0

    def add(self, key, rows: np.ndarray, n: int) -> None:
        entry = self.held.setdefault(key, [0, []])
        entry[0] += n
        entry[1].append(rows)
        self.values += rows.size

    def reduce(self) -> None:
        keys = list(self.held)
        stacks = [np.concatenate(self.held[k][1]) for k in keys]
        large = [i for i, s in enumerate(stacks) if len(s) > self.width]
        for i, r in zip(large, triangles([stacks[i] for i in large], self.width)):
            stacks[i] = r
        self.held = {k: [self.held[k][0], [s]] for k, s in zip(keys, stacks)}
        self.values = sum(s.size for s in stacks)

    def full(self) -> bool:
        """Whether there are too many groups for this task to go on holding them."""
        if self.values > HELD_VALUES:
            self.reduce()
        return self.values > HELD_VALUES // 2

    def batches(self, kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
        self.reduce()
        keys = list(self.held)
        salt = TaskContext.get().partitionId() % MERGE_TASKS
        for first in range(0, len(keys), 10_000):
            some = keys[first : first + 10_000]
            entries = [self.held[k] for k in some]
            groups = [pa.array([k[i] for k in some], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*groups, pa.array([salt] * len(some), pa.int32()),
                 pa.array([e[0] for e in entries], pa.int64()),
                 pa.array([e[1][0].ravel() for e in entries], pa.list_(pa.float64()))],
                names,
            )
        self.held, self.values = {}, 0


def factors(df: DataFrame, columns, group_by=()) -> DataFrame:
    """(group..., n, factor): the triangular factor of the rows (1, *columns) that have all these
    values, as an array row by row, and how many rows there are. Without groups there is one row.

    A group's rows become at most a factor per task before they move; a hot group's factors are
    merged by MERGE_TASKS tasks first.
    """
    columns, group_by = list(columns), list(group_by)
    require_columns(df, [*group_by, *columns])
    width = len(columns) + 1
    rows = known(df, *columns).selectExpr(
        *[f"`{g}`" for g in group_by], *[f"CAST(`{c}` AS DOUBLE) AS _{i}" for i, c in enumerate(columns)]
    )
    fields = rows.schema.fields[: len(group_by)]
    kinds = [to_arrow_type(f.dataType) for f in fields]
    keys = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    schema = ", ".join([*keys, "salt int, n long, f array<double>"])
    names = [*group_by, "salt", "n", "f"]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(width)
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = np.column_stack([np.ones(batch.num_rows), *[
                batch.column(len(group_by) + i).to_numpy() for i in range(len(columns))
            ]])
            for key, some in _split(batch, len(group_by)):
                part = matrix if some is None else matrix[some]
                held.add(key, part, len(part))
            if held.full():
                yield from held.batches(kinds, names)
        yield from held.batches(kinds, names)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index("f")
            stacks = [
                np.asarray(v.values.to_numpy(zero_copy_only=False)).reshape(-1, width)
                if v.is_valid and len(v.values) else np.zeros((0, width)) for v in batch.column(at)
            ]
            found = triangles(stacks, width).reshape(len(stacks), -1)
            offsets = np.arange(len(stacks) + 1, dtype=np.int32) * width * width
            yield batch.set_column(at, "f", pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(found.ravel())))

    def gathered(level: DataFrame, by: list[str]) -> DataFrame:
        summed = level.groupBy(*[F.col(f"`{g}`") for g in by]).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.flatten(F.collect_list("f")).alias("f")
        )
        shape = ", ".join([*keys, *(["salt int"] if "salt" in by else []), "n long, f array<double>"])
        return summed.mapInArrow(merged, shape)

    parts = gathered(rows.mapInArrow(first, schema), [*group_by, "salt"])
    return gathered(parts, group_by).withColumnRenamed("f", "factor")


def _split(batch: pa.RecordBatch, keys: int) -> Iterator[tuple]:
    """(key, row numbers) of the groups of a batch; all rows under () without keys."""
    if not keys:
        yield (), None
        return
    codes = np.zeros(batch.num_rows, dtype=np.int64)
    for i in range(keys):
        column = batch.column(i).dictionary_encode(null_encoding="encode")
        codes = codes * (len(column.dictionary) + 1) + column.indices.to_numpy()
        codes = np.unique(codes, return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(codes[order]) > 0])
    heads = [batch.column(i).take(pa.array(order[starts])).to_pylist() for i in range(keys)]
    for key, some in zip(zip(*heads), np.split(order, starts[1:])):
        yield key, some


def _pivots(columns: np.ndarray) -> np.ndarray:
    """What is left of unit columns when, the largest remainder first, each is taken out of the
    others; (groups, k), in that order. Taking out twice keeps the remainders orthogonal."""
    left = columns.copy()
    groups, _, k = left.shape
    out = np.empty((groups, k))
    every = np.arange(groups)
    taken = np.zeros((groups, k), bool)
    for step in range(k):
        norms = np.where(taken, -1.0, np.sqrt((left**2).sum(axis=1)))
        best = norms.argmax(axis=1)
        out[:, step] = norms[every, best]
        taken[every, best] = True
        unit = left[every, :, best] / np.where(out[:, step] > 0, out[:, step], 1.0)[:, None]
        for _ in range(2):
            left -= unit[:, :, None] * np.einsum("gi,gik->gk", unit, left)[:, None, :]
    return out


def _design(factor: np.ndarray, k: int) -> dict:
    """Of factors with columns (1, x1..xk, ...): the inverse of the centred drivers' factor, their
    spread, and whether they are independent."""
    with np.errstate(all="ignore"):
        x = factor[:, 1 : k + 1, 1 : k + 1]
        spread = np.sqrt((x**2).sum(axis=1))
        size = np.sqrt((factor[:, : k + 1, 1 : k + 1] ** 2).sum(axis=1))
        unit = x / spread[:, None, :]
        usable = np.isfinite(unit).all(axis=(1, 2)) & (spread > ROUNDING * size).all(axis=1)
        unit = np.where(usable[:, None, None], unit, np.eye(k))
        least = RANK + ROUNDING * np.where(usable[:, None], size / spread, 0.0).max(axis=1, initial=0.0)
        if k:
            usable &= _pivots(unit)[:, -1] > least
        unit = np.where(usable[:, None, None], unit, np.eye(k))
        inverse = np.linalg.inv(unit) / spread[:, :, None]
    return {"inverse": inverse, "spread": spread, "independent": usable}


def _solve(n: np.ndarray, factor: np.ndarray) -> dict:
    """Fits of many groups at once, one per first index: coefficients (constant first), their
    standard errors and fit statistics. Collinear drivers give `solved` False."""
    n = np.asarray(n, dtype=float)
    k = factor.shape[1] - 2
    design = _design(factor, k)
    inverse = design["inverse"]
    with np.errstate(all="ignore"):
        slopes = np.einsum("gij,gj->gi", inverse, factor[:, 1 : k + 1, k + 1])
        mean_x = factor[:, 0, 1 : k + 1] / factor[:, :1, 0]
        mean_y = factor[:, 0, k + 1] / factor[:, 0, 0]
        ss_resid = factor[:, k + 1, k + 1] ** 2
        ss_total = (factor[:, 1:, k + 1] ** 2).sum(axis=1)
        dof = n - k - 1
        sigma2 = np.where(dof > 0, ss_resid / dof, np.nan)
        slope_se = np.sqrt(sigma2[:, None] * (inverse**2).sum(axis=2))
        leverage = (np.einsum("gi,gij->gj", mean_x, inverse) ** 2).sum(axis=1)
        const_se = np.sqrt(sigma2 * (1.0 / n + leverage))
        r2 = 1.0 - ss_resid / ss_total
        coef = np.c_[mean_y - (slopes * mean_x).sum(axis=1), slopes]
        adjusted = np.where(dof > 0, 1.0 - (1.0 - r2) * (n - 1) / dof, np.nan)
    return {
        "coef": coef,
        "std_err": np.c_[const_se, slope_se],
        "dof": dof,
        "ss_total": ss_total,
        "r_squared": r2,
        "adj_r_squared": adjusted,
        "solved": design["independent"] & np.isfinite(coef).all(axis=1),
    }


def _matrices(column: pd.Series, width: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, width, width))
    return np.stack([np.asarray(v, dtype=float) for v in column]).reshape(-1, width, width)


_FIT_SCHEMA = (
    "term string, coef double, std_err double, t_value double, p_value double, "
    "ci_low double, ci_high double, n_obs long, r_squared double, adj_r_squared double, "
    "status string"
)


def fit_terms(df: DataFrame, y: str = OUTCOME, xs=COST_DRIVERS, group_by=()) -> DataFrame:
    """One row per term. A group with too few rows, or collinear drivers, says so in `status`."""
    xs, group_by = list(xs), list(group_by)
    least = len(xs) + 1
    grouped = factors(df, [*xs, y], group_by)

    def solve(batches):
        for batch in batches:
            if len(batch):
                yield _fit_frame(batch, xs, least, group_by)

    key_fields = [f"{f.name} {f.dataType.simpleString()}" for f in grouped.schema[: len(group_by)]]
    return grouped.mapInPandas(solve, ", ".join([*key_fields, _FIT_SCHEMA]))


def _fit_frame(groups: pd.DataFrame, xs: list[str], least: int, group_by: list[str]) -> pd.DataFrame:
    """Terms of all groups of a batch; one row without a term for a group that can't be fitted."""
    enough = (groups["n"] >= least).to_numpy()
    some = groups[enough]
    fit = _solve(some["n"].to_numpy(), _matrices(some["factor"], len(xs) + 2))
    solved = fit["solved"]
    fitted = some[solved]
    terms = len(xs) + 1
    coef, error = fit["coef"][solved].reshape(-1), fit["std_err"][solved].reshape(-1)
    dof = np.repeat(fit["dof"][solved], terms)
    distinct, place = np.unique(dof, return_inverse=True)
    critical = np.where(distinct > 0, t_critical(np.maximum(distinct, 1.0)), np.nan)
    with np.errstate(all="ignore"):
        t = coef / error
        margin = error * critical[place]
    frame = pd.DataFrame({
        **{g: fitted[g].repeat(terms).to_numpy() for g in group_by},
        "term": [CONSTANT, *xs] * len(fitted),
        "coef": coef,
        "std_err": error,
        "t_value": t,
        "p_value": t_two_sided(t, dof),
        "ci_low": coef - margin,
        "ci_high": coef + margin,
        "n_obs": fitted["n"].repeat(terms).to_numpy(),
        "r_squared": np.repeat(fit["r_squared"][solved], terms),
        "adj_r_squared": np.repeat(fit["adj_r_squared"][solved], terms),
        "status": "ok",
    })
    failed = [(groups[~enough], "insufficient data"), (some[~solved], "collinear drivers")]
    frames = [frame, *[
        pd.DataFrame({**{g: f[g].to_numpy() for g in group_by}, "n_obs": f["n"].to_numpy(),
                      "status": status}).reindex(columns=frame.columns)
        for f, status in failed if len(f)
    ]]
    whole = pd.concat([f for f in frames if len(f)], ignore_index=True)
    return whole.astype(object).where(whole.notna(), None)


def vif(df: DataFrame, xs=COST_DRIVERS, group_by=()) -> DataFrame:
    """Variance inflation factor of any number of drivers, also per group; only the drivers have to
    be non-null. NULL where drivers are collinear or rows too few to tell.

    With the drivers' centred factor R a factor is the squared length of a row of R's inverse times
    the driver's own sum of squares.
    """
    xs, group_by = list(xs), list(group_by)
    grouped = factors(df, xs, group_by)

    def inflate(batches):
        for batch in batches:
            if len(batch):
                factor = _matrices(batch["factor"], len(xs) + 1)
                design = _design(factor, len(xs))
                value = design["spread"] ** 2 * (design["inverse"] ** 2).sum(axis=2)
                value[~design["independent"] | (batch["n"] <= len(xs)).to_numpy()] = np.nan
                out = pd.DataFrame({
                    **{g: batch[g].repeat(len(xs)).to_numpy() for g in group_by},
                    "variable": xs * len(batch),
                    "vif": value.reshape(-1),
                })
                yield out.astype(object).where(out.notna(), None)

    key_fields = [f"{f.name} {f.dataType.simpleString()}" for f in grouped.schema[: len(group_by)]]
    return grouped.mapInPandas(inflate, ", ".join([*key_fields, "variable string, vif double"]))


def _single_fit(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """One row (fit): the coefficients of the whole frame, or why there are none."""
    k = len(xs)

    def solve(batches):
        for batch in batches:
            for n, factor in zip(batch["n"], batch["factor"]):
                status, coef, total = "ok", None, None
                if n < k + 1:
                    status = f"insufficient data: {n} rows"
                else:
                    fit = _solve([n], np.asarray(factor, float).reshape(1, k + 2, k + 2))
                    if fit["solved"][0]:
                        coef, total = fit["coef"][0].tolist(), float(fit["ss_total"][0])
                    else:
                        status = "collinear drivers"
                yield pd.DataFrame({"status": [status], "coef": [coef], "ss_total": [total]})

    fitted = factors(df, [*xs, y]).mapInPandas(
        solve, "status string, coef array<double>, ss_total double"
    )
    return fitted.select(F.struct("*").alias("fit"))


def diagnostics(
    df: DataFrame, order: list[str], y: str = OUTCOME, xs=COST_DRIVERS
) -> DataFrame:
    """(stat, value) rows of the usual regression summary. Lazy; reads `df` for the coefficients and
    again for the residuals, so a frame that costs much is better staged.

    Statistics that a small sample leaves undefined are NULL; without a fit there is one row, with
    the reason as its stat and no value. `order` is the row order the Durbin-Watson statistic is
    defined on.
    """
    xs = list(xs)
    k = len(xs)
    require_columns(df, [*order, y, *xs])
    fit = _single_fit(df, y, xs)
    fitted = " + ".join(["fit.coef[0]", *[f"fit.coef[{i}] * {x}" for i, x in enumerate(xs, 1)]])
    residuals = known(df, y, *xs).select(*order, y, *xs).withColumn("fit", fit.scalar())
    moments = ordered_moments(residuals.selectExpr(*order, f"{y} - ({fitted}) AS e"), order, "e")
    stats = moments.withColumn("fit", fit.scalar()).selectExpr("fit", *named({
        "n": "n",
        "ssr": "m2 + n * mean * mean",
        "skew": "(m3 / n) / pow(m2 / n, 1.5D)",
        "kurtosis": "n * m4 / (m2 * m2)",
        "steps": "steps",
    }))
    total = "fit.ss_total"
    stats = add_columns(stats, {
        "df_model": number(k),
        "df_residual": f"n - {k + 1}",
        "r_squared": f"1 - try_divide(ssr, {total})",
        "log_likelihood": f"-n / 2 * (ln(2 * {number(np.pi)}) + ln(ssr / n) + 1)",
        "durbin_watson": "try_divide(steps, ssr)",
        "jarque_bera": "n / 6 * (skew * skew + (kurtosis - 3) * (kurtosis - 3) / 4)",
        "skew_score": f"CASE WHEN n >= 8 THEN {_SKEW_SCORE} END",
        "kurtosis_score": f"CASE WHEN n >= 8 THEN {_KURTOSIS_SCORE} END",
    })
    stats = add_columns(stats, {
        "n_obs": "n",
        "adj_r_squared": "1 - try_divide((1 - r_squared) * (n - 1), df_residual)",
        "f_statistic": f"try_divide(({total} - ssr) / df_model, try_divide(ssr, df_residual))",
        "aic": f"-2 * log_likelihood + {2 * (k + 1)}",
        "bic": f"-2 * log_likelihood + ln(n) * {k + 1}",
        "prob_jarque_bera": "exp(-jarque_bera / 2)",
        "omnibus": "skew_score * skew_score + kurtosis_score * kurtosis_score",
    })
    stats = add_columns(stats, {"prob_omnibus": "exp(-omnibus / 2)"}).withColumn(
        "prob_f", f_pvalue(F.col("f_statistic"), F.col("df_model"), F.col("df_residual"))
    )
    hidden = ("fit", "n", "ssr", "steps", "skew_score", "kurtosis_score")
    rows = [row(stat=f"'{c}'", value=f"CAST({c} AS DOUBLE)") for c in stats.columns if c not in hidden]
    reason = row(stat="fit.status", value="CAST(NULL AS DOUBLE)")
    return stats.selectExpr(
        f"inline(CASE WHEN fit.status = 'ok' THEN array({', '.join(rows)}) ELSE array({reason}) END)"
    )


# Normal score of the sample skewness (D'Agostino) over columns n and skew. Undefined below 8 rows.
_SKEW_Y = "(skew * sqrt((n + 1) * (n + 3) / (6 * (n - 2))))"
_SKEW_BETA = (
    "(3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)))"
)
_SKEW_W2 = f"(sqrt(2 * ({_SKEW_BETA} - 1)) - 1)"
_SKEW_SCORE = f"asinh({_SKEW_Y} / sqrt(2 / ({_SKEW_W2} - 1))) / sqrt(0.5D * ln({_SKEW_W2}))"

# Normal score of the sample kurtosis (Anscombe and Glynn) over columns n and kurtosis.
_KURT_X = (
    "((kurtosis - 3 * (n - 1) / (n + 1))"
    " / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))))"
)
_KURT_BETA = (
    "(6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))"
    " * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))))"
)
_KURT_A = f"(6 + 8 / {_KURT_BETA} * (2 / {_KURT_BETA} + sqrt(1 + 4 / ({_KURT_BETA} * {_KURT_BETA}))))"
_KURT_D = f"(1 + {_KURT_X} * sqrt(2 / ({_KURT_A} - 4)))"
_KURTOSIS_SCORE = (
    f"(1 - 2 / (9 * {_KURT_A}) - sign({_KURT_D}) * cbrt((1 - 2 / {_KURT_A}) / abs({_KURT_D})))"
    f" / sqrt(2 / (9 * {_KURT_A}))"
)


def condition_number(df: DataFrame, xs=COST_DRIVERS) -> DataFrame:
    """Condition number of the design matrix with its constant, from its triangular factor: squaring
    the matrix would lose the small singular values. NULL with fewer rows than columns."""
    xs = list(xs)
    width = len(xs) + 1

    def condition(batches):
        for batch in batches:
            for n, factor in zip(batch["n"], batch["factor"]):
                value = None
                if n >= width:
                    matrix = np.asarray(factor, float).reshape(width, width)
                    singular = np.linalg.svd(matrix, compute_uv=False)
                    value = float(singular[0] / singular[-1]) if singular[-1] else None
                yield pd.DataFrame({"stat": ["condition_number"], "value": [value]})

    return factors(df, xs).mapInPandas(condition, "stat string, value double")


def significant_terms(terms: DataFrame, level: float = 0.05) -> DataFrame:
    return terms.where(f"p_value < {level} AND term <> '{CONSTANT}'")


def high_vif(factors: DataFrame, limit: float = 10.0) -> DataFrame:
    return factors.where(f"vif > {limit}")
