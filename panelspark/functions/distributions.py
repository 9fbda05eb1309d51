"""Tail probabilities Spark has no built-in for, as Arrow-batched column functions.

They only ever see grouped rows: one per entity, or one per fit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.tails import f_upper, t_two_sided


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of a t statistic; NULL where t or df is NULL or df < 1."""
    p = t_two_sided(t.to_numpy(dtype=float), df.to_numpy(dtype=float))
    return pd.Series(p).astype("Float64").mask(np.isnan(p))


@F.pandas_udf(T.DoubleType())
def f_pvalue(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    """Upper-tail p-value of an F statistic."""
    return pd.Series(f_upper(f.to_numpy(), df1.to_numpy(), df2.to_numpy()))
