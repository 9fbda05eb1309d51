"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drops columns that a result is about to define, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def row_key(df: DataFrame, id_column: str, text: str) -> Column:
    """What tells rows apart: the id with a digest of the text. Rows alike in both are one."""
    return F.concat_ws(":", F.col(id_column).cast("string"), F.md5(F.coalesce(text, F.lit(""))))


def spread(df: DataFrame) -> int:
    """Partitions of a shuffle in this session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
