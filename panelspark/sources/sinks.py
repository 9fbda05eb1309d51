"""Result sinks, and the written table that cuts lineage between plans."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL: dict[str, str] = {}  # scratch folder of each local session without a shared one


def _path(spark: SparkSession, path: str):
    """(file system, path) in the JVM, so any store that Spark writes to will do."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _path(spark, path)
    return system.exists(at)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    system, at = _path(spark, source)
    if not system.rename(at, _path(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def _beside(path: str, name: str) -> str:
    """A sibling that readers of the parent folder pass over."""
    parent, own = os.path.split(path.rstrip("/"))
    return os.path.join(parent, f"_{own}.{name}")


def restore(spark: SparkSession, path: str) -> None:
    """Puts the earlier table back if a job ended between the two renames of a swap."""
    previous = _beside(path, "previous")
    if not exists(spark, path) and exists(spark, previous):
        _rename(spark, previous, path)


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Moves a written table to its place. The earlier one is kept until the new one is there, and
    put back if that fails; a reader in between finds one of them or, for the moment between
    the two renames, none."""
    restore(spark, path)
    previous = _beside(path, "previous")
    had = exists(spark, path)
    if had:
        delete(spark, previous)
        _rename(spark, path, previous)
    try:
        _rename(spark, new, path)
    except Exception:
        if had:
            _rename(spark, previous, path)
        raise
    delete(spark, previous)


def _replace(df: DataFrame, path: str, write, check=None) -> None:
    spark, new = df.sparkSession, _beside(path, uuid.uuid4().hex)
    try:
        write(new)
        if check is not None:
            check(spark.read.schema(df.schema).parquet(new))
    except Exception:
        delete(spark, new)
        raise
    swap(spark, new, path)


def write_table(
    df: DataFrame, path: str, partition_by=(), files: int | None = None, check=None
) -> None:
    """Replace a parquet dataset: write it beside the old one, check it, then swap the two.

    `check` gets the written table and raises if it will not do; then, and when writing fails, the
    old table stays as it is. `files` is for small results only (one output task each).
    """
    out = df if files is None else df.coalesce(files)
    writer = out.write.partitionBy(*partition_by) if partition_by else out.write
    _replace(df, path, writer.parquet, check)


def write_bundle(tables: dict[str, DataFrame], path: str) -> None:
    """One JSON dataset per result table, written by the executors; each replaces its old one only
    when it is whole."""
    for name, df in tables.items():
        writer = df.write.option("ignoreNullFields", "false")
        _replace(df, f"{path}/{name}", writer.json)


def read_bundle(spark: SparkSession, path: str, schemas: dict) -> dict[str, DataFrame]:
    return {n: spark.read.schema(s).json(f"{path}/{n}") for n, s in schemas.items()}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its executor. It goes when the program ends.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="panelspark-")
        atexit.register(shutil.rmtree, _LOCAL[context.applicationId], ignore_errors=True)
    return _LOCAL[context.applicationId]


def delete(spark: SparkSession, path: str) -> None:
    """Removes a written table, in whatever file system it is."""
    system, at = _path(spark, path)
    system.delete(at, True)


def stage_path(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark), f"staged-{uuid.uuid4().hex}")


def stage(df: DataFrame) -> DataFrame:
    """Write once, read many: for a result that a plan uses more than once.

    The tables behind it are then scanned once instead of once per use, lost executors cost no
    recomputation, and the re-read has true sizes for join planning.
    """
    path = stage_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
