"""The folder that all executors share, and tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[tempfile.TemporaryDirectory] = []


def fresh_folder(spark: SparkSession, what: str) -> str:
    """A new path under spark.checkpoint.dir. Where that is unset, under a temporary folder of this process, but only if all tasks run in it (master local)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append(tempfile.TemporaryDirectory(prefix="panelyard-"))
        base = f"file://{_own[0].name}"
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def kept(df: DataFrame, what: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and a retried task can't change what is in it."""
    path = fresh_folder(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def drop_kept(*tables: DataFrame | None) -> None:
    """Deletes tables made by `kept` that nothing will read again; others are left alone."""
    for df in tables:
        path = getattr(df, "kept_at", None)
        if path:
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
