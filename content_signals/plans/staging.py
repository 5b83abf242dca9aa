"""Tables written once and read several times within a job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

_LOCAL_ROOTS: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Where it is unset, a fresh temporary folder serves a local session; on a
    cluster that would not be visible to all executors, hence an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="content-signals-")
    return _LOCAL_ROOTS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the staging root."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a DataFrame to the staging folder, with options of the Parquet writer, and read it back.

    Unlike a cache the table outlives lost executors, and its file sizes let
    Catalyst decide soundly whether it may be broadcast.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what is run inside; they are as before afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stage_counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
    """A staged table with its ``rows`` and other sums, observed while it is written, so that no scan counts them."""
    seen = Observation(name)
    counts = {"rows": F.count(F.lit(1)), **metrics}
    staged = stage(df.observe(seen, *[c.cast("long").alias(k) for k, c in counts.items()]), name)
    return staged, {k: v or 0 for k, v in seen.get.items()}


def discard(staged: DataFrame) -> None:
    """Delete a staged table that nothing will read again; other tables are left alone.

    Whatever was derived from it must have been written by now.
    """
    spark = staged.sparkSession
    folders = {name.rsplit("/", 1)[0] for name in staged.inputFiles()}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(staging_root(spark))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    below = files.makeQualified(root).toUri().getPath().rstrip("/") + "/"
    for folder in folders:
        path = hadoop.Path(folder)
        if path.toUri().getPath().startswith(below):
            files.delete(path, True)
