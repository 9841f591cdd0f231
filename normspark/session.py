"""Session settings, table access and lineage cuts shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "normspark", cpus: int | None = None, **conf: str) -> SparkSession:
    """A session for local work; a cluster passes its own and needs none of this."""
    b = (
        SparkSession.builder.master(f"local[{cpus or '*'}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; a directory of part files and a single file read alike."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where it is unset (local tests) one of our own."""
    got = spark.conf.get("spark.checkpoint.dir", None)
    if got:
        return got
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = os.path.join(tempfile.gettempdir(), f"normspark-{os.getpid()}")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_made: list[tuple[SparkSession, str]] = []


def _drop_made() -> None:
    for spark, path in _made:
        try:
            drop_path(spark, path)
        except Exception:  # the session has ended before: what is on this machine can still be removed
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system holds it."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table ends the lineage and survives the loss of executors; unlike an RDD checkpoint it stays columnar
    and compressed, and its size is known to the planner. It is removed when the driver ends.
    """
    spark = df.sparkSession
    if not _made:
        atexit.register(_drop_made)
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    df.write.option("compression", "zstd").parquet(path)
    got = spark.read.schema(df.schema).parquet(path)
    got._cut_path = path
    return got


def release(df: DataFrame) -> None:
    """Remove the table behind a ``cut`` that no later plan reads any more."""
    if path := getattr(df, "_cut_path", None):
        drop_path(df.sparkSession, path)
        _made.remove((df.sparkSession, path))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly where the input has fewer parts than the session has cores; large inputs stay as they are.

    For kernels whose work is out of proportion to the bytes they read, so that a small file does not sit in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores)
