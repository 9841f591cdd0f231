"""New shards as they arrive, merged into keyed tables: Structured Streaming over a folder of part files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from normspark.session import drop_path
from normspark.sources.files import exists, upserted


def arriving(spark: SparkSession, folder: str, like: DataFrame, files_per_trigger: int = 100) -> DataFrame:
    """The part files of a folder as a stream, in the schema of ``like``."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def merge_into(stream: DataFrame, target: str, keys: list[str], at: str, checkpoint: str) -> StreamingQuery:
    """Upsert each batch into a table of versions: a batch is written to its own folder ``v=<batch>`` with all rows current
    after it, so a batch that is run again overwrites only itself, and readers see whole versions. The version before stays
    for such a batch and for readers, older ones are removed."""
    def one(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        old = current(spark, target, n)
        upserted(old, batch, keys, F.col(at)).write.mode("overwrite").parquet(f"{target}/v={n}")
        for v in versions(spark, target, n)[:-1]:
            drop_path(spark, f"{target}/v={v}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def versions(spark: SparkSession, target: str, before: int | None = None) -> list[int]:
    """The versions of a merged table (before a batch), oldest first."""
    if not exists(spark, target):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(target)
    names = [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return sorted(v for v in (int(x[2:]) for x in names if x.startswith("v=")) if before is None or v < before)


def current(spark: SparkSession, target: str, before: int | None = None) -> DataFrame | None:
    """The latest version of a merged table (before a batch), None where there is none."""
    got = versions(spark, target, before)
    return spark.read.parquet(f"{target}/v={got[-1]}") if got else None


def loaded_per_window(stream: DataFrame, at: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows per window of arrival time, late ones up to the watermark."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("since"), "n")
