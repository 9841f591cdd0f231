"""Streaming queries run to their end over the files there are."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from normspark.session import shared_dir
from normspark.streaming import ingest


def _stream(s, d, name):
    like = s.read.parquet(f"{d}/{name}.parquet")
    return s.readStream.schema(like.schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/{name}*.parquet")


def stream_merged_metadata(s, d):
    """Metadata as it arrives, merged by id: the latest row of each."""
    out = f"{shared_dir(s).rstrip('/')}/merged-{uuid.uuid4().hex}"
    q = ingest.merge_into(_stream(s, d, "metadata").filter("id is not null").select("id", "so_ky_hieu", "loaded_at"), f"{out}/table", ["id"], "loaded_at", f"{out}/check")
    q.awaitTermination()
    return ingest.current(s, f"{out}/table")


def stream_daily_events(s, d):
    """Events per day and type, with a watermark."""
    out = f"{shared_dir(s).rstrip('/')}/daily-{uuid.uuid4().hex}"
    e = _stream(s, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value").withWatermark("ts", "1 day")
    g = e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    q = g.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total").writeStream.outputMode("complete").foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(f"{out}/table"))
    q.option("checkpointLocation", f"{out}/check").trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(f"{out}/table")


QUERIES = {f.__name__: f for f in (stream_merged_metadata, stream_daily_events)}
ORACLES = {
    "stream_merged_metadata": "SELECT id, so_ky_hieu, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST) AS rn FROM metadata WHERE id IS NOT NULL) WHERE rn = 1",
    "stream_daily_events": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
}
