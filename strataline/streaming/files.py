"""Documents as they arrive: a file stream of parsed JSON, each batch through the chunk plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strataline.plans import pipeline
from strataline.sources.tables import DOCUMENT


def stream_chunks(spark: SparkSession, inbox: str, out: str, checkpoint: str) -> StreamingQuery:
    """Starts a query that turns each new parsed document in ``inbox`` into chunks in ``out`` (parquet), once.

    The checkpoint keeps what was read, so a restart neither skips nor repeats a document; a batch that is run again
    writes the same folder. Both folders have to be shared by the cluster.
    """
    docs = spark.readStream.schema(DOCUMENT).option("multiLine", True).json(inbox)
    docs = docs.withColumn("file_id", F.xxhash64(F.col("_metadata.file_path")))
    rows = docs.select("file_id", F.posexplode("flat_segments").alias("pos", "s")).select("file_id", "pos", "s.*")

    def write(batch: DataFrame, number: int) -> None:
        pipeline.chunks(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def session_windows(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Sessions of users over a stream or table of events: start, end, events, total value. Late events within ``late``
    still count on a stream."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    g = marked.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))
    return g.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events", F.round("total", 4).alias("total"))
