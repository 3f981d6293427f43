"""Restartable ingest and event windows by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest_new_files(spark: SparkSession, source: str, sink: str, checkpoint: str, key: str) -> StreamingQuery:
    """Append what came into ``source`` since the last run, without keys the sink has.

    The checkpoint remembers which files were read; a batch that is run again
    after a failure meets its own keys in the sink and adds nothing twice.
    """
    rows = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)

    def append(batch: DataFrame, _: int) -> None:
        new = batch.dropDuplicates([key])
        jvm = spark._jvm.org.apache.hadoop.fs.Path(sink)
        if jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm):
            new = new.join(spark.read.parquet(sink).select(key), key, "left_anti")
        new.write.mode("append").parquet(sink)

    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours", by: str = "event_type") -> DataFrame:
    """(window_start, by, n, total) of a stream or table; rows later than ``late`` behind the newest may be left out of a stream."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    out = timed.groupBy(F.window("ts", width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), by, "n", "total")
