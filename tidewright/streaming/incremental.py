"""Incremental forms: acceptance until targets are met, resume by key, per batch of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.labels import accept_capped


def unseen(stream: DataFrame, key: str, time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """First occurrences of a key; with a time column the state is dropped behind the watermark."""
    if time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def accept_stream(stream: DataFrame, path: str, targets: dict[str, int], checkpoint: str) -> StreamingQuery:
    """Accepts url, label, ord rows into the table at path until every label has its target. A batch that is run again is not added twice."""

    def step(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        stored = spark.read.schema("url string, label string, ord long, batch long").parquet(path) if _exists(spark, path) else None
        counts, rows = {}, batch
        if stored is not None:
            stored = stored.where(F.col("batch") != number)
            counts = {r["label"]: r["count"] for r in stored.groupBy("label").count().collect()}  # one row per label
            rows = batch.join(stored.select("url"), "url", "left_anti")
        caps = {label: target - counts.get(label, 0) for label, target in targets.items()}
        accepted = accept_capped(rows.select("url", "label", "ord"), caps)
        accepted.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p))


def event_windows(stream: DataFrame, time: str = "ts", delay: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts and sums per event type and tumbling window, late events within the delay included."""
    stream = stream.withColumn(time, F.col(time).cast("timestamp"))  # zoneless times are read in the session's zone
    return stream.withWatermark(time, delay).groupBy(F.window(time, size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(stream: DataFrame, time: str = "ts", size: str = "1 hour", slide: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Counts and sums per event type and sliding window."""
    stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stream.withWatermark(time, delay).groupBy(F.window(time, size, slide).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(stream: DataFrame, time: str = "ts", gap: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Counts per event type and session: events that follow each other within the gap."""
    stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
