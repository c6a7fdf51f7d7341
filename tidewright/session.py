"""Session defaults. Queries never depend on them for right results."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tidewright", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; everything else stays with the cluster's own settings."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    b = b.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()
