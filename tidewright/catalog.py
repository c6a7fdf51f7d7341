"""Every registered query of the engine, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .plans import audio, queries, results

QUERIES = {**queries.QUERIES, **results.QUERIES, **audio.QUERIES}
ORACLES = {**queries.ORACLES, **results.ORACLES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.page_hosts_platform(spark, sf_dir)
