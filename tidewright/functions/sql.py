"""SQL names for the engine's expressions: temporary SQL functions that Catalyst inlines, and generators."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


class ChunkWindows:
    """chunk_windows(duration, window, overlap, least): rows (chunk_index, start_sec, end_sec)."""

    def eval(self, duration: int, window: int, overlap: int, least: int):  # noqa: ANN201
        start = index = 0
        while duration is not None and duration >= max(least, 1):
            end = min(start + window, duration)
            if end - start < least:
                return
            yield index, start, end
            if end >= duration:
                return
            start, index = start + window - overlap, index + 1


def register(spark: SparkSession) -> None:
    for name, signature, kind, body in (
        ("record_id", "url string", "string", "substring(md5(url), 1, 16)"),
        ("media_id", "url string", "string", "substring(sha1(url), 1, 10)"),
        ("text_key", "t string", "string", r"replace(lower(trim(regexp_replace(t, '(?U)\\s+', ' '))), 'ß', 'ss')"),
        ("draw", "k string", "bigint", "cast(conv(substring(md5(k), 1, 8), 16, 10) as bigint)"),
    ):
        spark.sql(f"create or replace temporary function {name}({signature}) returns {kind} return {body}")
    spark.udtf.register("chunk_windows", udtf(ChunkWindows, returnType="chunk_index int, start_sec int, end_sec int"))
