"""Windows over media: fixed chunks, speech segments, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunks(duration: Column, window: int = 30, overlap: int = 0, least: int = 5) -> Column:
    """Array of (chunk_index, start, end) of a duration in whole seconds; the tail below `least` is dropped."""
    step = window - overlap
    if step < 1:
        raise ValueError("the overlap must be below the window")
    starts = F.when(duration >= F.greatest(F.lit(least), F.lit(1)), F.sequence(F.lit(0), duration - 1, F.lit(step))).otherwise(F.expr("cast(array() as array<int>)"))
    every = F.transform(starts, lambda s, i: F.struct(i.alias("chunk_index"), s.alias("start"), F.least(s + window, duration).alias("end")))
    return F.filter(every, lambda c: (c["end"] - c["start"] >= least) & ((c["chunk_index"] == 0) | (c["start"] - step + window < duration)))


def chunk_name(path_stem: Column, index: Column, ext: str) -> Column:
    return F.format_string(f"%s_chunk%03d{ext}", path_stem, index)


def speech_ratio(segments: Column, duration: Column) -> Column:
    total = F.aggregate(segments, F.lit(0.0), lambda a, s: a + F.greatest(s["end"] - s["start"], F.lit(0.0)))
    return F.when(duration > 0, total / duration).otherwise(0.0)


def segment_rows(rows: DataFrame, segments: str, least: float) -> DataFrame:
    """One row per segment of `least` seconds or more; a row without any stays whole, with null segment columns."""
    kept = F.filter(segments, lambda s: s["end"] - s["start"] >= least)
    marked = rows.withColumn("_s", kept)
    out = F.posexplode_outer("_s").alias("segment_index", "_one")
    return marked.select(*rows.columns, out).select(*rows.columns, "segment_index", F.col("_one.start").alias("segment_start"), F.col("_one.end").alias("segment_end"))


def batches(n: Column, size: int) -> Column:
    """Array of (start, count) that deals n items into batches."""
    starts = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1, F.lit(size).cast("long"))).otherwise(F.expr("cast(array() as array<bigint>)"))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(F.lit(size).cast("long"), n - s).alias("count")))
