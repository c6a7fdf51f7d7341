"""Quality gates with the first failing reason, kept-first deduplication, names and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions.text import canonical_label


@dataclass(frozen=True)
class Gate:
    """Limits of the media gate; None turns one off."""

    min_duration: float | None = 3.0
    max_duration: float | None = None
    min_size: int | None = None
    max_size: int | None = None
    min_rms: float = 200.0
    max_clip: float = 0.02
    min_vad: float = 0.15
    min_segments: int = 1
    extensions: tuple[str, ...] = (".wav",)
    validate_labels: bool = False
    audio_check: bool = True
    vad_check: bool = True


def media_reason(gate: Gate) -> Column:
    """accepted, or the first reason against a row of v_media's columns."""
    extension = F.lower(F.regexp_extract("filename", r"(\.[^./]*)$", 1))
    out = F.when(~F.coalesce(F.nullif("status", F.lit("")), F.lit("ok")).isin("ok"), "status-not-ok").when(F.coalesce(F.col("filename"), F.lit("")) == "", "missing-file").when(~F.col("file_exists"), "missing-file").when(~extension.isin(*gate.extensions), "unsupported-extension")
    if gate.validate_labels:
        out = out.when(~canonical_label(F.col("weak_label")).isin(dims.VALID_LABELS), "invalid-label")
    for limit, reason, low in ((gate.min_size, "too-small", True), (gate.max_size, "too-large", False)):
        if limit is not None:
            out = out.when((F.col("file_size_bytes") < limit) if low else (F.col("file_size_bytes") > limit), reason)
    if gate.min_duration is not None:
        out = out.when(F.col("duration_sec") < gate.min_duration, "too-short")
    if gate.max_duration is not None:
        out = out.when(F.col("duration_sec") > gate.max_duration, "too-long")
    if gate.audio_check:
        out = out.when(F.coalesce("rms", F.lit(0.0)) < gate.min_rms, "too-quiet").when(F.coalesce("clip_ratio", F.lit(0.0)) > gate.max_clip, "too-clipped")
    if gate.vad_check:  # a missing measurement is no evidence
        out = out.when(F.col("vad_ratio") < gate.min_vad, "low-vad").when(F.col("vad_ratio").isNotNull() & (F.col("vad_segments") < gate.min_segments), "low-vad-segments")
    return out.otherwise("accepted")


def speech_reason(stats: Column, finite: Column) -> Column:
    """Gate of synthesized speech over the struct of float_stats."""
    return (
        F.when(~finite, "non-finite").when(stats["duration"] < 0.8, "too-short").when(stats["duration"] > 45.0, "too-long")
        .when(stats["rms"] < 0.003, "too-quiet").when(stats["clip_ratio"] > 0.03, "too-clipped").otherwise("accepted")
    )


def duration_reason(duration: Column, low: int | None, high: int | None) -> Column:
    out = F.when(duration.isNull(), F.lit(None).cast("string"))
    if high is not None:
        out = out.when(duration > high, F.concat(F.lit("duration "), duration.cast("string"), F.lit(f"s exceeds max {high}s")))
    if low is not None:
        out = out.when(duration < low, F.concat(F.lit("duration "), duration.cast("string"), F.lit(f"s below min {low}s")))
    return out


def first_kept(rows: DataFrame, key: str, order: str, reason: str) -> DataFrame:
    """Marks rows behind the first accepted one of their key as duplicate-entry; rejected copies claim nothing, blank keys are never duplicates.

    The first accepted place is a partial aggregate, joined back; AQE splits a hot key.
    """
    first = rows.where((F.col(reason) == "accepted") & (F.col(key) != "")).groupBy(key).agg(F.min(order).alias("_first"))
    late = F.col("_first").isNotNull() & (F.col(order) > F.col("_first"))
    return rows.join(first, key, "left").withColumn(reason, F.when(late, "duplicate-entry").otherwise(F.col(reason))).drop("_first")


def dedupe_key(path: Column, filename: Column, url: Column, chunk: Column) -> Column:
    def named(prefix: str, c: Column) -> Column:
        return F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(prefix), c))

    return F.coalesce(named("path:", path), named("filename:", filename), F.when(F.coalesce(chunk, F.lit("")) != "", F.concat(named("url:", url), F.lit("#chunk:"), chunk)), named("url:", url), F.lit(""))


def stem(path: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(path, r"([^/]*)$", 1), r"^(.+?)(\.[^.]*)?$", 1)


def suffix(path: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(path, r"([^/]*)$", 1), r"^.+?(\.[^.]*)$", 1)


def safe_names(rows: DataFrame, path: str = "path", order: str = "ord") -> DataFrame:
    """Adds name: the file's own, with a hash where another path owns it, with a counter where that is taken as well."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    own = rows.withColumn("_name", name)
    owner = own.groupBy("_name").agg(F.min_by(path, order).alias("_owner"))
    k = F.row_number().over(Window.partitionBy("_name", path).orderBy(order)) - F.when(F.col(path) == F.col("_owner"), 1).otherwise(0)
    hashed = F.concat(stem(F.col(path)), F.lit("-"), F.substring(F.sha1(path), 1, 8))
    made = F.when(F.col("_k") == 0, F.col("_name")).when(F.col("_k") == 1, F.concat(hashed, suffix(F.col(path)))).otherwise(F.concat(hashed, F.lit("-"), (F.col("_k") - 1).cast("string"), suffix(F.col(path))))
    return own.join(owner, "_name").withColumn("_k", k).withColumn("name", made).drop("_name", "_owner", "_k")
