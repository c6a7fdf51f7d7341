"""Queries of signal operators that SQL cannot express: property-tested, rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import sampling
from ..operators import audio
from .views import table


def _signals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("x"), sampling.draw(F.col("vec_id").cast("string")).alias("seed"))


def _simple(kind: str, *arguments):  # noqa: ANN002, ANN202
    def run(spark: SparkSession, d: str) -> DataFrame:
        made = audio.transform(F.col("x"), kind, *[F.col(a) if isinstance(a, str) else F.lit(a) for a in arguments])
        return _signals(spark, d).select("vec_id", made.alias("y")).select("vec_id", F.size("y").alias("n"), F.sqrt(F.aggregate("y", F.lit(0.0), lambda a, v: a + v * v) / F.size("y")).alias("rms"))

    return run


def vad_energy(spark: SparkSession, d: str) -> DataFrame:
    return _signals(spark, d).select("vec_id", F.explode_outer(audio.voice_activity(F.col("x"), F.lit(100))).alias("s")).select("vec_id", "s.start", "s.end")


def wav_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    files = _signals(spark, d).select("vec_id", audio.wav_encode(F.col("x"), F.lit(16000)).alias("content"))
    return files.select("vec_id", F.length("content").alias("bytes"), audio.wav_decode("content").alias("w")).select("vec_id", "bytes", "w.sample_rate", "w.channels", "w.frames", "w.error")


def _files(spark: SparkSession, d: str) -> DataFrame:
    return _signals(spark, d).withColumn("content", audio.wav_encode(F.col("x"), F.lit(8000)))


def cleaning_chain(spark: SparkSession, d: str) -> DataFrame:
    """Standardised, trimmed, levelled and brought to one length."""
    made = _files(spark, d).select("vec_id", audio.cleaned("content", trim=True, target_lufs=-16.0, target_seconds=0.01).alias("c"))
    return made.select("vec_id", "c.sample_rate", F.length("c.audio").alias("bytes"), "c.error")


def chunk_audio(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of ten samples' time, at twice the rate."""
    parts = _signals(spark, d).select("vec_id", "x", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("chunk_index"))
    made = audio.chunk_audio(F.col("x"), F.lit(1000), F.col("chunk_index") * 0.01, (F.col("chunk_index") + 1) * 0.01, 2000)
    return parts.select("vec_id", "chunk_index", F.length(made).alias("bytes"))


def augment_audio(spark: SparkSession, d: str) -> DataFrame:
    """Every registered augmentation of every signal as a file."""
    kinds = sorted({a[0] for a in dims.AUGMENTATIONS})
    versions = _signals(spark, d).select("vec_id", F.col("x").alias("samples"), F.lit(100).alias("sample_rate"), "seed", F.explode(F.array(*map(F.lit, kinds))).alias("kind"))
    return audio.augmented(versions).select("vec_id", "kind", F.length("audio").alias("bytes"), "error")


QUERIES = {
    "cleaning_chain": cleaning_chain,
    "chunk_audio": chunk_audio,
    "augment_audio": augment_audio,
    "sig_noise_white": _simple("noise_white", 0.005, "seed"),
    "sig_noise_brown": _simple("noise_brown", 0.05, "seed"),
    "sig_noise_pink": _simple("noise_pink", 0.05, "seed"),
    "sig_stretch": _simple("time_stretch", 1.25),
    "sig_pitch": _simple("pitch_shift", 2.0),
    "sig_denoise": _simple("denoise"),
    "sig_loudness": _simple("loudness", 16000),
    "sig_trim": _simple("trim", 16),
    "sig_resample": _simple("resample", 16000, 8000),
    "vad_energy": vad_energy,
    "wav_roundtrip": wav_roundtrip,
}
