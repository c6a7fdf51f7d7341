"""Signals by their properties; sources, sinks and streams by round trips."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.operators import audio
from tidewright.sources import files
from tidewright.streaming import incremental

RATE = 16_000
TONE = 0.3 * np.sin(2 * np.pi * 440 * np.arange(RATE) / RATE)


def pitch(x):
    return np.abs(np.fft.rfft(x * np.hanning(len(x)))).argmax() * RATE / len(x)


def test_wav_roundtrip():
    got = audio.decode_wav(audio.encode_wav(TONE, RATE))
    assert got["sample_rate"] == RATE and got["frames"] == RATE and np.abs(got["samples"] - TONE).max() < 1e-4
    assert audio.decode_wav(b"no")["error"].startswith("audio-read-failed")
    assert audio.decode_wav(None)["error"]


def test_stretch_and_pitch():
    slow = audio.stretch(TONE, 0.8)
    assert len(slow) == round(RATE / 0.8) and abs(pitch(slow) - 440) < 8
    high = audio.pitch_shift(TONE, 12)
    assert len(high) == RATE and abs(pitch(high) - 880) < 16
    assert len(audio.stretch(TONE[:0], 1.2)) == 0


@pytest.mark.parametrize("kind", ["white", "brown", "pink"])
def test_noise_is_seeded(kind):
    a, b = (audio.noise(TONE, kind, 0.05, 3) for _ in range(2))
    assert (a == b).all() and (a != audio.noise(TONE, kind, 0.05, 4)).any() and len(a) == RATE


def test_trim_loudness_and_activity():
    quiet = np.zeros(RATE)
    x = np.concatenate([quiet, TONE, quiet])
    assert len(audio.trim_silence(x, RATE)) == pytest.approx(RATE, abs=50)
    assert audio.loudness(audio.normalize_loudness(TONE, RATE, -20.0), RATE) == pytest.approx(-20, abs=0.2)
    (only,) = audio.speech_segments(x, RATE)
    assert only["start"] == pytest.approx(1, abs=0.05) and only["end"] == pytest.approx(2, abs=0.05)
    y, rate = audio.process(x, RATE, trim=True, target_seconds=0.5)
    assert len(y) == 8000 and rate == RATE
    assert len(audio.resample(TONE, RATE, 8000)) == 8000


def test_csv_roundtrip(spark, tmp_path):
    rows = spark.createDataFrame([("a,\"b\"", None, 3)], "url string, title string, extra int")
    files.write_csv(rows, f"{tmp_path}/c", ["url", "title", "missing"])
    back = files.read_csv(spark, f"{tmp_path}/c")
    assert back.columns == ["url", "title", "missing"] and tuple(back.first()) == ('a,"b"', "", "")


def test_lines_items_and_upsert(spark, tmp_path):
    (tmp_path / "u.txt").write_text("https://a.org/x\n\n# c\nnot a url\nhttps://b.org/login\n")
    assert [r[0] for r in files.read_url_lines(spark, f"{tmp_path}/u.txt").collect()] == ["https://a.org/x"]
    items = spark.createDataFrame([(1, "b"), (0, "a")], "o int, text string")
    files.write_items(items, f"{tmp_path}/items", {"n": F.lit(2)}, "o")
    assert [r[0] for r in files.read_items(spark, f"{tmp_path}/items", "struct<text:string>").collect()] == ["a", "b"]
    new = spark.createDataFrame([("u", 1, "x")], "url string, chunk int, more string")
    old = spark.createDataFrame([("u", 1), ("u", 2)], "url string, chunk int")
    assert sorted((r["url"], r["chunk"], r["more"]) for r in files.upsert(old, new, ["url", "chunk"]).collect()) == [("u", 1, "x"), ("u", 2, None)]


def test_audio_listing_and_transcripts(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.WAV").write_bytes(audio.encode_wav(TONE, RATE))
    (tmp_path / "a" / "y.txt").write_text("no")
    listed = files.list_audio(spark, f"{tmp_path}/a")
    assert [r["path"].rsplit("/", 1)[1] for r in listed.collect()] == ["x.WAV"]
    content = spark.read.format("binaryFile").load(f"{tmp_path}/a/x.WAV")
    assert files.transcribed(content, lambda: lambda b: [str(len(c)) for c in b]).first()["text"] == str(44 + 2 * RATE)
    path = spark.createDataFrame([("/r/a/x.wav",)], "p string").select(files.transcript_path(F.col("p"), "/r", "/out")).first()[0]
    assert path == "/out/a/x.txt"


def test_stream_acceptance(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("u1", "a", 1), ("u2", "a", 2), ("u1", "b", 3), ("u3", "a", 4)], "url string, label string, ord long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("url string, label string, ord long").parquet(f"{tmp_path}/in")
    for _ in range(2):  # a second start has nothing new
        query = incremental.accept_stream(stream, f"{tmp_path}/out", {"a": 2, "b": 1}, f"{tmp_path}/cp")
        query.awaitTermination(60)
    assert sorted(r["url"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["u1", "u2"]


def test_event_windows(spark, sf, tmp_path):
    events = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    query = incremental.event_windows(events).writeStream.outputMode("append").format("memory").queryName("ew").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.sql("select count(*) from ew").first()[0] > 0
