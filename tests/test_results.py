"""Sinks, external steps with fakes, corrected semantics with values written by hand, augmentation."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright import catalog, dims
from tidewright.functions import extract, text, urls
from tidewright.operators import audio, results
from tidewright.sources import external, sinks


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize("href,link", [
    ("../a", "https://h.id/x/a"), ("./a", "https://h.id/x/y/a"), ("../../../a", "https://h.id/a"), ("a/./b/../c", "https://h.id/x/y/a/c"), ("..", "https://h.id/x/"), ("/p/../q?z=1#f", "https://h.id/q?z=1#f"),
    ("mailto:a@b.id", "mailto:a@b.id"), ("javascript:void(0)", "javascript:void(0)"), ("b.html", "https://h.id/x/y/b.html"), ("?k=2", "https://h.id/x/y/z?k=2"), ("//c.id/d", "https://c.id/d"), ("HTTP://C.id/", "HTTP://C.id/"),
])
def test_absolute_addresses(spark, href, link):
    assert one(spark, urls.absolute(F.lit(href), F.lit("https://h.id/x/y/z?k=1")))[0] == link


def test_source_block_has_no_shorts(spark):
    page = 'Narasi <a href="https://www.youtube.com/shorts/abcdefghijk">s</a><a href="https://youtu.be/abcdefghijk">v</a> Penjelasan'
    assert one(spark, extract.preferred_urls(F.lit(page), F.lit("https://turnbackhoax.id/a")))[0] == ["https://www.youtube.com/watch?v=abcdefghijk"]
    only = 'Narasi <a href="https://www.youtube.com/shorts/abcdefghijk">s</a> Penjelasan'
    assert one(spark, extract.preferred_urls(F.lit(only), F.lit("https://turnbackhoax.id/a")))[0] == []


def test_case_folding_is_the_full_one(spark):
    for t in ("Straße ẞ", "ﬁn ŉ ΐ", "ΣΊΣΥΦΟΣ ς", "ſ µ", "Plain İ"):
        assert one(spark, text.casefold(F.lit(t)))[0] == t.casefold()


def test_items_that_are_no_objects(spark):
    found = one(spark, text.item_kind_findings(F.lit('[{"text":"a"}, 1, "x", [2], true, 1.5, null]')))[0]
    assert [(f["index"], f["reason"].split(":")[1]) for f in found] == [(1, "int"), (2, "str"), (3, "list"), (4, "bool"), (5, "float"), (6, "NoneType")]
    for document, bad in (('{"items": []}', False), ("[]", False), ("{}", True), ("no json", True), ('"[1]"', False)):
        assert one(spark, text.unreadable(F.lit(document)))[0] is bad, document


def test_pink_filter_equals_the_recursion():
    white = np.random.default_rng(3).standard_normal(700)
    b, made = [0.0] * 6, []
    for n, w in enumerate(white):
        b = [p * v + w * g for p, v, g in zip(audio.PINK_POLES, b, audio.PINK_GAINS)]
        made.append((sum(b) + (audio.PINK_DELAYED * white[n - 1] if n else 0.0) + audio.PINK_DIRECT * w) * audio.PINK_SCALE)
    made = np.array(made)
    assert np.allclose(audio.noise(np.zeros(700), "pink", 0.05, 3), made / np.abs(made).max() * 0.05)
    brown = audio.noise(np.zeros(700), "brown", 0.05, 3)
    assert np.allclose(brown, np.cumsum(white) / np.abs(np.cumsum(white)).max() * 0.05 * 700 * 0.01)


def test_registry_makes_audio(spark):
    rng = np.random.default_rng(1)
    x = np.clip(rng.standard_normal(400) * 0.2, -1, 1)
    for kind in {a[0] for a in dims.AUGMENTATIONS}:
        assert np.abs(audio.augment(x, kind, 100, 5)).max() <= 1
        assert (audio.augment(x, kind, 100, 5) == audio.augment(x, kind, 100, 5)).all()
    assert np.allclose(audio.augment(x, "volume_up", 100, 5, {"level": (1.0, 1.0)}), x)
    with pytest.raises(ValueError):
        audio.ranges_of("none")
    y = x.copy()
    for i in range(20, 400):
        y[i] += 0.5 * y[i - 20]
    assert np.allclose(audio.echo(x, 0.2, 0.5, 100), y)
    rows = spark.createDataFrame([(x.tolist(), 100, "echo", 1), (x.tolist(), 100, "none", 1)], "samples array<double>, sample_rate int, kind string, seed long")
    found = {r["kind"]: (r["audio"], r["error"]) for r in audio.augmented(rows).collect()}
    assert found["echo"][0][:4] == b"RIFF" and found["none"] == (None, "augment-failed:unknown augmentation none")


def test_csv_with_one_header_in_input_order_widened(spark, tmp_path):
    path = f"{tmp_path}/out.csv"
    inputs = spark.createDataFrame([(k, f"u{k % 4}") for k in range(8)], "ord long, url string")
    found = spark.createDataFrame([(f"u{k}", f't "{k}", x') for k in range(3)], "url string, title string")
    sinks.append_results(found, inputs, path, ["url", "title"])
    lines = open(path).read().splitlines()
    assert lines[0] == "url,title" and len(lines) == 7 and [x.split(",")[0] for x in lines[1:]] == ["u0", "u1", "u2", "u0", "u1", "u2"]
    sinks.append_results(found.withColumn("b", F.lit("1")).withColumn("a", F.lit("2")), inputs.where("ord < 2"), path, ["url", "title"])
    lines = open(path).read().splitlines()
    assert lines[0] == "url,title,a,b" and len(lines) == 9 and sum(x.startswith("url,") for x in lines) == 1
    back = sinks.read_csv(spark, path).collect()
    assert back[0]["title"] == 't "0", x' and back[0]["a"] == "" and back[-1]["b"] == "1"


def test_batches_snapshots_and_discovery(spark, tmp_path):
    frame = spark.range(3)
    for batch in (0, 1, 1):
        sinks.append_jsonl(frame, f"{tmp_path}/log", batch)
    assert spark.read.json(f"{tmp_path}/log").count() == 6
    assert sinks.snapshot(frame, f"{tmp_path}/snap", 0) is None and sinks.snapshot(frame, f"{tmp_path}/snap", 1) is None
    assert sinks.exists(spark, f"{tmp_path}/snap/after=1") and not sinks.exists(spark, f"{tmp_path}/snap/after=0")
    sinks.finish(spark, f"{tmp_path}/snap")
    assert not sinks.exists(spark, f"{tmp_path}/snap")
    folder = tmp_path / "meta"
    folder.mkdir()
    with pytest.raises(FileNotFoundError):
        sinks.find_metadata(spark, str(folder))
    (folder / "a.csv").write_text("x")
    assert sinks.find_metadata(spark, str(folder)).endswith("a.csv")
    (folder / "b.csv").write_text("x")
    with pytest.raises(FileNotFoundError):
        sinks.find_metadata(spark, str(folder))
    (folder / "metadata.csv").write_text("x")
    assert sinks.find_metadata(spark, str(folder)).endswith("metadata.csv")
    files = spark.createDataFrame([("d/a.mp4",), ("d/a.wav",), ("d/b.txt",)], "path string")
    assert [tuple(r) for r in sinks.by_stem(files).collect()] == [("a", "d/a.wav")]


def test_external_steps_with_fakes(spark):
    def client():
        def call(attempt, url, agent=""):
            if "blocked" in url:
                raise external.Failed("throttled", "429")
            if "private" in url:
                raise external.Failed("needs-login", "sign in")
            if "flaky" in url and attempt < 2:
                raise RuntimeError("reset")
            return f"<html>{url} {agent}"

        return call

    pages = spark.createDataFrame([("u1",), ("flaky",), ("blocked",), ("private",)], "url string")
    found = {r["url"]: r for r in external.fetched(pages, client, ["A"], tries=4).collect()}
    assert found["u1"]["html"] == "<html>u1 A" and found["flaky"]["status"] == "ok" and len(found["flaky"]["errors"]) == 2
    assert (found["blocked"]["status"], len(found["blocked"]["errors"])) == ("throttled", 4)
    assert (found["private"]["status"], found["private"]["errors"]) == ("needs-login", ["attempt-1:sign in"])

    def probe():
        return lambda attempt, url: 12.9 if url == "u1" else float("x")

    assert {r["url"]: r["duration"] for r in external.probed(pages, probe).collect()} == {"u1": "12", "flaky": "", "blocked": "", "private": ""}
    assert {r["duration"] for r in external.probed(pages, probe, whole=False).collect()} == {12.9, 0.0}
    media = {r["url"]: r["content"] for r in external.downloaded(pages, lambda: lambda attempt, url: url.encode()).collect()}
    assert media["u1"] == b"u1"
    asks = spark.createDataFrame([(1, "p")], "id long, prompt string")
    assert external.generated(asks, lambda: lambda attempt, prompt: "[]").first()["answer"] == "[]"
    items = spark.createDataFrame([(1, "t", "male")], "id long, text string, instruct string")
    spoken = external.synthesized(items, lambda: lambda attempt, t, i: bytes([attempt]) if attempt == 1 else 1 / 0).first()
    assert (bytes(spoken["content"]), spoken["attempts"]) == (b"\1", 2)
    assert external.back_off(3, 0.5) == 4.0


def test_clock_and_shares(spark):
    assert one(spark, results.now_iso(F.lit("2024-05-06 07:08:09.9").cast("timestamp")))[0] == "2024-05-06T07:08:09"
    assert (results.feed_share(0, 5), results.feed_share(100, 10), results.feed_share(3, 50)) == (100, 11, 2)
    assert one(spark, results.topic_limit(F.lit(3)), results.article_limit(F.lit(30))) == (12, 90)
    shuffled = results.numbered(spark.range(0, 1000, 1, 7).select(((F.col("id") * 37) % 1000).alias("k")), "k")
    assert shuffled.where("k <> idx").count() == 0


def test_sizes_at_half_a_hundredth(spark):
    sizes = [k * 131072 for k in range(1, 400)] + [k * 131072 + 131072 * 1600 for k in range(1, 400)] + [k * 131072 + d for k in (1, 5, 2601, 2605) for d in (-1, 1)] + [(1 << 40) + 131072, (1 << 52) + 12345, 0, None]
    rows = spark.createDataFrame([(s,) for s in sizes], "size long").select("size", results.size_reason(F.col("size"), 50.0, 200.0).alias("reason")).collect()
    assert len(rows) == len(sizes)
    for size, reason in rows:
        mb = None if size is None else size / 1048576
        expected = None if mb is None else f"file too small: {mb:.2f} MB < 50.00 MB" if mb < 50 else f"file too large: {mb:.2f} MB > 200.00 MB" if mb > 200 else None
        assert reason == expected, size


def test_size_reasons_equals_sql_at_half_a_hundredth(spark, tmp_path):
    """Keys that only tables larger than sf0.1 have."""
    con = duckdb.connect()
    con.execute("create table events as select unnest([200873, 249001, 297129, 345257, 393385, 7])::bigint as event_id, 0.5 as value")
    con.execute(f"copy events to '{tmp_path}/events.parquet' (format parquet)")
    found = catalog.QUERIES["size_reasons"](spark, str(tmp_path)).select("ord", "reason").collect()
    assert sorted(map(tuple, found)) == sorted(con.execute(f"select ord, reason from ({catalog.ORACLES['size_reasons']})").fetchall())
