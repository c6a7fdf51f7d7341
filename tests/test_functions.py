"""Edge cases by table, sequential models for the ordered operators, and plans."""

import random

import pytest
from pyspark.sql import functions as F

from tidewright.functions import extract, sql, text, urls
from tidewright.operators import gates, labels, windows

YT = "https://www.youtube.com/watch?v=dQw4w9WgXcQ"
CASES = [
    ("https://youtu.be/dQw4w9WgXcQ?t=3", YT, "youtube", True, "dQw4w9WgXcQ"),
    ("https://m.youtube.com/watch?v=dQw4w9WgXcQ&x=1", YT, "youtube", True, "dQw4w9WgXcQ"),
    ("https://www.youtube.com/shorts/abcdefghijk", "https://www.youtube.com/watch?v=abcdefghijk", "youtube", True, "abcdefghijk"),
    ("youtube.com/watch?v=dQw4w9WgXcQ", YT, "youtube", True, "dQw4w9WgXcQ"),
    ("www.tiktok.com/@a/video/12", "https://www.tiktok.com/@a/video/12", "tiktok", True, "12"),  # one www. only
    ("tiktok.com/@a/video/12?x=1", "https://www.tiktok.com/@a/video/12", "tiktok", True, "12"),
    ("https://vm.tiktok.com/ZM1/", "https://vm.tiktok.com/ZM1/", "tiktok", True, None),
    ("vt.tiktok.com/ZS9", "https://vt.tiktok.com/ZS9", "tiktok", True, None),
    ("https://fb.watch/abc/?x=1", "https://fb.watch/abc/", "facebook", True, None),
    ("https://www.facebook.com/x/videos/99/", "https://www.facebook.com/watch?v=99", "facebook", True, "99"),
    ("https://facebook.com/reel/77", "https://www.facebook.com/watch?v=77", "facebook", True, "77"),
    ("https://www.facebook.com/watch?v=123456789012345", "https://www.facebook.com/watch?v=123456789012345", "facebook", True, "123456789012345"),
    ("https://www.facebook.com/watch/?a=1&v=5", "https://www.facebook.com/watch/", "facebook", False, None),
    ("https://www.instagram.com/p/AbC-1/?igsh=z", "https://www.instagram.com/p/AbC-1/", "instagram", True, "AbC-1"),
    ("https://twitter.com/u/status/42?s=20", "https://x.com/i/web/status/42", "twitter", True, "42"),
    ("https://netflix.com/title/1?q=2", "https://netflix.com/title/1", "twitter", True, None),
    ("https://www.facebook.com/login/?next=1", "https://www.facebook.com/login/", "facebook", False, None),
]


def test_addresses(spark):
    rows = spark.createDataFrame([(c[0],) for c in CASES], "raw string").withColumn("u", urls.canonical(F.col("raw")))
    found = {r[0]: tuple(r)[1:] for r in rows.select("raw", "u", urls.platform(F.col("u")), urls.is_valid(F.col("u")), urls.video_id(F.col("u"))).collect()}
    for raw, *expected in CASES:
        assert found[raw] == tuple(expected), raw


def test_address_switches(spark):
    row = spark.createDataFrame([("https://www.facebook.com/watch?v=123456789012345", "https://netflix.com/t")], "a string, b string")
    got = row.select(urls.is_valid(F.col("a"), strict_reference=True), urls.video_id(F.col("a"), strict_reference=True), urls.platform(F.col("b"), exact_host=True)).first()
    assert tuple(got) == (False, "12345678901", "unknown")


def test_text(spark):
    def one(value, column):
        return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]

    assert one(" \x1b[31mred\x1b[0m ", text.strip_ansi) == "red"
    assert one("Straße  X", text.text_key) == "strasse x"
    assert one("a [foo] b [sigh]", text.speech_text) == "a b [sigh]"
    assert one("中", text.speech_text) is None
    assert one("[1, 'violates']", text.is_refusal) is False
    assert one("HTTP 429", text.error_status) == "throttled"
    assert one("a+b%2Fc", urls.unquote) == "a+b/c"
    assert one("%zz", urls.unquote) == "%zz"
    assert one("<b>a &amp; b</b>", text.html_text) == "a & b"


@pytest.mark.parametrize("tags,label", [(["hoaks atau fakta"], "disinformasi"), (["sarapan"], "neutral"), (["hoaks", "fitnah"], "fitnah"), (["kasus fitnah", "hoaks"], "disinformasi"), ([], "seed")])
def test_classification(spark, tags, label):
    row = spark.createDataFrame([(tags,)], "tags array<string>")
    assert row.select(labels.page_label(F.col("tags"), F.lit("seed"))).first()[0] == label


def _greedy(rows, caps):
    seen, count, out = set(), dict.fromkeys(caps, 0), []
    for order, url, label in sorted(rows):
        if url in seen or label not in caps or count[label] >= caps[label]:
            continue
        seen.add(url)
        count[label] += 1
        out.append((order, url, label))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_capped_acceptance_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    caps = {x: rng.randint(0, 6) for x in "abcd"}
    rows = [(k, f"u{rng.randint(0, 25)}", rng.choice("abcde")) for k in range(120)]
    frame = spark.createDataFrame(rows, "ord long, url string, label string")
    got = sorted((r["ord"], r["url"], r["label"]) for r in labels.accept_capped(frame, caps).collect())
    assert got == _greedy(rows, caps)


def _chunks(duration, window, overlap, least):
    out, start, k = [], 0, 0
    while duration >= max(least, 1):
        end = min(start + window, duration)
        if end - start < least:
            break
        out.append((k, start, end))
        if end >= duration:
            break
        start, k = start + window - overlap, k + 1
    return out


@pytest.mark.parametrize("window,overlap,least", [(30, 0, 5), (10, 3, 2), (7, 6, 1), (30, 10, 30)])
def test_chunks_equal_the_loop(spark, window, overlap, least):
    sql.register(spark)
    rows = spark.range(0, 120).select(F.col("id").cast("int").alias("d"))
    for r in rows.select("d", windows.chunks(F.col("d"), window, overlap, least).alias("c")).collect():
        assert [tuple(c) for c in r["c"]] == _chunks(r["d"], window, overlap, least)
    assert [tuple(r) for r in spark.sql("select * from chunk_windows(65, 30, 0, 5)").collect()] == _chunks(65, 30, 0, 5)


def test_kept_first_and_names(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice(["", "a", "b"]), rng.choice(["accepted", "too-short"])) for k in range(60)]
    frame = spark.createDataFrame(rows, "ord long, key string, reason string")
    kept, expected = set(), {}
    for k, key, reason in rows:
        if key and key in kept:
            expected[k] = "duplicate-entry"
        else:
            expected[k] = reason
            if reason == "accepted" and key:
                kept.add(key)
    assert {r["ord"]: r["reason"] for r in gates.first_kept(frame, "key", "ord", "reason").collect()} == expected


def test_plans(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = labels.cap_by(docs, "lang", "doc_id", 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
    pruned = docs.select("doc_id").where("lang = 'en'")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in pruned and "ReadSchema: struct<doc_id:bigint,lang:string>" in pruned


def test_tag_sites_and_skips(spark):
    page = '<a href="https://www.detik.com/tag/cek-fakta">'
    row = spark.createDataFrame([(page, "https://x/tag/a")], "h string, u string").select(extract.site_tags(F.col("h"), "detik"), extract.skipped(F.col("u"), "cnnindonesia")).first()
    assert row[0] == ["cek fakta"] and row[1] is True
