"""Views that put the engine's data shapes on the test tables; the same text runs in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_urls": """
SELECT page_id AS ord, page_id % 150 AS k,
  CASE (page_id % 150) % 9
    WHEN 0 THEN concat('https://www.youtube.com/watch?v=', substring(md5(cast(page_id % 150 AS string)),1,11), '&list=a')
    WHEN 1 THEN concat('https://youtu.be/', substring(md5(cast(page_id % 150 AS string)),1,11), '?t=3')
    WHEN 2 THEN concat('https://www.tiktok.com/@user', cast(page_id % 7 AS string), '/video/7', lpad(cast(page_id % 150 AS string),18,'0'), '?lang=id')
    WHEN 3 THEN concat('https://vm.tiktok.com/', substring(md5(cast(page_id % 150 AS string)),1,9), '/')
    WHEN 4 THEN concat('https://www.facebook.com/acct/videos/', lpad(cast(page_id % 150 AS string),15,'1'))
    WHEN 5 THEN concat('https://fb.watch/', substring(md5(cast(page_id % 150 AS string)),1,8), '/?ref=x')
    WHEN 6 THEN concat('https://www.instagram.com/reel/', substring(md5(cast(page_id % 150 AS string)),1,11), '/?igsh=z')
    WHEN 7 THEN concat('https://twitter.com/someone/status/', lpad(cast(page_id % 150 AS string),18,'1'), '?s=20')
    ELSE url END AS raw_url,
  CASE page_id % 5 WHEN 0 THEN 'ujaran kebencian' WHEN 1 THEN 'fitnah' WHEN 2 THEN 'disinformasi' ELSE 'neutral' END AS label
FROM pages
""",
    "v_tags": """
SELECT doc_id,
  split(CASE doc_id % 8
    WHEN 0 THEN 'Hoaks,cek-fakta,hoaks, HOAKS '
    WHEN 1 THEN 'fitnah,pencemaran nama baik,politik'
    WHEN 2 THEN 'SARA,ujaran-kebencian,hoaks'
    WHEN 3 THEN 'olahraga,sepak bola'
    WHEN 4 THEN 'hoaks atau fakta,adu domba'
    WHEN 5 THEN 'sarapan,-_,berita%20palsu viral'
    WHEN 6 THEN 'kasus fitnah,isu sara'
    ELSE concat('tag ', lang) END, ',') AS tags
FROM documents
""",
    "v_media": """
SELECT event_id AS ord,
  concat('raw/f', cast(event_id % 4000 AS string), CASE WHEN event_id % 41 = 0 THEN '.mp3' ELSE '.wav' END) AS filename,
  CASE WHEN event_id % 13 = 0 THEN 'failed' WHEN event_id % 17 = 0 THEN '' ELSE 'ok' END AS status,
  event_id % 19 <> 0 AS file_exists,
  CASE event_id % 6 WHEN 0 THEN 'Neutral' WHEN 1 THEN 'fitnah' WHEN 2 THEN 'ujaran_kebencian' WHEN 3 THEN '' WHEN 4 THEN 'fake' ELSE 'disinformasi' END AS weak_label,
  value AS duration_sec,
  (event_id * 37) % 100000 AS file_size_bytes,
  cast((event_id * 37) % 1000 AS double) AS rms,
  cast(event_id % 50 AS double) / cast(1000 AS double) AS clip_ratio,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast(event_id % 7 AS double) / cast(10 AS double) END AS vad_ratio,
  cast(event_id % 4 AS int) AS vad_segments
FROM events
""",
    "v_items": """
SELECT doc_id AS idx,
  CASE WHEN doc_id % 29 = 0 THEN '' WHEN doc_id % 31 = 0 THEN concat(text, ' 中文') WHEN doc_id % 7 = 0 THEN concat(text, ' [sigh] [foo]') ELSE text END AS text,
  CASE doc_id % 4 WHEN 0 THEN 'disinformasi' WHEN 1 THEN 'fitnah' WHEN 2 THEN 'ujaran_kebencian' ELSE 'neutral' END AS label,
  CASE WHEN doc_id % 23 = 0 THEN '  ' ELSE concat('persona ', source) END AS persona,
  concat('medium ', lang) AS medium,
  CASE doc_id % 5 WHEN 0 THEN 'short' WHEN 1 THEN 'medium' WHEN 2 THEN 'long' WHEN 3 THEN 'short' ELSE CASE WHEN doc_id % 25 = 4 THEN 'huge' ELSE 'medium' END END AS duration_hint,
  CASE WHEN doc_id % 7 = 0 THEN split('[sigh]', ',') WHEN doc_id % 37 = 0 THEN split('[laughter],[boo]', ',') ELSE NULL END AS control_tokens_used,
  split(concat('headline ', cast(doc_id % 10 AS string)), ',') AS context
FROM documents
""",
}
SOURCES = {"v_urls": "pages", "v_tags": "documents", "v_media": "events", "v_items": "documents"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = SOURCES[name]
    text = VIEWS[name].replace(f"FROM {source}", f"FROM {{{source}}}")
    return spark.sql(text, **{source: table(spark, sf_dir, source)})
