"""Sources and sinks of the stages' files. Raw zones are read as strings with a given schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.urls import is_valid

AUDIO_EXTENSIONS = ("wav", "mp3", "m4a", "aac", "flac", "ogg", "opus", "webm", "mp4", "mkv")
CRAWL_FIELDS = ["id", "source_article", "url", "platform", "keyword", "discovered_at", "weak_label", "strategy"]
MEDIA_FIELDS = ["url", "platform", "title", "uploader", "duration_sec", "filename", "status", "error", "scraped_at", "resolved_url", "weak_label", "source_article", "keyword", "strategy", "chunk_index", "chunk_start_sec", "chunk_end_sec", "parent_url"]


def strings(fields: list[str]) -> StructType:
    return StructType([StructField(f, StringType()) for f in fields])


def read_csv(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """A CSV with a header, every column a string; blanks come as empty strings."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").option("nullValue", "\u0000")
    found = (reader.schema(strings(fields)) if fields else reader.option("inferSchema", False)).csv(path)
    return found.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in found.columns])


def write_csv(frame: DataFrame, path: str, fields: list[str], mode: str = "overwrite") -> None:
    """Exactly these columns in this order: unknown ones are left out, missing ones and nulls come out blank."""
    columns = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in frame.columns else F.lit("").alias(f) for f in fields]
    frame.select(columns).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_lines(spark: SparkSession, path: str, strip_first: bool = True) -> DataFrame:
    """value: lines without blanks and comments. strip_first tells whether a comment sign may stand behind white space."""
    lines = spark.read.text(path)
    comment = F.trim("value").startswith("#") if strip_first else F.col("value").startswith("#")
    return lines.where((F.trim("value") != "") & ~comment).select(F.trim("value").alias("value"))


def read_url_lines(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path, strip_first=False).select(F.col("value").alias("url")).where(is_valid(F.col("url")))


def literal_urls(spark: SparkSession, urls: list[str]) -> DataFrame:
    return spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "ord int, url string")


def normalize_rows(rows: DataFrame) -> DataFrame:
    """Strings trimmed, weak_label filled from label."""
    out = rows.select([F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in rows.columns])
    label = F.nullif("weak_label", F.lit("")) if "weak_label" in rows.columns else F.lit(None).cast("string")
    other = F.col("label") if "label" in rows.columns else F.lit("")
    return out.withColumn("weak_label", F.coalesce(label, other, F.lit("")))


def read_url_rows(spark: SparkSession, path: str, labels: list[str] | None = None) -> DataFrame:
    """A CSV of addresses: blank, commented and invalid ones out, an optional list of labels."""
    rows = normalize_rows(read_csv(spark, path)).where((F.col("url") != "") & ~F.col("url").startswith("#"))
    rows = rows.where(is_valid(F.col("url")))
    return rows.where(F.col("weak_label").isin(labels)) if labels else rows


def read_items(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Items of JSON documents, {"items": [...]} or [...]."""
    from ..functions.text import json_items

    return spark.read.option("wholetext", True).text(path).select(F.inline(json_items(F.col("value"), schema)))


def write_items(items: DataFrame, path: str, metadata: dict[str, Column], order: str) -> None:
    """One JSON document with a metadata header. Meant for a finished batch: all items meet in one row, by contract of the format."""
    row = F.struct(F.col(order).alias("_o"), F.struct(*[c for c in items.columns if c != order]).alias("item"))
    found = items.agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["item"]).alias("items"))
    head = F.struct(*[v.alias(k) for k, v in metadata.items()]).alias("metadata")
    found.select(F.to_json(F.struct(head, "items")).alias("value")).write.mode("overwrite").text(path)


def read_processed(spark: SparkSession, path: str, key: str = "audio") -> DataFrame:
    """Keys of a JSON-lines log; blank lines are skipped."""
    return spark.read.schema(f"{key} string").json(path).where(F.col(key).isNotNull()).distinct()


def list_audio(spark: SparkSession, path: str, recursive: bool = False, extensions: tuple[str, ...] = AUDIO_EXTENSIONS) -> DataFrame:
    """path, length of audio files, by extension whatever its case; the content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).select("path", "length")
    return files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*extensions)).orderBy("path")


def read_feed(spark: SparkSession, path: str, per_feed: int) -> DataFrame:
    """Title and summary of the first entries of stored RSS files."""
    items = spark.read.format("xml").option("rowTag", "item").schema("title string, description string").load(path)
    numbered = items.select(F.input_file_name().alias("feed"), F.monotonically_increasing_id().alias("pos"), "title", F.col("description").alias("summary"))
    from ..operators.labels import cap_by

    return cap_by(numbered, "feed", "pos", per_feed)


def upsert(stored: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """New rows over stored ones of the same key; columns of either side are kept."""
    return stored.join(rows.select(keys).distinct(), keys, "left_anti").unionByName(rows, allowMissingColumns=True)


def split_sink(frame: DataFrame, kept: Column, path: str) -> None:
    """Kept and rejected rows in one pass, as partitions of one table."""
    frame.withColumn("decision", F.when(kept, "kept").otherwise("rejected")).write.mode("overwrite").partitionBy("decision").parquet(path)


def transcript_path(path: Column, root: str, out: str) -> Column:
    """Where a file's text goes: its path below root, mirrored below out, with .txt."""
    inner = F.when(path.startswith(root.rstrip("/") + "/"), F.substring(path, len(root.rstrip("/")) + 2, 1 << 20)).otherwise(F.regexp_extract(path, r"([^/]*)$", 1))
    return F.concat(F.lit(out.rstrip("/") + "/"), F.regexp_replace(inner, r"\.[^./]*$", ""), F.lit(".txt"))


def transcribed(files: DataFrame, model: Callable[[], Callable[[list[bytes]], list[str]]], batch: int = 16) -> DataFrame:
    """path, text, error through a model that each worker loads once; a batch that fails gives its error for each file."""

    def run(batches):  # noqa: ANN001, ANN202
        import pandas as pd

        call = model()
        for frame in batches:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                try:
                    yield pd.DataFrame({"path": part["path"], "text": call(list(part["content"])), "error": None})
                except Exception as e:  # the model is foreign code: its failure is a row's result
                    yield pd.DataFrame({"path": part["path"], "text": None, "error": str(e)})

    return files.select("path", "content").mapInPandas(run, "path string, text string, error string")
