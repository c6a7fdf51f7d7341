"""Sinks that other tools read: one CSV with one header, results in input order, JSON lines by batch, snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.results import in_input_order
from .files import read_csv, strings


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def append_csv(frame: DataFrame, path: str, fields: list[str], order: str) -> None:
    """Appends to one CSV file, with a header only when it is new.

    Parts are written in order without headers and joined by the file system's streams; the file is replaced at the end, so a
    failure leaves the old one. No row goes through the driver's memory.
    """
    spark, made = frame.sparkSession, f"{path}.{uuid.uuid4().hex}"
    columns = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in frame.columns else F.lit("").alias(f) for f in fields]
    frame.repartitionByRange(F.col(order)).sortWithinPartitions(order).select(columns).write.option("escape", '"').option("emptyValue", "").csv(f"{made}.parts")
    fs, target = _file_system(spark, path)
    hadoop, parts = spark._jvm.org.apache.hadoop, []
    for status in fs.listStatus(hadoop.fs.Path(f"{made}.parts")):
        if status.getPath().getName().startswith("part-"):
            parts.append(status.getPath())
    new = not fs.exists(target)
    out = fs.create(hadoop.fs.Path(f"{made}.file"))
    try:
        if new:
            out.write(bytearray((",".join(fields) + "\n").encode()))
        for p in [*([] if new else [target]), *sorted(parts, key=lambda p: p.getName())]:
            source = fs.open(p)
            hadoop.io.IOUtils.copyBytes(source, out, 65_536, False)
            source.close()
    finally:
        out.close()
    if not new:
        fs.delete(target, False)
    fs.rename(hadoop.fs.Path(f"{made}.file"), target)
    fs.delete(hadoop.fs.Path(f"{made}.parts"), True)


def result_fields(base: list[str], *frames: DataFrame) -> list[str]:
    """The base columns in their order, then every other column by name."""
    return [*base, *sorted({c for f in frames for c in f.columns} - set(base))]


def append_results(results: DataFrame, inputs: DataFrame, path: str, base: list[str], key: str = "url", order: str = "ord") -> None:
    """Appends results in the order of their inputs; the file is widened where they have columns that it lacks."""
    spark = results.sparkSession
    rows = in_input_order(inputs, results, key, order)
    named = results.columns
    if not exists(spark, path):
        return append_csv(rows, path, result_fields(base, results), order)
    stored = read_csv(spark, path)
    fields = result_fields(base, stored, results.select(named))
    if fields == stored.columns:
        return append_csv(rows, path, fields, order)
    old = stored.withColumn(order, F.monotonically_increasing_id())
    made = f"{path}.{uuid.uuid4().hex}"
    append_csv(old, made, fields, order)
    append_csv(rows, made, fields, order)
    fs, target = _file_system(spark, path)
    fs.delete(target, False)
    fs.rename(spark._jvm.org.apache.hadoop.fs.Path(made), target)


def append_jsonl(frame: DataFrame, path: str, batch: int) -> None:
    """JSON lines of one batch: a batch that is written again replaces its own lines only."""
    frame.write.mode("overwrite").json(f"{path}/batch={batch}")


def snapshot(frame: DataFrame, path: str, batch: int) -> str | None:
    """A checkpoint after a batch; its failure is a message, never an end of the run. Older ones go once it is there."""
    try:
        frame.write.mode("overwrite").parquet(f"{path}/after={batch}")
        if batch:
            remove(frame.sparkSession, f"{path}/after={batch - 1}")
        return None
    except Exception as e:  # the run goes on without its checkpoint
        return f"checkpoint-failed:{type(e).__name__}"


def finish(spark: SparkSession, path: str) -> None:
    """The run is over: its checkpoints go."""
    if exists(spark, path):
        remove(spark, path)


def find_metadata(spark: SparkSession, folder: str) -> str:
    """metadata.csv of a folder, else its only CSV; an error if there is none or a choice."""
    fs, p = _file_system(spark, folder)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(".csv"))
    if "metadata.csv" in names:
        names = ["metadata.csv"]
    if len(names) != 1:
        raise FileNotFoundError(f"no single CSV in {folder}: {names}")
    return f"{folder.rstrip('/')}/{names[0]}"


def by_stem(files: DataFrame, extensions: tuple[str, ...] = ("mp4", "m4a", "mp3", "wav", "webm", "mkv")) -> DataFrame:
    """stem, path of a listing: of several files with one stem the last by path."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    known = files.where(F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin(*extensions))
    return known.groupBy(F.regexp_replace(name, r"\.[^.]*$", "").alias("stem")).agg(F.max("path").alias("path"))


__all__ = ["append_csv", "append_jsonl", "append_results", "by_stem", "exists", "find_metadata", "finish", "remove", "result_fields", "snapshot", "strings"]
