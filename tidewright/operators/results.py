"""Paths, names, order and heads of result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sampling import draw
from .labels import cap_by


def resolved_path(name: Column, folder: str) -> Column:
    """An absolute path as it is, a relative one below the folder, null for a blank one."""
    trimmed = F.nullif(F.trim(name), F.lit(""))
    return F.when(trimmed.startswith("/"), trimmed).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), trimmed))


def download_names(rows: DataFrame, id: str, ext: str, order: str) -> DataFrame:
    """Adds name: id.ext for the first row of an id in order, id-<k>.ext for the k-th behind it. No clock is read, so a rerun gives the same names."""
    k = F.row_number().over(Window.partitionBy(id, ext).orderBy(order)) - 1
    tail = F.when(k == 0, F.lit("")).otherwise(F.concat(F.lit("-"), k.cast("string")))
    return rows.withColumn("name", F.concat(F.col(id), tail, F.lit("."), F.col(ext)))


def size_mb(size: Column) -> Column:
    return size / F.lit(1048576.0)


def two_decimals(x: Column) -> Column:
    """With two decimals; an exact half of a hundredth goes to the even one, as SQL's and Python's format do (format_string takes it up)."""
    return F.call_function("format_number", x, F.lit("0.00"))


def size_reason(size: Column, low: float | None, high: float | None) -> Column:
    """Why a file of this many bytes is out, with its size in MB; null if it is within the limits."""
    mb, out = size_mb(size), F.when(size.isNull(), F.lit(None).cast("string"))
    if low is not None:
        out = out.when(mb < low, F.concat(F.lit("file too small: "), two_decimals(mb), F.lit(f" MB < {low:.2f} MB")))
    if high is not None:
        out = out.when(mb > high, F.concat(F.lit("file too large: "), two_decimals(mb), F.lit(f" MB > {high:.2f} MB")))
    return out


def now_iso(clock: Column | None = None) -> Column:
    """The time to the second, as ISO text; clock stands in for the current time."""
    return F.date_format(F.current_timestamp() if clock is None else clock, "yyyy-MM-dd'T'HH:mm:ss")


def with_files(rows: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """rows with file_exists and file_size_bytes from a listing (path, length)."""
    listed = files.groupBy(F.col("path").alias("_path")).agg(F.max("length").alias("file_size_bytes"))
    return rows.join(listed, F.col(path) == F.col("_path"), "left").withColumn("file_exists", F.col("_path").isNotNull()).drop("_path")


def in_input_order(inputs: DataFrame, results: DataFrame, key: str, order: str) -> DataFrame:
    """Results of each input row, repeated inputs included; `order` of the inputs comes with them."""
    return inputs.select(key, order).join(results, key)


def error_samples(rows: DataFrame, group: str, order: str, error: str, k: int) -> DataFrame:
    """The first k errors of each group in order, joined to one message."""
    first = cap_by(rows.where(F.col(error).isNotNull()).select(group, order, error), group, order, k)
    return first.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, error))), lambda r: r[error]), ", ").alias("message"))


def numbered(rows: DataFrame, order: str, name: str = "idx") -> DataFrame:
    """Adds the ordinal position in order, from 0: sorted by range partitions, whose sizes (one row each) give the offsets."""
    placed = rows.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id())
    sizes = placed.groupBy("_p").count()  # one row per partition
    before = sizes.select("_p", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_p").orderBy(order)) - 1
    return placed.withColumn("_own", own).join(F.broadcast(before), "_p").withColumn(name, F.col("_before") + F.col("_own")).drop("_p", "_own", "_before")


def shuffled_first(rows: DataFrame, key: str, seed: int, k: int) -> DataFrame:
    """The first k rows of a seeded shuffle, the same on every run."""
    return rows.orderBy(draw(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(k)


def feed_share(pool: int, feeds: int) -> int:
    """Entries of each feed for a pool; without a pool, a hundred."""
    return max(2, pool // max(feeds, 1) + 1) if pool else 100


def article_limit(remaining: Column) -> Column:
    return F.greatest(3 * remaining, F.lit(10))


def topic_limit(remaining: Column) -> Column:
    return F.greatest(2 * remaining, F.lit(12))


def needed_jobs(jobs: DataFrame, remaining: DataFrame, order: str) -> DataFrame:
    """Jobs of labels that still need rows, as many of each as its limit. remaining: label, remaining."""
    open_ = remaining.where("remaining > 0").select("label", article_limit(F.col("remaining")).alias("_limit"))
    n = F.row_number().over(Window.partitionBy("label").orderBy(order))
    return jobs.join(F.broadcast(open_), "label").withColumn("_n", n).where("_n <= _limit").drop("_n", "_limit")  # broadcast: one row per label
