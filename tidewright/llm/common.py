"""What the operators of this subpackage share: batches of whole texts, fold rule, shared folder, vocabularies."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that a Python worker handles at once; a longer text makes a block of its own.
BLOCK_CHARS = 8_000_000

#: Spark's setting that deletes a query's shuffle files as it ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than the cluster has cores, dealt to all of them; a larger one as it is. Only for scans: it asks for their splits."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def held_out(doc_id: Column) -> Column:
    """The fold rule: crc32 of the id as text, remainder 2 of 4. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below spark.checkpoint.dir. Only local mode does without that setting (tests), below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there and a lost executor costs no recomputation.

    The shuffle files behind it are of no more use then, so Spark is told to delete them as the write ends, not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(CLEAN)
    spark.conf.set(CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], stem: str) -> str:
    """A column name that no column has, in any case."""
    taken = {c.lower() for c in columns}
    return next(name for name in (stem + "_" * k for k in range(len(taken) + 1)) if name.lower() not in taken)


#: What clears a module's worker-wide memo, by the memo's name.
MEMOS: dict[str, Callable[[], None]] = {}


#: The C library, whose allocator keeps freed memory of a reused worker unless told otherwise (glibc only).
LIBC = ctypes.CDLL(None)


def release(owner: str = "") -> None:
    """Frees the memos that a reused worker process still has from other operators, and gives free memory back to the system."""
    for name, clear in MEMOS.items():
        if name != owner:
            clear()
    pa.default_memory_pool().release_unused()
    if hasattr(LIBC, "malloc_trim"):
        LIBC.malloc_trim(0)


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_CHARS, memo: str = "") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches cut into slices of bounded text size, with their texts (null: empty). memo: the one memo to keep."""
    release(memo)
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start = size = 0
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        for i, n in enumerate(sizes):
            if size and size + n > limit:
                part = batch.slice(start, i - start)
                yield part, texts_of(part, text)
                start, size = i, 0
            size += n
        if start < len(sizes):
            part = batch.slice(start)
            yield part, texts_of(part, text)


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def map_blocks(df: DataFrame, fn: Callable[[pa.RecordBatch, list[str]], dict], schema: str, text: str = "text", memo: str = "") -> DataFrame:
    """Runs fn over blocks of rows; fn returns the output columns by name, in the order of schema."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, text, memo=memo):
            out = fn(batch, texts)
            yield pa.record_batch([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type) for x, f in zip(out.values(), arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
