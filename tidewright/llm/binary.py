"""Token-id output: documents compressed one by one with a shared zstandard dictionary, in indexed blocks.

A block (the unit of the file format) holds up to BLOCK_DOCS documents in ascending doc_id order:

    magic "TWIDS1\\0\\0" | item size u2, reserved u2, documents u4 | dictionary SHA-256 (32 bytes) | start u8
    null flags u1[n] | doc ids i8[n] | ids per document u4[n] | frame offsets u8[n + 1] | zstandard frames

`start` counts the ids of the shard before the block. Blocks travel as a binary column of a Parquet table, so that any
file system that Spark can write takes them and task retries commit once; `dictionary` beside them has one row.
One document is read by its block's offset index: only that frame is decompressed.

Nulls: a null text is an empty document (the end id alone); a null doc_id sorts first. Repeated ids are kept, ties are
ordered by the text's hash. An empty table gives an empty file set. Only doc_id and text are read, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks, read_table, shared_folder, vocabulary
from .ids import encoder

MAGIC, BLOCK_DOCS, END_ID = b"TWIDS1\0\0", 1024, 0
HEAD = struct.Struct("<8sHHI32sQ")
DICTIONARY_DOCS, DICTIONARY_BYTES, SAMPLE_BYTES = 512, 65_536, 16_384  # SAMPLE_BYTES: of one document's ids, at most
BLOCKS = "shard int, start long, n_docs int, n_tokens long, first_doc long, last_doc long, payload binary"


def serialize(ids: bytes, item: int) -> bytes:
    """Ids in items of that many bytes; ids beyond them are refused."""
    if item == 4:
        return ids
    numbers = np.frombuffer(ids, "<u4")
    if len(numbers) and int(numbers.max()) >= 1 << (8 * item):
        raise ValueError(f"id {int(numbers.max())} needs more than {item} bytes")
    return numbers.astype(f"<u{item}").tobytes()


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of serialized id arrays; too few samples to train on make a raw-content dictionary."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def dictionary_of(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def pack_block(docs: list[tuple[int | None, bytes]], item: int, start: int, dictionary: bytes, pack: zstandard.ZstdCompressor) -> bytes:
    frames = [pack.compress(serialize(ids, item)) for _, ids in docs]
    return b"".join([
        HEAD.pack(MAGIC, item, 0, len(docs), hashlib.sha256(dictionary).digest(), start),
        np.array([d is None for d, _ in docs], "u1").tobytes(),
        np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
        np.array([len(ids) // 4 for _, ids in docs], "<u4").tobytes(),
        np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8").tobytes(),
        *frames,
    ])


class Block:
    """Reader of one block; document(i) decompresses only that document's frame."""

    def __init__(self, payload: bytes, dictionary: bytes):
        magic, self.item, _, n, digest, self.start = HEAD.unpack_from(payload)
        if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
            raise ValueError("not a block of this dictionary")
        at = HEAD.size
        self.null = np.frombuffer(payload, "u1", n, at)
        self.doc_ids = np.frombuffer(payload, "<i8", n, at + n)
        self.counts = np.frombuffer(payload, "<u4", n, at + 9 * n)
        self.offsets = np.frombuffer(payload, "<u8", n + 1, at + 13 * n)
        self.frames = memoryview(payload)[at + 13 * n + 8 * (n + 1) :]
        shared = dictionary_of(dictionary)
        self.unpack = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.counts)

    def document(self, i: int) -> np.ndarray:
        raw = self.unpack.decompress(self.frames[int(self.offsets[i]) : int(self.offsets[i + 1])], max_output_size=int(self.counts[i]) * self.item)
        return np.frombuffer(raw, f"<u{self.item}").astype("<u4")


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, item: int | None = None, shards: int | None = None, level: int = 1) -> None:
    """Writes the files of all documents below path. item: bytes of an id; 2 where the vocabulary and the end id allow it, else 4.

    The dictionary is trained on the ids of DICTIONARY_DOCS documents, those of least hash of the id in the whole table, of each its first
    SAMPLE_BYTES; it decides the files' size only.
    """
    spark, tokenizer = docs.sparkSession, tokenizer or vocabulary("byte_bpe_50k.json")
    if item is None:
        item = 2 if max(encoder(tokenizer).library.get_vocab_size() - 1, end_id) < 1 << 16 else 4
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    drawn = docs.select(F.xxhash64("doc_id").alias("r")).orderBy("r").limit(DICTIONARY_DOCS).agg(F.max("r")).first()[0]
    least = docs.where(F.xxhash64("doc_id") <= drawn) if drawn is not None else docs.limit(0)

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, memo="ids"):
            found = [serialize(x, item)[:SAMPLE_BYTES] for x in encoder(tokenizer).encode(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["ids"])

    sample = least.select("text").mapInArrow(serialized, "ids binary").distinct().orderBy("ids").limit(DICTIONARY_DOCS).collect()  # 8 MB at most
    dictionary = train_dictionary([bytes(r[0]) for r in sample if r[0]])
    spark.createDataFrame([(bytearray(dictionary), hashlib.sha256(dictionary).hexdigest(), item, end_id)], "content binary, sha256 string, item int, end_id int").coalesce(1).write.parquet(f"{path}/dictionary")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = dictionary_of(dictionary)
        pack = zstandard.ZstdCompressor(level=level, dict_data=shared) if shared else zstandard.ZstdCompressor(level=level)
        shard, start, encode = TaskContext.get().partitionId(), 0, encoder(tokenizer).encode
        for batch, texts in blocks(batches, memo="ids"):
            found = [(d, x + end) for d, x in zip(batch.column(0).to_pylist(), encode(texts))]
            for at in range(0, len(found), BLOCK_DOCS):
                part = found[at : at + BLOCK_DOCS]
                n = sum(len(x) for _, x in part) // 4
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((shard, pa.int32()), (start, pa.int64()), (len(part), pa.int32()), (n, pa.int64()), (part[0][0], pa.int64()), (part[-1][0], pa.int64()), (pack_block(part, item, start, dictionary, pack), pa.binary()))], names=["shard", "start", "n_docs", "n_tokens", "first_doc", "last_doc", "payload"])
                start += n

    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    dealt = docs.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), tie.asc()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie.asc())
    dealt.mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks")


def dictionary_at(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()["content"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian u4 bytes)."""
    dictionary = dictionary_at(spark, path)
    table = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = table.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # one row per shard
    before = totals.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    numbered = table.join(F.broadcast(before), "shard").select("base", "payload")  # broadcast: one row per shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(payload.as_py(), dictionary)
                starts = base + block.start + np.concatenate([[0], np.cumsum(block.counts, dtype="i8")[:-1]])
                ids = [block.document(i).tobytes() for i in range(len(block))]
                yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids.astype("i8"), mask=block.null.astype(bool)), pa.array(starts.astype("i8")), pa.array(block.counts.astype("i8")), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return numbered.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this id: the scan is pruned to their blocks, of which only their frames are decompressed."""
    dictionary = dictionary_at(spark, path)
    rows = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).select("payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0):
                block = Block(payload.as_py(), dictionary)
                for i in np.flatnonzero((block.doc_ids == doc_id) & (block.null == 0)):
                    yield pa.RecordBatch.from_arrays([pa.array([block.document(int(i)).tolist()], pa.list_(pa.int64()))], names=["ids"])

    return [r[0] for r in rows.mapInArrow(run, "ids array<long>").collect()]


def digest(frame: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids."""
    return frame.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-ids")
    write_ids(read_table(spark, sf_dir, "documents"), path)
    return digest(read_ids(spark, path))
