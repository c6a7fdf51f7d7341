"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints that differ in at most 3 of 64 bits agree in at least 5 of their 8 bytes (the guaranteed minimum), so at
least 3 of the first four or of the last four. The index therefore posts every distinct fingerprint under the 8 triples of positional bytes
that lie in one half, the prefixes of which such a pair shares one at least. Inside a list the shared positional bytes of every pair
are tallied over the eight positions; pairs below the guaranteed 5 are dropped, and only the rest are verified by their differing bits.
Lists longer than `longest` are split further by two more shared
bytes (lists of five positions, complete by the same count), and if still longer are compared block against block, each
pair of blocks in its own row group, so no task ever holds more than two blocks of one list.

Equal fingerprints are one entry. A list gives a spanning forest of its verified links, not all
pairs; components follow on the distributed link table of fingerprints, and take the smallest doc_id of their documents.

Null and empty texts have fingerprint zero and link like any other. Null doc_ids link too, but give no component its id: a component without
any id gets null. Repeated rows appear once each; an empty table gives no rows; other columns are ignored (keep_first keeps them,
whatever their names).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_blocks, materialize, read_table
from .graph import components

SHINGLE, SEED, DISTANCE, SHARED, LONGEST = 3, 42, 3, 5, 4096
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text (unsigned)."""
    words = text.encode().lower().split()  # bytes: only A-Z fall, only ASCII white space cuts
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())]
    ones = np.zeros(64, "i8")
    packed = np.array(hashes, ">u8")
    for at in range(0, len(packed), 8192):
        part = packed[at : at + 8192]
        ones += np.unpackbits(part.view("u1").reshape(len(part), 8), axis=1).sum(axis=0, dtype="i8")
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash of the text, and of whether there is an id) and fp (fingerprint as a signed long) of every document."""

    def run(batch: pa.RecordBatch, texts: list[str]) -> dict:
        found = np.array([fingerprint(t) for t in texts], "u8").view("i8")
        return {"doc_id": batch.column(0), "th": batch.column(1), "fp": pa.array(found)}

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_hash(docs).alias("th"), docs["text"].alias("text"))
    return map_blocks(own, run, "doc_id long, th long, fp long")


def text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"], docs["doc_id"].isNull())


def bytes_at(fp: np.ndarray, positions: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(fp), "u8")
    for p in positions:
        out = out << np.uint64(8) | (fp >> np.uint64(8 * p)) & np.uint64(255)
    return out


def shared_bytes(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The tally of pairs: how many positional bytes they share."""
    gap = fp[i] ^ fp[j]
    tally = np.zeros(np.shape(gap), "u1")
    for p in range(8):
        tally += (gap >> np.uint64(8 * p)) & np.uint64(255) == 0
    return tally


def verified(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp[i] ^ fp[j]) <= DISTANCE


def forest(fp: np.ndarray, groups: np.ndarray, sides: np.ndarray | None = None, seen: Counter | None = None) -> list[tuple[int, int]]:
    """Verified links inside runs of equal group numbers, as a spanning forest of row numbers.

    sides: rows of a side other than -1 link only across sides. seen counts the pairs met, retained by the tally, and linked.
    """
    root = np.arange(len(fp))
    seen = Counter() if seen is None else seen
    out: list[tuple[int, int]] = []

    def settle(i: np.ndarray, j: np.ndarray, low: int, high: int) -> None:
        """Joins pairs of rows from low to high; a root takes part in one join at a time, so that joins form no cycle."""
        seen["met"] += len(i)
        retained = shared_bytes(fp, i, j) >= SHARED
        i, j = i[retained], j[retained]
        seen["retained"] += len(i)
        hit = verified(fp, i, j)
        seen["linked"] += int(hit.sum())
        i, j = i[hit], j[hit]
        while True:
            x, y = root[i], root[j]
            apart = x != y
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            greater, lesser = np.maximum(x, y)[apart], np.minimum(x, y)[apart]
            _, one = np.unique(greater, return_index=True)
            root[greater[one]] = lesser[one]
            out.extend(zip(i[one].tolist(), j[one].tolist()))
            while (root[root[low:high]] != root[low:high]).any():
                root[low:high] = root[root[low:high]]

    bounds = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1], [True]])) if len(fp) else np.array([0])
    sizes = np.diff(bounds)
    for size in np.unique(sizes[sizes > 1]).tolist():
        starts = bounds[:-1][sizes == size]
        if size <= 32 and sides is None:  # many short lists: all of one length at once
            a, b = np.triu_indices(size, 1)
            for at in range(0, len(starts), max(1, 2_000_000 // len(a))):
                part = starts[at : at + max(1, 2_000_000 // len(a)), None]
                settle((part + a).ravel(), (part + b).ravel(), int(part[0, 0]), int(part[-1, 0]) + size)
            continue
        for start in starts.tolist():
            for x in range(start, start + size - 1, 64):
                i, j = np.meshgrid(np.arange(x, min(x + 64, start + size - 1)), np.arange(x + 1, start + size), indexing="ij")
                wanted = i < j
                if sides is not None:
                    wanted &= (sides[i] == -1) | (sides[i] != sides[j])
                settle(i[wanted], j[wanted], start, start + size)
    return out


def links(entries: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Links a, b between entries (node long, fp long, distinct), enough to connect every pair within the distance."""

    def post(positions: list[tuple[int, ...]]):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                node, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view("u8")
                for k, p in enumerate(positions):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), k, "i2")), pa.array(bytes_at(fp, p).view("i8")), pa.array(node), pa.array(fp.view("i8"))], names=["list", "value", "node", "fp"])

        return run

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by list, value and sub-list; a run that goes over batches is carried."""
        rest: pa.Table | None = None
        for batch in _with_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                rest = table if rest is None else pa.concat_tables([rest, table])
            if rest is None or not rest.num_rows:
                continue
            key = [rest.column(c).to_numpy() for c in ("list", "value", "sub")]
            new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)])
            groups = np.cumsum(new)
            upto = len(groups) if batch is None else int(np.flatnonzero(new)[-1])
            if upto:
                node, fp, side = (rest.column(c).to_numpy()[:upto] for c in ("node", "fp", "side"))
                across = groups[:upto].astype("i8")
                found = forest(fp.view("u8"), across, side if (side != -1).any() else None)
                pairs = np.array(found, "i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], names=["a", "b"])
            rest = rest.slice(upto)

    def in_order(posted: DataFrame) -> DataFrame:
        return posted.select("list", "value", "sub", "side", "node", "fp").repartition("list", "value", "sub").sortWithinPartitions("list", "value", "sub", "fp").mapInArrow(compare, "a long, b long")

    kind = "list short, value long, node long, fp long"
    plain = [F.lit(0).alias("sub"), F.lit(-1).cast("long").alias("side")]
    posted = materialize(entries.mapInArrow(post(TRIPLES), kind), "postings")
    sizes = posted.groupBy("list", "value").agg(F.count("*").alias("n")).where("n > 1")  # one row per shared list
    sizes = materialize(sizes, "list-sizes")
    short = posted.join(sizes.where(F.col("n") <= longest).select("list", "value"), ["list", "value"])
    found = in_order(short.select("*", *plain))
    long = sizes.where(F.col("n") > longest)
    if long.isEmpty():
        return found
    # lists that are too long: two more shared bytes
    hot = posted.join(long.select("list", "value"), ["list", "value"]).select(F.col("node"), F.col("fp")).distinct()
    fives = [tuple(c) for c in combinations(range(8), SHARED)]
    finer = materialize(hot.mapInArrow(post(fives), kind), "postings")
    counts = materialize(finer.groupBy("list", "value").agg(F.count("*").alias("n")).where("n > 1"), "list-sizes")
    found = found.union(in_order(finer.join(counts.where(F.col("n") <= longest).select("list", "value"), ["list", "value"]).select("*", *plain)))
    longer = counts.where(F.col("n") > longest)
    if longer.isEmpty():
        return found
    # and what is still too long: every pair of blocks of the list
    blocked = finer.join(longer, ["list", "value"]).withColumn("blocks", F.ceil(F.col("n") / (longest // 2)).cast("int"))
    own = blocked.withColumn("side", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("sub", (F.least("side", "other") * F.col("blocks") + F.greatest("side", "other") + 1).cast("int"))
    return found.union(in_order(dealt.withColumn("side", F.when(F.col("side") == F.col("other"), F.lit(-1)).otherwise(F.col("side")).cast("long")).select("list", "value", "sub", "side", "node", "fp")))


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def grouped(prints: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Adds component_id (smallest doc_id) and group (smallest fingerprint) to doc_id, th, fp. prints is read several times: pass a written table."""
    entries = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "entries")
    joined = components(links(entries.select(F.col("fp").alias("node"), "fp"), longest))
    own = entries.join(joined, entries["fp"] == joined["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("group"))
    own = materialize(own, "groups")
    lowest = own.groupBy("group").agg(F.min("low").alias("component_id"))
    return prints.join(own.select("fp", "group").join(lowest, "group"), "fp")


def near_duplicates(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """doc_id, fp, component_id of every document."""
    return grouped(materialize(fingerprints(docs), "fingerprints"), longest).select("doc_id", "fp", "component_id")


def op4_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of every component, with all its columns: that of smallest doc_id, or, without any, of smallest text hash. Of repeated rows one stays."""
    found = grouped(materialize(fingerprints(docs), "fingerprints"))
    found = materialize(found.select("group", F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("doc"), "th"), "fingerprint-groups")
    first = found.groupBy("group").agg(F.min(F.struct("none", "doc", "th")).alias("first"))
    lost = found.join(first, "group").where(F.struct("none", "doc", "th") != F.col("first")).select("doc", "th").distinct()
    again = materialize(found.groupBy("doc", "th").count().where("count > 1").select("doc", "th"), "repeated-rows")
    keyed = docs.select(F.struct("*").alias("row"), F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("doc"), text_hash(docs).alias("th"))
    left = keyed.join(lost, ["doc", "th"], "left_anti")
    if again.isEmpty():
        return left.select("row.*")
    once = left.join(again, ["doc", "th"], "left_semi").groupBy("doc", "th").agg(F.first("row").alias("row"))
    return left.join(again, ["doc", "th"], "left_anti").select("row.*").union(once.select("row.*"))
