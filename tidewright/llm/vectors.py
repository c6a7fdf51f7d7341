"""Embedding near-duplicates by collision-counting projections.

Vectors of one label (and length) are projected on many random directions. In each projection a query's window is centred on the
query; a pair collides where one lies in the other's window. Pairs that collide in at least `needed` of the projections are
verified by cosine in double precision. `needed` is calibrated: the greatest count that a pair at the threshold
reaches with probability `recall`; nearer pairs reach it more surely.

Distribution: equal vectors are one entry with a multiplicity. Entries meet in tables: a table cuts `m` projections of its own into cells
of width CELL with random shifts, and its buckets are the entries of one label in one cell of each. `m` grows with the logarithm of a label's
size, so that buckets keep theirs, and there are as many tables as let a pair at the threshold share a bucket with probability `recall`.
So every entry is sent to a number of buckets that hardly grows, and nothing is compared across a whole label. Windows are counted
inside a bucket; a pair counts in the first table where it shares a bucket. Buckets above `slab` entries are cut into blocks, each
pair of blocks a row group of its own. Tasks give per-entry sums of link counts and a spanning forest, never pairs. A cluster whose
members are all linked costs as much as it has links.

Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do rows with a null label: no links, a component of
their own. Repeated rows count as links of each other. A null vec_id takes part under no id: it is not counted. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import mix
from .common import materialize
from .graph import components

COSINE, PROJECTIONS, WINDOW, RECALL, SLAB, SEED = 0.98, 24, 1.5, 0.9999999, 2048, 5
#: Width of a cell in standard deviations of a projected difference at the threshold; entries that a bucket should have; least m.
CELL, BUCKET, LEAST = 10.0, 1024, 3


def needed_collisions(projections: int, window: float, recall: float) -> int:
    """The greatest count that a pair at the threshold reaches with at least this probability. window: in standard deviations."""
    p = math.erf(window / math.sqrt(2))
    tail = 0.0
    for k in range(projections, -1, -1):
        tail += math.comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if tail >= recall:
            return k
    return 0


def directions(n: int, count: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, n]).standard_normal((n, count))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def table_shape(size: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Projections of a table and number of tables for a label of so many entries."""
    sigma = math.sqrt(max(2 - 2 * cosine, 0.0))
    apart = 1 / CELL * math.sqrt(2 / math.pi)  # that a cell's bound lies between two vectors at the threshold
    share = min(max(CELL * sigma / math.sqrt(4 * math.pi), 0.05), 0.9)  # that two unrelated vectors lie in one cell, about
    m = max(LEAST, math.ceil(math.log(max(size / BUCKET, 1)) / -math.log(share)))
    return m, math.ceil(math.log(1 - recall) / math.log(1 - (1 - apart) ** m))


def bucket_keys(units: np.ndarray, m: int, tables: int, cosine: float = COSINE) -> np.ndarray:
    """The 32-bit key of each unit vector in each table."""
    width = CELL * math.sqrt(max(2 - 2 * cosine, 0.0)) or 1e-9
    shifts = np.random.default_rng([SEED, 2]).random((tables, m))
    cells = np.floor(units @ directions(units.shape[1], tables * m, SEED + 1) / width + shifts.ravel()).astype("i8").view("u8").reshape(len(units), tables, m)
    key = np.zeros((len(units), tables), "u8")
    for k in range(m):
        key = mix(key ^ cells[:, :, k] + np.uint64(0x9E3779B97F4A7C15))
    return (key >> np.uint64(32)).astype("u4").view("i4")


def linked_pairs(x: np.ndarray, y: np.ndarray | None, cosine: float = COSINE, projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs between unit vectors x and y (or within x): window collisions counted, then cosine."""
    a = directions(x.shape[1], projections)
    width = window * math.sqrt(max(2 - 2 * cosine, 0.0))
    least = needed_collisions(projections, window, recall)
    px = (x @ a).T
    py = px if y is None else (y @ a).T
    order = np.argsort(py, axis=1)  # every projection sorted once
    rank = np.empty(py.shape, "i4")
    np.put_along_axis(rank, order, np.arange(py.shape[1], dtype="i4")[None, :], axis=1)
    values = np.take_along_axis(py, order, axis=1)
    # a query's window as a range of ranks
    low, high = (np.array([np.searchsorted(v, q + w, side=side) for v, q in zip(values, px)], "i4") for w, side in ((-width, "left"), (width, "right")))
    found_i, found_j = [], []
    for at in range(0, len(x), 256):
        tally = np.zeros((min(256, len(x) - at), py.shape[1]), "u1")
        for p in range(projections):
            tally += (rank[p] >= low[p, at : at + 256, None]) & (rank[p] < high[p, at : at + 256, None])
        i, j = np.nonzero(tally >= least)
        if y is None:
            i, j = i[i + at < j], j[i + at < j]
        i += at
        if len(i):
            hit = np.einsum("ij,ij->i", x[i], (x if y is None else y)[j]) >= cosine
            found_i.append(i[hit])
            found_j.append(j[hit])
    none = np.zeros(0, "i8")
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (none, none)


def tree(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each row's component under the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _deal(cosine: float, kind: str | None = None):  # noqa: ANN202
    """A row for every table of an entry: its bucket; with a kind of number also the entry, its keys of all tables, and the vector's bytes."""
    names = ["group", "tab", "key", *(["node", "n", "keys", "raw"] if kind else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n, group, size, raw = (batch.column(k).to_pylist() for k in range(5))
            shapes = [(*table_shape(s, cosine), len(v)) for s, v in zip(size, raw)]
            for shape in sorted(set(shapes)):
                own = [i for i, found in enumerate(shapes) if found == shape]
                vectors = np.array([raw[i] for i in own], "f8")
                keys = bucket_keys(unit(vectors), *shape[:2], cosine)
                groups = pa.array([group[i] for i in own])
                rest = [pa.array([node[i] for i in own], pa.int64()), pa.array([n[i] for i in own], pa.int64()), pa.array([k.tobytes() for k in keys], pa.binary()), pa.array([v.tobytes() for v in vectors.astype(kind)], pa.binary())] if kind else []
                for t in range(shape[1]):
                    yield pa.RecordBatch.from_arrays([groups, pa.array([t] * len(own), pa.int32()), pa.array(keys[:, t]), *rest], names=names)

    return run


def _compare(cosine: float, kind: str):  # noqa: ANN202
    """Buckets (or pairs of blocks of one), sorted: sums of links and a spanning forest of each."""

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        near, far = ([r for r in rows if r[5] == side] for side in (0, 1))
        every, table = near + far, rows[0][1]
        if len(every) < 2 or (rows[0][3] != rows[0][4] and not (near and far)):
            return
        units = unit(np.array([np.frombuffer(r[9], kind) for r in every], "f8"))
        i, j = linked_pairs(units[: len(near)], units[len(near) :] if far else None, cosine)
        if not len(i):
            return
        j = j + len(near) if far else j
        node, count = np.array([r[6] for r in every], "i8"), np.array([r[7] for r in every], "i8")
        keys = np.array([np.frombuffer(r[8], "<i4")[:table] for r in every], "i4").reshape(len(every), table)
        root = tree(len(every), i, j)
        new = np.concatenate([~(keys[i[k : k + 65_536]] == keys[j[k : k + 65_536]]).any(axis=1) for k in range(0, len(i), 65_536)])  # met in no table before
        i, j = i[new], j[new]
        total = np.bincount(i, count[j], len(every)).astype("i8") + np.bincount(j, count[i], len(every)).astype("i8")
        own, moved = np.flatnonzero(total), np.flatnonzero(root != np.arange(len(every)))
        yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(total[own]), pa.nulls(len(own), pa.int64())], names=["a", "n", "b"])
        yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.nulls(len(moved), pa.int64()), pa.array(node[root[moved]])], names=["a", "n", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:5] != held[0][:5]:
                    yield from settle(held)
                    held = []
                held.append(row)
        if held:
            yield from settle(held)

    return run


def near_duplicates(rows: DataFrame, cosine: float = COSINE, slab: int = SLAB) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding, label)."""
    v = F.col("embedding")
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(v, lambda c: c != 0)
    base = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    base = base.withColumn("ok", F.coalesce(usable, F.lit(False)))
    keyed = base.withColumn("k1", F.when(F.col("ok"), F.xxhash64("label", "embedding"))).withColumn("k2", F.when(F.col("ok"), F.xxhash64(F.lit(1), "embedding", "label")))
    entries = keyed.where("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    entries = entries.select("node", "n", F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string")).alias("group"), "embedding")
    units = materialize(entries, "vector-entries")

    sizes = units.groupBy("group").agg(F.count("*").alias("size"))
    sized = units.join(sizes, "group").select("node", "n", "group", "size", "embedding")
    kind = "<f4" if dict(rows.dtypes)["embedding"] == "array<float>" else "<f8"
    bucket = ["group", "tab", "key"]
    large = sized.mapInArrow(_deal(cosine), "group string, tab int, key int").groupBy(*bucket).agg(F.count("*").alias("rows"))
    large = materialize(large.where(F.col("rows") > slab), "large-buckets")  # no hint: small tables are broadcast, others joined
    dealt = sized.mapInArrow(_deal(cosine, kind), "group string, tab int, key int, node long, n long, keys binary, raw binary").join(large, bucket, "left")
    placed = dealt.withColumn("blocks", F.coalesce(F.ceil(F.col("rows") / max(slab // 2, 1)), F.lit(1)).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    placed = placed.select(*bucket, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.expr("if(own > other, 1, 0)").alias("side"), "node", "n", "keys", "raw")
    placed = placed.repartition(*bucket, "i", "j").sortWithinPartitions(*bucket, "i", "j", "side", "node")
    found = materialize(placed.mapInArrow(_compare(cosine, kind), "a long, n long, b long"), "vector-links")

    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("links"))
    joined = components(found.where("b is not null").select("a", "b"))
    labelled = units.select("node", F.col("n").alias("same")).join(counts, F.col("node") == F.col("a"), "left").join(joined, "node", "left")
    labelled = labelled.select(F.col("node"), (F.coalesce("links", F.lit(0)) + F.col("same") - 1).alias("links"), F.coalesce("component", "node").alias("component"))
    named = keyed.where("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("node")).join(labelled, "node").select("k1", "k2", "links", "component")
    out = keyed.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op10_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
