"""Quality classifier: supervised subword embeddings.

A document is the average of learned hashed vectors, one per word and one per character n-gram of a word; a softmax layer
gives class probabilities. Vectors and layer are trained together by stochastic gradient descent in numpy. A word equal
to the one before it also gives a token of its own, so that stuttering text is seen whatever the word. As
averaging and layer are linear, scoring sums one precomputed logit per word.

Training uses at most `sample` labelled rows outside the held-out fold, in the order of a hash of their ids, and of them as many as
have SAMPLE_BYTES of counted features; these are counted on the executors, and one task trains on them. Every document is scored whole.

A null or empty text has no features: its score is the model's prior alone. Null labels are no labels; of several labels
for an id the largest counts. Null doc_ids are scored. Repeated rows are scored again; without labels, or with one
class, the score is that class' share (0.5 without any). Columns other than doc_id, text and the label are ignored; keep_good keeps them,
whatever their names, and all repeated rows.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MEMOS, blocks, held_out, map_blocks, materialize, read_table, spread

WORD = re.compile("[^ \u0009-\u000d]+")
SAMPLE, BUCKETS, DIM, EPOCHS, RATE, SEED, GRAMS, MEMO = 3000, 1 << 18, 8, 8, 0.5, 11, (3, 5), 300_000
TOGETHER = 1_000_000  # characters of text scored at once
SAMPLE_BYTES = 64_000_000
AGAIN = " again"  # no word: it has a space
THRESHOLD = 0.7


FACTOR, LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)


def bucket(x: np.ndarray, salt: int, buckets: int) -> np.ndarray:
    """A bucket for each 64-bit number."""
    x = (x + np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (((x >> LAST) * np.uint64(buckets)) >> LAST).astype("i8")


def features_of(words: list[str], buckets: int = BUCKETS, grams: tuple[int, int] = GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, and which word each is of: the word itself, and its character n-grams with the ends marked."""
    sizes = np.fromiter(map(len, words), "i8", len(words)) + 2
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = ends[owner] - np.arange(len(codes))  # characters up to the word's end
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), FACTOR))
    whole = np.add.reduceat(codes * powers[left - 1], ends - sizes) if words else codes
    ids, of = [bucket(whole, 1, buckets)], [np.arange(len(words))]
    plain = np.array([w != AGAIN for w in words], bool)[owner] if AGAIN in words else None
    rolled = codes
    for n in range(2, grams[1] + 1):
        rolled = rolled[:-1] * FACTOR + codes[n - 1 :]
        if n >= grams[0]:
            fits = left[: len(rolled)] >= n
            at = np.flatnonzero(fits if plain is None else fits & plain[: len(rolled)])
            ids.append(bucket(rolled[at], n, buckets))
            of.append(owner[at])
    return np.concatenate(ids), np.concatenate(of)


def feature_number(length: int, grams: tuple[int, int] = GRAMS) -> int:
    """How many features a word of this length has."""
    return 1 + sum(max(length + 3 - n, 0) for n in range(grams[0], grams[1] + 1))


LENGTHS = [feature_number(n) for n in range(64)]


def tokens_of(text: str) -> Counter:
    words = WORD.findall(text)
    out = Counter(words)
    again = sum(map(str.__eq__, words, words[1:]))
    if again:
        out[AGAIN] += again
    return out


def feature_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns keep, and the document's feature numbers (ascending, little-endian i4 bytes) and counts (f4 bytes)."""

    def run(batch: pa.RecordBatch, texts: list[str]) -> dict:
        ids, counts = [], []
        for text in texts:
            tokens = tokens_of(text)
            every, of = features_of(list(tokens))
            own, at = np.unique(every, return_inverse=True)
            ids.append(own.astype("<i4").tobytes())
            counts.append(np.bincount(at, np.array(list(tokens.values()), "f8")[of], len(own)).astype("<f4").tobytes())
        return {c: batch.column(batch.schema.get_field_index(c)) for c in keep} | {"ids": ids, "counts": counts}

    kinds = dict(docs.dtypes)
    return map_blocks(docs.select(*keep, "text"), run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", ids binary, counts binary")


#: Words' logits by the key of the one model that a worker scores with.
_logits: dict[str, dict[str, float]] = {}
MEMOS["quality"] = _logits.clear


class Model:
    """Collapsed model: the logit that each feature adds, and the bias."""

    def __init__(self, logits: np.ndarray, bias: float):
        self.logits, self.bias = logits, bias
        self.key = uuid.uuid4().hex

    def words(self, words: list[str]) -> list[float]:
        """The sum of each word's features' logits."""
        ids, of = features_of(words, len(self.logits))
        return np.bincount(of, self.logits[ids], len(words)).tolist()

    def scores(self, texts: list[str]) -> list[float]:
        """A text's words are summed exactly: their order makes no difference."""
        out: list[float] = []
        at = 0
        while at < len(texts):  # as many texts together as bound the new words
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= TOGETHER:
                size += len(texts[end])
                end += 1
            out += self._scores([WORD.findall(t) for t in texts[at:end]])
            at = end
        return out

    def _scores(self, cuts: list[list[str]]) -> list[float]:
        every = set().union(*cuts, (AGAIN,))
        known = _logits.get(self.key, {})
        if len(known) + len(every.difference(known)) > MEMO:  # the words of this call are in use, others go
            known = {}
        if _logits.get(self.key) is not known:
            _logits.clear()
            _logits[self.key] = known
        fresh = list(every.difference(known))
        for k in range(0, len(fresh), 20_000):
            part = fresh[k : k + 20_000]
            known.update(zip(part, self.words(part)))
        out = []
        for words in cuts:
            sizes = list(map(len, words))
            again = sum(map(str.__eq__, words, words[1:]))
            total = math.fsum(map(known.__getitem__, words)) + again * known[AGAIN]
            n = sum(map(LENGTHS.__getitem__, sizes)) if max(sizes, default=0) < len(LENGTHS) else sum(map(feature_number, sizes))
            out.append(float(1 / (1 + math.exp(-min(max(total / max(n + again, 1) + self.bias, -40.0), 40.0)))))
        return out

    def score(self, text: str) -> float:
        return self.scores([text])[0]


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Rows of (feature numbers, counts, label 0 or 1)."""
    share = sum(y for *_, y in rows) / len(rows) if rows else 0.5
    if not rows or share in (0, 1):
        return Model(np.zeros(buckets), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype("f4")
    layer, bias = np.zeros((2, dim), "f4"), np.log(np.array([1 - share, share], "f4"))
    data = [(i, c / max(c.sum(), 1) if len(c) else c, y) for i, c, y in rows]
    steps, at = epochs * len(data), 0
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            ids, weights, y = data[k]
            lr = rate * (1 - at / steps)
            at += 1
            hidden = weights @ vectors[ids]
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = layer.T @ p
            layer -= lr * np.outer(p, hidden)
            bias -= 0.05 * lr * p
            if len(ids):
                # the mean's gradient is spread over the features; scaled up so that long documents learn as fast
                vectors[ids] -= np.outer(weights * np.float32(lr / max(float(weights.max()), 1e-6)), back)
    gap = (layer[1] - layer[0]).astype("f8")
    return Model((vectors.astype("f8") @ gap), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", sample: int = SAMPLE, **settings) -> Model:
    """Fits on a bounded sample of labelled rows of the training folds."""
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # at most `sample` rows: small enough to broadcast
    rows = feature_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id"), ["doc_id", "y"])
    rows = materialize(rows, "sample-features")
    sizes = rows.groupBy("doc_id").agg(F.sum(F.length("ids")).alias("n")).collect()  # at most `sample` rows
    room, small = SAMPLE_BYTES, []
    for doc_id, n in sorted(map(tuple, sizes), key=lambda r: (r[1], r[0])):
        room -= 2 * n
        if room < 0:
            break
        small.append(doc_id)
    rows = rows.where(F.col("doc_id").isin(small)) if room < 0 else rows

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[:2])
        model = train([(np.frombuffer(i, "<i4"), np.frombuffer(c, "<f4"), y) for _, i, y, c in found], **settings)
        yield pa.record_batch([pa.array([model.logits.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], names=["logits", "bias"])

    # one task trains, of SAMPLE_BYTES at most: the driver gets the model alone
    made = rows.select("doc_id", "ids", "y", "counts").coalesce(1).mapInArrow(trained, "logits binary, bias double").first()
    return Model(np.frombuffer(bytes(made["logits"]), "f8"), made["bias"]) if made else train([], **settings)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    def run(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "score": shared.value.scores(texts)}

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").alias("text"))
    return map_blocks(own, run, "doc_id long, held_out boolean, score double", memo="quality").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents"))
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier accepts, with all their columns. A row with a null or empty text has the prior's score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, memo="quality"):
            yield batch.filter(pa.array([x >= threshold for x in shared.value.scores(texts)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
