"""Toxicity: noisy-channel deobfuscation, then scoring of the restored text.

Every token that can be read in more than one way is a lattice: look-alike signs stand for letters, separators between
characters may be dropped, a letter written twice may be written once, one written three times or more once or twice. Runs of short
pieces (at most SHORT characters each) over any white space are lattices too, whose white space may be dropped. Viterbi decoding under a
character language model takes the likeliest reading, over all contexts; the plain reading is one of them. Tokens with one reading pass
through, which is what decoding would give. Only the restored text is scored.
The model counts four-character sequences over the whole corpus, so its statistics grow with the input while its table has
a fixed size (32^4). A restored word's evidence is the greatest log odds of those of it and its beginnings that are significantly
more frequent in toxic documents; a logistic curve turns a document's summed evidence into a probability.

The classifier uses at most `sample` labelled rows outside the held-out fold, in the order of a hash of their ids, and keeps the
FEATURES words and beginnings of greatest association.

A null or empty text has no words: its score is that of no evidence. Null labels are no labels; of several labels of an id the
largest counts. Null doc_ids and repeated rows are scored. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, held_out, map_blocks, materialize, read_table, spread

SAMPLE, FEATURES, SIGNIFICANT, THRESHOLD, MEMO = 6000, 4000, 22.0, 0.3, 300_000
#: Look-alike signs and the letters that they may stand for.
LOOKALIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l"}
SEPARATORS = frozenset(" .-_*~'`,·•/\\")
EDGE = ".,;:!?\"()[]{}<>|*$%&#=/\\~_-+'`«»¿¡…·•@^"
#: Log-probabilities of the channel: a sign for a letter, a separator put in, a letter repeated; of leaving a sign as it is; of a letter written twice for once, and of a sign put in.
SIGN, DROP, REPEAT, ASIS, DOUBLE, PUT = -1.0, -1.2, -0.4, -6.0, -2.0, -2.5
WORD = re.compile("[^ \u0009-\u000d]+")
TWICE = re.compile(r"([^\W\d_])\1")
UNSURE = re.compile(r"[\W\d_]|([^\W\d_])\1")  # where a token may begin to have several readings
SHORT = 3
RUN = re.compile(r"(?<!\S)\S{1,%d}(?:\s+\S{1,%d})+(?!\S)" % (SHORT, SHORT))
RUNS = re.compile(f"({RUN.pattern})")
ORDER, SYMBOLS = 4, 32


def symbol(c: str) -> int:
    """Language-model symbol: 0 for a boundary, 1 to 26 for a to z, the rest for other letters."""
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 5 if c.isalpha() else 0


_symbols: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    if not _symbols:
        table = np.zeros(0x110000, "u1")
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                table[code] = symbol(c)
        _symbols.append(table)
    return _symbols[0]


def sequences(texts: list[str]) -> np.ndarray:
    """Counts of ORDER symbols in a row over lower-cased texts, boundaries collapsed."""
    codes = symbol_table()[np.frombuffer((" " + " \n ".join(texts).lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")].astype("i4")
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
    if len(codes) < ORDER:
        return np.zeros(SYMBOLS**ORDER, "i8")
    packed = ((codes[:-3] * SYMBOLS + codes[1:-2]) * SYMBOLS + codes[2:-1]) * SYMBOLS + codes[3:]
    return np.bincount(packed, minlength=SYMBOLS**ORDER)


def language_model(docs: DataFrame) -> np.ndarray:
    """log P(symbol | three before it), interpolated, from all documents. A partition gives one row per sequence it has, 32^4 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**ORDER, "i8")
        for _, texts in blocks(batches):
            total += sequences(texts)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("i4")), pa.array(total[at])], names=["s", "n"])

    rows = docs.select("text").mapInArrow(run, "s int, n long").groupBy("s").agg(F.sum("n").alias("n")).toPandas()  # 32^4 rows at most
    counts = np.zeros(SYMBOLS**ORDER)
    counts[rows["s"].to_numpy("i8")] = rows["n"].to_numpy("f8")
    return smooth(counts)


def smooth(counts: np.ndarray) -> np.ndarray:
    table = counts.reshape((SYMBOLS,) * ORDER)
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        level = table.sum(axis=tuple(range(ORDER - order))) if order < ORDER else table
        context = level.sum(axis=-1, keepdims=True)
        kinds = (level > 0).sum(axis=-1, keepdims=True)
        lower = (level + (kinds + 1) * lower) / (context + kinds + 1)  # Witten-Bell
    return np.log(lower).astype("f4").reshape(-1, SYMBOLS)


class Channel:
    """Restores tokens; costs are log-probabilities."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.flat = model.ravel().tolist()  # numbers that Python reads fast
        self.memo: dict[str, tuple[str, ...]] = {}
        self.runs: dict[str, tuple[str, ...]] = {}

    def __getstate__(self) -> np.ndarray:
        return self.model

    def __setstate__(self, model: np.ndarray) -> None:
        self.__init__(model)

    def readings(self, token: str) -> list[list[tuple[str, float]]]:
        """For each character what it may stand for ("" if dropped), with its channel cost."""
        out: list[list[tuple[str, float]]] = []
        run = 0
        for i, c in enumerate(token):
            run = run + 1 if i and token[i - 1] == c else 1
            long_run = run >= 3 or (token[i + 1 : i + 2] == c and (run == 2 or token[i + 2 : i + 3] == c))
            if c in LOOKALIKE:
                options = [(x, SIGN) for x in LOOKALIKE[c]] + [(" ", ASIS)]
                if not c.isdigit():
                    options.append(("", PUT))
            elif c in SEPARATORS:
                options = [("", DROP), (" ", 0.0)]
            elif c.isalpha():
                options = [(c, 0.0)]
                if long_run and run > 1:
                    options.append(("", REPEAT))
                elif long_run:
                    options = [(c, REPEAT)]
                elif run == 2:
                    options.append(("", DOUBLE))
            else:
                options = [(" ", 0.0)]
            out.append(options)
        return out

    def decode(self, token: str) -> str:
        """The likeliest reading of a token; boundaries come out as spaces. Of equal ones the greatest text.

        Letters before the first choice and, once one reading is left, behind the last one are taken over: all readings share them.
        """
        flat, context = self.flat, SYMBOLS**3
        first = UNSURE.search(token)
        sure = token[: first.start()] if first else token
        if not sure.isalpha():
            sure = ""
        begin = 0
        for c in sure[-3:]:
            begin = begin * SYMBOLS + symbol(c)
        rest = token[len(sure) :]
        lattice = self.readings(rest)
        last = len(lattice) - 1
        while last >= 0 and len(lattice[last]) == 1:
            last -= 1
        states: dict[int, tuple[float, str]] = {begin: (0.0, sure)}
        for i, options in enumerate([*lattice, [(" ", 0.0)]]):
            if i > last and len(states) == 1:
                tail = rest[i:]
                if not tail or tail.isalpha():
                    return (next(iter(states.values()))[1] + tail).strip()
            if len(options) == 1 and len(states) == 1:  # one way on
                (state, (score, text)), ((c, cost),) = next(iter(states.items())), options
                s = symbol(c)
                if s or state % SYMBOLS:
                    at = state * SYMBOLS + s
                    states = {at % context: (score + cost + flat[at], text + c)}
                else:
                    states = {state: (score + cost, text)}
                continue
            known = [(c, symbol(c) if c else -1, cost) for c, cost in options]
            after: dict[int, tuple[float, str]] = {}
            for state, (score, text) in states.items():
                edge = state % SYMBOLS == 0
                for c, s, cost in known:
                    if s < 0 or (s == 0 and edge):
                        to, new = state, (score + cost, text)
                    else:
                        at = state * SYMBOLS + s
                        to, new = at % context, (score + cost + flat[at], text + c)
                    best = after.get(to)
                    if best is None or new > best:
                        after[to] = new
            states = after  # at most 32^3
        return max(states.values())[1].strip()

    def token(self, token: str) -> tuple[str, ...]:
        """The words that a token stands for."""
        known = self.memo.get(token)
        if known is not None:
            return known
        if token.isalpha() and not TWICE.search(token):
            self.memo[token] = found = (token,)
            return found
        core = token.strip(EDGE)
        at = token.find(core) if core else 0
        if core and at and token[at - 1] in "@$!|(" and core[0].isalpha() and (at == 1 or token[at - 2] != token[at - 1]):
            core = token[at - 1] + core
        end = token[at + len(token.strip(EDGE)) :] if core else ""
        if core and end and end[0] in "@$" and end[:3] not in ("$$$", "@@@"):
            core += end[: 2 if end[:2] == end[0] * 2 else 1]
        if not core and len(token) > 2 and sum(c in "@$" for c in token) > 1 and len(set(token)) > 1:
            core = token.strip(".,;:?\"")  # signs alone, of several kinds
        if core.isalpha() and not TWICE.search(core):
            words: tuple[str, ...] = (core,)
        elif not any(c.isalpha() or c in LOOKALIKE for c in core):
            words = ()  # no letter in any reading
        else:
            words = tuple(w for w in self.decode(core).split() if len(w) > 1)
        self.memo[token] = words
        return words

    def run(self, run: str) -> tuple[str, ...]:
        """The words of a run of short pieces."""
        known = self.runs.get(run)
        if known is None:
            known = self.runs[run] = tuple(w for w in self.decode(run).split() if len(w) > 1)
        return known

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a text."""
        parts = RUNS.split(text.lower())  # by turns without and with runs
        tokens = set(WORD.findall(" ".join(parts[::2])))
        for token in tokens.difference(self.memo):
            self.token(token)
        out = set(chain.from_iterable(map(self.memo.__getitem__, tokens)))
        for run in {" ".join(found.split()) for found in set(parts[1::2])}:
            out.update(self.run(run))
        if len(self.memo) > MEMO:
            self.memo.clear()
        if len(self.runs) > MEMO // 3:
            self.runs.clear()
        return out


def features_of(word: str) -> list[str]:
    """The word and its beginnings, accents kept."""
    word = unicodedata.normalize("NFC", word)
    return [word + "$"] + [word[:n] for n in (4, 5, 6) if len(word) > n]


class Scorer:
    def __init__(self, channel: Channel, weights: dict[str, float], bias: float, slope: float = 1.0):
        self.channel, self.weights, self.bias, self.slope = channel, weights, bias, slope
        self.memo: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def word(self, word: str) -> float:
        known = self.memo.get(word)
        if known is None:
            known = self.memo[word] = max((self.weights.get(f, 0.0) for f in features_of(word)), default=0.0)
        return known

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-min(max(self.bias + self.slope * self.evidence(text), -40.0), 40.0)))

    def evidence(self, text: str) -> float:
        return self.total(self.channel.words(text))

    def total(self, words: set[str]) -> float:
        """The summed evidence of words."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        for word in words.difference(self.memo):
            self.word(word)
        return math.fsum(map(self.memo.__getitem__, words))


def association(a: Column, b: Column, n1: int, n0: int) -> Column:
    """G-squared of a feature's presence (in a toxic and b clean documents) against the label."""
    rate = (a + b) / (n1 + n0)

    def part(k: Column, n: int) -> Column:
        inside, outside = (F.when((x > 0) & (r > 0), x * F.log(x / (n * r))).otherwise(0.0) for x, r in ((k, rate), (n - k, 1 - rate)))
        return inside + outside

    return 2 * (part(a, n1) + part(b, n0))


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", sample: int = SAMPLE) -> Scorer:
    """Language model over all documents, then the classifier on a bounded sample of labelled rows of the training folds."""
    spark = docs.sparkSession
    channel = Channel(language_model(docs))
    shared = spark.sparkContext.broadcast(channel)  # a table of 32^4 numbers
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("doc_id", "y", "text")

    def restored(batch: pa.RecordBatch, texts: list[str]) -> dict:
        words = [shared.value.words(t) for t in texts]
        return {"doc_id": batch.column(0), "y": batch.column(1), "w": [sorted(ws) for ws in words], "m": [signature(ws) for ws in words]}

    rows = materialize(map_blocks(texts, restored, "doc_id long, y int, w array<string>, m array<long>"), "restored-sample")
    # near copies count once: their common words are no independent evidence
    signed = sorted((r["doc_id"], r["y"], r["m"]) for r in rows.select("doc_id", "y", "m").collect())
    kept = set(independent([(d, m) for d, _, m in signed]))
    n1, n0 = (len({d for d, y, _ in signed if d in kept and (y == 1) == one}) for one in (True, False))
    if not n1 or not n0:
        return Scorer(channel, {}, math.log((n1 + 0.5) / (n0 + 0.5)) if n1 + n0 else 0.0)
    ids = spark.createDataFrame([(d,) for d in sorted(kept)], "doc_id long")

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({f for w in ws or () for f in features_of(w)}) for ws in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["y", "f"])

    own = rows.join(F.broadcast(ids), "doc_id").select("y", "w").mapInArrow(present, "y int, f array<string>")
    a, b = (F.sum(F.expr(f"int(y {sign} 1)")) for sign in ("=", "<>"))
    counts = own.select("y", F.explode("f").alias("f")).groupBy("f").agg(a.alias("a"), b.alias("b")).where(f"a >= 2 and a * {n0} > 3 * b * {n1}")
    counts = counts.withColumn("g", association(F.col("a"), F.col("b"), n1, n0)).where(F.col("g") >= SIGNIFICANT)
    chosen = counts.orderBy(F.desc("g"), "f").limit(FEATURES).collect()
    weights = {r["f"]: math.log((r["a"] + 0.5) / (r["b"] + 0.5) * (n0 + 1) / (n1 + 1)) for r in chosen}
    first = spark.sparkContext.broadcast(Scorer(channel, weights, 0.0))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [first.value.total(set(ws or ())) for ws in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["doc_id", "y", "e"])

    data = rows.select("doc_id", "y", "w").mapInArrow(weighed, "doc_id long, y int, e double").toPandas().sort_values(["doc_id", "e"])  # at most `sample` ids
    return Scorer(channel, weights, *logistic(data["e"].to_numpy("f8"), np.minimum(data["y"].to_numpy("f8"), 1)))


def signature(words: set[str], n: int = 8) -> list[int]:
    """Minimum hashes of a word set."""
    if not words:
        return []
    h = np.array([zlib.crc32(w.encode()) for w in words], "u8")
    salts = np.arange(1, n + 1, dtype="u8") * np.uint64(0x9E3779B97F4A7C15)
    x = (h[None, :] + np.uint64(1)) * (salts[:, None] | np.uint64(1))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(1)).min(axis=1).astype("i8").tolist()


def independent(rows: list[tuple[int, list[int]]], shared: int = 5) -> list[int]:
    """Ids of rows, in order, that share fewer than `shared` minimum hashes with each one kept before."""
    posting: dict[tuple[int, int], list[int]] = {}
    kept = []
    for doc_id, found in rows:
        met: dict[int, int] = {}
        for key in enumerate(found):
            for other in posting.get(key, ()):
                met[other] = met.get(other, 0) + 1
        if max(met.values(), default=0) < shared:
            kept.append(doc_id)
            for key in enumerate(found):
                posting.setdefault(key, []).append(doc_id)
    return kept


def logistic(e: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1.0) -> tuple[float, float]:
    """Bias and slope of the label's log odds in the evidence; the slope is drawn to 1 and stays above 0.2."""
    b, w = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(b + w * e, -40, 40)))
        r = p * (1 - p) + 1e-9
        g = np.array([(p - y).sum(), ((p - y) * e).sum() + ridge * (w - 1)])
        h = np.array([[r.sum() + 1e-3, (r * e).sum()], [(r * e).sum(), (r * e * e).sum() + ridge]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        b, w = b - step[0], max(w - step[1], 0.2)
    return float(b), float(w)


def score(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # the language model and at most FEATURES weights

    def run(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "score": [shared.value.score(t) for t in texts]}

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").alias("text"))
    return map_blocks(own, run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op5_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents"))
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
