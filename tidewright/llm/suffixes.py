"""Removal of repeated passages by suffix arrays, over whole texts as UTF-8 bytes.

A byte goes if a `LENGTH`-byte string that covers it also starts earlier: in a smaller doc_id, or before in its document.

1. Anchors (see anchors.py) split every text into regions; equal windows lie in regions of one k-gram hash.
   A block first settles its own equal regions, so a hot passage leaves a block once.
2. Equal regions meet by k-gram hash and a 128-bit hash of their bytes: all but the earliest go whole, as each of their windows starts
   earlier there. Of k-gram hashes with several contents, one region of each content is asked for as text. Contents beyond the second
   of a k-gram hash in a partition are known to have company, so at most two a partition are counted by hash: a hot one is spread.
3. The asked regions meet by k-gram hash. A suffix array is built over blocks of whole groups by two-stage sorting: only suffixes smaller
   than their successors are sorted directly, the others are induced by scanning the buckets; common prefixes of adjacent
   suffixes give the classes of equal windows, and in each class all but the earliest are removed.
   A group of more than GROUP contents is first split: its regions are cut anew by longer k-grams (GRAMS), so that its parts share more
   bytes; equal parts are settled by their bytes, the rest goes to suffix arrays as before.
4. Spans are collected per document and cut out.

Null text: empty. A null doc_id comes before all others. Rows that share a doc_id and the text are one document's copies and
keep or lose the same bytes; rows that share a doc_id (or have none) with different texts are different documents, in the order of a hash
of their texts. Texts below LENGTH bytes lose nothing. An empty table gives no rows; other columns are ignored (keep_unique keeps them,
whatever their names).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import GRAM, LENGTH, SEGMENT, changes, contents, joined, regions
from .common import blocks, fresh, materialize, read_table, release

SEPARATOR = 0xFF  # in no UTF-8 text
GROUP, BLOCK_BYTES, NULL_ID = 2_000, 2_000_000, -(1 << 63)
GRAMS = (64, 92, LENGTH)  # the last makes every window a region of its own: such a group has one content
CHUNK, ROWS = 1 << 18, 8192  # positions read at once; rows of a batch of region texts
SPANS = "doc long, th long, start long, stop long"
MET = "kind byte, h long, w1 long, w2 long, doc long, th long, start long, size long"
PARTS = "h long, doc long, th long, start long, part binary"


# --- the suffix array -------------------------------------------------------------------------------------------------


def words_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as a big-endian number; text is padded by eight at least."""
    views, out = np.lib.stride_tricks.sliding_window_view(text, 8), np.empty(len(at), "u8")
    for k in range(0, len(at), CHUNK):
        out[k : k + CHUNK] = np.ascontiguousarray(views[at[k : k + CHUNK]]).view(">u8").ravel()
    return out


def sort_directly(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first depth bytes, eight more for tied runs at a time."""
    if not len(at):
        return at
    key = words_at(text, at)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    run = np.cumsum(new, dtype="i4")
    for reach in range(8, depth, 8):
        tied = ~new
        tied[:-1] |= ~new[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        key = words_at(text, np.minimum(at[where] + reach, len(text) - 8))
        order = np.lexsort((key, run[where]))
        at[where] = at[where][order]
        key, own = key[order], run[where]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
        new[where] = fresh
        run = np.cumsum(new, dtype="i4")
    return at


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of text[:-depth-8] (a padded text, below 2 GB) in the order of their first depth bytes at least, by two-stage sorting."""
    n = len(text) - depth - 8
    t = text[:n]
    change = np.flatnonzero(t[1:] != t[:-1]) if n > 1 else np.zeros(0, "i8")
    smaller = np.zeros(n, bool)  # than the successor; a last run is greater than the empty suffix
    if len(change):
        rises = t[change + 1] > t[change]
        lengths = np.diff(np.concatenate([[-1], change]))
        smaller[: change[-1] + 1] = np.repeat(rises, lengths)
    direct = sort_directly(text, np.flatnonzero(smaller).astype("i4"), depth)
    first = t[direct]
    bounds = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[int(t[-1])].append(np.array([n - 1], "i4"))
    out = []
    for c in range(256):
        part = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, "i4")
        waiting[c], levels = [], []
        while len(part):  # the greater suffixes of the bucket: induced ones, then those that they induce in it
            levels.append(part)
            part = part[part > 0] - 1
            part = part[(t[part] == c) & ~smaller[part]]
        bucket = np.concatenate([*levels, direct[bounds[c] : bounds[c + 1]]]) if levels else direct[bounds[c] : bounds[c + 1]]
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[t[before] > c]
        if len(before):
            symbol = t[before]
            order = np.argsort(symbol, kind="stable")
            before, symbol = before[order], symbol[order]
            cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
            for piece in np.split(before, cuts):
                waiting[int(t[piece[0]])].append(piece)
    return np.concatenate(out)


def classes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Class numbers along order: adjacent suffixes whose common prefix has `length` bytes share one."""
    alike = np.ones(max(len(order) - 1, 0), bool)
    left, right = order[:-1], order[1:]
    for reach in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        every = np.flatnonzero(alike)
        if not len(every):
            break
        for k in range(0, len(every), CHUNK):
            at = every[k : k + CHUNK]
            alike[at] = words_at(text, left[at] + reach) == words_at(text, right[at] + reach)
    return np.cumsum(np.concatenate([[False], ~alike]), dtype="i4") if len(order) else order


def repeated(parts: list[bytes], docs: np.ndarray, texts: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Spans (doc, th, start, stop) of windows of the parts that start earlier in another place. docs, texts, starts: where each part begins."""
    depth = max(map(len, parts)) + 1
    text = np.frombuffer(bytes([SEPARATOR]).join([*parts, b"\xff" * (depth + 8)]), "u1")
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    order = suffix_array(text, depth)
    owner = np.repeat(np.arange(len(parts), dtype="i4"), sizes + 1)  # of each byte
    order = order[order + length <= (begins + sizes)[owner[order]]]
    number = classes(text, order, length)
    again = number[1:] == number[:-1]
    shared = np.concatenate([again, [False]]) | np.concatenate([[False], again]) if len(order) else np.zeros(0, bool)
    order, number = order[shared], np.unique(number[shared], return_inverse=True)[1]
    if not len(order):
        return docs[:0], texts[:0], starts[:0], starts[:0]
    part = owner[order]
    by_document = np.lexsort((texts, docs))
    rank = np.empty(len(parts), "i8")
    rank[by_document] = np.cumsum(changes(docs[by_document], texts[by_document]))
    place = (rank * (1 << 40) + starts - begins)[part] + order
    earliest = np.minimum.reduceat(place, np.flatnonzero(changes(number)))
    late = place > earliest[number]
    part, order = part[late], order[late]
    start = (starts - begins)[part] + order
    return joined((docs[part], texts[part]), start, start + length)


# --- the operator -------------------------------------------------------------------------------------------------------


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names.split())


def _key(docs: DataFrame) -> list[Column]:
    """What a document is known by: its id, and a hash of its text."""
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(docs["text"], docs["doc_id"].isNull()).alias("th")]


def _segments(text: str, length: int) -> Iterator[tuple[int, bytes]]:
    """A text's bytes in segments that overlap by length - 1: every window lies in one."""
    data = text.encode()
    for at in range(0, max(len(data) - length + 1, 1), SEGMENT):
        yield at, data[at : at + SEGMENT + length - 1]


def _pieces(rows: Iterator[tuple], length: int, gram: int) -> Iterator[tuple]:
    """Regions of rows (doc, th, start, bytes), many rows at a time: h, w1, w2, doc, th, start, size, and (data, first) to take bytes from."""
    held: list[tuple] = []
    size = 0

    def cut() -> tuple:
        data = b"".join(r[3] for r in held)
        ends = np.cumsum([len(r[3]) for r in held])
        h, first, n = regions(np.frombuffer(data, "u1"), ends, length, gram)
        w1, w2 = contents(data, first, n)
        own = np.searchsorted(ends, first, side="right")
        doc, th, start = (np.array([r[k] for r in held], "i8")[own] for k in range(3))
        return h.view("i8"), w1, w2, doc, th, start + first - np.concatenate([[0], ends[:-1]])[own], n, (data, first)

    for row in rows:
        if held and size + len(row[3]) > SEGMENT:
            yield cut()
            held, size = [], 0
        held.append(row)
        size += len(row[3])
    if held:
        yield cut()


def _order(h: np.ndarray, w1: np.ndarray, w2: np.ndarray, doc: np.ndarray, th: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order by content and place; along it, which rows are the first of their content, and which lie at a later place than it."""
    order = np.lexsort((start, th, doc, w2, w1, h))
    lead = changes(h[order], w1[order], w2[order])
    at = np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))
    # repeated rows of one document at one place are no earlier start
    late = np.any([x[order] != x[order][at] for x in (doc, th, start)], axis=0) if len(order) else lead
    return order, lead, late


def _regions(length: int):  # noqa: ANN202
    """Regions of all texts (kind 0), and spans already settled inside a block (kind 1, dealt by their own numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, limit=4_000_000):
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = ((d, t, at, part) for d, t, text in zip(ids, hashes, texts) for at, part in _segments(text, length))
            found = [x[:7] for x in _pieces(rows, length, min(GRAM, length))]
            h, w1, w2, doc, th, start, size = (np.concatenate(c) for c in zip(*found))
            order, lead, late = _order(h, w1, w2, doc, th, start)
            keep, gone = order[lead], order[late]
            yield _batch("kind h w1 w2 doc th start size", np.zeros(len(keep), "i1"), *(x[keep] for x in (h, w1, w2, doc, th, start, size)))
            d, t, a, b = joined((doc[gone], th[gone]), start[gone], start[gone] + size[gone])
            yield _batch("kind h w1 w2 doc th start size", np.ones(len(d), "i1"), a, d, t, d, t, a, b - a)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by content and place. Gives spans (kind 1) and the first region of each content: of the first two contents of an h kind 0,
    of further ones kind 2. Holds one batch and one row."""
    tail: tuple = ()  # the first row of the content that the last batch ended with
    seen = 0  # contents of its h so far
    for batch in batches:
        kind, h, w1, w2, doc, th, start, size = (batch.column(i).to_numpy() for i in range(8))
        if not len(h):
            continue
        region = kind == 0
        spans = [(x[~region]) for x in (doc, th, start, size)]
        h, w1, w2, doc, th, start, size = (np.concatenate([np.array(tail[k : k + 1], "i8"), x[region]]) for k, x in enumerate((h, w1, w2, doc, th, start, size)))
        lead = changes(h, w1, w2)
        at = np.maximum.accumulate(np.where(lead, np.arange(len(h)), 0))
        late = np.any([x != x[at] for x in (doc, th, start)], axis=0) if len(h) else lead
        d, t, a, b = joined(tuple(np.concatenate([x[late], y]) for x, y in ((doc, spans[0]), (th, spans[1]))), np.concatenate([start[late], spans[2]]), np.concatenate([(start + size)[late], spans[2] + spans[3]]))
        yield _batch("kind h doc th start stop", np.ones(len(d), "i1"), np.zeros(len(d), "i8"), d, t, a, b)
        lead[: len(tail) and 1] = False  # given before
        own = h[lead]
        if len(own):
            new, along = changes(own), np.arange(len(own))
            new[0] = not tail or own[0] != tail[0]
            rank = along - np.maximum.accumulate(np.where(new, along, 0)) + np.where(np.cumsum(new) == 0, seen, 0)
            seen = int(rank[-1]) + 1
            yield _batch("kind h doc th start stop", np.where(rank < 2, 0, 2).astype("i1"), own, doc[lead], th[lead], start[lead], (start + size)[lead])
        if len(h):
            tail = tuple(x[at[-1]] for x in (h, w1, w2, doc, th, start, size))


def _with_company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by h, those whose h another row has. Holds one batch and one row."""
    release()
    tail: list[np.ndarray] = []  # the last row so far
    given = False
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy() for c in batch.columns]
        if tail:
            columns = [np.concatenate(x) for x in zip(tail, columns)]
        new = changes(columns[0])
        keep = ~new | ~np.append(new[1:], True)
        tail, last = [c[-1:] for c in columns], bool(keep[-1])
        keep[0] &= not given
        given = last
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=batch.schema.names)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of asked regions: doc, th, text, asked (array of h, start, stop). A long text gives many small batches."""
    names, kinds = ["h", "doc", "th", "start", "part"], (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    rows: list[list] = [[], [], [], [], []]
    for batch, texts in blocks(batches):
        bounds, asked = batch.column(3).offsets.to_pylist(), batch.column(3).values
        for doc, th, text, low, high in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, bounds, bounds[1:]):
            data = text.encode()
            for at in range(low, high, ROWS):
                h, start, stop = (asked.field(k)[at : min(at + ROWS, high)].to_pylist() for k in ("h", "start", "stop"))
                for column, values in zip(rows, (h, [doc] * len(h), [th] * len(h), start, [data[x:y] for x, y in zip(start, stop)])):
                    column += values
                if len(rows[0]) >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)
                    rows = [[], [], [], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)


def _sorted_blocks(length: int, block: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by h: blocks of whole groups, each through a suffix array."""
        held: list[tuple[int, int, int, int, bytes]] = []
        size = 0

        def settle() -> pa.RecordBatch:
            return _batch("doc th start stop", *repeated([r[4] for r in held], *(np.array([r[k] for r in held], "i8") for k in (1, 2, 3)), length))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > block and row[0] != held[-1][0]:
                    yield settle()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield settle()

    return run


def _cut_anew(length: int, gram: int):  # noqa: ANN202
    """Parts of large groups, cut by longer k-grams: kind 0 with their bytes; spans (kind 1) of those that are equal inside a block."""
    names = "kind h w1 w2 doc th start stop part"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)))
            for h, w1, w2, doc, th, start, size, (data, first) in _pieces(rows, length, gram):
                order, lead, late = _order(h, w1, w2, doc, th, start)
                keep, gone = order[lead], order[late]
                parts = pa.array([data[a:b] for a, b in zip(first[keep].tolist(), (first + size)[keep].tolist())], pa.binary())
                yield _batch(names, np.zeros(len(keep), "i1"), *(x[keep] for x in (h, w1, w2, doc, th, start)), (start + size)[keep], parts)
                d, t, a, b = joined((doc[gone], th[gone]), start[gone], start[gone] + size[gone])
                yield _batch(names, np.ones(len(d), "i1"), a, d, t, d, t, a, b, pa.nulls(len(d), pa.binary()))

    return run


def _meet_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _cut_anew sorted by content and place: spans, and one part of each content. Contents are compared by their bytes."""
    lead: tuple = ()
    for batch in batches:
        out: list[tuple] = []
        for kind, h, _, _, doc, th, start, stop, part in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 1:
                out.append((1, h, doc, th, start, stop, None))
            elif lead and lead[0] == h and lead[4] == part:
                if lead[1:4] != (doc, th, start):
                    out.append((1, h, doc, th, start, stop, None))
            else:
                lead = (h, doc, th, start, part)
                out.append((0, h, doc, th, start, stop, part))
        kinds = (pa.int8(), *[pa.int64()] * 5, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)], names="kind h doc th start stop part".split())


def removed_spans(docs: DataFrame, length: int = LENGTH, group: int = GROUP, block: int = BLOCK_BYTES) -> DataFrame:
    """doc (null ids as NULL_ID), th (hash of the text), start, stop: bytes to remove; spans may touch or overlap."""
    keyed = docs.select(*_key(docs), docs["text"].alias("text"))
    found = keyed.mapInArrow(_regions(length), MET).repartition("h", "w1", "w2").sortWithinPartitions("h", "w1", "w2", "kind", "doc", "th", "start")
    met = materialize(found.mapInArrow(_meet, "kind byte, h long, doc long, th long, start long, stop long"), "regions")
    spans = met.where("kind = 1").select("doc", "th", "start", "stop")
    firsts = met.where("kind = 0").select("h", "doc", "th", "start", "stop").repartition("h").sortWithinPartitions("h")
    plural = firsts.mapInArrow(_with_company, firsts.schema).union(met.where("kind = 2").select(firsts.columns))
    asked = plural.groupBy("doc", "th").agg(F.collect_list(F.struct("h", "start", "stop")).alias("asked"))
    texts = keyed.join(asked, ["doc", "th"]).select("doc", "th", "text", "asked")
    parts = materialize(texts.mapInArrow(_texts, PARTS), "region-texts")
    for gram in [g for g in GRAMS if g < length] + [length]:
        large = materialize(parts.groupBy("h").count().where(F.col("count") > group).select("h"), "large-groups")
        if large.isEmpty():
            break
        anew = parts.join(large, "h", "left_semi").select("h", "doc", "th", "start", "part").mapInArrow(_cut_anew(length, gram), "kind byte, h long, w1 long, w2 long, doc long, th long, start long, stop long, part binary")
        anew = anew.repartition("h", "w1", "w2").sortWithinPartitions("h", "w1", "w2", "kind", "part", "doc", "th", "start").mapInArrow(_meet_parts, "kind byte, h long, doc long, th long, start long, stop long, part binary")
        anew = materialize(anew, "split-groups")
        spans = spans.union(anew.where("kind = 1").select("doc", "th", "start", "stop"))
        spans = spans.union(_by_suffix_arrays(parts.join(large, "h", "left_anti"), length, block))
        parts = anew.where("kind = 0").select("h", "doc", "th", "start", "part")
    return spans.union(_by_suffix_arrays(parts, length, block))


def _by_suffix_arrays(parts: DataFrame, length: int, block: int) -> DataFrame:
    ordered = parts.select("h", "doc", "th", "start", "part").repartition("h").sortWithinPartitions("h", "doc", "th", "start")
    return ordered.mapInArrow(_sorted_blocks(length, block), SPANS)


def with_spans(docs: DataFrame, length: int = LENGTH, name: str = "_spans", **settings) -> DataFrame:
    """docs and a column of that name: array of (start, stop), unordered, null if nothing goes."""
    spans = removed_spans(docs, length, **settings).groupBy("doc", "th").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rows = docs.select(F.struct("*").alias("row"), *_key(docs))
    return rows.join(spans, ["doc", "th"], "left").select("row.*", F.col("spans").alias(name))


def cut_at(data: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of data, and the maximal runs that went."""
    if not len(starts):
        return data, []
    starts, stops = joined((), starts, stops)
    runs = [(a, min(b, len(data))) for a, b in zip(starts.tolist(), stops.tolist()) if a < len(data)]
    ends = [0, *(b for _, b in runs)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(data)])), runs


def cut(data: bytes, spans: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    """The same with spans as rows of start and stop."""
    return cut_at(data, *(np.array([s[k] for s in spans or []], "i8") for k in ("start", "stop")))


def _cuts(texts: list[str], spans: pa.ListArray) -> Iterator[tuple[bytes, bytes, list[tuple[int, int]]]]:
    """Each text's bytes, what is left of them, and the runs that went. spans: the column of with_spans."""
    bounds, values = spans.offsets.to_pylist(), spans.values
    for text, low, high, null in zip(texts, bounds, bounds[1:], spans.is_null().to_pylist()):
        data = text.encode()
        yield data, *(cut_at(data, *(values.field(k)[low:high].to_numpy() for k in ("start", "stop"))) if not null else (data, []))


def op6_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            rows = [[], [], [], []]
            for data, kept, runs in _cuts(texts, batch.column(2)):
                for column, v in zip(rows, (len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_spans(docs).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def keep_unique(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with repeated passages cut from text; a run never splits a character (its broken bytes go too). Rows whose text is used up stay, empty."""

    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            left = [kept.decode("utf-8", "ignore") for _, kept, _ in _cuts(texts, batch.column(len(names)))]
            columns = batch.columns[:-1]
            columns[at] = pa.array(left, columns[at].type, mask=columns[at].is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return with_spans(docs, length, fresh(names, "spans")).mapInArrow(run, docs.schema)
