"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

A text is escaped (space to U+2581, a leading one added) and cut before every run of U+2581: no piece of the vocabulary has one
behind another character, so merges never cross a cut and each chunk has an agenda of its own. The agenda takes
the adjacent pair of best score, leftmost first. With dropout, a candidate (left offset, merged piece) is skipped when its
keyed hash falls below the rate: hash(key, offset, piece), with a key of its own for every occurrence, hash(seed, doc_id, number
of the chunk in the document). So every occurrence of a word is cut anew, and a rerun gives the same ids. The merges that a chunk
takes without dropout are remembered by each worker once two documents have it: an occurrence that skips none of them has the
plain ids, every other one runs its agenda. Agendas of a block advance together in numpy; a very long chunk has a heap of its own.

Characters without a piece become byte pieces. A literal U+2581 in a text becomes byte pieces too (the library would
turn it into a space), so decode(encode(text)) == text for every text. Null text: empty, no ids. A null doc_id draws as 0. Repeated
rows with one doc_id get the same ids. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MEMOS, blocks, read_table, spread, vocabulary

SPACE = "▁"
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
DROPOUT, SEED, MEMO = 0.1, 7, 400_000
BATCH_CHUNKS, BLOCK, OCCURRENCES = 20_000, 1_000_000, 200_000
#: Slots of a worker's note on chunks met once (by hash, no chunk is kept): a power of two.
ONCE = 1 << 22
#: A longer chunk hardly keeps all of its merges: its agenda runs at once.
LONG = 40
#: The agenda of a chunk beyond this length is a heap: rounds over all its pairs would take time by the square of the length.
WIDE = 256
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PieceTable:
    """Pieces, scores, and the merge table: (left piece, right piece) to merged piece."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.scores = np.array([model.get_score(i) for i in range(n)], "f4")
        pairs = self.pairs = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        # open addressing with linear probes, looked up in numpy
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, "i8")
        self.merged = np.full(1 << self.bits, -1, "i4")
        self.probes = 1
        for key, i in pairs.items():
            slot, step = self._slot(key), 1
            while self.keys[slot] != -1:
                slot, step = (slot + 1) & ((1 << self.bits) - 1), step + 1
            self.keys[slot], self.merged[slot], self.probes = key, i, max(self.probes, step)
        self.char = -1 - np.arange(0x110000, dtype="i4")  # a character without a piece: -1 - its code
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        self.text = [p.replace(SPACE, " ") for p in self.pieces]
        self.spelled = np.array(self.text, object)
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.empty = special - self.byte_of.keys()
        self.raw = np.array([bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.empty else x.encode() for i, x in enumerate(self.text)], object)
        self.is_byte = np.zeros(n, bool)
        self.is_byte[list(self.byte_of)] = True

    def _slot(self, key: int) -> int:
        return ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged piece of each pair, -1 where there is none (or a side is -1)."""
        key = left.astype("i8") << 32 | right
        slot = ((key.view("u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view("i8")
        found = self.keys[slot]
        hit = found == key
        out = np.full(len(key), -1, "i4")
        out[hit] = self.merged[slot[hit]]
        todo = np.flatnonzero(~hit & (found != -1))
        for _ in range(1, self.probes):
            if not todo.size:
                break
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.merged[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        out[(left < 0) | (right < 0)] = -1
        return out


def chunk_key(seed: int, variant: int, chunk: str) -> int:
    """The key of a chunk that stands in no document."""
    return xxhash.xxh64_intdigest(chunk.encode(), seed * 1_000_003 + variant)


def candidate(offset: np.ndarray, piece: np.ndarray) -> np.ndarray:
    return mix(offset.astype("u8") << np.uint64(32) | piece.astype("u8"))


def dropped(key: np.ndarray, candidates: np.ndarray, rate: float) -> np.ndarray:
    return (mix(key + candidates) >> np.uint64(11)).astype("f8") < rate * 2.0**53


def skips(key: np.ndarray, offset: np.ndarray, piece: np.ndarray, rate: float) -> np.ndarray:
    """Whether the candidate is dropped from the agenda."""
    return dropped(key, candidate(offset, piece), rate)


def mix_one(x: int) -> int:
    """mix of one number."""
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


class PieceEncoder:
    def __init__(self, path: str, rate: float = DROPOUT, seed: int = SEED, memo: int = MEMO):
        if not 0 <= rate <= 1:
            raise ValueError("the rate must be between 0 and 1")
        self.table = PieceTable(path)
        self.rate, self.seed, self.memo_size = rate, seed, memo
        self.variants = 4 if rate else 1  # keys to try on chunks outside documents; encode has no such number
        self._forget()

    def _forget(self) -> None:
        """Empties the memo: numbers of chunks; by number the plain ids, where the plain merges begin, how many; and all merges."""
        self.number: dict[str, int] = {}
        self.plain: list[bytes] = []
        self.once = np.zeros(ONCE, bool)  # slots of chunks met in one document so far: not learned yet
        self.first, self.merges, self.path = np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "u8")

    def agenda(self, chunks: list[str], keys: list[int] | np.ndarray, rate: float | None = None, taken: list | None = None) -> list[bytes]:
        """Runs the agendas of all chunks together; every round makes the best allowed merge of each chunk, and appends it to taken."""
        rate = self.rate if rate is None else rate
        t = self.table
        wide = [i for i, c in enumerate(chunks) if len(c) > WIDE]
        if wide:  # never with taken: only short chunks are learned
            near = [i for i, c in enumerate(chunks) if len(c) <= WIDE]
            found = dict(zip(near, self.agenda([chunks[i] for i in near], [keys[i] for i in near], rate))) if near else {}
            return [found[i] if i in found else self._heap_agenda(c, int(keys[i]), rate) for i, c in enumerate(chunks)]
        count = np.array([len(c) or 1 for c in chunks])
        codes = np.frombuffer("".join(c or SPACE for c in chunks).encode("utf-32-le"), "<u4").astype("i4")
        start = t.char[codes]
        start[np.repeat([not c for c in chunks], count)] = -1 - ord(SPACE)
        width = int(count.max())
        column = np.arange(len(codes)) - np.repeat(np.cumsum(count) - count, count)
        gone = -(1 << 30)
        sym = np.full((len(chunks), width), gone, "i4")
        sym[np.repeat(np.arange(len(chunks)), count), column] = start
        # a symbol stays in the column of its first character; after and before are its neighbours' columns
        flat, score = sym.ravel(), np.full((len(chunks), width), -np.inf, "f4")
        pair, value = np.full(sym.size, -1, "i4"), score.ravel()
        after, before = (np.tile(np.arange(k, width + k, dtype="i4"), len(chunks)) for k in (1, -1))
        key = np.array(keys, "u8")

        def weigh(row: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            """Puts the candidates of neighbours in columns left and right on the agenda."""
            at = row * width + left
            merged = t.merge(flat[at], flat[row * width + right])
            found = np.flatnonzero(merged >= 0)
            if rate and found.size:
                found = found[~skips(key[row[found]], left[found], merged[found], rate)]
            pair[at[found]] = merged = merged[found]
            value[at[found]] = t.scores[merged]

        row, left = np.nonzero(np.arange(1, width) < count[:, None])
        weigh(row, left, left + 1)
        live = np.flatnonzero(count > 1)
        while live.size:
            own = score[live]
            best = own.argmax(axis=1)
            hit = own[np.arange(len(live)), best] > -np.inf
            live, best = live[hit], best[hit]
            if not live.size:
                break
            base = live * width
            at = base + best
            merged = pair[at]
            if taken is not None:
                taken.append((live, candidate(best, merged)))
            lost = base + after[at]
            right, left = after[lost], before[at]
            flat[at], flat[lost], after[at] = merged, gone, right
            value[at] = value[lost] = -np.inf
            more, less = right < count[live], left >= 0
            before[base[more] + right[more]] = best[more]
            value[base[less] + left[less]] = -np.inf
            weigh(np.concatenate([live[more], live[less]]), np.concatenate([best[more], left[less]]), np.concatenate([right[more], best[less]]))
        kept = sym != gone
        count = kept.sum(axis=1)
        packed = sym[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(count)).tolist()
        out = [packed[i:j] for i, j in zip([0, *ends], ends)]
        for i in np.flatnonzero(((sym < 0) & kept).any(axis=1)):
            ids = [x for v in sym[i, kept[i]].tolist() for x in ([v] if v >= 0 else [t.byte[b] for b in chr(-1 - v).encode()])]
            out[i] = np.array(ids, "<u4").tobytes()
        return out

    def _heap_agenda(self, chunk: str, key: int, rate: float) -> bytes:
        """The agenda of one chunk in the order of a heap, over a linked list of symbols."""
        t, pairs, scores = self.table, self.table.pairs, self.table.scores.tolist()
        start = t.char[np.frombuffer(chunk.encode("utf-32-le"), "<u4")]
        n = len(start)
        merged = t.merge(start[:-1], start[1:])
        at = np.flatnonzero(merged >= 0)
        if rate and at.size:
            at = at[~skips(np.full(len(at), key, "u8"), at, merged[at], rate)]
        heap = list(zip((-t.scores[merged[at]]).tolist(), at.tolist(), merged[at].tolist()))
        heapq.heapify(heap)
        sym, after, before = start.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        alive, limit = bytearray(b"\1") * n, rate * 2.0**53
        while heap:
            _, i, m = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j == n or sym[i] < 0 or sym[j] < 0 or pairs.get(sym[i] << 32 | sym[j]) != m:
                continue
            sym[i], alive[j], k = m, 0, after[j]
            after[i] = k
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and sym[left] >= 0 and sym[right] >= 0:
                    piece = pairs.get(sym[left] << 32 | sym[right])
                    if piece is not None and not (rate and mix_one((key + mix_one(left << 32 | piece)) & 0xFFFFFFFFFFFFFFFF) >> 11 < limit):
                        heapq.heappush(heap, (-scores[piece], left, piece))
        out: list[int] = []
        i = 0
        while i < n:
            out += [sym[i]] if sym[i] >= 0 else [t.byte[b] for b in chr(-1 - sym[i]).encode()]
            i = after[i]
        return np.array(out, "<u4").tobytes()

    def escape(self, text: str) -> list[str]:
        """The chunks of a text; an empty chunk stands for a literal U+2581."""
        if not text:
            return []
        if SPACE not in text:
            return CHUNK.findall((" " + text).replace(" ", SPACE))
        first, *rest = (CHUNK.findall(x.replace(" ", SPACE)) for x in (" " + text).split(SPACE))
        return first + [c for chunks in rest for c in ["", *chunks]]

    def keys(self, doc_id: int, n: int) -> np.ndarray:
        """The key of each chunk of a document."""
        base = mix(np.array([(doc_id & 0xFFFFFFFFFFFFFFFF) ^ (self.seed << 20)], "u8"))
        return mix(base + np.arange(n, dtype="u8") * GOLDEN)

    def _steps(self, order: list[str]) -> Iterator[slice]:
        """Slices of chunks in order of length: of like length together, so that a long one does not widen the others' rows."""
        at = 0
        while at < len(order):
            step = max(1, min(BATCH_CHUNKS, 2_000_000 // max(1, len(order[min(at + BATCH_CHUNKS, len(order)) - 1]))))
            yield slice(at, at + step)
            at += step

    def _learn(self, chunks: set[str]) -> None:
        order, counts, paths = sorted(chunks, key=len), [self.merges], [self.path]
        for part in self._steps(order):
            taken: list[tuple[np.ndarray, np.ndarray]] = []
            self.plain += self.agenda(order[part], np.zeros(len(order[part]), "u8"), 0.0, taken)
            rows, merges = (np.concatenate(x) for x in zip(*taken)) if taken else (np.zeros(0, "i8"), np.zeros(0, "u8"))
            counts.append(np.bincount(rows, minlength=len(order[part])))
            paths.append(merges[np.argsort(rows, kind="stable")])
        self.number.update(zip(order, range(len(self.number), len(self.number) + len(order))))
        self.merges, self.path = np.concatenate(counts), np.concatenate(paths)
        self.first = np.cumsum(self.merges) - self.merges

    def _cut(self, chunks: list[str], keys: np.ndarray) -> list[bytes]:
        """The ids of every occurrence: the plain ones where the memo has them and no merge is skipped."""
        numbers = np.fromiter(map(self.number.get, chunks, repeat(-1)), "i8", len(chunks))
        out = list(map(self.plain.__getitem__, numbers.tolist())) if self.plain else [b""] * len(chunks)  # -1: any, replaced below
        known = np.flatnonzero(numbers >= 0)
        changed = np.flatnonzero(numbers < 0)
        if self.rate and len(known):
            merges = self.merges[numbers[known]]
            ends = np.cumsum(merges)
            at = np.repeat(self.first[numbers[known]] - (ends - merges), merges) + np.arange(ends[-1])
            lost = np.flatnonzero(dropped(np.repeat(keys[known], merges), self.path[at], self.rate))
            changed = np.concatenate([changed, known[np.unique(np.searchsorted(ends, lost, side="right"))]])
        if len(changed):
            self._run([chunks[i] for i in changed.tolist()], keys[changed], changed.tolist(), out)
        return out

    def _run(self, chunks: list[str], keys: np.ndarray, places: list[int], out: list[bytes]) -> None:
        """Puts what the agendas of chunks give into their places of out."""
        order = np.argsort(np.fromiter(map(len, chunks), "i8", len(chunks)), kind="stable")
        chunks, keys, places = [chunks[i] for i in order.tolist()], keys[order], [places[i] for i in order.tolist()]
        for part in self._steps(chunks):
            for i, ids in zip(places[part], self.agenda(chunks[part], keys[part])):
                out[i] = ids

    def encode(self, doc_ids: list[int | None], texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes."""
        cuts = [self.escape(text) for text in texts]
        fresh: set[str] = set()
        again: set[str] = set()
        for chunks in map(set, cuts):
            chunks = chunks.difference(self.number)
            again |= chunks & fresh
            fresh |= chunks
        slots = np.fromiter(map(hash, fresh), "i8", len(fresh)) & (ONCE - 1)
        again.update(compress(fresh, self.once[slots].tolist()))  # two chunks in a slot: learned a document early
        if len(self.number) + len(again) > self.memo_size:
            self._forget()
        if np.count_nonzero(self.once) + len(fresh) > self.memo_size:
            self.once[:] = False
        self.once[slots] = True
        self._learn({c for c in again if len(c) <= LONG})
        found, at = [], 0
        while at < len(cuts):  # documents together, up to a number of chunks
            end, n = at + 1, len(cuts[at])
            while end < len(cuts) and n + len(cuts[end]) <= OCCURRENCES:
                n += len(cuts[end])
                end += 1
            chunks = list(chain.from_iterable(cuts[at:end]))
            keys = np.concatenate([self.keys(d or 0, len(c)) for d, c in zip(doc_ids[at:end], cuts[at:end])])
            ids: list[bytes] = []
            for k in range(0, n, OCCURRENCES):
                ids += self._cut(chunks[k : k + OCCURRENCES], keys[k : k + OCCURRENCES])
            k = 0
            for own in cuts[at:end]:
                found.append(b"".join(ids[k : k + len(own)]))
                k += len(own)
            at = end
        return found

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, byte pieces as UTF-8, U+2581 as a space, the leading one removed."""
        t = self.table
        if not t.is_byte[ids].any():
            text = "".join(t.spelled[ids])
        else:
            text = b"".join(t.raw[ids].tolist()).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_encoders: dict[tuple, PieceEncoder] = {}
MEMOS["pieces"] = _encoders.clear


def encoder(path: str, rate: float, seed: int) -> PieceEncoder:
    key = path, rate, seed
    if key not in _encoders:
        _encoders[key] = PieceEncoder(*key)
    return _encoders[key]


def _encoded(own: PieceEncoder, batch: pa.RecordBatch, texts: list[str]) -> list[pa.Array]:
    ids = own.encode(batch.column(0).to_pylist(), texts)
    return [batch.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]


def _decoded(own: PieceEncoder, ids: pa.Array) -> pa.Array:
    return pa.array([own.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in ids], pa.string())


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))


def encode(docs: DataFrame, path: str | None = None, rate: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, ids (little-endian u4 bytes), n_ids of every document."""
    path = path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, rate, seed)
        for batch, texts in blocks(batches, limit=BLOCK, memo="pieces"):
            yield pa.RecordBatch.from_arrays(_encoded(own, batch, texts), names=["doc_id", "ids", "n_ids"])

    return _documents(docs).mapInArrow(run, "doc_id long, ids binary, n_ids long")


def decode(frame: DataFrame, path: str | None = None) -> DataFrame:
    """Adds text to the frame of encode."""
    path = path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, 0.0, 0)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, _decoded(own, part.column(1))], names=["doc_id", "ids", "n_ids", "text"])

    return frame.select("doc_id", "ids", "n_ids").mapInArrow(run, "doc_id long, ids binary, n_ids long, text string")


def round_trip(docs: DataFrame, path: str | None = None, rate: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """decode(encode(docs)) in one worker a task, which has one table and one copy of a block; text is decoded from the column of ids."""
    path = path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, rate, seed)
        for batch, texts in blocks(batches, limit=BLOCK, memo="pieces"):
            found = _encoded(own, batch, texts)
            yield pa.RecordBatch.from_arrays([*found, _decoded(own, found[1])], names=["doc_id", "ids", "n_ids", "text"])

    return _documents(docs).mapInArrow(run, "doc_id long, ids binary, n_ids long, text string")


def op1_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and unsigned crc32 of the ids, and crc32 of the UTF-8 text that they decode to."""
    back = round_trip(spread(read_table(spark, sf_dir, "documents")))
    return back.select("doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
