"""Hierarchical multi-length packing of documents into training sequences.

Every document is cut into whole windows of the longest tier and one remainder; the remainder is routed to the
shortest context tier that holds it. Long-tier remainders are completed first, their gaps filled from shorter tiers (best
fit, the last filler cut to size); what is left is packed tier by tier in the same way. Windows are powers of two, so
a full window of any tier needs no padding; only the tail of a partition does, after it is cut into powers of two.
Within a tier, sequences are dealt to step groups of equal token budget in serpentine order of their attention cost
(sum of squared piece lengths), so that the groups of a block cost about the same.

Sequences never cross partitions: no shuffle, and a lost task is recomputed whole. Memory is bounded by one block of
texts and less than one longest window carried over.

A null text is empty (its document is the end id alone); a null doc_id stays null; repeated rows are packed again;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, read_table, release, spread, vocabulary
from .ids import encoder

TIERS, LEAST_WINDOW, STEP_TOKENS, END_ID = (1024, 512, 256, 128), 16, 16_384, 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, step_group long"

#: A piece: (document number, start, length). Documents of a block are kept as id bytes until their pieces are placed.
Piece = tuple[int, int, int]


class TierPacker:
    """Packs pieces of a stream of documents; sequences come out as (window, pieces)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, least: int = LEAST_WINDOW):
        if any(t & (t - 1) for t in (*tiers, least)) or list(tiers) != sorted(set(tiers), reverse=True) or least > tiers[-1]:
            raise ValueError("tiers must be falling powers of two, no less than the least window")
        self.tiers, self.least = tiers, least
        self.pools: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # (length, document, start) by tier, ascending

    def tier(self, length: int) -> int:
        return max(k for k, t in enumerate(self.tiers) if length <= t)

    def put(self, piece: Piece) -> None:
        doc, start, length = piece
        bisect.insort(self.pools[self.tier(length)], (length, doc, start))

    def add(self, doc: int, n: int) -> Iterator[tuple[int, list[Piece]]]:
        top = self.tiers[0]
        whole = n - n % top
        for at in range(0, whole, top):
            yield top, [(doc, at, top)]
        if n > whole:
            self.put((doc, whole, n - whole))

    def _fill(self, gap: int, below: int) -> list[Piece]:
        """Pieces for a gap, longest fitting first from tier `below` on; the last is cut. Falls back to the longer tiers."""
        out: list[Piece] = []
        while gap:
            best = None
            for k in range(below, len(self.tiers)):
                at = bisect.bisect_right(self.pools[k], (gap, 1 << 62, 0)) - 1
                if at >= 0:
                    best = k, at
                    break
            if best:
                length, doc, start = self.pools[best[0]].pop(best[1])
            else:  # nothing fits: cut a longer one, from the shortest tier that has any
                k = next((k for k in reversed(range(len(self.tiers))) if self.pools[k]), None)
                if k is None:
                    break
                length, doc, start = self.pools[k].pop(0)
                if length > gap:
                    self.put((doc, start + gap, length - gap))
                    length = gap
            out.append((doc, start, length))
            gap -= length
        return out

    def _waiting(self) -> int:
        return sum(x[0] for pool in self.pools for x in pool)

    def flush(self, last: bool) -> Iterator[tuple[int, list[Piece]]]:
        """Completes windows tier by tier; keeps less than one longest window unless it is the last flush."""
        waiting = self._waiting()
        for k, window in enumerate(self.tiers):
            while self.pools[k] and waiting >= (window if last or k == 0 else max(window, self.tiers[0])):
                length, doc, start = self.pools[k].pop()
                pieces = [(doc, start, length), *self._fill(window - length, k + 1)]
                waiting -= window
                yield window, pieces
        if last:
            while waiting:
                window = 1 << (waiting.bit_length() - 1)
                if window < self.least:
                    window = waiting
                pieces = self._fill(min(window, self.tiers[0]), 0)
                waiting -= sum(p[2] for p in pieces)
                yield (window if window & (window - 1) == 0 else self.tiers[0]), pieces


def step_groups(sequences: list[tuple[int, list[Piece]]], budget: int) -> list[int]:
    """A group for each sequence: groups of one window length, equal token budgets, costs balanced in serpentine order."""
    groups, base = [0] * len(sequences), 0
    for window in sorted({w for w, _ in sequences}, reverse=True):
        own = sorted((i for i, (w, _) in enumerate(sequences) if w == window), key=lambda i: (-sum(p[2] ** 2 for p in sequences[i][1]), i))
        n = -(-len(own) * window // budget)
        for rank, i in enumerate(own):
            lap, at = divmod(rank, n)
            groups[i] = base + (n - 1 - at if lap % 2 else at)
        base += n
    return groups


def pack(docs: DataFrame, tokenizer: str | None = None, tiers: tuple[int, ...] = TIERS, least: int = LEAST_WINDOW, step_tokens: int = STEP_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece. sequence_id and step_group carry the partition in their upper bits."""
    tokenizer = tokenizer or vocabulary("byte_bpe_50k.json")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("ids")
        packer, encode = TierPacker(tiers, least), encoder(tokenizer).encode
        high = TaskContext.get().partitionId() << 40
        held: dict[int, tuple[int | None, bytes]] = {}
        number = sequence = group = 0

        def rows(found: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
            nonlocal sequence, group
            out: list[list] = [[] for _ in range(9)]
            dealt = step_groups(found, step_tokens)
            for (window, pieces), g in zip(found, dealt):
                offset = 0
                for doc, start, length in pieces:
                    doc_id, ids = held[doc]
                    for column, v in zip(out, (doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), len(ids) // 4, high | sequence, offset, window, high | (group + g))):
                        column.append(v)
                    offset += length
                sequence += 1
            group += max(dealt, default=-1) + 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 7 else pa.int64()) for k, c in enumerate(out)], names=[x.split()[0] for x in PIECES.split(", ")])

        for batch, texts in blocks(batches, memo="ids"):
            found = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(texts)):
                held[number] = (doc_id, ids + end)
                found += packer.add(number, len(ids) // 4 + 1)
                number += 1
            found += packer.flush(last=False)
            yield rows(found)
            waiting = {x[1] for pool in packer.pools for x in pool}
            held = {k: v for k, v in held.items() if k in waiting}
        yield rows(list(packer.flush(last=True)))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, PIECES)


def op3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spread(read_table(spark, sf_dir, "documents")))
