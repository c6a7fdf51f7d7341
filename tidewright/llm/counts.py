"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary's trie carries failure links and, with each link, the number of tokens that following it pops. A word
is read once, character by character; only counts are added, no piece is built, and no word length needs a limit. The
vocabulary is that of the SentencePiece file: a word's first piece starts with U+2581, the others do not. A character that is no
piece counts as its UTF-8 bytes (the vocabulary's byte pieces). Words are maximal runs of characters other than
space and U+0009 to U+000D.

A null text has no words; empty likewise. Repeated rows are counted again, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MEMOS, map_blocks, read_table, spread, vocabulary

WORD = re.compile("[^ \u0009-\u000d]+")
SPACE, MEMO = "▁", 400_000


class LongestMatch:
    """step[node] maps a character to a child; link[node] is the failure node, popped[node] the tokens that leaving for it emits."""

    def __init__(self, vocabulary: set[str]):
        self.step: list[dict[str, int]] = [{}]
        token = [False]
        for piece in vocabulary:
            node = 0
            for c in piece:
                if c not in self.step[node]:
                    self.step[node][c] = len(self.step)
                    self.step.append({})
                    token.append(False)
                node = self.step[node][c]
            token[node] = bool(piece)
        self.link, self.popped = [0] * len(self.step), [0] * len(self.step)
        level = [0]
        while level:
            after = []
            for parent in level:
                for c, node in self.step[parent].items():
                    after.append(node)
                    if token[node]:
                        self.link[node], self.popped[node] = 0, 1
                    elif parent == 0:  # a character that starts pieces without being one
                        self.link[node], self.popped[node] = 0, len(c.encode())
                    else:
                        self.link[node], self.popped[node] = self._leave(self.link[parent], self.popped[parent], c)
            level = after

    def _leave(self, node: int, count: int, c: str) -> tuple[int, int]:
        """Reads c from a node: follows failure links until a child takes it, or drops it at the root as bytes."""
        step, link, popped = self.step, self.link, self.popped
        while c not in step[node]:
            if node == 0:
                return 0, count + len(c.encode())
            count += popped[node]
            node = link[node]
        return step[node][c], count

    def length(self, word: str) -> int:
        """Tokens of the greedy longest-match segmentation of a word."""
        step, link, popped = self.step, self.link, self.popped
        node = count = 0
        for c in word:
            to = step[node].get(c)
            while to is None and node:
                count += popped[node]
                node = link[node]
                to = step[node].get(c)
            if to is None:
                count += len(c.encode())
            else:
                node = to
        while node:
            count += popped[node]
            node = link[node]
        return count


_automata: dict[str, tuple[LongestMatch, dict[str, int]]] = {}
MEMOS["counts"] = _automata.clear


def automaton(path: str) -> tuple[LongestMatch, dict[str, int]]:
    """The vocabulary's automaton and a memo of word lengths, one of each per worker."""
    if path not in _automata:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        _automata[path] = LongestMatch(plain), {}
    return _automata[path]


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens of every document."""
    path = path or vocabulary("piece_bpe_32k.model")

    def run(batch: pa.RecordBatch, texts: list[str]) -> dict:
        match, memo = automaton(path)
        if len(memo) > MEMO:
            memo.clear()
        words, tokens = [], []
        for text in texts:
            n = 0
            counted = Counter(WORD.findall(text))
            for word, k in counted.items():
                size = memo.get(word)
                if size is None:
                    size = memo[word] = match.length(SPACE + word)
                n += k * size
            words.append(counted.total())
            tokens.append(n)
        return {"doc_id": batch.column(0), "n_words": words, "n_tokens": tokens}

    return map_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")), run, "doc_id long, n_words long, n_tokens long", memo="counts")


def op8_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spread(read_table(spark, sf_dir, "documents")))
