"""Token ids of the byte-level BPE through the tokenizers library, with a bounded memo of pre-tokens.

The vocabulary's pre-tokenizer cuts a text by one pattern and merges never cross a cut, so the ids of a text
are the ids of its pre-tokens in order. Random prose repeats most of its pre-tokens: each is encoded by the
library once per worker and kept as packed bytes. Texts with characters beyond Latin Extended-B go to the
library whole, because only there the pattern needs Unicode classes that Python's re lacks.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from .common import MEMOS

#: Letters, numbers and white space below U+0250, as the vocabulary's published pattern classes them.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\u0009-\u000d \u0085 "
CUT = re.compile(f" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
#: The byte alphabet: visible bytes stand for themselves, the others follow from 256 on.
VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
HIDDEN = [b for b in range(256) if b not in VISIBLE]
ALPHABET = "".join(chr(b if b in VISIBLE else 256 + HIDDEN.index(b)) for b in range(256))
#: New pre-tokens go to the library JOINED at a time, behind each other with a byte between them that no UTF-8 text has.
SEPARATOR, JOINED = 0xFF, 256
BEYOND = re.compile("[^\u0000-ɏ]")


class IdEncoder:
    """Encodes blocks of texts to little-endian unsigned 32-bit ids.

    When the memo is full, only pre-tokens that two texts of some block shared stay in it.
    """

    def __init__(self, path: str, memo_size: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.words = Tokenizer.from_file(path)  # for pre-tokens already cut, given in the vocabulary's byte alphabet
        self.words.encode_special_tokens = True
        self.words.pre_tokenizer = None
        pieces = self.words.get_vocab()
        merged = any(ALPHABET[SEPARATOR] in piece for piece in pieces if len(piece) > 1)
        added = any(not token.special for token in self.words.get_added_tokens_decoder().values())
        self.separator = None if merged or added else pieces.get(ALPHABET[SEPARATOR])  # None: the vocabulary could join across it
        self.memo: dict[str, bytes] = {}
        self.shared: set[str] = set()
        self.memo_size = memo_size

    def _encoded(self, words: set[str]) -> dict[str, bytes]:
        order, out = list(words), {}
        joined = JOINED if self.separator is not None else 1
        for at in range(0, len(order), 8192):
            parts = [order[i : min(i + joined, at + 8192)] for i in range(at, min(at + 8192, len(order)), joined)]
            spelled = [bytes([SEPARATOR]).join(map(str.encode, part)).decode("latin-1").translate(ALPHABET) for part in parts]
            for part, x in zip(parts, self.words.encode_batch_fast(spelled, add_special_tokens=False)):
                ids = array("I", x.ids)
                if len(part) == 1:
                    out[part[0]] = ids.tobytes()
                    continue
                ends = (4 * np.flatnonzero(np.frombuffer(ids, "u4") == self.separator)).tolist()
                raw = ids.tobytes()
                out.update(zip(part, [raw[i:j] for i, j in zip([0, *(e + 4 for e in ends)], [*ends, len(raw)])]))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids' bytes of each text, without any end id."""
        cuts = [None if BEYOND.search(t) else CUT.findall(t) for t in texts]
        known = self.memo.get
        found = [list(map(known, words or ())) for words in cuts]  # None: new
        missing = [[i for i, x in enumerate(own) if x is None] if None in own else [] for own in found]
        new: set[str] = set()
        for words, at in zip(cuts, missing):
            if at:
                fresh = {words[i] for i in at}
                self.shared |= fresh & new
                new |= fresh
        full = len(self.memo) + len(new) > self.memo_size
        if full:
            if len(self.shared) > self.memo_size // 2:
                self.shared.clear()
            self.memo = {w: self.memo[w] for w in self.shared & self.memo.keys()}
        encoded = self._encoded(new)
        self.memo.update(encoded)
        for words, own, at in zip(cuts, found, missing):
            for i in at:
                own[i] = encoded[words[i]]
            if full and words:  # the block's words stay as well
                self.memo.update(zip(words, own))
        return [np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if words is None else b"".join(own) for t, words, own in zip(texts, cuts, found)]


_encoders: dict[str, IdEncoder] = {}
MEMOS["ids"] = _encoders.clear


def encoder(path: str) -> IdEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = IdEncoder(path)
    return _encoders[path]
