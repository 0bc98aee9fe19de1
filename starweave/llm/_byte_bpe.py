"""Token ids of whole texts under a byte-level BPE of the tokenizers library; ids of atoms are remembered.

The tokenizer cuts a text in words by a pattern before it merges. An atom is a
stretch between places where that pattern always cuts, whatever else is in the
text: before white space that follows something else, and between a letter and an
ASCII mark other than the apostrophe (which may begin a contraction). A text's
ids are those of its atoms. A text with ``<|``, which may begin a special token,
is encoded whole.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from ._tokens import EXACT_VALUES, Memo, byte_class, hashes

#: Distinct atoms whose ids a Python worker remembers.
CACHE = 1 << 20

_SPACE = byte_class(lambda b: b == 32 or 9 <= b <= 13)
_LETTER = byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122)
_PRINTED = byte_class(lambda b: 33 <= b <= 126)
_MARK = byte_class(lambda b: 33 <= b <= 126 and not chr(b).isalnum() and b != 39)


def _ends_blank(buf: np.ndarray) -> np.ndarray:
    """True at the last byte of each white-space character beyond ASCII (and of U+180E, which once was one)."""
    one, two = np.zeros_like(buf), np.zeros_like(buf)
    one[1:], two[2:] = buf[:-1], buf[:-2]
    general = (two == 0xE2) & (((one == 0x80) & ((buf <= 0x8A) | (buf == 0xA8) | (buf == 0xA9) | (buf == 0xAF))) | ((one == 0x81) & (buf == 0x9F)))
    return ((one == 0xC2) & ((buf == 0x85) | (buf == 0xA0))) | general | ((two == 0xE1) & (one == 0x9A) & (buf == 0x80)) \
        | ((two == 0xE3) & (one == 0x80) & (buf == 0x80)) | ((two == 0xE1) & (one == 0xA0) & (buf == 0x8E))


def borders(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The byte at which each atom of a run of texts begins."""
    n = len(buf)
    start = np.zeros(n, bool)
    start[off[:-1][off[:-1] < off[1:]]] = True
    sure = _PRINTED[buf] | ((buf >= 0x80) & ~_ends_blank(buf))
    letter, mark = _LETTER[buf], _MARK[buf]
    latin = np.flatnonzero(buf[:-1] == 0xC3)  # À to ÿ, without the signs × and ÷
    latin = latin[(buf[latin + 1] != 0x97) & (buf[latin + 1] != 0xB7)]
    letter[latin] = True
    letter[latin + 1] = True
    start[1:] |= (_SPACE[buf[1:]] & sure[:-1]) | (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    return np.flatnonzero(start)


class ByteBpe:
    """One process's encoder for a tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.size = max(self.tokenizer.get_vocab().values()) + 1
        self._clear()

    def _clear(self) -> None:
        self.memo = Memo(CACHE)
        self.flat = np.zeros(1 << 20, np.uint32)
        self.start = np.zeros(CACHE + 1, np.int64)

    def encode_plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, h: np.ndarray, atoms: list[str]) -> None:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(atoms, add_special_tokens=False)]
        n = self.memo.count
        total = int(self.start[n])
        if n + len(h) >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros(len(h) + CACHE, np.int64)])
        ends = total + np.cumsum([len(i) for i in ids])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[total: ends[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32, ends[-1] - total)
        self.start[n + 1: n + 1 + len(h)] = ends
        self.memo.put(h, np.arange(n, n + len(h), dtype=np.int32))

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a run of texts, one after the other, and where each begins (one more entry at the end)."""
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if self.memo.count > CACHE:
            self._clear()
        s = borders(buf, off)
        e = np.append(s[1:], len(buf))
        h = hashes(buf, s, e, EXACT_VALUES)
        which = self.memo.find(h)
        new = np.flatnonzero(which < 0)
        if len(new):
            distinct, at = np.unique(h[new], return_index=True)
            at, raw = new[at], buf.tobytes()
            self._learn(distinct, [raw[a:b].decode() for a, b in zip(s[at].tolist(), e[at].tolist(), strict=True)])
            which[new] = self.memo.find(h[new])
        begin = self.start[which]
        size = self.start[which + 1] - begin
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(begin - (ends - size), size) + np.arange(ends[-1])]
        first = np.concatenate([[0], ends])[np.searchsorted(s, off)]
        special = np.flatnonzero((buf[:-1] == 60) & (buf[1:] == 124))
        if not len(special):
            return ids, first
        odd = set((np.searchsorted(off, special, side="right") - 1).tolist())
        parts = [np.array(self.encode_plain(buf[off[i]: off[i + 1]].tobytes().decode()), np.uint32) if i in odd else ids[first[i]: first[i + 1]]
                 for i in range(len(off) - 1)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)


_ENCODERS: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """This process's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]
