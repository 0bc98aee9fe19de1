"""Word hashes of Arrow string columns, vectorised over the UTF-8 bytes.

A word is a maximal run of bytes that a 256-entry table marks; bytes of 0x80
and above belong to whatever class the table gives them, so any rule that
treats all non-ASCII characters alike is exact. A word's hash is a polynomial
of its bytes modulo 2**64, finished by a bijective mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at once; one longer document is hashed alone.
CHUNK_BYTES = 1 << 20

_M = np.uint64(0x9E3779B97F4A7C15 | 1)
_M_INVERSE = np.uint64(pow(int(_M), -1, 1 << 64))
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers (two xor-shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A 64-bit value for each byte; in VALUES, A-Z are as a-z.
EXACT_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
VALUES = EXACT_VALUES.copy()
VALUES[65:91] = VALUES[97:123]


def byte_class(member) -> np.ndarray:
    """A table over the 256 bytes, true where ``member(byte)``."""
    return np.array([bool(member(b)) for b in range(256)])


#: Everything but the ASCII white space that ``[^\x20\x09-\x0D]+`` leaves out.
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 9 <= b <= 13)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = byte_class(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n + 1:
        size = max(n + 1, CHUNK_BYTES + 1)
        for name, m in (("up", _M), ("down", _M_INVERSE)):
            p = np.full(size, m, np.uint64)
            p[0] = 1
            np.cumprod(p, out=p)
            _POWERS[name] = p
    up, down = _POWERS["up"], _POWERS["down"]
    if n <= CHUNK_BYTES < len(up) - 1:  # tables of one very long document are not kept
        _POWERS["up"], _POWERS["down"] = up[: CHUNK_BYTES + 1].copy(), down[: CHUNK_BYTES + 1].copy()
    return up, down


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows with about ``limit`` bytes: first row, end row, bytes, offsets. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, hi, buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        lo = hi


def words(buf: np.ndarray, off: np.ndarray, member: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes in order, each document's first word (one more entry at the end), word start and end bytes."""
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), none, none
    inside = member[buf]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    at = off[:-1][off[:-1] < off[1:]]
    start[at] = inside[at]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | start[1:]
    s, e = np.flatnonzero(start), np.flatnonzero(last) + 1
    return hashes(buf, s, e), np.searchsorted(s, off), s, e


def hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray, values: np.ndarray = VALUES) -> np.ndarray:
    """The hash of each stretch ``buf[s:e]``; ``values`` are those of the 256 bytes."""
    up, down = _powers(len(buf))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(values[buf] * up[: len(buf)], out=total[1:])
    return mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside a document, and each document's first one.

    A document of fewer words, but not none, has its whole sequence as its only shingle.
    """
    n = len(h)
    count = np.diff(first)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    g = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        g[: n - j] += h[j:] * np.uint64(pow(int(_M), j + 1, 1 << 64))
    keep = np.ones(n, bool)
    for j in range(1, k):
        keep[first[1:][count >= j] - j] = False
    for d in np.flatnonzero((count > 0) & (count < k)):
        lo, hi = int(first[d]), int(first[d + 1])
        total = hi - lo
        for j in range(lo, hi):
            total = (total * int(_M_INVERSE) + int(h[j])) % (1 << 64)
        g[lo] = total
        keep[lo] = True
    at = np.flatnonzero(keep)
    return mix(g[at]), np.searchsorted(at, first)


class Memo:
    """Whole numbers by 64-bit hash, looked up and stored in bulk (open addressing). Hash 0 stands for 1."""

    def __init__(self, size: int):
        self.slots = 1 << max(8, (2 * size - 1).bit_length())
        self.shift = np.uint64(64 - self.slots.bit_length() + 1)
        self.keys = np.zeros(self.slots, np.uint64)
        self.numbers = np.zeros(self.slots, np.int32)
        self.count = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The stored numbers, -1 where there is none."""
        out = np.full(len(h), -1, np.int32)
        h = np.maximum(h, np.uint64(1))
        slot, left = (h >> self.shift).astype(np.int64), np.arange(len(h))
        while len(left):
            key = self.keys[slot]
            same = key == h[left]
            out[left[same]] = self.numbers[slot[same]]
            more = ~same & (key != 0)
            left, slot = left[more], (slot[more] + 1) & (self.slots - 1)
        return out

    def put(self, h: np.ndarray, numbers: np.ndarray) -> None:
        """Store new, distinct hashes."""
        self.count += len(h)
        h = np.maximum(h, np.uint64(1))
        if 4 * self.count > 3 * self.slots:  # a batch of very many new words: a larger table
            held = np.flatnonzero(self.keys)
            old, own = self.keys[held], self.numbers[held]
            self.__init__(2 * self.count)
            self.put(old, own)
            self.count += len(h)
        slot = (h >> self.shift).astype(np.int64)
        while len(h):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, one = np.unique(slot[free], return_index=True)  # of several that want a place, one gets it
            won = free[one]
            self.keys[slot[won]] = h[won]
            self.numbers[slot[won]] = numbers[won]
            lost = np.ones(len(h), bool)
            lost[won] = False
            h, numbers, slot = h[lost], numbers[lost], (slot[lost] + 1) & (self.slots - 1)
