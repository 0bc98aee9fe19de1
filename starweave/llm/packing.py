"""Packing (7): order-preserving window cuts by dynamic programming.

The documents of a partition form one stream of token ids, in their order, each
ended by id 1. Sequences are consecutive windows of at most ``CAPACITY`` ids. A
cut may fall behind a document (free), behind a sentence, or, where sentences are
long, at every ``STEP`` ids (dearer). With ``best[i]`` the least cost of cutting
at place ``i``,

    best[j] = penalty[j] + min(best[i] + CAPACITY - (j - i)),  j - CAPACITY <= i < j

whose minimum slides with ``j``, so a monotone queue of ``best[i] + i`` makes
each place's transition constant on average. The stream is cut in blocks of
``BLOCK_IDS`` ids; the last window of a block is carried into the next block,
so memory does not grow with the partition.

Nothing is shuffled. A sequence lies in one partition, whose number is the upper
part of ``sequence_id``; only the last sequence of a partition has a large gap.

Defined results: a NULL or empty text is the single id 1; a document longer than
a sequence is cut into pieces; repeated rows are packed each; a NULL ``doc_id``
stays NULL; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ._tokens import NOT_SPACE, Memo, byte_class, chunks, hashes

CAPACITY = 2048
END_ID = 1
#: Costs of a cut behind a sentence and inside one, in padded ids.
SENTENCE_CUT, INNER_CUT = 2, 6
#: Where a sentence is longer, it may be cut at every so many ids.
STEP = 12
BLOCK_IDS = 1 << 18
#: Distinct atoms whose ids a Python worker remembers.
CACHE = 1 << 19

_LETTER = byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122)
#: ASCII punctuation but the apostrophe, which may begin a token of its own with the letters after it.
_MARK = byte_class(lambda b: 33 <= b <= 126 and not chr(b).isalnum() and b != 39)
#: Byte-level alphabet: bytes without a visible Latin-1 character stand, in order, as characters from 256 on.
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b <= 32 or 127 <= b <= 160 or b == 173)}


class Encoder:
    """Token ids of whole texts; the ids of atoms are remembered under their hash.

    The tokenizer ignores case, drops white space and never joins across it, nor
    across the border between a letter and a punctuation mark. An atom is a
    stretch between such places: white space, and borders of an ASCII or
    Latin-1 letter with an ASCII mark. A text's ids are those of its atoms.
    A text with ``<|``, which may begin a special token, is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab()
        self.sentence = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            if token.endswith("</w>") and token[0] in ".!?":
                self.sentence[i] = True
        self._clear()

    def _clear(self) -> None:
        self.memo = Memo(CACHE)
        self.flat = np.zeros(1 << 20, np.uint32)
        self.start = np.zeros(CACHE + 1, np.int64)

    def encode_plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _atom(self, raw: bytes) -> list[int]:
        text = raw.decode()
        if text.isalpha():  # one run of letters goes straight to the merges, if it is composed already
            if text.isascii():
                return [t.id for t in self.model.tokenize(text.lower())]
            if max(text) <= "\xff":
                return [t.id for t in self.model.tokenize(text.lower().encode().decode("latin-1").translate(_BYTE_CHARS))]
        return self.encode_plain(text)

    def _learn(self, h: np.ndarray, ids: list[list[int]]) -> None:
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
        n = len(buf)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if self.memo.count > CACHE:
            self._clear()
        inside = NOT_SPACE[buf]
        letter = _LETTER[buf]
        latin = np.flatnonzero(buf == 0xC3)  # the bytes of À to ÿ, without the signs × and ÷
        latin = latin[(latin + 1 < n)]
        latin = latin[(buf[latin + 1] != 0x97) & (buf[latin + 1] != 0xB7)]
        letter[latin] = True
        letter[latin + 1] = True
        mark = _MARK[buf]
        border = np.zeros(n + 1, bool)  # between byte i - 1 and byte i
        border[1:n] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        border[off] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | border[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | border[1:n]
        s, e = np.flatnonzero(start), np.flatnonzero(last) + 1
        h = hashes(buf, s, e)
        which = self.memo.find(h)
        new = np.flatnonzero(which < 0)
        if len(new):
            distinct, at = np.unique(h[new], return_index=True)
            at = new[at]
            raw = buf.tobytes()
            self._learn(distinct, [self._atom(raw[a:b]) for a, b in zip(s[at].tolist(), e[at].tolist(), strict=True)])
            which[new] = self.memo.find(h[new])
        begin = self.start[which]
        size = self.start[which + 1] - begin
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        first = np.concatenate([[0], ends])[np.searchsorted(s, off)]
        special = np.flatnonzero((buf[:-1] == 60) & (buf[1:] == 124))
        if not len(special):
            return ids, first
        odd = set((np.searchsorted(off, special, side="right") - 1).tolist())
        parts = [np.array(self.encode_plain(buf[off[i]: off[i + 1]].tobytes().decode()), np.uint32) if i in odd else ids[first[i]: first[i + 1]]
                 for i in range(len(off) - 1)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cuts(place: np.ndarray, penalty: np.ndarray, capacity: int, more: bool = False) -> list[int]:
    """The cheapest places to cut, ascending, the last place always among them.

    ``place`` ascends from above 0 by at most ``capacity``; ``penalty`` is the
    cost of a cut there. If ``more`` follows, the last window's padding costs
    nothing: else the padding that the total length forces would go anywhere.
    """
    places, costs = [0, *place.tolist()], [0, *penalty.tolist()]
    costs[-1] = 0
    best, back = [0] * len(places), [0] * len(places)
    keys: deque[int] = deque([0])
    queue: deque[int] = deque([0])
    for j in range(1, len(places)):
        p = places[j]
        low = p - capacity
        while places[queue[0]] < low:
            queue.popleft()
            keys.popleft()
        back[j] = queue[0]
        best[j] = b = costs[j] + capacity - p + keys[0]
        b += p
        while keys and keys[-1] >= b:
            keys.pop()
            queue.pop()
        keys.append(b)
        queue.append(j)
    if more:
        low = places[-1] - capacity
        back[-1] = min((i for i in range(len(places) - 1) if places[i] >= low), key=lambda i: best[i])
    out, j = [], len(places) - 1
    while j:
        out.append(places[j])
        j = back[j]
    return out[::-1]


class _Stream:
    """The documents of one partition: ids not yet in a committed sequence."""

    def __init__(self, sentence: np.ndarray, capacity: int, first_sequence: int):
        self.sentence, self.capacity, self.sequence = sentence, capacity, first_sequence
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []  # doc_id, ids before, ids here, ids of the document
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, 0, len(ids), len(ids)))
        self.size += len(ids)

    def commit(self, last: bool) -> dict[str, list]:
        """Cut what is held; all windows but the last become sequences (all, if ``last``)."""
        rows: dict[str, list] = {n: [] for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
        if not self.size:
            return rows
        ids = np.concatenate(self.ids)
        penalty = np.full(len(ids) + 1, -1, np.int64)
        penalty[1:][self.sentence[ids]] = SENTENCE_CUT
        ends = np.cumsum([n for _, _, n, _ in self.docs])
        penalty[ends] = 0
        place = np.flatnonzero(penalty >= 0)
        gap = np.diff(place, prepend=0)
        for i in np.flatnonzero(gap > STEP).tolist():
            inner = np.arange(place[i] - gap[i] + STEP, place[i], STEP)
            penalty[inner] = INNER_CUT
        place = np.flatnonzero(penalty >= 0)
        at = cuts(place, penalty[place], self.capacity, more=not last)
        if not last:
            at = at[:-1]
        done = at[-1] if at else 0
        begin, s = 0, 0
        at_set = iter(at)
        cut = next(at_set, None)
        window = 0  # where the running sequence begins
        rest: list[tuple] = []
        for (doc_id, before, n, total), end in zip(self.docs, ends.tolist(), strict=True):
            a = begin
            while a < end and cut is not None:
                b = min(end, cut)
                part = ids[a:b]
                for name, value in (("doc_id", doc_id), ("start", before + a - begin), ("length", b - a), ("ids_crc32", zlib.crc32(part.astype("<u4").tobytes())),
                                    ("doc_tokens", total), ("sequence_id", self.sequence + s), ("offset", a - window), ("ids", part)):
                    rows[name].append(value)
                a = b
                if b == cut:
                    window, s, cut = b, s + 1, next(at_set, None)
            if a < end:
                rest.append((doc_id, before + a - begin, end - a, total))
            begin = end
        self.sequence += s
        self.docs, self.ids, self.size = rest, [ids[done:]], len(ids) - done
        return rows


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked, ``ids``.

    ``tokenizer`` is the path of a file of the tokenizers library that drops
    white space, the same on every executor.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
             "sequence_id": pa.int64(), "offset": pa.int64()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})

    def batch_of(rows: dict[str, list]) -> pa.RecordBatch:
        columns = [pa.array(rows[n], t) for n, t in kinds.items() if n != "ids"]
        if with_ids:
            flat = np.concatenate(rows["ids"]) if rows["ids"] else np.zeros(0, np.uint32)
            offsets = np.concatenate([[0], np.cumsum(rows["length"])]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32))))
        return pa.RecordBatch.from_arrays(columns, list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        stream = _Stream(own.sentence, capacity, TaskContext.get().partitionId() << 36)
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for lo, hi, buf, off in chunks(batch.column("text")):
                ids, first = own.encode(buf, off)
                for i in range(hi - lo):
                    stream.add(doc_ids[lo + i], np.concatenate([ids[first[i]: first[i + 1]], end]))
                    if stream.size >= BLOCK_IDS:
                        yield batch_of(stream.commit(last=False))
        yield batch_of(stream.commit(last=True))

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents, with their ids."""
    return pack(docs)
