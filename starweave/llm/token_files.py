"""Token-id files (12): fixed-width bit packing with block offsets.

An id takes the least bits that the vocabulary needs. A block has ``BLOCK_IDS``
ids (the last of a file fewer); 64 ids of ``b`` bits are ``b`` 64-bit words, so
numpy packs and unpacks all groups of 64 at once, in 64 steps, whatever ``b`` is. A
file:

    magic | blocks | block offsets, block checksums, document ends, document ids, NULL flags | trailer

Offsets lead to the blocks that hold any range of ids; the trailer (fixed size, at
the end) leads to the index. All numbers are little-endian.

Documents are dealt by ranges of ``doc_id`` and each task writes one file of its
own range, under a name of its own attempt. The manifest, a Parquet table with one
row a file, is written by the same job and names the files of the attempts that
Spark kept: files of lost or repeated attempts are never read. Files are written and
read through ``pyarrow.fs``, so the folder can be any store that it knows, shared by
all executors.

Defined results: a NULL or empty text has the end id alone; a NULL ``doc_id`` comes
first and stays NULL; rows of one ``doc_id`` are in the order of their text's hash,
and each has its place; extra columns are ignored; an empty table gives no files and
no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ._byte_bpe import byte_bpe
from ._cluster import Stages
from ._tokens import chunks

END_ID = 0
BLOCK_IDS = 4096
#: Ids that are unpacked at once, about, when documents are read.
RUN_IDS = 1 << 20

_MAGIC = b"IDBITS01"
#: Bits an id, ids a block, ids, documents, place and checksum of the index, magic.
_TRAILER = struct.Struct("<IIQQQI8s")
_GROUP = 64


def bits_for(vocabulary: int) -> int:
    """The least bits that hold the ids 0 to ``vocabulary - 1``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """``ids`` as 64-bit words; the last group of 64 is filled up with zeros."""
    lanes = np.zeros((-(-len(ids) // _GROUP), _GROUP), np.uint64)
    lanes.ravel()[: len(ids)] = ids
    words = np.zeros((len(lanes), bits), np.uint64)
    for j in range(_GROUP):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return words.ravel()


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    """The ids of whole groups of 64."""
    words = words.reshape(-1, bits)
    lanes = np.empty((len(words), _GROUP), np.uint64)
    for j in range(_GROUP):
        word, shift = divmod(j * bits, 64)
        lanes[:, j] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lanes[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
    lanes &= np.uint64((1 << bits) - 1)
    return lanes.ravel().astype(np.uint32)


@dataclass
class FileWriter:
    """Writes one file; holds less than a block of ids besides the index."""

    stream: object
    bits: int
    rest: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    offsets: list[int] = field(default_factory=lambda: [len(_MAGIC)])
    checksums: list[int] = field(default_factory=list)
    ends: list[np.ndarray] = field(default_factory=list)
    doc_ids: list[pa.Array] = field(default_factory=list)
    count: int = 0

    def __post_init__(self):
        self.stream.write(_MAGIC)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        """Documents whose ids stand one after the other in ``ids`` and end at ``ends``."""
        self.doc_ids.append(doc_ids)
        self.ends.append(self.count + ends)
        self.count += len(ids)
        self.rest = np.concatenate([self.rest, ids])
        whole = len(self.rest) // BLOCK_IDS
        if whole:
            self._blocks(self.rest[: whole * BLOCK_IDS])
            self.rest = self.rest[whole * BLOCK_IDS:]

    def _blocks(self, ids: np.ndarray) -> None:
        packed = pack(ids, self.bits).astype("<u8", copy=False).tobytes()
        size = BLOCK_IDS // _GROUP * self.bits * 8
        for at in range(0, len(packed), size):
            block = packed[at: at + size]
            self.checksums.append(zlib.crc32(block))
            self.offsets.append(self.offsets[-1] + len(block))
        self.stream.write(packed)

    def close(self) -> tuple[int, int]:
        """Writes index and trailer; documents and ids of the file."""
        if len(self.rest):
            self._blocks(self.rest)
        ids = pa.chunked_array(self.doc_ids, pa.int64()).combine_chunks()
        index = b"".join([np.array(self.offsets, "<u8").tobytes(), np.array(self.checksums, "<u4").tobytes(), np.concatenate(self.ends).astype("<u8").tobytes(),
                          ids.fill_null(0).to_numpy().astype("<i8").tobytes(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()])
        self.stream.write(index)
        self.stream.write(_TRAILER.pack(self.bits, BLOCK_IDS, self.count, len(ids), self.offsets[-1], zlib.crc32(index), _MAGIC))
        self.stream.close()
        return len(ids), self.count


class TokenFile:
    """Random access to one file: any range of ids, or any documents, by the blocks that hold them."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        stream.seek(size - _TRAILER.size)
        self.bits, self.block_ids, self.n_ids, self.n_docs, index_at, checksum, magic = _TRAILER.unpack(stream.read(_TRAILER.size))
        if magic != _MAGIC:
            raise ValueError("not a token-id file")
        stream.seek(index_at)
        index = stream.read(size - _TRAILER.size - index_at)
        if zlib.crc32(index) != checksum:
            raise ValueError("the index of a token-id file is damaged")
        n_blocks, at = -(-self.n_ids // self.block_ids), 0
        tables = []
        for kind, n in (("<u8", n_blocks + 1), ("<u4", n_blocks), ("<u8", self.n_docs), ("<i8", self.n_docs), ("u1", self.n_docs)):
            tables.append(np.frombuffer(index, kind, n, at))
            at += tables[-1].nbytes
        self.offsets, self.checksums, ends, self.doc_ids, self.no_id = tables
        #: Where each document begins, and the end of the last one.
        self.begins = np.concatenate([[0], ends]).astype(np.int64)

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids ``a`` to ``b - 1`` of the file; only the blocks that hold them are read."""
        if a >= b:
            return np.zeros(0, np.uint32)
        first, last = a // self.block_ids, (b - 1) // self.block_ids
        lo, hi = int(self.offsets[first]), int(self.offsets[last + 1])
        self.stream.seek(lo)
        data = self.stream.read(hi - lo)
        for i in range(first, last + 1):
            if zlib.crc32(data[int(self.offsets[i]) - lo: int(self.offsets[i + 1]) - lo]) != self.checksums[i]:
                raise ValueError(f"block {i} of a token-id file is damaged")
        found = unpack(np.frombuffer(data, "<u8").astype(np.uint64, copy=False), self.bits)
        return found[a - first * self.block_ids: b - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.begins[i]), int(self.begins[i + 1]))

    def runs(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """All documents in runs of about ``RUN_IDS`` ids, or one longer document: first, end, ids."""
        lo = 0
        while lo < self.n_docs:
            hi = max(lo + 1, int(np.searchsorted(self.begins, self.begins[lo] + RUN_IDS, side="right")) - 1)
            yield lo, hi, self.ids(int(self.begins[lo]), int(self.begins[hi]))
            lo = hi


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the ids of ``docs(doc_id, text)`` in ascending ``doc_id`` order under ``folder``; the manifest.

    ``tokenizer`` is the path of a byte-level BPE of the tokenizers library, the
    same on every executor. Manifest: ``place, file, n_docs, n_ids``; a file with
    a smaller ``place`` has the smaller documents.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, writer, task = byte_bpe(path), None, TaskContext.get()
        store, root = pafs.FileSystem.from_uri(folder)
        name = f"ids-{task.partitionId():06d}-{task.taskAttemptId()}.bits"
        for batch in batches:
            for lo, hi, buf, off in chunks(batch.column("text")):
                if writer is None:
                    store.create_dir(f"{root}/ids", recursive=True)
                    writer = FileWriter(store.open_output_stream(f"{root}/ids/{name}"), bits_for(max(own.size, end_id + 1)))
                ids, first = own.encode(buf, off)
                ends = first[1:] + np.arange(1, hi - lo + 1)
                with_end = np.full(len(ids) + hi - lo, end_id, np.uint32)
                held = np.ones(len(with_end), bool)
                held[ends - 1] = False
                with_end[held] = ids
                writer.add(batch.column("doc_id").slice(lo, hi - lo), with_end, ends)
        if writer:
            n_docs, n_ids = writer.close()
            yield pa.RecordBatch.from_pydict({"place": pa.array([task.partitionId()], pa.int32()), "file": [name], "n_docs": [n_docs], "n_ids": [n_ids]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("n"))
    order = [F.asc_nulls_first("doc_id"), F.asc("h"), F.asc("n")]  # a frequent id is split as well
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    dealt.mapInArrow(run, "place int, file string, n_docs bigint, n_ids bigint").write.parquet(f"{folder}/manifest")
    return manifest(docs.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("place int, file string, n_docs bigint, n_ids bigint").parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids`` of each document of the files under ``folder``."""
    files = manifest(spark, folder)
    # One row a file: the sum before it is where its ids begin.
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.withColumn("start", before).repartition(max(1, files.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with store.open_input_file(f"{root}/ids/{name}") as stream:
                    own = TokenFile(stream)
                    for lo, hi, ids in own.runs():
                        begins = own.begins[lo: hi + 1] - own.begins[lo]
                        raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                        crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
                        columns = [pa.array(own.doc_ids[lo:hi], pa.int64(), mask=own.no_id[lo:hi].astype(bool)), pa.array(start + own.begins[lo:hi], pa.int64()),
                                   pa.array(np.diff(begins), pa.int64()), pa.array(crc, pa.int64())]
                        if with_ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids.astype(np.int32))))
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return files.select("file", "start").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def op12_token_files(spark, sf_dir: str) -> DataFrame:
    folder = Stages(spark, "token-files").folder
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_tokens(spark, folder, with_ids=False)
