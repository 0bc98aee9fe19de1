"""Operator 12: round trips through files, against the tokenizer itself."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import public_tokenizers
import pytest

from starweave.llm import token_files as T
from starweave.llm._byte_bpe import ByteBpe
from starweave.llm._cluster import Stages
from starweave.llm._tokens import chunks

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return ByteBpe(PATH)


@pytest.mark.parametrize("bits", [1, 2, 5, 7, 8, 13, 16, 17, 24, 31, 32])
def test_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (1, 63, 64, 65, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        ids[-1] = (1 << bits) - 1
        words = T.pack(ids, bits)
        assert len(words) == -(-n // 64) * bits
        assert (T.unpack(words, bits)[:n] == ids).all()
        assert all((int(w) >> k) & 1 == (int(ids[(64 * i + k) // bits]) >> ((64 * i + k) % bits)) & 1
                   for i, w in enumerate(words[: n * bits // 64].tolist()) for k in (0, 17, 63))


def test_bits_for():
    assert [T.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_atoms_never_change_ids(encoder):
    rng = random.Random(11)
    pieces = [" ", "  ", "\n", "\n\n", "\t", " ", " ", "　", "᠎", "\x85", "\x1c", "é", "ß", "×", "÷", "«", "»", "“", "don't", "I'll", "'s", "'", "''re",
              "word", "Word", "12", "3.4", ",", "...", "!?", "(", ")", "日本", "é", "😀", "<", "|", "<|endoftext|>", "​", "_", "-", "à", "\x00", "\r\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(4000)] + ["", " ", "\n ", "x" * 5000]
    for lo, hi, buf, off in chunks(pa.array(texts)):
        ids, first = encoder.encode(buf, off)
        for i in range(hi - lo):
            assert ids[first[i]: first[i + 1]].tolist() == encoder.encode_plain(texts[lo + i]), texts[lo + i]


def expected(rows, encoder):
    """``doc_id, start, n_tokens, crc`` of rows in file order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*encoder.encode_plain(text or ""), 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_files_hold_the_corpus(spark, corpus, encoder):
    folder = Stages(spark, "token-test").folder
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one file
    try:
        files = T.write_tokens(corpus.repartition(3), folder).orderBy("place").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) > 1 and sum(f["n_docs"] for f in files) == corpus.count()
    found = sorted(T.read_tokens(spark, folder).collect(), key=lambda r: r["start"])
    ids = [(-1 if r["doc_id"] is None else r["doc_id"]) for r in found]
    assert ids == sorted(ids) and ids[0] == -1
    texts = {}
    for r in corpus.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    rows = []
    for r in found:  # rows of one id are in the order of a hash of their texts: any order of them is right here
        mine = next(t for t in texts[r["doc_id"]] if [*encoder.encode_plain(t or ""), 0] == r["ids"])
        texts[r["doc_id"]].remove(mine)
        rows.append((r["doc_id"], mine))
    assert [tuple(r) for r in found] == expected(rows, encoder)
    assert not any(texts.values())


def test_random_access_and_damage(spark, corpus):
    folder = Stages(spark, "token-test").folder
    T.write_tokens(corpus, folder)
    store, root = pafs.FileSystem.from_uri(folder)
    of = {tuple(r["ids"]) for r in T.read_tokens(spark, folder).collect()}
    for f in T.manifest(spark, folder).collect():
        path = f"{root}/ids/{f['file']}"
        own = T.TokenFile(store.open_input_file(path))
        assert (own.n_docs, own.n_ids, own.bits) == (f["n_docs"], f["n_ids"], 16)
        every = own.ids(0, own.n_ids)
        rng = random.Random(1)
        for _ in range(30):
            a, b = sorted(rng.randrange(own.n_ids + 1) for _ in range(2))
            assert (own.ids(a, b) == every[a:b]).all()
        assert all(tuple(own.document(i).tolist()) in of for i in range(own.n_docs))
    with store.open_input_file(path) as stream:
        data = bytearray(stream.read())
    data[len(T._MAGIC) + 3] ^= 4
    bad = T.TokenFile(pa.PythonFile(__import__("io").BytesIO(bytes(data)), mode="r"))
    with pytest.raises(ValueError, match="damaged"):
        bad.ids(0, 10)
    data[-T._TRAILER.size - 1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        T.TokenFile(pa.PythonFile(__import__("io").BytesIO(bytes(data)), mode="r"))


def test_files_of_lost_attempts_are_not_read(spark, corpus):
    folder = Stages(spark, "token-test").folder
    T.write_tokens(corpus, folder)
    before = T.read_tokens(spark, folder, with_ids=False).count()
    store, root = pafs.FileSystem.from_uri(folder)
    with store.open_output_stream(f"{root}/ids/ids-000000-999999.bits") as stream:
        stream.write(b"half a file")
    assert T.read_tokens(spark, folder, with_ids=False).count() == before


def test_empty_table(spark, nothing):
    folder = Stages(spark, "token-test").folder
    assert T.write_tokens(nothing, folder).count() == 0
    assert T.read_tokens(spark, folder).count() == 0
