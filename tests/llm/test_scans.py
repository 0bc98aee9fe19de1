"""Decontamination, packing, sharding, fingerprints against brute force."""
import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import alnum_words, lower
from starweave.llm import decontaminate, fingerprints, packing, sharding


def brute_hits(docs, items, width=10):
    out = []
    wins = []
    for item, text in items:
        w = alnum_words(text)
        if w:
            n = min(width, len(w))
            wins.append((item, {tuple(w[i: i + n]) for i in range(len(w) - n + 1)}, n))
    for doc, text in docs:
        w, hit, found = alnum_words(text), set(), set()
        for item, own, n in wins:
            for i in range(len(w) - n + 1):
                if tuple(w[i: i + n]) in own:
                    hit.update(range(i, i + n))
                    found |= {str(item)} if item is not None else set()
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def contamination_case(spark, corpus):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    w = [alnum_words(t) for _, t in rows]
    long = max(w, key=len)
    items = [(1, " ".join(w[3][5:30]).upper()), (2, " ".join(w[4][:9])), (10, " ".join(w[4][:9])), (3, None), (4, "?!"), (5, "one"),
             (6, " ".join(long[-12:])), (None, " ".join(w[5][10:21])), (7, "never seen words here at all in any of them x"), (8, " ".join(w[6][:10] + w[7][:10]))]
    return rows, items, spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("block", [1 << 22, 200])
def test_decontamination(spark, corpus, block):
    rows, items, frame = contamination_case(spark, corpus)
    found = decontaminate.contamination(corpus, frame, block_bytes=block)
    hit = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["from"], s["to"] - 1)))))
    got = found.select("doc_id", "n_words", hit, F.size("items"), F.sha2(F.array_join("items", ","), 256), hit > 0).collect()
    expected = brute_hits(rows, items)
    assert sorted((tuple(r) for r in got), key=repr) == expected
    kept = decontaminate.clean(corpus, frame, block_bytes=block)
    assert kept.columns == corpus.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in expected if not r[5]), key=repr)


def test_decontamination_without_items_or_documents(corpus, nothing, spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r.contaminated for r in decontaminate.report(corpus, none).collect())
    assert decontaminate.report(nothing, none).count() == 0


def test_packing_keeps_every_id_once(corpus, nothing):
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(corpus).collect()
    expected = sorted(([r.doc_id, [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]] for r in corpus.collect()), key=repr)
    # Rows of one document: its pieces, which cover it without gaps.
    seqs, docs, current = {}, [], None
    for r in rows:
        assert list(r.ids) and r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at = seqs.setdefault(r.sequence_id, 0)
        assert r.offset == at
        seqs[r.sequence_id] += r.length
        if r.start == 0:
            current = [r.doc_id, []]
            docs.append(current)
        assert r.start == len(current[1])
        current[1].extend(r.ids)
        assert r.doc_tokens >= len(current[1])
    assert sorted(docs, key=repr) == expected
    assert max(seqs.values()) <= 2048 and packing.pack(nothing).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(2)
    for _ in range(200):
        gaps = rng.integers(1, 8, rng.integers(1, 14))
        place, capacity = np.cumsum(gaps), 10
        penalty = rng.integers(0, 5, len(place))

        def cost(chosen):
            at = [0, *chosen]
            return sum(capacity - (b - a) for a, b in zip(at, at[1:])) + sum(int(penalty[place.tolist().index(c)]) for c in chosen[:-1])

        best = math.inf
        for mask in range(1 << (len(place) - 1)):
            chosen = [int(p) for i, p in enumerate(place[:-1]) if mask >> i & 1] + [int(place[-1])]
            if all(b - a <= capacity for a, b in zip([0, *chosen], chosen)):
                best = min(best, cost(chosen))
        got = packing.cuts(place, penalty, capacity)
        assert got[-1] == place[-1] and all(b - a <= capacity for a, b in zip([0, *got], got)) and cost(got) == best


def test_a_stream_in_blocks_wastes_little():
    rng = np.random.default_rng(1)
    sentence = np.zeros(100, bool)
    sentence[7] = True
    stream = packing._Stream(sentence, 2048, 0)
    used, sequences = 0, set()
    for i in range(400):
        stream.add(i, rng.integers(0, 100, rng.integers(1, 6000)).astype(np.uint32))
        if stream.size >= 50_000:
            rows = stream.commit(False)
            used, sequences = used + sum(rows["length"]), sequences | set(rows["sequence_id"])
    rows = stream.commit(True)
    used, sequences = used + sum(rows["length"]), sequences | set(rows["sequence_id"])
    assert used / (2048 * len(sequences)) > 0.98


def test_shards(corpus, nothing):
    rows = sharding.shard(corpus).collect()
    texts = corpus.collect()
    assert len(rows) == len(texts)
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (repr(r.doc_id), len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in texts)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert all(r.grown_shard in (r.shard, 24) for r in rows)
    assert len({(r.doc_id, r.shard) for r in rows}) == len({r.doc_id for r in rows})
    assert sharding.shard(nothing).count() == 0


def test_shards_are_even_and_follow_weights(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    n = {r.shard: r["count"] for r in sharding.shard(docs).groupBy("shard").count().collect()}
    assert len(n) == 24 and min(n.values()) > 180 and max(n.values()) < 330
    two = {r.shard: r["count"] for r in sharding.shard(docs, (1.0, 3.0)).groupBy("shard").count().collect()}
    assert abs(two[1] / 6000 - 0.75) < 0.03
    moved = sharding.shard(docs).filter("grown_shard <> shard").count()
    assert abs(moved / 6000 - 1 / 25) < 0.015


def test_slots_of_one_key_that_fills_the_table(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 8)
    docs = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    rows = sharding.shard(docs.repartition(5)).groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert all(r.n == r.d == r.m + 1 for r in rows)


def brute_winnow(grams, window):
    """Hash and place of the rightmost smallest k-gram of each window."""
    out = []
    for i in range(max(1, len(grams) - window + 1)) if grams else ():
        own = grams[i: i + window]
        j = max(k for k, x in enumerate(own) if x == min(own))
        if (own[j], i + j) not in out:
            out.append((own[j], i + j))
    return out


def test_fingerprints(spark, corpus):
    df = fingerprints.with_fingerprint(corpus.select("doc_id", "text"), "text", "f")
    grams = df.select("text", fingerprints.unpacked(F.col("f")).alias("f")).collect()
    hashed = {}
    words = {w for r in grams for w in lower(r.text).split()}
    for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.pmod(F.xxhash64(F.lower("w")), F.lit(2**31 - 1)).alias("h")).collect():
        hashed[r.w] = r.h
    for r in grams:
        if r.text and not r.text.isascii():
            continue  # lower-casing beyond ASCII is Spark's
        h = [hashed[w] for w in lower(r.text).split()]
        g = []
        for i in range(max(1, len(h) - 2) if h else 0):
            total = len(h) if len(h) < 3 else 0
            for x in h[i: i + 3]:
                total = (total * 1_000_003 + x) % (2**31 - 1)
            g.append(total)
        assert [(x["hash"], x["place"]) for x in r.f] == brute_winnow(g, 4)


def test_shared_runs_are_found(spark):
    import random

    from conftest import sentence
    rng = random.Random(9)
    run = sentence(rng, 6)
    docs = spark.createDataFrame([(sentence(rng, rng.randint(0, 30)) + " " + run + " " + sentence(rng, 20),) for _ in range(30)], "text string")
    rows = [{x["hash"] for x in r.f} for r in fingerprints.with_fingerprint(docs, "text", "f").select(fingerprints.unpacked(F.col("f")).alias("f")).collect()]
    assert all(a & b for a in rows for b in rows)


@pytest.mark.parametrize("range_rows", [1024, 3])
def test_next_document_and_edited_text(spark, tmp_path, monkeypatch, range_rows):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", range_rows)
    rows = [(i, ("w%d " % i) * (i % 9)) for i in range(40)] + [(99, None), (98, ""), (97, "ab")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in fingerprints.op1_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 3
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256((t[: len(t) - m] + after[:m]).encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert len({r.fingerprint for r in got.values() if r.doc_id in (0, 9, 18, 98, 99)}) == 1
