"""Near-dedup, line dedup and substring dedup against brute force."""
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import space_words
from starweave.llm import line_dedup, near_dedup, substring_dedup
from starweave.llm._linking import components


def shingle_set(text, k=5):
    w = space_words(text)
    return frozenset(tuple(w[i: i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] * bool(w))


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    low = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)].append(doc)
    return [(doc, len(sets[i]), min(low[find(i)], default=None)) for i, (doc, _) in enumerate(rows)]


def key(rows):
    return sorted(rows, key=repr)


def test_near_duplicates(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    got = near_dedup.near_duplicates(corpus).collect()
    # A blank text is linked with nothing.
    assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(brute_components(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_nothing(nothing):
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_near_dedup_stage_keeps_one_of_each_group_and_all_columns(spark, corpus):
    out = near_dedup.stage(spark, corpus, "")
    assert out.columns == corpus.columns
    ids = [r.doc_id for r in out.collect()]
    assert 0 in ids and not {20, 21, 22, 23, 24, 25} & set(ids) and 50 in ids and 51 in ids


def test_a_chain_and_a_wide_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 90)] + [(500, 500)]
    out = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(out[i] == 100 for i in range(100, 161)) and all(out[i] == 0 for i in range(90)) and 500 not in out


def test_blocks_of_one_bucket_meet_each_other(spark, corpus, monkeypatch):
    from starweave.llm import _linking
    monkeypatch.setattr(_linking, "BLOCK_BYTES", 600)
    monkeypatch.setattr(_linking, "ROUNDS", 0)  # the search in blocks alone
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    got = near_dedup.near_duplicates(corpus).collect()
    assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(brute_components(rows))


def brute_lines(rows, least):
    """The lines that stay, by document: windows of every number of lines that occurred before are deleted."""
    docs = {}
    for doc, text in rows:
        if text is not None:
            docs.setdefault((doc is not None, doc, text), text.split("\n"))
    gone = defaultdict(set)
    size = 1
    while size <= max(map(len, docs.values()), default=0):
        seen = set()
        for k in sorted(docs, key=lambda k: (k[0], k[1] if k[0] else 0)):
            for p in range(len(docs[k]) - size + 1):
                run = tuple(docs[k][p: p + size])
                if run in seen and sum(map(len, run)) >= least:
                    gone[k].update(range(p, p + size))
                seen.add(run)
        size += 1
    return {k: [x for i, x in enumerate(v) if i not in gone[k]] for k, v in docs.items()}


def test_lines(spark):
    a, b, c = "the first line that is long enough", "the second line that is long too", "short"
    rows = [(1, "\n".join([a, c, b])), (2, "\n".join(["own", a, c, b, "tail"])), (3, c), (4, a), (5, None), (6, ""), (None, b),
            (7, "\n".join([a, a, a, c, c])), (8, "\n".join([c, b, "x", "x"])), (9, "x\nx"), (2, "\n".join(["own", a, c, b, "tail"]))]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id bigint, text string, n_chars bigint")
    expected = brute_lines(rows, line_dedup.MIN_CHARS)
    got = line_dedup._edited(docs, line_dedup.MIN_CHARS).select("row.doc_id", "row.text", "kept", "had", "lost").collect()
    assert len(got) == len(rows)
    for r in got:
        if r.text is None:
            assert r.kept is None and r.had == r.lost == 0
        else:
            left = expected[(r.doc_id is not None, r.doc_id, r.text)]
            assert (r.kept, r.had - r.lost) == ("\n".join(left), len(left)), r
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    kept = {(r.doc_id, r.text): r.n_chars for r in out.collect()}
    assert (4, "") not in kept and not any(i == 4 for i, _ in kept)  # nothing was left
    assert kept[(6, "")] == 7 and kept[(5, None)] == 7 and kept[(2, "own\ntail")] == 8


@pytest.mark.parametrize("seed", range(3))
def test_lines_by_sql_and_by_every_window(spark, seed):
    """Runs of any number of short lines: the operator, its SQL and all windows of all lengths agree."""
    import random

    import duckdb
    import pandas as pd
    rng = random.Random(seed)
    some = ["", "", "a", "bb", "four", "ten chars.", "ten more..", "a line that is long enough"]
    pieces = [[rng.choice(some) for _ in range(rng.randint(3, 12))] for _ in range(6)]
    rows = [(1, "ten chars.\nten more..\nten again."), (2, "ten chars.\nten more..\nten again."), (3, None), (4, ""), (None, "ten chars.\nown\nten more..")]
    for i in range(10, 35):
        parts = [rng.choice(pieces) if rng.random() < 0.6 else [f"own {i} {rng.randint(0, 9)}"] for _ in range(rng.randint(1, 5))]
        rows.append((i, "\n".join(x for part in parts for x in part)))
    brute = brute_lines(rows, line_dedup.MIN_CHARS)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.kept, r.lost) for r in line_dedup._edited(docs, line_dedup.MIN_CHARS).select("row.doc_id", "kept", "lost").collect()}
    want = {}
    for doc, text in rows:
        left = brute[(doc is not None, doc, text)] if text is not None else []
        want[doc] = (None, 0) if text is None else ("\n".join(left), len(text.split("\n")) - len(left))
    assert got == want and want[2] == ("", 3)
    con = duckdb.connect()
    documents = pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], dtype="Int64"), "text": [r[1] for r in rows]})
    con.register("documents", documents)
    sql = {r[0]: (r[3], r[2]) for r in con.execute(line_dedup.ORACLE_SQL + " ORDER BY 1").fetchall()}
    assert sql == {k: (t if t is None else hashlib.sha256(t.encode()).hexdigest(), n) for k, (t, n) in want.items()}


def test_lines_of_a_corpus_with_clashing_names(corpus, nothing):
    out = line_dedup.dedup_lines(corpus)
    assert out.columns == corpus.columns and out.filter("d = 'x' AND `row` = 'y'").count() == out.count()
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_substring_dedup(spark):
    import random

    from conftest import sentence
    rng = random.Random(3)
    passage = sentence(rng, 70)
    para = sentence(rng, 60)
    near = para.split()
    near[30] = "changed"
    rows = [(i, sentence(rng, 80) + " " + passage + " " + sentence(rng, 40 + i)) for i in range(8)]
    rows += [(20, para), (21, sentence(rng, 50) + "\n" + " ".join(near)), (30, sentence(rng, 400)), (31, None), (32, ""), (None, sentence(rng, 60))]
    docs = spark.createDataFrame([(*r, "t") for r in rows], "doc_id bigint, text string, t string")
    out = {r.d: r for r in substring_dedup.removals(docs).collect()}
    assert set(out) == {*range(1, 8), 21}
    assert all(sum(x["to"] - x["from"] for x in out[i].spans) >= 20 and 0 in out[i].kept_in for i in range(1, 8))
    assert [(x["from"], x["to"]) for x in out[21].spans] == [(50, 110)] and out[21].kept_in == [20]
    assert substring_dedup.removals(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text", [None, "", "   "])
def test_only_empty_documents(spark, text):
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.component_id, r.n_shingles) for r in near_dedup.near_duplicates(docs).collect()) == [(1, 1, 0), (2, 2, 0)]
    assert line_dedup.dedup_lines(docs).count() == 2


def brute_runs(docs, size):
    """Words that a run of ``size`` words at an earlier place repeats, but those of that place itself."""
    first, gone = {}, defaultdict(set)
    for d, text in sorted(docs):
        w = space_words(text)
        for p in range(len(w) - size + 1):
            k = tuple(w[p: p + size])
            d0, p0 = first.setdefault(k, (d, p))
            if (d0, p0) != (d, p):
                gone[d].update(range(max(p, p0 + size) if d0 == d else p, p + size))
    return gone


def test_substring_dedup_finds_every_passage_word_by_word(spark):
    import random

    from conftest import sentence
    rng = random.Random(17)
    rows = []
    for n in [*range(50, 56)] * 8 + [20, 21, 25, 30, 39] * 5:
        passage = sentence(rng, n)
        for _ in range(2):
            rows.append((len(rows), f"{sentence(rng, rng.randint(5, 60))} {passage} {sentence(rng, rng.randint(5, 60))}"))
    rows += [(len(rows), " ".join(["la"] * 70)), (len(rows) + 1, " ".join(sentence(rng, 7).split() * 9)), (len(rows) + 2, rows[0][1].split(" ", 3)[3])]
    out = {r.d: {i for x in r.spans for i in range(x["from"], x["to"])} for r in
           substring_dedup.removals(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {d: w for d, w in brute_runs(rows, 20).items() if w}
    assert {2 * i + 1 for i in range(73)} <= set(out)


def test_substring_dedup_compares_lines_of_20_words(spark):
    import random

    from conftest import sentence
    rng = random.Random(23)
    rows, expected = [], {}
    for n in [20, 21, 24, 30, 39] * 6:
        line = sentence(rng, n).split()
        near = [*line[:-1], "changed"] if n < 39 else [*line[:19], "changed", *line[20:]]
        before = rng.randint(3, 18)
        rows += [(len(rows), " ".join(line)), (len(rows) + 1, f"{sentence(rng, before)}\n{' '.join(near)}\n{sentence(rng, 6)}")]
        expected[len(rows) - 1] = [(before, before + n)]
    out = {r.d: [(x["from"], x["to"]) for x in r.spans] for r in substring_dedup.removals(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == expected


def brute_runs_of_lines(rows, least):
    """Deleted lines by document: windows of every length that occurred before."""
    gone, seen = defaultdict(set), set()
    for d, text in sorted(rows):
        part = text.split("\n")
        for p in range(len(part)):
            for e in range(p + 1, len(part) + 1):
                run = tuple(part[p:e])
                if run in seen and sum(map(len, run)) >= least:
                    gone[d].update(range(p, e))
                seen.add(run)
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in rows}


def test_runs_of_any_number_of_lines(spark):
    import random
    rng = random.Random(31)
    short = ["ten chars.", "Ed.", "", "eleven char", "x", "a line of nineteen."]
    rows = [(1, "one\nten chars.\nten more..\nten again."), (2, "two\nten chars.\nten more..\nten again.\nend"),
            (3, "a heading that is long enough\nEd.\nOf ores the eronnt."), (4, "own\na heading that is long enough\nEd.\nOf ores the eronnt.\nlast")]
    rows += [(i, "\n".join(rng.choice(short) if rng.random() < 0.9 else f"own {i}" for _ in range(rng.randint(1, 25)))) for i in range(5, 60)]
    got = line_dedup._edited(spark.createDataFrame(rows, "doc_id bigint, text string"), line_dedup.MIN_CHARS).select("row.doc_id", "kept").collect()
    expected = brute_runs_of_lines(rows, line_dedup.MIN_CHARS)
    assert expected[2] == "two\nend" and expected[4] == "own\nlast"
    assert {r.doc_id: r.kept for r in got} == expected


def test_stage_keeps_one_row_of_a_component(spark):
    text, near = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(59)) + " x"
    other, last = "a b c d e f g", "one two three four five six"
    rows = [(1, text, "p"), (1, text, "p"), (1, text, "q"), (1, near, "p"), (7, text, "p"),  # one id three times, its near copy, a copy
            (None, other, "p"), (None, other, "q"), (None, last, "p"), (9, last, "p"),       # NULL ids only; a NULL id and another
            (4, "", "p"), (4, "", "p"), (5, None, "p"), (6, "alone here", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, m string")
    got = near_dedup.stage(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    small = min([text, near], key=lambda t: __import__("hashlib").md5(t.encode()).hexdigest())
    assert kept == sorted([(1, small), (None, other), (9, last), (4, ""), (4, ""), (5, None), (6, "alone here")], key=str)


def test_stage_of_an_empty_table(spark, nothing):
    assert near_dedup.stage(spark, nothing, "").count() == 0


def test_small_buckets_send_only_the_texts_that_signatures_allow(spark, monkeypatch):
    """Buckets of few members give the links that the search in blocks gives, and send no text there."""
    import numpy as np
    from starweave.llm import _linking
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, sketches = [], []
    for group in range(30):
        base = rng.choice(vocabulary, 80).tolist()
        sketch = rng.integers(0, 256, 42, dtype=np.uint8)
        for copy in range(3):
            words, own = list(base), sketch.copy()
            if copy:
                words[int(rng.integers(0, 80))] = "changed"
                own[: 4 * copy] += 1
            texts.append(" ".join(words))
            sketches.append(own.tobytes())
    cls = [bytes([0, n]) for n in range(len(texts))]
    # Buckets: near copies together (twice), strangers together, and one crowd of all.
    rows = [(n // 3, cls[n], cls[n]) for n in range(90)] + [(100 + n // 3, cls[n], cls[n]) for n in range(90)]
    rows += [(200 + n % 9, cls[n], cls[n]) for n in range(90)] + [(300, c, c) for c in cls]
    mixed = spark.createDataFrame(rows, "band bigint, cls binary, comp binary")
    held = spark.createDataFrame(list(zip(cls, sketches)), "cls binary, sketch binary")
    whole = spark.createDataFrame(list(zip(cls, texts)), "cls binary, text string")
    pairs = lambda df: {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in df.collect()}
    want = pairs(_linking._across_blocks(mixed, held, whole, 0.75, 5))
    assert len(want) >= 60 and pairs(_linking._across(mixed, held, whole, 0.75, 5)) == want
    monkeypatch.setattr(_linking, "PAIRS", 5)  # several chunks of pairs
    sent = []
    blocks = _linking._across_blocks
    monkeypatch.setattr(_linking, "_across_blocks", lambda mixed, *a: (sent.append(mixed.filter("band < 300").count()), blocks(mixed, *a))[1])
    small = mixed.filter("band < 300")
    assert pairs(_linking._across(small, held, whole, 0.75, 5)) == pairs(blocks(small, held, whole, 0.75, 5)) and sent == [0]


def test_the_anchor_is_the_last_smallest_piece_of_a_run():
    import numpy as np
    from starweave.llm import substring_dedup as s
    rng = np.random.default_rng(3)
    for n, kinds in ((20, 3), (21, 50), (75, 2), (200, 1), (500, 9)):
        h = rng.integers(1, 1 << 62, kinds).astype(np.uint64)[rng.integers(0, kinds, n)]
        g = s._sequence_hash(h, np.arange(n - s.GRAM + 1), np.arange(n - s.GRAM + 1) + s.GRAM, s._A)
        _, place, at = s._anchors(h, np.array([0, n]))
        for p, a in zip(place.tolist(), at.tolist()):
            window = g[p: p + s.SPAN_WORDS - s.GRAM + 1]
            assert a == p + int(np.flatnonzero(window == window.min())[-1])
