"""Operator 11 against a plain trie of Python tuples."""
import hashlib
import random
import zlib

import pytest

from starweave.llm import prefix_trie as P

SCHEMA = "conv_id bigint, turn int, role string, text string, part int, depth string, n int, weight string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations():
    rng = random.Random(3)
    rows = []
    say = [f"tëxt {i} " * (i % 4) for i in range(4)]
    for c in [*range(0, 40), 100, 101, 199, 205, 250, 4095, 4096, 9000, 9001, 70_000, -3, -250, 2**62]:
        for turn in range(rng.choice([1, 2, 2, 3, 7, 9])):
            rows.append((c, turn, ["user", "assistant"][turn % 2], rng.choice(say[:2] if turn < 2 else say)))
    for c in (300, 301, 302, 5303, 9304):  # copies with one common beginning
        rows += [(c, t, "user", "hello") for t in range(4)]
    rows += [(6001 + i, 0, "user", "one") for i in range(12)]  # base absent: many are turnless
    rows += [(300, None, None, None), (300, None, None, None), (300, 1, "user", "tie"), (301, 1, "user", ""), (None, 0, "user", "lost"), (7, 3, None, None)]
    rows += [(400, t, "user", f"long {t % 3}") for t in range(700)]
    rng.shuffle(rows)
    return rows


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    sign = lambda c: c - (abs(c) % 100) * (1 if c >= 0 else -1)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(sign(c), [])[:h] + turns[h:])
    return out


def brute(rows):
    seqs, nodes = rebuilt(rows), {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p, members in nodes.items():
        cost = (len(members) - 1) * (len(p[-1][1]) if p else 0)
        for d in range(len(p) + 1):
            saved[p[:d]] += cost
            leaves[p[:d]] += children[p] == 0
    ends = lambda p: ",".join(str(c) for c in sorted(nodes[p]) if len(seqs[c]) == len(p))
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest())
                  for p, m in nodes.items())


@pytest.fixture(scope="module")
def rows():
    return conversations()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", None, "y") for r in rows], SCHEMA).repartition(5).checkpoint()


@pytest.fixture(scope="module")
def trie(table):
    return P.prefix_trie(table)


def test_nodes_equal_brute_force(trie, rows):
    found = sorted(tuple(r) for r in trie.nodes.select(*NAMES).collect())
    assert found == brute(rows)
    assert any(len(s) == 0 for s in rebuilt(rows).values())


def test_end_lists_in_blocks(trie, rows):
    of = {}
    for r in trie.ends.collect():
        assert all(i >> P.END_BLOCK_BITS == r["block"] for i in r["ids"])
        of.setdefault((r["depth"], r["k1"], r["k2"]), []).extend(r["ids"])
    expected = {}
    for c, s in rebuilt(rows).items():
        expected.setdefault(s, []).append(c)
    assert sorted(sorted(v) for v in of.values()) == sorted(sorted(v) for v in expected.values())
    assert max(len({i >> P.END_BLOCK_BITS for i in v}) for v in expected.values()) > 1


def test_last_turns_of_nodes(trie, table, rows):
    seqs = rebuilt(rows)
    for r in trie.with_turns(table).collect():
        s = seqs[r["conv_id"]]
        assert (r["role"], r["text"]) == (s[r["depth"] - 1] if r["depth"] else (None, None))


def test_hot_parents_by_broadcast(table, rows, monkeypatch):
    monkeypatch.setattr(P, "HOT_PARENTS", 1 << 40)
    many = [*rows, *[(10**6 + 100 * i, 0, "user", "hi") for i in range(3)]]
    wide = [(2_000_000 + 100 * i, t, "user", f"{t}-{i}" if t else "start") for i in range(160) for t in range(8)]
    spark = table.sparkSession
    frame = spark.createDataFrame(many + wide, "conv_id bigint, turn int, role string, text string")
    assert sorted(tuple(r) for r in P.prefix_trie(frame).nodes.select(*NAMES).collect()) == brute(many + wide)


def test_empty_table(spark):
    none = P.prefix_trie(spark.createDataFrame([], SCHEMA))
    assert none.nodes.count() == 0 and none.ends.count() == 0


def test_one_turnless_conversation(spark):
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6)
    rows = [(c, 0, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    found = [tuple(r) for r in P.prefix_trie(frame).nodes.select(*NAMES).collect()]
    assert found == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
