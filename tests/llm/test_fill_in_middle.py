"""Operator 13 against a plain version, and its exact round trip."""
import hashlib
import random
import re

import pytest

from starweave.llm import fill_in_middle as M

SCHEMA = "doc_id bigint, text string, n string, form int, output string, h1 string"


def plain(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[8 * i: 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text, text)
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    return (doc_id, n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}", text)


def texts():
    rng = random.Random(9)
    parts = ["a", "Zed", " ", "\n", "é", "日本", "😀", "1", "<", "P>", "S>", "M>", ">", "<S", "end.", "\x00", " "]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(1500)]
    rows += [(2000 + i, "one" + "!" * i) for i in range(40)] + [(None, None), (None, "no id here"), (3000, ""), (3001, None), (3002, "x<M>y")]
    rows += [(3100, "ab " * 300_000), (3101, "é" * 700_000), (5, "same"), (5, "same")]
    return rows


def test_equals_plain_version_and_restores(spark):
    rows = texts()
    docs = spark.createDataFrame([(*r, "x", 1, None, "y") for r in rows], SCHEMA).repartition(4)
    made = M.restored(M.fill_in_middle(docs)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[6])
    assert sorted(map(tuple, made), key=key) == sorted((plain(*r) for r in rows), key=key)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("rate, spm_rate, forms", [(0, 20, {"plain"}), (100, 0, {"psm"}), (100, 100, {"spm"})])
def test_rates(spark, rate, spm_rate, forms):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(50)], "doc_id bigint, text string")
    made = M.restored(M.fill_in_middle(docs, rate, spm_rate, seed="other")).collect()
    assert {r["form"] for r in made} == forms and all(r["restored"] == f"some words {r['doc_id']}" for r in made)


def test_empty_table(spark, nothing):
    assert M.restored(M.fill_in_middle(nothing)).collect() == []
