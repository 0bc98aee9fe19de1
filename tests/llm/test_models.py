"""Language ID, toxicity and quality: held-out accuracy, defined cases, automata against brute force."""
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import sentence
from starweave.llm import language_id, quality, toxicity
from starweave.llm._labels import remainder

LANGUAGES = {"aa": "abcdefgh", "bb": "hijklmno", "cc": "opqrstuv"}


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    rows = []
    for i in range(360):
        lang = sorted(LANGUAGES)[i % 3]
        words = sentence(rng, rng.randint(20, 60), LANGUAGES[lang]).split()
        toxic, bad = int(i % 5 == 0), int(i % 4 == 0)
        if toxic:
            for w in ("blockhead", "dimwitted"):
                words[rng.randrange(len(words))] = w
        text = " ".join(f"{w}###" for w in words) if bad else " ".join(words) + "."
        rows.append((i, text, lang, toxic, 1 - bad))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int, quality int").checkpoint()
    return df.select("doc_id", "text", "lang"), df.select("doc_id", "quality", "toxic")


ODD = [(1000, None), (1001, ""), (1002, "123 !?"), (None, "abc"), (1003, "b" * 200_000)]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id bigint, text string")


def test_language(spark, texts):
    docs, _ = texts
    model = language_id.learn(docs)
    got = {r.doc_id: r for r in language_id.predicted(docs, model).collect()}
    truth = docs.select("doc_id", "lang", (remainder(F.col("doc_id"), 4) == 2).alias("held")).collect()
    held = [r for r in truth if r.held]
    assert held and sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)
    rest = {r.doc_id: r for r in language_id.predicted(odd(spark), model).collect()}
    assert all((rest[i].lang_pred, rest[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert rest[None].lang_pred == "aa" and 0 <= rest[1003].score <= 1


def test_language_without_labels(spark, nothing):
    assert language_id.learn(nothing) is None
    assert [r.lang_pred for r in language_id.predicted(odd(spark), None).collect()] == ["und"] * len(ODD)


def test_code_lengths_are_those_of_the_tree():
    """The costs of all followers of a context and its escapes make one distribution, up to what is escaped twice."""
    codes = np.array([ord("a"), ord("b")], np.uint64)
    pairs = np.array([(ord("a") << 8) | ord("b")], np.uint64)
    counted = {1: (codes, np.array([[3.0], [1.0]])), 2: (pairs, np.array([[2.0]]))} | {n: (np.zeros(0, np.uint64), np.zeros((0, 1))) for n in (3, 4, 5)}
    trees = [language_id._Tree(*counted[n]) for n in range(1, 6)]
    cost = lambda n, *code: language_id._costs(trees, n, np.array(code, np.uint64), 1)[:, 0].tolist()
    assert np.allclose(cost(1, ord("a"), ord("b"), ord("z")), [np.log2(6 / 3), np.log2(6 / 1), np.log2(6 / 2) + 8])
    ab, aa = (ord("a") << 8) | ord("b"), (ord("a") << 8) | ord("a")
    assert np.allclose(cost(2, ab, aa), [np.log2(3 / 2), np.log2(3 / 1) + np.log2(6 / 3)])


def distance_rows(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row


TERMS = [("idiot", True), ("worthless", True), ("scum", True), ("stemmy", False), ("stem", False)]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(TERMS), st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["", "a", "s", "te"]), st.booleans()), max_size=3))
def test_automaton_against_edit_distance(term, edits):
    lexicon = toxicity.Lexicon(TERMS)
    word = term[0]
    for at, put, drop in edits:
        word = word[:at] + put + word[at + drop:]
    best = None
    for t, (letters, whole) in enumerate(lexicon.terms):
        row = distance_rows(letters, word)
        d = row[-1] if whole else min(row)
        if d <= toxicity.edits_allowed(letters, whole) and (best is None or (d, t) < best):
            best = (d, t)
    assert lexicon.match(word) == (best and (best[1], best[0]))


def test_toxicity(spark, texts, tmp_path):
    docs, labels = texts
    model = toxicity.learn(docs, labels)
    assert {t for t, _ in model.terms} >= {"blockhead", "dimwitted"}
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert sum((got[r.doc_id] >= 0.7) == (r.toxic == 1) for r in labels.collect()) >= 355
    cases = [(1, "you blokchead and dimwited one"), (2, "nothing here"), (3, None), (4, 'he said "blockhead" once ' + "abc " * 80)]
    near = {r.doc_id: r.score for r in toxicity.scored(spark.createDataFrame(cases, "doc_id bigint, text string"), model).collect()}
    assert near[1] >= 0.7 and near[2] == near[3] < 0.1 and near[4] < near[1]
    kept = toxicity.keep_clean(odd(spark).withColumn("score", F.lit("x")), model)
    assert kept.count() == len(ODD) and kept.columns == ["doc_id", "text", "score"]


def test_quality(spark, texts):
    docs, labels = texts
    model = quality.learn(docs, labels)
    got = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    held = [r for r in labels.withColumn("held", remainder(F.col("doc_id"), 3) == 1).collect() if r.held]
    assert sum((got[r.doc_id] >= 0.5) == (r.quality == 1) for r in held) >= 0.9 * len(held)
    rest = quality.scored(odd(spark), model).collect()
    assert len(rest) == len(ODD) and all(0 <= r.score <= 1 for r in rest)


def test_models_without_labels(spark, texts, nothing):
    docs, labels = texts
    none = labels.limit(0)
    assert [r.score for r in toxicity.scored(odd(spark), toxicity.learn(docs, none)).collect()] == [0.0] * len(ODD)
    assert [r.score for r in quality.scored(odd(spark), quality.learn(docs, none)).collect()] == [0.5] * len(ODD)
    assert quality.scored(nothing, quality.learn(nothing, none)).count() == 0


def test_labels_of_the_held_out_fold_are_not_used(spark, texts):
    from starweave.llm._labels import labelled
    docs, labels = texts
    held = {r.text for r in docs.filter(remainder(F.col("doc_id"), 3) == 1).collect()}
    sample = labelled(docs, labels, "toxic", 1, 3, 50).collect()
    assert sample and not held & {r.text for r in sample}
    assert sum(r.label == 0 for r in sample) < 80


def test_toxicity_of_thinned_labels_is_that_of_all(spark):
    rng = random.Random(29)
    rows = []
    for i in range(3000):
        words = sentence(rng, 30, "klmnopqr").split()
        toxic = int(i % 20 < 3)
        hits = (1 if rng.random() < 0.1 else 2) if toxic else int(rng.random() < 0.03)
        for at in rng.sample(range(30), hits):
            words[at] = "blockhead"
        rows.append((i, " ".join(words), toxic))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").checkpoint()
    probe = spark.createDataFrame([(n, "lorem ipsum dolor " * 9 + "blockhead " * n) for n in range(3)], "doc_id bigint, text string")
    whole, thinned = ({r.doc_id: r.score for r in toxicity.scored(probe, toxicity.learn(df, df, bound)).collect()} for bound in (4000, 290))
    assert whole[1] < toxicity.THRESHOLD < whole[2]
    assert all(abs(whole[n] - thinned[n]) < 0.12 and (whole[n] < toxicity.THRESHOLD) == (thinned[n] < toxicity.THRESHOLD) for n in whole), (whole, thinned)
