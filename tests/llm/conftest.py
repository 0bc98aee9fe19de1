"""A small corpus with the awkward cases, and its brute-force readers."""
import random
import re

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, d string, t string, row string"


def sentence(rng, n, alphabet="abcdefghij"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(n))


def make_corpus():
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, near and exact copies."""
    rng = random.Random(5)
    base = [sentence(rng, 60) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20 + i, base[0]) for i in range(6)]  # exact copies
    for i in range(10):  # near copies, one or two words changed
        w = base[1].split()
        w[rng.randrange(60)] = f"x{i}"
        rows.append((30 + i, " ".join(w)))
    rows += [(50, None), (51, ""), (52, "  \n\t "), (None, base[2]), (None, None), (53, "one"), (54, "one"), (55, "a b c d e")]
    rows += [(60, sentence(rng, 30_000)), (61, "\n".join(base[3:6])), (61, "\n".join(base[3:6])), (62, "\n".join([sentence(rng, 4), base[4], base[5]]))]
    rows += [(63, base[7].upper()), (64, "ünïcödé “quoted” 日本語 " + base[8])]
    return [(i, t, None if k % 7 == 0 else "en", None, None if k % 5 == 0 else len(t or ""), "x", None, "y") for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def corpus(spark):
    """Extra columns have names that operators use inside."""
    return spark.createDataFrame(make_corpus(), SCHEMA).checkpoint()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
