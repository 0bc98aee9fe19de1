"""Vectorised word hashes against regular expressions."""
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from conftest import alnum_words, space_words
from starweave.llm._tokens import ALNUM, NOT_SPACE, Memo, chunks, shingles, words

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet=" \n\tabAB.9é日\x0b-", max_size=40)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXT, st.sampled_from([1, 16, 1 << 20]))
def test_words_and_shingles(texts, limit):
    for table, split in ((NOT_SPACE, space_words), (ALNUM, alnum_words)):
        seen, seen_g = {}, {}
        rows = 0
        for lo, hi, buf, off in chunks(pa.array(texts, pa.string()), limit):
            h, first, _, _ = words(buf, off, table)
            g, at = shingles(h, first, 5)
            for i in range(hi - lo):
                w = split(texts[lo + i])
                own = h[first[i]: first[i + 1]].tolist()
                assert len(own) == len(w)
                assert all(seen.setdefault(a, b) == b for a, b in zip(w, own))
                sh = [tuple(w[k: k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
                own = g[at[i]: at[i + 1]].tolist()
                assert len(own) == len(sh) and all(seen_g.setdefault(a, b) == b for a, b in zip(sh, own))
                rows += 1
        assert rows == len(texts) and len(set(seen.values())) == len(seen) and len(set(seen_g.values())) == len(seen_g)


def test_memo_against_a_dict():
    rng, memo, held = random.Random(1), Memo(64), {}
    for _ in range(30):
        h = np.array(sorted({rng.getrandbits(64) for _ in range(50)}), np.uint64)
        found = memo.find(h)
        assert found.tolist() == [held.get(x, -1) for x in h.tolist()]
        new = h[found < 0]
        memo.put(new, np.arange(len(held), len(held) + len(new), dtype=np.int32))
        held |= dict(zip(new.tolist(), range(len(held), len(held) + len(new))))
    every = np.array(list(held), np.uint64)
    assert memo.find(every).tolist() == list(held.values())
