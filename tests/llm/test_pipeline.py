"""The pipeline against a brute-force version of its stages on a small corpus."""
import random

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from conftest import sentence
from starweave.llm import line_dedup
from test_near_and_lines import brute_components, brute_lines
from test_scans import brute_hits


def documents():
    rng = random.Random(11)
    rows, toxic = [], {}
    for i in range(150):
        lines = [sentence(rng, rng.randint(8, 30)) for _ in range(rng.randint(1, 4))]
        toxic[i] = int(i % 5 == 0)
        if toxic[i]:
            lines[0] = "blockhead " + lines[0] + " you dimwitted blockhead"
        rows.append([i, "\n".join(lines)])
    for i in range(1, 40):
        if i % 5:
            rows[100 + i][1] += "\n" + rows[1][1]  # a run that repeats
            toxic[100 + i] = toxic[100 + i]
    near = rows[2][1].split(" ")
    rows += [[200, rows[3][1]], [201, " ".join(["other", *near[1:]])], [202, None], [203, ""], [None, sentence(rng, 12)]]
    items = [[1, " ".join(rows[7][1].split()[2:16])], [2, rows[12][1]], [3, sentence(rng, 20)]]
    return rows, toxic, items


def test_pipeline(spark, tmp_path):
    rows, toxic, items = documents()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, x) for i, x in toxic.items()], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [(i, t) for i, t in rows if "blockhead" not in (t or "")]
    cut = brute_lines(left, line_dedup.MIN_CHARS)
    after = []
    for i, t in left:
        kept = t if t is None else "\n".join(cut[(i is not None, i, t)])
        if t is None or kept.strip() or not t.strip():
            after.append((i, kept))
    comps = {id(r): c for r, c in zip(after, brute_components(after))}
    single = [r for r in after if comps[id(r)][2] == r[0]]
    clean = {i for i, *_, bad in brute_hits(single, items) if not bad}
    single = [(i, t) for i, t in single if i in clean]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = sorted(([i, [*tok.encode(t or "", add_special_tokens=False).ids, 1]] for i, t in single), key=repr)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    pieces = {}
    for r in sorted(out, key=lambda r: (repr(r.doc_id), r.start)):
        pieces.setdefault(r.doc_id, []).extend(r.ids)
    assert sorted(([k, v] for k, v in pieces.items()), key=repr) == expected
    total = {}
    for r in out:
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
    assert max(total.values()) <= 2048 and np.all([r.length == len(r.ids) for r in out])
    assert 200 not in pieces and 201 not in pieces and 7 not in pieces and 202 in pieces and 203 in pieces and None in pieces
