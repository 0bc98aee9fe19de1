"""Fill-in-middle (13): documents cut in three and moved about by displacement scatter.

The text is cut in units: runs of ASCII letters, and single other code points.
Two cuts, drawn from the document's id, part prefix, middle and suffix. In a
batch, the byte at which a piece or a marker begins gets the change of the output
shift (a difference array); the cumulative sum is every byte's displacement, and
one scatter builds all outputs of the batch. ``restored`` finds the markers in the
output, builds the shifts back alike, and gathers the text.

The cuts and the form are drawn in the JVM from SHA-256, so they depend on nothing
but the id and the text. A batch holds about ``CHUNK_BYTES`` of text, or one longer
document, and nothing is shuffled.

Defined results: a NULL or empty text is plain and its output is empty; a text that
contains a marker is plain, so that an output has each marker once; a NULL ``doc_id``
counts as an empty text when cuts are drawn; rows that repeat are each transformed, those
of one id and text alike; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ._tokens import byte_class, chunks

#: The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Documents in a hundred that are transformed, and of those, the ones with the suffix first.
RATE, SPM_RATE = 90, 20
SEED = "1"

_LETTER = byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122)
_MARK = 3


def _draws(seed: str) -> list[Column]:
    """Four 32-bit numbers of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _unit_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The byte at which each unit of a run of texts begins."""
    letter = _LETTER[buf]
    begins = (buf & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[off[:-1][off[:-1] < off[1:]]] = True
    return np.flatnonzero(begins)


def _chars(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Code points of each stretch ``buf[a:b]``."""
    so_far = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=so_far[1:])
    return so_far[b] - so_far[a]


def _shifts(n: int, at: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The displacement of each of ``n`` bytes: ``shift[i]`` from byte ``at[i]`` on, ``at`` ascending.

    Where several pieces begin at one byte, all but the last are empty.
    """
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, np.diff(shift, prepend=0))
    return np.cumsum(change[:n])


def scatter(buf: np.ndarray, off: np.ndarray, cut1: np.ndarray, cut2: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All outputs of a run of texts, one after the other, and where each begins.

    ``cut1`` and ``cut2`` are the bytes at which middle and suffix begin; ``form`` is 0 (plain), 1 (psm) or 2 (spm).
    """
    lo, hi = off[:-1], off[1:]
    moved = form > 0
    ends = np.concatenate([[0], np.cumsum(hi - lo + 3 * _MARK * moved)])
    begin = ends[:-1]
    p, m, s = cut1 - lo, cut2 - cut1, hi - cut2
    psm, spm = form == 1, form == 2
    # Where each piece begins in the output.
    to_p = begin + np.select([psm, spm], [_MARK, 2 * _MARK + s], 0)
    to_s = begin + np.select([psm, spm], [2 * _MARK + p, _MARK], p + m)
    to_m = begin + np.select([psm, spm], [3 * _MARK + p + s, 3 * _MARK + s + p], p)
    at = np.stack([lo, cut1, cut2], axis=1).ravel()
    shift = np.stack([to_p - lo, to_m - cut1, to_s - cut2], axis=1).ravel()
    out = np.empty(int(ends[-1]), np.uint8)
    out[np.arange(len(buf)) + _shifts(len(buf), at, shift)] = buf
    for mark, to in ((PREFIX, to_p), (SUFFIX, to_s), (MIDDLE, to_m)):
        for j, b in enumerate(mark.encode()):
            out[to[moved] - _MARK + j] = b
    return out, ends


def gather(buf: np.ndarray, off: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that the outputs were made of, one after the other, and where each begins."""
    lo, hi = off[:-1], off[1:]
    moved = np.flatnonzero(form > 0)
    place = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        a, b, c = mark.encode()
        found = np.flatnonzero((buf[:-2] == a) & (buf[1:-1] == b) & (buf[2:] == c)) if len(buf) > 2 else np.zeros(0, np.int64)
        # A moved output has each marker once; those of plain ones are text.
        place[mark] = found[np.searchsorted(found, lo[moved])] if len(moved) else found[:0]
    size = hi - lo
    size[moved] -= 3 * _MARK
    ends = np.concatenate([[0], np.cumsum(size)])
    from_p, from_s, from_m = (place[m] + _MARK for m in (PREFIX, SUFFIX, MIDDLE))
    psm = form[moved] == 1
    p = np.where(psm, place[SUFFIX] - from_p, place[MIDDLE] - from_p)
    s = np.where(psm, place[MIDDLE] - from_s, place[PREFIX] - from_s)
    m = hi[moved] - from_m
    at, shift = ends[:-1].repeat(3).reshape(-1, 3), (lo - ends[:-1]).repeat(3).reshape(-1, 3)
    begin = ends[:-1][moved]
    at[moved] = np.stack([begin, begin + p, begin + p + m], axis=1)
    shift[moved] = np.stack([from_p, from_m, from_s], axis=1) - at[moved]
    n = int(ends[-1])
    return buf[np.arange(n) + _shifts(n, at.ravel(), shift.ravel())], ends


def _strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))


_FORMS = ["plain", "psm", "spm"]


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: str = SEED) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each row of ``docs(doc_id, text)``."""
    h1, h2, h3, h4 = _draws(seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | text.contains(mark)
    form = F.when((text == "") | marked | (h3 % 100 >= rate), 0).when(h4 % 100 < spm_rate, 2).otherwise(1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"), form.alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2")])
            forms = batch.column("form").to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in chunks(batch.column("text")):
                starts, form = np.append(_unit_starts(buf, off), len(buf)), forms[lo:hi]
                first = np.searchsorted(starts, off)
                n = np.diff(first)
                unit = np.sort(h[:, lo:hi] % (n + 1), axis=0) + first[:-1]
                cut1, cut2 = starts[unit]
                out, ends = scatter(buf, off, cut1, cut2, form)
                none = form == 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(np.array(_FORMS)[form].tolist(), pa.string()),
                     pa.array(_chars(buf, off[:-1], cut1), pa.int64(), mask=none), pa.array(_chars(buf, cut1, cut2), pa.int64(), mask=none), _strings(out, ends)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(made: DataFrame) -> DataFrame:
    """``made(form, output, ...)`` with a last column ``restored``: the text, from form and output alone."""
    names = made.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = np.array([_FORMS.index(f) for f in batch.column("form").to_pylist()], np.int64)
            for lo, hi, buf, off in chunks(batch.column("output")):
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in names] + [_strings(*gather(buf, off, forms[lo:hi]))], [*names, "restored"])

    return made.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema.fields) + ", restored string")


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    made = restored(fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


_UNITS = "[A-Za-z]+|[^A-Za-z]"

ORACLE_SQL = f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_UNITS}') AS u,
                    sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
draw AS (SELECT *, len(u) AS n, list_transform(range(4), lambda i: CAST('0x' || substr(x, CAST(8 * i + 1 AS INT), 8) AS BIGINT)) AS h FROM doc),
cut AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h[3] % 100 >= {RATE} THEN 'plain'
                    WHEN h[4] % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM draw),
piece AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM piece
"""
