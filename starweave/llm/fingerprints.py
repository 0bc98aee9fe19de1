"""Document fingerprints (1): winnowing of rolling word k-gram hashes.

The words of a text (parted by white space, lower case) are hashed; a k-gram's
hash rolls over ``GRAM`` of them, modulo the prime 2**31 - 1. In every window of
``WINDOW`` consecutive k-grams the smallest hash is chosen, the rightmost of
equals, and kept with its place. So any run of ``GRAM + WINDOW - 1`` words that
two texts share has a common hash in both fingerprints, at places that differ by
the runs' offset.

Hash and place are packed in one whole number. Only DataFrame functions run here, on whole texts.

Defined results: NULL is an empty text, and its fingerprint is empty; a text of
fewer words than a k-gram has one hash, of all its words; one of fewer k-grams
than a window has one window; equal texts have equal fingerprints; two empty
fingerprints have likeness 1, an empty and another 0; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._cluster import checkpointed

#: Words of a k-gram, and k-grams of a window: shared runs of six words are found.
GRAM, WINDOW = 3, 4
_PRIME = (1 << 31) - 1
_BASE = 1_000_003
#: Bits of a packed number for the place; 31 are the hash's.
_PLACE_BITS = 31
#: Rows that are ordered in one window, about, and the number of windows at most.
RANGE_ROWS, RANGES = 1024, 1 << 16
#: The place of NULL ids in the order.
_LAST = (1 << 63) - 1


def _upto(n: Column) -> Column:
    """0, 1, ..., n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def with_fingerprint(rows: DataFrame, text: str, out: str, k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``rows`` with the packed fingerprint of the column ``text``: for each chosen k-gram, in the order of
    places, its hash above and its inverted place below, so smallest and rightmost are one order.

    Each step is a column of its own, which Spark computes once.
    """
    w, h, g, p = (f"{out}_{x}" for x in "whgp")
    top = F.lit((1 << _PLACE_BITS) - 1)
    rows = rows.withColumn(w, F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t-\r]+"), lambda x: x != ""))
    rows = rows.withColumn(h, F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(_PRIME))))

    def rolled(i: Column) -> Column:
        total = F.get(h, i)
        for j in range(1, k):
            total = F.pmod(total * _BASE + F.get(h, i + j), F.lit(_PRIME))
        return total

    whole = F.aggregate(h, F.size(h).cast("long"), lambda a, x: F.pmod(a * _BASE + x, F.lit(_PRIME)))
    rows = rows.withColumn(g, F.when(F.size(h) >= k, F.transform(_upto(F.size(h) - (k - 1)), rolled))
                           .when(F.size(h) > 0, F.array(whole)).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn(p, F.transform(g, lambda x, i: F.shiftleft(x, _PLACE_BITS) + (top - i)))
    least = F.transform(_upto(F.size(p) - (window - 1)), lambda i: F.least(*[F.get(p, i + j) for j in range(window)]))
    chosen = F.when(F.size(p) >= window, F.array_distinct(least)).when(F.size(p) > 0, F.array(F.array_min(p))).otherwise(F.col(p))
    return rows.withColumn(out, chosen).drop(w, h, g, p)


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, _PLACE_BITS)


def _place(packed: Column) -> Column:
    return F.lit((1 << _PLACE_BITS) - 1) - packed.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))


def unpacked(packed: Column) -> Column:
    """The fingerprint as an array of ``(hash, place)``, in the order of places."""
    return F.transform(packed, lambda x: F.struct(_hash(x).alias("hash"), _place(x).cast("int").alias("place")))


def as_string(packed: Column) -> Column:
    """All packed numbers (hash times 2**31, plus 2**31 - 1 less the place), in the order of places."""
    return F.array_join(packed.cast("array<string>"), " ")


def hashes_of(packed: Column) -> Column:
    """The distinct hashes, without places."""
    return F.array_distinct(F.transform(packed, _hash))


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard coefficient of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both).cast("double"))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are below the key: a binary search."""
    if not bounds:
        return F.lit(0)
    held = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")  # folded to one constant
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        (low + step <= len(bounds)) & (F.coalesce(F.get(held, low + step - 1), F.lit(_LAST)) < key), low + step).otherwise(low))


def followed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, packed, next_text, next_packed``: each row with the next one, descending by ``doc_id``.

    After the last row comes the first. NULL ids come last; rows of one id are
    ordered by their text's hash. The order is cut at quantiles of the id into
    ranges of about ``RANGE_ROWS`` rows, ``RANGES`` at most; the first row of
    each range is also put behind the range before. So each range is ordered by
    itself, and texts are shuffled once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "o", F.coalesce(-F.greatest("doc_id", F.lit(-_LAST)), F.lit(_LAST))).withColumn("t", F.xxhash64("text"))
    keys = checkpointed(rows.select("o", "t"))
    ranges = min(RANGES, keys.count() // RANGE_ROWS)
    bounds = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        bounds = sorted(set(keys.select(F.percentile_approx("o", shares, 20 * ranges)).first()[0]))
    in_range = _range_of(F.col("o"), bounds)
    heads = (keys.withColumn("range", in_range).groupBy("range").agg(F.min(F.struct("o", "t")).alias("head"))
             .withColumn("one", F.lit(1)))  # RANGES rows at most
    order = Window.partitionBy("one").orderBy("range")
    last = F.max("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select(F.col("head.o").alias("o"), F.col("head.t").alias("t"), F.coalesce(F.lag("range").over(order), last).alias("before"))
    marked = rows.withColumn("range", in_range).join(F.broadcast(heads), ["o", "t"], "left")
    copied = (marked.withColumn("to", F.explode(F.when(F.col("before").isNull(), F.array(F.struct(F.col("range"), F.lit(0).alias("extra"))))
                                                .otherwise(F.array(F.struct(F.col("range"), F.lit(0).alias("extra")),
                                                                   F.struct(F.col("before").alias("range"), F.lit(1).alias("extra"))))))
              .select("to.range", "to.extra", "o", "t", "doc_id", "text"))
    packed = with_fingerprint(copied.repartition("range"), "text", "packed")
    step = Window.partitionBy("range").orderBy("extra", "o", "t")
    return (packed.withColumn("next_text", F.lead("text").over(step)).withColumn("next_packed", F.lead("packed").over(step))
            .filter("extra = 0").select("doc_id", "text", "packed", "next_text", "next_packed"))


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    near = followed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = F.length("text")
    moved = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - moved), F.substring("next_text", F.lit(1), moved))
    both = with_fingerprint(near.withColumn("edited", edited), "edited", "edited_packed").withColumn("own", hashes_of(F.col("packed")))
    own = F.col("own")
    return both.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       as_string(F.col("packed")).alias("fingerprint"), as_string(F.col("edited_packed")).alias("edited_fingerprint"),
                       likeness(own, hashes_of(F.col("edited_packed"))).alias("near_edited"),
                       likeness(own, hashes_of(F.col("next_packed"))).alias("near_next"))
