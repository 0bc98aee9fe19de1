"""Hash-based surrogate keys.

The key is the first 15 hex digits (60 bits) of SHA-256 over the business
key's string form, read as a LONG. It is stable across runs and clusters,
needs no sequence or join to assign, and a NULL business key gives a NULL
key. Collision odds are about n^2 / 2^61 for n keys; ``operators.surrogate``
gives the members that collide another key.
"""
from pyspark.sql import Column, DataFrame, functions as F

from ._col import col

# Fixed value: 15 hex digits = 60 bits, so the key always fits a signed LONG.
SK_HEX_DIGITS = 15


def surrogate_key(business_key: "Column | str", digits: int = SK_HEX_DIGITS, attempt: int = 0) -> Column:
    """The key of a business key; a later ``attempt`` gives another one (see ``operators.surrogate``)."""
    text = col(business_key).cast("string")
    digest = F.sha2(F.concat(text, F.lit(f"#{attempt}")) if attempt else text, 256)
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def with_surrogate_key(df: DataFrame, business_key: str, sk_name: str = "surrogate_key") -> DataFrame:
    return df.withColumn(sk_name, surrogate_key(business_key))
