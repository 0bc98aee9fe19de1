"""Safe casts for ANSI mode.

Spark 4 runs with ANSI on: a plain cast of 'abc' to INT, an overflowing
decimal or an impossible date raises and kills the job. Raw extracts are
untrusted, so every parse here returns NULL on failure and the caller
quarantines the row with ``parsed_ok``.
"""
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

from ._col import col

# Money and percentages are carried as DECIMAL(18,2).
MONEY = DecimalType(18, 2)
PCT = DecimalType(18, 2)
DATE_FORMAT = "yyyy-MM-dd"


def parse_int(c: "Column | str") -> Column:
    return col(c).try_cast("int")


def parse_decimal(c: "Column | str", precision: int, scale: int) -> Column:
    return col(c).try_cast(DecimalType(precision, scale))


def parse_bool(c: "Column | str") -> Column:
    """true/t/yes/y/1 and false/f/no/n/0, any case; anything else is NULL."""
    return col(c).try_cast("boolean")


def parse_date(c: "Column | str", fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(col(c), fmt)


def parsed_ok(raw: "Column | str", parsed: "Column | str") -> Column:
    """True unless a non-NULL raw value failed to parse."""
    return col(raw).isNull() | col(parsed).isNotNull()
