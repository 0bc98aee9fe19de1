"""String standardisation (all JVM built-ins, stay inside whole-stage codegen)."""
from pyspark.sql import Column, functions as F

from ._col import col

# Fixed value: a phone number keeps digits, '+' and '-' only.
PHONE_DROP = r"[^\d\+\-]"


def clean(c: "Column | str") -> Column:
    """Trim surrounding spaces."""
    return F.trim(col(c))


def upper_clean(c: "Column | str") -> Column:
    return F.upper(F.trim(col(c)))


def key_clean(c: "Column | str") -> Column:
    """A business key: upper case without surrounding spaces; a blank one is NULL."""
    return F.nullif(upper_clean(c), F.lit(""))


def lower_clean(c: "Column | str") -> Column:
    return F.lower(F.trim(col(c)))


def title_clean(c: "Column | str") -> Column:
    """``initcap`` after trim: words split on spaces only, rest lower-cased."""
    return F.initcap(F.trim(col(c)))


def phone_clean(c: "Column | str") -> Column:
    return F.regexp_replace(col(c), PHONE_DROP, "")


def join_names(*parts: "Column | str", sep: str = " ") -> Column:
    """``concat_ws`` skipping NULL parts; an all-NULL result is NULL, not ''."""
    return F.nullif(F.concat_ws(sep, *[col(p) for p in parts]), F.lit(""))
