"""Calendar attributes of a DATE column (fiscal year configurable)."""
from pyspark.sql import Column, functions as F

from ._col import col

# Fixed value: the fiscal year starts in July and is named after the
# calendar year in which it ends.
FISCAL_START_MONTH = 7


def fiscal_year(d: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    if start_month == 1:
        return F.year(d)
    return F.when(F.month(d) >= start_month, F.year(d) + 1).otherwise(F.year(d))


def fiscal_quarter(d: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    q = F.floor(((F.month(d) - start_month + 12) % 12) / 3).cast("int") + 1
    return F.concat(F.lit("FQ"), q.cast("string"))


def calendar_columns(date_col: "Column | str", fiscal_start_month: int = FISCAL_START_MONTH) -> dict:
    """Ordered mapping name → expression; ``full_date`` is the input date."""
    d = col(date_col)
    weekend = F.dayofweek(d).isin(1, 7)
    return {
        "date_key": F.date_format(d, "yyyyMMdd").cast("int"),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "month_abbrev": F.date_format(d, "MMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "day_abbrev": F.date_format(d, "EEE"),
        "is_weekend": weekend,
        "is_weekday": ~weekend,
        "year_month": F.date_format(d, "yyyy-MM"),
        "year_quarter": F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")),
        "fiscal_year": fiscal_year(d, fiscal_start_month),
        "fiscal_quarter": fiscal_quarter(d, fiscal_start_month),
    }
