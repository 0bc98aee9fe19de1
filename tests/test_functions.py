"""Column functions: keys, text, casts, measures, calendar (no I/O)."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starweave.functions import calendar, casts, metrics
from starweave.functions.keys import surrogate_key
from starweave.functions.text import join_names, lower_clean, phone_clean, title_clean, upper_clean


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first().r


# --- surrogate keys -------------------------------------------------------

@pytest.mark.parametrize("bk,sk", [
    ("C001", 741130920687010838),
    ("P001", 1004834881906144444),
    ("USA_NY_New York", 298392063268950640),
])
def test_surrogate_key_golden(spark, bk, sk):
    assert one(spark, surrogate_key, bk) == sk


def test_surrogate_key_null_is_null(spark):
    assert one(spark, surrogate_key, None) is None


def test_surrogate_key_unique_and_stable(spark):
    df = spark.createDataFrame([("C001",), ("C002",), ("C003",)], "customer_id string")
    keys = df.select(surrogate_key("customer_id").alias("k"))
    assert keys.distinct().count() == 3
    again = spark.createDataFrame([("C001",)], "customer_id string").select(surrogate_key("customer_id"))
    assert again.first()[0] == keys.first()[0]
    assert dict(keys.dtypes)["k"] == "bigint"


# --- text -----------------------------------------------------------------

def test_email_lower(spark):
    assert one(spark, lower_clean, " Alice.TEST@Email.COM ") == "alice.test@email.com"


def test_id_upper(spark):
    assert one(spark, upper_clean, " c001") == "C001"


def test_initcap_splits_on_spaces_only(spark):
    assert one(spark, title_clean, "USB-C Hub 7-Port") == "Usb-c Hub 7-port"
    assert one(spark, title_clean, "PayPal") == "Paypal"


def test_phone_keeps_digits_plus_minus(spark):
    assert one(spark, phone_clean, "(555) 010-1 x+2") == "555010-1+2"


def test_full_name_null_when_no_parts(spark):
    df = spark.createDataFrame([(None, None), ("Ann", None)], "f string, l string")
    out = [r.n for r in df.select(join_names("f", "l").alias("n")).collect()]
    assert out == [None, "Ann"]


# --- casts (ANSI-safe) ----------------------------------------------------

@pytest.mark.parametrize("raw,expected", [("5", 5), ("abc", None), ("1.7", None), (None, None)])
def test_parse_int(spark, raw, expected):
    assert one(spark, casts.parse_int, raw) == expected


def test_parse_decimal_overflow_is_null(spark):
    assert one(spark, lambda c: casts.parse_decimal(c, 10, 2), "123456789.999") is None
    assert one(spark, lambda c: casts.parse_decimal(c, 10, 2), "12.5") == Decimal("12.50")


@pytest.mark.parametrize("raw,expected", [("yes", True), ("1", True), ("N", False), ("true", True),
                                          ("maybe", None)])
def test_parse_bool(spark, raw, expected):
    assert one(spark, casts.parse_bool, raw) is expected


@pytest.mark.parametrize("raw", ["2024/01/05", "2024-1-5", "2024-02-30", "abc"])
def test_parse_date_rejects(spark, raw):
    assert one(spark, casts.parse_date, raw) is None


def test_parse_date_accepts(spark):
    assert one(spark, casts.parse_date, "2024-02-29") == dt.date(2024, 2, 29)


def test_parsed_ok(spark):
    df = spark.createDataFrame([("abc", None), (None, None), ("5", 5)], "raw string, v int")
    assert [r.ok for r in df.select(casts.parsed_ok("raw", "v").alias("ok")).collect()] == [False, True, True]


# --- measures -------------------------------------------------------------

def test_net_revenue(spark):
    df = spark.createDataFrame([(2, Decimal("100.00"), Decimal("0.1000"))],
                               "quantity int, unit_price decimal(10,2), discount_pct decimal(5,4)")
    gross = metrics.gross_revenue("unit_price", "quantity")
    disc = metrics.discount_amount("unit_price", "quantity", "discount_pct")
    r = df.select(gross.alias("g"), disc.alias("d"), metrics.net_revenue(gross, disc).alias("n")).first()
    assert (r.g, r.d, r.n) == (Decimal("200.00"), Decimal("20.00"), Decimal("180.00"))


def test_gross_profit(spark):
    df = spark.createDataFrame([(3, Decimal("60.00"), Decimal("300.00"))],
                               "quantity int, unit_cost decimal(10,2), net decimal(18,2)")
    cogs = metrics.cogs("quantity", "unit_cost")
    profit = metrics.gross_profit("net", cogs)
    r = df.select(cogs.alias("c"), profit.alias("p"), metrics.gross_profit_pct(profit, "net").alias("pct")).first()
    assert (r.c, r.p, r.pct) == (Decimal("180.00"), Decimal("120.00"), Decimal("40.00"))


def test_profit_pct_zero_and_null_net(spark):
    df = spark.createDataFrame([(Decimal("5.00"), Decimal("0.00")), (Decimal("5.00"), None)],
                               "p decimal(18,2), n decimal(18,2)")
    assert [r.x for r in df.select(metrics.gross_profit_pct("p", "n").alias("x")).collect()] == \
        [Decimal("0.00"), Decimal("0.00")]


def test_margin_half_up_and_zero_price(spark):
    df = spark.createDataFrame([(Decimal("3.00"), Decimal("2.00")), (Decimal("0.00"), Decimal("1.00"))],
                               "price decimal(10,2), cost decimal(10,2)")
    out = [r.m for r in df.select(metrics.gross_margin_pct("price", "cost").alias("m")).collect()]
    assert out == [Decimal("33.33"), None]


def test_days_to_ship(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), dt.date(2024, 1, 8))], "o date, s date")
    assert df.select(metrics.days_to_ship("o", "s")).first()[0] == 3


@pytest.mark.parametrize("s,c,expected", [
    (Decimal("10.05"), 2, Decimal("5.03")),    # 5.025 → half up
    (Decimal("-10.05"), 2, Decimal("-5.03")),  # away from zero
    (Decimal("1.00"), 3, Decimal("0.33")),
    (Decimal("1.00"), 0, None),
])
def test_exact_avg(spark, s, c, expected):
    df = spark.createDataFrame([(s, c)], "s decimal(38,2), c bigint")
    assert df.select(metrics.exact_avg("s", "c")).first()[0] == expected


# --- calendar ---------------------------------------------------------------

@pytest.mark.parametrize("day,fy,fq,week", [
    (dt.date(2024, 2, 29), 2024, "FQ3", 9),
    (dt.date(2024, 6, 30), 2024, "FQ4", 26),
    (dt.date(2024, 7, 1), 2025, "FQ1", 27),
    (dt.date(2020, 12, 31), 2021, "FQ2", 53),
    (dt.date(2021, 1, 1), 2021, "FQ3", 53),
])
def test_fiscal_calendar(spark, day, fy, fq, week):
    cols = calendar.calendar_columns("d")
    r = spark.createDataFrame([(day,)], "d date").select(*[e.alias(n) for n, e in cols.items()]).first()
    assert (r.fiscal_year, r.fiscal_quarter, r.week_of_year) == (fy, fq, week)


def test_calendar_names(spark):
    cols = calendar.calendar_columns("d")
    r = spark.createDataFrame([(dt.date(2024, 9, 15),)], "d date").select(
        *[e.alias(n) for n, e in cols.items()]).first()
    assert r.date_key == 20240915 and r.day_name == "Sunday" and r.day_abbrev == "Sun"
    assert r.month_name == "September" and r.month_abbrev == "Sep" and r.day_of_week == 1
    assert r.is_weekend and not r.is_weekday and r.year_quarter == "2024-Q3" and r.quarter_name == "Q3"
