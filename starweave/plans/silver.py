"""Bronze → Silver: standardise, type, de-duplicate, quarantine.

Order of work per table (each step is a lazy DataFrame transform):

1. one projection cleans strings and parses types with NULL-on-failure
   casts (ANSI-safe), keeping the raw text of every parsed field;
2. ``keep_latest`` picks the newest row per normalised key (normalising
   first means ' c001' and 'C001' are one customer); rows without a key
   bypass it, so they neither collapse into one row nor pile up in one
   task;
3. row rules (including the missing key) run on the winner only, so an
   older valid row never resurrects a key whose latest version is
   invalid; the failed rule names land in ``reject_reasons``;
4. valid rows get the contract column order and row audit columns.

All steps are narrow except the dedup shuffle, whose partial
``WindowGroupLimit`` runs before the exchange. Valid and rejected rows
are two filters of one tagged frame, so staging that frame once
(``plans.star``) evaluates the shuffle once.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions import casts, metrics
from ..functions.text import clean, join_names, key_clean, lower_clean, phone_clean, title_clean, upper_clean
from ..operators.dedup import keep_latest
from ..operators.quarantine import REASONS, Split, tag_rules
from ..sources.csv import CORRUPT_COLUMN
from ..sources.ingest import _ts

AUDIT = ["source_system", "batch_id", "ingested_at"]

# Names and order of the Silver tables' columns.
CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "full_name", "email", "phone", "city", "state",
    "country", "zip_code", "customer_segment", "registration_date",
    "source_system", "batch_id", "ingested_at", "created_at", "updated_at"]
PRODUCT_COLUMNS = [
    "product_id", "product_name", "category", "sub_category", "brand", "sku", "supplier_id",
    "unit_cost", "unit_price", "gross_margin_pct", "weight_kg", "is_active", "created_date",
    "source_system", "batch_id", "ingested_at", "created_at", "updated_at"]
ORDER_COLUMNS = [
    "order_id", "order_line_id", "customer_id", "product_id", "order_date", "ship_date",
    "quantity", "unit_price", "discount_pct", "discount_amount", "gross_revenue", "net_revenue",
    "days_to_ship", "payment_method", "order_channel", "order_status",
    "source_system", "batch_id", "ingested_at", "created_at", "updated_at"]

# What ``with_order_measures`` derives from the other columns.
ORDER_MEASURES = ["discount_amount", "gross_revenue", "net_revenue", "days_to_ship"]

# Tie-break order for rows of one key landed at the same time.
CUSTOMER_TIEBREAK = ["first_name", "last_name", "email", "phone", "city", "state", "country",
                     "zip_code", "customer_segment", "registration_date", "source_system", "batch_id"]
PRODUCT_TIEBREAK = ["product_name", "category", "sub_category", "brand", "sku", "supplier_id",
                    "unit_cost", "unit_price", "weight_kg", "is_active", "created_date",
                    "source_system", "batch_id"]
ORDER_TIEBREAK = ["order_id", "customer_id", "product_id", "order_date", "ship_date", "quantity",
                  "unit_price", "discount_pct", "payment_method", "order_channel", "order_status",
                  "source_system", "batch_id"]


# How the raw texts of a row are spelled (see ``pack_raw``).
SPELLING = "__spelling"


def _own_text(raw: str, columns) -> Column:
    """The text of the value that was parsed from a ``_raw_`` column."""
    value = raw.removeprefix("_raw_")
    return F.col(value).cast("string") if value in columns else F.lit(None).cast("string")


def pack_raw(rows: DataFrame) -> DataFrame:
    """``rows`` with the ``_raw_`` columns as one struct, NULL where each is the text of the value parsed from it.

    Most raw texts are, so they are neither sorted, shuffled nor staged beside their values; ``unpack_raw`` gives
    them back. A text is '=' where it is its value's own, else marked whether it sorts before ('<') or after ('>')
    that, NULL if it is NULL: among rows of equal values these marks sort as the texts do.
    """
    raws = [f.name for f in rows.schema if f.name.startswith("_raw_") and f.dataType == StringType()]
    same, marks = F.lit(True), []
    for c in raws:
        own = _own_text(c, rows.columns)
        same = same & F.col(c).eqNullSafe(own)
        marks.append(F.when(F.col(c).eqNullSafe(own), F.lit("=")).when(F.col(c) < own, F.concat(F.lit("<"), c))
                     .otherwise(F.concat(F.lit(">"), c)).alias(c))
    return rows.select(*[c for c in rows.columns if c not in raws], F.when(~same, F.struct(*marks)).alias(SPELLING))


def unpack_raw(rows: DataFrame) -> DataFrame:
    """The rows that ``pack_raw`` got, the ``_raw_`` columns last; the packed ones stay."""
    raws = {}
    for c in rows.schema[SPELLING].dataType.names:
        own, mark = _own_text(c, rows.columns), F.col(SPELLING)[c]
        raws[c] = F.when(F.col(SPELLING).isNull() | (mark == "="), own).otherwise(F.substring(mark, 2, 2 ** 31 - 1))
    return rows.withColumns(raws)


def _spelling_order(rows: DataFrame) -> list[Column]:
    """Sorts packed raw texts: a row of own texts stands between those whose first other text is smaller and greater."""
    side = [F.when(~F.col(SPELLING)[c].eqNullSafe(F.lit("=")), F.when(F.col(SPELLING)[c].startswith(">"), 1).otherwise(-1))
            for c in rows.schema[SPELLING].dataType.names]
    return [F.when(F.col(SPELLING).isNull(), 0).otherwise(F.coalesce(*side)), F.col(SPELLING)]


def _corrupt(bronze: DataFrame):
    if CORRUPT_COLUMN in bronze.columns:
        return [F.col(CORRUPT_COLUMN).alias("_raw_line")]
    return [F.lit(None).cast("string").alias("_raw_line")]


def tag(bronze: DataFrame, standardise, key: str, tiebreak: list, rules: dict, derive=None, packed: bool = False) -> DataFrame:
    """Latest row per key, with ``reject_reasons`` (empty = valid); one shuffle.

    ``derive`` adds what follows from a row's own values to the winners, so it is neither sorted nor shuffled, and
    nor are raw texts that say no more than their values (``pack_raw``). ``packed`` leaves out both, for staging:
    ``unpacked`` gives the whole rows.

    Rows without a key (NULL, or blank: both clean to NULL) never enter the
    de-duplication: they are standardised alike and rejected by the
    ``missing_<key>`` rule. So they can neither collapse into one row nor pile
    up in one task, and the result does not depend on row order, which keeps a
    recomputed task exact after executor loss.
    """
    clean_rows = pack_raw(standardise(bronze))
    keyed = clean_rows.filter(F.col(key).isNotNull())
    unkeyed = clean_rows.filter(F.col(key).isNull())
    latest = keep_latest(keyed, key, "ingested_at", tiebreak + _spelling_order(keyed))
    all_rules = {f"missing_{key}": F.col(key).isNotNull(), **rules,
                 "malformed_line": F.col("_raw_line").isNull()}
    rows = unpack_raw(latest.unionByName(unkeyed))
    tagged = tag_rules(derive(rows) if derive else rows, all_rules)
    return tagged.select(*clean_rows.columns, REASONS) if packed else tagged.drop(SPELLING)


def unpacked(rows: DataFrame, derive=None) -> DataFrame:
    """What ``tag`` gives without ``packed``, from its packed rows."""
    whole = unpack_raw(rows)
    whole = derive(whole) if derive else whole
    return whole.select(*[c for c in whole.columns if c not in (SPELLING, REASONS)], REASONS)


def split_tagged(tagged: DataFrame, columns: list, now=None) -> Split:
    ok = F.size(F.col(REASONS)) == 0
    ts = _ts(now)
    valid = tagged.filter(ok).withColumns({"created_at": ts, "updated_at": ts}).select(*columns)
    return Split(valid, tagged.filter(~ok))


def standardise_customers(bronze: DataFrame) -> DataFrame:
    first, last = title_clean("first_name"), title_clean("last_name")
    return bronze.select(
        key_clean("customer_id").alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        join_names(first, last).alias("full_name"),
        lower_clean("email").alias("email"),
        phone_clean("phone").alias("phone"),
        title_clean("city").alias("city"),
        upper_clean("state").alias("state"),
        upper_clean("country").alias("country"),
        clean("zip_code").alias("zip_code"),
        upper_clean("customer_segment").alias("customer_segment"),
        casts.parse_date("registration_date").alias("registration_date"),
        *AUDIT,
        F.col("registration_date").alias("_raw_registration_date"),
        *_corrupt(bronze))


def tag_customers(bronze: DataFrame, packed: bool = False) -> DataFrame:
    return tag(bronze, standardise_customers, "customer_id", CUSTOMER_TIEBREAK, customer_rules(), packed=packed)


def customers(bronze: DataFrame, now=None) -> Split:
    return split_tagged(tag_customers(bronze), CUSTOMER_COLUMNS, now)


def standardise_products(bronze: DataFrame) -> DataFrame:
    cost = casts.parse_decimal("unit_cost", 10, 2)
    price = casts.parse_decimal("unit_price", 10, 2)
    return bronze.select(
        key_clean("product_id").alias("product_id"),
        title_clean("product_name").alias("product_name"),
        title_clean("category").alias("category"),
        title_clean("sub_category").alias("sub_category"),
        clean("brand").alias("brand"),
        upper_clean("sku").alias("sku"),
        upper_clean("supplier_id").alias("supplier_id"),
        cost.alias("unit_cost"),
        price.alias("unit_price"),
        metrics.gross_margin_pct(price, cost).alias("gross_margin_pct"),
        casts.parse_decimal("weight_kg", 8, 3).alias("weight_kg"),
        casts.parse_bool("is_active").alias("is_active"),
        casts.parse_date("created_date").alias("created_date"),
        *AUDIT,
        F.col("unit_cost").alias("_raw_unit_cost"),
        F.col("unit_price").alias("_raw_unit_price"),
        F.col("weight_kg").alias("_raw_weight_kg"),
        F.col("is_active").alias("_raw_is_active"),
        F.col("created_date").alias("_raw_created_date"),
        *_corrupt(bronze))


def customer_rules() -> dict:
    return {
        "missing_email": F.col("email").isNotNull(),
        "bad_registration_date": casts.parsed_ok("_raw_registration_date", "registration_date"),
    }


def product_rules() -> dict:
    return {
        "missing_product_name": F.col("product_name").isNotNull(),
        "bad_unit_cost": casts.parsed_ok("_raw_unit_cost", "unit_cost"),
        "bad_unit_price": casts.parsed_ok("_raw_unit_price", "unit_price"),
        "bad_weight_kg": casts.parsed_ok("_raw_weight_kg", "weight_kg"),
        "bad_is_active": casts.parsed_ok("_raw_is_active", "is_active"),
        "bad_created_date": casts.parsed_ok("_raw_created_date", "created_date"),
        "non_positive_cost": F.col("unit_cost") > 0,
        "non_positive_price": F.col("unit_price") > 0,
        "price_below_cost": F.col("unit_price") >= F.col("unit_cost"),
    }


def tag_products(bronze: DataFrame, packed: bool = False) -> DataFrame:
    return tag(bronze, standardise_products, "product_id", PRODUCT_TIEBREAK, product_rules(), packed=packed)


def products(bronze: DataFrame, now=None) -> Split:
    return split_tagged(tag_products(bronze), PRODUCT_COLUMNS, now)


def parse_orders(bronze: DataFrame) -> DataFrame:
    """Cleaned and typed order lines, without the measures that ``with_order_measures`` adds."""
    return bronze.select(
        upper_clean("order_id").alias("order_id"),
        key_clean("order_line_id").alias("order_line_id"),
        upper_clean("customer_id").alias("customer_id"),
        upper_clean("product_id").alias("product_id"),
        casts.parse_date("order_date").alias("order_date"),
        casts.parse_date("ship_date").alias("ship_date"),
        casts.parse_int("quantity").alias("quantity"),
        casts.parse_decimal("unit_price", 10, 2).alias("unit_price"),
        casts.parse_decimal("discount_pct", 5, 4).alias("discount_pct"),
        title_clean("payment_method").alias("payment_method"),
        title_clean("order_channel").alias("order_channel"),
        title_clean("order_status").alias("order_status"),
        *AUDIT,
        F.col("quantity").alias("_raw_quantity"),
        F.col("unit_price").alias("_raw_unit_price"),
        F.col("discount_pct").alias("_raw_discount_pct"),
        F.col("order_date").alias("_raw_order_date"),
        F.col("ship_date").alias("_raw_ship_date"),
        *_corrupt(bronze))


def order_amounts() -> dict:
    """The amounts of an order line."""
    disc = metrics.discount_amount(F.col("unit_price"), F.col("quantity"), F.col("discount_pct"))
    gross = metrics.gross_revenue(F.col("unit_price"), F.col("quantity"))
    return {"discount_amount": disc, "gross_revenue": gross, "net_revenue": metrics.net_revenue(gross, disc)}


def with_order_measures(rows: DataFrame) -> DataFrame:
    """The amounts and the days of parsed order lines, which follow from their other columns."""
    at = rows.columns.index("discount_pct") + 1
    return rows.select(
        *rows.columns[:at],
        *[e.alias(c) for c, e in order_amounts().items()],
        metrics.days_to_ship(F.col("order_date"), F.col("ship_date")).alias("days_to_ship"),
        *rows.columns[at:])


def standardise_orders(bronze: DataFrame) -> DataFrame:
    return with_order_measures(parse_orders(bronze))


def order_rules() -> dict:
    return {
        "missing_order_id": F.col("order_id").isNotNull(),
        "missing_customer_id": F.col("customer_id").isNotNull(),
        "missing_product_id": F.col("product_id").isNotNull(),
        "bad_quantity": casts.parsed_ok("_raw_quantity", "quantity"),
        "bad_unit_price": casts.parsed_ok("_raw_unit_price", "unit_price"),
        "bad_discount_pct": casts.parsed_ok("_raw_discount_pct", "discount_pct"),
        "bad_order_date": casts.parsed_ok("_raw_order_date", "order_date"),
        "bad_ship_date": casts.parsed_ok("_raw_ship_date", "ship_date"),
        "non_positive_quantity": F.col("quantity") > 0,
        "non_positive_price": F.col("unit_price") > 0,
        "revenue_overflow": F.col("gross_revenue").isNotNull(),
    }


def tag_orders(bronze: DataFrame, packed: bool = False) -> DataFrame:
    return tag(bronze, parse_orders, "order_line_id", ORDER_TIEBREAK, order_rules(), with_order_measures, packed=packed)


def orders(bronze: DataFrame, now=None) -> Split:
    return split_tagged(tag_orders(bronze), ORDER_COLUMNS, now)
