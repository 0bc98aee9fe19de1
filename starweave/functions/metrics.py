"""Derived sales measures, exact decimal arithmetic rounded HALF_UP.

Inputs are DECIMALs (prices 10,2; discount 5,4) and INT quantities, so the
products are exact; only ``round`` rounds. Results are narrowed to
DECIMAL(18,2) with ``try_cast`` so an overflow gives NULL instead of
failing the job under ANSI. Divisions use ``try_divide`` (zero → NULL).
"""
from pyspark.sql import Column, functions as F

from ._col import col
from .casts import MONEY, PCT


def _money(x: Column) -> Column:
    return F.round(x, 2).try_cast(MONEY)


def gross_margin_pct(unit_price: "Column | str", unit_cost: "Column | str") -> Column:
    price, cost = col(unit_price), col(unit_cost)
    return F.round(F.try_divide(price - cost, price) * 100, 2).try_cast(PCT)


def discount_amount(unit_price, quantity, discount_pct) -> Column:
    return _money(col(unit_price) * col(quantity) * col(discount_pct))


def gross_revenue(unit_price, quantity) -> Column:
    return _money(col(unit_price) * col(quantity))


def net_revenue(gross, discount) -> Column:
    return _money(col(gross) - col(discount))


def days_to_ship(order_date, ship_date) -> Column:
    return F.datediff(col(ship_date), col(order_date))


def cogs(quantity, unit_cost) -> Column:
    return _money(col(quantity) * col(unit_cost))


def gross_profit(net, cost_of_goods) -> Column:
    return _money(col(net) - col(cost_of_goods))


def gross_profit_pct(profit, net) -> Column:
    """profit / net * 100; zero or NULL net gives 0."""
    p, n = col(profit), col(net)
    pct = F.round(F.try_divide(p, n) * 100, 2).try_cast(PCT)
    return F.when(n != 0, pct).otherwise(F.lit(0).cast(PCT))


def exact_avg(total, count, scale: int = 2) -> Column:
    """Mean rounded HALF_UP to ``scale`` digits, from a decimal sum and a count.

    Built from sums and counts, so it can be merged from partial
    aggregates (per product, per day, ...) and still be exact: integer
    arithmetic on DECIMAL(38,0), no intermediate rounding. NULL when
    ``count`` is 0.
    """
    t, n = col(total), col(count).cast("decimal(38,0)")
    unit = 10 ** scale
    s = (t * unit).cast("decimal(38,0)")
    num = F.abs(s) * 2 + n
    den = n * 2
    q = ((num - F.pmod(num, den)) / den).cast("decimal(38,0)")
    signed = F.when(s < 0, -q).otherwise(q)
    return F.when(n > 0, (signed / unit).cast(f"decimal(38,{scale})"))
