"""Column expressions for derived business values (all JVM-side, no UDFs)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight per demand category; a category's share of sales is
# its weight over the sum of all weights (15).
DEMAND_WEIGHTS = {"Very High": 5, "High": 4, "Medium": 3, "Low": 2, "Very Low": 1}
# Closure probability in percent = base + per-month step times
# calendar months since the order, capped at the maximum.
CLOSURE_BASE_PCT, CLOSURE_STEP_PCT, CLOSURE_MAX_PCT = 10, 30, 100


def as_of_date(as_of: dt.date | str | Column | None) -> Column:
    """The planning date: a fixed date when given, else today's date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


def max_delivery_date(order_date: Column, days: int = 90) -> Column:
    """Latest contractual delivery day: the order's day plus ``days``."""
    return F.date_add(F.to_date(order_date), days)


def demand_share(category: Column) -> Column:
    """Weight of the category divided by the weight total, as float; null for
    an unknown category."""
    total = sum(DEMAND_WEIGHTS.values())
    items = list(DEMAND_WEIGHTS.items())
    expr = F.when(category == items[0][0], F.lit(items[0][1]))
    for name, weight in items[1:]:
        expr = expr.when(category == name, F.lit(weight))
    return (expr / F.lit(total)).cast("float")


def calendar_months_between(start: Column, end: Column) -> Column:
    """Whole calendar months from start to end, ignoring the day of month."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def closure_probability(order_date: Column, as_of: dt.date | str | Column | None = None) -> Column:
    """Percent chance an order is closed: 10 + 30 per calendar month of age,
    at most 100."""
    months = calendar_months_between(order_date, as_of_date(as_of))
    return F.least(F.lit(CLOSURE_BASE_PCT) + F.lit(CLOSURE_STEP_PCT) * months, F.lit(CLOSURE_MAX_PCT))


def safety_stock(inventory: Column, reserve: int = 50) -> Column:
    """Stock above the reserve, never below 0; null stays null."""
    rest = inventory - F.lit(reserve)
    return F.when(rest < 0, F.lit(0)).otherwise(rest)


def product_category(part_id: Column) -> Column:
    """The last character of the process part id (the part's number)."""
    return F.substring(part_id, -1, 1)
