"""Scalar column functions of the invoice model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rules' constants.
NEAR_DAYS = 2
DUPLICATE_DAYS = 7
MAX_YEARLY_CHANGE = 0.1
RATIO_EPSILON = 1e-9
SPACING_DAYS = 30


def add_days(day: Column, days: Column | int) -> Column:
    return F.date_add(day, days)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from `start` to `end`, signed."""
    return F.datediff(end, start)


def strict_date(text: Column) -> Column:
    """A date from `YYYY-MM-DD` only; anything else, or a day that does not exist, raises."""
    bad = F.raise_error(F.concat(F.lit("not a date: "), F.coalesce(text, F.lit("null"))))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.cast("date")).otherwise(bad.cast("date"))


def number_order(number: Column) -> list[Column]:
    """Invoice order: shorter numbers first, then as text."""
    return [F.length(number), number]


def line_commission(amount: Column) -> Column:
    """5 % of an amount in cents, rounded half up."""
    return F.floor((amount * 5 + 50) / F.lit(100)).cast("long")


def installment_part(total: Column, count: Column, ordinal: Column) -> Column:
    """Part `ordinal` (from 1) of `total` in `count` parts that differ by a cent at most, the larger ones first."""
    base = F.floor(total / count).cast("long")
    return base + F.when(ordinal <= total - base * count, 1).otherwise(0)


def rounded(x: Column, digits: int) -> Column:
    """Half up on the binary value, as floor(x * 10**d + 0.5) / 10**d."""
    return F.floor(x * float(10**digits) + 0.5) / float(10**digits)


def ratio(num: Column, den: Column, digits: int = 4) -> Column:
    """Rounded quotient; null for a zero denominator."""
    return F.when(den != 0, rounded(num.cast("double") / den.cast("double"), digits))


def split_of(day: Column, test_from: str, demo_from: str) -> Column:
    return F.when(day < F.lit(test_from).cast("date"), "tune").when(day < F.lit(demo_from).cast("date"), "test").otherwise("demo")


def signature(product: Column, quantity: Column) -> Column:
    """An aggregate: products and quantities of all lines, sorted, as text."""
    return F.array_join(F.sort_array(F.collect_list(F.concat_ws(" x ", product, quantity.cast("string")))), ", ")


def signed_percent(x: Column) -> Column:
    return F.format_string("%+.1f%%", x * 100)
