"""Exact decimal money arithmetic and rounding.

Revenue is held as DECIMAL: ``unit_price * quantity * (100 - discount_pct)
/ 100`` has at most four decimals, so every sum is exact and the result of
a query does not depend on the order in which partitions are combined.
Values are rounded in decimal (half away from zero like SQL ``ROUND``, or
half to even like pandas ``.round``) and only then cast to DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import MONEY

# Dividend precision for ratios: 18 decimals keep the quotient exact far
# beyond the 1-2 decimals that are finally kept.
_RATIO_DIVIDEND = T.DecimalType(38, 18)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_revenue(price: str | Column, qty: str | Column,
                 discount_pct: str | Column) -> Column:
    """price x qty x (1 - discount_pct / 100), exact, DECIMAL(28,4)."""
    return ((col_(price) * col_(qty) * (F.lit(100) - col_(discount_pct)))
            / F.lit(100)).cast(MONEY)


def gross_revenue(price: str | Column, qty: str | Column) -> Column:
    """List-price value of a line before discount, exact."""
    return (col_(price) * col_(qty)).cast(MONEY)


def rounded(value: str | Column, scale: int, half_even: bool = False) -> Column:
    """Round an exact decimal and return DOUBLE."""
    fn = F.bround if half_even else F.round
    return fn(col_(value), scale).cast("double")


def ratio(num: str | Column, den: str | Column, scale: int,
          half_even: bool = False) -> Column:
    """num / den rounded to ``scale`` places; NULL when den is 0 or NULL.

    Division happens in DECIMAL so the rounding decision is exact.
    """
    q = F.try_divide(col_(num).cast(_RATIO_DIVIDEND), col_(den))
    return rounded(q, scale, half_even)


def pct(num: str | Column, den: str | Column, scale: int,
        half_even: bool = False) -> Column:
    """100 * num / den rounded to ``scale`` places."""
    return ratio(col_(num) * F.lit(100), den, scale, half_even)


def to_double(value: str | Column) -> Column:
    return col_(value).cast("double")
