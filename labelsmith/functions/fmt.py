"""Number formatting for report rows, done with integer arithmetic so it is exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col


def safe_ratio(num, den) -> Column:
    """num / den as DOUBLE, 0 when den is 0."""
    n, d = as_col(num), as_col(den)
    return F.when(d == 0, F.lit(0.0)).otherwise(n.cast("double") / d.cast("double"))


def format_count(c) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(as_col(c).cast("long"), 0)


def percent_hundredths(num: str, den: str) -> Column:
    """Percent in hundredths, rounded half up: (20000*n + d) div (2*d); 0 when d is 0.

    ``num`` and ``den`` are SQL expressions (column names); integer division keeps it exact.
    """
    return F.expr(f"CASE WHEN ({den}) = 0 THEN 0L "
                  f"ELSE (CAST(({num}) AS BIGINT) * 20000 + ({den})) div (CAST(({den}) AS BIGINT) * 2) END")


def format_percent(num: str, den: str) -> Column:
    """'12.34%' with two decimals (``num``/``den`` are SQL expressions)."""
    h = percent_hundredths(num, den)
    frac = F.lpad((h % 100).cast("string"), 2, "0")
    return F.concat(F.floor(h / 100).cast("long").cast("string"), F.lit("."), frac, F.lit("%"))
