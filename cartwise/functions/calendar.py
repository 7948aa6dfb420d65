"""Date windows used by the jobs, all relative to an explicit ``as_of`` date.

The reference reads the wall clock; here "today" is a parameter so results are
reproducible. All predicates are plain comparisons on a DATE column, so they
reach the parquet scan as pushed filters once the column is a raw date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the as-of date the registered queries use.
DEFAULT_AS_OF = dt.date(2001, 7, 15)


def first_of_month(as_of: dt.date | str) -> dt.date:
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    return d.replace(day=1)


def add_months(d: dt.date, n: int) -> dt.date:
    """Calendar month shift, clamping the day like SQL ``add_months``."""
    y, m = divmod(d.month - 1 + n, 12)
    year, month = d.year + y, m + 1
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    last = (nxt - dt.timedelta(days=1)).day
    return dt.date(year, month, min(d.day, last))


def last_months(date_col: Column, as_of: dt.date | str, months: int) -> Column:
    """Half-open [as_of - months, as_of) (the six-month ranking windows)."""
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    return (date_col >= F.lit(add_months(d, -months))) & (date_col < F.lit(d))


def whole_months_before(date_col: Column, as_of: dt.date | str, months: int) -> Column:
    """Half-open [first of month - months, first of month): the forecast history."""
    first = first_of_month(as_of)
    return (date_col >= F.lit(add_months(first, -months))) & (date_col < F.lit(first))


def since_months(date_col: Column, as_of: dt.date | str, months: int) -> Column:
    """date > as_of - months, open above (the overview windows)."""
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    return date_col > F.lit(add_months(d, -months))


def horizon_months(as_of: dt.date | str, n: int = 12) -> Column:
    """Array of the next ``n`` first-of-month dates, starting with as_of's month."""
    first = first_of_month(as_of)
    return F.sequence(F.lit(first), F.lit(add_months(first, n - 1)), F.expr("INTERVAL 1 MONTH"))


def month_prefilter(lines: DataFrame, lo: dt.date | None, hi: dt.date | None) -> DataFrame:
    """Keep order lines whose order month lies in [month of lo, month of hi].

    Only a lines copy that carries its order's month (the co-located layout,
    partitioned by that month) has the column; there the filter prunes whole
    partitions at the scan. It is a superset of any day-level window inside
    those months, so the exact filter on the order date still decides.
    Without the column the lines are returned unchanged.
    """
    if "order_month" not in lines.columns:
        return lines
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("order_month") >= F.lit(first_of_month(lo)))
    if hi is not None:
        cond = cond & (F.col("order_month") <= F.lit(first_of_month(hi)))
    return lines.filter(cond)
