"""Filters that reach the scan of a table that does not have the filtered column itself.

Order lines carry no date, so a date window says nothing to their scan. But a
store numbers its orders as they come in, so the window's orders have ids in one
range, and that range does reach the line scan: Parquet skips the row groups
(and, by page statistics, pages) whose ids lie outside. Ids are found by one aggregate
over the orders in the window, two columns of the smaller table. Where ids
don't follow time the range is wide, nothing is skipped, and the join decides as before:
the filter only drops lines that can't meet an order of the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines_in_key_range(lines: DataFrame, orders: DataFrame, line_key: str = "order_id", order_key: str = "id") -> DataFrame:
    """``lines`` with a key between the least and the greatest key of ``orders``.

    A literal range: a scalar subquery in its place would be evaluated only above the scan.
    """
    least, greatest = orders.agg(F.min(order_key), F.max(order_key)).first()
    if least is None:
        return lines.filter(F.lit(False))
    return lines.filter(F.col(line_key).between(least, greatest))
