"""Assembling the reference's nested output documents from flat results.

Every list inside a document is built from an already aggregated frame whose
size is bounded by a dimension (months in a window, states, top-n), never by
raw rows. One-row documents stack their one-row parts and fold them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sorted_list(df: DataFrame, sort_fields: list[str], out_fields: list[str], name: str) -> DataFrame:
    """Collapse ``df`` into one row holding ``name``: array<struct(out_fields)>.

    The array is ordered by ``sort_fields`` (a stable order for the document).
    """
    packed = (df.groupBy(F.lit(1).alias("_k"))
              .agg(F.sort_array(F.collect_list(F.struct(*sort_fields, *[
                  c for c in out_fields if c not in sort_fields])))
                   .alias("_raw")))
    return packed.select("_k", F.transform("_raw", lambda r: F.struct(
        *[r[c].alias(c) for c in out_fields])).alias(name))


def one_row_document(*parts: DataFrame) -> DataFrame:
    """Merge one-row parts (each carrying ``_k`` and its own columns) into one row.

    The parts are stacked (union by name, missing columns null) and folded by
    one aggregation that keeps each column's non-null value: no join, so no
    nested-loop plan for a constant key.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cols = [c for p in parts for c in p.columns if c != "_k"]
    return stacked.groupBy("_k").agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols]).drop("_k")


def nest_by_month(flat: DataFrame, inner: list[str], name: str) -> DataFrame:
    """(month, year, name: array<struct(inner)>) -- one row per month, list sorted."""
    return (flat.groupBy("month", "year")
            .agg(F.sort_array(F.collect_list(F.struct(*inner))).alias(name)))


def unnested(document: DataFrame, *lists: str) -> DataFrame:
    """The rows of a list in a document, with the columns beside it; then of a list in those rows, and so on."""
    rows = document
    for name in lists:
        beside = [c for c in rows.columns if c != name]
        rows = rows.select(*beside, F.explode(name).alias("_e")).select(*beside, "_e.*")
    return rows
