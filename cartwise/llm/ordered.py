"""Each row beside the next one in the order of its ids, without sorting the table in one task.

Ids that a hash chooses open ranges of about ``RANGE_ROWS`` rows. Rows are dealt
to tasks by range, and the rows of an id that opens a range also go, as copies,
to the end of the range before, so every row finds its successor where it lies.
The rows are shuffled once; the driver sees the chosen ids only, about
``MAX_RANGES`` of them at most, whatever the table's size.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows of a range, on average, and about how many ranges there are at most.
RANGE_ROWS = 200
MAX_RANGES = 65_536


def range_of(key: Column, starts: list[int]) -> Column:
    """How many of ``starts`` (ascending) are at most ``key``, by two levels of about sqrt(n) comparisons."""
    if not starts:
        return F.lit(0)
    width = isqrt(len(starts) - 1) + 1
    blocks = [starts[i:i + width] for i in range(0, len(starts), width)]

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda s: s <= key))

    def literal(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    full = passed(literal([b[0] for b in blocks]))
    inside = F.get(F.array(*[literal(b) for b in blocks]), F.greatest(full - 1, F.lit(0)))
    return F.when(full == 0, 0).otherwise((full - 1) * width + passed(inside))


def by_ranges(rows: DataFrame, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, WindowSpec]:
    """(dealt, order): ``rows`` with the columns ``place`` and ``copy``, and the window in which they follow each other.

    ``rows`` has an ``id`` (long, not null) and a ``text`` that decides among equal
    ids. Within the window, ``lead`` gives each row of its own (``copy`` is 0)
    its successor; after the last row of all comes the first. Rows with ``copy`` 1
    are there to be led to and are dropped after that.
    """
    every = max(range_rows, -(-rows.count() // MAX_RANGES))
    opens = F.pmod(F.xxhash64("id"), F.lit(every)) == 0
    starts = sorted(r.id for r in rows.filter(opens).groupBy("id").agg(F.count("*").alias("n")).collect())
    first = rows.agg(F.min("id")).first()[0]
    at = range_of(F.col("id"), starts)
    places = F.array(F.struct(at.alias("place"), F.lit(0).alias("copy")),
                     F.when(opens, F.struct((at - 1).alias("place"), F.lit(1).alias("copy"))),
                     F.when(F.col("id") == F.lit(first).cast("long"),
                            F.struct(F.lit(len(starts)).alias("place"), F.lit(1).alias("copy"))))
    dealt = rows.select("*", F.explode(F.array_compact(places)).alias("_at")).select(*rows.columns, "_at.place", "_at.copy")
    return dealt, Window.partitionBy("place").orderBy("copy", "id", "text")
