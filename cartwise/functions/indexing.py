"""Dense 0-based index of distinct keys in sorted order.

Two paths:

* ``bounded=True`` -- the keys form a small dimension (months of a window,
  states, brands, categories, cluster ids). ``dense_rank`` over one ordered
  window is exact and cheap; its single task holds at most the dimension.
* default -- keys that grow with the data (item ids). A window without
  ``partitionBy`` would pull every key into one task. Instead the keys are
  range-partitioned, sorted inside each partition and numbered locally with
  ``monotonically_increasing_id`` (partition id in the high bits, position in
  the low 33 bits). That numbered frame is checkpointed to the shared
  checkpoint folder before it is read twice: range bounds come from a sample
  whose rows arrive in shuffle order, so two evaluations could disagree. A
  per-partition count (one row per partition) gives each partition its offset,
  broadcast back by a join. This is ``zipWithIndex`` in DataFrame form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = (1 << 33) - 1


def rank_on(rows: DataFrame, key_cols: list[str], out: str) -> DataFrame:
    """``rows`` plus ``out`` = 0-based dense rank of ``key_cols``, nulls first.

    For rows already aggregated to a bounded size (months of a window, months x
    states): one window over them, no second computation of the rows and no
    join, so null keys stay.
    """
    order = [F.col(c).asc_nulls_first() for c in key_cols]
    return rows.withColumn(out, (F.dense_rank().over(Window.orderBy(*order)) - 1).cast("int"))


def dense_index(keys: DataFrame, key_cols: list[str], out: str = "idx",
                num_partitions: int | None = None, bounded: bool = False) -> DataFrame:
    """Return ``keys`` (assumed distinct on ``key_cols``) plus ``out`` = rank - 1.

    Ordering is ascending on ``key_cols`` with nulls first, like SQL
    ``DENSE_RANK() OVER (ORDER BY key_cols) - 1`` on distinct keys.
    """
    order = [F.col(c).asc_nulls_first() for c in key_cols]
    if bounded:
        return rank_on(keys, key_cols, out)
    spark = keys.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (keys.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
              .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
              .drop("_mid")
              .checkpoint(eager=True))
    # One row per non-empty partition: bounded by n, safe to broadcast.
    sizes = ranged.groupBy("_pid").agg((F.max("_pos") + 1).alias("_size"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_size").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_pos")).cast("int"))
            .drop("_pid", "_pos", "_off"))
