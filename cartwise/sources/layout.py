"""Co-located storage for the repeated line-order join.

Almost every job joins order lines to their orders on the order id, which at
scale shuffles both of the two largest tables every time. Writing both once as
bucketed tables (same column, same bucket count, sorted) lets Spark's
sort-merge join read matching buckets side by side with no exchange on either
input. The layout is optional: ``load_colocated`` returns the same
``StoreTables`` with those two tables swapped for their bucketed copies.

A copy lives in a folder of its own, named by its source's version and its bucket
count, and its session tables are named after that folder, so copies of several
sources, and of several states of one, can be used side by side. ``source_version``
derives the version from the source's files; a copy whose source changed while it was
written is not marked complete. The bucket metadata is registered anew (``CREATE TABLE ... CLUSTERED BY
... LOCATION``), so a later application needs no metastore. A marker written
last tells a whole copy from a half-written one. The lines copy is also
partitioned by its order's month, so windows on the order date prune line files
before the join.
"""

from __future__ import annotations

import dataclasses
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.sources.tables import StoreTables


def source_version(spark: SparkSession, paths: list[str]) -> str:
    """A fingerprint of the files below ``paths``: their names, lengths and modification times.

    Spark lists the files, in parallel where there are many, and never opens them;
    what comes to the driver is one row. Another folder, an added, removed or
    rewritten file gives another version.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([p.rstrip("/") for p in paths])
             .select("path", "length", "modificationTime"))
    each = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    n, total, low, high = files.select(each.alias("h")).agg(
        F.count("*"), F.sum(F.col("h").cast("decimal(38,0)")), F.min("h"), F.max("h")).first()
    return hashlib.sha256(f"{n} {total} {low} {high}".encode()).hexdigest()[:24]


def copy_folder(folder: str, buckets: int, version: str) -> str:
    """Where the copy of a source version with that many buckets is."""
    return f"{folder.rstrip('/')}/{version}-{buckets}"


def _names(place: str) -> tuple[str, str]:
    key = hashlib.sha256(place.encode()).hexdigest()[:16]
    return f"cartwise_order_{key}", f"cartwise_lines_{key}"


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found))


def is_complete(spark: SparkSession, folder: str, buckets: int, version: str) -> bool:
    """Whether the copy was written to its end."""
    return _exists(spark, f"{copy_folder(folder, buckets, version)}/complete/_SUCCESS")


def _save(df: DataFrame, key: str, buckets: int, path: str, name: str, by: list[str]) -> None:
    # one task per bucket: a file per bucket (and month), not one per task and bucket
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    if by:
        writer = writer.partitionBy(*by)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def write_colocated(t: StoreTables, folder: str, buckets: int, version: str,
                    sources: list[str] | None = None) -> None:
    """Write orders and order lines bucketed and sorted by the order id.

    The lines copy also carries its order's month and is partitioned by it, so
    date-windowed jobs prune line files at the scan (``month_prefilter``).
    Lines without an order keep a null month and stay in the copy. At most
    ``buckets`` files are written for the orders and for each month's lines. With
    ``sources`` (the paths that ``version`` was derived from) the copy is marked
    complete only if they still have that version when it is written.
    """
    spark, place = t.order.sparkSession, copy_folder(folder, buckets, version)
    orders, lines = _names(place)
    _save(t.order, "id", buckets, f"{place}/order", orders, [])
    months = t.order.select(F.col("id").alias("order_id"), F.trunc("date", "month").alias("order_month"))
    _save(t.ordereditem.join(months, "order_id", "left"), "order_id", buckets, f"{place}/ordereditem", lines,
          ["order_month"])
    if sources and source_version(spark, sources) != version:
        raise RuntimeError(f"the source changed while its copy in {place} was written")
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(version).alias("version")) \
        .write.mode("overwrite").parquet(f"{place}/complete")


def load_colocated(spark: SparkSession, t: StoreTables, folder: str, buckets: int, version: str) -> StoreTables:
    """``t`` with ``order`` and ``ordereditem`` read from the bucketed copy, which must be complete."""
    if not is_complete(spark, folder, buckets, version):
        raise FileNotFoundError(f"no complete copy in {copy_folder(folder, buckets, version)}")
    place = copy_folder(folder, buckets, version)
    orders, lines = _names(place)
    date_type = t.order.schema["date"].dataType.simpleString().upper()
    if not spark.catalog.tableExists(orders):
        spark.sql(f"CREATE TABLE {orders} (id BIGINT, customer_id BIGINT, date {date_type}, "
                  f"totalPrice DOUBLE) USING parquet CLUSTERED BY (id) SORTED BY (id) "
                  f"INTO {buckets} BUCKETS LOCATION '{place}/order'")
    if not spark.catalog.tableExists(lines):
        spark.sql(f"CREATE TABLE {lines} (order_id BIGINT, item_id BIGINT, quantity INT, "
                  f"order_month DATE) USING parquet PARTITIONED BY (order_month) "
                  f"CLUSTERED BY (order_id) SORTED BY (order_id) INTO {buckets} BUCKETS "
                  f"LOCATION '{place}/ordereditem'")
        spark.sql(f"ALTER TABLE {lines} RECOVER PARTITIONS")
    return dataclasses.replace(t, order=spark.table(orders), ordereditem=spark.table(lines), colocated=True)
