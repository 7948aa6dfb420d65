"""Sinks: the reference replaces, appends to or clears document collections.

Here a collection is a folder of snapshots (``sources/snapshots.py``), each
written by Spark's own writers as a distributed job; nothing passes through the
driver. Replacing or clearing makes a new snapshot, so readers have the old
collection until the new one is whole, also if the job fails. Appending writes a
partition of the current snapshot: one for each request, overwritten when the same
request is made again, so that a repeated job leaves one copy.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.sources.snapshots import Snapshots

#: Partition column of what was appended, by request; readers don't see it.
REQUEST = "_request"


def _snapshot(df: DataFrame, path: str, fmt: str) -> str:
    """Write ``df`` as a new snapshot and make it current; returns its folder."""
    versions = Snapshots(df.sparkSession, path)
    place = versions.begin()
    df.write.format(fmt).save(f"{place}/data")
    versions.finish(place)
    return place


def replace_collection(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Put ``df`` in place of the collection, which stays readable until ``df`` is written whole."""
    _snapshot(df, path, fmt)


def clear_collection(spark: SparkSession, schema, path: str, fmt: str = "parquet") -> None:
    """Leave an empty collection with the given schema."""
    _snapshot(spark.createDataFrame([], schema), path, fmt)


def append_collection(df: DataFrame, path: str, fmt: str = "parquet", request: str | None = None) -> None:
    """Add ``df`` to the collection; what the same ``request`` added to it before is replaced.

    Spark stages the rows and moves them into the request's partition when all
    tasks are done. Without a request the rows are one of their own.
    """
    versions = Snapshots(df.sparkSession, path)
    place = versions.current()
    if place is None:
        place = _snapshot(df.limit(0), path, fmt)
    (df.withColumn(REQUEST, F.lit(request or uuid.uuid4().hex)).write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(REQUEST).save(f"{place}/appended"))


def replace_by_key(df: DataFrame, path: str, key: str, order: list[str], buckets: int | None = None) -> None:
    """Put ``df`` in place of the collection, as rows bucketed by ``key`` and sorted by it and ``order``.

    For lists that grow with the data: a list is not collected into one value but
    lies in consecutive rows of one bucket, written by sorting (which spills) and read by
    ``read_by_key``, where a filter on the key opens that bucket's file only.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    versions = Snapshots(spark, path)
    place = versions.begin()
    (df.repartition(buckets, key).write.format("parquet").option("path", f"{place}/data")
     .bucketBy(buckets, key).sortBy(key, *order).saveAsTable(_table(place)))
    spark.sql(f"DROP TABLE {_table(place)}")        # the name only: the files are the snapshot's
    spark.createDataFrame([(key, order, buckets)], "key string, order array<string>, buckets int").write.parquet(f"{place}/layout")
    versions.finish(place)


def read_by_key(spark: SparkSession, path: str) -> DataFrame:
    """The current state of a collection written by ``replace_by_key``, with its buckets known to Spark.

    The buckets are registered anew in each application, so no metastore need outlive one.
    """
    place = Snapshots(spark, path).current()
    if place is None:
        raise FileNotFoundError(f"no collection in {path}")
    name = _table(place)
    if not spark.catalog.tableExists(name):
        at = spark.read.parquet(f"{place}/layout").first()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{place}/data").schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({at.key}) "
                  f"SORTED BY ({', '.join([at.key, *at.order])}) INTO {at.buckets} BUCKETS LOCATION '{place}/data'")
    return spark.table(name)


def _table(place: str) -> str:
    return f"cartwise_by_key_{hashlib.sha256(place.encode()).hexdigest()[:16]}"


def request_id(users: DataFrame) -> str:
    """A name for the request of these customers, the same in any order and with repeats."""
    ids = users.select(F.xxhash64("customer_id").alias("h")).distinct()
    n, total = ids.agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return f"{n}-{total or 0}"


def read_collection(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current state of a collection: its newest whole snapshot and what was appended to it."""
    versions = Snapshots(spark, path)
    place = versions.current()
    if place is None:
        raise FileNotFoundError(f"no collection in {path}")
    base = spark.read.format(fmt).load(f"{place}/data")
    if not versions.exists(f"{place}/appended"):
        return base
    added = spark.read.format(fmt).schema(base.schema).load(f"{place}/appended")
    return base.unionByName(added.select(*base.columns))
