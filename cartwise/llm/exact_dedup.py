"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to its
distinct digests (pre-aggregated in each task, so a text that a third of all
rows share costs a row per task), sort-merge anti-joined with the index, which
needs no shuffle of the index, and the digests that are new are appended. Each
document then looks up its digest's entry; in that join a hot digest is split
by adaptive skew handling, both of its inputs being plain exchanges over
written tables.

Defined results: a null text equals the empty text. Texts are equal when they
are identical after lower-casing A-Z. Rows repeating a (doc_id, text) are one
document with as many rows, which ``per_row`` gives back; ``group_size`` counts rows. The largest doc_id of a
batch stays, a null doc_id being smaller than any other; a text already in the
index keeps the document it was entered with. An empty batch gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.common import LOWER, UPPER, fresh, scratch_path, texts, written


#: Copies of a decision made at a time.
REPEATS = 10_000


def normalised(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest(text: Column | str) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


class DigestIndex:
    """Digests seen so far: (text_sha256, keep_id), bucketed and sorted by digest.

    ``path`` must be a shared folder; a table made earlier at ``path`` is opened
    again under ``table`` with the ``buckets`` it was made with.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, table: str | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = table or f"digests_{uuid.uuid4().hex}"
        if not spark.catalog.tableExists(self.table):
            spark.sql(f"CREATE TABLE {self.table} (text_sha256 STRING, keep_id BIGINT) USING parquet "
                      f"OPTIONS (path '{path}') CLUSTERED BY (text_sha256) SORTED BY (text_sha256) "
                      f"INTO {buckets} BUCKETS")

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame) -> DataFrame:
        """Append the new digests of ``docs``; one row per document with its decision."""
        rows = written(texts(docs).select("doc_id", digest("text").alias("text_sha256"))
                       .groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n_rows")), "digest_rows")
        groups = rows.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size"))
        new = (groups.repartition(self.buckets, "text_sha256")
               .join(self.entries().hint("merge"), "text_sha256", "left_anti"))
        (new.select("text_sha256", "keep_id").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "text_sha256").sortBy("text_sha256").option("path", self.path).saveAsTable(self.table))
        kept = written(groups.withColumnRenamed("keep_id", "batch_keep")
                       .join(self.entries(), "text_sha256")
                       .select("text_sha256", "keep_id", "group_size", "batch_keep"), "digest_groups")
        return (rows.join(kept.withColumnRenamed("text_sha256", "_digest"), F.col("text_sha256") == F.col("_digest"))
                .select("doc_id", "keep_id", "group_size",
                        (F.col("doc_id").eqNullSafe(F.col("keep_id"))
                         & F.col("batch_keep").eqNullSafe(F.col("keep_id"))).alias("kept"),
                        "text_sha256", "n_rows"))


def exact_dedup(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Decisions for one batch against a new index in the shared folder."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, scratch_path(spark, "digest_index"), buckets).add(docs)


def per_row(decisions: DataFrame, many: str = "n_rows") -> DataFrame:
    """A row for each input row: decisions repeated as often as their (doc_id, text) was given, in lists of bounded length."""
    whole, rest = F.floor(F.col(many) / REPEATS), F.col(many) % REPEATS
    lists = F.concat(F.when(whole > 0, F.array_repeat(F.lit(REPEATS), whole.cast("int"))).otherwise(F.array().cast("array<int>")),
                     F.array(rest.cast("int")))
    counted = decisions.withColumn(many, F.explode(lists))
    return counted.withColumn(many, F.explode(F.array_repeat(F.lit(1), F.col(many)))).drop(many)


def drop_copies(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one of a row that repeats."""
    key, copy, many, own = fresh(docs, "_kept_id", "_kept_digest", "_kept_rows", "_digest")
    kept = decisions.filter("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(copy),
                                           F.col("n_rows").alias(many))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.col(own) == F.col(copy))
    joined = docs.withColumn(own, digest(F.col("text").cast("string"))).join(kept, same)
    once = joined.filter(F.col(many) == 1).select(*docs.columns)
    again = joined.filter(F.col(many) > 1).dropDuplicates([key, copy]).select(*docs.columns)
    return once.unionByName(again)
