"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cartwise.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Rows in one Arrow batch; whole texts travel in them, so few.
BATCH_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """The two columns an operator works on; a null text stays null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names like ``bases`` that don't clash with any column of ``df`` (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = base
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again.

    Cuts the lineage: a lost executor costs the tasks that read it, not the
    work before it. The files live as long as the checkpoint folder does.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


try:    # the C library's allocator keeps freed memory unless asked
    _TRIM = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):
    _TRIM = None


def give_back() -> None:
    """Return to the system what a task's arrays took: its Python worker lives on and serves other stages."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` that gives its memory back when a task ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def text_column(text: Column | str, returns: DataType | str,
                make: Callable[[], Callable[[list[str | None]], pa.Array]]) -> Column:
    """A column computed from whole texts, a batch at a time.

    ``make`` runs once per task and gives the function from a batch's texts to
    an Arrow array. Marked nondeterministic only so that Spark never evaluates
    it twice (once in a filter that it has pushed down, once in a projection).
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = make()
        try:
            for batch in batches:
                yield of(batch.to_pylist())
        finally:
            give_back()

    # the annotations are given as objects: the closure must not need this module's globals
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returns).asNondeterministic()(text)


def learnable(docs: DataFrame, modulus: int, held: int) -> Column:
    """Whether a row may be learned from: crc32(doc_id as text) mod ``modulus`` is not ``held``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus != held


def sample_by(rows: DataFrame, key: str, per_key: int) -> DataFrame:
    """``per_key`` rows of each ``key``, chosen by a hash of ``doc_id``; ids and keys only.

    The rank filter is applied in each task before the shuffle, so a hot key
    sends ``per_key`` rows per task at most.
    """
    from pyspark.sql import Window

    order = Window.partitionBy(key).orderBy(F.xxhash64("doc_id"), "doc_id")
    return (rows.select("doc_id", key).withColumn("_rank", F.row_number().over(order))
            .filter(F.col("_rank") <= per_key).drop("_rank"))
