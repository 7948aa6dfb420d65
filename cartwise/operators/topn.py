"""Each user's exact top n items by inner product, without scoring every item.

Items are numbered by falling norm and kept in blocks of ``BLOCK``. Every user
is scored against the first block, which gives a bound for the n-th place;
by Cauchy-Schwarz an item of norm v can't pass it where |user| * v lies below,
so a user needs the blocks up to the last whose longest item may still pass. Those
meet in groups of one block and a bounded number of users. What the driver sees is
the first block and one number a block; lists hold a block or n items. Tasks score
``CELLS`` pairs of a user and an item at a time, so their memory does not follow
the request or the catalog.

Ties go by item_idx. Nothing is left out: with equal norms every block is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.indexing import dense_index
from cartwise.functions.scratch import scratch_path

#: Items in a block, and about how many users meet a block at a time.
BLOCK, USERS = 4096, 8192
#: Scores in memory at a time.
CELLS = 1 << 19

_BLOCK = "block int, longest double, item_idx array<int>, factors array<double>"
_PART = pa.schema([("user_idx", pa.int32()), ("item_idx", pa.int32()), ("rating", pa.float64())])


def _best(scores: np.ndarray, items: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, item) of each row's n greatest scores, ties by item; only those are sorted."""
    by_item = np.argsort(items, kind="stable")
    key = scores[:, by_item]
    key[np.isnan(key)] = -np.inf
    if key.shape[1] > n:
        nth = np.partition(key, -n, axis=1)[:, -n, None]
        above, equal = key > nth, key == nth
        equal &= np.cumsum(equal, axis=1, dtype=np.int32) <= n - above.sum(1, keepdims=True)
        row, at = np.nonzero(above | equal)
    else:
        row, at = (x.ravel() for x in np.indices(key.shape))
    order = np.lexsort((at, -key[row, at], row))
    return row[order], by_item[at[order]]


def _tiles(factors: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The users' factors, so many at a time that ``CELLS`` holds ``width`` numbers of each; with the place of the first."""
    step = max(1, CELLS // max(width, 1))
    for start in range(0, len(factors), step):
        yield start, factors[start:start + step]


def _matrix(lists: pa.Array, rank: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, rank)


def _parts(users: pa.Array, factors: np.ndarray, items: np.ndarray, vectors: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    for start, some in _tiles(factors, len(items)):
        scores = some @ vectors.T
        row, at = _best(scores, items, n)
        yield pa.RecordBatch.from_arrays([users.take(pa.array(start + row)), pa.array(items[at], pa.int32()), pa.array(scores[row, at])],
                                         schema=_PART)


class TopItems:
    """Items in blocks by norm, to be asked for users' best ones.

    ``items`` has (item_idx, features); rows without features are no items.
    """

    def __init__(self, items: DataFrame, block: int = BLOCK):
        self.spark = items.sparkSession
        given = items.select(F.col("item_idx").cast("int").alias("item_idx"), F.col("features").cast("array<double>").alias("features")
                             ).filter("size(features) > 0")
        norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x * x))
        placed = dense_index(given.withColumn("_less", -norm), ["_less", "item_idx"], "place")
        rows = F.sort_array(F.collect_list(F.struct("place", "item_idx", "features")))
        blocks = (placed.groupBy(F.floor(F.col("place") / block).cast("int").alias("block"))
                  .agg(F.max(-F.col("_less")).alias("longest"), rows.alias("_rows"))
                  .select("block", "longest", F.col("_rows.item_idx").alias("item_idx"), F.flatten("_rows.features").alias("factors")))
        path = scratch_path(self.spark, "item_blocks")
        blocks.write.parquet(path)
        self.blocks = self.spark.read.schema(_BLOCK).parquet(path)
        self.longest = [r.longest for r in self.blocks.select("block", "longest").orderBy("block").collect()]
        self.first = self.blocks.filter("block = 0").first()
        self.scored_blocks: DataFrame | None = None

    def best(self, users: DataFrame, n: int, per_group: int = USERS) -> DataFrame:
        """(user_idx, rank, item_idx, rating): the n best items of each of ``users`` (user_idx, features), rank from 1."""
        asked = users.select(F.col("user_idx").cast("int").alias("user_idx"), F.col("features").cast("array<double>").alias("features")
                             ).filter("size(features) > 0")
        if self.first is None:
            return asked.limit(0).select("user_idx", F.lit(1).alias("rank"), F.lit(0).alias("item_idx"), F.lit(0.0).alias("rating"))
        items = np.array(self.first.item_idx, np.int32)
        vectors = np.array(self.first.factors, float).reshape(len(items), -1)
        longest = np.array(self.longest)

        def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A user's best of the first block, and the last block that may hold better ones."""
            for batch in batches:
                for start, factors in _tiles(_matrix(batch["features"], vectors.shape[1]), max(len(items), len(longest))):
                    some = batch.slice(start, len(factors))
                    scores = factors @ vectors.T
                    row, at = _best(scores, items, n)
                    found = scores[row, at].reshape(len(factors), -1)
                    bound = found[:, -1] if found.shape[1] == n else np.full(len(factors), -np.inf)
                    may = np.sqrt((factors ** 2).sum(1))[:, None] * longest[None, :] * (1 + 1e-9) >= bound[:, None]
                    ends = pa.array(np.arange(0, len(row) + 1, found.shape[1], dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [some["user_idx"], some["features"], pa.array(may.sum(1).astype(np.int32) - 1).cast(pa.int32()),
                         pa.ListArray.from_arrays(ends, pa.array(items[at], pa.int32())),
                         pa.ListArray.from_arrays(ends, pa.array(found.ravel()))],
                        ["user_idx", "features", "last", "item_idx", "rating"])

        path = scratch_path(self.spark, "opened")
        asked.mapInArrow(opened, "user_idx int, features array<double>, last int, item_idx array<int>, rating array<double>").write.parquet(path)
        known = self.spark.read.parquet(path)
        self.scored_blocks = known.select("user_idx", (F.greatest("last", F.lit(0)) + 1).alias("n_blocks"))
        n_users, last = known.agg(F.count("*"), F.max("last")).first()
        at_first = known.select("user_idx", F.explode(F.arrays_zip("item_idx", "rating")).alias("r")).select(
            "user_idx", "r.item_idx", "r.rating")
        parts = -(-n_users // per_group)
        rest = known.filter("last > 0").select(
            "user_idx", "features", F.explode(F.sequence(F.lit(1), "last")).alias("block"),
            F.pmod(F.xxhash64("user_idx"), F.lit(max(parts, 1))).cast("int").alias("part"))
        blocks = self.blocks.filter(F.col("block").between(1, last or 0)).select(
            "block", F.explode(F.sequence(F.lit(0), F.lit(max(parts, 1) - 1))).alias("part"), "item_idx", "factors")

        def scored(users: pa.Table, block: pa.Table) -> pa.Table:
            if not users.num_rows or not block.num_rows:
                return _PART.empty_table()
            ids = block["item_idx"].combine_chunks().flatten().to_numpy().astype(np.int32)
            found = _matrix(block["factors"].combine_chunks(), -(-len(block["factors"].combine_chunks().flatten()) // len(ids)))
            return pa.Table.from_batches(_parts(users["user_idx"].combine_chunks(),
                                                _matrix(users["features"].combine_chunks(), found.shape[1]), ids, found, n), _PART)

        more = (rest.groupBy("block", "part").cogroup(blocks.groupBy("block", "part"))
                .applyInArrow(scored, "user_idx int, item_idx int, rating double"))
        order = Window.partitionBy("user_idx").orderBy(F.desc("rating"), "item_idx")
        return (at_first.unionByName(more).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
                .select("user_idx", "rank", "item_idx", "rating"))

    def scored_share(self) -> float:
        """Share of (user, block) pairs that the last call scored, of all there are."""
        n, total = self.scored_blocks.agg(F.count("*"), F.sum("n_blocks")).first()
        return total / (n * len(self.longest)) if n else 0.0
