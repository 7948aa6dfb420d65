"""Ranked lexical search as maximum inner products over impact vectors in norm buckets.

A document's coordinate for a term is the term's impact there, an integer; a
query's is the term's weight times how often the query has it; a document's score is their
inner product. The queries are worked off in blocks of bounded size, each with
these passes:

1. Whole texts are read once and reduced to the counts of the block's terms.
2. Counts become impact vectors, dealt to tasks in order of their length
   (Euclidean norm), longest first, and written.
3. The longest vectors of all are scored, which gives each query a first lower
   bound for its tenth place.
4. Each task goes through its vectors bucket by bucket. By Cauchy-Schwarz a bucket
   whose longest vector times the query's length stays below the query's bound
   is skipped. In the others a vector's coordinates at the query's heaviest terms,
   and Cauchy-Schwarz for the rest of both, bound its score. Survivors are scored
   exactly in integers, and raise the task's bounds as it goes.
5. What each task keeps, at most ``top`` rows a query, is ranked.

A bound must lie below a place to exclude, so ties are never lost, and the bounds,
which are doubles, get a margin far above their rounding errors.

Defined results: a null text, or one without a term, is found by no query, and
a query without a term finds nothing. Rows of one doc_id are documents of their
own, repeated rows too; equal scores go by doc_id, null first, and which of two
equal rows comes first can't be seen. Queries are the distinct (item_id, text). Extra columns are not
looked at. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import texts, written

#: Places of a query.
TOP = 10
#: Bytes of query texts in a block: bounds what is sent to the tasks and each pass's dense buckets.
BLOCK_BYTES = 96 << 10
#: Vectors in a bucket, and the longest ones that give the first bounds.
BUCKET = 512
#: Coordinates of a query that bound a vector's score before it is scored.
FOCUS = 8

#: What a null doc_id counts as among equal scores.
NULL_ID = -(1 << 63)

_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_VECTORS = "doc_id long, n long, term array<int>, tf array<int>"
_IMPACTS = "doc_id long, norm double, term array<int>, impact array<long>"
_FOUND = "item int, doc_id long, score long"


def terms(values: pa.Array) -> pa.ListArray:
    """Each text's terms in order; runs of separators leave empty strings at its ends only."""
    return pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(values), _SEPARATORS, " "))


@dataclass(frozen=True)
class Block:
    """Some queries: their ids, and for each its terms, as numbers, with how often it has them."""

    items: list
    vocabulary: list[str]
    queries: list[dict[int, int]]

    @classmethod
    def of(cls, rows: list[tuple]) -> Block:
        number: dict[str, int] = {}
        queries = []
        for _, text in rows:
            counts: dict[int, int] = {}
            for t in terms(pa.array([text or ""], pa.string())).values.to_pylist():
                if t:
                    i = number.setdefault(t, len(number))
                    counts[i] = counts.get(i, 0) + 1
            queries.append(counts)
        return cls([r[0] for r in rows], list(number), queries)


def blocks(queries: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The distinct (item_id, text) in blocks of about ``block_bytes``, one on the driver at a time."""
    items = written(queries.select("item_id", F.col("text").cast("string").alias("text")).distinct(), "search_items")
    n = int((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for b in range(n):
        rows = items.filter(part == b).orderBy("item_id", "text").collect()
        if rows:
            yield Block.of([(r.item_id, r.text) for r in rows])


def _vectors(vocabulary: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch in batches:
            if not batch.num_rows:
                continue
            found = terms(pc.fill_null(batch.column("text"), ""))
            row = pc.list_parent_indices(found).to_numpy().astype(np.int64)
            flat = pc.list_flatten(found)
            real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
            n = np.bincount(row[real], minlength=batch.num_rows)
            at = pc.index_in(flat, value_set=known)
            hit = at.is_valid().to_numpy(zero_copy_only=False)
            key = row[hit] * max(len(vocabulary), 1) + at.drop_null().to_numpy()
            key, tf = np.unique(key, return_counts=True)
            ends = np.searchsorted(key, np.arange(batch.num_rows + 1) * max(len(vocabulary), 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array((key % max(len(vocabulary), 1)).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int32)))], ["doc_id", "n", "term", "tf"])

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of a list column."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy()


def _impacts(n_docs: int, n_terms: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, tf = _lists(batch.column("tf"))
            tf = tf.astype(np.int64)
            m = 100 - 75 + (75 * batch.column("n").to_numpy() * n_docs) // n_terms
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(ends)))
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            norm = np.sqrt(np.bincount(row, impact.astype(float) ** 2, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(norm), batch.column("term"),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(impact))],
                ["doc_id", "norm", "term", "impact"])

    return run


class Search:
    """A block's queries as weight vectors, looking through impact vectors bucket by bucket."""

    def __init__(self, block: Block, weights: list[int], top: int = TOP, focus: int = FOCUS):
        self.top, self.width = top, len(block.vocabulary)
        self.terms, self.weights = [], []
        for q in block.queries:
            found = sorted(((weights[t] * c, t) for t, c in q.items() if weights[t] > 0), reverse=True)
            self.terms.append(np.array([t for _, t in found], np.int64))
            self.weights.append(np.array([w for w, _ in found], np.int64))
        self.norm = np.array([np.sqrt((w.astype(float) ** 2).sum()) for w in self.weights])
        self.rest = np.array([np.sqrt((w[focus:].astype(float) ** 2).sum()) for w in self.weights])
        self.focus = focus
        self.bound = np.zeros(len(self.terms), np.int64)     # a score below this takes no place
        self.best: list[list[tuple[int, int, int | None]]] = [[] for _ in self.terms]
        self.scored = 0

    def bucket(self, ids: list, norms: np.ndarray, ends: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """Take the vectors of one bucket into the queries' best."""
        longest = norms.max(initial=0.0)
        live = np.flatnonzero((self.norm * longest * (1 + 1e-9) >= self.bound) & (self.norm > 0))
        if not len(live) or longest == 0:
            return
        dense = np.zeros((len(ids), self.width), np.int64)
        dense[np.repeat(np.arange(len(ids)), np.diff(ends)), term] = impact
        squares = norms ** 2
        for q in live:
            t, w = self.terms[q], self.weights[q]
            head = dense[:, t[:self.focus]].astype(float)
            left = np.sqrt(np.maximum(squares - (head ** 2).sum(1), 0) + squares * 1e-9)
            most = (head @ w[:self.focus].astype(float) + self.rest[q] * left) * (1 + 1e-9) + 1
            rows = np.flatnonzero((most >= self.bound[q]) & (most > 1))
            if not len(rows):
                continue
            scores = dense[np.ix_(rows, t)] @ w
            self.scored += len(rows)
            good = np.flatnonzero((scores > 0) & (scores >= self.bound[q]))
            if len(good):
                found = [(-int(scores[i]), NULL_ID if ids[rows[i]] is None else ids[rows[i]], ids[rows[i]]) for i in good]
                self.best[q] = sorted(self.best[q] + found, key=lambda f: f[:2])[:self.top]
                if len(self.best[q]) == self.top:
                    self.bound[q] = max(self.bound[q], -self.best[q][-1][0])

    def through(self, batches: Iterator[pa.RecordBatch]) -> None:
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                ends, term = _lists(part.column("term"))
                self.bucket(part.column("doc_id").to_pylist(), part.column("norm").to_numpy(), ends, term,
                            _lists(part.column("impact"))[1])

    def places(self) -> pa.RecordBatch:
        rows = [(q, i, -s) for q, best in enumerate(self.best) for s, _, i in best]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.int64())], ["item", "doc_id", "score"])


def _search(block: Block, weights: list[int], bounds: list[int], top: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(block, weights, top)
        search.bound[:] = bounds
        search.through(batches)
        yield search.places()

    return run


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, block: Block, top: int) -> DataFrame:
    vectors = written(docs.mapInArrow(_vectors(block.vocabulary), _VECTORS), "search_vectors")
    n_docs, n_terms = vectors.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    holding = {r.term: r.df for r in vectors.select(F.explode("term").alias("term")).groupBy("term")
               .agg(F.count("*").alias("df")).collect()}        # at most the block's terms
    weights = [floor(1000 * log((2 * n_docs + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(block.vocabulary))]
    impacts = (vectors.filter(F.size("term") > 0).mapInArrow(_impacts(n_docs, n_terms or 1), _IMPACTS)
               .repartitionByRange(F.desc("norm"), F.col("doc_id")).sortWithinPartitions(F.desc("norm")))
    impacts = written(impacts, "search_impacts")
    longest = impacts.orderBy(F.desc("norm")).limit(BUCKET).coalesce(1)
    first = longest.mapInArrow(_search(block, weights, [0] * len(block.items), top), _FOUND)
    bounds = [0] * len(block.items)
    for r in first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect():
        if r.n == top:
            bounds[r.item] = r.least
    ranked = _ranked(impacts.mapInArrow(_search(block, weights, bounds, top), _FOUND), top)
    return ranked.select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each query."""
    spark = docs.sparkSession
    kind = queries.schema["item_id"].dataType
    source = texts(docs)
    result = None
    for block in blocks(queries, block_bytes):
        found = written(_search_block(source, block, top), "search_places")     # one block's work at a time
        names = spark.createDataFrame(list(enumerate(block.items)), "item int, item_id " + kind.simpleString())
        named = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        result = named if result is None else result.unionByName(named)
    if result is None:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return result
