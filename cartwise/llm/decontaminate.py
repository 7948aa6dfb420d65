"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the benchmark's word windows. Searching one window length
needs two tables: how far a pair of words lets the search jump (a pair that no
window holds lets it jump almost a whole window), and, for pairs that end a
window, the windows with that ending, which are compared directly. Windows of
whole items shorter than the usual length have tables of their own, one set per
length that occurs.

Documents are scanned where they lie, without a shuffle. The benchmark is the
only side sent to the tasks, in blocks of bounded bytes (``BLOCK_BYTES``, by
its measured size); each block is one more pass in the same stage, carrying the
hits so far.

Defined results: null text has no words, neither has text without word
characters; such an item has no windows. Repeated items and rows count as they
stand: each document row gets its row, an item_id found in several rows is
listed once. A null item_id takes part in hits and is not listed.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import text_column

#: Consecutive words of a window.
WINDOW = 10
#: Bytes of benchmark text sent to the tasks at once.
BLOCK_BYTES = 16 << 20

_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
               for b in range(256))

HITS = "struct<n_words:bigint,spans:array<struct<start:int,stop:int>>,items:array<string>>"
_HITS = pa.struct([("n_words", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                   ("items", pa.list_(pa.string()))])


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def windows(ws: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not ws:
        return []
    return [tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))]


class WordSearch:
    """Wu-Manber tables for windows of ``m`` words each."""

    def __init__(self, m: int, owners: dict[tuple[bytes, ...], list[str]]):
        self.m, self.block = m, min(2, m)
        self.far = m - self.block + 1
        self.shift: dict = {}
        self.ending: dict = {}
        for window, items in owners.items():
            for end in range(self.block, m + 1):
                key = window[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.far), m - end)
            self.ending.setdefault(window[m - self.block:], []).append((list(window), items))

    def occurrences(self, ws: list[bytes]):
        """(start, items) of each occurrence of a window, by start."""
        m, block, far, shift, n, at = self.m, self.block, self.far, self.shift.get, len(ws), self.m
        while at <= n:
            key = tuple(ws[at - block:at])
            jump = shift(key, far)
            if jump:
                at += jump
                continue
            here = ws[at - m:at]
            for window, items in self.ending[key]:
                if window == here:
                    yield at - m, items
            at += 1


def searches(items: list[tuple[str | None, str | None]], size: int = WINDOW) -> list[WordSearch]:
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item, text in items:
        for window in windows(words(text), size):
            owners = by_length.setdefault(len(window), {}).setdefault(window, [])
            if item is not None and item not in owners:
                owners.append(item)
    return [WordSearch(m, owners) for m, owners in sorted(by_length.items())]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


_BUILT: dict[str, list[WordSearch]] = {}


def _scanner(key: str, block, size: int) -> Callable[[], Callable[[list], pa.Array]]:
    def make():
        if key not in _BUILT:       # once for each worker process and block
            if len(_BUILT) > 3:
                _BUILT.clear()
            _BUILT[key] = searches(block.value, size)
        tables = _BUILT[key]

        def of(batch: list) -> pa.Array:
            out = []
            for text in batch:
                ws, spans, found = words(text), [], set()
                for table in tables:
                    for start, items in table.occurrences(ws):
                        spans.append((start, start + table.m))
                        found.update(items)
                out.append({"n_words": len(ws), "spans": [{"start": a, "stop": b} for a, b in merged(spans)],
                            "items": sorted(found)})
            return pa.array(out, _HITS)

        return of

    return make


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[list[tuple]]:
    """The benchmark in blocks of about ``block_bytes``, read one after another."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [[(r.item, r.text) for r in items.filter(block == b).collect()] for b in range(n)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, name: str = "contamination", text: str = "text",
                       size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the struct column ``name``: words, merged spans of hit words, items found."""
    spark = docs.sparkSession
    columns: list[Column] = []
    for block in benchmark_blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(block)
        columns.append(text_column(text, HITS, _scanner(f"{sent._jbroadcast.id()}-{size}", sent, size)))
    out = docs
    names = [f"{name}__{i}" for i in range(len(columns))]
    for n, column in zip(names, columns, strict=True):
        out = out.withColumn(n, column)
    if len(names) == 1:
        return out.withColumnRenamed(names[0], name)
    spans = F.array_sort(F.flatten(F.array(*[F.col(n)["spans"] for n in names])))
    grown = F.aggregate(spans, F.array().cast("array<struct<start:int,stop:int>>"), _join_span)
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(n)["items"] for n in names]))))
    return out.withColumn(name, F.struct(F.col(names[0])["n_words"].alias("n_words"), grown.alias("spans"),
                                         items.alias("items"))).drop(*names)


def _join_span(done: Column, span: Column) -> Column:
    last = F.try_element_at(done, F.lit(-1))
    touches = (F.size(done) > 0) & (span["start"] <= last["stop"])
    joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
    return F.when(touches, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))).otherwise(
        F.concat(done, F.array(span)))


def n_hit(name: str = "contamination") -> Column:
    """Words of a document inside any span."""
    return F.aggregate(F.col(name)["spans"], F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]))
