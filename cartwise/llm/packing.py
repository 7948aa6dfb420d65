"""Best-fit packing of tokenized documents into fixed-length sequences.

Three steps:

1. One pass tokenizes whole texts and cuts documents into pieces. A piece is
   numbered within its task and length while it is made, so ranking the pieces
   of one length needs no window over them, however many share it.
2. The plan is made on counts alone: at most ``LENGTH`` distinct piece lengths,
   longest first, each put into the fullest open sequences that hold it. What
   comes out says "pieces of length L with ranks a to b go to sequences
   s, s+1, ... at offset o"; its size follows from ``LENGTH``, not from the
   corpus.
3. A piece's rank within its length is its number in its task plus the counts
   of earlier tasks (a join on task and length). It joins the plan on its
   length and the range of ranks that holds it; the plan is broadcast if it has
   at most ``PLAN_ROWS`` rows.

Texts are tokenized a white-space-delimited chunk at a time with a bounded memo:
the tokenizer replaces white space and never merges across it, so a text's ids
are those of its chunks in order.

Defined results: a null text is empty; an empty document is the one id that
ends each document. A document longer than a sequence is cut, the last piece
being shorter; others are whole. Rows with a null or repeated doc_id are packed
as they stand. An empty table gives an empty plan and no rows.
"""

from __future__ import annotations

import bisect
import heapq
import os
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import mapped, texts, written
from cartwise.llm.token_counts import byte_symbols

#: Tokens of a sequence; the id that ends a document.
LENGTH, END = 2048, 0
#: Chunks whose ids a task keeps.
MEMO = 400_000
#: Rows of a plan up to which it is broadcast; a larger one is joined by a shuffle.
PLAN_ROWS = 200_000

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, number long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
                     ("ids_crc32", pa.int64()), ("task", pa.int32()), ("number", pa.int64())])


class ChunkTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    A chunk of letters, perhaps with closing punctuation, is one pre-token or
    two, and its pieces come straight from the file's merges; every other chunk
    goes through the whole tokenizer. Letters are those up to U+024F, where
    normal form and lower case need no context.
    """

    _of: dict[str, ChunkTokenizer] = {}
    CLOSING = ".,;:!?"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.memo = Tokenizer.from_file(path), {}
        self.merges = self.tokenizer.model.tokenize
        self.symbols = {byte: ord(c) for c, byte in byte_symbols().items()}

    @classmethod
    def of(cls, path: str) -> ChunkTokenizer:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def packed(self, chunks: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids)
                for e in self.tokenizer.encode_batch(chunks, add_special_tokens=False)]

    def letters(self, word: str) -> bytes | None:
        """Ids of a chunk that is letters and closing punctuation, else None."""
        stem = word.rstrip(self.CLOSING)
        if not stem.isalpha() or not (stem.isascii() or max(stem) < "\u0250" and "\u0130" not in stem):
            return None
        low = stem.lower()
        if not low.isascii():
            low = low.encode().decode("latin-1").translate(self.symbols)
        ids = [t.id for t in self.merges(low)]
        made = struct.pack(f"<{len(ids)}I", *ids)
        if len(stem) < len(word):
            closing = word[len(stem):].encode()
            if closing not in self.memo:
                self.memo[closing], = self.packed([word[len(stem):]])
            made += self.memo[closing]
        return made

    def encode(self, text: str | None) -> bytes:
        chunks = text.encode().split() if text else []
        memo = self.memo
        try:
            return b"".join([memo[c] for c in chunks])
        except KeyError:
            if len(memo) > MEMO:
                memo.clear()
            other = []
            for c in dict.fromkeys(chunks):
                if c not in memo:
                    ids = self.letters(c.decode())
                    if ids is None:
                        other.append(c)
                    else:
                        memo[c] = ids
            memo.update(zip(other, self.packed([c.decode() for c in other]), strict=True))
            return b"".join([memo[c] for c in chunks])


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Step 1: a row per piece. ``tokenizer`` is the file's path on every machine."""
    last = int(end).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, numbers = ChunkTokenizer.of(tokenizer).encode, TaskContext.get().partitionId(), {}
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [], [])
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = memoryview(encode(text) + last)
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    n = len(part) // 4
                    numbers[n] = number = numbers.get(n, -1) + 1
                    for col, value in zip(cols, (doc_id, k, at // 4, n, zlib.crc32(part), task, number), strict=True):
                        col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECES, strict=True)],
                                             schema=_PIECES)
        ChunkTokenizer.of(tokenizer).memo.clear()

    return mapped(texts(docs), run, PIECES)


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Step 2: (piece length, first rank, pieces, first sequence, offset), best fit, longest first.

    Open sequences are held as ranges of equal room. For each length the ranges
    with the least sufficient room are taken first; only when none is left are
    new sequences opened.
    """
    out: list[tuple[int, int, int, int, int]] = []
    rooms: list[int] = []                          # rooms of open sequences, ascending
    ranges: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)
    opened = 0

    def leave(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in ranges:
                bisect.insort(rooms, room)
                ranges[room] = []
            heapq.heappush(ranges[room], (first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):    # new sequences, as full as pieces of this length make them
                each = length // size
                full, rest = divmod(left, each)
                for first, n, deep in ((opened, full, each), (opened + full, 1, rest)):
                    for k in range(deep if n else 0):
                        out.append((size, rank, n, first, k * size))
                        rank += n
                    if n and deep:
                        leave(length - deep * size, first, n)
                opened += full + (rest > 0)
                break
            room = rooms[at]
            first, n = heapq.heappop(ranges[room])
            if not ranges[room]:
                del ranges[room]
                rooms.pop(at)
            put = min(left, n)
            out.append((size, rank, put, first, length - room))
            leave(room, first + put, n - put)
            leave(room - size, first, put)
            rank, left = rank + put, left - put
    return out


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """A row per piece with its sequence and its offset there."""
    spark = docs.sparkSession
    made = written(pieces(docs, tokenizer, length, end), "pieces")
    per_task = made.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan(counts, length)
    planned = spark.createDataFrame(slots, "p_length int, p_rank long, p_count long, p_sequence long, p_offset long")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = written(per_task.select(F.col("task").alias("b_task"), F.col("length").alias("b_length"),
                                     F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "ranks_before")
    # a sort-merge join at every size: there are more tasks, and so more of these counts, in a larger corpus
    ranked = (made.join(before.hint("merge"), (F.col("task") == F.col("b_task")) & (F.col("length") == F.col("b_length")))
              .withColumn("rank", F.col("before") + F.col("number")))
    slot = ((F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_rank"))
            & (F.col("rank") < F.col("p_rank") + F.col("p_count")))
    found = ranked.join(F.broadcast(planned) if len(slots) <= PLAN_ROWS else planned, slot)
    return found.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                        (F.col("p_sequence") + F.col("rank") - F.col("p_rank")).alias("sequence_id"),
                        F.col("p_offset").alias("offset"))
