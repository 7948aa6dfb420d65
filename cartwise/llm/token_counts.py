"""Word-piece token counts by a linear longest-match automaton.

Greedy longest-match-first cuts a word into the longest vocabulary piece that
starts it, then the longest that starts the rest, and so on. Read naively that
goes back over the word again and again; here a trie of the vocabulary gets
failure links: where no piece goes on, the link says in which state the match
stands after the longest pieces so far have been popped, and a precomputed
count says how many those were. So one pass over a word counts its pieces, in
time linear in its length, without building any.

A word is a white-space-delimited chunk of UTF-8 bytes behind the vocabulary's
mark for "preceded by a space"; vocabularies of byte-level pieces cover every
byte, so no word is unknown.

Defined results: a null or empty text, and one of white space, has 0 words and
0 tokens. Rows are counted as they stand.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwise.llm.common import text_column

#: Words whose counts a worker process keeps, and the longest of them in bytes.
MEMO, MEMO_BYTES = 400_000, 64
SPACE = b" "

COUNTS = "struct<n_words:bigint,n_tokens:bigint>"
_COUNTS = pa.struct([("n_words", pa.int64()), ("n_tokens", pa.int64())])


def byte_symbols() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte, by the public rule:

    printable characters of Latin-1 stand for themselves, the rest take the
    characters from 256 on in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a byte-level vocabulary file, without special tokens."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    special = {t["content"] for t in made.get("added_tokens", [])}
    symbols = byte_symbols()
    return [bytes(symbols[c] for c in piece) for piece in made["model"]["vocab"] if piece not in special]


class Automaton:
    """Trie with failure links and popped-piece counts; states are numbers, 0 the root."""

    def __init__(self, pieces: Iterable[bytes]):
        self.next: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            state = 0
            for byte in piece:
                to = self.next[state].get(byte)
                if to is None:
                    to = self.next[state][byte] = len(self.next)
                    self.next.append({})
                    final.append(False)
                state = to
            final[state] = state != 0
        none = -1
        self.fail, self.pops = [none] * len(self.next), [0] * len(self.next)
        order = [0]
        for state in order:     # breadth first: a state's link needs its parent's
            for byte, to in self.next[state].items():
                order.append(to)
                if final[to]:
                    self.fail[to], self.pops[to] = 0, 1
                    continue
                at, popped = self.fail[state], self.pops[state]
                while at != none and byte not in self.next[at]:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at != none:
                    self.fail[to], self.pops[to] = self.next[at][byte], popped
        missing = [b for b in range(256) if b not in self.next[0] or not final[self.next[0][b]]]
        if missing:
            raise ValueError(f"the vocabulary has no piece for {len(missing)} of 256 bytes")

    def count(self, word: bytes) -> int:
        go, fail, pops = self.next, self.fail, self.pops
        state, n = 0, 0
        for byte in word:
            to = go[state].get(byte)
            while to is None:
                n += pops[state]
                state = fail[state]
                to = go[state].get(byte)
            state = to
        while state:
            n += pops[state]
            state = fail[state]
        return n


class Counter:
    _of: dict[str, Counter] = {}

    def __init__(self, path: str):
        self.automaton, self.memo = Automaton(read_vocabulary(path)), {}

    @classmethod
    def of(cls, path: str) -> Counter:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def word(self, w: bytes) -> int:
        n = self.automaton.count(SPACE + w)
        if len(w) <= MEMO_BYTES:
            if len(self.memo) > MEMO:
                self.memo.clear()
            self.memo[w] = n
        return n

    def count(self, text: str | None) -> tuple[int, int]:
        words = text.encode("utf-8", "surrogatepass").split() if text else []
        got = self.memo.get
        return len(words), sum([got(w) or self.word(w) for w in words])


def token_counts(vocabulary: str, text: Column | str = "text") -> Column:
    """Column of words and tokens of whole texts; ``vocabulary`` is the file's path on every machine."""

    def make() -> Callable[[list], pa.Array]:
        counter = Counter.of(vocabulary)

        def of(batch: list) -> pa.Array:
            n = [counter.count(t) for t in batch]
            return pa.StructArray.from_arrays([pa.array([a for a, _ in n], pa.int64()),
                                               pa.array([b for _, b in n], pa.int64())], fields=list(_COUNTS))

        return of

    return text_column(F.col(text) if isinstance(text, str) else text, COUNTS, make)
