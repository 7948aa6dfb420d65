"""Secret scans: fixed patterns, and two character Markov models for the rest.

The patterns of ``KINDS`` give the base spans. They also label samples: what
they find is random strings, the rest of the texts is ordinary: its longer tokens,
and, since prose holds few identifiers, its words, four at a time, joined the ways
identifiers are (:func:`identifiers`). Character transitions of both kinds are
counted over all documents (a task sends its counts, not its tokens), and a
token's log-likelihood ratio between the two models says which of them it came
from: tokens of ``LEAST`` characters and more that lean to randomness by the
model's threshold a character become spans of kind ``random``.

Identifiers elsewhere have words that these documents lack. So the threshold comes
from identifiers of words that the transitions were not counted on: a hash of the
word holds one in ``HELD_OUT`` back. It is the least threshold, from ``PER_CHAR``
upwards, that no more than ``MISTAKEN`` of these identifiers and of the ordinary
long tokens reach.

Defined results: a null text is empty and has no spans. Spans are in code
points, sorted by start, then by kind as listed. Where no pattern matched
anything there is no random model, and base spans are all. Repeated rows are
scanned as they stand.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import mapped, text_column, texts

# The base patterns and the least length of what they find.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")

_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Least characters of a token that is scored, least log-likelihood ratio a character.
LEAST, PER_CHAR = 16, 0.3
#: Weight of the uniform distribution in the ordinary transitions; of single characters' frequencies in the random ones.
SMOOTHING, INDEPENDENT = 5.0, 20.0
#: Share of single characters' frequencies in the ordinary model: pairs that no word here has aren't random yet.
BACKOFF = 0.05
#: One in so many words is held out for the threshold; share of ordinary tokens that may reach it.
HELD_OUT, MISTAKEN = 4, 0.002
#: Width of a bin of ratios, and their number on either side of 0.
BIN, BINS = 0.01, 2000
#: Consecutive words of a text that make an identifier.
JOINED = 4
_WORD = re.compile(r"[A-Za-z]+")

_IN_TOKEN = np.zeros(256, bool)
_IN_TOKEN[[c for c in range(128) if chr(c).isalnum() or chr(c) in "+/_=-"]] = True
_SYMBOLS = int(_IN_TOKEN.sum())
_CODE = np.cumsum(_IN_TOKEN) - 1

SPANS = "array<struct<kind:string,start:int,stop:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

Span = tuple[int, int, int, int]    # start, kind, stop, start of the secret itself


def base_spans(text: str | None) -> list[Span]:
    if not text:
        return []
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(out)


def _transitions(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    inside = _IN_TOKEN[b]
    both = inside[:-1] & inside[1:]
    code = _CODE[b]
    return np.bincount(code[:-1][both] * _SYMBOLS + code[1:][both], minlength=_SYMBOLS * _SYMBOLS)


def identifiers(ws: list[str]) -> list[str]:
    """Words, four at a time, as identifiers: Pascal and camel case, snake case, with a number, capitals, hyphens."""
    out = []
    for i in range(0, len(ws) - JOINED + 1, JOINED):
        own = ws[i:i + JOINED]
        form = i // JOINED % 6
        if form < 2:
            name = "".join([w.capitalize() for w in own])
            out.append(name if form == 0 else name[0].lower() + name[1:])
        elif form < 4:
            name = "_".join(own).lower()
            out.append(name if form == 2 else f"{name}_{zlib.crc32(name.encode()) % 10000}")
        else:
            out.append("_".join(own).upper() if form == 4 else "-".join(own).lower())
    return out


def held_out(word: str) -> bool:
    return zlib.crc32(word.lower().encode()) % HELD_OUT == 0


def labelled(text: str, held: bool) -> tuple[list[str], list[str]]:
    """(ordinary tokens, random strings) of a text.

    The ordinary ones are its long tokens and identifiers of held-out words, or of the others; random
    hexadecimal strings come in both cases, since either is usual.
    """
    at, random, rest = 0, [], []
    for start, _, stop, secret in base_spans(text):
        own = text[secret:stop]
        random += [own, own.upper()] if _HEX.fullmatch(own) else [own]
        rest.append(text[at:max(at, start)])
        at = max(at, stop)
    rest = "\n".join([*rest, text[at:]])
    return _TOKEN.findall(rest) + identifiers([w for w in _WORD.findall(rest) if held_out(w) == held]), random


def _counts(docs: DataFrame, held: bool, size: int, of: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """(random, at, n): sums of ``of`` over the ordinary and the random samples."""
    schema = pa.schema([("random", pa.bool_()), ("at", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size), np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                for k, samples in enumerate(labelled(text, held) if text else ()):
                    if samples:
                        total[k] += of(samples)
        k, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k == 1), pa.array(at.astype(np.int32)), pa.array(total[k, at])],
                                         schema=schema)

    counted = mapped(texts(docs).select("text"), run, "random boolean, at int, n long")
    return counted.groupBy("random", "at").agg(F.sum("n").alias("n"))


class Model(NamedTuple):
    """Log-likelihood ratio of each transition (random over ordinary), and the ratio a character that makes a span."""

    values: np.ndarray
    threshold: float = PER_CHAR


def count_transitions(docs: DataFrame) -> DataFrame:
    """(random, at, n): character transitions of random strings and of ordinary tokens."""
    return _counts(docs, False, _SYMBOLS * _SYMBOLS, lambda samples: _transitions("\n".join(samples).encode()))


def count_ratios(docs: DataFrame, values: np.ndarray) -> DataFrame:
    """(random, at, n): bins of the ratios that samples with held-out words have."""
    model = Model(values)

    def of(samples: list[str]) -> np.ndarray:
        found = np.array([ratio(model, t) for t in samples if len(t) >= LEAST])
        bins = np.clip(np.floor(found / BIN).astype(int) + BINS, 0, 2 * BINS - 1)
        return np.bincount(bins, minlength=2 * BINS)

    return _counts(docs, True, 2 * BINS, of)


def least_threshold(ordinary: np.ndarray, mistaken: float = MISTAKEN) -> float:
    """The least threshold that at most a share of ``mistaken`` of the binned ordinary tokens reach, from ``PER_CHAR`` upwards."""
    reach = np.r_[np.cumsum(ordinary[::-1])[::-1], 0]      # tokens in this bin and above
    return max(PER_CHAR, (int(np.argmax(reach <= mistaken * ordinary.sum())) - BINS) * BIN)


def fit(docs: DataFrame) -> Model | None:
    """The two models' ratio and its threshold; None without a labelled random string."""
    counts = np.zeros((2, _SYMBOLS, _SYMBOLS))
    for r in count_transitions(docs).collect():     # at most two rows a pair of symbols
        counts[int(r.random), r["at"] // _SYMBOLS, r["at"] % _SYMBOLS] = r.n
    if not counts[1].any():
        return None
    single = counts.sum(axis=1) + SMOOTHING / _SYMBOLS
    single /= single.sum(axis=1, keepdims=True)
    total = counts.sum(axis=2, keepdims=True)
    ordinary = (1 - BACKOFF) * (counts[0] + SMOOTHING / _SYMBOLS) / (total[0] + SMOOTHING) + BACKOFF * single[0]
    # characters of a random string hardly depend on the one before: few samples lean on single frequencies
    random = (counts[1] + INDEPENDENT * (single[1] + 1 / _SYMBOLS) / 2) / (total[1] + INDEPENDENT)
    values = np.log(random) - np.log(ordinary)
    tokens = np.zeros(2 * BINS, np.int64)
    for r in count_ratios(docs, values).filter("NOT random").collect():     # at most one row a bin
        tokens[r["at"]] = r.n
    return Model(values, least_threshold(tokens))


def ratio(model: Model, token: str) -> float:
    """Log-likelihood ratio a character."""
    code = _CODE[np.frombuffer(token.encode("ascii"), np.uint8)]
    return float(model.values[code[:-1], code[1:]].sum()) / len(token)


def find_spans(text: str | None, model: Model | None) -> list[Span]:
    spans = base_spans(text)
    if text and model is not None:
        found, i, reach = [], 0, 0      # reach: where the base spans that start before a token's end stop
        for m in _TOKEN.finditer(text):
            while i < len(spans) and spans[i][0] < m.end():
                reach = max(reach, spans[i][2])
                i += 1
            if reach <= m.start() and ratio(model, m.group()) >= model.threshold:
                found.append((m.start(), 3, m.end(), m.start()))
        spans = sorted(spans + found)
    return spans


def scan(model: Model | None, text: Column | str = "text") -> Column:
    """Column of all spans of whole texts."""

    def make() -> Callable[[list], pa.Array]:
        return lambda batch: pa.array([[{"kind": KINDS[k], "start": s, "stop": e} for s, k, e, _ in find_spans(t, model)]
                                       for t in batch], _SPANS)

    return text_column(F.col(text) if isinstance(text, str) else text, SPANS, make)


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
