"""Personal data by weak supervision, in DataFrame operations alone.

1. Patterns find candidates with their code-point offsets and the text around
   them. Those that pass their check are the base spans (``BASE``).
2. Labelers vote on each candidate or abstain: the pattern's own check, words
   before it (a gazetteer), its grouping, the characters around it, and known
   endings, issuers and prefixes (a second gazetteer).
3. Expectation-maximisation over the counts of vote patterns (at most
   3**labelers rows a shape leave Spark) estimates how reliable each labeler is
   and how likely each pattern is personal. Candidates of one shape, whether they pass
   its check or not, are one class with one share of personal ones, so the check's vote
   tells them apart. How far a check digit or a range of numbers is to be trusted
   is arithmetic and not estimated.
4. These likelihoods are the soft labels that a naive Bayes span classifier is
   trained on, from counts of span features over all documents. Candidates that
   it takes for personal, and that touch no base span, are added as ``<kind>_like``.

Texts are read once; candidates stay with their row, so nothing is shuffled but
counts. Offsets come from a pattern's matches and the text between them. The
patterns are possessive where the fixed ones can't backtrack: same matches,
in linear time and without recursion on very long texts.

Defined results: a null text is empty. Spans are sorted by start, then by kind
as listed; per kind they don't overlap. Repeated rows are scanned as they
stand. Without any candidate there is no model and nothing is added.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import texts, written

BASE = ("email", "ip", "card", "phone")
LOOSE = ("email_like", "ip_like", "card_like", "phone_like", "id_like")
KINDS = BASE + LOOSE

# The base patterns. A run that a match could start in is entered at its beginning only (or where the
# last match ended), since every later start in it would meet the same end.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_like": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
                  r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++",
    "phone_like": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "id_like": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
_NEEDS = {"email": "@", "phone": "+", "email_like": "at"}     # a text without it has no match
_PUBLIC = "0*(?!127\\.)(?:[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])"     # first parts of addresses of hosts
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# What the gazetteers know.
PERSONAL_WORDS = ("phone tel telephone call mobile cell fax mail email e-mail contact reach card visa mastercard amex "
                  "account iban ssn ip host address from whatsapp sms").split()
OTHER_WORDS = ("version release total page pages figure fig table line isbn issn order invoice serial section chapter "
               "price year rfc build model part lot").split()
ENDINGS = "com org net edu gov info io de fr es uk it eu".split()
PREFIXES = "1 7 30 31 32 33 34 39 41 43 44 45 46 47 48 49 52 55 61 81 86 91".split()

#: Matches whose offsets are summed up one by one; see ``matches``.
BLOCK = 128
#: Characters around a candidate that labelers see.
AROUND = 32
#: Rounds of expectation-maximisation; likelihood from which a candidate is personal.
ROUNDS, LIKELY = 50, 0.5

#: What a check's vote says where arithmetic settles it: true ones always pass, other numbers in one of ten (Luhn) or,
#: of addresses, about half. Log-odds for + and for -.
CERTAIN = {"card": {"+": math.log(0.999 / 0.1), "-": math.log(0.001 / 0.9)},
           "ip": {"+": math.log(0.999 / 0.5), "-": math.log(0.001 / 0.5)}}

LABELERS = ("check", "words", "grouping", "around", "known")


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, stop, hit, before, after>> of a pattern's matches, leftmost, not overlapping.

    A start is the length of all that comes before. Running sums are made in
    blocks of ``BLOCK`` matches, then over the blocks, so that a text of very
    many matches costs no square of them.
    """
    hits, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.zip_with(hits, between, lambda h, b: F.struct(
        h.alias("hit"), F.length(b).alias("gap"), F.substring(b, -AROUND, AROUND).alias("before")))
    # the text after the last match is one more than there are matches
    after = F.transform(F.slice(between, F.lit(2), F.greatest(F.size(between) - 1, F.lit(0))),
                        lambda b: F.substring(b, 1, AROUND))
    whole = F.zip_with(F.filter(pairs, lambda p: p["hit"].isNotNull()), after, lambda p, a: F.struct(
        p["hit"].alias("hit"), p["gap"].alias("gap"), p["before"].alias("before"), a.alias("after")))
    blocks = F.transform(F.sequence(F.lit(0), (F.size(whole) - 1).cast("int"), F.lit(1)),
                         lambda i: F.when(i % BLOCK == 0, F.slice(whole, i + 1, F.lit(BLOCK))))
    spans = "array<struct<start:int,stop:int,hit:string,before:string,after:string>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        stop = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), stop.alias("stop"), x["hit"].alias("hit"), x["before"].alias("before"),
                        x["after"].alias("after"))
        return F.struct(stop.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("spans"))
    local = F.transform(F.filter(blocks, lambda b: b.isNotNull()), lambda b: F.aggregate(b, empty, step))

    def shift(acc: Column, block: Column) -> Column:
        moved = F.transform(block["spans"], lambda s: F.struct(
            (s["start"] + acc["at"]).alias("start"), (s["stop"] + acc["at"]).alias("stop"), s["hit"].alias("hit"),
            s["before"].alias("before"), s["after"].alias("after")))
        return F.struct((acc["at"] + block["at"]).alias("at"),
                        F.concat(acc["blocks"], F.array(moved)).alias("blocks"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{spans}>").alias("blocks"))
    return F.when(F.size(hits) > 0, F.flatten(F.aggregate(local, start, shift)["blocks"])).otherwise(
        F.array().cast(spans))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _passes(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return n.between(12, 19) & F.when(n.between(12, 19), F.call_function("luhn_check", _digits(hit))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(kind == "email")


def _one_of(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit("+")).when(no, F.lit("-")).otherwise(F.lit("0"))


def _votes(kind: str, m: Column, passes: Column) -> Column:
    """A character per labeler: + personal, - not, 0 abstains."""
    hit, before, after = m["hit"], F.lower(m["before"]), m["after"]
    near = r"[^\p{L}0-9]{0,3}(?:[\p{L}]+[^\p{L}0-9]{1,3})?$"
    check = _vote(passes, ~passes) if kind in BASE else F.lit("0")
    words = _vote(before.rlike(r"(?<!\p{L})" + _one_of(PERSONAL_WORDS) + near),
                  before.rlike(r"(?<!\p{L})" + _one_of(OTHER_WORDS) + near))
    shape = {"card": r"^(?:[0-9]{16}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$",
             "phone": r"^\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}", "ip": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$",
             "phone_like": r"^\([0-9]{3}\)|^[0-9]{3}-[0-9]{3}-", "id_like": "^(?!000|666|9)[0-9]{3}-(?!00)"}.get(kind)
    grouping = _vote(hit.rlike(shape), ~hit.rlike(shape)) if shape else F.lit("0")
    around = _vote(before.rlike(r"(?:^|[\p{L}\p{P}]\s*)$") & after.rlike(r"^(?:$|\s*[\p{L}\p{P}|])"),
                   before.rlike(r"[0-9]\s*[.,;|]?\s*$") | after.rlike(r"^\s*[.,;|]?\s*[0-9]"))
    known = {"email": (r"\." + _one_of(ENDINGS) + "$", r"\.[0-9-]+$"), "ip": (rf"^{_PUBLIC}\.", rf"^(?!{_PUBLIC}\.)"),
             "card": ("^[3-6]", "^[^3-6]"), "phone": (r"^\+" + _one_of(PREFIXES), r"^\+0"),
             "email_like": (_one_of(ENDINGS) + "$", "[0-9]$"), "phone_like": (r"^\(?[2-9]", r"^\(?[01]")}.get(kind)
    gazetteer = _vote(hit.rlike(known[0]), hit.rlike(known[1])) if known else F.lit("0")
    return F.concat(check, words, grouping, around, gazetteer)


def _features(kind: str, m: Column, passes: Column) -> Column:
    """What the span classifier sees: one "name=value" per feature."""
    hit, before, after = m["hit"], m["before"], m["after"]

    def sort_of(c: Column) -> Column:
        return (F.when(c == "", "end").when(c.rlike(r"\p{L}"), "letter").when(c.rlike("[0-9]"), "digit")
                .when(c.rlike(r"\s"), "space").otherwise("mark"))

    return F.array(F.lit(f"kind={kind}"), F.concat(F.lit(f"check {kind}="), passes.cast("string")),
                   F.concat(F.lit("digits="), F.least(F.length(_digits(hit)), F.lit(20)).cast("string")),
                   F.concat(F.lit("marks="), F.least(F.length(F.regexp_replace(hit, r"[\p{L}0-9]", "")), F.lit(6)).cast("string")),
                   F.concat(F.lit("before="), sort_of(F.substring(before, -1, 1))),
                   F.concat(F.lit("after="), sort_of(F.substring(after, 1, 1))),
                   F.concat(F.lit("word="), F.when(F.lower(before).rlike(_one_of(PERSONAL_WORDS) + r"\W*$"), "yes").otherwise("no")))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row; spans: array<struct<start, stop, kind, shape, base, votes, features>>."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = texts(docs).select("doc_id", text.alias("text")).withColumn("has_digit", F.col("text").rlike("[0-9]"))
    found = []
    for kind, pattern in PATTERNS.items():
        may = F.col("has_digit") if kind not in _NEEDS else F.col("text").contains(_NEEDS[kind])
        if kind == "email_like":
            may = F.col("text").rlike(r"[\[(]at[\])]")
        rows = rows.withColumn(kind, F.when(may, matches(F.col("text"), pattern)))

        def described(m: Column, kind: str = kind) -> Column:
            passes = _passes(kind, m["hit"])
            named = F.when(passes, F.lit(kind)).otherwise(F.lit(f"{kind}_like")) if kind in BASE else F.lit(kind)
            return F.struct(m["start"].alias("start"), m["stop"].alias("stop"), named.alias("kind"),
                            F.lit(kind).alias("shape"), passes.alias("base"), _votes(kind, m, passes).alias("votes"),
                            _features(kind, m, passes).alias("features"))

        # two digits are a match of the card pattern: only what could be a number of its kind is a candidate
        usable = {"card": lambda m: F.length(_digits(m["hit"])).between(12, 19),
                  "phone": lambda m: F.length(_digits(m["hit"])).between(7, 15)}.get(kind)
        own = F.filter(F.col(kind), usable) if usable else F.col(kind)
        found.append(F.coalesce(F.transform(own, _one_argument(described)), F.array().cast(
            "array<struct<start:int,stop:int,kind:string,shape:string,base:boolean,votes:string,features:array<string>>>")))
    return rows.select("doc_id", F.concat(*found).alias("spans"))


def _one_argument(f: Callable) -> Callable[[Column], Column]:
    return lambda m: f(m)


def reliabilities(counts: dict[tuple[str, str], int], rounds: int = ROUNDS):
    """EM over (shape, votes) counts: likelihood of each pattern, and each labeler's reliability.

    A labeler that votes is right with a probability of its own, but for the checks in
    ``CERTAIN``; a shape has its own share of personal spans.
    """

    def vote(i: int, kind: str, v: str) -> float:
        if v == "0":
            return 0.0
        if i == 0 and kind in CERTAIN:
            return CERTAIN[kind][v]
        return math.log(right[i] / (1 - right[i])) * (1 if v == "+" else -1)

    right = [0.8] * len(LABELERS)
    share = {kind: 0.5 for kind, _ in counts}
    likely: dict[tuple[str, str], float] = {}
    for _ in range(rounds):
        for (kind, votes) in counts:
            odds = math.log(share[kind] / (1 - share[kind])) + sum(vote(i, kind, v) for i, v in enumerate(votes))
            likely[kind, votes] = 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))
        for i in range(len(LABELERS)):
            voted = [(n, likely[k, votes] if votes[i] == "+" else 1 - likely[k, votes]) for (k, votes), n in counts.items()
                     if votes[i] != "0" and not (i == 0 and k in CERTAIN)]
            agree, total = sum(n * p for n, p in voted), sum(n for n, _ in voted)
            right[i] = min(0.99, max(0.5, (agree + 8) / (total + 10)))      # no worse than chance, never certain
        for kind in share:
            n = sum(c for (k, _), c in counts.items() if k == kind)
            share[kind] = (sum(c * likely[k, v] for (k, v), c in counts.items() if k == kind) + 1) / (n + 2)
    return likely, dict(zip(LABELERS, right, strict=True))


def _lookup(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv])


def train(found: DataFrame) -> dict[str, float] | None:
    """Log-odds of each feature value, and under "" of a personal span at all."""
    spans = found.select(F.explode("spans").alias("s")).select("s.*")
    counts = {(r.shape, r.votes): r.n for r in spans.groupBy("shape", "votes").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    likely, _ = reliabilities(counts)
    soft = _lookup({f"{kind} {votes}": p for (kind, votes), p in likely.items()})
    named = spans.withColumn("p", soft[F.concat_ws(" ", "shape", "votes")])
    table = (named.select("p", F.explode(F.concat("features", F.array(F.lit("")))).alias("feature"))
             .groupBy("feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect())
    total = {r.feature: (r.yes + 1, r.no + 1) for r in table}
    yes, no = total[""]
    return {f: math.log(a / b) - (math.log(yes / no) if f else 0.0) for f, (a, b) in total.items()}


def personal_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row; spans: sorted array<struct<start, stop, kind, base, likelihood>>."""
    found = written(candidates(docs), "pii_candidates")
    model = train(found)
    if model is None:
        odds = lambda s: F.lit(0.0)
    else:
        table = _lookup(model)

        def odds(s: Column) -> Column:
            return F.lit(model[""]) + F.aggregate(s["features"], F.lit(0.0), lambda t, f: t + F.coalesce(table[f], F.lit(0.0)))

    scored = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.lit(list(KINDS)), s["kind"]).alias("order"), s["stop"].alias("stop"),
        s["kind"].alias("kind"), s["base"].alias("base"), (1 / (1 + F.exp(-odds(s)))).alias("likelihood")))
    rows = found.select("doc_id", scored.alias("scored"))
    base = F.filter("scored", lambda s: s["base"])
    rows = rows.withColumn("base", base)
    added = F.filter("scored", lambda s: ~s["base"] & (s["likelihood"] >= LIKELY) & ~F.exists(
        F.col("base"), lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    return rows.select("doc_id", F.array_sort(F.concat("base", added)).alias("spans"))
