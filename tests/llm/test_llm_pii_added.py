"""What the span classifier adds, against planted personal data."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cartwise.llm import pii


def luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def number(rng: random.Random, passes: bool, first: str = "3456") -> str:
    while True:
        digits = rng.choice(first) + "".join(rng.choices("0123456789", k=15))
        if luhn(digits) == passes:
            return rng.choice([digits, " ".join(digits[i:i + 4] for i in range(0, 16, 4))])


def planted(rng: random.Random, n: int) -> list[tuple]:
    """(doc_id, text, kinds to add): true cards are base spans; other numbers alike are not personal; loose phones are."""
    prose = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(12))
    phone = lambda: f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    makers = [lambda: (f"{prose()} {number(rng, True)} {prose()}", []), lambda: (f"{prose()} {number(rng, False)} {prose()}", []),
              lambda: (f"{prose()} {number(rng, False, '012789')}. {prose()}", []), lambda: (f"{prose()} call {phone()} {prose()}", ["phone_like"]),
              lambda: (f"{prose()} +1 (504) 555-{rng.randint(1000, 9999)} {prose()}", []), lambda: (f"{prose()} 300.{rng.randint(256, 999)}.1.2 {prose()}", [])]
    return [(i, *makers[i % len(makers)]()) for i in range(n)]


@pytest.mark.parametrize("n", [60, 600, 3000])
def test_added_spans_on_planted_ones(spark, n):
    """Alike at every size: numbers that fail their check digit are never added, loose phone numbers are."""
    rows = planted(random.Random(n), n)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: sorted(s.kind for s in r.spans if not s.base) for r in pii.personal_spans(docs).collect()}
    right = sum(k in want for i, _, want in rows for k in got[i])
    added, wanted = sum(map(len, got.values())), sum(len(want) for *_, want in rows)
    assert not any("card_like" in kinds or "ip_like" in kinds for kinds in got.values())
    assert right >= 0.95 * wanted and right >= 0.95 * added


@pytest.mark.parametrize("sf_dir", ["sf0.01", "sf0.1"])
def test_failed_check_digits_are_no_personal_data(spark, sf_dir):
    docs = spark.read.parquet(f"/root/testdata/{sf_dir}/documents.parquet")
    kinds = {r.kind: r["count"] for r in pii.personal_spans(docs).select(F.explode("spans.kind").alias("kind")).groupBy("kind").count().collect()}
    assert kinds["card"] > 15 and kinds["ip"] > 15 and "card_like" not in kinds and "ip_like" not in kinds
