"""Card numbers, IBANs and bare surnames beside other numbers and words."""

from __future__ import annotations

import pytest

from tidegrid.llm.pii import pseudonymised
from tidegrid.llm.surrogates import mentions

CARD, SOLID = "4111 1111 1111 1111", "4111111111111111"


@pytest.mark.parametrize(
    ("text", "kind", "wanted"),
    [
        (f"{CARD} 12/25", "card", CARD),
        (f"{SOLID} 123 is", "card", SOLID),
        (f"order 12 {CARD}", "card", CARD),
        (f"order 12 {CARD} 123 of 2024", "card", CARD),
        (f"2024-01-31 {CARD}", "card", CARD),
        ("3782 822463 10005 1234 x", "card", "3782 822463 10005"),
        ("ES9121000418450200051332 EUR", "iban", "ES9121000418450200051332"),
        ("BE68539007547034 BIC", "iban", "BE68539007547034"),
        ("ES91 2100 0418 4502 0005 1332 EUR 100", "iban", "ES91 2100 0418 4502 0005 1332"),
        ("REF AB12 BE68 5390 0754 7034 BIC", "iban", "BE68 5390 0754 7034"),
    ],
)
def test_numbers_beside_others(text, kind, wanted):
    assert [text[a:b] for a, b, k, _ in mentions(text) if k == kind] == [wanted]


def test_two_cards_in_a_row():
    text = f"{CARD} 5500 0000 0000 0004 9"
    assert [text[a:b] for a, b, k, _ in mentions(text) if k == "card"] == [CARD, "5500 0000 0000 0004"]


def test_nothing_private_stays(spark):
    texts = [f"{CARD} 12/25", f"order 12 {CARD}", "ES9121000418450200051332 EUR", "Mr. John Smith left. Then Smith came back; SMITH's hat, smith work, Smithson.", "Smith alone"]
    out = [r["text"] for r in pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert "4111 1111" not in out[0] + out[1] and out[0].endswith(" 12/25") and out[1].startswith("order 12 ")
    assert "2100041845" not in out[2] and out[2].endswith(" EUR")
    assert "Smith " not in out[3] and "SMITH" not in out[3] and "smith work, Smithson." in out[3]
    assert out[3].split()[2].rstrip(".") == out[3].split()[5] and out[4] == "Smith alone"
