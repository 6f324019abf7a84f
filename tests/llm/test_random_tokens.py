"""Tokens drawn evenly from each alphabet are found at every length."""

from __future__ import annotations

import random
import string
from collections import Counter

import pytest

from tidegrid.llm.secret_scan import LOST, _battery, secrets

LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
ALPHABETS = {
    "hex": DIGITS + "abcdef", "base32": UPPER + "234567", "lower base32": LOWER + "234567", "base36": LOWER + DIGITS, "upper base36": UPPER + DIGITS,
    "base62": LOWER + UPPER + DIGITS, "base64": LOWER + UPPER + DIGITS + "+/", "letters": LOWER + UPPER,
}
LENGTHS = (24, 32, 40, 52, 64)


def _tokens(n):
    draw = random.Random(17)
    return [(name, k, "".join(draw.choices(chars, k=k))) for name, chars in ALPHABETS.items() for k in LENGTHS for _ in range(n)]


def test_random_tokens_pass_the_battery(spark):
    rows = spark.createDataFrame(_tokens(200), "name string, length int, token string")
    passed = Counter((r["name"], r["length"]) for r in _battery(rows).where(f"p_random >= {LOST}").collect())
    assert {key: n for key in ((a, k) for a in ALPHABETS for k in LENGTHS) if (n := passed[key]) < 190} == {}


@pytest.mark.parametrize("name", ["lower base32", "base36", "upper base36", "letters"])
def test_planted_tokens_are_discovered(spark, name):
    prose = "the boat went out at dawn with seven people and came home late in the day " * 3
    planted = [(i, f"{prose} {token} {prose}") for i, (a, _, token) in enumerate(_tokens(20)) if a == name]
    plain = [(-i, f"{prose} an-ordinary-name-of-a-page {'internationalisation' * (1 + i % 2)} {prose}") for i in range(1, 101)]
    found = {r["doc_id"]: r["spans"] for r in secrets(spark.createDataFrame(planted + plain, "doc_id long, text string")).collect()}
    start = len(prose) + 1
    hits = sum(f"random:{start}:{start + len(text) - 2 * len(prose) - 2}" in found[i] for i, text in planted)
    assert hits >= 0.9 * len(planted)
    assert sum("random" in found[i] for i, _ in plain) <= 1
