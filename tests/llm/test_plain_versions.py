"""Language mixtures, personal data and random tokens against versions that share no code with the operators."""

from __future__ import annotations

import ipaddress
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidegrid.llm import language_id
from tidegrid.llm.language_id import languages
from tidegrid.llm.pii import pseudonymised
from tidegrid.llm.secret_scan import secrets
from tidegrid.llm.surrogates import mentions, splice, surrogate

SF_DIR = "/root/testdata/sf0.001"


def _grams(text):
    """The trigrams of each word of letters, blanks around it."""
    out = []
    for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text.lower())):
        w = f" {word} "
        out.append([w[i : i + 3] for i in range(len(w) - 2)])
    return out


def _slot(gram):
    h = sum(ord(c) * m for c, m in zip(gram, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))) % 2**32
    return ((h ^ (h >> 15)) * 0x85EBCA77) % 2**32 >> 16


def _plain_mixture(words, logs, allowed):
    """Expectation and maximisation word by word."""
    share = [1 / len(allowed) if k in allowed else 0.0 for k in range(len(logs[0]))]
    likelihoods = [[sum(logs[_slot(g)][k] for g in w) for k in range(len(share))] for w in words]
    tops = [max(x) for x in likelihoods]
    likelihoods = [[math.exp(v - t) for v in x] for x, t in zip(likelihoods, tops)]
    for _ in range(language_id.ROUNDS):
        new = [0.0] * len(share)
        for x in likelihoods:
            parts = [a * b for a, b in zip(x, share)]
            total = max(sum(parts), 1e-300)
            new = [n + p / total for n, p in zip(new, parts)]
        new = [n / len(words) for n in new]
        moved = max(abs(a - b) for a, b in zip(new, share))
        share = new
        if moved < 1e-3:
            break
    return share, sum(math.log(max(sum(a * b for a, b in zip(x, share)), 1e-300)) + t for x, t in zip(likelihoods, tops))


@pytest.fixture(scope="module")
def learned(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts = defaultdict(Counter)
    for r in rows:
        if r["text"] and r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1:
            counts[r["lang"]].update(_slot(g) for w in _grams(r["text"]) for g in w)
    names = sorted(counts)
    total = {x: sum(counts[x].values()) + 65536 * language_id.ALPHA for x in names}
    logs = [[math.log((counts[x][i] + language_id.ALPHA) / total[x]) for x in names] for i in range(65536)]
    return rows, names, logs


def test_learned_probabilities_are_plain_counts(spark, learned):
    rows, names, logs = learned
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1")
    found, table = language_id.learn(docs.select("text", "lang"))
    assert found == names and np.allclose(table, np.array(logs), atol=1e-4)


def test_mixtures_and_sets_equal_plain_em(learned):
    rows, names, logs = learned
    texts = [r["text"] for r in rows if r["text"] and _grams(r["text"])][:40]
    by = {x: next(r["text"] for r in rows if r["lang"] == x and len(r["text"] or "") > 300) for x in names}
    texts += [by[a][:200] + " " + by[b][:n] for a in names for b in names if a != b for n in (60, 200)] + ["word", "a b c", "ßüö " * 3]
    table, several = np.array(logs, np.float32), 0
    for text in texts:
        at, share, chosen = language_id.mixtures(*language_id._trigrams([text]), table)
        words = _grams(text)
        wanted, _ = _plain_mixture(words, logs, range(len(names)))
        assert np.allclose(share[0], wanted, atol=2e-3), text[:50]
        order = sorted(range(len(names)), key=lambda k: -wanted[k])
        penalty = 0.5 * math.log(max(len(words), 2))
        values = [_plain_mixture(words, logs, order[: k + 1])[1] - k * penalty for k in range(len(names))]
        picked = {k for k in range(len(names)) if chosen[0][k] > 0}
        # sets of equal value up to rounding are equally right
        assert values[len(picked) - 1] >= max(values) - 1e-2 and picked <= set(order[: len(picked)]), text[:50]
        several += len(picked) > 1
    assert several >= 10


def test_predictions_follow_from_the_text_by_plain_em(spark, learned):
    rows, names, logs = learned
    found = {r["doc_id"]: r for r in languages(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()}
    for r in rows[:60]:
        words = _grams(r["text"] or "")
        if not words:
            assert found[r["doc_id"]]["lang_pred"] == "und"
            continue
        share, _ = _plain_mixture(words, logs, range(len(names)))
        best = found[r["doc_id"]]["lang_pred"]
        # all texts of a block go through as many rounds as the slowest
        assert share[names.index(best)] >= max(share) - 0.02 and abs(found[r["doc_id"]]["score"] - share[names.index(best)]) < 0.05


def _luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def _plain_entities(text):
    """E-mail addresses, cards, social-security numbers and IPv4 addresses, by splitting at blanks and trimming signs."""
    out = set()
    for token in re.split(r"[\s,;()<>\"']+", text):
        token = token.strip(".:!?")
        local, _, domain = token.partition("@")
        if local and "." in domain and re.fullmatch(r"[A-Za-z0-9._%+-]+", local) and re.fullmatch(r"[A-Za-z0-9.-]+\.[A-Za-z]{2,24}", domain):
            out.add(("email", token))
        if re.fullmatch(r"\d{3}-\d{2}-\d{4}", token):
            out.add(("ssn", token))
        if token.count(".") == 3 and all(x.isdigit() and len(x) <= 3 and int(x) < 256 for x in token.split(".")):
            out.add(("ip", token))
        if re.fullmatch(r"\d{4}-\d{4}-\d{4}-\d{4}|\d{16}", token) and _luhn(token.replace("-", "")):
            out.add(("card", token))
    return out


def test_entities_of_the_tables_are_replaced_one_by_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = {r["doc_id"]: r["text"] for r in pseudonymised(docs).collect()}
    known, new, n = set(), set(), Counter()
    for i, text in before.items():
        mine = _plain_entities(text or "")
        known |= mine
        n.update(k for k, _ in mine)
        assert not mine & _plain_entities(after[i] or ""), i
        # as many of each kind, of equal format
        shape = lambda found: Counter((k, re.sub(r"\d", "0", v) if k in ("card", "ssn") else "") for k, v in found)
        new |= _plain_entities(after[i] or "")
        assert shape(mine) == shape(_plain_entities(after[i] or "")), i
    assert n["email"] > 5 and not known & new and Counter(k for k, _ in known) == Counter(k for k, _ in new)


@pytest.mark.parametrize(("text", "wanted"), [
    ("Ask Wei Zhang or Priya Patel.", ["Wei", "Zhang", "Priya", "Patel"]),
    ("Call 030/1234567, (089) 123456-78 or 0151-23456789.", ["030/1234567", "(089) 123456-78", "0151-23456789"]),
    ("From 2001:DB8:85a3::8a2e:370:7334 to fd12:3456::1, not ::1, a::b or 12:30:45.", ["2001:DB8:85a3::8a2e:370:7334", "fd12:3456::1"]),
    ("Արամ Պետրոսյան", ["Արամ", "Պետրոսյան"]),
    ("Mr 山田太郎, שרה כהן", ["山田太郎", "שרה"]),
    ("On 1999-12-31, 01/02/2003, 2020/12, part 0123-4567 at 12:30", []),
])
def test_numbers_and_names_of_other_lands(text, wanted):
    found = mentions(text)
    assert [text[a:b] for a, b, _, _ in found] == wanted
    out = splice(text, ((a, b, k, surrogate(b"key", k, v, 0)) for a, b, k, v in found))
    again = mentions(out)
    assert [k for _, _, k, _ in again if k in ("phone", "ipv6")] == [k for _, _, k, _ in found if k in ("phone", "ipv6")]
    for (a, b, kind, _), (c, d, _, _) in zip(found, again):
        old, new = text[a:b], out[c:d]
        assert old != new
        if kind == "phone":
            assert re.sub(r"\d", "0", old) == re.sub(r"\d", "0", new) and new.lstrip("(")[0] == "0"
        if kind == "ipv6":
            assert ipaddress.IPv6Address(new).is_private and any(map(str.isupper, old)) == new.isupper() and old.count(":") == new.count(":")


def test_surrogates_are_of_the_script_of_the_name():
    for name, letters in (("Պետրոսյան", "Ա-և"), ("גולדברג", "א-ת"), ("חוסיין", "א-ת"), ("محمود", "ء-ي"), ("王小明", "一-龥"), ("გელაშვილი", "ა-ჺ"), ("김철수", "가-힣"), ("Петров", "А-я"), ("สมชาย", "ก-ฮ")):
        for attempt in range(12):
            kind = mentions(f"Dr {name}")[0][2]
            assert re.fullmatch(f"[{letters}]+(-[{letters}]+)*", surrogate(b"key", kind, name, attempt), re.IGNORECASE), (name, attempt)


def _upper_tail(z):
    """A bound from above of a normal variable's chance to exceed z."""
    return 1.0 if z <= 0 else 4 * math.exp(-min(700, z * z / 2)) / math.sqrt(2 * math.pi) / (3 * z + math.sqrt(z * z + 8))


def _plain_battery(token):
    """Chance under even draws, and how unlike text the token is: sums over characters and pairs, straight from the definitions."""
    body = token.rstrip("=")
    if len(body) < 16:
        return None
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    orders = [[digits + "abcdef", digits + "ABCDEF"], [lower, upper], [lower + "234567", upper + "234567"], [digits + lower, digits + upper]]
    orders += [[upper + lower], [upper + lower + digits], [upper + lower + digits + "+/", upper + lower + digits + "-_"]]
    order = next((o for several in orders for o in several if set(body) <= set(o)), None)
    n = len(body)
    if order is None:  # both of the last alphabet's spellings in one token
        order = upper + lower + digits + "+/"
        places = [order.find({"-": "+", "_": "/"}.get(c, c)) for c in body]
    else:
        places = [order.index(c) for c in body]
    k = len(order)
    squares = sum(v * v for v in Counter(body).values())
    chi = (k * squares / n - n - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    high = [2 * p >= k for p in places]
    one, two = sum(high), n - sum(high)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    spread = 2 * one * two * (2 * one * two - n) / (n * n * (n - 1))
    mean = sum(places) / n
    around = sum((p - mean) ** 2 for p in places)
    if spread <= 0 or not around:
        chance = 0.0
    else:
        z_runs = (runs - 1 - 2 * one * two / n) / math.sqrt(spread)
        z_serial = (sum((a - mean) * (b - mean) for a, b in zip(places, places[1:])) / around + 1 / n) * math.sqrt(n)
        chance = min(1.0, 3 * min(_upper_tail(chi), 2 * _upper_tail(abs(z_runs)), 2 * _upper_tail(abs(z_serial))))
    same, three, change = 0.066, 0.0056, 0.08
    text = (n + n * (n - 1) * same - squares) / math.sqrt(4 * n * (n - 1) * (n - 2) * (three - same**2) + 2 * n * (n - 1) * same)
    kind = ["a" if c in lower else "A" if c in upper else "0" if c in digits else c for c in body]
    changes = (sum(a != b for a, b in zip(kind, kind[1:])) - (n - 1) * change) / math.sqrt((n - 1) * change * (1 - change))
    return chance, (text + changes) / math.sqrt(2)


def test_random_spans_equal_a_plain_battery_and_discovery_control(spark):
    import random
    import string

    draw, texts = random.Random(12), []
    alphabets = [string.hexdigits[:16], string.ascii_letters, string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_lowercase + "234567", string.ascii_lowercase]
    for i in range(500):
        n = draw.choice([20, 24, 33, 47, 64, 90])
        token = "".join(draw.choices(draw.choice(alphabets), k=n)) if i % 2 else "".join(draw.choices(["the", "and", "Under", "standing", "-", "_", "over", "2024", "/"], k=n // 4))
        texts.append(f"see {token} and {'x' * draw.randint(0, 3)} {token[::-1]}== there")
    found = {r["doc_id"]: r["spans"] for r in secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    tokens = []
    for i, text in enumerate(texts):
        taken = [m.span() for m in re.finditer("[0-9a-f]{32,}|AKIA[A-Z0-9]{12,}", text)]
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
            if not any(a < m.end() and m.start() < b for a, b in taken) and (scored := _plain_battery(m[0])):
                tokens.append((i, *m.span(), *scored))
    chosen = set()
    for length in range(4, 24):
        group = [(a, s, e, -200 if p < 0.003 else math.floor(max(-20, min(100, z)) * 10)) for a, s, e, p, z in tokens if int(math.log2(e - s)) == length]
        steps = sorted({g[3] for g in group})
        fits = [x for x in steps if _upper_tail(x / 10) <= 0.01 * sum(g[3] >= x for g in group) / len(group)]
        chosen |= {(a, s, e) for a, s, e, x in group if fits and x >= min(fits)}
    shown = {(i, int(s), int(e)) for i, spans in found.items() for kind, s, e in (x.split(":") for x in spans.split(",") if x) if kind == "random"}
    assert len(chosen) > 100 and shown == chosen
