"""Spelling variants, resampling and quality against plain versions."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidegrid.llm.automaton import Automaton, coded
from tidegrid.llm.quality import qualities, statistics
from tidegrid.llm.resampling import Tournament, resampled
from tidegrid.llm.trees import fit
from tidegrid.llm.variants import counted, spelling_variants, variants

SF_DIR = "/root/testdata/sf0.001"


def _plain_variants(counts: dict[str, int], ratio: int) -> dict[str, tuple]:
    letters = sorted(set("".join(counts)))
    near = {}
    for w in counts:
        cut = [w[:i] + w[i + 1 :] for i in range(len(w))]
        put = [w[:i] + x + w[i + k :] for i in range(len(w) + 1) for x in letters for k in (0, 1)]
        near[w] = {x for x in (*cut, *put) if x in counts and x != w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def root(w: str) -> str:
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


@pytest.mark.parametrize(("group", "chunk"), [(4000, 32768), (5, 50), (2, 10)])
def test_variants_equal_brute_force(spark, group, chunk):
    random.seed(group)
    few = lambda: random.choice("ab" if random.random() < 0.9 else "abcdéÿ")
    counts = {"".join(few() for _ in range(random.randint(7, 11))): int(10 ** random.uniform(0.31, 5)) for _ in range(1500)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants(words, 10, group, chunk).collect()}
    assert found == _plain_variants(counts, 10)


def test_words_beyond_latin_and_of_any_length(spark):
    counts = {"λόγος": 100, "λόγοσ": 3, "😀😀a": 50, "😀a": 2, "ab": 7, "a" * 3000: 40, "a" * 2999: 2}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r["word"]: r["form"] for r in variants(words).collect()}
    assert found == {w: p[0] for w, p in _plain_variants(counts, 10).items()}


def test_counted_words_lose_characters_as_stated(spark):
    texts = [(1, "Alphabet ALPHABET alphabé×t, short 1234567 Ünderway x_underway_y"), (2, None), (None, "alphabet"), (3, ""), (3, "alphabet " * 40)]
    for i in range(4, 150):
        texts.append((i, "gathering wanderers gathering"))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, n long, word string")
    wanted: Counter = Counter()
    for i, t in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            wanted[w] += len(w) >= 7
    assert {r["word"]: r["n"] for r in counted(docs, drop=31).collect()} == {w: n for w, n in wanted.items() if n >= 2}


@pytest.mark.parametrize("rows", [0, 1, 300])
def test_automaton_is_minimal_and_numbers_rows(rows):
    random.seed(rows)
    words = sorted({"".join(random.choice("abc") for _ in range(random.randint(1, 6))) for _ in range(rows)})
    labels, size = coded(words, np.ones(len(words), np.int64))
    machine = Automaton(labels, size)
    # states are the distinct sets of ends that words can have
    ends = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in {w[:i] for w in words for i in range(len(w) + 1)}}
    assert len(machine.final) == len(ends) + 1
    state, number = np.full(len(words), machine.root), np.zeros(len(words), np.int64)
    for i in range(labels.shape[1] if rows else 0):
        on = np.flatnonzero(size > i)
        at, there = machine.edge(state[on], labels[on, i].astype(np.int64))
        assert there.all()
        state[on], number[on] = machine.target[at], number[on] + machine.skip[at]
    assert machine.final[state].all() and (number == np.arange(len(words))).all()


def test_tournament_merges_runs():
    random.seed(5)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((random.randrange(20), i) for i in range(random.randrange(9))) for _ in range(k)]
        assert list(Tournament([iter(r) for r in runs])) == list(heapq.merge(*runs))


@pytest.mark.parametrize("size", [200_000, 5])
@pytest.mark.parametrize("grams", [1, 2])
def test_resampled_equals_plain_version(spark, size, grams):
    random.seed(9)
    words = ["ab", "cd", "éf", "G7", "x", "yy", "Zz"]
    rows = [(i, " ".join(random.choices(words, weights=range(1, 8), k=random.randint(0, 40)))) for i in range(300)]
    rows += [(7, None), (None, "ab " * 30), (None, "cd " * 30), (8, ""), *[(500, "ab cd " * 20)] * 40]
    target = [(1, "éf ab éf"), (2, None), (3, "x_yy")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, row long, score long").repartition(7)
    found = resampled(docs, spark.createDataFrame(target, "item_id long, text string"), grams=grams, buckets=50, size=size).collect()

    def runs(text):
        w = [x for x in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        return w, [" ".join(w[i : i + n]) for n in range(1, grams + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 50
    s, t = (Counter(bucket(f) for _, x in table for f in runs(x)[1]) for table in (rows, target))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 50) / ((s[b] + 1) * (t.total() + 50)))) for b in range(50)}
    wanted = []
    for i, text in rows:
        w, f = runs(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        wanted.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= 20))
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in found) == Counter(x[:4] for x in wanted)
    order = sorted((x for x in wanted if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == [*range(1, len(order) * 10 // 100 + 1)]
    assert [(r["doc_id"], r["score"]) for r in drawn] == [(x[0], x[3]) for x in order[: len(drawn)]]


def test_trees_equal_row_by_row_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(np.int64)
    model = fit(x, y, np.ones(800), trees=30, depth=3)

    def walk(row):
        total = model.base
        for feature, limit, value in zip(model.feature, model.limit, model.value):
            at = 0
            while at < len(feature):
                at = 2 * at + (2 if row[feature[at]] > limit[at] else 1)
            total += value[at - len(feature)]
        return total

    assert np.allclose(model.logits(x), [walk(row) for row in x])
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.97
    # the first tree's first split is the best of all splits there are
    p = 1 / (1 + np.exp(-model.base))
    g, h = p - y, np.full(800, p * (1 - p))
    part = lambda m: g[m].sum() ** 2 / (h[m].sum() + 2.0)
    limits = [(part(x[:, f] <= c) + part(x[:, f] > c), f) for f in range(5) for c in np.quantile(x[:, f], np.arange(1, 64) / 64, method="lower")]
    assert model.feature[0, 0] == max(limits)[1]
    assert fit(x[:0], y[:0], np.ones(0)).scores(x[:2]).tolist() == [0.5, 0.5]
    assert len(fit(x, np.ones(800), np.ones(800)).value) == 0


def test_quality_of_rows_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = qualities(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert len(held) > 50 and sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_on_a_sample_of_rows_does_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    a, b = ({r["doc_id"]: r["score"] for r in qualities(docs.repartition(n), labels, sample=40).collect()} for n in (1, 9))
    assert a == b


def test_quality_of_awkward_rows(spark):
    docs = spark.createDataFrame([(1, "good words here"), (1, "good words here"), (2, "BAD!! BAD!!"), (None, "BAD!! BAD!!"), (3, None), (4, ""), (5, "a" * 90_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (2, 0, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, f int")
    found = qualities(docs, labels).collect()
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(found) == 7 and all(len(s) == 1 for s in by.values()) and by[2] == by[None] and by[3] == by[4]
    assert {r["score"] for r in qualities(docs, labels.limit(0)).collect()} == {0.5}
    assert qualities(docs.limit(0), labels).count() == 0
    assert len({len(statistics(t)) for t in (None, "", " ", "a", "\n", "a b\n\nc😀", "x " * 5000)}) == 1


def test_variants_of_empty_and_null_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "short words 123")], "doc_id long, text string")
    assert spelling_variants(docs).count() == 0 and spelling_variants(docs.limit(0)).count() == 0
