"""Scoring a few long documents beside many short ones."""

from __future__ import annotations

import numpy as np

from tidegrid.llm import gru


def test_few_long_documents_are_scored_over_wide_windows(monkeypatch):
    """op5: a document of 4000 tokens took a call for each 16 of them, as many as a thousand such documents do."""
    rng = np.random.default_rng(3)
    p = gru.views(gru.initial(np.arange(gru.VOCABULARY, 0, -1), np.ones(gru.RARE)))
    texts = [rng.integers(0, gru.VOCABULARY + gru.RARE, n) for n in (4000, 1, 3, 700, 17, 16, 257, 0, *[5] * 60)]
    calls, plain = [], gru.outputs
    monkeypatch.setattr(gru, "outputs", lambda *a: calls.append(1) or plain(*a))
    found = gru.score(p, texts, 0)
    assert len(calls) < 40
    for text, value in zip(texts, found):
        h, last, total = np.zeros((1, gru.HIDDEN), np.float32), np.array([0]), 0.0
        for token in text:
            h = gru.step(p, last, h)[0]
            last = np.array([token])
            total += float(plain(p, h, last)[0][0])
        assert abs(total - value) <= 1e-4 * max(1.0, abs(total))
