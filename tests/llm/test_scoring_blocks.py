"""The outer softmax is looked at in blocks of rows that stay near the processor."""

from __future__ import annotations

import tracemalloc

import numpy as np

from tidegrid.llm import gru


def test_the_outer_softmax_of_many_rows_is_never_held_whole():
    """op5: exponentials of all rows and classes were one array, written and read again five times."""
    rng, rows = np.random.default_rng(3), 40_000
    p = gru.views(gru.initial(np.arange(gru.VOCABULARY, 0, -1), np.ones(gru.RARE)))
    h = rng.normal(0, 0.5, (rows, gru.HIDDEN)).astype(np.float32)
    target = rng.integers(0, gru.VOCABULARY + gru.RARE, rows)
    tracemalloc.start()
    found = gru.outputs(p, h, target)[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < rows * gru.OUT * 4, most
    parts = [gru.outputs(p, h[i : i + 999], target[i : i + 999])[0] for i in range(0, rows, 999)]
    assert np.allclose(found, np.concatenate(parts), rtol=1e-5)
