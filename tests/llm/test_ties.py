"""Blocks in which every row ties."""

import tracemalloc

import numpy as np

from milepost.llm import multi_index


def test_ties_need_bounded_memory():
    queries, rows = np.ones((512, 64)), np.ones((2048, 64))
    tracemalloc.start()
    q, r, exact, ids = multi_index.best_of(queries, np.arange(5000, 5512), rows, np.arange(2048)[::-1], 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids[r].tolist() == [0, 1, 2, 3, 4] * 512 and np.allclose(exact, 1)
    assert peak < 300 << 20
