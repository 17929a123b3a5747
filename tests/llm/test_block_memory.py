"""Memory that a block of sets and a worker between two tasks take."""

import tracemalloc

import numpy as np
import pyarrow as pa

from lociflow.llm import common, jaccard


def test_intersections_of_a_block_take_little_more_than_its_sets():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 6000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(6000) < 0.5], rng.integers(0, 2**63, 3000, dtype=np.uint64)])) for _ in range(400)]
    a, b = sets[:200], sets[200:]
    tracemalloc.start()
    got = jaccard._common(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * sum(s.nbytes for s in sets)
    for i, j in ((0, 0), (7, 130), (199, 199), (120, 3)):
        assert got[i, j] == len(np.intersect1d(a[i], b[j]))
    assert not jaccard._common([base[:0], base[:1]], [base[:0]]).any()


def test_a_worker_gives_back_what_arrow_holds(monkeypatch):
    freed = []

    class Pool:
        def release_unused(self):
            freed.append(True)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batch = pa.record_batch([pa.array([1])], ["x"])
    assert list(common.freed(lambda batches: (b for b in batches))(iter([batch]))) == [batch]
    assert freed == [True]
