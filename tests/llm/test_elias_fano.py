import numpy as np
import pytest

from tokenloom.llm.elias_fano import EliasFano


@pytest.mark.parametrize("n,top", [(0, 1), (1, 5), (1, 0), (7, 3), (1000, 50), (1000, 10**6), (5000, 2**53), (64, 64)])
def test_access_and_successor(n, top):
    r = np.random.default_rng(n + top % 97)
    v = np.sort(r.integers(0, top + 1, n)).astype(np.uint64)
    for ef in (EliasFano(v), EliasFano.open(EliasFano(v).tobytes())[0]):
        assert (ef.access(np.arange(n)) == v).all()
        x = np.concatenate([v, v + np.uint64(1), r.integers(0, 2 * top + 2, 500).astype(np.uint64), [np.uint64(0), np.uint64(top * 3 + 9)]])
        assert (ef.successor(x) == np.searchsorted(v, x, side="left")).all()
