import numpy as np
import pytest

from vigil.llm import diffcover as D


@pytest.mark.parametrize("seed", range(40))
def test_order_of_planted_repeats(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(97, 97 + rng.integers(1, 4), 600).astype(np.uint8)
    pieces = []
    for _ in range(rng.integers(1, 30)):
        r = int(rng.integers(0, 140))
        a = int(rng.integers(0, 600 - 200 - r))
        c = base[a:a + 200 + r].copy()
        for _ in range(rng.integers(0, 3)):
            c[rng.integers(len(c))] = rng.integers(97, 100)
        pieces.append(c)
    data = np.concatenate(pieces)
    beyond = np.concatenate([np.arange(len(c)) - (len(c) - 200) for c in pieces])
    order, grams = D.order(data, beyond)
    assert sorted(order) == list(np.flatnonzero(beyond <= 0))
    prefixes = [data[p:p + 200].tobytes() for p in order]
    assert prefixes == sorted(prefixes)
    same = D.same_prefix(grams, order[1:], order[:-1], 200)
    assert same.tolist() == [a == b for a, b in zip(prefixes, prefixes[1:])]


def test_whole_suffix_array():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 900).astype(np.uint8)
    order, _ = D.order(data, np.full(len(data), -1000))
    suffixes = [data[p:p + D.DEPTH - 16].tobytes() for p in order]
    assert sorted(order) == list(range(len(data))) and suffixes == sorted(suffixes)


def test_names_of_many_large_ranks():
    rng = np.random.default_rng(2)
    keys = [rng.integers(0, 1 << 30, 500) for _ in range(3)]
    keys = [np.concatenate([k, k[:100]]) for k in keys]
    names = D._names(*keys)
    rows = list(zip(*(k.tolist() for k in keys)))
    rank = {r: n for n, r in enumerate(sorted(set(rows)), 1)}
    assert names.tolist() == [rank[r] for r in rows]
