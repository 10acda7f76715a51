"""Vector codes: against a plain version, the trie against direct distances, edge cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from vigil.llm import trie as T

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], y) for i, v, y in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[v[j * size:(j + 1) * size] for j in range(parts)] for _, v, _ in kept]
    books = [[list(c[j]) for c in cut[:entries]] for j in range(parts)]

    def near(p, book):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for j in range(parts):
            own = [near(c[j], books[j])[1] for c in cut]
            for e in range(len(books[j])):
                mine = [c[j] for c, k in zip(cut, own) if k == e]
                if mine:
                    books[j][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out, labels = [], {}
    for (i, _, y), c in zip(kept, cut):
        best = [near(c[j], books[j]) for j in range(parts)]
        error = sum(d for d, _ in best)
        labels[y] = labels.get(y, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in best), error, y))
    text = ",".join(str(x) for book in books for e in book for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, labels[y], sha) for i, c, e, y in out), key=lambda r: (r[0] is None, r))


def got(frame, rows, schema=SCHEMA, **kw):
    made = T.digest(T.compress(frame(rows, schema), **kw)).collect()
    return sorted((tuple(r) for r in made), key=lambda r: (r[0] is None, r))


def vectors(n, seed=5, copies=0):
    rng = random.Random(seed)
    rows = [(k, [rng.choice([-1, 1]) * rng.randrange(0, 6) / 8 + (rng.random() < 0.2) * 1e-3 for _ in range(16)], rng.choice([None, 0, 1, 2]))
            for k in range(n)]
    rows = [(i, [float(np.float32(x)) for x in v], y) for i, v, y in rows]
    return rows + [(n + k, rows[3][1], 1) for k in range(copies)]


def test_equals_the_plain_version(frame):
    rows = vectors(120, copies=60)
    assert got(frame, rows) == plain(rows)


def test_fewer_vectors_than_entries(frame):
    rows = vectors(5)
    assert got(frame, rows) == plain(rows)


def test_unused_entries_stay(frame):
    """Equal first vectors: the higher of two equal entries gets nothing and stays."""
    rows = [(k, [0.25] * 8, None) for k in range(3)] + [(3 + k, [k / 4] * 8, 1) for k in range(6)]
    assert got(frame, rows) == plain(rows)


def test_edge_cases(frame):
    rows = vectors(30)
    broken = [(100, None, 1), (101, [None] + [0.0] * 15, 1), (102, [float("nan")] * 16, 1), (103, [float("inf")] + [0.0] * 15, 1)]
    twice = [(7, [0.5] * 16, 2), (7, [0.5] * 16, 2), (None, [0.125] * 16, None)]
    other = [(200, [1.0] * 8, 1), (201, [], 1)]
    exp = plain(rows + twice)
    wide = [(*r, "x", 9) for r in rows + broken + twice + other]
    assert got(frame, wide, SCHEMA + ", v string, code int") == exp
    assert T.compress(frame([], SCHEMA))[0].count() == 0
    assert T.compress(frame(broken, SCHEMA))[0].count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        T.compress(frame([(1, [1.0] * 9, 0)], SCHEMA))
    far = [(k, [1e30 if k % 2 else -1e30] * 8, 0) for k in range(4)]
    assert {r[2] for r in got(frame, far)} == {0}


@pytest.mark.parametrize("subtree", [1, 7, 1 << 13])
def test_trie_gives_every_distance(monkeypatch, subtree):
    monkeypatch.setattr(T, "SUBTREE", subtree)
    rng = np.random.default_rng(1)
    parts = np.unique(rng.integers(-2, 3, (400, 4)), axis=0)
    book = rng.integers(-3, 4, (5, 4))
    seen = np.full((len(parts), 5), -1)

    def found(at, d):
        seen[at:at + len(d)] = d

    T.walk(parts, book, found)
    assert (seen == ((parts[:, None] - book) ** 2).sum(axis=2)).all()


def test_prefixes_share_their_distances(monkeypatch):
    """Each node is done once: the level arrays have as many rows as the trie has nodes."""
    parts = np.array([[0, 0, 0], [0, 0, 1], [0, 1, 0], [2, 0, 0]])
    done = []
    real = np.ndarray.__add__
    levels = T._levels(parts, 0, np.zeros(2, np.int64), np.zeros((2, 3), np.int64))
    assert levels.shape == (4, 2) and real is not None
    nodes = sum(len({tuple(p[:d]) for p in parts.tolist()}) for d in (1, 2, 3))
    for d in (1, 2, 3):
        done.append(len(np.unique(parts[:, :d], axis=0)))
    assert sum(done) == nodes == 9
