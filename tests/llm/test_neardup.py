import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from vigil.llm import neardup as N
from vigil.llm.components import components
from vigil.llm.queries import QUERIES


def sets_of(rows, size):
    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = min(size, len(w))
        out.append((i, frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if n else frozenset()))
    return out


def root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def plain(rows, size=2, percent=80):
    """doc_id -> (set sizes, component); rows with the same id are one node."""
    sets = sets_of([r for r in rows if r[0] is not None], size)
    parent = {i: i for i, _ in sets}
    by = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            by[x].append(k)
    for k, (i, s) in enumerate(sets):
        shared = Counter(j for x in s for j in by[x] if j > k)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = root(parent, i), root(parent, sets[j][0])
                parent[max(a, b)] = min(a, b)
    return {i: root(parent, i) for i in parent}


def check(got, rows, size=2):
    comps = plain(rows, size)
    sizes = Counter((i, len(s)) for i, s in sets_of(rows, size))
    assert Counter((r.doc_id, r.n_shingles) for r in got) == sizes
    for r in got:
        expected = comps.get(r.doc_id)
        assert r.component_id == expected and r.kept == (r.doc_id is None or r.doc_id == expected), r


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_families_around_the_limit(frame):
    rng = random.Random(8)
    texts = []
    for size in (4, 6, 11, 30, 120):
        base = [f"w{size}x{j}" for j in range(size)]
        texts += family(rng, base, 25, max(1, size // 15))
    rows = [(k * 3 % 997, t) for k, t in enumerate(texts)]
    check(N.near_duplicates(frame(rows), size=2).collect(), rows)
    check(N.near_duplicates(frame(rows), size=2, block_shingles=200).collect(), rows)


def test_edges(frame):
    rows = [(9, None), (8, ""), (7, " \n\t"), (6, "one"), (5, "ONE"), (4, "one"), (3, "one two"), (2, "One\x0bTWO"), (None, "one two"),
            (None, None), (10, "É é"), (11, "é é"), (12, "a b c d e f"), (12, "a b c d e f"), (13, "a b c d e f"),
            (14, "x y z"), (14, "q r s"), (14, None), (15, "q r s"), (16, "x y z"), (17, "word " * 50_000), (18, "word " * 3),
            (19, " ".join(f"n{k}" for k in range(60_000))), (20, " ".join(f"n{k}" for k in range(60_003)))]
    df = frame(rows).withColumn("kept", F.lit("clash")).withColumn("node", F.lit(1))
    check(N.near_duplicates(df, size=2).collect(), rows)


def test_empty_table(frame):
    assert N.near_duplicates(frame([])).collect() == []


def test_pairs_within_the_signature_distance_share_a_key():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 16, (200, N.SYMBOLS), dtype=np.uint16)
    other = base.copy()
    most = N.CHUNKS * (N.ERRORS + 1) - 1
    for row in other:
        for k in rng.choice(N.SYMBOLS, most, replace=False):
            row[k] ^= np.uint16(1)
    a, b = N._keys(base, N.CHUNKS, N.ERRORS), N._keys(other, N.CHUNKS, N.ERRORS)
    assert (a == b).any(axis=1).all()


def test_components(frame):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(200, 260)] + [(rng.randrange(150), rng.randrange(150)) for _ in range(90)]
    edges += [(500, 499), (500, 498), (7, 7), (300, 301), (300, 301)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = root(parent, a), root(parent, b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(frame(edges, "u long, v long")).collect()}
    assert got == {x: root(parent, x) for e in edges if e[0] != e[1] for x in e}


def test_query(spark, small, documents):
    check(QUERIES["op7_neardup"](spark, small).collect(), list(documents.items()))


def test_only_pairs_within_the_signature_distance_are_confirmed():
    rng = np.random.default_rng(4)
    own = np.unique(rng.integers(0, 1 << 62, 100, dtype=np.uint64))
    sig = N.signature(own, N._multipliers(N.SYMBOLS))
    far = sig.copy()
    far[:15] += np.uint16(1)
    first = np.array([True, True])
    for other, links in ((sig, 1), (far, 0)):
        got = N.link_block(np.array([1, 2]), [own, own], np.stack([sig, other]), first, 80, 14)
        assert len(got) == links
    far[0] = sig[0]
    assert N.link_block(np.array([1, 2]), [own, own], np.stack([sig, far]), first, 80, 14) == [(1, 2)]


def test_shared_boilerplate_links_nothing(frame):
    rng = random.Random(12)
    shared = [f"b{j}" for j in range(60)]  # about 0.3 of the shingles of any two
    rows = [(k, " ".join(shared + [f"o{rng.randrange(10**9)}" for _ in range(70)])) for k in range(300)]
    rows += [(1000 + k, t + " end") for k, t in rows[::10]]
    check(N.near_duplicates(frame(rows), size=2).collect(), rows)
    check(N.near_duplicates(frame(rows), size=2, block_shingles=3000).collect(), rows)


def _sketched(sigs, keys, frame):
    words = N.sketch(sigs).view(np.int64)
    rows = [(int(k), n, *map(int, words[n])) for n, k in enumerate(keys)]
    return frame(rows, "key long, node long, s0 long, s1 long")


def test_a_sketch_never_differs_in_more_symbols_than_its_signature():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 16, (500, N.SYMBOLS), dtype=np.uint16)
    b = np.where(rng.random(a.shape) < rng.random((500, 1)), a ^ rng.integers(0, 1 << 16, a.shape, dtype=np.uint16), a)
    low = (a & 15 != b & 15).sum(axis=1)
    assert (N.sketch_distance(N.sketch(a), N.sketch(b)) == low).all() and (low <= (a != b).sum(axis=1)).all()


def test_only_rows_near_another_of_their_key_meet(frame):
    rng = np.random.default_rng(7)
    sigs = rng.integers(0, 1 << 16, (300, N.SYMBOLS), dtype=np.uint16)
    for k in range(0, 300, 5):  # rows k to k + 3 are a chain: 10 symbols from one to the next, 20 or more over two steps
        for j in range(3):
            sigs[k + j + 1] = sigs[k + j]
            sigs[k + j + 1, 10 * j:10 * j + 10] ^= np.uint16(0x5555)
    keys = np.concatenate([np.arange(150) // 5, np.full(150, 99)])
    df = _sketched(sigs, keys, frame)
    for key_rows in (20_000, 151):
        got = [tuple(r) for r in N.meeting(df, 14, key_rows).collect()]
        assert {n for _, _, n in got} == {n for n in range(300) if n % 5 < 4}
        parent = list(range(300))
        for key, u, v in got:
            assert keys[u] == keys[v] == key
            parent[max(root(parent, u), root(parent, v))] = min(root(parent, u), root(parent, v))
        assert [root(parent, n) for n in range(300)] == [n // 5 * 5 if n % 5 < 4 else n for n in range(300)]
    hot = N.meeting(df, 14, 100).filter("key = 99").collect()  # too many for one comparison: all stay
    assert {(r.head, r.node) for r in hot} == {(150, n) for n in range(150, 300)}


def test_blocks_of_a_linked_family_are_compared_by_a_few(frame, monkeypatch):
    rng = random.Random(5)
    base = [f"w{j}" for j in range(200)]
    rows = list(enumerate(family(rng, base, 300, 2)))
    # A second family, near the first one (0.6 of the shingles) but not linked to it.
    rows += [(1000 + k, t) for k, t in enumerate(family(rng, base[:150] + [f"v{j}" for j in range(50)], 60, 2))]
    seen = []
    plain_linked = N.linked

    def counted(tasks, *args):
        seen.append(tasks.select("cluster", "a", "b", "node").distinct().count())
        return plain_linked(tasks, *args)

    monkeypatch.setattr(N, "linked", counted)
    check(N.near_duplicates(frame(rows), size=2, block_shingles=50_000).collect(), rows)
    monkeypatch.undo()
    blocks = -(-sum(200 + N.MEMBER for _ in rows) // 50_000)
    assert blocks > 4 and len(seen) == 3
    assert seen[0] <= len(rows) and seen[1] <= 2 * N.DELEGATES * blocks * blocks
    check(N.near_duplicates(frame(rows), size=2).collect(), rows)
