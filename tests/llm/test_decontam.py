import random
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from vigil.llm import decontam as D
from vigil.llm.queries import QUERIES


def grams(text, width=None, size=5):
    w = (text or "").encode().lower().split()
    n = min(size, len(w)) if width is None else width
    return n, [tuple(w[k:k + n]) for k in range(len(w) - n + 1)] if n else []


def plain(text, items, least=0.8):
    out = {}
    for i, item in items:
        width, own = grams(item)
        if not own:
            continue
        bag = Counter(own)
        _, run = grams(text, width)
        n = min(len(own), len(run))
        best = 0
        for a in range(len(run) - n + 1) if n else ():
            shared = sum((Counter(run[a:a + n]) & bag).values())
            best = max(best, shared / (n + len(own) - shared))
        if best >= least:
            out[i] = best
    return out


def check(df, docs, items):
    for (i, text), r in zip(docs, df):
        expected = plain(text, items)
        assert {m.item_id: round(m.similarity, 9) for m in r.matches} == {k: round(v, 9) for k, v in expected.items()}, (i, text)


def test_exact_near_and_partial_passages(frame):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(rng.randrange(6, 50)))) for k in range(30)]
    items += [(100, None), (101, ""), (102, "two words"), (103, "alone"), (104, items[0][1]), (105, "rep " * 30)]
    docs = []
    for k in range(60):
        own = items[k % 30][1].split()
        for _ in range(k // 15):  # 0 to 3 changed words
            j = rng.randrange(len(own))
            own[j:j + 1] = rng.choice([[], [word()], [own[j], word()]])
        around = [word() for _ in range(rng.randrange(80))]
        docs.append((k, " ".join(around + own + around[::-1]).upper()))
    docs += [(200, None), (201, ""), (202, "two words"), (203, "ALONE"), (204, "rep " * 500), (205, "rep " * 9),
             (206, items[3][1] + "\n" + items[3][1]), (206, items[3][1] + "\n" + items[3][1])]
    for blocks in ({}, {"block_items": 7}):
        df = D.decontaminate(frame(docs).coalesce(1).withColumn("matches", F.lit(1)), frame(items, "item_id long, text string"), **blocks)
        assert df.columns == ["doc_id", "text", "matches"]
        rows = df.collect()
        check(rows, docs, items)


def test_index_finds_just_the_items_within_the_radius():
    rng = np.random.default_rng(2)
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(6 + k % 3))) for k in range(300)]
    items = D.Items(rows, 5, D.RADIUS, 0.8)
    assert [g[:2] for g in items.groups] == [(5, 2), (5, 3), (5, 4)]
    near = items.prints.copy()
    for k in range(len(near)):  # up to the radius
        for b in rng.choice(D.BITS, rng.integers(0, D.RADIUS + 2), replace=False):
            near[k, b // 16] ^= np.uint16(1 << (b % 16))
    exact = D._distance(near[:, None], items.prints[None, :]) <= D.RADIUS
    assert 200 < exact.diagonal().sum() < 300
    for _, _, low, high in items.groups:
        found = np.zeros_like(exact)
        found[items.within_radius(near, low, high)] = True
        assert np.array_equal(found[:, low:high], exact[:, low:high]) and found.sum() == exact[:, low:high].sum()


def test_fingerprints_of_windows_at_the_limit_lie_within_the_radius():
    rng = np.random.default_rng(5)
    for n in (9, 18, 45, 200):
        missed = 0
        for _ in range(200):
            run = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            other = run.copy()
            other[:n // 9] = rng.integers(0, 1 << 63, n // 9, dtype=np.uint64)  # similarity 0.8
            a, b = (D._fingerprints(D._signed(r).sum(axis=0, keepdims=True)) for r in (run, other))
            missed += int(D._distance(a, b)[0] > D.RADIUS)
        assert missed == 0, n


def test_a_very_long_text(frame):
    rng = random.Random(6)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(30))) for k in range(3)]
    far = [f"t{rng.randrange(10**6)}" for _ in range(300_000)]
    text = " ".join(far[:200_000] + items[1][1].split() + far[200_000:] + items[2][1].split()[:29])
    got = D.decontaminate(frame([(1, text)]), frame(items, "item_id long, text string")).first().matches
    assert [(m.item_id, m.word) for m in got] == [(1, 200_000), (2, 300_029)]
    assert got[0].similarity == 1.0 and abs(got[1].similarity - 25 / 27) < 1e-9


def test_empty_tables(frame):
    none = frame([], "item_id long, text string")
    assert D.decontaminate(frame([]), none).collect() == []
    assert D.decontaminate(frame([(1, "a b c")]), none).first().matches == []
    assert D.decontaminate(frame([]), frame([(1, "a b c")], "item_id long, text string")).collect() == []


def test_query(spark, small, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{small}/benchmark.parquet'").fetchall()
    first = {}
    for i, t in items:
        for g in grams(t)[1]:
            first.setdefault(g, []).append((i, t))
    for r in QUERIES["op6_decontam"](spark, small).collect():
        near = {x for g in grams(documents[r.doc_id])[1] for x in first.get(g, ())}
        expected = plain(documents[r.doc_id], near)
        assert r.item_ids == ",".join(map(str, sorted(expected))) and r.n_items == len(expected)
        assert r.contaminated == bool(expected)
