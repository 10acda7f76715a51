import hashlib
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm import linedup as L
from vigil.llm.queries import QUERIES

GAPS = " \t\n\x0b\x0c\r"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@given(st.text("ab", max_size=9), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9), st.sampled_from("abc")), max_size=5))
@settings(max_examples=500, deadline=None)
def test_banded_distance(a, edits):
    b = list(a)
    for kind, p, c in edits:
        if kind == 0:
            b.insert(p, c)
        elif p < len(b):
            if kind == 1:
                del b[p]
            else:
                b[p] = c
    b = "".join(b)
    for most in range(4):
        assert L.within(a, b, most) == (distance(a, b) <= most)


@given(st.text("abcde", min_size=8, max_size=30), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 29), st.sampled_from("abcx")), max_size=2))
@settings(max_examples=500, deadline=None)
def test_lines_within_the_threshold_share_a_key(a, edits):
    b = list(a)
    for kind, p, c in edits:
        if kind == 0:
            b.insert(p, c)
        elif p < len(b):
            if kind == 1:
                del b[p]
            else:
                b[p] = c
    b = "".join(b)
    lines = [a, b]
    length = np.array([len(x) for x in lines])
    start = np.cumsum(length) - length
    points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    for most in (1, 2, 3):
        if len(b) > most and distance(a, b) <= most:
            hashes = L.Substrings(points)
            row, key = L.segment_keys(hashes, start, length, most)
            p_row, p_key = L.probe_keys(hashes, start, length, most)
            long, short = (0, 1) if len(a) >= len(b) else (1, 0)
            assert set(p_key[p_row == long]) & set(key[row == short])
            par = L.parity(points, start, length)
            assert np.bitwise_count(par[0] ^ par[1]) <= 4 * most


def order_of(doc_id, text, pos):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return (L.LAST_ID if doc_id is None else doc_id, h - (1 << 64) if h >> 63 else h, pos)


def most(a, b, steps):
    """The edits that two lines may differ by: those of the longer one."""
    return max([e for n, e in steps if max(len(a), len(b)) >= n], default=0)


def plain(rows, steps=L.STEPS):
    first = {}
    for i, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            if line.strip(GAPS):
                k = order_of(i, t, p)
                first[line] = min(first.get(line, k), k)
    ranked = sorted(first, key=first.get)
    near = {b for k, b in enumerate(ranked) if any(
        abs(len(a) - len(b)) <= most(a, b, steps) and L.within(a, b, most(a, b, steps)) for a in ranked[:k])}
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0, 0))
            continue
        left, seen, n, repeats, nears = [], set(), 0, 0, 0
        for p, line in enumerate(t.split("\n")):
            if line.strip(GAPS):
                n += 1
                if line in near:
                    nears += 1
                    continue
                if line in seen or first[line] != order_of(i, t, p):
                    repeats += 1
                    continue
                seen.add(line)
            left.append(line)
        out.append((i, "\n".join(left), n, repeats, nears))
    return out


def check(got, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2:])
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_repeats, r.n_near) for r in got), key=key)
    # A near line that repeats in its own text may count as either.
    assert [(*r[:3], r[3] + r[4]) for r in got] == [(*r[:3], r[3] + r[4]) for r in sorted(expected, key=key)]


def edited(rng, line, n):
    b = list(line)
    for _ in range(n):
        p = rng.randrange(len(b))
        kind = rng.randrange(3)
        if kind == 0:
            b.insert(p, "x")
        elif kind == 1:
            del b[p]
        else:
            b[p] = "é"
    return "".join(b)


def planted(documents, seed=5):
    rng = random.Random(seed)
    docs = [(i, t) for i, t in sorted(documents.items()) if len(t) < 2500][:60]
    lines = [x for _, t in docs for x in t.split("\n") if len(x) >= 28]
    extra = [(1000 + k, "\n".join(edited(rng, rng.choice(lines)[:rng.choice([15, 17, 24, 31, 33, 60, 255, 258, 400])], rng.randrange(5)) for _ in range(6)))
             for k in range(30)]
    return docs + extra


@pytest.mark.parametrize("hot_key", [L.HOT_KEY, 7, 0])
def test_against_plain_version(frame, documents, hot_key):
    rows = planted(documents)
    rows += [(5000, None), (5001, ""), (5002, "\n \n"), (None, rows[0][1]), (None, None), (rows[3][0], "a\nb"), rows[4], rows[4],
             (5003, "same line\nsame line\n\nsame line"), (5004, "z" * 50_000), (5005, "z" * 49_999 + "y")]
    df = frame(rows).withColumn("n_near", F.lit("clash")).withColumn("_gone", F.lit(1)).withColumn("lang", F.lit("en"))
    got = L.line_dedup(df, hot_key=hot_key)
    assert got.columns == ["doc_id", "text", "lang", "n_lines", "n_repeats", "n_near"]
    check(got.collect(), plain(rows))


@pytest.mark.parametrize("hot_key", [L.HOT_KEY, 9])
def test_keys_across_small_batches(spark, frame, documents, hot_key):
    rows = planted(documents, seed=6)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "5")
    try:
        check(L.line_dedup(frame(rows), hot_key=hot_key).collect(), plain(rows))
    finally:
        spark.conf.set(setting, before)


def counted(rng, n):
    """Lines of one form that are near many of the others, in any order."""
    lines = [f"Copyright 2021 Example Corp. page {k:04d} of the register" for k in range(n)]
    return rng.sample(lines, n)


@pytest.mark.parametrize("hot_key", [L.HOT_KEY, 100])
def test_group_of_near_lines_makes_no_pairs(frame, hot_key):
    rows = list(enumerate(counted(random.Random(4), 400)))
    keys = L._keyed(frame(rows), "text", L.STEPS)
    met = [(r.key, r.h1) for r in L._candidates(keys, hot_key).collect()]
    made = L.line_keys(L.Substrings(np.zeros(60, np.uint32)), np.array([0]), np.array([len(rows[0][1])]), L.STEPS)[1]
    assert len(met) == len(set(met)) <= len(rows) * len(made) * (1 if hot_key > 400 else 9)
    check(L.line_dedup(frame(rows), hot_key=hot_key).collect(), plain(rows))


@pytest.mark.parametrize("n", [2, L.FEW, 150, 700])
def test_earlier_near_lines_of_a_key(n):
    lines = counted(random.Random(n), n) + [f"something else {k * k * 7919:030d}" for k in range(n // 3)]
    random.Random(1).shuffle(lines)
    length = np.array([len(x) for x in lines])
    points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    found = L._later(L.parity(points, np.cumsum(length) - length, length), lines, L.STEPS)
    assert sorted(found) == [z for z, x in enumerate(lines) if any(L.within(x, y, most(x, y, L.STEPS)) for y in lines[:z])]


def test_comparisons_of_a_near_group_are_as_many_as_its_lines(monkeypatch):
    calls = []
    within = L.within
    monkeypatch.setattr(L, "within", lambda *a: calls.append(1) or within(*a))
    lines = ["Copyright 2021 Example Corp. all rights reserved " + chr(0x4E00 + k) for k in range(1500)]
    assert len(L._later(np.zeros(len(lines), np.uint64), lines, L.STEPS)) == len(calls) == 1499


@pytest.mark.parametrize("held_rows", [L.HELD_ROWS, 50, 1])
def test_buckets_across_batches(held_rows):
    rng = np.random.default_rng(held_rows)
    # 300 keys of 40 buckets, one with a third of the rows.
    key = (rng.integers(0, 40, 300).astype(np.uint64) << np.uint64(50) | rng.integers(1, 1 << 30, 300).astype(np.uint64) << np.uint64(8))
    word = np.where(rng.random(3000) < 0.3, key[7], key[rng.integers(0, 300, 3000)])
    side = rng.choice(np.array([-2, 2], np.int8), 3000)
    h1 = rng.integers(0, 500, 3000).astype(np.uint64)
    par = h1 % np.uint64(7) * np.uint64(0x1111111111111111)
    rows = np.stack([L._joined(word, side), h1, par], axis=1)

    def made(tables, hot_key, held):
        batches = [b.slice(k, 1) for b in L._bucketed(tables) for k in range(b.num_rows)]
        batches.sort(key=lambda b: b.column(0)[0].as_py())
        return [tuple(r.values()) for b in L._met_batches(iter(batches), hot_key, False, held) for r in b.to_pylist()]

    for hot_key in (1 << 20, 100):
        whole = made([rows], hot_key, 1 << 20)
        assert len(whole) == len(set(whole)) and whole
        parts = made([rows[k:k + 37] for k in range(0, 3000, 37)], hot_key, held_rows)
        assert set(parts) == set(whole)
    assert any(r[1] is not None for r in whole)


def test_threshold_one_and_short_lines(frame):
    rows = [(1, "abcdefghij\nabcdefghiX"), (2, "abcdefgh\nabcdefghijk"), (3, "abcXefghij\nzz"), (4, "zy\nzz")]
    check(L.line_dedup(frame(rows), steps=((5, 1),)).collect(), plain(rows, ((5, 1),)))


@given(st.text("abcde", min_size=3, max_size=24), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 23), st.sampled_from("abcx")), max_size=4))
@settings(max_examples=500, deadline=None)
def test_lines_share_a_key_across_steps(a, edits):
    steps = ((4, 1), (8, 2), (14, 3), (20, 4))
    b = list(a)
    for kind, p, c in edits:
        if kind == 0:
            b.insert(p, c)
        elif p < len(b):
            if kind == 1:
                del b[p]
            else:
                b[p] = c
    b = "".join(b)
    if a != b and b and distance(a, b) <= most(a, b, steps):
        length = np.array([len(a), len(b)])
        points = np.frombuffer((a + b).encode("utf-32-le"), np.uint32)
        row, key, side = L.line_keys(L.Substrings(points), np.cumsum(length) - length, length, steps)
        long, short = (0, 1) if len(a) >= len(b) else (1, 0)
        t = most(a, b, steps)
        assert set(key[(row == long) & (side == t)]) & set(key[(row == short) & (side == -t)])


@pytest.mark.parametrize("hot_key", [L.HOT_KEY, 0])
def test_edits_grow_with_length(frame, hot_key):
    long = "".join(random.Random(3).choice("abcdefghij ") for _ in range(300))
    rows = [(1, "Copyright 2021 Foo Inc."), (2, "Copyright 2022 Foo Inc."), (3, "Copyright 2032 Foo Inc"),
            (4, "page 12 of 30"), (5, "page 13 of 30"), (6, "x" * 31), (7, "x" * 33), (8, "x" * 30), (9, "y" * 15), (10, "y" * 16),
            (11, long), (12, "X" + long[1:150] + "X" + long[151:299] + "X"), (13, "YZ" + long[2:150] + "Y" + long[151:299] + "Y")]
    got = L.line_dedup(frame(rows), hot_key=hot_key).collect()
    check(got, plain(rows))
    # 1 edit for short lines, 2 from 32, 3 from 256 on; none under 16.
    assert {r.doc_id for r in got if r.n_near} == {2, 7, 8, 10, 12}


def test_steps_must_rise(frame):
    for steps in ((), ((3, 1),), ((16, 2), (32, 2)), ((16, 0),)):
        with pytest.raises(ValueError):
            L.line_dedup(frame([(1, "a")]), steps=steps)


def test_empty_table(frame):
    assert L.line_dedup(frame([])).collect() == []


def test_query(spark, small, documents):
    got = {r.doc_id: r for r in QUERIES["op2_lines"](spark, small).collect()}
    expected = plain(list(documents.items()))
    assert len(got) == len(expected)
    for i, text, n, repeats, nears in expected:
        r = got[i]
        assert (r.n_lines, r.n_repeats + r.n_near) == (n, repeats + nears)
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
