import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from vigil.llm import substrings as S
from vigil.llm.queries import QUERIES


def plain(rows, length):
    starts = Counter()
    for _, t in rows:
        b = (t or "").encode()
        starts.update(b[k:k + length] for k in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if starts[b[k:k + length]] > 1:
                gone[k:k + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((-1 if i is None else i, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out)


def got(df, **kw):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
                  for r in S.remove_repeats(df, **kw).collect())


@pytest.mark.parametrize("group", [S.GROUP, 2])
def test_against_plain_version(frame, documents, group):
    rows = [(i, t) for i, t in sorted(documents.items()) if len(t) < 4000][:80]
    rng = random.Random(2)
    passage = rows[5][1][:260]
    for k in range(12):  # passages at odd places, cut at every length around the limit
        a = rng.randrange(40)
        rows.append((2000 + k, rows[20 + k][1][:300] + passage[a:a + 195 + k] + "é" * k + rows[40 + k][1][:150]))
    rows += [(90001, None), (90002, "a" * 1000), (90003, "ab" * 300 + "x" + "ab" * 99), (90004, "z" * 199), (90004, "z" * 199),
             (90005, rows[3][1]), (None, rows[5][1][:700] + "é" * 200), (90006, ""), (90007, "漢" * 67), (90008, "漢" * 66)]
    df = frame(rows).selectExpr("doc_id", "text", "1 AS kept", "'x' AS n_bytes")
    assert got(df, group=group) == plain(rows, 200)


def test_other_lengths(frame):
    rng = random.Random(9)
    rows = [(k, "".join(rng.choice("ab ") for _ in range(rng.randrange(200)))) for k in range(40)]
    for length in (20, 33):
        assert got(frame(rows), length=length) == plain(rows, length)


def test_parts_of_a_long_text(monkeypatch):
    rng = random.Random(4)
    data = np.frombuffer(bytes(rng.choice(b"abcd") for _ in range(5000)), np.uint8)
    whole = {(int(h), int(p)) for h, p, _, _ in zip(*S.text_anchors(data, 200, 141))}
    monkeypatch.setattr(S, "PART", 700)
    h, place, first, last = S.text_anchors(data, 200, 141)
    assert {(int(a), int(b)) for a, b in zip(h, place)} == whole
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert np.array_equal(windows, np.arange(len(data) - 199))


def test_texts_of_one_id_with_the_same_short_hash(frame):
    def made(n):
        return "".join(hashlib.sha256(f"{k}-{n}".encode()).hexdigest() for k in range(5))

    pair = [made(62569), made(99135)]  # Spark's 32-bit hashes of the two are equal
    assert frame([(None, t) for t in pair]).selectExpr("hash(text) AS h").distinct().count() == 1
    rows = [(None, pair[0]), (None, pair[1]), (1, "x" + pair[0][:250])]  # a repeated string
    assert got(frame(rows)) == plain(rows, 200)
    rows = [(None, pair[0]), (None, pair[1]), (None, pair[0])]  # a repeated text
    assert got(frame(rows)) == plain(rows, 200)


def test_empty_table(frame):
    assert got(frame([])) == []


def test_query(spark, small, documents):
    expected = plain(list(documents.items()), 200)
    rows = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffixes"](spark, small).collect())
    assert rows == [(*e[:4], hashlib.sha256(e[4]).hexdigest()) for e in expected]
