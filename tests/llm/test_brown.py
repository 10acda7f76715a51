"""Class-based language model: against a plain version, sums of probabilities, edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vigil.llm import blocks as B
from vigil.llm import brown as W
from vigil.llm.queries import QUERIES


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    kinds = [["the", "a", "one"], ["cat", "dog", "fox", "hen"], ["sees", "eats", "likes"], ["now", "here"]]
    docs = []
    for k in range(n):
        text = []
        for _ in range(rng.randrange(0, 12)):
            text += [rng.choice(w) for w in kinds] + ([f"x{rng.randrange(60)}"] if rng.random() < 0.2 else [])
        docs.append((k, " \t".join(text)))
    return docs


def train(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 != 0


def words_of(text):
    return [w.lower() for w in (text or "").encode().split()]


def h(x):
    return x * math.log(x) if x > 0 else 0.0


def plain(docs, classes, rounds, parts):
    """The same clustering and score, word by word."""
    lines = [words_of(t) for i, t in docs if train(i)]
    count = Counter(w for x in lines for w in x)
    ends, tokens = len(lines), sum(count.values()) + len(lines)
    part = {w: int(B.hashes(pa.array([w], pa.large_binary()))[0] % np.uint64(parts)) for w in count}
    number, seen = {}, Counter()
    for w in sorted(count):
        number[w] = seen[part[w]]
        seen[part[w]] += 1
    top = sorted(count, key=lambda w: (-count[w], part[w], number[w]))[:classes - 1]
    label = {w: classes - 1 for w in count} | {w: k for k, w in enumerate(top)}
    end = classes

    def successions(label):
        n = np.zeros((classes + 1, classes + 1))
        for x in lines:
            c = [end, *[label[w] for w in x], end]
            for a, b in zip(c, c[1:]):
                n[a, b] += 1
        return n

    def value(n):
        return sum(h(x) for x in n.flat) - sum(h(x) for x in n.sum(0)) - sum(h(x) for x in n.sum(1))

    n = successions(label)
    best, history = (value(n), dict(label), n), [value(n)]
    for half in range(rounds):
        new = dict(label)
        for w in count:
            if (number[w] + half) % 2:
                continue
            left, right = Counter(), Counter()
            for x in lines:
                c = [None, *x, None]
                for at in range(1, len(c) - 1):
                    if c[at] == w:
                        left[label.get(c[at - 1], end)] += 1
                        right[label.get(c[at + 1], end)] += 1
            gain = []
            for b in range(classes):
                out = -1 if b == label[w] else 1
                g = sum(out * (h(n[b, c] + out * r) - h(n[b, c])) for c, r in right.items())
                g += sum(out * (h(n[c, b] + out * r) - h(n[c, b])) for c, r in left.items())
                for margin in (n.sum(1)[b], n.sum(0)[b]):
                    g -= out * (h(margin + out * count[w]) - h(margin))
                gain.append(g)
            to = max(range(classes), key=lambda b: gain[b])
            if gain[to] > gain[label[w]] + 1e-9 * abs(gain[label[w]]):
                new[w] = to
        label = new
        n = successions(label)
        history.append(value(n))
        if history[-1] > best[0]:
            best = (history[-1], dict(label), n)
    _, label, n = best
    ones, twos = (sum(v == k for v in count.values()) for k in (1, 2))
    d = ones / (ones + 2 * twos) if ones and twos else 0.5
    types, share, size = Counter(label.values()), n.sum(0) / tokens, n.sum(0)

    def p(word, before):
        def step(c):
            return share[c] if before is None else (n[before, c] + 5 * share[c]) / (n[before].sum() + 5)
        if word == "end":
            return step(end)
        if word not in count:
            return sum(step(c) * d * types[c] / size[c] for c in range(classes) if size[c])
        return step(label[word]) * (count[word] - d) / size[label[word]]

    out = {}
    for i, t in docs:
        before, score, base, known = end, 0.0, 0.0, 0
        for w in [*words_of(t), "end"]:
            c = ends if w == "end" else count[w]
            known += c > 0
            uni = (c + 0.1) / (tokens + 0.1 * (len(count) + 2))
            base += math.log10(uni)
            score += math.log10(0.9 * p(w, before) + 0.1 * uni)
            before = end if w == "end" else label.get(w)
        out[i] = (len(words_of(t)) + 1, known, tokens, base, score)
    return out, history


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_equals_the_plain_version(frame, block_bytes):
    docs = corpus()
    trace = []
    got = {r.doc_id: r for r in W.score(frame(docs).repartition(3), classes=6, rounds=3, block_bytes=block_bytes, trace=trace).collect()}
    exp, history = plain(docs, 6, 3, B.LEAST_PARTS)
    assert trace == pytest.approx(history) and max(trace) > trace[0]
    assert set(got) == set(exp)
    for i, (n, known, tokens, base, score) in exp.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, tokens, not train(i))
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(2)
    count, label = np.array([5, 1, 2, 1, 7, 2]), np.array([0, 0, 1, 1, 2, 2])
    n = rng.integers(0, 5, (4, 4))
    tokens = 0
    # Succession counts whose columns are the words of each class and the ends.
    n[:] = 0
    for c, size in ((0, 6), (1, 3), (2, 9), (3, 4)):
        for _ in range(size):
            n[rng.integers(0, 4), c] += 1
        tokens += size
    m = W.Model(n, np.array([2, 2, 2]), tokens, 7, 2, 2)
    everything = np.array([*range(6), -1, 6])  # six words, the end, an unknown word
    for before in range(4):  # after a word of each class, and after a boundary
        first = {0: 0, 1: 2, 2: 4, 3: -1}[before]
        p = [10 ** np.array(m.scores(np.append(count, 0), np.append(label, W.NONE), np.array([first, w]), 4))[:, 0] for w in everything]
        assert np.sum(p, axis=0) == pytest.approx([1, 1])
    p = [10 ** m.scores(np.append(count, 0), np.append(label, W.NONE), np.array([6, w]), 4)[1][0] for w in everything]
    assert sum(p) == pytest.approx(1)


def test_edge_cases(frame):
    docs = [(1, None), (2, ""), (None, "a b"), (3, "A\tb\x0bc"), (3, "A\tb\x0bc"), (4, "é É  x"), (10, "w " * 200_000)]
    rows = [(*d, 5, "z", True) for d in docs]
    df = frame(rows, "doc_id long, text string, block int, codes string, _train boolean")
    got = W.score(df, classes=4, rounds=2, block_bytes=64).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got) == [
        (False, 1, 1), (False, 2, 1), (False, 3, 4), (False, 3, 4), (False, 4, 4), (False, 10, 200_001), (True, 0, 3)]
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert len({r.train_tokens for r in got}) == 1 and all(math.isfinite(r.score) for r in got)
    assert W.score(df.filter("false")).count() == 0


def test_without_training_texts(frame):
    held = next(k for k in range(100) if not train(k))
    r = W.score(frame([(held, "a b")]), classes=4, rounds=2).collect()[0]
    assert (r.n_known, r.train_tokens, r.score) == (0, 0, r.base_score)


def test_query_and_held_out_texts(spark, small, documents):
    got = QUERIES["op12_brown"](spark, small).collect()
    assert sorted(r.doc_id for r in got) == sorted(documents)
    for r in got:
        assert r.n_tokens == len(words_of(documents[r.doc_id])) + 1 and r.held_out == (not train(r.doc_id))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
