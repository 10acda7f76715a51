import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from vigil.llm import toxicity as T
from vigil.llm.queries import QUERIES


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    plain = ["".join(rng.choice(["an", "th", "er", "on", "st", "ou"]) for _ in range(rng.randrange(1, 5))) for _ in range(200)]
    bad = ["moronic", "scumbag", "trashy", "pathetic"]
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(plain) for _ in range(60)]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(bad)
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs, labels


def test_held_out_accuracy(frame):
    docs, labels = corpus()
    model = T.train(frame(docs), frame([x for x in labels if x[0] % 3], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in T.score(frame(docs), *model).collect()}
    held = [(got[i], y) for i, y in labels if i % 3 == 0]
    assert sum((s >= 0.3) == bool(y) for s, y in held) / len(held) > 0.95
    assert min(s for s, y in held if y) > max(s for s, y in held if not y) - 0.5


def test_query(spark, small, documents):
    got = QUERIES["op4_toxicity"](spark, small).collect()
    assert {r.doc_id for r in got} == set(documents) and len(got) == len(documents)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_edges(frame):
    docs, labels = corpus(60)
    docs += [(None, "scumbag trashy"), (900, None), (901, ""), (902, "x"), (903, "é" * 100_000), (904, "THE the"), (904, "THE the")]
    labels += [(None, 1), (5, None), (0, 0), (777, 1)]
    df = frame(docs).withColumn("score", F.lit("clash")).withColumn("label", F.lit(1))
    weights, b = T.train(df, frame(labels, "doc_id long, toxic int"))
    got = T.score(df, weights, b, keep=("doc_id", "score")).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    empty = [r.score for r in got if r.doc_id in (900, 901)]
    assert empty[0] == empty[1]
    assert len({r.score for r in got if r.doc_id == 904}) == 1


def test_one_class_and_empty_tables(frame):
    kind = "doc_id long, toxic int"
    docs = frame([(1, "a b c d e"), (2, "f g h")])
    assert {r.score for r in T.score(docs, *T.train(docs, frame([(1, 1)], kind))).collect()} == {1.0}
    zero = {r.score for r in T.score(docs, *T.train(docs, frame([], kind))).collect()}
    assert len(zero) == 1 and zero.pop() < 1e-9
    assert T.score(frame([]), *T.train(frame([]), frame([(1, 1), (2, 0)], kind))).collect() == []


def test_training_does_not_depend_on_partitions(frame):
    docs, labels = corpus(100)
    a = T.train(frame(docs).repartition(1), frame(labels, "doc_id long, toxic int"))
    b = T.train(frame(docs).repartition(7), frame(labels, "doc_id long, toxic int"))
    one = {r.doc_id: r.score for r in T.score(frame(docs), *a).collect()}
    two = {r.doc_id: r.score for r in T.score(frame(docs), *b).collect()}
    assert all(abs(one[k] - two[k]) < 1e-3 for k in one)


def plain_grams(text, buckets):
    """The buckets of a text, one code point after the other."""
    c = [(ord(x) * 2654435761 + 97) % 2**32 for x in f" {text.lower()} "]
    out = set()
    for n in T.SIZES:
        for k in range(len(c) - n + 1):
            h = c[k]
            for x in c[k + 1:k + n]:
                h = (h * 16777619 + x) % 2**32
            h ^= h >> 15
            out.add((h * (2246822519 + 2 * n)) % 2**32 * buckets >> 32)
    return out


def plain_model(texts, labels, buckets):
    """Counts, ratios and a dense logistic regression by Newton steps."""
    x = np.zeros((len(texts), buckets))
    for k, t in enumerate(texts):
        x[k, list(plain_grams(t, buckets))] = 1
    y = np.array(labels, float)
    share = [(x[y == c].sum(axis=0) + 1) / ((y == c).sum() + 2) for c in (0, 1)]
    ratio = np.log(share[1]) - np.log(share[0])
    x = np.hstack([x * ratio, np.ones((len(texts), 1))])
    beta = np.zeros(buckets + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.eye(buckets + 1), x.T @ (p - y) + beta)
        beta -= step / max(1, np.abs(step).max())
    assert np.abs(x.T @ (1 / (1 + np.exp(-x @ beta)) - y) + beta).max() < 1e-8
    return ratio, beta[:-1] * ratio, beta[-1]


def test_against_counts_ratios_and_a_dense_fit(frame):
    docs, labels = corpus(120, seed=9)
    docs[7] = (7, "é" + docs[7][1].upper() + " 𝔘")
    buckets = 512
    ratio, weights, b = plain_model([t for _, t in docs], [y for _, y in labels], buckets)
    grams = T.Grams(buckets)
    for _, t in docs:
        g = grams(t).tolist()
        assert len(g) == len(set(g)) and set(g) == plain_grams(t, buckets)
    got, constant = T.train(frame(docs).repartition(3), frame(labels, "doc_id long, toxic int"), buckets=buckets)
    assert np.abs(got - weights).max() < 0.02 and abs(constant - b) < 0.02
    rows = [grams(t) for _, t in docs]
    exact, constant = T.logistic(rows, np.array([y for _, y in labels], float), ratio, rounds=2000, tolerance=1e-9)
    assert np.abs(exact - weights).max() < 1e-5 and abs(constant - b) < 1e-5


def test_every_bucket_met_has_a_weight(frame):
    docs, labels = corpus(60)
    docs[10] = (10, docs[10][1] + " zyxwvutsrqp")  # toxic, once in the corpus
    weights, _ = T.train(frame(docs), frame(labels, "doc_id long, toxic int"))
    own = T.Grams(T.BUCKETS)("zyxwvutsrqp")
    assert (weights[own] != 0).mean() > 0.8 and weights[own].sum() > 0


def test_very_long_text(frame):
    docs, labels = corpus(60)
    docs.append((500, "clean words " * 100_000 + "moronic scumbag trashy pathetic"))
    got = T.score(frame(docs), *T.train(frame(docs), frame([*labels, (500, 1)], "doc_id long, toxic int"))).collect()
    assert len(got) == 61 and {r.doc_id: r.score for r in got}[500] > 0.3
