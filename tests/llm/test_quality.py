import math
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from vigil.llm import quality as Q
from vigil.llm.common import table
from vigil.llm.queries import QUERIES

GAPS = re.compile(r"[\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = [w for w in GAPS.split(text) if w]
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for k, w in enumerate(windows) if often[w] > 1 for j in (k, k + 1, k + 2)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if GAPS.sub("", line):
            repeats += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), repeats, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def grams(text, buckets):
    """Bucket of each n-gram, with Spark's xxhash64 (seed 42, columns chained)."""
    words = [w.encode() for w in GAPS.split(text or "") if w]
    one = [xxhash.xxh64_intdigest(w, 42) for w in words]
    two = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(words, words[1:])]
    return [(h - (1 << 64) if h >> 63 else h) % buckets for h in one + two]


def verdicts(rows, trusted, buckets=Q.BUCKETS, alpha=Q.SMOOTHING):
    raw, target = Counter(), Counter()
    for i, text in rows:
        g = grams(text, buckets)
        raw.update(g)
        if i is not None and i in trusted:
            target.update(g)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    rho = n_raw / n_target if n_target else None
    out = []
    for i, text in rows:
        g = grams(text, buckets)
        s = sum(math.log((target[k] + alpha) * rho / (raw[k] + alpha * rho)) for k in g) / len(g) if g and rho else 0.0
        out.append((i, *base(text), s))
    return out


def check(got, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:7])
    got = sorted(((r.doc_id, *[r[c] for c in Q.BASE], r.score, r.kept) for r in got), key=key)
    expected = sorted(expected, key=key)
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g[:7] == e[:7]
        assert math.isclose(g[7], e[7], abs_tol=1e-9)
        assert g[8] == (not e[6] and g[7] >= Q.THRESHOLD)


def test_query_against_plain_version(spark, small, documents):
    trusted = {r.doc_id for r in Q.trusted_ids(table(spark, small, "labels")).collect()}
    check(QUERIES["op3_quality"](spark, small).collect(), verdicts(list(documents.items()), trusted))


def test_edges(spark, frame):
    rows = [(1, None), (2, ""), (3, " \n\x0b\x0c\r\t "), (4, "a b c a b c"), (4, "a b c a b c"), (None, "x y\nx y\n\nx  y"),
            (5, "word " * 30_000), (6, "é # <tag> | 100%\n漢字 漢字 漢字"), (7, "a a a a")]
    df = frame(rows).withColumn("score", F.lit("clash"))
    trusted = frame([(4,), (4,), (None,), (99,)], "doc_id long")
    got = Q.quality(df, trusted, keep=("doc_id", "score")).collect()
    check(got, verdicts(rows, {4}))


def test_empty_tables(spark, frame):
    none = frame([], "doc_id long")
    assert Q.quality(frame([]), none).collect() == []
    got = Q.quality(frame([(1, "a b " * 100)]), none).collect()
    assert got[0].score == 0.0 and got[0].base_failed and not got[0].kept


def test_no_python_in_the_plan(spark, small):
    plan = QUERIES["op3_quality"](spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_junk_goes_and_clean_documents_stay(spark, frame):
    clean = [(k, " ".join(f"w{(k * 7 + j * j) % 83}" for j in range(120))) for k in range(80)]
    junk = [(1000 + k, " ".join(f"w{(k * 7 + j * j) % 83}***" for j in range(120))) for k in range(20)]
    got = {r.doc_id: r for r in Q.quality(frame(clean + junk), frame([(k,) for k in range(40)], "doc_id long")).collect()}
    assert all(r.score > -0.1 for i, r in got.items() if i < 1000)
    assert all(r.score < -0.1 for i, r in got.items() if i >= 1000)


def test_a_filter_on_the_verdict_stays_above_the_expressions(spark, small):
    docs = table(spark, small, "documents")
    df = Q.quality(docs, Q.trusted_ids(table(spark, small, "labels")), keep=docs.columns).filter("kept")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(_g") == 1 and plan.index("Filter") < plan.index("Generate inline")


def test_rows_without_a_key_are_dealt_out(spark, frame):
    docs = frame([(None, f"text {k}") for k in range(200)] + [(k, f"text {k}") for k in range(5)])
    df = Q.ratio_table(docs, frame([(k,) for k in range(5)], "doc_id long"), "text", 64, 1.0)
    assert re.search(r"Exchange hashpartitioning\(doc_id#\d+L?, _salt#\d+", df._jdf.queryExecution().executedPlan().toString())


def test_exact_counts_are_left_to_texts_that_repeat(spark, frame):
    rows = [(1, "a b c d"), (2, "a\n\n\nb\n \n \t\nc"), (3, "a b\n\na b\n \n "), (4, "a b c a b c\n*$*"), (5, "\n\n"), (6, "a"), (7, "a b"),
            (8, "a b c"), (9, "x\u0085y \u3000 #\r\nx\u0085y \u3000 #\r\n")]
    df = Q.quality(frame(rows), frame([], "doc_id long"))
    check(df.collect(), verdicts(rows, set()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(_t" not in plan and plan.count("array_distinct(_h") == 1
