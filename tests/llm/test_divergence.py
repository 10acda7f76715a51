"""Source divergence audit: against a plain version, tiles and blocks, edge cases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from vigil.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string"


def plain(rows, least=30, ranks=50):
    docs = [(lang or "", source or "",
             re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    df, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        df[lang].update(set(terms))
        count[lang, source].update(terms)
    out = []
    for lang in df.keys() | {g[0] for g in count}:
        kept = sorted(t for t, n in df[lang].items() if n >= least)
        groups = {s: c for (x, s), c in count.items() if x == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        ps, q = {s: p(c) for s, c in groups.items()}, p(whole)
        for s in groups:
            pairs = sorted(((-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o.encode()) for o in groups if o != s))
            terms = sorted((-(ps[s][t] - q[t]), t.encode()) for t in kept if groups[s][t] and ps[s][t] > q[t])[:ranks]
            out += [(lang, s, "pair", o.decode(), -f, k + 1) for k, (f, o) in enumerate(pairs)]
            out += [(lang, s, "term", t.decode(), -f, k + 1) for k, (f, t) in enumerate(terms)]
    return sorted(out)


def corpus(n=120, seed=4):
    rng = random.Random(seed)
    words = ["The", "the,", "cat", "dog's", "élan", "ÉLAN", "x1y", "(end)", "ß", "日本", "a b", "mañana"]
    rows = []
    for k in range(n):
        lang = rng.choice(["en", "en", "de", None])
        source = rng.choice(["s1", "s2", "s3", "s4", None, "ß"])
        own = words[:4] if source == "s1" else words
        rows.append((k, rng.choice([" ", "\n", "\t\x0b"]).join(rng.choice(own) for _ in range(rng.randrange(0, 9))), lang, source))
    return rows


@pytest.mark.parametrize("options", [{}, {"block_bytes": 100}, {"block_terms": 2, "tile_sources": 2}, {"ranks": 2}])
def test_equals_the_plain_version(frame, options):
    rows = corpus()
    got = D.audit(frame(rows, SCHEMA).repartition(3), least=4, **options).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, 4, options.get("ranks", 50))


def test_edge_cases(frame):
    rows = [(1, None, "en", "a"), (None, "", "en", "b"), (3, "one one", "en", "c"), (3, "one one", "en", "c"), (4, "w " * 100_000, "fr", "z"),
            (5, "12 34", "", ""), (6, None, None, None), (7, "tie Tie", "en", "a")]
    wide = [(*r, "x", "y", 1) for r in rows]
    got = D.audit(frame(wide, SCHEMA + ", _lang string, term string, block int"), least=1).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, 1)
    assert {r.value for r in D.audit(frame(rows, SCHEMA), least=50).collect()} == {0}
    assert D.audit(frame([], SCHEMA)).count() == 0


def test_repeated_rows_are_documents(frame):
    rows = [(1, "same text", "en", "a")] * 30 + [(2, "same other", "en", "b")] * 3
    assert sorted(tuple(r) for r in D.audit(frame(rows, SCHEMA)).collect()) == plain(rows)


def test_exact_beyond_doubles(spark):
    from pyspark.sql import functions as F
    n, total, terms = 9_007_199_254_740_993, 9_007_199_254_740_999, 3
    got = spark.range(1).select(D.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first().p
    assert got == 1 + 10 ** 9 * (n + 5) // (total + 5 * terms)
