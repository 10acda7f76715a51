"""Every stage against its plain version on the stage's own input."""

import hashlib

import duckdb
import numpy as np
import pytest
from .test_bpe import MERGER
from .test_decontam import plain as plain_matches
from .test_linedup import plain as plain_lines
from .test_neardup import plain as plain_components
from .test_quality import verdicts

import corpus_pipeline
from vigil.llm import bpe
from vigil.llm import quality as Q

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF_SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return SF_SMALL, out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for df in stages[1][:-1]:
        assert sorted(df.columns) == sorted(COLUMNS)
    assert stages[1][0].schema["n_chars"].dataType == stages[1][2].schema["n_chars"].dataType


def test_quality_stage(stages):
    sf, (docs, kept, *_) = stages
    trusted = {i for (i,) in duckdb.sql(f"SELECT doc_id FROM '{sf}/labels.parquet' WHERE quality = 1").fetchall()}
    expected = {r[0] for r in verdicts(list(texts(docs).items()), trusted) if not r[6] and r[7] >= Q.THRESHOLD}
    assert texts(kept) == {i: t for i, t in texts(docs).items() if i in expected}


def test_line_stage(stages):
    before, after = stages[1][1:3]
    expected = {i: t for i, t, n, r, m in plain_lines(list(texts(before).items())) if n - r - m > 0 or n == 0}
    assert texts(after) == expected
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_stage(stages):
    before, after = stages[1][2:4]
    comps = plain_components(list(texts(before).items()), size=5)
    assert texts(after) == {i: t for i, t in texts(before).items() if comps[i] == i}


def test_near_stage_with_null_and_repeated_ids(spark, frame):
    text = {c: " ".join(f"{c}{k}" for k in range(60)) for c in "abcde"}
    rows = [(None, text["a"]), (None, text["a"]), (None, text["a"] + " end"),  # a group of null ids
            (None, text["b"]), (7, text["b"]),  # the id that is not null stays
            (3, text["c"]), (3, text["c"] + " end"), (3, text["c"]), (3, text["d"]),  # one id: a group and another text
            (9, text["e"]), (8, text["e"] + " end"), (None, None), (None, "")]
    got = corpus_pipeline.near_dedup(spark, frame(rows), "").collect()
    assert len([r for r in got if (r.text or "").startswith("a0 ")]) == 1
    assert len([r for r in got if (r.text or "").startswith("c0 ")]) == 1
    rest = sorted((r.doc_id or -1, r.text or "") for r in got if (r.text or "")[:2] not in ("a0", "c0"))
    assert rest == sorted([(7, text["b"]), (3, text["d"]), (8, text["e"] + " end"), (-1, ""), (-1, "")])


def test_decontamination_stage(stages):
    sf, out = stages
    before, after = out[3:5]
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    assert texts(after) == {i: t for i, t in texts(before).items() if not plain_matches(t, items)}


def test_encoding_stage(stages):
    before, after = stages[1][4:6]
    got = {r.doc_id: r for r in after.collect()}
    docs = texts(before)
    assert set(got) == set(docs)
    for i, t in docs.items():
        ids = bpe.encode_texts([t], MERGER)[0][0]
        assert got[i].n_tokens == len(np.frombuffer(ids, "<u4"))
        assert got[i].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_run_is_the_stages(spark, stages):
    sf, out = stages
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, out[-1].collect()))


CLASHING = ["kept", "score", "_s", "_w", "_t", "_did", "_row", "matches", "n_lines", "n_near", "place", "component_id", "a b", "_rest", "ids", "c0"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_other_columns_survive(spark, name, stage):
    """Columns named like those of the operators, and one with a blank, come back as they were."""
    import random
    from conftest import SF_SMALL
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    rng = random.Random(6)
    lines = ["\n".join(" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randrange(300)) for _ in range(12)) for _ in range(8))
             for _ in range(6)]
    rows = [(k, t) for k, t in enumerate(lines)] + [(None, lines[0]), (8, None), (9, ""), (10, (lines[1] + "\n") * 3), (10, "long " * 300_000)]
    full = [(i, t, "en", *[f"{c}-{k}" for c in CLASHING]) for k, (i, t) in enumerate(rows)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ["text", "lang", *CLASHING]]])
    docs = spark.createDataFrame(full, schema)
    got = stage(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    before = {r["kept"]: tuple(r)[2:] for r in docs.collect()}
    after = got.collect()
    assert all(before[r["kept"]] == tuple(r)[2:] for r in after)
    plain = stage(spark, docs.select("doc_id", "text"), SF_SMALL)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    if name != "near_dedup":  # there ties among equal rows go by the whole row
        assert sorted(map(key, after)) == sorted(map(key, plain.collect()))
    else:
        assert len(after) == plain.count()
    none = stage(spark, docs.filter(F.lit(False)), SF_SMALL)
    assert none.columns == docs.columns and none.count() == 0


def test_last_stage_with_other_columns(spark):
    from conftest import SF_SMALL
    docs = spark.createDataFrame([(1, "a b", 3, "x", "y")], "doc_id long, text string, n_tokens int, ids string, decoded string")
    assert [r.n_tokens for r in corpus_pipeline.encode(spark, docs, SF_SMALL).collect()] == [2]
    assert corpus_pipeline.encode(spark, docs.filter("false"), SF_SMALL).count() == 0
