"""The batch plans (window, segmented) and the stream against a plain
sequential model, including a device that holds every row."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from sequential_model import bucket, score_device
from vigil.functions.encoders import scalar_bucket
from vigil.operators.score import score
from vigil.settings import ScoreSettings
from vigil.sources.tables import events_records, typed


def _expected(pdf):
    exp = {}
    for key, g in pdf.sort_values(["device_key", "event_time", "seq"]).groupby("device_key", sort=False):
        for seq, n, p, e, a, pn in score_device(list(zip(g["seq"], g["measurement"]))):
            exp[(key, int(seq))] = (n, p, e, a, pn)
    return exp


def _check(scored_pdf, exp):
    assert len(scored_pdf) == len(exp)
    for r in scored_pdf.itertuples(index=False):
        n, p, e, a, pn = exp[(r.device_key, int(r.seq))]
        assert r.record_number == n
        assert r.prediction == pytest.approx(p, abs=1e-12)
        assert r.error == pytest.approx(e, abs=1e-12)
        assert r.anomaly == pytest.approx(a, abs=1e-12)
        assert r.predictionNext == pytest.approx(pn, abs=1e-12)


@pytest.mark.parametrize("plan,blocks", [("window", None), ("segmented", 5)])
def test_plans_match_sequential_model(spark, plan, blocks):
    t = typed(events_records(spark, SF_SMALL))
    out = score(t, plan=plan, blocks=blocks).toPandas()
    exp = _expected(t.select("device_key", "event_time", "seq", "measurement").toPandas())
    _check(out, exp)


def test_hot_device_segmented(spark):
    """One device holds all 10,000 rows: the segmented plan spreads it over
    blocks and still equals the sequential model."""
    t = typed(events_records(spark, SF_MID)).withColumn("device_key", F.lit("hot"))
    out = score(t, plan="segmented", blocks=7).toPandas()
    exp = _expected(t.select("device_key", "event_time", "seq", "measurement").toPandas())
    _check(out, exp)


def _ties(t):
    """``seq`` repeats, and is null for every tenth record."""
    return t.withColumn("seq", F.when(F.col("seq") % 10 != 0, F.floor(F.col("seq") / 2)))


@pytest.mark.parametrize("hot", [False, True])
def test_plans_keep_every_row_with_tied_and_null_seq(spark, hot):
    t = _ties(typed(events_records(spark, SF_SMALL)))
    if hot:
        t = t.withColumn("device_key", F.lit("hot"))
    win = score(t, plan="window")
    seg = score(t, plan="segmented", blocks=6)
    assert win.count() == seg.count() == t.count() == 1000
    assert win.exceptAll(seg).count() == 0 and seg.exceptAll(win).count() == 0


@pytest.mark.parametrize("plan,blocks", [("window", None), ("segmented", 5)])
def test_finer_encoders_take_more_words(spark, plan, blocks):
    """401 buckets: seven words of successor bits."""
    fine = ScoreSettings(scalar_resolution=0.00025)
    t = typed(events_records(spark, SF_SMALL))
    out = score(t, fine, plan=plan, blocks=blocks).toPandas()
    pdf = t.select("device_key", "event_time", "seq", "measurement").toPandas()
    exp = {}
    for key, g in pdf.sort_values(["device_key", "event_time", "seq"]).groupby("device_key", sort=False):
        for seq, n, p, e, a, pn in score_device(list(zip(g["seq"], g["measurement"])), res=0.00025):
            exp[(key, int(seq))] = (n, p, e, a, pn)
    _check(out, exp)


@settings(max_examples=200, deadline=None)
@given(st.floats(min_value=-1.0, max_value=1.0, allow_nan=False))
def test_bucket_in_range(x):
    b = bucket(x)
    assert 0 <= b <= 100
    if x <= 0:
        assert b == 0
    if x >= 0.1:
        assert b == 100


def test_bucket_spark_equals_python(spark):
    xs = [-1.0, 0.0, 0.0004999, 0.0005, 0.0015, 0.0499, 0.05, 0.0995, 0.1, 5.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", scalar_bucket("x").alias("b"))
    for r in df.collect():
        assert r.b == bucket(r.x)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=100), min_size=1, max_size=60))
def test_running_mode_prefers_most_recent_on_ties(seq_buckets):
    rows = [(i, b * 0.001) for i, b in enumerate(seq_buckets)]
    out = score_device(rows)
    # predictionNext is always a bucket value that followed the current
    # bucket before, or the bucket itself
    for (seq, n, p, e, a, pn), b in zip(out, seq_buckets):
        followers = {seq_buckets[m + 1] for m in range(n) if seq_buckets[m] == b}
        assert round(pn / 0.001) in (followers or {b})
        assert 0.0 <= a <= 1.0
