"""Edge cases of FIXTURES.md F7 on small inline rows."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from vigil.functions import columns as C
from vigil.functions.encoders import scalar_bucket, season_bits
from vigil.operators import quality as Q
from vigil.operators import reports as R
from vigil.operators.score import score
from vigil.schema import ENRICHED_SCHEMA, RAW_FIELDS
from vigil.sources import lines as L
from vigil.sources.tables import typed


def _raw(spark, rows, seqs=None):
    seqs = seqs or list(range(len(rows)))
    schema = "seq long, " + ", ".join(f"{f} string" for f in RAW_FIELDS)
    return spark.createDataFrame([(s,) + tuple(r.get(f) for f in RAW_FIELDS) for s, r in zip(seqs, rows)],
                                 schema)


def _rec(**kw):
    base = dict(stateCode="36", countyCode="001", siteNum="0001", parameterCode="44201", poc="1",
                dateGMT="2015-03-31", timeGMT="10:00", sampleMeasurement="0.05")
    base.update(kw)
    return base


def test_json_round_trip_of_reference_record(spark):
    """The reference's own serde test: only stateName and predictionNext set."""
    row = tuple("NY" if f == "stateName" else None for f in RAW_FIELDS) + (0.0, 0.0, 0.0, 0.555)
    df = spark.createDataFrame([row], ENRICHED_SCHEMA)
    enc = df.select("*", C.json_encode().alias("v"))
    text = enc.first()["v"]
    assert '"uncertainty":null' in text and '"predictionNext":0.555' in text
    dec = enc.select("*", C.json_decode("v").alias("d"))
    assert dec.select(C.null_safe_equal_all("", "d.").alias("eq")).first()["eq"]


def test_json_unknown_property_detected(spark):
    df = spark.createDataFrame([('{"stateCode":"1","bogus":2}',)], "v string")
    assert df.select(C.json_unknown_keys("v").alias("u")).first()["u"] == ["bogus"]


def test_null_key_part_not_shortened(spark):
    df = _raw(spark, [_rec(poc=None)]).select(C.device_key().alias("k"))
    assert df.first()["k"] == "36-001-0001-44201-null"


def test_line_widths(spark):
    base = ",".join(["a"] * 24)
    lines = [base, base + ",0.1,0.2,0.3,0.4", base + ",x,y", ",".join(["a"] * 10),
             base + ",0.1,0.2,x,0.4", ",".join(["a"] * 17 + [""] + ["a"] * 6)]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, value string")
    out = {r.i: r for r in L.map_records(df).collect()}
    assert (out[0].prediction, out[0].predictionNext, out[0].reason) == (0.0, 0.0, None)
    assert (out[1].prediction, out[1].error, out[1].anomaly, out[1].predictionNext) == (0.1, 0.2, 0.3, 0.4)
    assert (out[2].prediction, out[2].reason, out[2].fields) == (0.0, None, 26)
    assert out[3].reason == "short_line"
    assert out[4].reason == "bad_result_field"
    assert out[5].qualifier == ""


def test_csv_header_skip(spark):
    path = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write(",".join(RAW_FIELDS) + "\n")
        f.write(",".join(["x"] * 17 + [""] + ["x"] * 6) + "\n")
    assert L.read_csv(spark, path, skip_header=True).count() == 1
    assert L.read_csv(spark, path, skip_header=False).count() == 2
    assert L.read_csv(spark, path, skip_header=True).first()["qualifier"] == ""


def test_quarantine_reasons_and_padded_number(spark):
    rows = [_rec(sampleMeasurement="abc"), _rec(timeGMT="99:99"), _rec(sampleMeasurement=" 0.05 ")]
    t = typed(_raw(spark, rows))
    reasons = [r.reason for r in Q.classify(t).collect()]
    assert sorted(reasons) == ["bad_measurement", "bad_time", "ok"]
    good, bad = Q.split_quarantine(t)
    assert good.first()["measurement"] == 0.05
    assert bad.count() == 2


def test_clipping_buckets(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.1,), (5.0,)], "x double")
    assert [r.b for r in df.select(scalar_bucket("x").alias("b")).collect()] == [0, 0, 100, 100]


def test_month_ends(spark):
    df = spark.createDataFrame([("2015-03-31",), ("2015-04-01",), ("2015-1",)], "d string")
    assert [r.m for r in df.select(C.month_bucket("d", 10).alias("m")).collect()] == [9, 0, None]


def test_month_bucket_table(spark):
    """01,10->7; 02,11->8; 03,12->9; 04->0 ... 09->5; 6 never used."""
    months = [f"2015-{m:02d}-01" for m in range(1, 13)]
    df = spark.createDataFrame([(d,) for d in months], "d string")
    got = [r.m for r in df.select(C.month_bucket("d", 10).alias("m")).collect()]
    assert got == [7, 8, 9, 0, 1, 2, 3, 4, 5, 7, 8, 9]


def test_season_wraps(spark):
    df = spark.createDataFrame([("2015-01-01 00:00:00",), ("2015-12-31 00:00:00",)], "t string") \
        .select(season_bits(F.to_timestamp("t")).alias("s"))
    for r in df.collect():
        assert len(set(r.s)) == 31 and min(r.s) >= 0 and max(r.s) < 124


def _score_rows(spark, values, times=None, seqs=None):
    rows = []
    for i, v in enumerate(values):
        t = times[i] if times else f"{i // 60:02d}:{i % 60:02d}"
        rows.append(_rec(sampleMeasurement=str(v), timeGMT=t))
    return score(typed(_raw(spark, rows, seqs)), plan="window").orderBy("seq").collect()


def test_single_and_two_record_device(spark):
    one = _score_rows(spark, [0.05])
    assert (one[0].prediction, one[0].error, one[0].anomaly) == (0.0, 0.0, 0.0)
    assert one[0].predictionNext == pytest.approx(0.05)
    two = _score_rows(spark, [0.05, 0.07])
    assert all(r.error == 0.0 and r.anomaly == 0.0 for r in two)


def test_same_minute_ordered_by_seq(spark):
    out = _score_rows(spark, [0.01, 0.02, 0.03], times=["10:00", "10:00", "10:00"], seqs=[30, 10, 20])
    by_seq = {r.seq: r.record_number for r in out}
    assert by_seq == {10: 0, 20: 1, 30: 2}


def test_tie_in_mode_most_recent_wins(spark):
    # 10 -> 20, then 10 -> 30: both once; the later (30) wins for the last 10
    out = _score_rows(spark, [0.010, 0.020, 0.010, 0.030, 0.010])
    assert out[-1].predictionNext == pytest.approx(0.030)


def test_display_cap_keeps_501(spark):
    df = spark.range(502).select(F.col("id").alias("seq"), F.col("id").cast("timestamp").alias("event_time"),
                                 F.lit(0.0).alias("anomaly"))
    kept = R.last_n(df).select("seq").collect()
    assert len(kept) == 501 and min(r.seq for r in kept) == 1


def test_strict_decode_rejects_unknown_property(spark):
    good = spark.createDataFrame([('{"stateCode":"1"}',)], "v string")
    assert good.select(C.json_decode_strict("v").alias("r")).first()["r"]["stateCode"] == "1"
    bad = spark.createDataFrame([('{"stateCode":"1","bogus":2}',)], "v string")
    with pytest.raises(Exception, match="unknown record property"):
        bad.select(C.json_decode_strict("v").alias("r")).collect()


def test_quoted_comma_is_one_field(spark):
    fields = ["a"] * 24
    fields[8] = '"Ozone, 8-hr"'
    df = spark.createDataFrame([(",".join(fields),)], "value string")
    r = L.map_records(df).first()
    assert r.fields == 24 and r.parameterName == "Ozone, 8-hr" and r.reason is None


def test_record_text_formats_like_the_reference(spark):
    row = tuple("NY" if f == "stateName" else None for f in RAW_FIELDS) + (0.0001, 0.5, 1.0, 0.555)
    text = spark.createDataFrame([row], ENRICHED_SCHEMA).select(C.record_text().alias("t")).first()["t"]
    assert text.startswith("MonitoringRecord [stateCode=null, countyCode=null,")
    assert "stateName=NY," in text
    assert text.endswith("prediction=1.0E-4, error=0.5, anomaly=1.0, predictionNext=0.555]")


def test_line_with_commas_and_quotes_comes_back(spark):
    rec = _rec(parameterName='Ozone, "8-hr"', qualifier=" padded ", unitsOfMeasure="")
    df = C.with_zero_results(_raw(spark, [rec]))
    r = L.map_records(L.record_lines(df)).first()
    assert (r.fields, r.reason, r.parameterName, r.qualifier) == (28, None, 'Ozone, "8-hr"', " padded ")


def test_json_outcomes(spark):
    rows = [('{"stateCode":"1"}', "ok"), ('{"stateCode":"1","bogus":2}', "unknown_property"), ("not json", "malformed"), (None, "malformed")]
    df = spark.createDataFrame(rows, "v string, o string")
    assert df.filter(C.json_outcome("v") != F.col("o")).count() == 0


def test_two_digit_years(spark):
    df = spark.createDataFrame([("15-03-31", "10:00"), ("2015-03-31", "10:00"), ("5-3-31", "10:00"), ("15/03/31", "10:00"), (None, "10:00")],
                               "d string, t string")
    out = [r.x for r in df.select(F.date_format(C.event_time("d", "t"), "yyyy-MM-dd HH:mm").alias("x")).collect()]
    assert out == ["2015-03-31 10:00", "2015-03-31 10:00", None, None, None]


def _diff(spark, left, right, **kw):
    from vigil.operators.quality import record_diff
    schema = "k string, n long, a string, b double"
    got = record_diff(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k", "n"], ["a", "b"], **kw)
    return sorted(((str(r.k), r.n, r.side, r.fields_differing) for r in got.collect()), key=str)


def test_record_diff_with_null_and_repeated_keys(spark):
    rows = [("d", None, "x", 1.0), ("d", 1, "x", None), ("d", 1, "x", None), ("d", 1, "y", 2.0), (None, None, None, None)]
    assert _diff(spark, rows, rows) == []
    assert _diff(spark, rows, rows[::-1], plan="blocked", blocks=3) == []
    changed = [("d", None, "z", 1.0), ("d", 1, "x", None), ("d", 1, "y", 2.0), ("d", 1, "y", 2.0), ("e", 1, "q", None)]
    exp = [("None", None, "left_only", 0), ("d", 1, "changed", 2), ("d", None, "changed", 1), ("e", 1, "right_only", 1)]
    for kw in ({}, {"plan": "blocked", "blocks": 3}):
        assert sorted(_diff(spark, rows, changed, **kw), key=str) == sorted(exp, key=str)


def test_record_diff_keeps_every_copy(spark):
    got = _diff(spark, [("d", 1, "x", 1.0)] * 5, [("d", 1, "x", 1.0)] * 2)
    assert got == [("d", 1, "left_only", 2)] * 3
