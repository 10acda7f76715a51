"""Streams over the enriched records, the change feed of the state, bucketed landing."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.operators.reports import window_summary
from vigil.operators.score import score
from vigil.session import scratch_dir
from vigil.settings import ScoreSettings
from vigil.sources.tables import events_records, landed, typed
from vigil.sources.topics import chunks, publish, wire_rows
from vigil.streaming import scorer as SC
from vigil.streaming import windows as W


def _dirs(spark, *names):
    return [scratch_dir(spark, n) for n in names]


def _topic(spark):
    wire = SC.enriched_wire(score(typed(events_records(spark, SF_SMALL))))
    return wire.withColumn("reason", F.lit(None).cast("string"))


def test_live_window_keeps_the_newest_rows(spark):
    s = ScoreSettings(display_window=4)
    topic, sink, ck = _dirs(spark, "topic", "sink", "ck")
    for part in chunks(_topic(spark), 400):
        publish(part, topic)
        W.run_live_window(spark, topic, sink, ck, s)
    got = W.read_live_window(spark, sink)
    scored = score(typed(events_records(spark, SF_SMALL)))
    newest = scored.groupBy("device_key").agg(F.max("record_number").alias("top"))
    exp = scored.join(newest, "device_key").filter("record_number > top - 5").select("device_key", *W.RING_FIELDS)
    got = got.select("device_key", *W.RING_FIELDS)
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0
    every = spark.read.parquet(sink).groupBy("device_key", "newest").count()
    assert every.agg(F.max("count")).first()[0] == 5


def test_windows_in_small_blocks(spark):
    """Every window comes out once, closed or open, whatever shares its block."""
    topic, sink, ck = _dirs(spark, "topic", "sink", "ck")
    s = ScoreSettings(summary_window="6 hours")
    for part in chunks(_topic(spark), 300):
        publish(part, topic)
        W.run_window_summary(spark, topic, sink, ck, s, delay="2 days", block_windows=3)
    got = W.read_window_summary(spark, sink, ck)
    exp = window_summary(score(typed(events_records(spark, SF_SMALL)), keep=["event_time"]), s)
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0
    assert 0 < W.open_windows(spark, ck).count() < got.count() == got.select("device_key", "window_start").distinct().count()


def test_changes_list_the_devices_of_a_batch(spark):
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    records = events_records(spark, SF_SMALL)
    some = F.col("stateCode") == "01"
    for part in (records.filter("seq < 500"), records.filter("seq >= 500").filter(some)):
        publish(wire_rows(part), landing)
        SC.run_scoring(spark, landing, sink, ck)
    got = SC.state_changes(spark, ck, 1, 1).collect()
    exp = {r.device_key for r in typed(records.filter("seq >= 500").filter(some)).collect()}
    assert {r.device_key for r in got} == exp and len(got) == len(exp)
    assert {r.device_key for r in SC.state_changes(spark, ck, 0, 1).collect()} > exp


def test_bucketed_rows_need_no_exchange(spark):
    rows = landed(typed(events_records(spark, SF_SMALL)), 4)
    scored = score(rows, plan="window")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    exp = score(typed(events_records(spark, SF_SMALL)))
    assert scored.exceptAll(exp).count() == 0 and scored.count() == exp.count()
