"""The scoring stream: any folder, any batching, quarantine, strictness, pacing,
state TTL, progress kept past Spark's own history."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.operators.score import score
from vigil.session import scratch_dir
from vigil.settings import ScoreSettings
from vigil.sources.tables import events_records, junk_records, junk_wire, typed
from vigil.sources.topics import chunks, publish, read_landing_stream, wire_rows
from vigil.streaming import scorer as SC
from vigil.streaming import windows as W

COLS = ["device_key", "seq", "record_number", "prediction", "error", "anomaly", "predictionNext"]


def _batch(spark):
    return score(typed(events_records(spark, SF_SMALL)), plan="window").select(*COLS)


def _same(got, exp, n=1000):
    assert got.count() == exp.count() == n
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def _dirs(spark, *names):
    return [scratch_dir(spark, n) for n in names]


def test_two_landing_folders_equal_batch(spark):
    wire = wire_rows(events_records(spark, SF_SMALL))
    a, b, sink, ck = _dirs(spark, "land-a", "land-b", "sink", "ck")
    one = F.col("key").startswith("00") | F.col("key").startswith("01")
    publish(wire.filter(one), a)
    publish(wire.filter(~one), b)
    SC.run_scoring(spark, f"{a},{b}", sink, ck)
    _same(SC.read_enriched(spark, sink).select(*COLS), _batch(spark))


def test_replay_in_chunks_through_a_file_uri(spark, tmp_path):
    """Order comes from the chunks, not from file times: the landing folder's
    files all get one time, and the path is a URI."""
    sink, ck = _dirs(spark, "sink", "ck")
    wire = wire_rows(events_records(spark, SF_SMALL)).orderBy(F.rand(3))
    done = SC.replay(wire, f"file:{tmp_path}/landing", sink, ck, chunk_rows=300)
    assert [p["batchId"] for p in done if p["numInputRows"]] == [0, 1, 2, 3]
    _same(SC.read_enriched(spark, sink).select(*COLS), _batch(spark))


def test_restart_with_no_new_data_adds_nothing(spark):
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    publish(wire_rows(events_records(spark, SF_SMALL)), landing)
    SC.run_scoring(spark, landing, sink, ck)
    SC.run_scoring(spark, landing, sink, ck)
    assert SC.read_enriched(spark, sink).count() == 1000


def test_more_batches_asked_for_than_there_are(spark):
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    publish(wire_rows(events_records(spark, SF_SMALL)).coalesce(1), landing)
    SC.run_scoring(spark, landing, sink, ck, files_per_trigger=1, max_batches=50)
    assert SC.read_enriched(spark, sink).count() == 1000


@pytest.mark.parametrize("rows", [300, 1000, 5000])
def test_chunks_are_consecutive_and_complete(spark, rows):
    wire = wire_rows(events_records(spark, SF_SMALL)).withColumn("seq", F.when(F.col("seq") % 50 != 0, F.floor(F.col("seq") / 3)))
    top, total = None, 0
    for part in chunks(wire, rows):
        r = part.agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).first()
        # Cut by position: equal values may meet the cut, no part is larger for them.
        assert top is None or r.lo >= top
        assert r.n == min(rows, 1000 - total)
        top, total = r.hi, total + r.n
    assert total == 1000


def test_every_record_is_scored_or_quarantined(spark):
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    wire = junk_wire(wire_rows(junk_records(events_records(spark, SF_SMALL))))
    wire = wire.withColumn("value", F.when(F.col("seq") == 5, F.lit(None)).when(F.col("seq") == 6, F.lit("[1]")).otherwise(F.col("value")))
    SC.replay(wire, landing, sink, ck, chunk_rows=400)
    bad = SC.read_quarantined(spark, sink)
    assert SC.read_enriched(spark, sink).count() + bad.count() == 1000
    reasons = {r.seq: r.reason for r in bad.collect()}
    assert reasons[5] == reasons[6] == "bad_json"
    assert {reasons[k] for k in reasons if k % 20 == 3} == {"bad_measurement"}
    assert {reasons[k] for k in reasons if k % 20 == 7} == {"bad_time"}
    assert bad.filter("seq = 11").first().value == "not json"


def test_strict_stream_and_batch_fail_on_a_bad_record(spark):
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    recs = junk_records(events_records(spark, SF_SMALL))
    publish(wire_rows(recs), landing)
    with pytest.raises(Exception, match="record cannot be scored"):
        SC.run_scoring(spark, landing, sink, ck, strict=True)
    with pytest.raises(Exception, match="record cannot be scored: bad_"):
        score(typed(recs), strict=True).collect()
    assert score(typed(events_records(spark, SF_SMALL)), strict=True).count() == 1000


def test_replay_pauses_between_chunks(spark):
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    calls = []
    real, SC.time.sleep = time.sleep, lambda s: (calls.append(s), real(min(s, 0.1)))
    pace = ScoreSettings(replay_batch_size=400, replay_batch_sleep_ms=1234)
    try:
        done = SC.paced_replay(wire_rows(events_records(spark, SF_SMALL)), landing, sink, ck, pace, strict=True)
    finally:
        SC.time.sleep = real
    assert calls.count(1.234) == 2 and [p["numInputRows"] for p in done if p["numInputRows"]] == [400, 400, 200]


def test_progress_outlives_the_history_of_the_query(spark):
    landing, sink, ck, table = _dirs(spark, "landing", "sink", "ck", "progress")
    wire_rows(events_records(spark, SF_SMALL)).repartition(12).write.parquet(landing)  # a batch for each file
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        q = (read_landing_stream(spark, landing, 1).writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        SC.write_progress(spark, SC.drain(q, poll=0.01), table)
    finally:
        spark.conf.set(key, before)
    got = spark.read.parquet(table).filter("input_rows > 0").orderBy("batch_id").collect()
    files = len(spark.read.parquet(landing).inputFiles())
    assert [r.batch_id for r in got] == list(range(files)) and files > 2
    assert sum(r.input_rows for r in got) == 1000 and all(r.overrun == (r.trigger_ms > r.interval_ms) for r in got)


def test_state_ttl_keeps_results(spark):
    """With a state TTL the scorer runs on processing time (expired state is
    cleaned in no-data batches, which keep the query busy, so it is watched
    until every input row went through and then stopped)."""
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    publish(wire_rows(events_records(spark, SF_SMALL)), landing)
    q = SC.start_scoring(read_landing_stream(spark, landing), ck, "parquet", {"path": sink},
                         trigger="1 second", ttl_ms=3_600_000, strict=True)
    try:
        deadline = time.time() + 240
        while time.time() < deadline:
            if sum(p["numInputRows"] for p in q.recentProgress) >= 1000 and not q.status["isTriggerActive"]:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    _same(SC.read_enriched(spark, sink).select(*COLS), _batch(spark))


def test_late_rows_within_the_delay_count(spark):
    from vigil.operators.reports import window_summary
    scored = score(typed(events_records(spark, SF_SMALL)), keep=None)
    wire = SC.enriched_wire(scored).withColumn("reason", F.lit(None).cast("string"))
    topic, sink, ck = _dirs(spark, "topic", "sink", "ck")
    late = F.col("seq") % 9 == 4  # these come after everything else
    for part in (wire.filter(~late), wire.filter(late)):
        publish(part, topic)
        W.run_window_summary(spark, topic, sink, ck, delay="60 days")
    got = W.read_window_summary(spark, sink, ck)
    with_time = score(typed(events_records(spark, SF_SMALL)), keep=["event_time"])
    exp = window_summary(with_time)
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0
