"""The ordered streaming source: batches by position, ties, nulls, resuming."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.operators.score import score
from vigil.session import scratch_dir
from vigil.sources.replay import BIN_ROWS, ReplayReader, last_position, stage
from vigil.sources.tables import events_records, typed
from vigil.sources.topics import wire_rows
from vigil.streaming import scorer as SC

COLS = ["device_key", "seq", "record_number", "prediction", "error", "anomaly", "predictionNext"]


def _wire(spark):
    return wire_rows(events_records(spark, SF_SMALL))


def _sizes(done):
    return [p["numInputRows"] for p in done if p["numInputRows"]]


def test_one_query_in_order_and_resumed(spark):
    sink, ck = scratch_dir(spark, "sink"), scratch_dir(spark, "ck")
    wire = _wire(spark).orderBy(F.rand(3))
    staged = stage(wire)
    assert _sizes(SC.replay_ordered(wire, sink, ck, 150, staged=staged, max_batches=2)) == [150, 150]
    assert last_position(spark, ck) == 300
    assert _sizes(SC.replay_ordered(wire, sink, ck, 200, staged=staged)) == [200, 200, 200, 100]
    assert SC.replay_ordered(wire, sink, ck, 200, staged=staged) == []
    got = SC.read_enriched(spark, sink).select(*COLS)
    exp = score(typed(events_records(spark, SF_SMALL))).select(*COLS)
    assert got.count() == 1000 and got.exceptAll(exp).count() == 0


def test_equal_and_null_order_values_are_cut_by_position(spark):
    sink, ck = scratch_dir(spark, "sink"), scratch_dir(spark, "ck")
    wire = _wire(spark).withColumn("seq", F.when(F.col("seq") % 2 == 0, F.lit(7)))
    assert _sizes(SC.replay_ordered(wire, sink, ck, 300)) == [300, 300, 300, 100]
    none = _wire(spark).withColumn("seq", F.lit(None).cast("long"))
    folder, n = stage(none)
    assert n == 1000
    place = spark.read.parquet(folder).select("position")
    assert place.distinct().count() == 1000 and place.agg(F.max("position")).first()[0] == 999


def test_no_rows(spark):
    sink, ck = scratch_dir(spark, "sink"), scratch_dir(spark, "ck")
    assert SC.replay_ordered(_wire(spark).filter("false"), sink, ck, 10) == []


def test_tasks_stay_within_bins():
    reader = ReplayReader({"path": "x", "rows": "5", "total": "12"})
    assert [reader.latestOffset()["position"] for _ in range(4)] == [5, 10, 12, 12]
    cuts = reader.partitions({"position": BIN_ROWS - 3}, {"position": BIN_ROWS + 4})
    assert [(p.low, p.high) for p in cuts] == [(BIN_ROWS - 3, BIN_ROWS), (BIN_ROWS, BIN_ROWS + 4)]
    assert reader.partitions({"position": 4}, {"position": 4}) == []


def test_a_batch_reads_its_row_groups_and_is_dealt_over_tasks(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    from vigil.sources import replay
    monkeypatch.setattr(replay, "GROUP_ROWS", 64)
    folder, n = stage(_wire(spark))
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folder.removeprefix('file:')}/bin=*/*.parquet")]
    assert n == 1000 and max(m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)) <= 64
    reader = ReplayReader({"path": folder, "rows": "5", "total": "1000"})
    cuts = reader.partitions({"position": 0}, {"position": 1000})
    assert len(cuts) == 16 and [c.low for c in cuts[1:]] == [c.high for c in cuts[:-1]]
    assert sum(b.num_rows for c in cuts for b in reader.read(c)) == 1000


def test_state_partitions_by_the_rows_of_a_batch(spark):
    import os
    most = spark.sparkContext.defaultParallelism
    assert [SC.partitions_for(spark, r) for r in (1, 4000, 1 << 30)] == [min(4, most), min(4, most), most]
    sink, ck = scratch_dir(spark, "sink"), scratch_dir(spark, "ck")
    SC.replay_ordered(_wire(spark), sink, ck, 1000)
    assert sum(d.isdigit() for d in os.listdir(f"{ck.removeprefix('file:')}/state/0")) == min(4, most)


def _starts(monkeypatch):
    """The streams that a query starts: what each drained."""
    from vigil.streaming import scorer
    seen = []
    plain = scorer.drain

    def counted(*args, **kw):
        seen.append(plain(*args, **kw))
        return seen[-1]

    monkeypatch.setattr(scorer, "drain", counted)
    return seen


def _small(monkeypatch, rows, most):
    from vigil.plans import queries as Q
    monkeypatch.setattr(Q, "SMALL_CHUNK", rows)
    monkeypatch.setattr(Q, "MAX_BATCHES", most, raising=False)
    return Q


@pytest.mark.parametrize("name", ["publish_rate", "batch_overruns"])
def test_batches_of_a_query_are_one_stream(spark, monkeypatch, name):
    Q, seen = _small(monkeypatch, 250, 2), _starts(monkeypatch)
    got = Q.QUERIES[name](spark, SF_SMALL).orderBy("batch_id").select("batch_id", "input_rows").collect()
    assert [tuple(r) for r in got] == [(k, 250) for k in range(4)]
    assert len(seen) == 1


@pytest.mark.parametrize("name", ["stream_last_n", "stream_state", "stream_window_summary"])
def test_larger_tables_do_not_make_more_batches(spark, monkeypatch, name):
    Q, seen = _small(monkeypatch, 50, 3), _starts(monkeypatch)
    made = Q.QUERIES[name](spark, SF_SMALL)
    assert made.count() > 0
    sizes = [p["numInputRows"] for p in seen[0] if p["numInputRows"]]
    assert len(seen) == 1 and sizes == [334, 334, 332]


def test_last_batch_stays_when_those_before_grow(spark, monkeypatch):
    Q, seen = _small(monkeypatch, 30, 3), _starts(monkeypatch)
    got = {r.device_key for r in Q.q_stream_state_changes(spark, SF_SMALL).collect()}
    last = Q._wire(spark, SF_SMALL).orderBy(F.desc("seq")).limit(1000 % 30)
    assert got == {r.key for r in last.select("key").collect()}
    assert len(seen) == 2 and [len([p for p in s if p["numInputRows"]]) for s in seen] == [3, 1]


def test_bad_records_have_as_many_keys_as_the_state_has_partitions(spark, monkeypatch):
    from vigil.sources.tables import junk_records, junk_wire
    seen, plain = [], SC.through_state
    monkeypatch.setattr(SC, "through_state", lambda *args, **kw: seen.append(kw.get("lanes")) or plain(*args, **kw))
    sink, ck = scratch_dir(spark, "sink"), scratch_dir(spark, "ck")
    wire = junk_wire(wire_rows(junk_records(events_records(spark, SF_SMALL))))
    SC.replay_ordered(wire, sink, ck, 500)
    assert seen == [SC.partitions_for(spark, 500)] and seen[0] < SC.LANES
    assert SC.read_enriched(spark, sink).count() + SC.read_quarantined(spark, sink).count() == 1000
    assert SC.read_quarantined(spark, sink).count() == 150
