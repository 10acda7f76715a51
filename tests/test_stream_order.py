"""The scorer across micro-batches: reorder delay, late records, state from
history, one pass over the input, observed figures, very many rows of a device."""

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from vigil.operators.score import score
from vigil.session import scratch_dir
from vigil.settings import DEFAULT
from vigil.sources.tables import events_records, junk_records, junk_wire, typed
from vigil.sources.topics import chunks, publish, read_landing_stream, wire_rows
from vigil.streaming import scorer as SC
from vigil.streaming.model import BucketState, DeviceRows

COLS = ["device_key", "seq", "record_number", "prediction", "error", "anomaly", "predictionNext"]


def _batch(records):
    return score(typed(records), plan="window").select(*COLS)


def _same(got, exp):
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def _dirs(spark, *names):
    return [scratch_dir(spark, n) for n in names]


def test_rows_of_released_spans_are_late(spark):
    """Three micro-batches: the middle of the month last. Its first day is
    released already (its rows are late), everything else is scored in order."""
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    records = events_records(spark, SF_SMALL)
    day = F.substring("dateGMT", 9, 2).cast("int")
    device = F.col("parameterCode") == "44201"
    held_back = device & (day == 5)
    for part in (records.filter((day <= 20) & ~held_back), records.filter((day > 20) & ~held_back), records.filter(held_back)):
        publish(wire_rows(part), landing)
        SC.run_scoring(spark, landing, sink, ck, reorder="1 day")
    publish(SC.end_mark(spark), landing)
    SC.run_scoring(spark, landing, sink, ck, reorder="1 day")
    bad = SC.read_quarantined(spark, sink)
    late = records.filter(held_back)
    assert late.count() > 0 and {(r.seq, r.reason) for r in bad.collect()} == {(r.seq, "late") for r in late.collect()}
    assert {r.key for r in bad.collect()} == {r.device_key for r in typed(late).collect()}
    _same(SC.read_enriched(spark, sink).select(*COLS), _batch(records.filter(~held_back)))


def test_rows_wait_for_the_watermark(spark):
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    records = events_records(spark, SF_SMALL)
    publish(wire_rows(records), landing)
    SC.run_scoring(spark, landing, sink, ck, reorder="3 days", span="1 day")
    newest = typed(records).agg(F.max("event_time")).first()[0]
    got = SC.read_enriched(spark, sink)
    held = typed(records).filter(F.col("event_time") >= F.date_trunc("day", F.lit(newest) - F.expr("INTERVAL 3 DAYS")))
    assert got.count() == 1000 - held.count() and 0 < held.count() < 1000


def test_history_then_stream_with_devices_on_one_side_only(spark):
    records = events_records(spark, SF_SMALL)
    old = F.col("seq") < 600
    only_old, only_new = F.col("parameterCode") == "44201", F.col("parameterCode") == "42401"
    records = records.filter((old & ~only_new) | (~old & ~only_old))
    past = score(typed(records.filter(old)))
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    SC.replay(wire_rows(records.filter(~old)), landing, sink, ck, 150, history=SC.history_state(past))
    _same(past.select(*COLS).unionByName(SC.read_enriched(spark, sink).select(*COLS)), _batch(records))


def test_history_of_one_row(spark):
    records = events_records(spark, SF_SMALL)
    first = typed(records).groupBy("device_key").agg(F.min("seq").alias("first"))
    rows = typed(records).join(first, "device_key")
    past = score(rows.filter("seq = first"))
    assert past.agg(F.max("record_number")).first()[0] == 0
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    SC.replay(wire_rows(rows.filter("seq > first")), landing, sink, ck, 1000, history=SC.history_state(past))
    _same(past.select(*COLS).unionByName(SC.read_enriched(spark, sink).select(*COLS)), _batch(records))


def test_input_is_read_once(spark):
    landing, sink, ck = _dirs(spark, "landing", "sink", "ck")
    wire = junk_wire(wire_rows(junk_records(events_records(spark, SF_SMALL))))
    publish(wire, landing)
    q = SC.start_scoring(read_landing_stream(spark, landing), ck, "parquet", {"path": sink}, None)
    done = SC.drain(q)
    plan = q._jsq.explainInternal(False)
    physical = plan[plan.index("== Physical Plan =="):] if "== Physical Plan ==" in plan else plan
    assert physical.count("FileScan") == 1 and physical.count("TransformWithStateInP") == 1
    assert sum(p["numInputRows"] for p in done) == 1000


def test_observed_figures(spark):
    landing, sink, ck, table = _dirs(spark, "landing", "sink", "ck", "metrics")
    wire = junk_wire(wire_rows(junk_records(events_records(spark, SF_SMALL))))
    done = SC.replay(wire, landing, sink, ck, 400)
    SC.write_metrics(spark, done, table)
    got = spark.read.parquet(table).orderBy("batch_id").collect()
    rows, bad = SC.read_enriched(spark, sink), SC.read_quarantined(spark, sink)
    assert [r.input_rows for r in got] == [400, 400, 200] and all(r.good + r.bad == r.input_rows for r in got)
    assert sum(r.good for r in got) == rows.count() and sum(r.bad for r in got) == bad.count()
    assert sum(r.error_sum for r in got) == pytest.approx(rows.agg(F.sum("error")).first()[0])
    assert max(r.error_max for r in got) == rows.agg(F.max("error")).first()[0]


def test_ttl_and_reorder_exclude_each_other(spark):
    wire = wire_rows(events_records(spark, SF_SMALL)).withColumn("place", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="one of them"):
        SC.through_state(SC.decoded(wire), ttl_ms=1000, reorder="1 day")


def test_chunks_of_an_all_null_order(spark):
    wire = wire_rows(events_records(spark, SF_SMALL)).withColumn("seq", F.lit(None).cast("long"))
    sizes = [part.count() for part in chunks(wire, 300)]
    assert sizes == [300, 300, 300, 100]


def _rows(m, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.integers(0, 12, m) * 0.009, 3)
    return rng.integers(0, m // 3 + 1, m), rng.integers(0, 5, m), x, np.floor((np.clip(x, 0, .1) + .0005) / .001).astype(int)


def _score(m, slice_rows, batch=1000):
    time, seq, x, b = _rows(m)
    rows = DeviceRows(slice_rows)
    for at in range(0, m, batch):
        own = slice(at, at + batch)
        n = len(x[own])
        rows.add(time[own], seq[own], pa.nulls(n, pa.string()), x[own], b[own], pa.array([str(k) for k in range(at, at + n)]))
    made, last, changed = rows.score(None, lambda _: BucketState(), DEFAULT)
    out = [np.concatenate(c) for c in zip(*([batch.column("value").to_numpy(zero_copy_only=False), *v] for batch, *v in made))]
    return out, last, {k: v.columns() for k, v in changed.items()}


def test_slices_do_not_change_the_rows():
    one, last, changed = _score(5000, 10 ** 6)
    for slice_rows in (7, 1000):
        some, last_2, changed_2 = _score(5000, slice_rows)
        assert all((a == b).all() for a, b in zip(one, some)) and last == last_2 and changed == changed_2
    assert one[0].tolist() == [str(k) for k in range(5000)] and sorted(one[1].tolist()) == list(range(5000))


def test_places_break_ties():
    rows = DeviceRows()
    rows.add(np.zeros(3), np.zeros(3), pa.array(["t:2", "t:1", None]), np.array([.1, .2, .3]), np.array([1, 2, 3]), pa.array(["a", "b", "c"]))
    made, _, _ = rows.score(None, lambda _: BucketState(), DEFAULT)
    batch, n, *_ = next(made)
    assert dict(zip(batch.column("value").to_pylist(), n.tolist())) == {"c": 0, "b": 1, "a": 2}


MEMORY = """
import resource, sys
import numpy as np, pyarrow as pa
from vigil.settings import DEFAULT
from vigil.streaming.model import BucketState, DeviceRows
m, batch = int(sys.argv[1]), 10_000
rng = np.random.default_rng(0)
text = '{"stateCode":"01","countyCode":"001","sampleMeasurement":"%s","parameterName":"view","unitsOfMeasure":"Parts per million"}'
rows = DeviceRows()
for at in range(0, m, batch):
    x = rng.integers(0, 101, batch) / 1000
    rows.add(np.arange(at, at + batch) // 3, np.arange(at, at + batch), pa.nulls(batch, pa.string()), x,
             np.floor((x + .0005) / .001).astype(int), pa.array([text % v for v in x.tolist()]))
made, last, changed = rows.score(None, lambda _: BucketState(), DEFAULT)
n = sum(b.num_rows for b, *_ in made)
assert n == m and last[0] == m - 1
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


def test_ten_million_rows_of_a_device_in_a_gigabyte():
    env = {**os.environ, "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", MEMORY, "10000000"], env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[-1]) < 1000, out.stdout
