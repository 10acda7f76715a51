"""Physical-plan checks: exchanges and scans of the main plans."""

import re

from conftest import SF_SMALL
from vigil.operators.score import score
from vigil.sources.tables import events_records, typed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (\w+\([^)]*\)|SinglePartition)", plan)


def test_window_plan_has_one_exchange(spark):
    df = score(typed(events_records(spark, SF_SMALL)), plan="window")
    ex = _exchanges(_plan(df))
    assert len(ex) == 1 and ex[0].startswith("hashpartitioning(device_key"), ex


def test_scan_reads_only_needed_columns(spark):
    df = typed(events_records(spark, SF_SMALL)).select("device_key", "measurement")
    plan = _plan(df)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == {"user_id", "event_type", "value"}, cols


def _checkpointed_plans(run) -> list[str]:
    from pyspark.sql.classic.dataframe import DataFrame
    plans = []
    orig = DataFrame.checkpoint

    def spy(self, eager=True):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return orig(self, eager)

    DataFrame.checkpoint = spy
    try:
        run()
    finally:
        DataFrame.checkpoint = orig
    return plans


def test_segmented_plan_moves_rows_only_to_place_blocks(spark):
    """The rows cross exactly two exchanges (range, then by block), both under
    the cached relation; every other exchange shuffles a small per-block table.
    Each row-level window runs once, payload included."""
    plan = _checkpointed_plans(lambda: score(typed(events_records(spark, SF_SMALL)), plan="segmented", blocks=4))[-1]
    lines = [re.sub(r"#\d+L?", "", x).strip(" :|+-") for x in plan.split("\n")]
    for i, x in enumerate(lines[:-1]):
        if x.startswith("Exchange"):
            assert not lines[i + 1].startswith("InMemoryTableScan"), (x, lines[i + 1])
    # The plan over the second cache: one window over all columns of the rows.
    wide = [x for x in lines if x.startswith("Window") and "lag(succ_1" in x]
    assert any(x.startswith("InMemoryTableScan") for x in lines) and len(wide) <= 2
    assert "Join" not in "".join(x for x in lines if "dateOfLastChange" in x and "SortMergeJoin" in x)


def test_blocks_are_even(spark):
    from pyspark.sql import functions as F
    from conftest import SF_MID
    from vigil.operators.score import with_bucket
    from vigil.operators.segmented import blocked_rows
    t = with_bucket(typed(events_records(spark, SF_MID)).select("device_key", "event_time", "seq", "measurement"))
    base = blocked_rows(t, 64)
    sizes = [r["count"] for r in base.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    base.unpersist()
    assert len(sizes) == 64 and max(sizes) <= 1.3 * sum(sizes) / 64


def test_positions_checkpoint_only_the_order(spark):
    from vigil.operators.reports import replay_batches
    plans = _checkpointed_plans(lambda: replay_batches(events_records(spark, SF_SMALL)))
    assert re.search(r"ReadSchema: struct<event_id:bigint>", plans[-1])


def test_last_n_per_device_scans_once(spark):
    from vigil.operators.reports import last_n_per_device
    df = last_n_per_device(score(typed(events_records(spark, SF_SMALL)), plan="window"))
    plan = _plan(df)
    assert plan.count("FileScan") == 1 and len(_exchanges(plan)) == 1


def test_months_are_scored_in_bounded_blocks(spark, monkeypatch):
    from conftest import SF_SMALL as sf
    from vigil.operators.score import score
    from vigil.plans import queries as Q
    monkeypatch.setattr(Q, "MONTH_BLOCK_ROWS", 100, raising=False)
    got = Q.q_score_months(spark, sf)
    rows = got.count()
    assert got.rdd.getNumPartitions() >= rows // 100
    exp = score(Q._typed_orders(spark, sf), plan="window").select(*Q.SCORE_COLS)
    assert rows == exp.count() and got.exceptAll(exp).count() == 0


def test_blocks_stay_in_place_when_no_carry_is_broadcast(spark):
    """Carries too large for a broadcast must not deal the rows anew: each block
    stays one task, whatever the session's number of shuffle partitions."""
    from datetime import datetime, timedelta
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    t0 = datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [(f"d{i % 3}", t0 + timedelta(minutes=i // 2), i, (i * i % 17) / 1000) for i in range(2000)],
        "device_key string, event_time timestamp, seq long, measurement double")
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        scored = []
        plan = _checkpointed_plans(lambda: scored.append(
            score(rows, plan="segmented", blocks=5, keep=["event_time"])))[-1]
        assert scored[0].rdd.getNumPartitions() == 5
    finally:
        for n in names:
            spark.conf.unset(n) if old[n] is None else spark.conf.set(n, old[n])
    assert not [x for x in _exchanges(re.sub(r"#\d+L?", "", plan)) if x.startswith("hashpartitioning(device_key, blk, ")]
    exp = score(rows, plan="window", keep=["event_time"])
    assert scored[0].count() == 2000 == exp.count() and scored[0].exceptAll(exp).count() == 0
