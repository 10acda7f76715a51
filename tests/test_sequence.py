"""Blocked sequence operators equal their window forms, also when one key
holds every row."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from vigil.operators.sequence import number_rows, previous_value, row_positions
from vigil.sources.tables import events_records, typed


@pytest.fixture(scope="module")
def rows(spark):
    t = typed(events_records(spark, SF_MID)).select("device_key", "seq", "arrival", "event_time")
    return t.withColumn("hot", F.lit("one"))


@pytest.mark.parametrize("key", ["device_key", "hot"])
def test_number_rows_blocked_equals_window(rows, key):
    w = number_rows(rows, [key], ["event_time", "seq"], plan="window").select("seq", "record_number")
    b = number_rows(rows, [key], ["event_time", "seq"], plan="blocked", blocks=7).select("seq", "record_number")
    assert w.exceptAll(b).count() == 0 and b.count() == w.count() == 10000


@pytest.mark.parametrize("key", ["device_key", "hot"])
def test_previous_value_blocked_equals_window(rows, key):
    w = previous_value(rows, [key], ["arrival"], "event_time", "p", plan="window").select("seq", "p")
    b = previous_value(rows, [key], ["arrival"], "event_time", "p", plan="blocked", blocks=5).select("seq", "p")
    assert w.exceptAll(b).count() == 0 and b.count() == 10000


def test_row_positions_are_a_permutation(rows):
    p = row_positions(rows, ["seq"], blocks=6)
    stats = p.agg(F.min("position").alias("lo"), F.max("position").alias("hi"),
                  F.count_distinct("position").alias("n")).first()
    assert (stats.lo, stats.hi, stats.n) == (0, 9999, 10000)
    # positions follow the order
    from pyspark.sql import Window
    chk = p.withColumn("r", F.row_number().over(Window.orderBy("seq")) - 1)
    assert chk.filter(F.col("r") != F.col("position")).count() == 0
