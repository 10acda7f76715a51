"""Topic option maps and the Kafka row mapping (the connector itself is not
installed here, so only what runs without a broker is tested)."""

import pytest
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir, scratch_dir
from vigil.sources.topics import kafka_reader_options, kafka_wire_rows, kafka_writer_options


def test_reader_options_subscribe_list_and_offsets():
    o = kafka_reader_options("b1:9092,b2:9092", "sensors-a,sensors-b", "latest", 750)
    assert o["kafka.bootstrap.servers"] == "b1:9092,b2:9092"
    assert o["subscribe"] == "sensors-a,sensors-b"
    assert o["startingOffsets"] == "latest"
    assert o["maxOffsetsPerTrigger"] == "750"


def test_writer_options_wait_for_all_replicas():
    o = kafka_writer_options("b1:9092", "sensors-scored")
    assert o["topic"] == "sensors-scored" and o["kafka.acks"] == "all"


def test_kafka_rows_of_two_topics_keep_apart_and_in_order(spark):
    rows = [("sensors-b", 0, 5, "2024-01-01 00:00:00.000001"), ("sensors-a", 0, 5, "2024-01-01 00:00:00.000001"),
            ("sensors-a", 0, 6, "2024-01-01 00:00:00.000001"), ("sensors-a", 1, 0, "2024-01-01 00:00:02"),
            ("sensors-a", 0, 12, "2024-01-01 00:00:01"), ("sensors-a", 0, 9, "2024-01-01 00:00:01")]
    df = spark.createDataFrame([(b"k", b'{"stateCode":"1"}', *r) for r in rows],
                               "key binary, value binary, topic string, partition int, offset long, t string")
    df = df.withColumn("timestamp", F.to_timestamp("t"))
    out = sorted(kafka_wire_rows(df).collect(), key=lambda r: (r.seq, r.place))
    assert len({(r.seq, r.place) for r in out}) == len(rows)
    assert [(r.place.split(":")[0], int(r.place.split(":")[2])) for r in out] == [
        ("sensors-a", 5), ("sensors-a", 6), ("sensors-b", 5), ("sensors-a", 9), ("sensors-a", 12), ("sensors-a", 0)]
    assert out[0].key == "k" and out[0].value == '{"stateCode":"1"}'


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    with pytest.raises(RuntimeError):
        scratch_dir(Session(), "x")
