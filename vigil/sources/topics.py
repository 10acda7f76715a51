"""Topic sources and the file landing folder that stands in for them.

On a cluster the raw and enriched records travel through topics:
``kafka_reader_options`` / ``kafka_writer_options`` give the option maps for
Spark's Kafka source and sink (key = device key, value = JSON record). The
Kafka connector is not on this machine, so tests and queries use a landing
folder of Parquet wire rows instead: ``publish`` adds rows to it, ``chunks``
cuts rows into consecutive parts so that ``streaming.scorer.replay`` can publish
and score them in order. Nothing relies on file times or on local paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import columns as C
from vigil.operators.sequence import row_positions
from vigil.schema import WIRE_SCHEMA
from vigil.settings import DEFAULT, ScoreSettings


#: Records of a micro-batch from topics, unless the caller says otherwise.
OFFSETS_PER_TRIGGER = 1_000_000


def kafka_reader_options(servers: str, topics: str, starting_offsets: str = "latest",
                         max_offsets_per_trigger: int | None = OFFSETS_PER_TRIGGER) -> dict[str, str]:
    """Subscribe to a comma-separated topic list. The starting offsets apply
    on the first start only; later starts resume from the checkpoint. A
    micro-batch takes at most ``max_offsets_per_trigger`` records (None: all
    there are), so a first start on a long topic is not one batch."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topics,
            "startingOffsets": starting_offsets, "failOnDataLoss": "true"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_writer_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}


def read_kafka(spark: SparkSession, servers: str, topics: str, **kw) -> DataFrame:
    """Streaming wire rows from topics (needs the Kafka connector; not
    available on this machine, so untested here)."""
    return kafka_wire_rows(spark.readStream.format("kafka")
                           .options(**kafka_reader_options(servers, topics, **kw)).load())


def wire_rows(records: DataFrame, s: ScoreSettings = DEFAULT) -> DataFrame:
    """(key, value, partition): the device key, the JSON record with all 28
    fields (zero results where absent), and the month partition the raw
    topic's partitioner picks."""
    df = C.with_zero_results(records)
    return df.select(C.device_key().alias("key"), C.json_encode().alias("value"),
                     C.month_bucket("dateGMT", s.month_partitions).alias("partition"),
                     *[c for c in ("seq",) if c in df.columns])


def publish_kafka(wire: DataFrame, servers: str, topic: str, partitions: int | None = None) -> None:
    """Batch publish of wire rows to a topic (key = device key, value = JSON
    record). With ``partitions`` the topic partition is the row's
    ``partition`` column (the month bucket); otherwise the producer hashes
    the key. Needs the Kafka connector (not on this machine: untested)."""
    cols = [F.col("key"), F.col("value")]
    if partitions:
        cols.append(F.pmod(F.col("partition"), F.lit(partitions)).alias("partition"))
    (wire.select(*cols).write.format("kafka").options(**kafka_writer_options(servers, topic)).save())


def decode_wire(wire: DataFrame) -> DataFrame:
    """JSON value back to the 28 record fields (key kept)."""
    return wire.select("key", C.json_decode("value").alias("r")).select("key", "r.*")


def publish(wire: DataFrame, path: str, order: str = "seq") -> None:
    """Add wire rows to a landing folder: a range exchange over ``order`` into
    as many tasks as the session deals shuffles to (merged by size at run
    time), each writing its range sorted."""
    wire.repartitionByRange(order).sortWithinPartitions(order).write.mode("append").parquet(path)


def chunks(wire: DataFrame, chunk_rows: int, order: str = "seq"):
    """Consecutive parts of ``chunk_rows`` rows (the last one fewer) in ``order``,
    nulls first. Rows are cut by their position in that order, so a part has no
    more rows where values repeat or are null. The rows are staged once, by
    position, and a part reads only the row groups of its own; nothing but the
    number of rows comes to the driver."""
    from vigil.session import scratch_dir
    spark = wire.sparkSession
    n = wire.count()
    if n <= chunk_rows:
        yield wire
        return
    staged = scratch_dir(spark, "staged")
    row_positions(wire, [order], "_position", keep=wire.columns).write.parquet(staged)
    placed = spark.read.parquet(staged)
    at = F.col("_position")
    for low in range(0, n, chunk_rows):
        yield placed.filter((at >= low) & (at < low + chunk_rows)).select(*wire.columns)


def read_landing_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream the landing folder's wire rows; with ``files_per_trigger`` at
    most so many files per micro-batch (in no promised order). A
    comma-separated list of folders is read as one stream (like a
    multi-topic subscription)."""
    schema = T.StructType(WIRE_SCHEMA.fields + [T.StructField("partition", T.IntegerType()),
                                                T.StructField("seq", T.LongType())])
    options = {"maxFilesPerTrigger": str(files_per_trigger)} if files_per_trigger else {}
    streams = [spark.readStream.schema(schema).options(**options).parquet(p.strip()) for p in path.split(",") if p.strip()]
    out = streams[0]
    for other in streams[1:]:
        out = out.unionByName(other)
    return out


def kafka_wire_rows(stream: DataFrame) -> DataFrame:
    """Kafka rows -> wire rows. ``seq`` is the arrival time in microseconds;
    ``place`` (topic, partition, offset) orders records of one microsecond and
    tells every two records apart, also those of different topics."""
    place = F.concat_ws(":", "topic", F.lpad(F.col("partition").cast("string"), 10, "0"),
                        F.lpad(F.col("offset").cast("string"), 20, "0"))
    return stream.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                         F.col("partition").cast("int").alias("partition"),
                         F.unix_micros("timestamp").alias("seq"), place.alias("place"))
