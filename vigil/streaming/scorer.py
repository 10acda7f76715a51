"""The scoring model as keyed state (``transformWithStateInPandas``).

State per device:

* ``last`` (value state): the previous row's number, bucket, next-step
  prediction, prediction, measurement and the successors of its bucket;
* ``trans`` (map state by block of ``BLOCK_BUCKETS`` from-buckets): from-bucket,
  successor, count, and row number of the latest such transition, as columns
  (``block_blob``). A micro-batch reads and writes each block that its rows visit
  once: every access is a round trip and every value in a row is converted by
  itself. A block has at most ``BLOCK_BUCKETS`` x ``n_buckets`` transitions;
* with a reorder delay, ``held`` (map state by span of event time and part of it):
  rows that wait for the watermark, and ``spans`` (parts of each span).

For each micro-batch a device's rows are sorted by (event_time, seq, place,
measurement) and scored in slices of arrays (``model.DeviceRows``) with the
definitions of the batch plan, so an uninterrupted or resumed stream gives the
batch result. With ``reorder`` the rows of a device are kept in its state until
the watermark passes the end of their span, and are then scored in order,
whatever micro-batch brought them; a row of a span that was already released is
quarantined as ``late``. ``history`` starts the model from scored rows of the past.

Every record goes once through the one stateful operator: good ones by device,
records that cannot be scored dealt over keys of their own (``LANES`` at most), which
have no state. These leave the stream with a reason, through the same sink;
``strict`` fails the batch instead.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vigil.functions import columns as C
from vigil.operators.quality import quarantine_reason
from vigil.operators.score import with_bucket
from vigil.schema import KEY_FIELDS, RAW_FIELDS, RESULT_FIELDS, SINK_SCHEMA
from vigil.settings import DEFAULT, ScoreSettings
from vigil.streaming.model import SLICE_ROWS, BucketState, DeviceRows, block_blob, block_states, from_blob, to_blob

LAST_SCHEMA = "n long, b int, pn double, pred double, x double, succ array<int>"
BLOCK_SCHEMA = "block int"
TRANS_SCHEMA = "rows binary"
#: From-buckets of a block of the transitions: one read and one write of the state for all of them that a batch meets.
BLOCK_BUCKETS = 32

#: Keys that records without a device are dealt over at most (a key costs a batch about as much as
#: a device, so one for each partition of the state is enough), and the lanes of a device and of an end mark.
LANES, SCORED_LANE, MARK_LANE = 64, -1, -2
#: The wire key of an end mark (``end_mark``), and the time it stands for.
END_KEY, END_TIME = "\u0000end", "9999-01-01"
NO_SEQ = -(1 << 63)

# Only the key, order, bucket and measurement cross into Python; the record
# itself rides along as its JSON text (one column instead of 24) and the
# four results are merged into it on the JVM side afterwards.
OUTPUT_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("value", T.StringType()),
     T.StructField("record_number", T.LongType()), T.StructField("measurement", T.DoubleType())]
    + [T.StructField(f, T.DoubleType()) for f in RESULT_FIELDS] + [T.StructField("reason", T.StringType())])


class ScoreProcessor(StatefulProcessor):
    """Per-device model state. State is kept forever by default (as in the
    reference); ``ttl_ms`` lets a device's state expire after that much
    processing time without records (needs ``timeMode="ProcessingTime"``).
    ``span_ms`` turns the reorder buffer on (needs ``timeMode="EventTime"``)."""

    def __init__(self, s: ScoreSettings = DEFAULT, ttl_ms: int | None = None, span_ms: int | None = None,
                 slice_rows: int = SLICE_ROWS):
        self.s = s
        self.ttl_ms = ttl_ms
        self.span_ms = span_ms
        self.slice_rows = slice_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", LAST_SCHEMA, self.ttl_ms)
        self.trans = handle.getMapState("trans", BLOCK_SCHEMA, TRANS_SCHEMA, self.ttl_ms)
        if self.span_ms:
            self.held = handle.getMapState("held", "span long, part int", "rows binary")
            self.spans = handle.getMapState("spans", "span long", "parts int")
            self.released = handle.getValueState("released", "span long")

    def _scored(self, device: str, rows: DeviceRows) -> Iterator[pd.DataFrame]:
        blocks: dict[int, dict[int, BucketState]] = {}

        def bucket(b: int) -> BucketState:
            k = b // BLOCK_BUCKETS
            if k not in blocks:
                found = self.trans.getValue((k,))
                blocks[k] = block_states(found[0]) if found is not None else {}
            return blocks[k].setdefault(b, BucketState())

        made, last, changed = rows.score(self.last.get(), bucket, self.s)
        for k in sorted({b // BLOCK_BUCKETS for b in changed}):
            self.trans.updateValue((k,), (block_blob(blocks[k]),))
        self.last.update(last)
        for batch, n, x, pred, err, anom, pn in made:
            yield pd.DataFrame({"key": device, "seq": batch.column("seq").to_numpy(), "value": batch.column("value").to_pylist(),
                                "record_number": n, "measurement": x, "prediction": pred, "error": err, "anomaly": anom,
                                "predictionNext": pn, "reason": None})

    @staticmethod
    def _unscored(pdf: pd.DataFrame, reason) -> pd.DataFrame:
        out = pdf[["key", "seq", "value"]].assign(record_number=-1, measurement=0.0, **{f: 0.0 for f in RESULT_FIELDS})
        return out.assign(reason=reason)

    def _add(self, rows: DeviceRows, pdf: pd.DataFrame) -> None:
        rows.add(pdf["time"].to_numpy(), pdf["seq"].to_numpy(), pa.array(pdf["place"], pa.string(), from_pandas=True),
                 pdf["measurement"].to_numpy(), pdf["b"].to_numpy(), pa.array(pdf["value"], pa.string(), from_pandas=True))

    def _hold(self, pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Keeps the rows for their spans; those of released spans are late."""
        span = pdf["time"].to_numpy() // (self.span_ms * 1000)
        done = self.released.get()[0] if self.released.exists() else None
        if done is not None and (span <= done).any():
            yield self._unscored(pdf[span <= done].assign(key=pdf["key"]), "late")
            pdf, span = pdf[span > done], span[span > done]
        for k in np.unique(span).tolist():
            own = pdf[span == k]
            found = self.spans.getValue((k,))
            parts = found[0] if found is not None else 0
            blob = to_blob({c: pa.array(own[c], t, from_pandas=True) for c, t in HELD})
            self.held.updateValue((k, parts), (blob,))
            self.spans.updateValue((k,), (parts + 1,))
            if not parts:
                self.handle.registerTimer((k + 1) * self.span_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        device, lane = key
        if lane == SCORED_LANE and not self.span_ms:
            held = DeviceRows(self.slice_rows)
            for pdf in rows:
                self._add(held, pdf)
            yield from self._scored(device, held)
            return
        for pdf in rows:
            if lane == SCORED_LANE:
                yield from self._hold(pdf)
            elif lane != MARK_LANE:
                yield self._unscored(pdf, pdf["reason"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A span of the device is over: its rows are scored in order."""
        k = expiredTimerInfo.getExpiryTimeInMs() // self.span_ms - 1
        rows = DeviceRows(self.slice_rows)
        for part in range(self.spans.getValue((k,))[0]):
            batch = from_blob(self.held.getValue((k, part))[0])
            rows.add(*(batch.column(c).to_numpy() for c in ("time", "seq")), batch.column("place"),
                     *(batch.column(c).to_numpy() for c in ("measurement", "b")), batch.column("value"))
            self.held.removeKey((k, part))
        self.spans.removeKey((k,))
        self.released.update((k,))
        yield from self._scored(key[0], rows)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """The model of a device as its history left it (``history_state``)."""
        row = initialState.iloc[0]
        blocks: dict[int, dict[int, BucketState]] = {}
        for t in row["trans"]:
            b = int(t["from_b"])
            state = blocks.setdefault(b // BLOCK_BUCKETS, {}).setdefault(b, BucketState())
            state.table[int(t["to_b"])] = (int(t["cnt"]), int(t["last_n"]))
        for k, states in blocks.items():
            self.trans.updateValue((k,), (block_blob(states),))
        b = int(row["b"])
        left = blocks.get(b // BLOCK_BUCKETS, {}).get(b, BucketState())
        self.last.update((int(row["n"]), b, float(row["pn"]), float(row["pred"]), float(row["x"]), sorted(left.table)))

    def close(self) -> None:
        pass


HELD = [("time", pa.int64()), ("seq", pa.int64()), ("place", pa.string()), ("measurement", pa.float64()), ("b", pa.int32()), ("value", pa.string())]


def history_state(scored: DataFrame, s: ScoreSettings = DEFAULT) -> DataFrame:
    """What the model knows after scored rows (``score``'s output, all rows of
    each device from its first on): one row per device with its last row and
    its transitions (at most ``n_buckets`` squared). A batch aggregate over one
    exchange on the device; its rows start a stream (``history``)."""
    from pyspark.sql import Window
    own = with_bucket(scored.select("device_key", "record_number", "measurement", "prediction", "predictionNext"), s)
    by_n = Window.partitionBy("device_key").orderBy("record_number")
    rows = own.withColumn("to_b", F.lead("b").over(by_n))
    moves = (rows.filter(F.col("to_b").isNotNull()).groupBy("device_key", "b", "to_b")
             .agg(F.count(F.lit(1)).alias("cnt"), F.max("record_number").alias("last_n"))
             .groupBy("device_key").agg(F.collect_list(F.struct(F.col("b").alias("from_b"), "to_b", "cnt", "last_n")).alias("trans")))
    last = (own.groupBy("device_key").agg(F.max_by(F.struct("record_number", "b", "predictionNext", "prediction", "measurement"),
                                                   "record_number").alias("r"))
            .select("device_key", F.col("r.record_number").alias("n"), F.col("r.b").alias("b"), F.col("r.predictionNext").alias("pn"),
                    F.col("r.prediction").alias("pred"), F.col("r.measurement").alias("x")))
    empty = F.array().cast("array<struct<from_b:int,to_b:int,cnt:bigint,last_n:bigint>>")
    return (last.join(moves, "device_key", "left").withColumn("trans", F.coalesce("trans", empty))
            .withColumn("lane", F.lit(SCORED_LANE)))


def _stream_conf(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # Each batch's changes as a log: the checkpoint is smaller and ``state_changes`` can read them.
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def decoded(wire: DataFrame, strict: bool = False) -> DataFrame:
    """Wire rows (key, value JSON, seq) with ``device_key``, ``event_time``,
    ``measurement`` and ``reason`` (null, ``bad_json``, ``bad_time`` or
    ``bad_measurement``); ``strict`` fails on a record with a reason."""
    r = C.json_decode("value", corrupt_col="_corrupt")
    place = F.col("place") if "place" in wire.columns else F.lit(None).cast("string")
    rec = wire.select("key", "seq", "value", place.alias("place"), r.alias("r"))
    typed = rec.select("key", "seq", "value", "place",
                       (F.col("value").isNull() | F.col("r").isNull() | F.col("r._corrupt").isNotNull()).alias("_bad"),
                       C.device_key(*[F.col(f"r.{k}") for k in KEY_FIELDS]).alias("device_key"),
                       C.event_time("r.dateGMT", "r.timeGMT").alias("event_time"),
                       C.measurement("r.sampleMeasurement").alias("measurement"))
    reason = F.when(F.col("_bad"), F.lit("bad_json")).otherwise(quarantine_reason())
    reason = F.when(F.col("key").eqNullSafe(END_KEY), F.lit(None)).otherwise(reason)
    out = typed.withColumn("reason", reason).drop("_bad")
    if strict:
        bad = F.raise_error(F.concat(F.lit("record cannot be scored: "), F.col("reason")))
        out = out.filter(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(bad.cast("boolean")))
    return out


def through_state(rows: DataFrame, s: ScoreSettings = DEFAULT, ttl_ms: int | None = None, reorder: str | None = None,
                  span: str | None = None, history: DataFrame | None = None, slice_rows: int = SLICE_ROWS,
                  lanes: int = LANES) -> DataFrame:
    """The rows of ``decoded`` through the stateful operator (``OUTPUT_SCHEMA``):
    scored, or with the reason why not. One pass: both kinds are keys of it."""
    ship_package(rows.sparkSession)
    if ttl_ms and reorder:
        raise ValueError("a state TTL counts processing time, a reorder delay event time: a stream has one of them")
    lane = (F.when(F.col("key") == END_KEY, F.lit(MARK_LANE)).when(F.col("reason").isNull(), F.lit(SCORED_LANE))
            .otherwise(F.pmod(F.xxhash64("value", "seq"), F.lit(lanes)).cast("int")))
    if reorder:
        mark = F.when(F.col("key") == END_KEY, F.lit(END_TIME).cast("timestamp"))
        # Its own column, dropped at once: rows behind the watermark must reach the operator, which quarantines them.
        rows = rows.withColumn("_mark", F.coalesce(mark, "event_time")).withWatermark("_mark", reorder).drop("_mark")
    own = F.col("lane") == SCORED_LANE
    keyed = with_bucket(rows.withColumn("lane", lane), s).select(
        F.when(own, F.col("device_key")).otherwise(F.lit("")).alias("device_key"), "lane",
        F.when(own, F.col("device_key")).otherwise(F.col("key")).alias("key"),
        F.coalesce(F.unix_micros("event_time"), F.lit(0)).alias("time"), F.coalesce("seq", F.lit(NO_SEQ)).alias("seq"), "place",
        F.coalesce("measurement", F.lit(0.0)).alias("measurement"), F.coalesce("b", F.lit(0)).alias("b"), "value", "reason")
    mode = "EventTime" if reorder else "ProcessingTime" if ttl_ms else "None"
    span_ms = interval_ms(span or reorder) if reorder else None
    start = history.groupBy("device_key", "lane") if history is not None else None
    out = (keyed.groupBy("device_key", "lane")
           .transformWithStateInPandas(ScoreProcessor(s, ttl_ms, span_ms, slice_rows), OUTPUT_SCHEMA, "append", mode, initialState=start))
    return out.withColumn("seq", F.when(F.col("seq") != NO_SEQ, F.col("seq")))


def interval_ms(text: str) -> int:
    """Milliseconds of an interval such as ``1 day``."""
    return int(pd.Timedelta(text) / pd.Timedelta(milliseconds=1))


def score_stream(wire_stream: DataFrame, s: ScoreSettings = DEFAULT, ttl_ms: int | None = None, strict: bool = False,
                 **options) -> DataFrame:
    """Streaming wire rows (key, value JSON, seq) -> sink rows (``SINK_SCHEMA``):
    every scored record as an enriched wire row, and every record that cannot
    be scored as it came, with its ``reason``. Works on any source with those
    columns (landing folder, or a topic with ``seq`` taken from its offsets).
    The ``METRICS`` of each batch are observed (``batch_metrics``)."""
    out = through_state(decoded(wire_stream, strict), s, ttl_ms, **options)
    good = F.col("reason").isNull()
    record = F.struct(*[F.col(f"r.{f}").alias(f) for f in RAW_FIELDS], *RESULT_FIELDS)
    rows = out.select("*", F.when(good, C.json_decode("value")).alias("r"))
    value = F.when(good, F.to_json(record, {"ignoreNullFields": "false"})).otherwise(F.col("value"))
    number = F.when(good, F.col("record_number"))
    high = (F.col("anomaly") >= s.anomaly_threshold) & good
    zero = F.lit(0)
    return rows.observe(METRICS, F.count(F.when(good, 1)).alias("good"), F.count(F.when(~good, 1)).alias("bad"),
                        F.count(F.when(F.col("reason") == "late", 1)).alias("late"), F.count(F.when(high, 1)).alias("anomalous"),
                        F.coalesce(F.sum(F.when(good, F.col("error"))), zero).alias("error_sum"),
                        F.coalesce(F.max(F.when(good, F.col("error"))), zero).alias("error_max")).select(
        "key", value.alias("value"), "seq", number.alias("record_number"), "reason")


#: Name of the figures that every batch of the scorer observes.
METRICS = "scoring"
METRIC_FIELDS = ["good", "bad", "late", "anomalous", "error_sum", "error_max"]


def batch_metrics(progress: list[dict]) -> list[dict]:
    """The observed figures of each batch with rows: batch_id, input_rows, ``METRIC_FIELDS``."""
    out = []
    for p in progress:
        seen = (p.get("observedMetrics") or {}).get(METRICS)
        if seen is not None and p["numInputRows"]:
            seen = seen.asDict() if hasattr(seen, "asDict") else dict(seen)
            out.append({"batch_id": int(p["batchId"]), "input_rows": int(p["numInputRows"]), **{f: seen[f] for f in METRIC_FIELDS}})
    return out


def write_metrics(spark: SparkSession, progress: list[dict], path: str) -> None:
    """Appends the batches' observed figures (a row each) to a table."""
    rows = [tuple(m.values()) for m in batch_metrics(progress)]
    schema = "batch_id long, input_rows long, good long, bad long, late long, anomalous long, error_sum double, error_max double"
    spark.createDataFrame([(*r[:6], float(r[6]), float(r[7])) for r in rows], schema).write.mode("append").parquet(path)


def end_mark(spark: SparkSession) -> DataFrame:
    """A wire row that ends a stream with a reorder delay: it moves the watermark
    past all records, so that every row still held is scored. Records that
    come later are late."""
    return spark.range(1).select(F.lit(END_KEY).alias("key"), F.lit(None).cast("string").alias("value"),
                                 F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("seq"))


def enriched_wire(scored: DataFrame) -> DataFrame:
    """Enriched topic rows: key, JSON value with all 28 fields, plus the
    arrival sequence and record number."""
    return scored.select(F.col("device_key").alias("key"), C.json_encode().alias("value"),
                         "seq", "record_number")


def ship_package(spark: SparkSession) -> None:
    """Make ``vigil`` importable in the Python workers: executors get the
    package with ``addPyFile``; the driver-side worker that starts a
    stateful Python operator only sees the functions' ``PYTHONPATH``, so the
    package root is added there too. Done once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_vigil_shipped", False):
        return
    import os
    import shutil
    import tempfile
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(pkg)
    out = tempfile.mkdtemp(prefix="vigil-pkg-")
    archive = shutil.make_archive(os.path.join(out, "vigil"), "zip", root, "vigil")
    sc.addPyFile(archive)
    current = sc.environment.get("PYTHONPATH", "")
    sc.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, current) if p)
    sc._vigil_shipped = True


#: Rows of a batch that are worth a partition of the state, and partitions that there are anyway.
STATE_ROWS, LEAST_PARTITIONS = 2500, 4


def partitions_for(spark: SparkSession, batch_rows: int) -> int:
    """State partitions for batches of so many rows, the cluster's default
    parallelism at most: each costs every batch a load, a commit and an output file."""
    return min(spark.sparkContext.defaultParallelism, max(LEAST_PARTITIONS, -(-batch_rows // STATE_ROWS)))


def start_with_partitions(spark: SparkSession, writer, partitions: int | None):
    """Start a stream whose state is spread over ``partitions`` (fixed in the
    checkpoint at the first start; later starts keep the stored number)."""
    if not partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def start_scoring(wire_stream: DataFrame, checkpoint: str, sink_format: str = "parquet",
                  sink_options: dict[str, str] | None = None, trigger: str | None = "5 seconds",
                  s: ScoreSettings = DEFAULT, state_partitions: int | None = None,
                  ttl_ms: int | None = None, strict: bool = False, **options):
    """Start the long-running scorer: wire rows in, sink rows out (``parquet``
    folder, or ``kafka`` with ``kafka_writer_options``; the topic gets the
    reason of a quarantined record as a header), one micro-batch per ``trigger``
    interval (None: until the input is drained); returns the ``StreamingQuery``
    (``stop()`` ends it; a new start resumes from ``checkpoint``).
    With ``ttl_ms`` the state is cleaned in no-data batches, so run it on a
    processing-time trigger (an available-now run would not finish).

    ``reorder`` (an interval) keeps records until the watermark, that much behind
    the newest event time, has passed the end of their span of event time
    (``span``, by default as long as the delay), and scores each device's records
    in their order across micro-batches. ``history`` (``history_state`` of scored
    rows) is the state that the first start begins with."""
    spark = wire_stream.sparkSession
    _stream_conf(spark)
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    options.setdefault("lanes", min(LANES, partitions))
    out = score_stream(wire_stream, s, ttl_ms, strict, **options)
    options = dict(sink_options or {})
    if sink_format == "kafka":
        header = F.array(F.struct(F.lit("reason").alias("key"), F.col("reason").cast("binary").alias("value")))
        out = out.select("key", "value", F.when(F.col("reason").isNotNull(), header).alias("headers"))
        options.setdefault("includeHeaders", "true")
    writer = (out.writeStream.format(sink_format).options(**options)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return start_with_partitions(spark, writer, partitions)


def drain(query, max_batches: int | None = None, poll: float = 0.1, settle: bool = False) -> list[dict]:
    """Waits until a query that ends by itself has drained its input, or until
    ``max_batches`` batches with rows are done (then it is stopped; with
    ``settle``, for a query with a watermark, when what the last of them leaves
    to be closed is done too). Returns the progress of every batch, gathered as
    the batches end (Spark itself keeps only the newest ones)."""
    seen: dict[int, dict] = {}

    def gather(every: bool = False):
        # The list of recent ones is long to read, so only where the newest is not the next one.
        last = query.lastProgress
        if last is None:
            return
        known = max(seen, default=-2)
        k = int(last["batchId"])
        if every or k > known + 1 or (k > known and not seen[known]["numInputRows"]):
            for p in query.recentProgress:
                seen[int(p["batchId"])] = dict(p)
        seen[k] = dict(last)

    while query.isActive:
        gather()
        if max_batches is not None and sum(p["numInputRows"] > 0 for p in seen.values()) >= max_batches:
            if settle:
                query.processAllAvailable()
            query.stop()
        time.sleep(poll)
    gather(every=True)
    if query.exception() is not None:
        raise query.exception()
    return [seen[k] for k in sorted(seen)]


def enriched_stream_rows(wire_stream: DataFrame) -> DataFrame:
    """Enriched wire rows (a topic or folder) -> device_key, seq,
    record_number, event_time, measurement and the four results."""
    rec = wire_stream.select("seq", "record_number", C.json_decode("value").alias("r"))
    return rec.select(C.device_key(*[F.col(f"r.{k}") for k in KEY_FIELDS]).alias("device_key"), "seq",
                      "record_number", C.event_time("r.dateGMT", "r.timeGMT").alias("event_time"),
                      C.measurement("r.sampleMeasurement").alias("measurement"),
                      *[F.col(f"r.{f}").alias(f) for f in RESULT_FIELDS])


def read_transitions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The scorer's transition tables, read from the stream checkpoint: per
    device and bucket every successor with its count and latest row."""
    ship_package(spark)
    st = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "trans").load()
    blocks = st.select(F.col("key.device_key").alias("device_key"), F.col("user_map_value.rows").alias("rows"))
    return blocks.mapInArrow(_transition_rows, "device_key string, from_bucket int, to_bucket int, cnt long, last_n long")


def _transition_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["device_key", "from_bucket", "to_bucket", "cnt", "last_n"]
    for batch in batches:
        for device, blob in zip(batch.column("device_key").to_pylist(), batch.column("rows").to_pylist()):
            rows = from_blob(blob)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(device, pa.string()), rows.num_rows), *rows.columns], names)


def read_device_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The scorer's per-device state, read from the stream checkpoint (the
    state data source): latest record number, measurement, prediction,
    next-step prediction and bucket of every device."""
    st = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last").load()
    return st.select(F.col("key.device_key").alias("device_key"),
                     F.col("value.n").alias("record_number"), F.col("value.x").alias("actual"),
                     F.col("value.pred").alias("prediction"), F.col("value.pn").alias("prediction_next"),
                     F.col("value.b").alias("bucket"))


def state_changes(spark: SparkSession, checkpoint: str, first: int, last: int) -> DataFrame:
    """What the batches ``first`` to ``last`` changed in the devices' states: per
    change the batch, the device, its state partition and its newest record
    number (the state reader's change feed)."""
    st = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last").option("readChangeFeed", "true")
          .option("changeStartBatchId", first).option("changeEndBatchId", last).load())
    return st.select("batch_id", "change_type", F.col("key.device_key").alias("device_key"), "partition_id",
                     F.col("value.n").alias("record_number"))


def run_scoring(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                s: ScoreSettings = DEFAULT, files_per_trigger: int | None = None,
                max_batches: int | None = None, state_partitions: int | None = None,
                strict: bool = False, **options) -> list[dict]:
    """Scores what the landing folder holds and has not been scored yet, into
    the sink (a Parquet file sink: exactly once), until the input is drained or
    for ``max_batches`` micro-batches. Device state is spread over
    ``state_partitions`` (default: the cluster's default parallelism).
    Returns the progress of each batch.

    Without ``files_per_trigger`` all of it is one micro-batch, in which each
    device's rows are put in order. A file source does not promise an order
    between files, so a device's order across micro-batches needs its files to
    arrive in order (``replay`` sees to that), or ``reorder`` (``start_scoring``)."""
    from vigil.sources.topics import read_landing_stream
    src = read_landing_stream(spark, landing, files_per_trigger)
    q = start_scoring(src, checkpoint, "parquet", {"path": sink}, None, s, state_partitions, strict=strict, **options)
    return drain(q, max_batches)


def replay(wire: DataFrame, landing: str, sink: str, checkpoint: str, chunk_rows: int,
           s: ScoreSettings = DEFAULT, first: int = 0, max_chunks: int | None = None,
           pause_ms: int = 0, strict: bool = False, order: str = "seq", **options) -> list[dict]:
    """Paced replay in order: chunk by chunk (``topics.chunks``) the rows are
    published to the landing folder by many tasks and scored; the next chunk is
    published when the one before is done, after ``pause_ms``. The order of the
    chunks is that of ``order``, on any file system. ``first`` and
    ``max_chunks`` replay a part (a later call goes on from the checkpoint)."""
    from vigil.sources.topics import chunks, publish
    spark = wire.sparkSession
    done: list[dict] = []
    for k, chunk in enumerate(chunks(wire, chunk_rows, order)):
        if k < first:
            continue
        if max_chunks is not None and k >= first + max_chunks:
            break
        if done and pause_ms:
            time.sleep(pause_ms / 1000)
        publish(chunk, landing, order)
        done += run_scoring(spark, landing, sink, checkpoint, s, strict=strict, **options)
    return done


def replay_ordered(wire: DataFrame, sink: str, checkpoint: str, batch_rows: int, s: ScoreSettings = DEFAULT,
                   max_batches: int | None = None, pause_ms: int = 0, order: str = "seq", staged: tuple[str, int] | None = None,
                   state_partitions: int | None = None, **options) -> list[dict]:
    """Replay in order as one query: the rows are staged by position
    (``sources.replay.stage``, or ``staged`` by an earlier call) and every
    micro-batch scores the next ``batch_rows`` of them, a batch per ``pause_ms``.
    Goes on from ``checkpoint``; ``max_batches`` replays a part. The state is
    spread by the rows of a batch (``partitions_for``) unless ``state_partitions`` says how."""
    from vigil.sources.replay import last_position, read_replay, stage
    spark = wire.sparkSession
    folder, total = staged or stage(wire, order)
    left = -(-(total - last_position(spark, checkpoint)) // batch_rows)
    if max_batches is not None and max_batches < left:
        left, total = max_batches, last_position(spark, checkpoint) + max_batches * batch_rows
    if left <= 0:
        return []
    src = read_replay(spark, folder, total, batch_rows, checkpoint)
    state_partitions = state_partitions or partitions_for(spark, batch_rows)
    q = start_scoring(src, checkpoint, "parquet", {"path": sink}, f"{pause_ms} milliseconds", s, state_partitions, **options)
    return drain(q, left, settle=bool(options.get("reorder")))


def paced_replay(wire: DataFrame, landing: str, sink: str, checkpoint: str, s: ScoreSettings = DEFAULT, **options) -> list[dict]:
    """``replay`` at the pace of the settings: ``replay_batch_size`` records,
    then a pause of ``replay_batch_sleep_ms``."""
    return replay(wire, landing, sink, checkpoint, s.replay_batch_size, s, pause_ms=s.replay_batch_sleep_ms, **options)


def write_progress(spark: SparkSession, progress: list[dict], path: str, interval_ms: int = DEFAULT.batch_interval_ms) -> None:
    """Appends the batches' figures (a row each) to a table."""
    rows = [(int(p["batchId"]), int(p["numInputRows"]), int(p["durationMs"].get("triggerExecution", 0)),
             float(p.get("processedRowsPerSecond") or 0.0)) for p in progress]
    df = spark.createDataFrame(rows, "batch_id long, input_rows long, trigger_ms long, rows_per_second double")
    (df.withColumn("interval_ms", F.lit(interval_ms).cast("long"))
     .withColumn("overrun", F.col("trigger_ms") > F.col("interval_ms")).write.mode("append").parquet(path))


def read_enriched(spark: SparkSession, sink: str) -> DataFrame:
    """Enriched sink back to scored rows (batch read)."""
    df = spark.read.schema(SINK_SCHEMA).parquet(sink).filter(F.col("reason").isNull())
    rec = df.select("key", "seq", "record_number", C.json_decode("value").alias("r"))
    return rec.select(F.col("key").alias("device_key"), "seq", "record_number",
                      C.measurement(F.col("r.sampleMeasurement")).alias("measurement"),
                      *[F.col(f"r.{f}").alias(f) for f in RAW_FIELDS],
                      *[F.col(f"r.{f}").alias(f) for f in RESULT_FIELDS])


def read_quarantined(spark: SparkSession, sink: str) -> DataFrame:
    """The records of the sink that could not be scored: key, value, seq, reason."""
    df = spark.read.schema(SINK_SCHEMA).parquet(sink)
    return df.filter(F.col("reason").isNotNull()).select("key", "value", "seq", "reason")
