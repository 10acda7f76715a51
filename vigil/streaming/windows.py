"""Streams over the enriched records: windowed summary and live display window.

Both keep named state per device, which can be read from the checkpoint by its
name: ``windows`` (a map by block of windows, which event-time timers close) and
``ring`` (the newest records).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vigil.schema import RESULT_FIELDS, SINK_SCHEMA
from vigil.settings import DEFAULT, ScoreSettings

SUMMARY_SCHEMA = ("device_key string, window_start long, rows long, avg_measurement double, max_measurement double, "
                  "max_anomaly double, anomalous long")
WINDOW_FIELDS = ["rows", "total", "max_measurement", "max_anomaly", "anomalous"]
_TYPES = ["long", "double", "double", "double", "long"]
_CLOSED = "device_key string, window_start long, " + ", ".join(f"{f} {t}" for f, t in zip(WINDOW_FIELDS, _TYPES))
_BLOCK = "start array<long>, " + ", ".join(f"{f} array<{t}>" for f, t in zip(WINDOW_FIELDS, _TYPES))
#: Windows of a block: one read and one write of the state for all its windows that a batch meets.
BLOCK_WINDOWS = 1024
#: What the display window holds of each record.
RING_FIELDS = ["record_number", "seq", "measurement", *RESULT_FIELDS]
_RING = "record_number long, seq long, measurement double, " + ", ".join(f"{f} double" for f in RESULT_FIELDS)


class SummaryProcessor(StatefulProcessor):
    """Per device and tumbling window: rows, sum and maxima. A window leaves the
    state, once, when the watermark has passed its end."""

    def __init__(self, width_ms: int, threshold: float, block_windows: int = BLOCK_WINDOWS):
        self.width_ms = width_ms
        self.threshold = threshold
        self.block_ms = width_ms * block_windows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "block long", _BLOCK)

    def _load(self, block: int) -> dict[int, tuple]:
        found = self.windows.getValue((block,))
        return {} if found is None else {start: tuple(values) for start, *values in zip(*found)}

    def _store(self, block: int, windows: dict[int, tuple]) -> None:
        if windows:
            self.windows.updateValue((block,), tuple(list(c) for c in zip(*[(k, *windows[k]) for k in sorted(windows)])))
        else:
            self.windows.removeKey((block,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            made = (pdf.assign(over=pdf["anomaly"] >= self.threshold).groupby("start")
                    .agg(rows=("measurement", "size"), total=("measurement", "sum"), top=("measurement", "max"),
                         anomaly=("anomaly", "max"), over=("over", "sum")))
            for block, part in made.groupby(made.index // self.block_ms):
                windows = self._load(int(block))
                first = min(windows, default=None)
                for start, r in zip(part.index.tolist(), part.itertuples(index=False)):
                    new = (int(r.rows), float(r.total), float(r.top), float(r.anomaly), int(r.over))
                    old = windows.get(start)
                    windows[start] = new if old is None else (old[0] + new[0], old[1] + new[1], max(old[2], new[2]),
                                                              max(old[3], new[3]), old[4] + new[4])
                self._store(int(block), windows)
                if min(windows) != first:
                    self.handle.registerTimer(min(windows) + self.width_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Closes the block's windows that the watermark has passed, and waits for the next one."""
        at = expiredTimerInfo.getExpiryTimeInMs()
        block = (at - self.width_ms) // self.block_ms
        windows = self._load(block)
        until = max(at, timerValues.getCurrentWatermarkInMs()) - self.width_ms
        closed = sorted(k for k in windows if k <= until)
        if closed:
            yield pd.DataFrame([(key[0], k // 1000, *windows.pop(k)) for k in closed], columns=["device_key", "window_start", *WINDOW_FIELDS])
            self._store(block, windows)
            if windows:
                self.handle.registerTimer(min(windows) + self.width_ms)

    def close(self) -> None:
        pass


def _average(rows: DataFrame) -> DataFrame:
    return rows.select("device_key", "window_start", "rows", F.round(F.col("total") / F.col("rows"), 9).alias("avg_measurement"),
                       "max_measurement", "max_anomaly", "anomalous")


class RingProcessor(StatefulProcessor):
    """Per device the newest ``size`` records, put out anew with each batch that has records of the device."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", _RING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame(list(self.ring.get()) if self.ring.exists() else [], columns=RING_FIELDS)
        for pdf in rows:
            own = pdf[RING_FIELDS]
            both = pd.concat([kept, own], ignore_index=True) if len(kept) else own
            kept = both.sort_values("record_number", kind="stable").tail(self.size)
        self.ring.put(list(kept.itertuples(index=False, name=None)))
        yield kept.assign(device_key=key[0], newest=kept["record_number"].max())[["device_key", *RING_FIELDS, "newest"]]

    def close(self) -> None:
        pass


def _enriched(spark: SparkSession, source: str | tuple[str, int], checkpoint: str, files_per_trigger: int | None,
              batch_rows: int | None) -> tuple[DataFrame, int | None]:
    """The enriched rows as a stream, and how many batches they are (None: until
    the folder is drained). ``source`` is a folder, or enriched wire rows staged
    by position (``sources.replay.stage``), then ``batch_rows`` of them a batch."""
    from vigil.sources.replay import ENRICHED, last_position, read_replay
    from vigil.streaming.scorer import _stream_conf, enriched_stream_rows, ship_package
    _stream_conf(spark)
    ship_package(spark)
    if isinstance(source, str):
        options = {"maxFilesPerTrigger": str(files_per_trigger)} if files_per_trigger else {}
        wire, left = spark.readStream.schema(SINK_SCHEMA).options(**options).parquet(source), None
    else:
        folder, total = source
        left = -(-(total - last_position(spark, checkpoint)) // batch_rows)
        wire = read_replay(spark, folder, total, batch_rows, checkpoint, ENRICHED)
    return enriched_stream_rows(wire.filter(F.col("reason").isNull())), left


def _run(out: DataFrame, sink: str, checkpoint: str, batches: int | None, batch_rows: int | None) -> list[dict]:
    from vigil.streaming.scorer import drain, partitions_for, start_with_partitions
    spark = out.sparkSession
    writer = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if batches is None else writer.trigger(processingTime="0 seconds")
    query = start_with_partitions(spark, writer, spark.sparkContext.defaultParallelism if batches is None else partitions_for(spark, batch_rows))
    return drain(query, batches, settle=True)


def run_window_summary(spark: SparkSession, enriched: str | tuple[str, int], sink: str, checkpoint: str, s: ScoreSettings = DEFAULT,
                       delay: str = "1 day", files_per_trigger: int | None = None, block_windows: int = BLOCK_WINDOWS,
                       batch_rows: int | None = None) -> list[dict]:
    """Tumbling-window summary over the enriched records as a stream: a (device,
    window) goes to the sink once, when event time has passed its end by
    ``delay``. Rows of closed windows are not counted; the windows that are
    still open stay in the state (``read_window_summary`` has both)."""
    from vigil.streaming.scorer import interval_ms
    width = interval_ms(s.summary_window)
    start = F.unix_millis("event_time") - F.pmod(F.unix_millis("event_time"), F.lit(width))
    stream, batches = _enriched(spark, enriched, checkpoint, files_per_trigger, batch_rows)
    rows = (stream.withColumn("start", start)
            # By its end, so that rows of an open window count however late they are.
            .withColumn("end", F.timestamp_millis(F.col("start") + width)).withWatermark("end", delay)
            .select("device_key", "start", "end", "measurement", "anomaly"))
    made = rows.groupBy("device_key").transformWithStateInPandas(
        SummaryProcessor(width, s.anomaly_threshold, block_windows), _CLOSED, "append", "EventTime")
    return _run(_average(made), sink, checkpoint, batches, batch_rows)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows still open, from the stream's state."""
    state = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "windows")
             .option("flattenCollectionTypes", "true").load())
    each = state.select(F.col("key.device_key").alias("device_key"),
                        F.inline(F.arrays_zip(*[F.col(f"user_map_value.{f}").alias(f) for f in ["start", *WINDOW_FIELDS]])))
    return _average(each.withColumn("window_start", F.expr("start div 1000")))


def read_window_summary(spark: SparkSession, sink: str, checkpoint: str) -> DataFrame:
    """Every window of the streamed summary: the closed ones from the sink, the
    open ones from the state in the checkpoint."""
    return spark.read.schema(SUMMARY_SCHEMA).parquet(sink).unionByName(open_windows(spark, checkpoint))


def run_live_window(spark: SparkSession, enriched: str | tuple[str, int], sink: str, checkpoint: str, s: ScoreSettings = DEFAULT,
                    files_per_trigger: int | None = None, batch_rows: int | None = None) -> list[dict]:
    """The display window as a stream over the enriched records: each batch puts
    out, for every device it has records of, the newest ``display_rows`` ones
    (``newest`` is the last record number of that window)."""
    stream, batches = _enriched(spark, enriched, checkpoint, files_per_trigger, batch_rows)
    rows = stream.select("device_key", *RING_FIELDS)
    made = rows.groupBy("device_key").transformWithStateInPandas(
        RingProcessor(s.display_rows), f"device_key string, {_RING}, newest long", "append", "None")
    return _run(made, sink, checkpoint, batches, batch_rows)


def read_live_window(spark: SparkSession, sink: str) -> DataFrame:
    """The window of each device as it was last put out."""
    rows = spark.read.parquet(sink)
    last = rows.groupBy("device_key").agg(F.max("newest").alias("newest"))
    return rows.join(last, ["device_key", "newest"]).drop("newest")
