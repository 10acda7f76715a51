"""Reports over scored records: windowed summaries, per-device accuracy and
last state, the display window and chart series, replay batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.encoders import scalar_bucket
from vigil.operators.sequence import row_positions
from vigil.settings import DEFAULT, ScoreSettings

# The four charts and the two series each one draws
# (measurement with the anomalous points, the error, the anomaly score and
# the prediction).
CHART_SERIES = [
    ("measurement", "measurement"), ("measurement", "points"),
    ("error", "measurement"), ("error", "error"),
    ("anomaly", "measurement"), ("anomaly", "anomaly"),
    ("prediction", "measurement"), ("prediction", "prediction"),
]
SERIES = ["measurement", "error", "anomaly", "prediction"]

#: The scorer's order, then the device: total up to rows that do not differ.
DISPLAY_ORDER = ("event_time", "seq", "measurement", "device_key")


def _r(c: F.Column, digits: int = 9) -> F.Column:
    return F.round(c, digits)


def window_summary(scored: DataFrame, s: ScoreSettings = DEFAULT, watermark: str | None = None) -> DataFrame:
    """Per device and tumbling window: rows, mean and max measurement, max
    anomaly and the count of anomalous rows. Partial aggregation runs
    map-side, so a hot device adds only one partial row per task."""
    df = scored if watermark is None else scored.withWatermark("event_time", watermark)
    return (df.groupBy("device_key", F.window("event_time", s.summary_window).alias("w"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 _r(F.avg("measurement")).alias("avg_measurement"),
                 F.max("measurement").alias("max_measurement"),
                 F.max("anomaly").alias("max_anomaly"),
                 F.sum((F.col("anomaly") >= s.anomaly_threshold).cast("long")).alias("anomalous"))
            .select("device_key", F.unix_timestamp("w.start").alias("window_start"),
                    "rows", "avg_measurement", "max_measurement", "max_anomaly", "anomalous"))


def device_error_stats(scored: DataFrame, s: ScoreSettings = DEFAULT) -> DataFrame:
    """Accuracy of the predictions per device (rows past the warm-up)."""
    return (scored.filter(F.col("record_number") >= s.warmup_rows)
            .groupBy("device_key")
            .agg(F.count(F.lit(1)).alias("rows"),
                 _r(F.avg("error")).alias("mean_error"),
                 _r(F.sqrt(F.avg(F.col("error") * F.col("error")))).alias("rms_error"),
                 _r(F.avg("anomaly")).alias("mean_anomaly")))


def device_snapshot(scored: DataFrame, s: ScoreSettings = DEFAULT) -> DataFrame:
    """Latest model state per device (``max_by`` combines map-side)."""
    last = F.max_by(F.struct("record_number", "measurement", "prediction", "error", "anomaly",
                             "predictionNext"), "record_number")
    return (scored.groupBy("device_key").agg(last.alias("s"))
            .select("device_key",
                    F.col("s.record_number").alias("record_number"),
                    F.col("s.measurement").alias("actual"),
                    F.col("s.prediction").alias("prediction"),
                    F.col("s.error").alias("error"),
                    F.col("s.anomaly").alias("anomaly"),
                    F.col("s.predictionNext").alias("prediction_next"),
                    scalar_bucket(F.col("s.measurement"), s).alias("bucket")))


def last_n(scored: DataFrame, s: ScoreSettings = DEFAULT, order: tuple[str, ...] = DISPLAY_ORDER) -> DataFrame:
    """The display window: the latest ``display_rows`` (501) records. A top-k:
    each task keeps its own best 501, the driver merges ``tasks x 501`` rows."""
    return scored.orderBy(*[F.col(c).desc() for c in order if c in scored.columns]).limit(s.display_rows)


def last_n_per_device(scored: DataFrame, s: ScoreSettings = DEFAULT) -> DataFrame:
    """Each device's own display window: its latest ``display_rows`` (501)
    records, ranked by record number over the partitioning the scorer's rows
    already have (no second scan or exchange). Spark keeps only the first
    ``display_rows`` ranks of each device while it sorts."""
    from pyspark.sql import Window
    newest = Window.partitionBy("device_key").orderBy(F.col("record_number").desc())
    return (scored.withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") <= s.display_rows).drop("_rank"))


def display_points(scored: DataFrame, s: ScoreSettings = DEFAULT,
                   order: tuple[str, ...] = DISPLAY_ORDER) -> DataFrame:
    """The display window with its running x index (0 = oldest shown). The
    numbering runs over at most 501 rows."""
    from pyspark.sql import Window
    win = last_n(scored, s, order)
    w = Window.orderBy(*[c for c in order if c in scored.columns])
    return win.withColumn("x", (F.row_number().over(w) - 1).cast("long"))


def chart_series(points: DataFrame) -> DataFrame:
    """Long form (x, series, y) of the four series."""
    stack = "stack(4, " + ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in SERIES) + ") AS (series, y)"
    return points.select("x", F.expr(stack))


def anomaly_points(points: DataFrame, s: ScoreSettings = DEFAULT) -> DataFrame:
    """Anomalous points inside the display window."""
    return (points.filter(F.col("anomaly") >= s.anomaly_threshold)
            .select("x", F.col("measurement").alias("y")))


def chart_pairs(points: DataFrame, s: ScoreSettings = DEFAULT) -> DataFrame:
    """(chart, series, x, y) for the four charts, in one pass over the
    display window: the four series plus the anomalous points; the pairing
    table has eight rows, so it is broadcast."""
    spark = points.sparkSession
    pairs = spark.createDataFrame(CHART_SERIES, "chart string, series string")
    stack = ("stack(5, " + ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in SERIES)
             + ", 'points', CAST(measurement AS DOUBLE)) AS (series, y)")
    series = (points.select("x", "anomaly", F.expr(stack))
              .filter((F.col("series") != "points") | (F.col("anomaly") >= s.anomaly_threshold))
              .drop("anomaly"))
    return series.join(F.broadcast(pairs), "series").select("chart", "series", "x", "y")


def replay_batches(records: DataFrame, s: ScoreSettings = DEFAULT, order: str = "seq",
                   blocks: int | None = None) -> DataFrame:
    """Paced replay: the ``k``-th group of ``replay_batch_size`` records in file
    order is sent in batch ``k`` (``streaming.replay`` pauses after each).
    Returns the order column, ``position`` and ``replay_batch``; positions come
    from a distributed zip-with-index over the order column alone."""
    pos = row_positions(records, [order], "position", blocks=blocks)
    return pos.withColumn("replay_batch", F.floor(F.col("position") / s.replay_batch_size).cast("long"))


def batch_counts(batches: DataFrame) -> DataFrame:
    """Records per replay batch, with the running total sent."""
    return (batches.groupBy("replay_batch").agg(F.count(F.lit(1)).alias("records"),
                                                (F.max("position") + 1).alias("sent_total")))
