"""Online per-device scoring as a batch plan (backfill) over a table.

Per device, rows are numbered ``n = 0, 1, …`` in (event_time, seq) order and
each measurement falls in bucket ``b``. A transition ``b_m -> b_{m+1}`` is
complete at row m+1. At row n the model knows every transition completed so
far and:

* ``predictionNext`` = value of the most frequent successor of ``b_n``
  (ties: the one that reached its count most recently), or ``b_n`` itself when
  ``b_n`` was never left before;
* ``prediction`` = the previous row's ``predictionNext`` (0.0 at n = 0);
* ``error`` = ``|prediction_{n-1} - measurement_{n-1}|`` (the reference reads
  the stored state before overwriting it, so the error lags one row);
* ``anomaly`` = share of the current code's bits not switched on by the codes
  of the successors expected at the previous row (1.0 if none were);
* error and anomaly are 0.0 for the first ``warmup_rows`` rows.

Every step is a window function, so the whole model is one hash exchange on
``device_key`` plus sorts (``plan="window"``). A device with very many rows
would make that one task; ``plan="segmented"`` (see ``segmented.py``) splits
devices into ordered blocks and combines block carries instead. The caller
names the plan; both give the same rows, every valid input row once.

The order of a device's rows is total up to rows that do not differ for the
model: (event_time, seq with nulls first, measurement).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.encoders import bucket_value, scalar_bucket
from vigil.operators.bitsets import bit_word, covered_bits, n_words
from vigil.schema import RAW_FIELDS, RESULT_FIELDS
from vigil.settings import DEFAULT, ScoreSettings

ORDER = ("event_time", "seq", "measurement")
#: Rows that a block of a blocked plan holds at most, on average: of one that
#: orders rows, and of the segmented plan, whose tasks sort a block several times.
BLOCK_ROWS, SCORE_BLOCK_ROWS = 4_000_000, 300_000


def valid_rows(typed: DataFrame) -> DataFrame:
    """Rows the model can take: a parsed time and measurement."""
    return typed.filter(F.col("event_time").isNotNull() & F.col("measurement").isNotNull())


def with_bucket(df: DataFrame, s: ScoreSettings = DEFAULT) -> DataFrame:
    return df.withColumn("b", scalar_bucket("measurement", s))


def _mode_struct() -> Column:
    return F.struct(F.col("c"), F.col("record_number"), F.col("to_b"))


def finish(df: DataFrame, s: ScoreSettings, prev: dict[str, Column]) -> DataFrame:
    """Results from the per-row model columns and the previous rows' values.

    ``prev`` gives ``pn1`` (predictionNext at n-1), ``pn2`` (at n-2), ``x1``
    (measurement at n-1), ``p0``, ``p1`` ... (words of the successor set of b
    at n-1).
    """
    # Materialise the previous-row values once; the coverage formula reads
    # them several times and must not repeat the window functions.
    df = df.select("*", *[c.alias(f"_{k}") for k, c in prev.items()])
    n = F.col("record_number")
    warm = n >= F.lit(s.warmup_rows)
    zero = F.lit(0).cast("long")
    words = [F.coalesce(F.col(f"_p{k}"), zero) for k in range(n_words(s.n_buckets))]
    cover = covered_bits(words, F.col("b"), s.scalar_w)
    out = df.select(
        "*",
        F.coalesce(F.col("_pn1"), F.lit(0.0)).alias("prediction"),
        F.when(warm, F.abs(F.col("_pn2") - F.col("_x1"))).otherwise(F.lit(0.0)).alias("error"),
        F.when(warm, F.lit(1.0) - cover.cast("double") / F.lit(float(s.scalar_w)))
         .otherwise(F.lit(0.0)).alias("anomaly"),
    )
    return out.drop(*[f"_{k}" for k in prev])


def score_window(prepared: DataFrame, s: ScoreSettings = DEFAULT) -> DataFrame:
    """The model as windows over ``device_key`` (one exchange)."""
    by_time = Window.partitionBy("device_key").orderBy(*ORDER)
    df = prepared.select("*", (F.row_number().over(by_time) - 1).cast("long").alias("record_number"),
                         F.lead("b").over(by_time).alias("to_b"))
    by_pair = Window.partitionBy("device_key", "b", "to_b").orderBy("record_number")
    df = df.withColumn("c", F.row_number().over(by_pair).cast("long"))
    # One select, so the three running aggregates share one Window operator
    # (one sort, one buffer per (device, b) group).
    before = (Window.partitionBy("device_key", "b").orderBy("record_number")
              .rowsBetween(Window.unboundedPreceding, -1))
    words = range(n_words(s.n_buckets))
    df = df.select("*", F.max(_mode_struct()).over(before).alias("best"),
                   *[F.bit_or(bit_word("to_b", k)).over(before).alias(f"succ_{k}") for k in words])
    df = df.withColumn("predictionNext", bucket_value(F.coalesce(F.col("best.to_b"), F.col("b")), s))
    by_n = Window.partitionBy("device_key").orderBy("record_number")
    prev = {
        "pn1": F.lag("predictionNext", 1).over(by_n),
        "pn2": F.lag("predictionNext", 2).over(by_n),
        "x1": F.lag("measurement", 1).over(by_n),
        **{f"p{k}": F.lag(f"succ_{k}", 1).over(by_n) for k in words},
    }
    return finish(df, s, prev)


def block_count(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> int:
    """Blocks for a blocked plan: one per core at least, and enough that a
    block holds ``block_rows`` rows on average (counts the rows once)."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(cores, -(-rows.count() // block_rows))


def score(typed: DataFrame, s: ScoreSettings = DEFAULT, plan: str = "window", block_rows: int = SCORE_BLOCK_ROWS,
          blocks: int | None = None, keep: list[str] | None = None, align_error: bool = False,
          strict: bool = False) -> DataFrame:
    """Score every valid row. Output: ``device_key, seq, record_number,
    measurement``, the kept record fields (default: all 24 raw fields) and
    the four results; with ``align_error`` also ``aligned_error``, this row's
    own ``|prediction - measurement|`` (``error`` keeps the one-row lag).

    Rows without a parsed time or measurement cannot be scored:
    ``quality.split_quarantine`` (or ``score_quarantine``) gives them with the
    reason; with ``strict`` such a row fails the job instead.

    Rows are ordered by (event_time, seq, measurement) per device, nulls
    first. ``seq`` (arrival order) may repeat or be null."""
    from vigil.operators.quality import fail_on_bad_rows
    keep = RAW_FIELDS if keep is None else keep
    checked = fail_on_bad_rows(typed) if strict else valid_rows(typed)
    prepared = with_bucket(checked.select(
        "device_key", *ORDER, *[c for c in keep if c not in ("device_key", *ORDER)]), s)
    if plan == "window":
        scored = score_window(prepared, s)
    elif plan == "segmented":
        from vigil.operators.segmented import score_segmented
        scored = score_segmented(prepared, s, blocks=blocks or block_count(prepared.select("device_key"), block_rows))
    else:
        raise ValueError(f"unknown plan {plan!r}")
    extra = [F.abs(F.col("prediction") - F.col("measurement")).alias("aligned_error")] if align_error else []
    return scored.select("device_key", "seq", "record_number", "measurement",
                         *[c for c in keep if c not in ("device_key", "seq", "measurement")],
                         *RESULT_FIELDS, *extra)
