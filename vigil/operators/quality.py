"""Data-quality checks around the scorer: quarantine, partition stability,
arrival order, one model per device, record comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import columns as C
from vigil.operators.sequence import number_rows, previous_value
from vigil.schema import ENRICHED_FIELDS


def quarantine_reason() -> F.Column:
    """Why a typed row cannot be scored (null when it can)."""
    return (F.when(F.col("event_time").isNull(), F.lit("bad_time"))
             .when(F.col("measurement").isNull(), F.lit("bad_measurement")))


def fail_on_bad_rows(typed: DataFrame) -> DataFrame:
    """The rows, or a failed job when one of them cannot be scored."""
    bad = F.raise_error(F.concat(F.lit("record cannot be scored: "), quarantine_reason()))
    return typed.filter(F.when(quarantine_reason().isNull(), F.lit(True)).otherwise(bad.cast("boolean")))


def classify(typed: DataFrame) -> DataFrame:
    """Every row with its quarantine reason, ``ok`` for rows the model takes."""
    return typed.select("device_key", "seq", F.coalesce(quarantine_reason(), F.lit("ok")).alias("reason"))


def split_quarantine(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with a ``reason``)."""
    r = typed.withColumn("reason", quarantine_reason())
    return r.filter(F.col("reason").isNull()).drop("reason"), r.filter(F.col("reason").isNotNull())


def score_quarantine(typed: DataFrame, **options) -> DataFrame:
    """Every input row once: scored rows with their results and ``ok``, the
    others with the reason (``bad_time``, ``bad_measurement``)."""
    from vigil.operators.score import score
    scored = score(typed, **options).withColumn("reason", F.lit("ok"))
    bad = split_quarantine(typed)[1]
    return scored.unionByName(bad.select(*[c for c in scored.columns if c in bad.columns]), allowMissingColumns=True)


def device_bucket_check(typed: DataFrame, n: int = 10) -> DataFrame:
    """Per device: how many partitions its records reach under the month
    bucket (not device-stable), and how many they are really in after the rows
    were dealt by device."""
    dealt = typed.select("device_key", C.month_bucket("dateGMT", n).alias("mb")).repartition(n, "device_key")
    return (dealt.select("device_key", "mb", F.spark_partition_id().alias("p")).groupBy("device_key")
            .agg(F.count_distinct("mb").cast("long").alias("month_partitions"),
                 F.count_distinct("p").cast("long").alias("device_partitions")))


def order_violations(typed: DataFrame, arrival: str = "arrival", plan: str = "window",
                     blocks: int | None = None) -> DataFrame:
    """Rows that arrive with an event time earlier than the device's previous
    arrival (order not kept per device)."""
    df = typed.select("device_key", "seq", arrival, "event_time")
    order = list(dict.fromkeys([arrival, "seq", "event_time"]))  # arrival numbers may repeat
    df = previous_value(df, ["device_key"], order, "event_time", "prev_time", plan=plan, blocks=blocks)
    return (df.filter(F.col("event_time") < F.col("prev_time"))
              .select("device_key", "seq", arrival,
                      F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
                      F.date_format("prev_time", "yyyy-MM-dd HH:mm:ss").alias("prev_time")))


def state_uniqueness(scored: DataFrame) -> DataFrame:
    """One model per device: every device's rows are numbered 0..count-1
    exactly once. ``count(distinct)`` is planned as a two-level aggregate on
    (device, n), so a hot device is still combined map-side."""
    return (scored.groupBy("device_key")
            .agg(F.count(F.lit(1)).alias("rows"),
                 (F.max("record_number") + 1).alias("numbered"),
                 F.count_distinct("record_number").alias("distinct_numbers"))
            .withColumn("one_model", (F.col("rows") == F.col("numbered"))
                        & (F.col("rows") == F.col("distinct_numbers"))))


def record_diff(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str] = ENRICHED_FIELDS,
                plan: str = "window", blocks: int | None = None) -> DataFrame:
    """Rows that differ between two multisets of records: side (``left_only``,
    ``right_only``, ``changed``) and the number of fields that differ under
    null-safe equality (of a row on one side only: its fields that are not null).

    Equal rows cancel out first: one grouping over the keys and all fields adds
    up +1 for each left and -1 for each right row, combined map-side, whatever
    keys are null or repeat. What is left over under a key is paired by its rank
    in the order of the fields; pairs are ``changed``. ``plan`` numbers these
    rows ("blocked" where most rows of one key differ, ``sequence.number_rows``)."""
    one = lambda df, w: df.select(*keys, *fields, F.lit(w).cast("long").alias("_w"))
    over = (one(left, 1).unionByName(one(right, -1)).groupBy(*keys, *fields).agg(F.sum("_w").alias("_w")).filter("_w <> 0")
            .withColumn("_side", F.col("_w") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_w")))))
    # One text for the keys, which is never null and tells nulls from texts.
    over = over.withColumn("_key", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    ranked = number_rows(over.drop("_w"), ["_key", "_side"], [*fields, "_copy"], plan=plan, blocks=blocks)
    side = lambda of, p: ranked.filter(of).select(
        *[F.col(c).alias(f"{p}{c}") for c in [*keys, *fields]], F.col("_key").alias(f"{p}_key"), F.col("record_number").alias(f"{p}_rank"))
    lefts, rights = side(F.col("_side"), "_l_"), side(~F.col("_side"), "_r_")
    j = lefts.join(rights, (F.col("_l__key") == F.col("_r__key")) & (F.col("_l__rank") == F.col("_r__rank")), "full_outer")
    n_diff = sum((~F.col(f"_l_{f}").eqNullSafe(F.col(f"_r_{f}"))).cast("int") for f in fields)
    kind = (F.when(F.col("_r__rank").isNull(), F.lit("left_only")).when(F.col("_l__rank").isNull(), F.lit("right_only"))
             .otherwise(F.lit("changed")))
    return j.select(*[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys], kind.alias("side"), n_diff.cast("long").alias("fields_differing"))


def record_numbers(typed: DataFrame, plan: str = "window", blocks: int | None = None) -> DataFrame:
    """0-based position of each valid row in its device's (event_time, seq) order."""
    df = typed.filter(F.col("event_time").isNotNull() & F.col("measurement").isNotNull()) \
              .select("device_key", "seq", "event_time", "measurement")
    return number_rows(df, ["device_key"], ["event_time", "seq", "measurement"], plan=plan, blocks=blocks) \
        .select("device_key", "seq", "record_number")
