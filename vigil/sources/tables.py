"""Reading the given parquet tables, and the monitoring-record views built
from them (same expressions as the DuckDB oracle views)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import columns as C
from vigil.schema import RAW_FIELDS

# Parameter codes per event type, and the constant fields of
# the fixture records.
PARAMETER_CODES = {
    "view": "44201",
    "click": "42401",
    "purchase": "42101",
    "signup": "42602",
    "error": "88101",
}
CONSTANTS = {
    "countyCode": "001",
    "siteNum": "0001",
    "poc": "1",
    "latitude": "40.0",
    "longitude": "-74.0",
    "datum": "WGS84",
    "unitsOfMeasure": "Parts per million",
    "mdl": "0.005",
    "methodType": "FEM",
    "methodCode": "087",
    "methodName": "FIXTURE",
    "countyName": "County 001",
    "dateOfLastChange": "2024-02-01",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _records(seq: F.Column, state: F.Column, param: F.Column, pname: F.Column,
             ts: F.Column, time_text: F.Column | None, local_time_text: F.Column | None,
             measurement_text: F.Column, arrival: F.Column) -> list[F.Column]:
    cols = {
        "stateCode": state,
        "parameterCode": param,
        "parameterName": pname,
        "dateGMT": F.date_format(ts, "yyyy-MM-dd"),
        "timeGMT": time_text,
        "dateLocal": F.date_format(ts - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd"),
        "timeLocal": local_time_text,
        "sampleMeasurement": measurement_text,
        "uncertainty": F.lit(None).cast("string"),
        "qualifier": F.lit(None).cast("string"),
        "stateName": F.concat(F.lit("State "), state),
    }
    out = [seq.cast("long").alias("seq"), arrival.cast("long").alias("arrival")]
    for f in RAW_FIELDS:
        expr = cols[f] if f in cols else F.lit(CONSTANTS[f])
        out.append(expr.cast("string").alias(f))
    return out


def events_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring records from ``events`` (one month, minute times).
    Device = (user_id % 4, event_type); measurement = value / 1000."""
    e = table(spark, sf_dir, "events")
    state = F.concat(F.lit("0"), (F.col("user_id") % 4).cast("string"))
    param = F.lit(None).cast("string")
    for k, v in PARAMETER_CODES.items():
        param = F.when(F.col("event_type") == k, F.lit(v)).otherwise(param)
    local = F.col("ts") - F.expr("INTERVAL 5 HOURS")
    return e.select(*_records(
        seq=F.col("event_id"),
        state=state,
        param=param,
        pname=F.col("event_type"),
        ts=F.col("ts"),
        time_text=F.date_format("ts", "HH:mm"),
        local_time_text=F.date_format(local, "HH:mm"),
        measurement_text=(F.col("value") / 1000).cast("decimal(12,5)").cast("string"),
        arrival=(F.col("event_id") * 7919) % 1000003,
    ))


def orders_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring records from ``orders`` (all twelve months, day times).
    Device = (custkey % 4, first letter of the priority)."""
    o = table(spark, sf_dir, "orders")
    state = F.concat(F.lit("0"), (F.col("o_custkey") % 4).cast("string"))
    return o.select(*_records(
        seq=F.col("o_orderkey"),
        state=state,
        param=F.substring("o_orderpriority", 1, 1),
        pname=F.col("o_orderpriority"),
        ts=F.col("o_orderdate"),
        time_text=F.lit("00:00"),
        local_time_text=F.lit("00:00"),
        measurement_text=(F.floor(F.col("o_totalprice") / 5000) / 1000).cast("decimal(12,5)").cast("string"),
        arrival=(F.col("o_orderkey") * 7919) % 1000003,
    ))


# The event types merged into one hot device, and its key parts.
HOT_EVENT_TYPES = ["view", "click"]
HOT_STATE_CODE = "99"
HOT_PARAMETER_CODE = "00000"


def hot_device_records(records: DataFrame) -> DataFrame:
    """The events records with every ``view`` and ``click`` record moved to
    one device (about 40% of all rows): a skewed input for the hot-device
    plans."""
    hot = F.col("parameterName").isin(*HOT_EVENT_TYPES)
    return (records.withColumn("stateCode", F.when(hot, F.lit(HOT_STATE_CODE)).otherwise(F.col("stateCode")))
                   .withColumn("parameterCode", F.when(hot, F.lit(HOT_PARAMETER_CODE))
                               .otherwise(F.col("parameterCode"))))


# Which records (by ``seq`` modulo 20) the junk view breaks, and how.
JUNK_EVERY = 20
JUNK_NUMBER, JUNK_TIME, JUNK_JSON, JUNK_PROPERTY = 3, 7, 11, 13


def junk_records(records: DataFrame) -> DataFrame:
    """The records with some measurements and times that do not parse."""
    k = F.col("seq") % JUNK_EVERY
    return (records.withColumn("sampleMeasurement", F.when(k == JUNK_NUMBER, F.lit("abc")).otherwise(F.col("sampleMeasurement")))
                   .withColumn("timeGMT", F.when(k == JUNK_TIME, F.lit("99:99")).otherwise(F.col("timeGMT"))))


def junk_wire(wire: DataFrame) -> DataFrame:
    """Wire rows with some values that are not JSON, or have a property too many."""
    k = F.col("seq") % JUNK_EVERY
    more = F.concat(F.lit('{"bogus":1,'), F.substring("value", 2, 1 << 30))
    return wire.withColumn("value", F.when(k == JUNK_JSON, F.lit("not json")).when(k == JUNK_PROPERTY, more)
                           .otherwise(F.col("value")))


def typed(records: DataFrame, strict: bool = False) -> DataFrame:
    """Add the typed columns every operator keys and orders on:
    ``device_key``, ``event_time`` (UTC), ``measurement``."""
    return records.select(
        C.device_key().alias("device_key"),
        C.event_time().alias("event_time"),
        C.measurement(strict=strict).alias("measurement"),
        *records.columns,
    )


def landed(rows: DataFrame, buckets: int | None = None, key: str = "device_key", order: tuple[str, ...] = ("event_time", "seq", "measurement")) -> DataFrame:
    """The rows as a table in the shared folder, in ``buckets`` by ``key`` (default:
    the shuffle partitions), each sorted as the scorer sorts. Written once;
    whatever groups, joins or windows by the key then needs no exchange."""
    import uuid
    from vigil.session import scratch_dir
    spark = rows.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"vigil_landed_{uuid.uuid4().hex}"
    (rows.repartition(n, key).write.bucketBy(n, key).sortBy(key, *order)
     .option("path", scratch_dir(spark, "landed")).saveAsTable(name))
    return spark.table(name)
