"""Per-record column expressions (keys, times, numbers, JSON, text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.schema import ENRICHED_FIELDS, ENRICHED_SCHEMA, KEY_FIELDS, RESULT_FIELDS

# Fixed value: the date-time pattern of the GMT date and time fields.
EVENT_TIME_PATTERN = "yyyy-MM-dd HH:mm"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def device_key(*parts: str | Column) -> Column:
    """``state-county-site-parameter-poc``. A missing part is written as the
    text ``null`` (string concatenation semantics), so two devices that differ
    only in which part is missing never merge."""
    cols = [_c(p) for p in (parts or KEY_FIELDS)]
    pieces: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(F.coalesce(c, F.lit("null")))
    return F.concat(*pieces)


def event_time(date_col: str | Column = "dateGMT", time_col: str | Column = "timeGMT") -> Column:
    """GMT date + time at minute resolution; a two-digit year is one of 2000 to
    2099. Null when either part is missing or does not parse (the row then goes
    to quarantine)."""
    date = _c(date_col)
    date = F.when(F.length(date) == len("yy-MM-dd"), F.concat(F.lit("20"), date)).otherwise(date)
    text = F.concat(date, F.lit(" "), _c(time_col))
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_PATTERN))


def measurement(col: str | Column = "sampleMeasurement", strict: bool = False) -> Column:
    """The measurement as a double, blanks trimmed. Lenient mode gives null
    for junk (quarantined); strict mode fails the query, as a plain parse does."""
    text = F.trim(_c(col))
    return text.cast("double") if strict else text.try_cast("double")


def month_bucket(date_col: str | Column = "dateGMT", n: int = 10) -> Column:
    """Partition chosen from the month digits of the GMT date: the string hash
    of characters 6..7 (``31*c0 + c1``), made non-negative, modulo ``n``.
    Null when the date is too short to hold a month."""
    d = _c(date_col)
    h = F.ascii(F.substring(d, 6, 1)) * 31 + F.ascii(F.substring(d, 7, 1))
    return F.when(F.length(d) >= 7, F.pmod(h.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(n)))


def device_bucket(key: str | Column = "device_key", n: int = 10) -> Column:
    """Device-stable partition: every record of a device maps to one bucket."""
    return F.pmod(F.hash(_c(key)), F.lit(n))


def record_struct(fields: list[str] = ENRICHED_FIELDS) -> Column:
    return F.struct(*[F.col(f) for f in fields])


def with_zero_results(df):
    """Add the four result fields as 0.0 where a record has none yet."""
    for f in RESULT_FIELDS:
        if f not in df.columns:
            df = df.withColumn(f, F.lit(0.0))
        else:
            df = df.withColumn(f, F.coalesce(F.col(f).cast("double"), F.lit(0.0)))
    return df


def json_encode(fields: list[str] = ENRICHED_FIELDS) -> Column:
    """All properties, missing values written as ``null``."""
    return F.to_json(record_struct(fields), {"ignoreNullFields": "false"})


def json_decode(value: str | Column, corrupt_col: str | None = None, strict: bool = False) -> Column:
    """Parse a JSON record. Lenient mode yields nulls for malformed input
    (optionally keeping the text in ``corrupt_col``); strict mode fails."""
    schema = ENRICHED_SCHEMA
    opts = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    if corrupt_col and not strict:
        from pyspark.sql import types as T
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt_col
    return F.from_json(_c(value), schema, opts)


def json_unknown_keys(value: str | Column) -> Column:
    """Property names present in the JSON text that the record does not have
    (a strict reader rejects such input)."""
    known = F.array(*[F.lit(f) for f in ENRICHED_FIELDS])
    return F.array_except(F.json_object_keys(_c(value)), known)


def json_decode_strict(value: str | Column) -> Column:
    """Parse a JSON record, failing the query on malformed text or on a
    property the record does not have (as a strict object reader does)."""
    unknown = json_unknown_keys(value)
    msg = F.concat(F.lit("unknown record property: "), F.array_join(unknown, ","))
    return F.when(F.size(unknown) > 0, F.raise_error(msg)).otherwise(json_decode(value, strict=True))


def json_outcome(value: str | Column) -> Column:
    """What a strict reader makes of a JSON text, as a value: ``ok``,
    ``malformed`` or ``unknown_property``."""
    broken = json_decode(value, corrupt_col="_corrupt")
    return (F.when(_c(value).isNull() | broken.isNull() | broken["_corrupt"].isNotNull(), F.lit("malformed"))
             .when(F.size(json_unknown_keys(value)) > 0, F.lit("unknown_property"))
             .otherwise(F.lit("ok")))


def record_text(fields: list[str] = ENRICHED_FIELDS) -> Column:
    """``MonitoringRecord [stateCode=…, …, predictionNext=…]``, missing values
    as ``null``, numbers in their shortest text form."""
    parts: list[Column] = [F.lit("MonitoringRecord [")]
    for i, f in enumerate(fields):
        parts.append(F.lit((", " if i else "") + f + "="))
        parts.append(F.coalesce(F.col(f).cast("string"), F.lit("null")))
    parts.append(F.lit("]"))
    return F.concat(*parts)


def null_safe_equal_all(left_prefix: str, right_prefix: str, fields: list[str] = ENRICHED_FIELDS) -> Column:
    """True when every field is equal, nulls equal to nulls."""
    cond = F.lit(True)
    for f in fields:
        cond = cond & F.col(f"{left_prefix}{f}").eqNullSafe(F.col(f"{right_prefix}{f}"))
    return cond
