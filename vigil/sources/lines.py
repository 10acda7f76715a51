"""CSV files and text lines of monitoring records.

A well-formed file (24 fields a line) is read by the CSV source with a
fixed schema. Mixed files follow the positional record rule: 24 fields give
a record with four zero results; exactly 28 fields also carry the four
results; 25-27 or more than 28 fields ignore the extras; fewer than 24 are
rejected. Empty fields read as empty text, not null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.schema import ENRICHED_FIELDS, RAW_FIELDS, RAW_SCHEMA, RESULT_FIELDS, TEXT28_SCHEMA

# A double-quoted section (its commas are not separators).
QUOTED = r'"[^"]*"'


def field_count(line: F.Column) -> F.Column:
    """Fields of a CSV line: commas outside quotes + 1 (linear in the line)."""
    bare = F.regexp_replace(line, QUOTED, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_csv(spark: SparkSession, path: str, skip_header: bool = True) -> DataFrame:
    """CSV scan of 24-field records; ``skip_header`` drops the first line."""
    df = (spark.read.option("header", str(skip_header).lower()).option("mode", "PERMISSIVE")
          .schema(RAW_SCHEMA).csv(path))
    return df.select(*[F.coalesce(F.col(f), F.lit("")).alias(f) for f in RAW_FIELDS])


def write_csv(records: DataFrame, path: str, header: bool = True) -> None:
    records.select(*RAW_FIELDS).write.mode("overwrite").option("header", str(header).lower()).csv(path)


def line_text(fields: list[str]) -> F.Column:
    """Fields as one comma-separated line (missing values empty, fields with a
    comma or quote quoted)."""
    row = F.struct(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields])
    return F.to_csv(row, {"emptyValue": "", "escape": '"', "ignoreLeadingWhiteSpace": "false",
                          "ignoreTrailingWhiteSpace": "false"})


def record_lines(records: DataFrame, fields: list[str] = ENRICHED_FIELDS) -> DataFrame:
    """Records as lines, with their key and sequence where there are any."""
    return records.select(line_text(fields).alias("value"), *[c for c in ("device_key", "seq") if c in records.columns])


def map_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """Apply the positional record rule to text lines. Output: the 24 text
    fields, the four results (double, never null), ``fields`` (count) and
    ``reason`` (null for accepted lines, else ``short_line`` or
    ``bad_result_field``)."""
    n = field_count(F.col(col))
    parsed = F.from_csv(F.col(col), TEXT28_SCHEMA.simpleString(), {"mode": "PERMISSIVE", "escape": '"'})
    df = lines.select("*", n.alias("fields"), parsed.alias("_p"))
    out = []
    for i, f in enumerate(RAW_FIELDS):
        out.append(F.when(F.col("fields") > i, F.coalesce(F.col(f"_p.{f}"), F.lit(""))).alias(f))
    bad = F.lit(False)
    for f in RESULT_FIELDS:
        v = F.trim(F.col(f"_p.{f}")).try_cast("double")
        out.append(F.when(F.col("fields") == 28, v).otherwise(F.lit(0.0)).alias(f))
        bad = bad | ((F.col("fields") == 28) & v.isNull())
    reason = (F.when(F.col("fields") < 24, F.lit("short_line"))
               .when(bad, F.lit("bad_result_field")))
    keep = [c for c in lines.columns if c != col]
    return df.select(*keep, *out, "fields", reason.alias("reason"))
