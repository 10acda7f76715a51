"""Record layout: the 24 raw text fields, the four result fields, and the
typed view the scoring works on."""

from __future__ import annotations

from pyspark.sql import types as T

# The positional field order of a monitoring record line and
# the four result fields appended to it.
RAW_FIELDS = [
    "stateCode", "countyCode", "siteNum", "parameterCode", "poc",
    "latitude", "longitude", "datum", "parameterName",
    "dateLocal", "timeLocal", "dateGMT", "timeGMT", "sampleMeasurement",
    "unitsOfMeasure", "mdl", "uncertainty", "qualifier",
    "methodType", "methodCode", "methodName",
    "stateName", "countyName", "dateOfLastChange",
]
RESULT_FIELDS = ["prediction", "error", "anomaly", "predictionNext"]
KEY_FIELDS = ["stateCode", "countyCode", "siteNum", "parameterCode", "poc"]

ENRICHED_FIELDS = RAW_FIELDS + RESULT_FIELDS

RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in RAW_FIELDS])

ENRICHED_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in RAW_FIELDS]
    + [T.StructField(f, T.DoubleType(), False) for f in RESULT_FIELDS]
)

# Every field as text, as a 28-column line is split.
TEXT28_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in ENRICHED_FIELDS])

# Wire rows of a topic or landing folder: device key and JSON record.
WIRE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

# Rows of the scorer's sink: enriched wire rows, and quarantined ones with a reason.
SINK_SCHEMA = T.StructType(WIRE_SCHEMA.fields + [
    T.StructField("seq", T.LongType()), T.StructField("record_number", T.LongType()),
    T.StructField("reason", T.StringType())])
