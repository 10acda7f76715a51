"""DuckDB SQL for every query that has an oracle.

The oracle is written independently of the Spark plans where it matters:
the anomaly score is counted bit by bit from successor lists, not from
bitmaps, and numbering uses DuckDB's own window functions.
"""

from __future__ import annotations

from vigil.schema import RAW_FIELDS
from vigil.settings import DEFAULT, ScoreSettings
from vigil.sources.tables import CONSTANTS, PARAMETER_CODES

RAW_LIST = ", ".join(RAW_FIELDS)


def _d(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def _records_sql(seq: str, state: str, param: str, pname: str, ts: str, time_text: str,
                 local_time_text: str, meas: str, src: str) -> str:
    cols = {
        "stateCode": state,
        "parameterCode": param,
        "parameterName": pname,
        "dateGMT": f"strftime({ts}, '%Y-%m-%d')",
        "timeGMT": time_text,
        "dateLocal": f"strftime({ts} - INTERVAL 5 HOUR, '%Y-%m-%d')",
        "timeLocal": local_time_text,
        "sampleMeasurement": meas,
        "uncertainty": "CAST(NULL AS VARCHAR)",
        "qualifier": "CAST(NULL AS VARCHAR)",
        "stateName": f"'State ' || {state}",
    }
    parts = [f"CAST({seq} AS BIGINT) AS seq", f"CAST(({seq} * 7919) % 1000003 AS BIGINT) AS arrival"]
    for f in RAW_FIELDS:
        expr = cols.get(f, f"'{CONSTANTS.get(f)}'")
        parts.append(f"CAST({expr} AS VARCHAR) AS {f}")
    return f"SELECT {', '.join(parts)} FROM {src}"


def events_records() -> str:
    case = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PARAMETER_CODES.items())
    return _records_sql(
        seq="event_id",
        state="('0' || CAST(user_id % 4 AS VARCHAR))",
        param=f"(CASE event_type {case} END)",
        pname="event_type",
        ts="ts",
        time_text="strftime(ts, '%H:%M')",
        local_time_text="strftime(ts - INTERVAL 5 HOUR, '%H:%M')",
        meas="CAST(CAST(value / 1000 AS DECIMAL(12,5)) AS VARCHAR)",
        src="events")


def orders_records() -> str:
    return _records_sql(
        seq="o_orderkey",
        state="('0' || CAST(o_custkey % 4 AS VARCHAR))",
        param="substr(o_orderpriority, 1, 1)",
        pname="o_orderpriority",
        ts="o_orderdate",
        time_text="'00:00'",
        local_time_text="'00:00'",
        meas="CAST(CAST(floor(o_totalprice / 5000) / 1000 AS DECIMAL(12,5)) AS VARCHAR)",
        src="orders")


DEVICE_KEY = ("coalesce(stateCode, 'null') || '-' || coalesce(countyCode, 'null') || '-' || "
              "coalesce(siteNum, 'null') || '-' || coalesce(parameterCode, 'null') || '-' || "
              "coalesce(poc, 'null')")
EVENT_TIME = "try_strptime(dateGMT || ' ' || timeGMT, '%Y-%m-%d %H:%M')"
MEASUREMENT = "TRY_CAST(trim(sampleMeasurement) AS DOUBLE)"


def typed(records_sql: str) -> str:
    return (f"SELECT {DEVICE_KEY} AS device_key, {EVENT_TIME} AS event_time, "
            f"{MEASUREMENT} AS measurement, * FROM ({records_sql})")


def bucket(x: str, s: ScoreSettings = DEFAULT) -> str:
    clip = f"least(greatest({x}, {_d(s.scalar_min)}), {_d(s.scalar_max)})"
    return (f"CAST(floor(({clip} - {_d(s.scalar_min)} + {_d(s.scalar_resolution / 2)}) "
            f"/ {_d(s.scalar_resolution)}) AS INTEGER)")


def bucket_value(b: str, s: ScoreSettings = DEFAULT) -> str:
    return f"({b} * {_d(s.scalar_resolution)} + {_d(s.scalar_min)})"


def scored(typed_sql: str, s: ScoreSettings = DEFAULT, keep: list[str] | None = None) -> str:
    """Scored rows: device_key, seq, record_number, measurement, kept fields, results."""
    keep = RAW_FIELDS if keep is None else keep
    kept = "".join(f", {k}" for k in keep)
    w = s.scalar_w
    return f"""
WITH t AS (
  SELECT device_key, event_time, seq, measurement{kept}, {bucket('measurement', s)} AS b
  FROM ({typed_sql}) WHERE event_time IS NOT NULL AND measurement IS NOT NULL),
num AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY device_key ORDER BY event_time, seq NULLS FIRST, measurement) - 1 AS BIGINT) AS n,
         lead(b) OVER (PARTITION BY device_key ORDER BY event_time, seq NULLS FIRST, measurement) AS nb
  FROM t),
cnt AS (
  SELECT *, row_number() OVER (PARTITION BY device_key, b, nb ORDER BY n) AS c FROM num),
mode AS (
  SELECT *,
    max({{'c': c, 'n': n, 'nb': nb}}) OVER prior AS best,
    list(DISTINCT nb) FILTER (WHERE nb IS NOT NULL) OVER prior AS succ
  FROM cnt
  WINDOW prior AS (PARTITION BY device_key, b ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pn AS (
  SELECT *, {bucket_value('coalesce(best.nb, b)', s)} AS predictionNext FROM mode),
prv AS (
  SELECT *, lag(predictionNext, 1) OVER byn AS pn1, lag(predictionNext, 2) OVER byn AS pn2,
         lag(measurement, 1) OVER byn AS x1, coalesce(lag(succ, 1) OVER byn, []) AS psucc
  FROM pn WINDOW byn AS (PARTITION BY device_key ORDER BY n))
SELECT device_key, seq, n AS record_number, measurement{kept},
  coalesce(pn1, 0.0::DOUBLE) AS prediction,
  CASE WHEN n >= {s.warmup_rows} THEN abs(pn2 - x1) ELSE 0.0::DOUBLE END AS error,
  CASE WHEN n >= {s.warmup_rows} THEN 1.0::DOUBLE - CAST(len(list_filter(range(b, b + {w}),
        lambda p: len(list_filter(psucc, lambda q: q <= p AND q > p - {w})) > 0)) AS DOUBLE) / {float(w)!r}::DOUBLE
       ELSE 0.0::DOUBLE END AS anomaly,
  predictionNext
FROM prv"""


# --------------------------------------------------------------------------
# Oracle SQL per registered query (events fixture = F1, orders fixture = F1b)
# --------------------------------------------------------------------------

S = DEFAULT
EV = events_records()
OR = orders_records()
TY = typed(EV)
TYO = typed(OR)
SCORED = scored(TY)
RESULTS = "prediction, error, anomaly, predictionNext"


def _raw_coalesced(prefix: str = "") -> str:
    return ", ".join(f"coalesce({prefix}{f}, '') AS {f}" for f in RAW_FIELDS)


def _json(prefix: str = "") -> str:
    parts = [f"'{f}': {prefix}{f}" for f in RAW_FIELDS] + [
        f"'{f}': {prefix}{f}" for f in ("prediction", "error", "anomaly", "predictionNext")]
    return "CAST(to_json({" + ", ".join(parts) + "}) AS VARCHAR)"


def _zeros() -> str:
    return ", ".join(f"0.0::DOUBLE AS {f}" for f in ("prediction", "error", "anomaly", "predictionNext"))


def _text() -> str:
    parts = []
    for i, f in enumerate(RAW_FIELDS + ["prediction", "error", "anomaly", "predictionNext"]):
        parts.append(f"'{', ' if i else ''}{f}=' || coalesce(CAST({f} AS VARCHAR), 'null')")
    return "'MonitoringRecord [' || " + " || ".join(parts) + " || ']'"


def _month_bucket(d: str, n: int) -> str:
    return (f"CASE WHEN length({d}) >= 7 THEN CAST(((ascii(substr({d}, 6, 1)) * 31 + "
            f"ascii(substr({d}, 7, 1))) & 2147483647) % {n} AS INTEGER) END")


def _season_bits(ts: str) -> str:
    c = f"CAST(floor((dayofyear({ts}) - 1) * {S.season_bits} / 366) AS INTEGER)"
    half = S.season_w // 2
    return (f"list_transform(range({c} - {half}, {c} + {S.season_w - half}), "
            f"lambda i: ((i % {S.season_bits}) + {S.season_bits}) % {S.season_bits})")


def _scalar_bits(x: str) -> str:
    b = bucket(x)
    return f"range({b}, {b} + {S.scalar_w})"


def _positions() -> str:
    return (f"SELECT seq, CAST(row_number() OVER (ORDER BY seq) - 1 AS BIGINT) AS position, "
            f"CAST(floor((row_number() OVER (ORDER BY seq) - 1) / {S.replay_batch_size}) AS BIGINT) "
            f"AS replay_batch FROM ({EV})")


def _display() -> str:
    return (f"SELECT *, CAST(row_number() OVER (ORDER BY event_time, seq, measurement, device_key) - 1 AS BIGINT) AS x FROM ("
            f"SELECT s.*, t.event_time FROM ({SCORED}) s JOIN ({TY}) t USING (device_key, seq) "
            f"ORDER BY t.event_time DESC, s.seq DESC, s.measurement DESC, device_key DESC LIMIT {S.display_rows})")


def _series() -> str:
    return " UNION ALL ".join(
        f"SELECT x, '{c}' AS series, CAST({c} AS DOUBLE) AS y FROM ({_display()})"
        for c in ("measurement", "error", "anomaly", "prediction"))


def _points() -> str:
    return f"SELECT x, measurement AS y FROM ({_display()}) WHERE anomaly >= {S.anomaly_threshold!r}"


def _hot(records_sql: str) -> str:
    from vigil.sources.tables import HOT_EVENT_TYPES, HOT_PARAMETER_CODE, HOT_STATE_CODE
    hot = "parameterName IN (" + ", ".join(f"'{t}'" for t in HOT_EVENT_TYPES) + ")"
    return (f"SELECT * REPLACE (CASE WHEN {hot} THEN '{HOT_STATE_CODE}' ELSE stateCode END AS stateCode, "
            f"CASE WHEN {hot} THEN '{HOT_PARAMETER_CODE}' ELSE parameterCode END AS parameterCode) "
            f"FROM ({records_sql})")


def _ties(records_sql: str) -> str:
    return (f"SELECT * REPLACE (CASE WHEN seq % 10 <> 0 THEN CAST(floor(seq / 2) AS BIGINT) END AS seq) "
            f"FROM ({records_sql})")


def _junk(records_sql: str) -> str:
    from vigil.sources.tables import JUNK_EVERY, JUNK_NUMBER, JUNK_TIME
    return (f"SELECT * REPLACE (CASE WHEN seq % {JUNK_EVERY} = {JUNK_NUMBER} THEN 'abc' ELSE sampleMeasurement END AS sampleMeasurement, "
            f"CASE WHEN seq % {JUNK_EVERY} = {JUNK_TIME} THEN '99:99' ELSE timeGMT END AS timeGMT) FROM ({records_sql})")


def _record_map() -> str:
    from vigil.plans.queries import WIDTHS
    values = {f: f"coalesce({f}, '')" for f in RAW_FIELDS}
    values["parameterName"] = "CASE WHEN seq % 7 = 0 THEN parameterName || ', x' ELSE parameterName END"
    width = "CASE CAST(seq % 6 AS INTEGER) " + " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(WIDTHS)) + " END"
    raw = ", ".join(f"CASE WHEN {width} > {i} THEN {values[f]} END AS {f}" for i, f in enumerate(RAW_FIELDS))
    res = ", ".join(f"CASE WHEN {width} = 28 THEN {'CASE WHEN seq % 6 = 5 THEN NULL ELSE 0.3::DOUBLE END' if f == 'anomaly' else f'0.{i + 1}::DOUBLE'} "
                    f"ELSE 0.0::DOUBLE END AS {f}" for i, f in enumerate(("prediction", "error", "anomaly", "predictionNext")))
    reason = f"CASE WHEN {width} < 24 THEN 'short_line' WHEN seq % 6 = 5 THEN 'bad_result_field' END"
    return f"SELECT seq, {raw}, {res}, CAST({width} AS INTEGER) AS fields, {reason} AS reason FROM ({EV})"


def _record_diff() -> str:
    results = ("prediction", "error", "anomaly", "predictionNext")
    n = " + ".join(f"CAST(({f} IS DISTINCT FROM 0.0) AS INTEGER)" for f in results)
    present = " + ".join(f"CAST({f} IS NOT NULL AS INTEGER)" for f in RAW_FIELDS)
    return (f"SELECT device_key, seq, CASE WHEN seq % 13 = 0 THEN 'left_only' WHEN seq % 11 = 0 THEN 'right_only' ELSE 'changed' END AS side, "
            f"CAST(CASE WHEN seq % 13 = 0 OR seq % 11 = 0 THEN {present} + 4 ELSE {n} END AS BIGINT) AS fields_differing FROM ({SCORED}) "
            f"WHERE NOT (seq % 11 = 0 AND seq % 13 = 0) AND (seq % 13 = 0 OR seq % 11 = 0 OR {n} > 0)")


def _record_diff_ties() -> str:
    fields = [*RAW_FIELDS, "prediction", "error", "anomaly", "predictionNext"]
    left = f"SELECT *, {_zeros()} FROM ({typed(_ties(EV))})"
    right = f"SELECT * REPLACE (CASE WHEN arrival % 5 = 0 THEN '2' ELSE poc END AS poc) FROM ({left}) WHERE arrival % 7 <> 0"
    names = ", ".join(["device_key", "seq", *fields])
    order = ", ".join(f"{f} NULLS FIRST" for f in fields)
    differ = " + ".join(f"CAST(l.{f} IS DISTINCT FROM r.{f} AS BIGINT)" for f in fields)
    return (f"WITH a AS (SELECT {names}, 1 AS w FROM ({left}) UNION ALL SELECT {names}, -1 FROM ({right}) UNION ALL "
            f"SELECT {names}, -1 FROM ({right}) WHERE arrival % 9 = 0), "
            f"d AS (SELECT {names}, sum(w) AS w FROM a GROUP BY ALL HAVING sum(w) <> 0), "
            f"x AS (SELECT * EXCLUDE (w), w > 0 AS is_left, unnest(range(CAST(abs(w) AS BIGINT))) AS copy FROM d), "
            f"n AS (SELECT *, row_number() OVER (PARTITION BY device_key, seq, is_left ORDER BY {order}) AS k FROM x) "
            f"SELECT coalesce(l.device_key, r.device_key) AS device_key, coalesce(l.seq, r.seq, -1) AS seq, "
            f"CASE WHEN r.k IS NULL THEN 'left_only' WHEN l.k IS NULL THEN 'right_only' ELSE 'changed' END AS side, {differ} AS fields_differing "
            f"FROM (SELECT * FROM n WHERE is_left) l FULL JOIN (SELECT * FROM n WHERE NOT is_left) r "
            f"ON l.device_key IS NOT DISTINCT FROM r.device_key AND l.seq IS NOT DISTINCT FROM r.seq AND l.k = r.k")


def _metrics() -> str:
    from vigil.plans.queries import SMALL_CHUNK
    from vigil.sources.tables import JUNK_EVERY, JUNK_JSON
    good = scored(f"SELECT * FROM ({typed(_junk(EV))}) WHERE seq % {JUNK_EVERY} <> {JUNK_JSON}")
    return (f"SELECT batch_id, count(*) AS input_rows, count(s.seq) AS good, count(*) - count(s.seq) AS bad, CAST(0 AS BIGINT) AS late, "
            f"count(CASE WHEN anomaly >= {S.anomaly_threshold!r} THEN 1 END) AS anomalous, round(coalesce(sum(error), 0), 6) AS error_sum, "
            f"coalesce(max(error), 0.0::DOUBLE) AS error_max FROM (SELECT seq, CAST(floor((row_number() OVER (ORDER BY seq) - 1) / {SMALL_CHUNK}) "
            f"AS BIGINT) AS batch_id FROM ({EV})) b LEFT JOIN ({good}) s USING (seq) GROUP BY batch_id")


def _transitions() -> str:
    return (f"SELECT device_key, b AS from_bucket, nb AS to_bucket, count(*) AS cnt, max(n) AS last_n FROM ("
            f"SELECT device_key, record_number AS n, {bucket('measurement')} AS b, "
            f"lead({bucket('measurement')}) OVER (PARTITION BY device_key ORDER BY record_number) AS nb FROM ({SCORED})) "
            f"WHERE nb IS NOT NULL GROUP BY ALL")


def _batches(rows: int, more: str) -> str:
    return (f"SELECT batch_id, count(*) AS input_rows, {more} FROM (SELECT CAST(floor((row_number() OVER (ORDER BY seq) - 1) / {rows}) "
            f"AS BIGINT) AS batch_id FROM ({EV})) GROUP BY batch_id")


def _window_summary() -> str:
    return (f"SELECT device_key, CAST(epoch(time_bucket(INTERVAL 60 SECOND, t.event_time)) AS BIGINT) "
            f"AS window_start, count(*) AS rows, round(avg(s.measurement), 9) AS avg_measurement, "
            f"max(s.measurement) AS max_measurement, max(anomaly) AS max_anomaly, "
            f"CAST(sum(CAST(anomaly >= {S.anomaly_threshold!r} AS BIGINT)) AS BIGINT) AS anomalous "
            f"FROM ({SCORED}) s JOIN ({TY}) t USING (device_key, seq) GROUP BY ALL")


def all_sql() -> dict[str, str]:
    from vigil.operators.reports import CHART_SERIES
    from vigil.plans.queries import SMALL_CHUNK
    from vigil.sources.tables import JUNK_EVERY, JUNK_JSON, JUNK_NUMBER, JUNK_PROPERTY, JUNK_TIME
    pairs = " UNION ALL ".join(f"SELECT '{c}' AS chart, '{s}' AS series" for c, s in CHART_SERIES)
    score_cols = f"device_key, seq, record_number, measurement, {RAW_LIST}, {RESULTS}"
    q = {
        "csv_scan": f"SELECT {_raw_coalesced()} FROM ({EV})",
        "record_map": _record_map(),
        "device_key": f"SELECT device_key, seq FROM ({TY})",
        "event_time": f"SELECT device_key, seq, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time FROM ({TY})",
        "measurement": f"SELECT device_key, seq, measurement FROM ({TY})",
        "month_bucket": f"SELECT seq, dateGMT, {_month_bucket('dateGMT', S.month_partitions)} AS month_bucket FROM ({OR})",
        "device_bucket_check": (f"SELECT device_key, CAST(count(DISTINCT {_month_bucket('dateGMT', S.month_partitions)}) "
                                f"AS BIGINT) AS month_partitions, CAST(1 AS BIGINT) AS device_partitions "
                                f"FROM ({TYO}) GROUP BY device_key"),
        "json_encode": f"SELECT device_key AS key, {_json()} AS value FROM (SELECT *, {_zeros()} FROM ({TY}))",
        "json_decode": f"SELECT device_key AS key, {RAW_LIST}, {_zeros()} FROM ({TY})",
        "json_roundtrip": f"SELECT device_key, seq, true AS roundtrip_equal FROM ({TY})",
        "record_diff": _record_diff(),
        "json_decode_strict": (f"SELECT device_key AS key, seq, CASE seq % {JUNK_EVERY} WHEN {JUNK_JSON} THEN 'malformed' "
                               f"WHEN {JUNK_PROPERTY} THEN 'unknown_property' ELSE 'ok' END AS outcome FROM ({TY})"),
        "record_text": f"SELECT device_key, seq, {_text()} AS text FROM (SELECT *, {_zeros()} FROM ({TY}))",
        "quarantine": (f"SELECT device_key, seq, CASE WHEN event_time IS NULL THEN 'bad_time' "
                       f"WHEN measurement IS NULL THEN 'bad_measurement' ELSE 'ok' END AS reason FROM ({typed(_junk(EV))})"),
        "score_quarantine": (f"SELECT device_key, seq, record_number, {RESULTS}, 'ok' AS reason FROM ({scored(typed(_junk(EV)))}) "
                             f"UNION ALL SELECT device_key, seq, -1, -1.0::DOUBLE, -1.0::DOUBLE, -1.0::DOUBLE, -1.0::DOUBLE, CASE WHEN event_time IS NULL THEN 'bad_time' "
                             f"ELSE 'bad_measurement' END FROM ({typed(_junk(EV))}) WHERE event_time IS NULL OR measurement IS NULL"),
        "stream_quarantine": (f"SELECT device_key AS key, seq, CASE seq % {JUNK_EVERY} WHEN {JUNK_JSON} THEN 'bad_json' "
                              f"WHEN {JUNK_TIME} THEN 'bad_time' ELSE 'bad_measurement' END AS reason FROM ({TY}) "
                              f"WHERE seq % {JUNK_EVERY} IN ({JUNK_JSON}, {JUNK_TIME}, {JUNK_NUMBER})"),
        "stream_transitions": _transitions(),
        "batch_overruns": _batches(SMALL_CHUNK, "true AS over_1ms, false AS over_hour"),
        "publish_rate": _batches(SMALL_CHUNK, "true AS rate_fits"),
        "record_diff_ties": _record_diff_ties(),
        "stream_reordered": f"SELECT {score_cols} FROM ({SCORED})",
        "stream_from_history": f"SELECT {score_cols} FROM ({SCORED})",
        "stream_replay": f"SELECT {score_cols} FROM ({SCORED})",
        "stream_metrics": _metrics(),
        "encode_scalar": (f"SELECT device_key, seq, {bucket('measurement')} AS bucket, "
                          f"CAST(list_min({_scalar_bits('measurement')}) AS INTEGER) AS first_bit, "
                          f"CAST(list_max({_scalar_bits('measurement')}) AS INTEGER) AS last_bit, "
                          f"CAST(len({_scalar_bits('measurement')}) AS INTEGER) AS n_bits, "
                          f"CAST(list_sum({_scalar_bits('measurement')}) AS BIGINT) AS bit_sum FROM ({TY})"),
        "encode_season": (f"SELECT device_key, seq, CAST(dayofyear(event_time) AS INTEGER) AS day_of_year, "
                          f"CAST(len(list_distinct({_season_bits('event_time')})) AS INTEGER) AS n_bits, "
                          f"CAST(list_min({_season_bits('event_time')}) AS INTEGER) AS min_bit, "
                          f"CAST(list_max({_season_bits('event_time')}) AS INTEGER) AS max_bit, "
                          f"CAST(list_sum({_season_bits('event_time')}) AS BIGINT) AS bit_sum FROM ({TYO})"),
        "encode_record": (f"SELECT device_key, seq, CAST(len(list_distinct(bits)) AS INTEGER) AS n_bits, "
                          f"CAST(list_max(bits) AS INTEGER) AS max_bit, CAST(list_sum(bits) AS BIGINT) AS bit_sum "
                          f"FROM (SELECT device_key, seq, list_concat({_scalar_bits('measurement')}, "
                          f"list_transform({_season_bits('event_time')}, lambda i: i + {S.scalar_bits})) AS bits "
                          f"FROM ({TYO}))"),
        "record_number": f"SELECT device_key, seq, record_number FROM ({SCORED})",
        "record_number_blocked": f"SELECT device_key, seq, record_number FROM ({SCORED})",
        "predict_next": f"SELECT device_key, seq, record_number, predictionNext FROM ({SCORED})",
        "anomaly_score": f"SELECT device_key, seq, anomaly FROM ({SCORED})",
        "lagged_error": (f"SELECT device_key, seq, error, abs(prediction - measurement) AS aligned_error "
                         f"FROM ({SCORED})"),
        "warmup_gate": (f"SELECT device_key, seq, record_number, record_number < {S.warmup_rows} AS in_warmup, "
                        f"error, anomaly FROM ({SCORED}) WHERE record_number <= {S.warmup_rows}"),
        "score_batch": f"SELECT {score_cols} FROM ({SCORED})",
        "score_segmented": f"SELECT {score_cols} FROM ({SCORED})",
        "score_months": f"SELECT {score_cols} FROM ({scored(TYO)})",
        "score_seq_ties": f"SELECT {score_cols.replace('seq', 'coalesce(seq, -1) AS seq', 1)} FROM ({scored(typed(_ties(EV)))})",
        "score_seq_ties_segmented": f"SELECT {score_cols.replace('seq', 'coalesce(seq, -1) AS seq', 1)} FROM ({scored(typed(_ties(EV)))})",
        "score_hot_device": f"SELECT {score_cols} FROM ({scored(typed(_hot(EV)))})",
        "device_snapshot": (f"SELECT device_key, s.record_number AS record_number, s.measurement AS actual, "
                            f"s.prediction AS prediction, s.error AS error, s.anomaly AS anomaly, "
                            f"s.predictionNext AS prediction_next, {bucket('s.measurement')} AS bucket FROM ("
                            f"SELECT device_key, arg_max({{'record_number': record_number, 'measurement': measurement, "
                            f"'prediction': prediction, 'error': error, 'anomaly': anomaly, "
                            f"'predictionNext': predictionNext}}, record_number) AS s FROM ({SCORED}) GROUP BY device_key)"),
        "score_bucketed": f"SELECT {score_cols} FROM ({SCORED})",
        "stream_state_changes": (f"SELECT device_key, 'update' AS change_type, CAST(1 AS BIGINT) AS state_partitions, max(record_number) AS record_number "
                                 f"FROM (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS p, count(*) OVER () AS total FROM ({SCORED})) "
                                 f"GROUP BY device_key HAVING max(p // {SMALL_CHUNK}) = any_value((total - 1) // {SMALL_CHUNK})"),
        "stream_state": (f"SELECT device_key, s.record_number AS record_number, s.measurement AS actual, "
                         f"s.prediction AS prediction, s.predictionNext AS prediction_next, "
                         f"{bucket('s.measurement')} AS bucket FROM ("
                         f"SELECT device_key, arg_max({{'record_number': record_number, 'measurement': measurement, "
                         f"'prediction': prediction, 'predictionNext': predictionNext}}, record_number) AS s "
                         f"FROM ({SCORED}) GROUP BY device_key)"),
        "device_error_stats": (f"SELECT device_key, count(*) AS rows, round(avg(error), 9) AS mean_error, "
                               f"round(sqrt(avg(error * error)), 9) AS rms_error, round(avg(anomaly), 9) AS mean_anomaly "
                               f"FROM ({SCORED}) WHERE record_number >= {S.warmup_rows} GROUP BY device_key"),
        "raw_publish": (f"SELECT device_key AS key, {_json()} AS value, "
                        f"{_month_bucket('dateGMT', S.month_partitions)} AS partition, seq "
                        f"FROM (SELECT *, {_zeros()} FROM ({TY}))"),
        "replay_batches": _positions(),
        "batch_counts": (f"SELECT replay_batch, count(*) AS records, max(position) + 1 AS sent_total "
                         f"FROM ({_positions()}) GROUP BY replay_batch"),
        "stream_ingest": (f"SELECT device_key, seq, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, "
                          f"measurement FROM ({TY})"),
        "stream_score": f"SELECT {score_cols} FROM ({SCORED})",
        "stream_resume": f"SELECT {score_cols} FROM ({SCORED})",
        "enriched_read": f"SELECT {score_cols} FROM ({SCORED})",
        "order_violations": (f"SELECT device_key, seq, arrival, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, "
                             f"strftime(prev_time, '%Y-%m-%d %H:%M:%S') AS prev_time FROM ("
                             f"SELECT *, lag(event_time) OVER (PARTITION BY device_key ORDER BY arrival, seq, event_time) AS prev_time "
                             f"FROM ({TY})) WHERE event_time < prev_time"),
        "order_violations_blocked": (f"SELECT device_key, seq, arrival, strftime(event_time, '%Y-%m-%d %H:%M:%S') "
                                     f"AS event_time, strftime(prev_time, '%Y-%m-%d %H:%M:%S') AS prev_time FROM ("
                                     f"SELECT *, lag(event_time) OVER (PARTITION BY device_key ORDER BY arrival, seq, event_time) "
                                     f"AS prev_time FROM ({TY})) WHERE event_time < prev_time"),
        "state_uniqueness": (f"SELECT device_key, count(*) AS rows, max(record_number) + 1 AS numbered, "
                             f"count(DISTINCT record_number) AS distinct_numbers, "
                             f"(count(*) = max(record_number) + 1 AND count(*) = count(DISTINCT record_number)) "
                             f"AS one_model FROM ({SCORED}) GROUP BY device_key"),
        "window_summary": _window_summary(),
        "stream_window_summary": _window_summary(),
        "last_n": (f"SELECT device_key, seq, record_number, measurement, {RESULTS} FROM ({_display()})"),
        "last_n_per_device": (f"SELECT device_key, seq, record_number, measurement, {RESULTS} FROM ("
                              f"SELECT s.*, row_number() OVER (PARTITION BY s.device_key ORDER BY t.event_time DESC, "
                              f"s.seq DESC) AS k FROM ({SCORED}) s JOIN ({TY}) t USING (device_key, seq)) "
                              f"WHERE k <= {S.display_rows}"),
        "stream_last_n": (f"SELECT device_key, seq, record_number, measurement, {RESULTS} FROM ("
                              f"SELECT s.*, row_number() OVER (PARTITION BY s.device_key ORDER BY t.event_time DESC, "
                              f"s.seq DESC) AS k FROM ({SCORED}) s JOIN ({TY}) t USING (device_key, seq)) "
                              f"WHERE k <= {S.display_rows}"),
        "chart_series": _series(),
        "anomaly_points": _points(),
        "chart_pairs": (f"SELECT p.chart, s.series, s.x, s.y FROM ({_series()} UNION ALL "
                        f"SELECT x, 'points' AS series, y FROM ({_points()})) s JOIN ({pairs}) p USING (series)"),
    }
    return q
