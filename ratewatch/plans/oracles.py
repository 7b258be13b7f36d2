"""The same results in SQL, over the same Parquet tables."""

from __future__ import annotations

from ratewatch.plans.queries import (
    AS_OF,
    BASE_DATES,
    FIVE_MINUTES,
    HIGH_MEAN,
    LATE,
    MANY,
    MARKER,
    NARROW,
    NUMBERS,
    RECENT,
    REPORT_DATES,
    SERVED_DATES,
    TEN_MINUTES,
    TWO_MARKERS,
)

TICKS = """(SELECT event_id, event_type AS fx_marker, epoch_us(ts)//1000 AS timestamp_ms,
  date_trunc('milliseconds', ts) AS ts, floor(value) AS bid_big,
  CAST(CAST(round(value*100) AS BIGINT)%100 AS INTEGER) AS bid_points,
  floor(value) AS offer_big,
  least(CAST(CAST(round(value*100) AS BIGINT)%100 AS INTEGER)+2, 99) AS offer_points,
  value+0.5 AS hight, value-0.5 AS low, value AS open FROM events)"""

# Of ticks with one key the last is stored.
UNIQUE_TICKS = f"""(SELECT * FROM {TICKS} QUALIFY row_number() OVER
  (PARTITION BY fx_marker, timestamp_ms ORDER BY event_id DESC) = 1)"""

FIELDS = "fx_marker, timestamp_ms, bid_big, bid_points, offer_big, offer_points, hight, low, open"


def _texts() -> str:
    return ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in FIELDS.split(", "))


def _in(values: list) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _dates(days: list) -> str:
    return ", ".join(f"DATE '{day}'" for day in days)


def _start(sec: int) -> str:
    return f"time_bucket(INTERVAL '{sec} seconds', ts)"


def _tumbling(sec: int, where: str = "true", ticks: str = TICKS) -> str:
    start = _start(sec)
    return f"""SELECT fx_marker, {start} AS window_start,
      {start} + INTERVAL '{sec} seconds' AS window_end, count(*) AS count
      FROM {ticks} WHERE {where} GROUP BY ALL"""


def _sliding(duration: int, slide: int, extra: str = "", where: str = "true") -> str:
    start = f"{_start(slide)} - i*INTERVAL '{slide} seconds'"
    return f"""SELECT fx_marker, {start} AS window_start,
      {start} + INTERVAL '{duration} seconds' AS window_end,
      avg(bid_big) AS bid_big_avg, avg(bid_points) AS bid_points_avg {extra}
      FROM {TICKS}, range({duration // slide}) r(i) WHERE {where} GROUP BY ALL"""


def _all_means(form: str, names: list[str] = NUMBERS) -> str:
    return ", ".join(form.format(name) for name in names)


HOURS = _tumbling(3600)
HOUR_MEANS = _sliding(6 * 3600, 3600)
STAT = f"""SELECT fx_marker, avg(count) AS avg_count, stddev_samp(count) AS stddev_count
  FROM ({HOURS}) WHERE CAST(window_start AS DATE) IN ({_dates(BASE_DATES)}) GROUP BY fx_marker"""
LIMITS = f"""SELECT fx_marker, avg_count - 2*stddev_count AS stream_stat_min,
  avg_count + 2*stddev_count AS stream_stat_max FROM ({STAT})"""
ANOMALIES = f"""SELECT c.* FROM ({HOURS}) c JOIN ({LIMITS}) b USING (fx_marker)
  WHERE count < stream_stat_min OR count > stream_stat_max"""
# The wall clock of New York is five hours behind UTC in January.
GATHERED = f"TIMESTAMP '{AS_OF}' - INTERVAL 5 HOUR"


def _unique_anomalies() -> str:
    """Anomalies where ticks of one marker and time count once."""
    hours = _tumbling(3600, ticks=f"(SELECT DISTINCT fx_marker, ts FROM {TICKS})")
    return f"""WITH h AS ({hours}), s AS (
      SELECT fx_marker, avg(count) AS m, stddev_samp(count) AS d FROM h
      WHERE CAST(window_start AS DATE) IN ({_dates(BASE_DATES)}) GROUP BY fx_marker)
      SELECT fx_marker, CAST(CAST(window_start AS DATE) AS VARCHAR) AS timestamp_d, window_start, window_end,
      CAST(count AS DOUBLE) AS anomaly_count FROM h JOIN s USING (fx_marker)
      WHERE count < m - 2 * d OR count > m + 2 * d"""


def _silent(sec: int) -> str:
    """Counts with a row of 0 for windows without ticks, from the first to the last of all markers."""
    step = f"INTERVAL '{sec} seconds'"
    return f"""WITH c AS ({_tumbling(sec)}),
      w AS (SELECT unnest(generate_series(min(window_start), max(window_start), {step})) AS window_start FROM c),
      m AS (SELECT DISTINCT fx_marker FROM c)
      SELECT fx_marker, window_start, window_start + {step} AS window_end, coalesce(count, 0) AS count
      FROM (SELECT * FROM m, w) LEFT JOIN c USING (fx_marker, window_start)"""


def _outside(counts: str, k: float, base: str) -> str:
    return f"""SELECT c.* FROM ({counts}) c JOIN (SELECT fx_marker, avg(count) AS m, stddev_samp(count) AS d
      FROM ({base}) WHERE CAST(window_start AS DATE) IN ({_dates(BASE_DATES)}) GROUP BY fx_marker) USING (fx_marker)
      WHERE count < m - {k} * d OR count > m + {k} * d"""


def _one_marker(sec: int) -> str:
    inner = _tumbling(sec, f"fx_marker = '{MARKER}' AND CAST(ts AS DATE) IN ({_dates(BASE_DATES[:2])})")
    return f"""SELECT '{MARKER}' AS fx_marker, round(avg(count), 6) AS avg_count,
      round(stddev_samp(count), 6) AS stddev_count, {GATHERED} AS stat_gathered_date
      FROM ({inner})"""


MEAN_ROWS = """SELECT fx_marker, CAST(CAST(window_start AS DATE) AS VARCHAR) AS timestamp_d, window_start, window_end,
  bid_big_avg, bid_points_avg FROM"""
ANOMALY_ROWS = """SELECT fx_marker, CAST(CAST(window_start AS DATE) AS VARCHAR) AS timestamp_d, window_start, window_end,
  CAST(count AS DOUBLE) AS anomaly_count FROM"""
SERVED = f"fx_marker = '{MARKER}' AND CAST(ts AS DATE) IN ({_dates(SERVED_DATES)})"
NEWEST = f"ORDER BY ts DESC, event_id DESC LIMIT {RECENT}"

SHOWN = f"""fx_marker = '{MARKER}' AND CAST(window_start AS DATE) IN ({_dates(SERVED_DATES)})
  AND window_start >= (SELECT min(ts) FROM (SELECT ts FROM {TICKS} WHERE {SERVED} {NEWEST}))"""

BASELINE = f"""SELECT fx_marker, round(avg_count, 6) AS avg_count,
  round(stddev_count, 6) AS stddev_count, {GATHERED} AS stat_gathered_date FROM ({STAT})"""

ORACLES: dict[str, str] = {
    "ticks_of_events": f"SELECT event_id, {FIELDS}, ts FROM {TICKS}",
    "wire_parse": f"SELECT event_id, {_texts()} FROM {TICKS} WHERE fx_marker <> 'error'",
    "wire_files": f"SELECT {_texts()} FROM {TICKS} WHERE fx_marker <> 'error'",
    "wire_quarantine": f"""SELECT event_id, 8 AS n_fields,
        concat_ws(',', {FIELDS.rsplit(', ', 1)[0]}) AS line
        FROM {TICKS} WHERE fx_marker = 'error'""",
    "ticks_from_json": f"SELECT event_id, {FIELDS}, ts FROM {TICKS} WHERE fx_marker <> 'error'",
    "frame_single_lines": f"SELECT event_id FROM {TICKS} WHERE fx_marker <> 'error'",
    "frame_sizes": f"""SELECT event_id // 50 AS "offset", count(*) AS records FROM {TICKS}
        WHERE fx_marker <> 'error' GROUP BY ALL""",
    "frame_roundtrip": f"SELECT {FIELDS}, ts FROM {TICKS} WHERE fx_marker <> 'error'",
    "ticks_valid": f"""SELECT event_id, {FIELDS}, ts FROM {TICKS}
        WHERE fx_marker <> 'signup' AND bid_points <> 0""",
    "ticks_quarantine": f"""SELECT event_id, fx_marker, CAST(timestamp_ms AS VARCHAR) AS timestamp_ms,
        CASE WHEN fx_marker = 'signup' THEN 'n/a' ELSE '' END AS bid_points,
        'bid_points' AS bad_fields
        FROM {TICKS} WHERE fx_marker = 'signup' OR bid_points = 0""",
    "ticks_rescued": f"""SELECT * REPLACE (CASE WHEN fx_marker <> 'signup' AND bid_points <> 0
          THEN CAST(bid_points AS DOUBLE) END AS bid_points, CASE WHEN fx_marker <> 'purchase' THEN open END AS open),
        nullif('{{' || concat_ws(',',
          CASE WHEN fx_marker = 'signup' THEN '"bid_points":"n/a"' WHEN bid_points = 0 THEN '"bid_points":""' END,
          CASE WHEN fx_marker = 'purchase' THEN '"open":{{"last":"n/a","tries":' || event_id % 4 || '}}' END,
          CASE WHEN event_id % 3 = 0 THEN '"venue":{{"lots":[' || event_id % 5 || ',7],"name":"v' ||
            event_id % 11 || '"}}' END) || '}}', '{{}}') AS rescued
        FROM {TICKS}""",
    "ticks_with_id": f"""SELECT event_id, sha256(concat_ws('|', fx_marker, timestamp_ms)) AS record_id
        FROM {TICKS}""",
    "ticks_with_time_id": f"""WITH h AS (SELECT event_id, printf('%012x', timestamp_ms) AS t,
          sha256(concat_ws('|', fx_marker, timestamp_ms)) AS k FROM {TICKS})
        SELECT event_id, concat_ws('-', t[1:8], t[9:12], '7' || k[2:4],
          '89ab'[1 + (strpos('0123456789abcdef', k[1]) - 1) % 4] || k[5:7], k[8:19]) AS time_id FROM h""",
    "ticks_latest": f"""SELECT *, timestamp_ms // 3600000 AS hour FROM {TICKS} QUALIFY
        row_number() OVER (PARTITION BY fx_marker, timestamp_ms // 3600000 ORDER BY event_id DESC) = 1""",
    "ticks_corrected": f"""SELECT fx_marker, timestamp_ms, open,
        CASE fx_marker WHEN 'error' THEN -1 WHEN 'view' THEN -2 ELSE bid_points END AS bid_points,
        CAST(CASE fx_marker WHEN 'error' THEN 1 WHEN 'view' THEN 2 ELSE 0 END AS BIGINT) AS batch_id,
        sha256(concat_ws('|', fx_marker, CAST(ts AS DATE), timestamp_ms)) AS record_id
        FROM {UNIQUE_TICKS}""",
    "tumbling_count": _tumbling(10),
    "tumbling_count_hour": HOURS,
    "tumbling_count_marker": _tumbling(3600, f"fx_marker IN ({_in(TWO_MARKERS)})"),
    "tumbling_count_distinct_times": _tumbling(
        86400, ticks=f"(SELECT DISTINCT fx_marker, date_trunc('minute', ts) AS ts FROM {TICKS})"
    ),
    "sliding_mean": _sliding(30, 5),
    "sliding_mean_hours": HOUR_MEANS,
    "sliding_mean_all_numbers": f"""SELECT fx_marker, window_start, window_end, {_all_means("round({0}_avg, 6) AS {0}_avg")}
        FROM ({_sliding(6 * 3600, 3600, ", " + _all_means("avg({0}) AS {0}_avg", NUMBERS[2:]))})""",
    "sliding_mean_day": _sliding(86400, FIVE_MINUTES),
    "tumbling_count_silent": _silent(TEN_MINUTES),
    "anomalies_silent": _outside(_silent(TEN_MINUTES), NARROW, _silent(TEN_MINUTES)),
    "baseline_one_marker": _one_marker(10),
    "baseline_per_marker": BASELINE,
    "baseline_merged_days": BASELINE,
    "stream_day_statistics": BASELINE,
    "baseline_stored_history": _one_marker(3600),
    "count_bounds": f"""SELECT fx_marker, round(stream_stat_min, 6) AS stream_stat_min,
        round(stream_stat_max, 6) AS stream_stat_max FROM ({LIMITS})""",
    "latest_statistics": f"""SELECT fx_marker,
        CAST(window_start AS DATE) + INTERVAL 7 HOUR AS stat_gathered_date,
        round(avg(count), 6) AS avg_count, round(stddev_samp(count), 6) AS stddev_count
        FROM ({HOURS}) GROUP BY fx_marker, CAST(window_start AS DATE) QUALIFY row_number()
        OVER (PARTITION BY fx_marker ORDER BY CAST(window_start AS DATE) DESC) = 1""",
    "anomalies_by_count": ANOMALIES,
    "anomalies_in_message": f"""SELECT * FROM ({HOURS})
        WHERE fx_marker <> 'view' AND (count < 2 OR count > 4)""",
    "envelope_avg_decode": f"{MEAN_ROWS} ({HOUR_MEANS})",
    "envelope_anomaly_decode": f"""SELECT *,
        sha256(concat_ws('|', fx_marker, timestamp_d, epoch_us(window_start))) AS record_id
        FROM ({ANOMALY_ROWS} ({ANOMALIES}))""",
    "recent_ticks": f"SELECT event_id, ts, bid_points FROM {TICKS} WHERE {SERVED} {NEWEST}",
    "recent_means": f"""SELECT window_start, bid_points_avg FROM ({HOUR_MEANS})
        WHERE fx_marker = '{MARKER}' AND CAST(window_start AS DATE) IN ({_dates(SERVED_DATES)})
        ORDER BY window_start DESC LIMIT {RECENT}""",
    "recent_ticks_per_marker": f"""SELECT event_id, fx_marker, ts, bid_points FROM {TICKS} QUALIFY
        row_number() OVER (PARTITION BY fx_marker ORDER BY ts DESC, event_id DESC) <= {RECENT}""",
    "recent_ticks_many": f"""SELECT event_id, fx_marker, ts, bid_points FROM {TICKS} QUALIFY
        row_number() OVER (PARTITION BY fx_marker ORDER BY ts DESC, event_id DESC) <= {MANY}""",
    "anomaly_report": f"""SELECT fx_marker, window_start AS "Time when anomaly was detected",
        CAST(count AS DOUBLE) AS anomaly_count FROM ({ANOMALIES})
        WHERE fx_marker = '{MARKER}' AND CAST(window_start AS DATE) IN ({_dates(REPORT_DATES)})
        ORDER BY window_start DESC LIMIT 10""",
    "anomalies_since_recent": f"""{ANOMALY_ROWS} ({ANOMALIES}) WHERE {SHOWN}""",
    "means_since_recent": f"""{MEAN_ROWS} ({HOUR_MEANS}) WHERE {SHOWN}""",
    "ticks_in_anomaly": f"""SELECT t.event_id, t.fx_marker, t.ts, t.bid_points,
        a.window_start AS anomaly_start, a.window_end AS anomaly_end,
        a.window_start IS NOT NULL AS in_anomaly
        FROM {TICKS} t LEFT JOIN ({ANOMALIES}) a
        ON t.fx_marker = a.fx_marker AND t.ts >= a.window_start AND t.ts < a.window_end""",
    "ticks_in_high_means": f"""SELECT t.event_id, t.fx_marker, t.ts, w.window_start, w.window_end
        FROM {TICKS} t LEFT JOIN (SELECT * FROM ({HOUR_MEANS}) WHERE bid_points_avg >= {HIGH_MEAN}) w
        ON t.fx_marker = w.fx_marker AND t.ts >= w.window_start AND t.ts < w.window_end""",
    "ticks_after_purchase": f"""SELECT p.event_id, t.fx_marker, count(*) AS ticks FROM {TICKS} t
        JOIN (SELECT event_id, ts AS a, ts + bid_points * INTERVAL 1 MINUTE AS b FROM {TICKS}
          WHERE fx_marker = 'purchase') p ON t.ts >= a AND t.ts < b GROUP BY ALL""",
    "stream_sliding_mean": f"{MEAN_ROWS} ({_sliding(30, 5)})",
    "stream_tumbling_count": f"SELECT *, CAST(CAST(window_start AS DATE) AS VARCHAR) AS timestamp_d FROM ({HOURS})",
    "stream_late_rows": f"""SELECT *, CAST(CAST(window_start AS DATE) AS VARCHAR) AS timestamp_d
        FROM ({_tumbling(3600, f"ts < TIMESTAMP '{LATE[0]}' OR ts >= TIMESTAMP '{LATE[1]}'")})""",
    "stream_late_corrected": f"""SELECT *, CAST(CAST(window_start AS DATE) AS VARCHAR) AS timestamp_d
        FROM ({_tumbling(3600, ticks=UNIQUE_TICKS)})""",
    "stream_late_means_corrected": f"{MEAN_ROWS} ({HOUR_MEANS})",
    "stream_silent_anomalies": f"{ANOMALY_ROWS} ({_outside(_silent(3600), NARROW, HOURS)})",
    "stream_anomalies": f"{ANOMALY_ROWS} ({ANOMALIES})",
    "stream_store_ticks": f"""SELECT {FIELDS}, ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS timestamp_d
        FROM {TICKS} WHERE fx_marker <> 'signup' AND bid_points <> 0 QUALIFY row_number() OVER
        (PARTITION BY fx_marker, timestamp_ms ORDER BY event_id DESC) = 1""",
    "stream_store_quarantine": f"""SELECT fx_marker, CAST(timestamp_ms AS VARCHAR) AS timestamp_ms,
        CASE WHEN fx_marker = 'signup' THEN 'n/a' ELSE '' END AS bid_points, 'bid_points' AS bad_fields
        FROM {TICKS} WHERE fx_marker = 'signup' OR bid_points = 0""",
    "stream_publish_store": f"""SELECT * REPLACE (CASE WHEN fx_marker = 'purchase' THEN 0 ELSE bid_points END
        AS bid_points) FROM (SELECT DISTINCT {FIELDS}, ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS timestamp_d
        FROM {UNIQUE_TICKS} WHERE fx_marker <> 'error')""",
    "stream_anomalies_topic": f"{ANOMALY_ROWS} ({ANOMALIES})",
    "stream_stored_statistics": _unique_anomalies(),
    "stream_anomalies_update": f"{ANOMALY_ROWS} ({ANOMALIES})",
    "stream_means_topic": f"{MEAN_ROWS} ({HOUR_MEANS})",
    "stream_bounded_batches": f"SELECT *, CAST(CAST(window_start AS DATE) AS VARCHAR) AS timestamp_d FROM ({HOURS})",
    "recent_ticks_stored": f"""SELECT ts, bid_points, open FROM {TICKS} WHERE fx_marker = '{MARKER}'
        ORDER BY ts DESC, open DESC LIMIT {RECENT}""",
    "stream_recent_view": f"""SELECT fx_marker, ts, bid_points FROM {UNIQUE_TICKS} QUALIFY
        row_number() OVER (PARTITION BY fx_marker ORDER BY ts DESC) <= {RECENT}""",
}
