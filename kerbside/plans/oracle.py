"""The registered queries again as plain SQL for DuckDB."""

from kerbside.plans.feeds import DISTRICTS, GAPS, TRAFFIC_TYPES


def _names(values):
    return ", ".join(f"'{value}'" for value in values)


def _whole(name, value):
    return value


def _gaps(name, value):
    return f"CASE WHEN event_id % {GAPS[name]} <> 0 THEN {value} END"


def _feeds(field=_whole):
    return f"""
base AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
           ([{_names(DISTRICTS)}])[user_id % {len(DISTRICTS)} + 1] AS district
    FROM events),
traffic AS (
    SELECT event_id, event_type, value, 'cam_' || (user_id % 100) AS sensor_id,
           {field("district", "district")} AS district,
           CAST(48.8 AS DOUBLE) + k / CAST(1000 AS DOUBLE) AS lat,
           CAST(2.3 AS DOUBLE) + k / CAST(1000 AS DOUBLE) AS lon,
           {field("speed_kmh", "CAST(floor(value) AS INT) % 130")} AS speed_kmh,
           {field("vehicle_count", "k % 50")} AS vehicle_count,
           {field("timestamp", "ts")} AS event_time
    FROM base WHERE event_type IN ({_names(TRAFFIC_TYPES)})),
pollution AS (
    SELECT event_id, event_type, value, 'air_' || (user_id % 50) AS sensor_id,
           {field("district", "district")} AS district,
           {field("pm25", "CAST(floor(value) AS INT) % 100")} AS pm25, 400 + k * 2 % 200 AS co2,
           {field("timestamp", "ts")} AS event_time
    FROM base WHERE event_type NOT IN ({_names(TRAFFIC_TYPES)})),
unified AS (
    SELECT event_type, district, event_time AS time, speed_kmh, vehicle_count AS density,
           CAST(NULL AS INT) AS pm25
    FROM traffic
    UNION ALL
    SELECT event_type, district, event_time, NULL, NULL, pm25 FROM pollution)
"""


FEEDS = _feeds()
LEVEL = """CASE WHEN avg_pm25 > 80 THEN 'CRITIQUE' WHEN avg_pm25 > 50 THEN 'WARNING'
                ELSE 'NORMAL' END AS alert_level"""


def _kpi(width, source="unified"):
    return f"""
kpi AS (
    SELECT *, {LEVEL}, avg_pm25 IS NOT NULL AS has_pm25
    FROM (SELECT district, time_bucket(INTERVAL '{width}', time) + INTERVAL '{width}' AS window_end,
                 avg(speed_kmh) AS avg_speed, max(density) AS max_density, avg(pm25) AS avg_pm25
          FROM {source} WHERE time IS NOT NULL GROUP BY ALL))
"""


# A window is out once the watermark, a minute behind the newest event, has passed its end.
def _watermark(newest):
    return f"date_trunc('millisecond', {newest}) - INTERVAL '1 minute'"


ONE_WATERMARK = f"(SELECT {_watermark('max(time)')} FROM unified)"
NEWEST = f"""(SELECT max(time) AS newest FROM lagging WHERE event_type IN ({_names(TRAFFIC_TYPES)})) t,
         (SELECT max(time) AS newest FROM lagging WHERE event_type NOT IN ({_names(TRAFFIC_TYPES)})) p"""
TWO_WATERMARKS = f"(SELECT {_watermark('least(t.newest, p.newest)')} FROM {NEWEST})"
SILENT = "least(t.newest, p.newest), greatest(t.newest, p.newest) - INTERVAL '2 days'"
IDLE_WATERMARK = f"(SELECT {_watermark(f'greatest({SILENT})')} FROM {NEWEST})"

OVERDUE = "('error', 'signup')"
IN_TIME = f"""
in_time AS (
    SELECT unified.* FROM unified,
         (SELECT {_watermark('max(time)')} AS first_watermark FROM unified
          WHERE event_type NOT IN {OVERDUE})
    WHERE event_type NOT IN {OVERDUE}
       OR time_bucket(INTERVAL '1 hour', time) + INTERVAL '1 hour' > first_watermark)
"""

MIDDLE = "make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2)"
CUT = f"(SELECT date_trunc('day', {MIDDLE}) FROM events)"
FIRST_RUN = f"(SELECT {_watermark('max(time)')} FROM unified WHERE time < {CUT})"


def _pairs(name="pairs", condition="true"):
    return f"""
{name} AS (
    SELECT t.district, t.speed_kmh, t.vehicle_count, p.pm25
    FROM traffic t JOIN pollution p
      ON t.district = p.district
     AND date_trunc('hour', t.event_time) = date_trunc('hour', p.event_time)
    WHERE t.speed_kmh IS NOT NULL AND t.vehicle_count IS NOT NULL AND p.pm25 IS NOT NULL
      AND {condition})
"""


PAIRS = _pairs()

def _ridge(source, x1, x2, y, line="line"):
    """Ridge regression of two standardised features in closed form."""
    return f"""
{line}_moments AS (
    SELECT avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my,
           stddev_pop({x1}) AS s1, stddev_pop({x2}) AS s2, stddev_pop({y}) AS sy,
           corr({x1}, {x2}) AS r12, corr({x1}, {y}) AS r1, corr({x2}, {y}) AS r2,
           1 + 0.3 / stddev_pop({y}) AS a
    FROM {source}),
{line}_slopes AS (
    SELECT *, (a * r1 - r12 * r2) / (a * a - r12 * r12) * sy / s1 AS c1,
           (a * r2 - r12 * r1) / (a * a - r12 * r12) * sy / s2 AS c2
    FROM {line}_moments),
{line} AS (SELECT c1, c2, my - c1 * m1 - c2 * m2 AS c0 FROM {line}_slopes)
"""


PAIR_LINE = _ridge("pairs", "speed_kmh", "vehicle_count", "pm25")
SCORED = """
scored AS (
    SELECT kpi.*, c0 + c1 * avg_speed + c2 * max_density AS predicted_pm25 FROM kpi, line)
"""
ALERT = """CASE WHEN predicted_pm25 > 80 AND max_density > 40 THEN 'CRITIQUE'
                WHEN predicted_pm25 > 50 THEN 'WARNING' ELSE 'NORMAL' END AS alert_predicted"""
PREDICTED = f"""SELECT district, window_end, avg_pm25, round(predicted_pm25, 6) AS predicted_pm25,
       alert_level, {ALERT} FROM scored"""
SERVED_COLUMNS = f"""SELECT district, window_end, avg_speed, max_density, avg_pm25,
       round(predicted_pm25, 6) AS predicted_pm25, alert_level, {ALERT} FROM scored"""
HIGH_LINE = _ridge("pairs", "speed_kmh", "vehicle_count", "3 * pm25")
LINE = """SELECT round(c1, 6) AS speed_coefficient, round(c2, 6) AS vehicle_coefficient,
       round(c0, 6) AS intercept FROM line"""

SERVED = f"""
log AS (
    SELECT 0 AS batch_id, district, window_end, avg_speed, max_density, avg_pm25 FROM kpi
    UNION ALL
    SELECT 1, district, window_end, avg_speed, max_density, avg_pm25 + 5 FROM kpi WHERE has_pm25),
served AS (
    SELECT district, window_end, avg_speed, max_density, avg_pm25,
           CAST(NULL AS DOUBLE) AS predicted_pm25, {LEVEL},
           CAST(NULL AS VARCHAR) AS alert_predicted
    FROM (SELECT *, row_number() OVER (PARTITION BY district, window_end
                                       ORDER BY batch_id DESC) AS n FROM log)
    WHERE n = 1)
"""

KPI_COLUMNS = "district, window_end, avg_speed, max_density, avg_pm25, alert_level, has_pm25"
STAMP = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"


def _with(*parts, select):
    return f"WITH {', '.join(parts)} {select}"


def _sensor_counts(feed, *fields):
    line = f"concat_ws('|', sensor_id, district, {', '.join(fields)}, {STAMP.format('event_time')})"
    return f"""SELECT '{feed}' AS feed, sensor_id, count(*) AS messages, count(*) AS dated,
               {STAMP.format('min(event_time)')} AS first_timestamp,
               {STAMP.format('max(event_time)')} AS last_timestamp,
               md5(string_agg({line}, chr(10) ORDER BY {line})) AS payloads
        FROM {feed} GROUP BY ALL"""


def sql():
    hourly = (FEEDS, _kpi("1 hour"))
    pollution_rows = "SELECT sensor_id, pm25, co2, event_time, district FROM pollution"
    closed = f"SELECT {KPI_COLUMNS} FROM kpi WHERE window_end <= {ONE_WATERMARK}"
    lagging = f"""lagging AS (SELECT * FROM unified
                            WHERE event_type IN ({_names(TRAFFIC_TYPES)}) OR time < {CUT})"""
    two_runs = _with(
        *hourly,
        PAIRS,
        PAIR_LINE,
        SCORED,
        f"""told AS (SELECT * REPLACE (CASE WHEN window_end > {FIRST_RUN}
                                            THEN predicted_pm25 END AS predicted_pm25) FROM scored)""",
        select=f"""SELECT district, window_end, avg_speed, max_density, avg_pm25,
                          round(predicted_pm25, 6) AS predicted_pm25, alert_level, {ALERT}
                   FROM told
                   WHERE district IS NOT NULL AND window_end <= {ONE_WATERMARK}""",
    )
    gold = _with(
        *hourly,
        PAIRS,
        PAIR_LINE,
        SCORED,
        select=f"""{SERVED_COLUMNS} WHERE district IS NOT NULL
                   AND window_end <= {ONE_WATERMARK}""",
    )
    retrained = _with(
        *hourly,
        PAIRS,
        PAIR_LINE,
        _pairs("early_pairs", f"t.event_time < {CUT} AND p.event_time < {CUT}"),
        _ridge("early_pairs", "speed_kmh", "vehicle_count", "pm25", "early_line"),
        f"""scored AS (
            SELECT kpi.*, CASE WHEN window_end <= {FIRST_RUN}
                THEN e.c0 + e.c1 * avg_speed + e.c2 * max_density
                ELSE l.c0 + l.c1 * avg_speed + l.c2 * max_density END AS predicted_pm25
            FROM kpi, line l, early_line e)""",
        select=f"""{SERVED_COLUMNS} WHERE district IS NOT NULL
                   AND window_end <= {ONE_WATERMARK}""",
    )
    hourly_means = _with(
        FEEDS,
        select="""
        SELECT t.district, t.hour, mean_speed, mean_pm25
        FROM (SELECT district, date_trunc('hour', event_time) AS hour,
                     avg(speed_kmh) AS mean_speed FROM traffic GROUP BY ALL) t
        JOIN (SELECT district, date_trunc('hour', event_time) AS hour,
                     avg(pm25) AS mean_pm25 FROM pollution GROUP BY ALL) p
          ON t.district = p.district AND t.hour = p.hour""",
    )
    return {
        "bronze_ingest": _with(
            FEEDS,
            select=f"""{_sensor_counts('traffic', 'speed_kmh', 'vehicle_count')}
                       UNION ALL {_sensor_counts('pollution', 'pm25', 'co2')}""",
        ),
        "silver_from_bronze": _with(
            FEEDS,
            select="""SELECT sensor_id, lat, lon, speed_kmh, vehicle_count, event_time, district,
                             CAST(NULL AS INT) AS pm25, CAST(NULL AS INT) AS co2 FROM traffic
                      UNION ALL
                      SELECT sensor_id, NULL, NULL, NULL, NULL, event_time, district, pm25, co2
                      FROM pollution""",
        ),
        "silver_traffic": _with(
            FEEDS,
            select="""SELECT sensor_id, lat, lon, speed_kmh, vehicle_count, event_time, district
                      FROM traffic""",
        ),
        "silver_pollution": _with(FEEDS, select=pollution_rows),
        "silver_replayed": _with(FEEDS, select=pollution_rows),
        "parse_rejects": _with(
            FEEDS,
            select="""
            SELECT 'traffic' AS feed, 'not json ' || event_id AS json,
                   'no readable field' AS reason
            FROM traffic WHERE event_type = 'error'
            UNION ALL
            SELECT 'pollution', NULL, 'null message'
            FROM pollution WHERE event_type <> 'signup' AND NOT value > 50""",
        ),
        "parse_faults": _with(
            FEEDS,
            select="""
            SELECT 'traffic' AS feed, sensor_id, district, event_time,
                   CASE WHEN event_type = 'click' THEN speed_kmh END AS speed_kmh,
                   CASE WHEN event_type = 'view' THEN vehicle_count END AS vehicle_count,
                   CAST(NULL AS INT) AS pm25, CAST(NULL AS INT) AS co2
            FROM traffic WHERE event_type <> 'error'
            UNION ALL
            SELECT 'pollution', sensor_id, district,
                   CASE WHEN event_type <> 'signup' THEN event_time END, NULL, NULL, pm25, co2
            FROM pollution WHERE event_type = 'signup' OR value > 50""",
        ),
        "reject_stream": """
            SELECT CASE WHEN event_type <> 'view' THEN props END AS json,
                   CASE WHEN event_type <> 'view' AND props IS NOT NULL THEN 'no readable field'
                        ELSE 'null message' END AS reason, count(*) AS messages
            FROM events GROUP BY ALL""",
        "unified_events": _with(
            FEEDS, select="SELECT district, time, speed_kmh, density, pm25 FROM unified"
        ),
        "kpi_1m": _with(FEEDS, _kpi("1 minute"), select=f"SELECT {KPI_COLUMNS} FROM kpi"),
        "kpi_1h": _with(*hourly, select=f"SELECT {KPI_COLUMNS} FROM kpi"),
        "kpi_stream_1m": _with(FEEDS, _kpi("1 minute"), select=closed),
        "kpi_stream_1h": _with(*hourly, select=closed),
        "kpi_stream_two_watermarks": _with(
            FEEDS,
            lagging,
            _kpi("1 hour", "lagging"),
            select=f"SELECT {KPI_COLUMNS} FROM kpi WHERE window_end <= {TWO_WATERMARKS}",
        ),
        "kpi_stream_idle": _with(
            FEEDS,
            lagging,
            _kpi("1 hour", "lagging"),
            select=f"SELECT {KPI_COLUMNS} FROM kpi WHERE window_end <= {IDLE_WATERMARK}",
        ),
        "kpi_stream_late": _with(FEEDS, IN_TIME, _kpi("1 hour", "in_time"), select=closed),
        "kpi_stream_carried": _with(*hourly, select=closed),
        "alert_summary": _with(
            *hourly,
            select="SELECT district, alert_level, count(*) AS windows FROM kpi GROUP BY ALL",
        ),
        "training_pairs": _with(
            FEEDS,
            PAIRS,
            select="""SELECT district, CAST(count(*) AS DOUBLE) AS pairs,
                             CAST(sum(speed_kmh) AS DOUBLE) AS speed_sum,
                             CAST(sum(vehicle_count) AS DOUBLE) AS vehicle_sum,
                             CAST(sum(pm25) AS DOUBLE) AS label_sum
                      FROM pairs GROUP BY ALL""",
        ),
        "model_coefficients": _with(FEEDS, PAIRS, PAIR_LINE, select=LINE),
        "model_incremental": _with(FEEDS, PAIRS, PAIR_LINE, select=LINE),
        "model_window_coefficients": _with(
            *hourly,
            """complete AS (SELECT * FROM kpi WHERE avg_speed IS NOT NULL
                            AND max_density IS NOT NULL AND avg_pm25 IS NOT NULL)""",
            _ridge("complete", "avg_speed", "max_density", "avg_pm25"),
            select=LINE,
        ),
        "kpi_predicted": _with(*hourly, PAIRS, PAIR_LINE, SCORED, select=PREDICTED),
        "kpi_predicted_high": _with(*hourly, PAIRS, HIGH_LINE, SCORED, select=PREDICTED),
        "serving_latest": _with(
            *hourly, SERVED, select="SELECT * FROM served ORDER BY district, window_end DESC"
        ),
        "district_series": _with(
            *hourly,
            SERVED,
            select="""SELECT window_end, avg_pm25, predicted_pm25 FROM served
                      WHERE district = 'Centre' ORDER BY window_end DESC""",
        ),
        "gold_serving": gold,
        "gold_crashed": gold,
        "gold_two_runs": two_runs,
        "gold_retrained": retrained,
        "gold_reloaded": retrained,
        "gaps_served": _with(
            _feeds(_gaps),
            _kpi("1 hour"),
            PAIRS,
            PAIR_LINE,
            SCORED,
            select=f"{SERVED_COLUMNS} WHERE district IS NOT NULL",
        ),
        "serving_folded": two_runs,
        "late_corrected": _with(
            *hourly,
            select=f"""SELECT district, window_end, avg_speed, max_density, avg_pm25,
                              CAST(NULL AS DOUBLE) AS predicted_pm25, alert_level,
                              'NORMAL' AS alert_predicted
                       FROM kpi WHERE district IS NOT NULL AND window_end <= {ONE_WATERMARK}""",
        ),
        "gold_new_checkpoint": _with(
            *hourly,
            select=f"""SELECT district, window_end, avg_speed, max_density, avg_pm25,
                              CAST(NULL AS DOUBLE) AS predicted_pm25, alert_level,
                              'NORMAL' AS alert_predicted
                       FROM kpi
                       WHERE district IS NOT NULL AND window_end <= {ONE_WATERMARK}
                         AND (window_end <= {FIRST_RUN} OR window_end > {CUT})""",
        ),
        "history_sql": hourly_means,
        "history_packed": hourly_means,
    }
