"""The registered queries stated a second time, in SQL for DuckDB.

Written against the definitions in FIXTURES.md with plain whole-partition windows; nothing here
reads Spark output.
"""

from __future__ import annotations

import re

from lagwatch.functions import texts


def r4(value: str, decimals: int = 4) -> str:
    return f"floor(({value}) * 1e{decimals} + 0.5) / 1e{decimals}"


def half_up(value: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,10)), 2) AS DOUBLE)"


def iso(time: str) -> str:
    return (
        f"CASE WHEN epoch_us({time}) % 1000000 = 0 THEN strftime({time}, '%Y-%m-%dT%H:%M:%SZ') "
        f"ELSE strftime({time}, '%Y-%m-%dT%H:%M:%S.%fZ') END"
    )


def zscore(kind: str, value: str, trained: str, rows: int, threshold: float, where: str) -> str:
    """Rows whose ``value`` is far from the mean of the ``rows`` rows before it."""
    return f"""SELECT *, event_time AS alert_time, '{kind}' AS detection_type,
        '{kind}_' || consumer_group || '_' || CAST(epoch_us(event_time) // 1000000 AS VARCHAR) AS alert_id,
        CASE WHEN anomaly_score > 0.8 THEN 'critical' WHEN anomaly_score > 0.5 THEN 'warning'
          ELSE 'info' END AS severity FROM (
        SELECT *, CASE WHEN s = 0 THEN CASE WHEN {value} = m THEN 0.0 ELSE 1.0 END
          ELSE least(abs({value} - m) / s / 6.0, 1.0) END AS anomaly_score FROM (
          SELECT *, count(*) OVER w AS seen, avg({value}) OVER w AS m, stddev_samp({value}) OVER w AS s
          FROM metrics WHERE {trained} WINDOW w AS (PARTITION BY consumer_group ORDER BY event_time
            ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)) WHERE seen = {rows})
      WHERE anomaly_score > {threshold} AND {where}"""


def regression(kind: str, value: str, trained: str, p: int, rows: int, threshold: float, where: str) -> str:
    """Rows whose ``value`` is far from its least-squares forecast over the ``rows`` rows before it.

    Differences are regressed on the ``p`` differences before each; values are whole ten-thousandths.
    """
    n = rows - 1 - p
    lags = ", ".join(f"lag(y0, {k}) OVER g AS y{k}" for k in range(1, p + 1))
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    sums = ", ".join(
        [f"CAST(sum(y{i}) OVER w AS DOUBLE) AS s{i}" for i in range(p + 1)]
        + [f"CAST(sum(y{i} * y{j}) OVER w AS DOUBLE) AS q{i}{j}" for i, j in pairs]
    )
    moments = ", ".join(f"q{i}{j} * {n} - s{i} * s{j} AS m0{i}{j}" for i, j in pairs)
    sql = f"""SELECT *, {moments} FROM (
      SELECT *, count(*) OVER (g ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING) AS seen, {sums}
      FROM (SELECT *, {lags} FROM (SELECT *, x - lag(x) OVER g AS y0, lag(x) OVER g AS x1 FROM (
          SELECT *, CAST(floor(CAST({value} AS DOUBLE) * 10000 + 0.5) AS HUGEINT) AS x FROM metrics WHERE {trained})
        WINDOW g AS (PARTITION BY consumer_group ORDER BY event_time))
        WINDOW g AS (PARTITION BY consumer_group ORDER BY event_time))
      WINDOW g AS (PARTITION BY consumer_group ORDER BY event_time),
        w AS (PARTITION BY consumer_group ORDER BY event_time ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING))
      WHERE seen = {rows}"""

    def live(k: int) -> str:  # what is left of a lag after the earlier ones
        return f"m{k - 1}{k}{k} > m0{k}{k} * 1e-9"

    for k in range(1, p):  # step k takes lag k out of the later equations; column 0 is the right side
        factor = ", ".join(f"CASE WHEN {live(k)} THEN m{k - 1}{k}{i} / m{k - 1}{k}{k} ELSE 0 END AS f{k}{i}"
                           for i in range(k + 1, p + 1))
        left = ", ".join(f"m{k - 1}{i}{j} - f{k}{i} * m{k - 1}{k}{j} AS m{k}{i}{j}"
                         for i in range(k + 1, p + 1) for j in range(i, p + 1))
        right = ", ".join(f"m{k - 1}0{i} - f{k}{i} * m{k - 1}0{k} AS m{k}0{i}" for i in range(k + 1, p + 1))
        sql = f"SELECT *, {left}, {right} FROM (SELECT *, {factor} FROM ({sql}))"
    for k in range(p, 0, -1):
        rest = "".join(f" - m{k - 1}{k}{j} * b{j}" for j in range(k + 1, p + 1))
        sql = f"""SELECT *, CASE WHEN {live(k)} THEN (m{k - 1}0{k}{rest}) / m{k - 1}{k}{k} ELSE 0 END AS b{k}
          FROM ({sql})"""
    error = "m000" + "".join(f" - b{k} * m00{k}" for k in range(1, p + 1))
    level = "s0" + "".join(f" - b{k} * s{k}" for k in range(1, p + 1))
    ahead = "".join(f" + b{k} * CAST(y{k} AS DOUBLE)" for k in range(1, p + 1))
    return f"""SELECT *, event_time AS alert_time, '{kind}' AS detection_type,
        '{kind}_' || consumer_group || '_' || CAST(epoch_us(event_time) // 1000000 AS VARCHAR) AS alert_id,
        CASE WHEN anomaly_score > 0.8 THEN 'critical' WHEN anomaly_score > 0.5 THEN 'warning'
          ELSE 'info' END AS severity FROM (
        SELECT *, ahead / 10000 AS m, CASE WHEN error <= m000 * 1e-12
            THEN CASE WHEN abs(CAST(x AS DOUBLE) - ahead) <= (abs(ahead) + 1) * 1e-6 THEN 0.0 ELSE 1.0 END
          ELSE least(abs(CAST(x AS DOUBLE) - ahead) / sqrt(error / {n} / {n - p - 1}) / 6.0, 1.0) END AS anomaly_score
        FROM (SELECT *, {error} AS error, CAST(x1 AS DOUBLE) + ({level}) / {n}{ahead} AS ahead FROM ({sql})))
      WHERE anomaly_score > {threshold} AND {where}"""


_CTES = {
    "ev": "SELECT *, user_id % 12 AS g FROM events",
    "num": "SELECT g, value, row_number() OVER (PARTITION BY g ORDER BY ts, event_id) AS n FROM ev",
    "par": """SELECT g, value, n, p, n // 10 AS blk, (n // 10 + g) % 7 AS ph
      FROM num CROSS JOIN (SELECT unnest([0, 1, 2]) AS p)""",
    "ends": """SELECT *,
      1000 * (p + 1) + CAST(sum(CAST(floor(value) AS BIGINT) * (p + 1) + 20)
        OVER (PARTITION BY g, p ORDER BY n) AS BIGINT) AS leo,
      CAST(floor(value * 3) AS BIGINT) * (p + 1) + CASE WHEN ph = 5 THEN 6000 ELSE 0 END
        + CASE WHEN ph = 1 AND p = 0 THEN 9000 ELSE 0 END AS lag0
      FROM par""",
    "commits": "SELECT *, greatest(leo - lag0, 0) AS c0 FROM ends",
    "offs": """SELECT *, CASE WHEN ph = 3
      THEN first_value(c0) OVER (PARTITION BY g, p, blk ORDER BY n) ELSE c0 END AS off FROM commits""",
    "lag": """SELECT 'cluster_1' AS cluster_id, 'group_' || g AS consumer_group,
      'topic_' || (g % 3) AS topic, CAST(p AS INTEGER) AS partition_id, off AS current_offset,
      leo AS log_end_offset, leo - off AS lag,
      TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n * 10) AS poll_time FROM offs""",
    "polls": """SELECT cluster_id, consumer_group, poll_time AS event_time, min(topic) AS topic,
      CAST(sum(lag) AS BIGINT) AS current_lag,
      CAST(sum(current_offset) AS BIGINT) AS total_current_offset,
      CAST(sum(log_end_offset) AS BIGINT) AS total_log_end_offset,
      CAST(count(*) AS INTEGER) AS partition_count,
      CASE WHEN count(*) > 1 AND sum(lag) <> 0
        THEN least(max(lag) / (sum(lag) / count(*)), 5.0) ELSE 0.0 END AS partition_skew_score,
      max(lag) - min(lag) AS partition_skew
      FROM lag GROUP BY cluster_id, consumer_group, poll_time""",
    "prev": """SELECT *,
      (epoch_us(event_time) - epoch_us(lag(event_time) OVER w)) / 1e6 AS dt,
      total_current_offset - lag(total_current_offset) OVER w AS moved,
      total_log_end_offset - lag(total_log_end_offset) OVER w AS grown,
      CAST(coalesce(current_lag - lag(current_lag) OVER w, 0) AS DOUBLE) AS lag_velocity,
      avg(current_lag) OVER d AS lag_24h_avg
      FROM polls WINDOW w AS (PARTITION BY consumer_group ORDER BY event_time),
      d AS (PARTITION BY consumer_group ORDER BY event_time
        RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)""",
    "speeds": """SELECT *, CAST(coalesce(greatest(moved / dt, 0), 0) AS DOUBLE) AS read_speed,
      CAST(coalesce(greatest(grown / dt, 0), 0) AS DOUBLE) AS write_speed FROM prev""",
    "metrics": """SELECT *,
      CASE WHEN read_speed > 0 THEN current_lag / read_speed ELSE 0.0 END AS time_to_catchup_seconds,
      CASE WHEN write_speed > 0 THEN read_speed / write_speed ELSE 1.0 END AS speed_ratio,
      read_speed < write_speed AS is_falling_behind, epoch_us(event_time) // 10000000 AS tick
      FROM speeds""",
    "sorted": """SELECT consumer_group, event_time, list_sort(list(current_lag) OVER (
        PARTITION BY consumer_group ORDER BY event_time
        RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)) AS lags FROM polls""",
    "p95": """SELECT consumer_group, event_time, CAST(lags[
      CAST(least(floor(CAST(0.95 AS DOUBLE) * len(lags)), len(lags) - 1) AS BIGINT) + 1] AS DOUBLE)
      AS lag_percentile_95_24h FROM sorted""",
    "spoilt": """SELECT * REPLACE (CASE WHEN tick % 23 = 0 THEN -1 ELSE current_lag END AS current_lag)
      FROM metrics JOIN p95 USING (consumer_group, event_time)""",
    "formatted": """SELECT * REPLACE (
        CAST(coalesce(current_lag - lag(current_lag) OVER w, 0) AS DOUBLE) AS lag_velocity),
      coalesce((current_lag - lag(current_lag) OVER w)
        / ((epoch_us(event_time) - epoch_us(lag(event_time) OVER w)) / 1e6), 0) AS rate
      FROM spoilt WHERE current_lag >= 0
      WINDOW w AS (PARTITION BY consumer_group ORDER BY event_time)""",
    "alerts": """SELECT *, 'arima_lag_up_' || consumer_group || '_' ||
        CAST(epoch_us(event_time) // 1000000 AS VARCHAR) AS alert_id, event_time AS alert_time,
      'arima_lag_up' AS detection_type,
      CASE WHEN current_lag > lag_24h_avg * 3 THEN 'critical'
        WHEN current_lag > lag_24h_avg * 2 THEN 'warning' ELSE 'info' END AS severity,
      CASE WHEN lag_24h_avg <> 0
        THEN least(1.0, CAST(current_lag AS DOUBLE) / lag_24h_avg / 5.0) END AS anomaly_score
      FROM metrics WHERE current_lag > 1000 AND lag_velocity > 0
        AND current_lag > lag_24h_avg * 1.5""",
    "spikes": """SELECT *, 'threshold_lag_spike_' || consumer_group || '_' ||
        CAST(epoch_us(event_time) // 1000000 AS VARCHAR) AS alert_id, event_time AS alert_time,
      'THRESHOLD_LAG_SPIKE' AS detection_type, 'HIGH' AS severity, 1.0 AS anomaly_score
      FROM metrics WHERE current_lag > 10000""",
    "idle": """SELECT *, datesub('second', last_active, event_time) AS idle_seconds FROM (
      SELECT *, last_value(CASE WHEN read_speed > 0 THEN event_time END IGNORE NULLS) OVER w
        AS last_active, first_value(current_lag) OVER w AS first_lag
      FROM metrics WINDOW w AS (PARTITION BY consumer_group ORDER BY event_time
        RANGE BETWEEN INTERVAL 2 MINUTES PRECEDING AND CURRENT ROW))""",
    "inactive": """SELECT *, 'threshold_inactive_' || consumer_group || '_' ||
        CAST(epoch_us(event_time) // 1000000 AS VARCHAR) AS alert_id, event_time AS alert_time,
      'threshold_inactive' AS detection_type, 'critical' AS severity, 1.0 AS anomaly_score
      FROM idle WHERE idle_seconds > 60 AND idle_seconds < 120 AND current_lag > 0""",
    "storms": """SELECT *, 'threshold_rebalance_' || consumer_group || '_' ||
        CAST(epoch_us(event_time) // 1000000 AS VARCHAR) AS alert_id, event_time AS alert_time,
      'threshold_rebalance_storm' AS detection_type,
      CASE WHEN zeros > 5 THEN 'critical' WHEN zeros > 3 THEN 'warning' ELSE 'info' END AS severity,
      least(zeros / 10.0, 1.0) AS anomaly_score
      FROM (SELECT *, count(*) FILTER (WHERE read_speed = 0) OVER w AS zeros,
          var_samp(read_speed) OVER w AS variance, avg(read_speed) OVER w AS mean
        FROM metrics WINDOW w AS (PARTITION BY consumer_group ORDER BY event_time
          RANGE BETWEEN INTERVAL 3 MINUTES PRECEDING AND CURRENT ROW))
      WHERE zeros >= 3 AND (variance > mean * 0.5 OR mean = 0)
        AND (epoch_us(event_time) // 1000000) % 180 < 10""",
    "zlag": zscore(
        "arima_lag_up", "current_lag", "current_lag > 0", 100, 0.5, "lag_velocity > 0 AND current_lag > 1000"
    ),
    "zspeed": zscore(
        "arima_speed_down", "read_speed", "read_speed > 0", 100, 0.5,
        "read_speed < m AND (m - read_speed) / m > 0.2",
    ),
    "zskew": zscore(
        "arima_hot_partition", "partition_skew_score", "partition_count > 1 AND partition_skew_score > 0", 80, 0.6,
        "partition_skew_score > m AND partition_skew_score > 2.0",
    ),
    "lowspeed": zscore(
        "arima_speed_down", "read_speed", "read_speed > 0", 20, 0.1,
        "read_speed < m AND (m - read_speed) / m > 0.2",
    ),
    "lowskew": zscore(
        "arima_hot_partition", "partition_skew_score", "partition_count > 1 AND partition_skew_score > 0", 20, 0.1,
        "partition_skew_score > m AND partition_skew_score > 2.0",
    ),
    "arlag": regression(
        "arima_lag_up", "current_lag", "current_lag > 0", 3, 100, 0.5, "lag_velocity > 0 AND current_lag > 1000"
    ),
    "arspeed": regression(
        "arima_speed_down", "read_speed", "read_speed > 0", 3, 20, 0.1,
        "read_speed < m AND (m - read_speed) / m > 0.2",
    ),
    "arskew": regression(
        "arima_hot_partition", "partition_skew_score", "partition_count > 1 AND partition_skew_score > 0", 2, 80, 0.6,
        "partition_skew_score > m AND partition_skew_score > 2.0",
    ),
    "topics": """SELECT *, count(DISTINCT consumer_group) FILTER (WHERE is_falling_behind
        OR lag_velocity > 100 OR read_speed < lag_24h_avg * 0.5) OVER w AS affected,
      count(DISTINCT consumer_group) OVER w AS total
      FROM metrics WINDOW w AS (PARTITION BY topic ORDER BY event_time
        RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW)""",
    "corr": """SELECT 'correlation_' || topic || '_' ||
        CAST(epoch_us(event_time) // 1000000 AS VARCHAR) AS alert_id, event_time AS alert_time,
      'correlation_multi_group' AS detection_type,
      CASE WHEN affected >= 3 THEN 'critical' WHEN affected = 2 THEN 'warning' ELSE 'info' END
        AS severity,
      cluster_id, min(consumer_group) AS consumer_group, topic,
      CAST(sum(current_lag) AS BIGINT) AS current_lag, avg(read_speed) AS read_speed,
      avg(write_speed) AS write_speed, max(time_to_catchup_seconds) AS time_to_catchup_seconds,
      avg(partition_skew_score) AS partition_skew_score, least(affected / 5.0, 1.0) AS anomaly_score,
      affected, total, string_agg(DISTINCT consumer_group, ', ' ORDER BY consumer_group) AS groups
      FROM topics WHERE affected >= 2 AND (is_falling_behind OR lag_velocity > 100)
      GROUP BY event_time, cluster_id, topic, affected, total
      HAVING (epoch_us(min(event_time)) // 1000000) % 300 < 10""",
    "enriched": """SELECT alert_id, 'diagnosis ' || v AS diagnosis,
      CASE WHEN v = 2 THEN 'HIGH' END AS severity, 'Scale ' || consumer_group AS recommended_action,
      '{"current_lag":' || current_lag || '}' AS metric_details, v,
      alert_time + to_seconds(v) AS "timestamp"
      FROM alerts, (SELECT unnest([1, 2]) AS v)
      WHERE tick % 2 = 0 OR v = 1""",
    "feedback": """SELECT alert_id, detection_type, alert_time + to_seconds(delay) AS moment,
      CASE WHEN (tick % 3 > 0) = (delay = 1) THEN 'up' ELSE 'down' END AS feedback
      FROM alerts, (SELECT unnest([1, 60]) AS delay) WHERE delay = 1 OR tick % 5 = 0""",
    "sim": """SELECT event_id, ts AS event_time, 'group_' || g AS consumer_group,
      'topic_' || (g % 3) AS topic, CAST(floor(value) AS INTEGER) AS message_count,
      CASE event_type WHEN 'error' THEN 'rebalance_storm' WHEN 'purchase' THEN 'lag_spike' END
        AS scenario_name,
      CASE WHEN event_type IN ('error', 'purchase') THEN 'anomaly_injection'
        ELSE 'baseline_event' END AS event_type,
      CASE WHEN event_type IN ('error', 'purchase') THEN 'run_' || user_id END AS scenario_id FROM ev""",
    "raw": """SELECT 'simulator_events' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
        event_time AS moment, consumer_group AS key FROM sim
      UNION ALL SELECT 'velocity_anomaly_alerts', CAST(tick % 3 AS INTEGER), alert_time, alert_id
        FROM alerts
      UNION ALL SELECT 'metrics_source', CAST(tick % 3 AS INTEGER), event_time, consumer_group
        FROM metrics""",
    "messages": """SELECT topic, "partition", key,
      row_number() OVER (PARTITION BY topic, "partition" ORDER BY moment, key) - 1 AS "offset" FROM raw""",
    "samples": """SELECT 'topic_' || (user_id % 7) AS topic, ts, value, event_type,
      CAST(floor(value * 1024) AS DOUBLE) AS received_bytes,
      CAST(floor(value * 900) AS DOUBLE) AS sent_bytes, 1.0 AS received_records,
      CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END AS sent_records,
      sum(CAST(floor(value * 1024) AS DOUBLE)) OVER (PARTITION BY user_id % 7 ORDER BY ts, event_id)
        AS retained_bytes FROM events""",
    "hourly": """SELECT topic, date_trunc('hour', ts) AS bucket,
      CAST(sum(received_bytes) AS DOUBLE) AS received_bytes,
      CAST(sum(sent_bytes) AS DOUBLE) AS sent_bytes,
      CAST(sum(received_records) AS DOUBLE) AS received_records,
      CAST(sum(sent_records) AS DOUBLE) AS sent_records,
      arg_max(retained_bytes, ts) AS retained_bytes FROM samples GROUP BY ALL""",
    "daily": """SELECT topic, date_trunc('day', ts) AS bucket,
      CAST(sum(received_bytes) AS DOUBLE) AS received_bytes,
      CAST(sum(sent_bytes) AS DOUBLE) AS sent_bytes,
      CAST(sum(received_records) AS DOUBLE) AS received_records,
      CAST(sum(sent_records) AS DOUBLE) AS sent_records FROM samples GROUP BY ALL""",
}


def _mentioned(sql: str) -> list[str]:
    return [name for name in _CTES if re.search(rf"\b(FROM|JOIN|,) {name}\b", sql)]


def _sql(body: str) -> str:
    """The statement behind the common tables it needs, in order of definition."""
    needed: set[str] = set()
    queue = _mentioned(body)
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue += _mentioned(_CTES[name])
    tables = ",\n".join(f"{name} AS ({sql})" for name, sql in _CTES.items() if name in needed)
    return f"WITH {tables}\n{body}" if tables else body


def _doubles(*names: str) -> str:
    return ", ".join(f"{r4(name)} AS {name}" for name in names)


_TIMED = f"consumer_group, {iso('event_time')} AS event_time"
_ALERT = (
    f"alert_id, {iso('alert_time')} AS alert_time, detection_type, severity, cluster_id, "
    "consumer_group, topic, current_lag, "
    + _doubles(
        "read_speed", "write_speed", "time_to_catchup_seconds", "partition_skew_score",
        "anomaly_score",
    )
)
_LAG_CONTEXT = (
    r4(half_up("CAST(current_lag AS DOUBLE) / lag_24h_avg")) + " AS ctx_lag_vs_avg_ratio, "
    f"current_lag AS ctx_actual_lag, {r4('lag_24h_avg')} AS ctx_lag_24h_avg, "
    f"{r4('lag_velocity')} AS ctx_lag_velocity, CAST(10 AS INTEGER) AS ctx_window_size_minutes, "
    "'THRESHOLD' AS ctx_model_type"
)
#: A stream holds back the rows that its watermark has not passed.
_PASSED = "event_time <= (SELECT max(event_time) - INTERVAL 30 SECONDS FROM metrics)"
_ALERT_COLUMNS = (
    "alert_id, alert_time, detection_type, severity, cluster_id, consumer_group, topic, "
    "current_lag, read_speed, write_speed, time_to_catchup_seconds, partition_skew_score, "
    "anomaly_score"
)


def _bodies() -> dict[str, str]:
    q: dict[str, str] = {}

    q["scan_metrics_source"] = f"""SELECT {iso('event_time')} AS "timestamp",
      {iso('event_time')} AS event_time, cluster_id, consumer_group, topic, current_lag,
      {_doubles('read_speed', 'lag_24h_avg', 'lag_percentile_95_24h')}, partition_count,
      partition_count AS nested FROM metrics JOIN p95 USING (consumer_group, event_time)"""
    q["scan_multi_topic"] = 'SELECT topic, "partition", "offset", key FROM messages'
    q["topic_dispatch"] = f"""SELECT m."partition", m."offset", a.alert_id,
      {iso('a.alert_time')} AS alert_time, a.severity, a.consumer_group, a.topic, a.current_lag,
      {r4('a.anomaly_score')} AS anomaly_score
      FROM messages m JOIN alerts a ON m.topic = 'velocity_anomaly_alerts' AND m.key = a.alert_id"""
    q["schema_valid"] = f"""SELECT consumer_group AS key, {iso('event_time')} AS "timestamp", topic,
      current_lag, {_doubles('read_speed')}, partition_count FROM metrics
      WHERE tick % 17 <> 0 AND tick % 11 <> 0 AND tick % 13 <> 0"""
    q["schema_quarantine"] = """SELECT CASE WHEN tick % 17 = 0 THEN 'malformed'
        WHEN tick % 11 = 0 THEN 'missing:topic' ELSE 'type:current_lag' END AS reason,
      count(*) AS records FROM metrics
      WHERE tick % 17 = 0 OR tick % 11 = 0 OR tick % 13 = 0 GROUP BY 1"""
    q["partitions_nest"] = f"""SELECT consumer_group, {iso('poll_time')} AS event_time,
      '[' || string_agg('{{"partition_id":' || partition_id || ',"topic":"' || topic || '","lag":'
        || lag || ',"consumed_offset":' || current_offset || ',"log_end_offset":'
        || log_end_offset || '}}', ',' ORDER BY partition_id) || ']' AS partitions
      FROM lag GROUP BY consumer_group, poll_time"""
    q["partitions_explode"] = f"""SELECT consumer_group, {iso('poll_time')} AS event_time,
      partition_id, topic, lag, current_offset AS consumed_offset, log_end_offset FROM lag"""
    q["scan_consumer_lag"] = f"""SELECT cluster_id, consumer_group, topic, partition_id,
      current_offset, log_end_offset, lag, {iso('poll_time')} AS poll_time FROM lag"""
    q["feedback_latest"] = f"""SELECT alert_id, feedback, {iso('moment')} AS "timestamp" FROM (
      SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY moment DESC) AS r FROM feedback)
      WHERE r = 1"""
    q["compact_latest"] = """SELECT key, value, "partition", "offset" FROM (
      SELECT 'group_' || g AS key, CASE WHEN event_id % 17 <> 0 THEN props END AS value,
        CAST(g % 6 AS INTEGER) AS "partition", event_id AS "offset",
        row_number() OVER (PARTITION BY g ORDER BY event_id DESC) AS r FROM ev)
      WHERE r = 1 AND value IS NOT NULL"""
    q["retention_filter"] = f"""SELECT event_id, {iso('event_time')} AS event_time, consumer_group
      FROM sim WHERE event_time >= (SELECT max(event_time) FROM sim) - INTERVAL 7 DAYS"""
    q["event_type_class"] = "SELECT event_id, event_type FROM sim"
    q["alerts_upsert"] = f"""SELECT alert_id, {iso('alert_time')} AS alert_time,
      CASE WHEN tick % 2 = 0 THEN 'critical' ELSE severity END AS severity,
      CAST(CASE WHEN tick % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS revision, current_lag
      FROM alerts"""

    q["group_rollup"] = f"""SELECT cluster_id, {_TIMED}, topic, current_lag, total_current_offset,
      total_log_end_offset, partition_count, {_doubles('partition_skew_score')}, partition_skew
      FROM polls"""
    q["partition_skew"] = f"""SELECT {_TIMED}, {_doubles('partition_skew_score')}, partition_skew
      FROM polls"""
    q["group_speeds"] = f"SELECT {_TIMED}, {_doubles('read_speed', 'write_speed')} FROM speeds"
    q["group_metrics"] = f"""SELECT {_TIMED}, cluster_id, topic, current_lag,
      {_doubles('read_speed', 'write_speed', 'time_to_catchup_seconds', 'partition_skew_score',
                'lag_24h_avg', 'lag_percentile_95_24h', 'lag_velocity', 'speed_ratio')},
      partition_count, is_falling_behind FROM metrics JOIN p95 USING (consumer_group, event_time)"""
    q["lag_24h_avg"] = f"SELECT {_TIMED}, {_doubles('lag_24h_avg')} FROM prev"
    q["lag_24h_p95"] = f"SELECT {_TIMED}, {_doubles('lag_percentile_95_24h')} FROM p95"
    q["format_metrics"] = f"""SELECT {_TIMED}, cluster_id, topic, current_lag,
      {_doubles('read_speed', 'write_speed', 'time_to_catchup_seconds', 'partition_skew_score',
                'lag_24h_avg', 'lag_percentile_95_24h', 'lag_velocity', 'speed_ratio')},
      partition_count, is_falling_behind FROM formatted"""
    q["lag_velocity_rate"] = f"SELECT {_TIMED}, {r4('rate')} AS lag_velocity FROM formatted"

    q["threshold_lag_up"] = f"SELECT {_ALERT}, {_LAG_CONTEXT} FROM alerts"
    q["threshold_lag_spike"] = f"""SELECT {_ALERT},
      'Consumer lag exceeded 10K messages: ' || current_lag AS context FROM spikes"""
    q["threshold_inactive"] = f"""SELECT {_ALERT}, idle_seconds AS ctx_inactive_duration_seconds,
      strftime(last_active, '%Y-%m-%d %H:%M:%S') AS ctx_last_active_time,
      current_lag - coalesce(first_lag, current_lag) AS ctx_lag_growth,
      'Check consumer group health, deployments, and network connectivity' AS ctx_recommendation
      FROM inactive"""
    q["rebalance_storm"] = f"""SELECT {_ALERT}, zeros AS ctx_zero_speed_events,
      CAST(3 AS INTEGER) AS ctx_window_minutes, {r4('variance')} AS ctx_speed_variance,
      {r4('mean')} AS ctx_avg_speed,
      'Consumer group rebalancing or instance restarts' AS ctx_possible_cause,
      'Check for frequent pod restarts, autoscaling events, or static membership configuration'
        AS ctx_recommendation FROM storms"""
    q["correlation"] = f"""SELECT {_ALERT}, affected AS ctx_affected_groups,
      total AS ctx_total_groups_on_topic, groups AS ctx_degrading_groups,
      CASE WHEN affected >= total * 0.8
        THEN 'Likely producer or broker issue (most groups affected)'
        ELSE 'Mixed issue - check both producer and consumer health' END AS ctx_root_cause,
      'Investigate topic write throughput, broker metrics, and producer health'
        AS ctx_recommendation FROM corr"""
    q["moving_avg_spike"] = f"""SELECT {_TIMED}, 'READ_SPEED_SPIKE' AS detection_type,
      'critical' AS severity, {r4('read_speed', 7)} AS value, {r4('m', 7)} AS moving_avg FROM (
        SELECT *, avg(read_speed) OVER (PARTITION BY consumer_group ORDER BY event_time
          ROWS BETWEEN 100 PRECEDING AND CURRENT ROW) AS m FROM metrics)
      WHERE read_speed > m * 2"""
    q["rule_table"] = f"""SELECT {_TIMED}, cluster_id, topic, detector, measure,
      {r4('value')} AS value, CASE WHEN value > critical THEN 'critical' ELSE 'high' END AS severity
      FROM (SELECT *, 'current_lag' AS measure, CAST(current_lag AS DOUBLE) AS value FROM metrics
        UNION ALL SELECT *, 'lag_velocity', lag_velocity FROM metrics
        UNION ALL SELECT *, 'partition_skew_score', partition_skew_score FROM metrics)
      JOIN (VALUES ('deep_backlog', 'current_lag', 7500, 3200),
        ('fast_growth', 'lag_velocity', 2000, 1000), ('skew', 'partition_skew_score', 2.5, 2.0))
        AS rules(detector, measure, critical, high) USING (measure) WHERE value > high"""
    def miss(value: str) -> str:
        return f"{r4(half_up(f'abs({value} - m) / m * 100'))} AS ctx_deviation_percent"

    q["zscore_lag_up"] = f"""SELECT {_ALERT}, {r4('m')} AS ctx_predicted_lag,
      current_lag AS ctx_actual_lag, {miss('current_lag')}, {r4('lag_velocity')} AS ctx_lag_velocity,
      CAST(10 AS INTEGER) AS ctx_window_size_minutes, 'ZSCORE' AS ctx_model_type FROM zlag"""
    q["zscore_speed_down"] = f"""SELECT {_ALERT}, {r4('m')} AS ctx_predicted_speed,
      {r4('read_speed')} AS ctx_actual_speed, {miss('read_speed')},
      {r4('speed_ratio')} AS ctx_speed_ratio, is_falling_behind AS ctx_is_falling_behind,
      'ZSCORE' AS ctx_model_type FROM lowspeed"""
    q["zscore_hot_partition"] = f"""SELECT {_ALERT}, {r4('m')} AS ctx_predicted_skew,
      {r4('partition_skew_score')} AS ctx_actual_skew, {miss('partition_skew_score')},
      partition_count AS ctx_partition_count, '{texts.HOT_PARTITION_ADVICE}' AS ctx_recommendation,
      'ZSCORE' AS ctx_model_type FROM lowskew"""
    for name, zscored, found in (
        ("ar_lag_up", "zscore_lag_up", "arlag"),
        ("ar_speed_down", "zscore_speed_down", "arspeed"),
        ("ar_hot_partition", "zscore_hot_partition", "arskew"),
    ):
        columns = q[zscored].rsplit(" FROM ", 1)[0]
        q[name] = f"{columns.replace("'ZSCORE'", "'AR'")} FROM {found}"
    q["all_alerts"] = f"""SELECT {_ALERT} FROM (
      SELECT {_ALERT_COLUMNS} FROM alerts UNION ALL SELECT {_ALERT_COLUMNS} FROM spikes
      UNION ALL SELECT {_ALERT_COLUMNS} FROM inactive UNION ALL SELECT {_ALERT_COLUMNS} FROM storms
      UNION ALL SELECT {_ALERT_COLUMNS} FROM corr UNION ALL SELECT {_ALERT_COLUMNS} FROM zlag
      UNION ALL SELECT {_ALERT_COLUMNS} FROM zspeed UNION ALL SELECT {_ALERT_COLUMNS} FROM zskew)"""

    q["alerts_enriched"] = f"""SELECT {_ALERT.replace('severity', 'coalesce(es, severity) AS severity')},
      {_LAG_CONTEXT}, diagnosis, recommended_action, metric_details, {iso('"timestamp"')} AS "timestamp"
      FROM alerts LEFT JOIN (SELECT alert_id, diagnosis, severity AS es, recommended_action,
          metric_details, "timestamp",
          row_number() OVER (PARTITION BY alert_id ORDER BY v DESC) AS r FROM enriched) e
      USING (alert_id) WHERE (r IS NULL OR r = 1)"""
    q["alerts_correlated"] = f"""SELECT topic, {iso('alert_time')} AS alert_time, recent_alerts,
      correlated_groups, 'same_topic_degradation' AS correlation_type,
      'broker_or_producer_issue' AS root_cause_probability,
      'Check broker health and producer for topic ' || topic AS recommended_action FROM (
        SELECT t.topic, t.alert_time, count(*) AS recent_alerts,
          string_agg(DISTINCT a.consumer_group, ', ' ORDER BY a.consumer_group) AS correlated_groups
        FROM (SELECT DISTINCT topic, alert_time FROM alerts) t JOIN alerts a ON a.topic = t.topic
          AND a.alert_time BETWEEN t.alert_time - INTERVAL 5 MINUTES AND t.alert_time
        GROUP BY ALL) WHERE recent_alerts >= 3"""
    q["alerts_first_in_bucket"] = f"""SELECT {_ALERT}, {_LAG_CONTEXT} FROM (
      SELECT *, row_number() OVER (PARTITION BY detection_type, consumer_group,
        (epoch_us(alert_time) // 1000000) // 300 ORDER BY alert_time, alert_id) AS r FROM alerts)
      WHERE r = 1"""
    q["feedback_by_type"] = """SELECT detection_type,
      count(*) FILTER (WHERE feedback = 'up') AS up,
      count(*) FILTER (WHERE feedback = 'down') AS down FROM feedback GROUP BY detection_type"""
    q["route_severe"] = f"""SELECT alert_id, {iso('alert_time')} AS alert_time, severity,
      consumer_group FROM alerts WHERE severity IN ('critical', 'high')"""
    q["severity_class"] = """SELECT alert_id, severity,
      CASE WHEN severity = 'critical' THEN 'high' ELSE 'medium' END AS severity_class FROM alerts"""
    q["merge_sources"] = f"""SELECT p.consumer_group, {iso('p.event_time')} AS event_time,
      coalesce(s.topic, p.topic) AS topic, p.current_lag, s.heap_used_mb
      FROM polls p LEFT JOIN (SELECT consumer_group, epoch_us(event_time) // 60000000 AS slot,
          arg_max('runtime_' || topic, event_time) AS topic,
          arg_max(total_log_end_offset % 4096, event_time) AS heap_used_mb FROM polls
        WHERE (epoch_us(event_time) // 1000000) % 30 = 0 GROUP BY ALL) s
      ON s.consumer_group = p.consumer_group AND s.slot = epoch_us(p.event_time) // 60000000"""

    q["latest_per_group"] = f"""SELECT {_TIMED}, topic, current_lag,
      {_doubles('read_speed', 'write_speed', 'time_to_catchup_seconds', 'lag_velocity')} FROM (
        SELECT *, row_number() OVER (PARTITION BY consumer_group ORDER BY event_time DESC) AS r
        FROM metrics) WHERE r = 1"""
    q["recent_metrics"] = f"""SELECT {_TIMED}, topic, current_lag,
      {_doubles('read_speed', 'write_speed')} FROM (SELECT * FROM metrics
        ORDER BY metrics.event_time DESC, consumer_group DESC LIMIT 100)"""
    q["recent_alerts"] = f"""SELECT alert_id, {iso('alert_time')} AS alert_time, severity,
      consumer_group, topic, current_lag FROM (SELECT * FROM alerts
        ORDER BY alerts.alert_time DESC, alert_id DESC LIMIT 50)"""
    q["event_feed"] = f"""SELECT {iso('event_time')} AS event_time, event_id, consumer_group, topic,
      message_count, event_type, scenario_name FROM (SELECT * FROM sim
        ORDER BY sim.event_time DESC, event_id DESC LIMIT 100)"""
    q["trend_points"] = f"""SELECT {_TIMED}, current_lag AS lag,
      {_doubles('read_speed', 'write_speed')} FROM (SELECT * FROM metrics
        ORDER BY metrics.event_time DESC, consumer_group DESC LIMIT 50)"""
    q["event_feed_stats"] = f"""SELECT count(*) AS total_events,
      {iso('max(event_time)')} AS last_event_time FROM sim"""
    q["scenario_rollup"] = """SELECT event_type, scenario_name, consumer_group, count(*) AS events,
      CAST(sum(message_count) AS BIGINT) AS messages FROM sim GROUP BY ALL"""

    q["telemetry_query"] = f"""SELECT 'received_bytes' AS metric, topic, {iso('ts')} AS ts,
      {r4('received_bytes')} AS value FROM (SELECT * FROM samples WHERE topic = 'topic_1'
        AND ts >= (SELECT max(ts) FROM samples WHERE topic = 'topic_1') - INTERVAL 7 DAYS
        ORDER BY samples.ts DESC, received_bytes DESC LIMIT 1000)"""
    q["telemetry_topic"] = f"""SELECT topic, {iso('bucket')} AS bucket,
      {_doubles('received_bytes', 'sent_bytes', 'received_records', 'sent_records',
                'retained_bytes')} FROM hourly"""
    q["telemetry_cluster"] = f"""SELECT {iso('bucket')} AS bucket,
      {r4('sum(received_bytes)')} AS received_bytes, {r4('sum(sent_bytes)')} AS sent_bytes,
      {r4('sum(received_bytes) + sum(sent_bytes)')} AS throughput FROM daily GROUP BY daily.bucket"""
    q["telemetry_latest"] = f"""SELECT topic, metric, {r4('value')} AS value FROM (
      SELECT topic, unnest(['received_bytes', 'sent_bytes', 'received_records', 'sent_records',
          'retained_bytes']) AS metric,
        unnest([arg_max(received_bytes, ts), arg_max(sent_bytes, ts), arg_max(received_records, ts),
          arg_max(sent_records, ts), arg_max(retained_bytes, ts)]) AS value
      FROM samples GROUP BY topic)"""
    q["telemetry_normalised"] = f"""SELECT topic, {iso('bucket')} AS bucket,
      {_doubles('received_bytes')}, {r4('percent')} AS percent FROM (
        SELECT *, least(100, received_bytes / max(received_bytes) OVER (PARTITION BY topic) * 100)
          AS percent FROM hourly)"""
    q["telemetry_last15"] = f"""SELECT topic, {iso('bucket')} AS bucket,
      {_doubles('received_bytes', 'sent_bytes', 'received_records', 'sent_records',
                'retained_bytes')} FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY hourly.bucket DESC) AS r FROM hourly)
      WHERE r <= 15"""
    q["telemetry_compare"] = f"""SELECT topic,
      {r4(half_up('received_bytes / 1024'))} AS received_kb,
      {r4(half_up('sent_bytes / 1024'))} AS sent_kb,
      {r4('received_records')} AS records_in, {r4('sent_records')} AS records_out FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY daily.bucket DESC) AS r FROM daily)
      WHERE r = 1"""

    event = f"""{iso('event_time')} AS "timestamp", consumer_group, topic, message_count, event_type,
      scenario_name, scenario_id"""
    q["decode_framed_json"] = f"""SELECT consumer_group AS key, CAST(7 AS INTEGER) AS schema_id,
      {event} FROM sim"""
    q["parse_sim_event"] = f"""SELECT event_id, {event},
      CASE WHEN scenario_name = 'lag_spike' THEN 'burst' END AS phase,
      CAST(event_id AS VARCHAR) AS sequence_number FROM sim"""
    q["telemetry_series"] = f"""SELECT topic, string_agg(({iso('bucket')}) || '=' ||
      CAST(received_bytes AS BIGINT), ',' ORDER BY bucket) AS received_bytes FROM hourly
      GROUP BY topic"""
    q["stream_metrics"] = f"{q['group_metrics']} WHERE {_PASSED}"
    q["stream_metric_record"] = q["group_metrics"]
    q["stream_rules"] = f"""SELECT {_ALERT} FROM (
      SELECT {_ALERT_COLUMNS} FROM alerts UNION ALL SELECT {_ALERT_COLUMNS} FROM inactive
      UNION ALL SELECT {_ALERT_COLUMNS} FROM storms UNION ALL SELECT {_ALERT_COLUMNS} FROM corr)"""
    q["stream_correlation"] = f"{q['correlation']} WHERE corr.{_PASSED.replace('event_time <=', 'alert_time <=')}"
    q["stream_late_rows"] = f"""SELECT count(*) + 7 * count(*) FILTER (WHERE tick % 50 = 0 AND NOT {_PASSED})
      AS settled, 7 * count(*) FILTER (WHERE tick % 50 = 0 AND {_PASSED}) AS dropped FROM metrics"""
    q["stream_enriched"] = q["alerts_enriched"] + """ AND alerts.alert_time <= greatest(
      (SELECT max(alert_time) FROM alerts), (SELECT max("timestamp") FROM enriched)) - INTERVAL 610 SECONDS"""
    q["stream_compact"] = q["compact_latest"]
    q["sink_metrics"] = f"""SELECT {_TIMED}, cluster_id, topic, current_lag,
      {_doubles('read_speed', 'write_speed', 'time_to_catchup_seconds', 'partition_skew_score',
                'lag_24h_avg', 'lag_velocity', 'speed_ratio')},
      partition_count, is_falling_behind FROM metrics"""
    q["sink_alerts"] = q["threshold_lag_up"]
    judged = """(SELECT consumer_group, event_time, CASE WHEN tick % 19 = 0 THEN 'frame'
        WHEN tick % 17 = 0 THEN 'malformed' WHEN tick % 11 = 0 THEN 'missing:topic'
        WHEN tick % 13 = 0 THEN 'type:current_lag'
        WHEN tick % 23 = 0 THEN 'missing:partitions[].consumed_offset' ELSE 'valid' END AS reason FROM metrics) judged"""
    q["stream_quarantine"] = f"""SELECT reason, count(*) AS records FROM {judged} GROUP BY reason
      UNION ALL SELECT 'valid partitions', count(*) FROM {judged} JOIN lag
        ON lag.consumer_group = judged.consumer_group AND lag.poll_time = judged.event_time
        WHERE reason = 'valid'"""
    q["retention_drop"] = f"""SELECT event_id, {iso('event_time')} AS event_time, consumer_group FROM sim
      WHERE CAST(event_time AS DATE) >= (SELECT CAST(max(event_time) AS DATE) - 7 FROM sim)"""
    return q


def all_sql() -> dict[str, str]:
    return {name: _sql(body) for name, body in _bodies().items()}
