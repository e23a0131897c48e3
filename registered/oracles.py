"""SQL that computes the registered queries in another engine, from the same event log."""

from __future__ import annotations

from registered.queries import STREAMED
from registered.tables import HALFWAY, registry
from spanloom.schema import COUNT_ATTRIBUTES, MEASURE_ATTRIBUTES, STRING_ATTRIBUTES

_R = registry()
_DIMS = [d.column for d in _R.dimensions]
_MODELS = _R["model"].values


def _pick(key: str, options) -> str:
    arms = " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(options))
    return f"CASE {key} {arms} END"


# --- derived tables -----------------------------------------------------------

_EV = "ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

_SPANS = f"""spans AS (
SELECT date_trunc('millisecond', ts) AS ts,
  't' || (event_id // 4) AS trace_id,
  's' || event_id AS span_id,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE 's' || (event_id - event_id % 4) END AS parent_span_id,
  trim(operation || ' ' || model) AS span_name,
  CASE event_type WHEN 'purchase' THEN 'server' WHEN 'signup' THEN 'internal' ELSE 'client' END
    AS span_kind,
  value * 10 + 1 AS duration_ms,
  printf('tenant-%04d', user_id) AS tenant_id,
  CASE WHEN tool THEN '' WHEN user_id < 8 THEN 'enterprise' WHEN user_id < 38 THEN 'pro'
    ELSE 'free' END AS tenant_tier,
  model, operation,
  CASE event_type WHEN 'signup' THEN '' WHEN 'purchase' THEN '/v1/agents/invoke'
    WHEN 'click' THEN '/v1/embeddings' ELSE '/v1/chat/completions' END AS route,
  CASE WHEN tool THEN '' WHEN event_id % 211 = 0 THEN 'antarctica-1'
    ELSE {_pick("user_id % 3", ["us-east-1", "us-west-2", "eu-central-1"])} END AS region,
  CASE WHEN event_type = 'error'
    THEN {_pick("event_id % 3", ["server_error", "timeout", "client_error"])}
    ELSE 'ok' END AS status_class,
  CASE WHEN tool THEN 'tool-runner' ELSE 'inference-gateway' END AS service_name,
  CASE WHEN call THEN CAST(k * 10 AS BIGINT) ELSE 0 END AS input_tokens,
  CASE WHEN call AND event_type <> 'click' THEN CAST(k * 4 AS BIGINT) ELSE 0 END AS output_tokens,
  CASE WHEN call THEN CAST(k * 3 AS BIGINT) ELSE 0 END AS cached_prompt_tokens,
  CASE WHEN call THEN CAST(k AS DOUBLE) / 100.0::DOUBLE ELSE 0.0::DOUBLE END
    AS kv_cache_utilization,
  CASE WHEN call THEN value ELSE 0.0::DOUBLE END AS ttft_ms,
  CASE WHEN call THEN value / 20 ELSE 0.0::DOUBLE END AS itl_ms,
  CASE WHEN call AND k > 80 THEN value ELSE 0.0::DOUBLE END AS queue_time_ms,
  CASE WHEN call THEN CAST(1 + k % 48 AS BIGINT) ELSE 0 END AS batch_size,
  'r' || event_id AS request_id,
  CASE WHEN event_type = 'error'
    THEN {_pick("event_id % 3", ["engine_overloaded", "deadline_exceeded", "invalid_request"])}
    ELSE '' END AS error_type,
  date_trunc('millisecond', ts) + to_microseconds(
    CAST(round((value * 10 + 1) * 1000) AS BIGINT) + (event_id % 10) * 1000000) AS ingested_at,
  event_id, (event_id // 4) % 13 = 0 AS copied
FROM (SELECT *, event_type = 'signup' AS tool,
        event_type NOT IN ('signup', 'purchase') AS call,
        CASE event_type WHEN 'signup' THEN 'execute_tool' WHEN 'purchase' THEN 'invoke_agent'
          WHEN 'click' THEN 'embeddings' ELSE 'chat' END AS operation,
        CASE WHEN event_type = 'signup' THEN '' WHEN event_id % 97 = 0 THEN 'shadow-deploy-v9'
          ELSE {_pick("event_id % 5", _MODELS)} END AS model
      FROM ev))"""

_AGAIN = """again AS (SELECT * FROM spans UNION ALL
SELECT * REPLACE (ingested_at + INTERVAL 60 SECOND AS ingested_at) FROM spans
WHERE event_id % 20 = 0)"""

_STATIC = ", ".join(f"('{d.name}', '{v}')" for d in _R.static for v in d.values)
_ALLOW = f"""topk AS (SELECT tenant_id AS value FROM spans
  WHERE ts > TIMESTAMP '2024-02-01' - INTERVAL {_R["tenant_id"].top_k_window_hours} HOUR
    AND ts <= TIMESTAMP '2024-02-01' AND tenant_id <> ''
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {_R["tenant_id"].budget}),
allow AS (SELECT 'tenant_id' AS dimension, value FROM topk
  UNION ALL SELECT * FROM (VALUES {_STATIC}) v(dimension, value))"""


def _guarded(name: str, column: str) -> str:
    return (
        f"CASE WHEN {column} = '' THEN '__none__' WHEN {column} IN "
        f"(SELECT value FROM allow WHERE dimension = '{name}') THEN {column} "
        f"ELSE '__other__' END AS {column}"
    )


_GUARDED = (
    "guarded AS (SELECT * REPLACE ("
    + ", ".join(_guarded(d.name, d.column) for d in _R.dimensions)
    + "), status_class <> 'ok' AS failed FROM spans)"
)

_STATE_COLUMNS = """count(*) AS spans,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
  CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(cached_prompt_tokens) AS BIGINT) AS cached_tokens,
  coalesce(sum(itl_ms) FILTER (WHERE itl_ms > 0), 0) AS itl_sum,
  count(*) FILTER (WHERE itl_ms > 0) AS itl_cnt,
  coalesce(sum(queue_time_ms) FILTER (WHERE queue_time_ms > 0), 0) AS queue_time_sum,
  count(*) FILTER (WHERE queue_time_ms > 0) AS queue_time_cnt,
  coalesce(sum(kv_cache_utilization) FILTER (WHERE kv_cache_utilization > 0), 0) AS kv_cache_sum,
  count(*) FILTER (WHERE kv_cache_utilization > 0) AS kv_cache_cnt,
  max(kv_cache_utilization) AS kv_cache_max,
  count(*) FILTER (WHERE failed) AS errors"""

_DIM_LIST = ", ".join(_DIMS)
_MINUTE = (
    f"minute AS (SELECT date_trunc('minute', ts) AS ts_minute, {_DIM_LIST}, {_STATE_COLUMNS} "
    f"FROM guarded GROUP BY ALL)"
)

_HEALTH = """hourly AS (SELECT date_trunc('hour', ts) AS sampled_at, count(*) AS accepted,
  count(*) FILTER (WHERE event_type = 'signup') AS refused,
  count(*) FILTER (WHERE event_type <> 'error') AS sent,
  count(*) FILTER (WHERE event_type = 'error' AND event_id % 3 = 0) AS failed,
  count(*) FILTER (WHERE event_type = 'error' AND event_id % 3 = 1) AS rejected,
  CAST(sum(k) AS BIGINT) AS ks, CAST(max(k) AS BIGINT) AS top
  FROM ev GROUP BY 1),
health AS (SELECT sampled_at, ks AS total_lag, top AS max_partition_lag,
  CAST(sum(accepted) OVER w AS BIGINT) AS accepted_spans,
  CAST(sum(refused) OVER w AS BIGINT) AS refused_spans,
  CAST(sum(sent) OVER w AS BIGINT) AS sent_spans,
  CAST(sum(failed) OVER w AS BIGINT) AS send_failed_spans,
  CAST(sum(rejected) OVER w AS BIGINT) AS enqueue_failed_spans,
  ks % 100 AS queue_size, CAST(100 AS BIGINT) AS queue_capacity
  FROM hourly WINDOW w AS (
    PARTITION BY (epoch(sampled_at) - 1704067200 >= 400 * 3600) ORDER BY sampled_at))"""

_OFFSETS = """keyed AS (SELECT CAST(ts AS DATE) AS day, CAST(event_id % 6 AS INTEGER) AS partition,
    event_id, event_type FROM events),
high AS (SELECT day, partition, max(event_id) AS high FROM keyed GROUP BY 1, 2),
committed AS (SELECT day, partition, max(event_id) AS committed FROM keyed
  WHERE event_type = 'purchase' GROUP BY 1, 2),
lags AS (SELECT day, partition, high, greatest(coalesce(committed, 0), 0) AS position,
  greatest(high - greatest(coalesce(committed, 0), 0), 0) AS lag
  FROM high LEFT JOIN committed USING (day, partition))"""

_RUNS = """base AS (SELECT strftime(ts, '%Y-%m-%d') AS run_id, count(*) AS n,
  count(*) FILTER (WHERE event_type = 'view') AS views,
  count(*) FILTER (WHERE event_type = 'error' AND event_id % 4 = 0) AS errors,
  count(*) FILTER (WHERE event_id % 50 = 0) AS refused,
  day(min(ts)) AS day FROM ev GROUP BY 1),
runs AS (SELECT run_id, n - views AS generator_spans,
  CASE WHEN day % 5 = 0 THEN n * 2 ELSE n - views END AS generator_target_spans,
  views AS endpoint_spans, n - errors - refused AS collector_accepted,
  refused AS collector_refused, n - errors - refused AS collector_sent,
  CASE WHEN day % 6 = 0 THEN n - errors - refused * 4 ELSE n - errors - refused END AS stored_rows,
  CASE WHEN day % 7 = 0 THEN 14400.0 ELSE 600.0 END AS sample_interval_s,
  28800.0 AS burst_s, 5 AS rebalances_before,
  CASE WHEN day % 9 = 0 THEN 6 ELSE 5 END AS rebalances_after_baseline,
  CASE WHEN day % 2 = 0 THEN 60000.0 END AS stall_released_at,
  CASE WHEN day % 3 = 0 THEN 28800.0 ELSE 28000.0 END AS baseline_end,
  28800.0 AS burst_start,
  CASE WHEN day % 3 = 0 THEN 57600.0 ELSE 58000.0 END AS burst_end FROM base),
accounted AS (SELECT *, generator_spans + endpoint_spans AS emitted_total,
  collector_accepted + collector_refused AS delivered,
  greatest(0, generator_spans + endpoint_spans - collector_accepted - collector_refused)
    AS sdk_lost,
  greatest(0, collector_sent - stored_rows) AS unaccounted FROM runs),
slices AS (SELECT strftime(ts, '%Y-%m-%d') AS run_id,
  CAST(floor((CAST(floor(epoch(ts)) AS BIGINT) % 86400) / 600.0) * 600 AS DOUBLE) AS t,
  count(*) AS a, count(*) FILTER (WHERE event_type <> 'error') AS s,
  count(*) FILTER (WHERE event_type = 'error' AND event_id % 4 = 0) AS d,
  CAST(sum(k) * 10 AS BIGINT) AS total_lag FROM ev GROUP BY 1, 2),
samples AS (SELECT run_id, t, total_lag, sum(a) OVER w AS accepted, sum(s) OVER w AS sent,
  sum(d) OVER w AS dropped FROM slices WINDOW w AS (
    PARTITION BY run_id,
      (CAST(substr(run_id, 9, 2) AS INTEGER) % 8 = 0 AND t >= 43200) ORDER BY t)),
pairs AS (SELECT *, lag(accepted) OVER w AS pa, lag(sent) OVER w AS ps, lag(dropped) OVER w AS pd,
  lag(t) OVER w AS pt FROM samples WINDOW w AS (PARTITION BY run_id ORDER BY t)),
resets AS (SELECT run_id,
  count(*) FILTER (WHERE accepted < pa OR sent < ps OR dropped < pd) AS resets,
  min(t) FILTER (WHERE accepted < pa OR sent < ps OR dropped < pd) AS first_reset_t
  FROM pairs GROUP BY 1),
probes AS (SELECT strftime(ts, '%Y-%m-%d') AS run_id,
  CAST(CAST(floor(epoch(ts)) AS BIGINT) % 86400 AS DOUBLE) AS t, value AS latency_ms,
  event_id % 10 <> 0 AS ok FROM ev WHERE event_type = 'view'),
phases AS (SELECT run_id, 'baseline' AS phase, 0.0 AS a, baseline_end AS b FROM runs
  UNION ALL SELECT run_id, 'burst', burst_start, burst_end FROM runs),
inside AS (SELECT p.run_id, phase, t, latency_ms FROM probes p JOIN phases h USING (run_id)
  WHERE ok AND t >= a AND t < b),
probed AS (SELECT run_id, count(*) FILTER (WHERE phase = 'baseline') AS baseline_probes,
  count(*) FILTER (WHERE phase = 'burst') AS burst_probes FROM inside GROUP BY 1),
peaks AS (SELECT run_id, max(total_lag) AS peak_lag FROM samples GROUP BY 1),
facts AS (SELECT a.*, coalesce(peak_lag, 0) AS peak_lag,
  coalesce(baseline_probes, 0) AS baseline_probes, coalesce(burst_probes, 0) AS burst_probes,
  coalesce(resets, 0) AS resets FROM accounted a LEFT JOIN peaks USING (run_id)
  LEFT JOIN probed USING (run_id) LEFT JOIN resets USING (run_id)),
graded AS (
  SELECT run_id, 'generator_hit_target' AS "check",
    generator_spans / generator_target_spans >= 0.90 AS passed,
    printf('generated %d of %d spans', generator_spans, generator_target_spans) AS detail FROM facts
  UNION ALL SELECT run_id, 'load_actually_delivered', delivered / emitted_total >= 0.95,
    printf('delivered %d of %d spans', delivered, emitted_total) FROM facts
  UNION ALL SELECT run_id, 'no_counter_reset', resets = 0,
    printf('%d counter resets', resets) FROM facts
  UNION ALL SELECT run_id, 'sampling_resolution', sample_interval_s <= burst_s / 4,
    'sampled every ' || CAST(sample_interval_s AS VARCHAR) || ' s in a burst of ' ||
    CAST(burst_s AS VARCHAR) || ' s' FROM facts
  UNION ALL SELECT run_id, 'burst_actually_stressed', peak_lag >= 5000,
    printf('peak lag %d messages', peak_lag) FROM facts
  UNION ALL SELECT run_id, 'spans_accounted', unaccounted / emitted_total <= 0.02,
    printf('%d of %d spans unaccounted', unaccounted, emitted_total) FROM facts
  UNION ALL SELECT run_id, 'endpoint_probed_under_load',
    baseline_probes >= 10 AND burst_probes >= 10,
    printf('%d baseline probes, %d burst probes', baseline_probes, burst_probes) FROM facts
  UNION ALL SELECT run_id, 'lag_reader_is_noninvasive',
    rebalances_after_baseline = rebalances_before,
    printf('rebalances %d before, %d after the baseline', rebalances_before,
      rebalances_after_baseline) FROM facts)"""

_LAKE = """lake AS (SELECT *, CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(CAST(ttft_ms AS FLOAT) AS DOUBLE) AS ttft, CAST(CAST(duration_ms AS FLOAT) AS DOUBLE) AS dur
  FROM again)"""

_REPORT = """report AS (SELECT ts, tenant_id,
  CASE WHEN model = '' THEN 'agent tool call' ELSE model END AS model, status_class,
  input_tokens, output_tokens, CASE WHEN model <> '' THEN ttft_ms END AS ttft_ms,
  input_tokens + output_tokens AS tokens, CAST(ts AS DATE) AS date FROM spans)"""

_READABLE = "decoded AS (SELECT * FROM spans)"
_MINUTE_DECODED = (
    f"minute AS (SELECT date_trunc('minute', ts) AS ts_minute, {_DIM_LIST}, {_STATE_COLUMNS} "
    f"FROM guarded GROUP BY ALL)"
)

_LATENCY = (
    "(epoch_us(ingested_at) // 1000 - epoch_us(ts) // 1000 - duration_ms) / 1000.0::DOUBLE"
)


def _with(tables: list[str], select: str) -> str:
    return "WITH " + ",\n".join([_EV, *tables]) + "\n" + select


def _spans(select: str) -> str:
    return _with([_SPANS], select)


def _minute(select: str) -> str:
    return _with([_SPANS, _ALLOW, _GUARDED, _MINUTE], select)


def _stored(select: str) -> str:
    """Minute states written by the stream."""
    return _with([_SPANS, _ALLOW, _GUARDED, _MINUTE_DECODED], select)


def _decoded(select: str) -> str:
    return _with([_SPANS, _READABLE], select)


def _health(select: str) -> str:
    return _with([_HEALTH], select)


def _runs(select: str) -> str:
    return _with([_RUNS], select)


def _lake(select: str) -> str:
    return _with([_SPANS, _AGAIN, _LAKE], select)


def _report(select: str) -> str:
    return _with([_SPANS, _REPORT], select)


def _sum(column: str, name: str | None = None) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {name or column}"


def _r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) AS {name}"


_GROWTH = "greatest(0, coalesce({c} - lag({c}) OVER (ORDER BY sampled_at), 0)) AS {n}"


def _growth(**columns: str) -> str:
    parts = ", ".join(_GROWTH.format(c=f"({c})", n=n) for n, c in columns.items())
    return _health(f"SELECT sampled_at AS time, {parts} FROM health")


def _attribute_rows() -> str:
    parts = [
        f"SELECT '{key}' AS key, count(*) AS spans, count(DISTINCT {c}) AS distinct_values "
        f"FROM decoded WHERE {c} <> '' HAVING count(*) > 0"
        for key, c in STRING_ATTRIBUTES.items()
    ]
    numeric = {**{k: c for k, (c, _) in COUNT_ATTRIBUTES.items()}, **MEASURE_ATTRIBUTES}
    parts += [
        f"SELECT '{key}', count(*), count(DISTINCT {c}) FROM decoded HAVING count(*) > 0"
        for key, c in numeric.items()
    ]
    return " UNION ALL ".join(parts)


def _sent_attributes() -> str:
    sent = " + ".join(f"CAST({c} <> '' AS INTEGER)" for c in STRING_ATTRIBUTES.values())
    return f"({sent} + {len(COUNT_ATTRIBUTES) + len(MEASURE_ATTRIBUTES)})"


def _per_dimension(select: str, source: str) -> str:
    """``select`` once per dimension; {d} is its name, {c} its column, {b} its budget."""
    return " UNION ALL ".join(
        select.format(d=d.name, c=d.column, b=d.budget) + f" FROM {source}" for d in _R.dimensions
    )


def _states(keys: str, source: str = "minute") -> str:
    return (
        f"SELECT {keys}, {_sum('spans')}, {_sum('input_tokens')}, {_sum('output_tokens')}, "
        f"{_sum('cached_tokens')}, sum(itl_sum) AS itl_sum, {_sum('itl_cnt')}, "
        f"sum(queue_time_sum) AS queue_time_sum, {_sum('queue_time_cnt')}, "
        f"sum(kv_cache_sum) AS kv_cache_sum, {_sum('kv_cache_cnt')}, "
        f"max(kv_cache_max) AS kv_cache_max, {_sum('errors')} FROM {source} GROUP BY ALL"
    )


def _rounded_states(time_column: str, source: str) -> str:
    doubles = ("itl_sum", "queue_time_sum", "kv_cache_sum", "kv_cache_max")
    return f"SELECT * REPLACE ({', '.join(_r6(c, c) for c in doubles)}) FROM ({source})"


# Buckets of a quantile state, and the number in the middle of one.
_WHOLE = "CAST(greatest(1, least(round(({c}) * 1000::DOUBLE), 1099511627775::DOUBLE)) AS BIGINT)"
_SHIFT = f"greatest(length(bin({_WHOLE})) - 8, 0)"
_BUCKET = f"CAST({_SHIFT} * 128 + ({_WHOLE} >> {_SHIFT}) AS INTEGER)"


def _bucket(column: str) -> str:
    return _BUCKET.format(c=column)


def _held(column: str, p: float, digits: int = 6) -> str:
    """A quantile as a state gives it: the middle of the bucket of the value that reaches the share."""
    bucket = f"CAST(quantile_disc({_bucket(column)}, {p}) FILTER (WHERE {column} > 0) AS BIGINT)"
    shift = f"greatest(({bucket}) // 128 - 1, 0)"
    low = f"((({bucket}) - {shift} * 128) << CAST({shift} AS INTEGER))"
    return f"round(({low} + ((1::BIGINT << CAST({shift} AS INTEGER)) - 1) / 2.0::DOUBLE) / 1000.0::DOUBLE, {digits})"


def _counts(keys: str, column: str) -> str:
    """``bucket:n`` of all buckets of a measure in each group of guarded spans."""
    return (
        f"(SELECT {keys}, string_agg(b || ':' || n, ',' ORDER BY b) AS held FROM (SELECT {keys}, b, count(*) AS n "
        f"FROM (SELECT *, {_bucket(column)} AS b FROM timed WHERE {column} > 0) GROUP BY ALL) GROUP BY ALL)"
    )


def _whole_states(unit: str) -> str:
    """Rollup rows with their sketches as what they hold."""
    time = f"ts_{unit}"
    keys = f"{time}, {_DIM_LIST}"
    same = " AND ".join(f"{{a}}.{k} = s.{k}" for k in keys.split(", "))
    doubles = ("itl_sum", "queue_time_sum", "kv_cache_sum", "kv_cache_max")
    return _with(
        [_SPANS, _ALLOW, _GUARDED, f"timed AS (SELECT *, date_trunc('{unit}', ts) AS {time} FROM guarded)"],
        f"SELECT s.* REPLACE ({', '.join(_r6('s.' + c, c) for c in doubles)}), coalesce(a.held, '') AS ttft, "
        f"coalesce(b.held, '') AS duration FROM (SELECT {keys}, {_STATE_COLUMNS}, count(DISTINCT trace_id) AS traces "
        f"FROM timed GROUP BY ALL) s LEFT JOIN {_counts(keys, 'ttft_ms')} a ON {same.format(a='a')} "
        f"LEFT JOIN {_counts(keys, 'duration_ms')} b ON {same.format(a='b')}",
    )


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    jan = "TIMESTAMP '2024-01-{}'"

    q["s01_message_stream"] = _decoded(
        f"SELECT operation, count(*) AS spans, {_sum('input_tokens')}, "
        f"{_sum('batch_size', 'batch_sizes')}, "
        "round(sum(CAST(CAST(ttft_ms AS FLOAT) AS DOUBLE)), 2) AS ttft_ms "
        "FROM decoded GROUP BY 1"
    )
    q["s02_dead_letters"] = (
        "SELECT 'otel.spans' AS topic, 'malformed JSON' AS error, "
        "count(DISTINCT event_id // 4) AS messages, CAST(200 AS BIGINT) AS longest "
        "FROM events WHERE (event_id // 4) % 13 = 0"
    )
    q["s01_offset_gaps"] = (
        "WITH m AS (SELECT event_id % 6 AS p, event_id // 6 AS o, ts >= TIMESTAMP '2024-01-10 06:00:00' AND "
        "ts < TIMESTAMP '2024-01-10 18:00:00' AS lost FROM events), "
        "b AS (SELECT p, max(o) FILTER (WHERE NOT lost AND o < l) + 1 AS f, min(o) FILTER (WHERE NOT lost AND o > l) - 1 AS t "
        "FROM m JOIN (SELECT p, min(o) AS l FROM m WHERE lost GROUP BY p) USING (p) GROUP BY p) "
        "SELECT 'events' AS topic, CAST(p AS INTEGER) AS partition, f AS from_offset, t AS to_offset, t - f + 1 AS missing FROM b"
    )
    q["s12_empty_lake"] = _spans(
        "SELECT count(*) AS rows, max(ts) AS last_ts, CAST(sum(output_tokens) AS BIGINT) AS output_tokens "
        "FROM spans WHERE ts < TIMESTAMP '2023-12-02'"
    )
    q["c09_event_time_latency"] = _with(
        [_SPANS, _AGAIN],
        f"SELECT count(*) AS n, {_r6('avg(s)', 'avg_s')}, "
        + ", ".join(_r6(f"quantile_cont(s, {p})", f"p{int(p * 100)}_s") for p in (0.5, 0.95, 0.99))
        + f", {_r6('max(s)', 'max_s')} FROM (SELECT {_LATENCY} AS s FROM again "
        "WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06 12:00:00')",
    )
    q["j05_lag_margin"] = _spans(
        "SELECT a AS window_start, b AS window_end, count(*) AS rows FROM spans JOIN (VALUES "
        "(TIMESTAMP '2024-01-02 12:00:00', TIMESTAMP '2024-01-02 12:25:00'), "
        "(TIMESTAMP '2024-01-02 12:25:00', TIMESTAMP '2024-01-02 12:57:00')) w(a, b) ON ts >= a AND ts < b GROUP BY 1, 2"
    )
    q["j09_allowlist_refresh"] = _with(
        [_SPANS, _ALLOW],
        "SELECT second, CASE WHEN tenant_id = '' THEN '__none__' WHEN second AND tenant_id IN (SELECT value FROM allow "
        "WHERE dimension = 'tenant_id') THEN tenant_id ELSE '__other__' END AS tenant_id, count(*) AS spans "
        "FROM (SELECT *, (event_id // 4) % 2 = 1 AS second FROM spans) GROUP BY 1, 2",
    )
    q["j10_bounded_batch"] = (
        "SELECT 'otel.spans' AS topic, count(DISTINCT event_id // 4) + count(DISTINCT event_id // 4) "
        "FILTER (WHERE (event_id // 4) % 13 = 0) AS messages, CAST(4 AS BIGINT) AS batches FROM events"
    )
    q["s02_replay"] = (
        "SELECT 'otel.spans' AS topic, 'malformed JSON' AS error, TIMESTAMP '2024-02-01 00:01:00' AS ingested_at, "
        "count(DISTINCT event_id // 4) AS messages FROM events WHERE (event_id // 4) % 13 = 0"
    )
    q["s03_raw_sink"] = _decoded(
        "SELECT CAST(ts AS DATE) AS dt, count(*) AS spans, count(DISTINCT tenant_id) AS tenants "
        "FROM decoded GROUP BY 1"
    )
    q["s04_minute_states_sink"] = _stored(
        f"SELECT tenant_id, {_sum('spans')}, {_sum('input_tokens')}, {_sum('output_tokens')}, "
        f"{_sum('cached_tokens')}, {_sum('errors')} FROM minute GROUP BY 1"
    )
    q["s05_hour_states_sink"] = _stored(
        f"SELECT date_trunc('hour', ts_minute) AS ts_hour, operation, {_sum('spans')}, "
        f"{_sum('output_tokens')}, "
        "round(max(CAST(CAST(kv_cache_max AS FLOAT) AS DOUBLE)), 6) AS kv_cache_max "
        "FROM minute GROUP BY 1, 2"
    )
    q["s06_allowlist_snapshot"] = _with([_SPANS, _ALLOW], "SELECT dimension, value FROM allow")
    q["s07_health_sink"] = _health(
        "SELECT sampled_at, total_lag, accepted_spans, sent_spans, queue_size FROM health"
    )
    q["s10_lake_writer"] = _lake(
        "SELECT CAST(dt AS TIMESTAMP) AS window_start, "
        "CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY AS window_end, count(*) AS rows "
        "FROM lake GROUP BY dt"
    ).replace(
        "CAST(dt AS TIMESTAMP) AS window_start",
        "CASE WHEN dt = (SELECT min(dt) FROM lake) THEN "
        "(SELECT date_trunc('second', min(ts)) FROM lake) ELSE CAST(dt AS TIMESTAMP) END "
        "AS window_start",
    )
    q["s11_lake_scan"] = _lake(
        f"SELECT dt, hour, count(*) AS spans, {_sum('output_tokens')}, min(ts) AS first_ts "
        "FROM lake GROUP BY 1, 2"
    )
    counters = (
        "accepted_spans, refused_spans, sent_spans, send_failed_spans, enqueue_failed_spans, "
        "queue_size, queue_capacity"
    )
    q["s14_metrics_text"] = _health(
        f"SELECT strftime(sampled_at, '%Y-%m-%d %H:%M:%S') AS scrape, {counters} FROM health"
    )
    q["s15_offset_lag"] = _with(
        [_OFFSETS],
        f"SELECT day, {_sum('lag', 'total_lag')}, max(lag) AS max_partition_lag, "
        "count(*) AS partitions FROM lags GROUP BY 1",
    )
    q["s16_report_load"] = _lake(
        "SELECT dt AS date, CASE WHEN model = '' THEN 'agent tool call' ELSE model END AS model, "
        "count(*) AS spans, count(*) FILTER (WHERE model <> '') AS with_ttft, "
        f"{_sum('input_tokens + output_tokens', 'tokens')} FROM lake GROUP BY 1, 2"
    )
    q["s17_run_report"] = _runs(
        "SELECT f.run_id, bool_and(passed) AS valid, any_value(peak_lag) AS peak_lag, "
        "any_value(sdk_lost) AS sdk_lost, any_value(unaccounted) AS unaccounted, "
        "count(*) FILTER (WHERE passed) AS passed_checks "
        "FROM facts f JOIN graded g ON f.run_id = g.run_id GROUP BY f.run_id"
    )

    q["b01_flatten"] = _decoded(
        "SELECT service_name, span_kind, count(*) AS spans FROM decoded GROUP BY 1, 2"
    )
    q["b02_attribute_map"] = _decoded(_attribute_rows())
    q["b05_decoded_spans"] = _decoded(
        """SELECT ts, trace_id, span_id, parent_span_id, span_name, span_kind,
        round(CAST(CAST(duration_ms AS FLOAT) AS DOUBLE), 1) AS duration_ms, tenant_id, tenant_tier,
        model, operation, route, region, status_class, input_tokens, output_tokens,
        cached_prompt_tokens,
        round(CAST(CAST(kv_cache_utilization AS FLOAT) AS DOUBLE), 4) AS kv_cache_utilization,
        round(CAST(CAST(ttft_ms AS FLOAT) AS DOUBLE), 3) AS ttft_ms, batch_size, request_id,
        error_type FROM decoded"""
    )
    q["b11_export_projection"] = _spans(
        "SELECT CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour, span_kind, "
        f"count(*) AS spans, {_sum('cached_prompt_tokens')} FROM spans GROUP BY 1, 2, 3"
    )
    q["b12_relabel"] = _report(
        f"SELECT model, count(*) AS spans, count(ttft_ms) AS with_ttft, {_sum('tokens')}, "
        "min(date) AS first_date FROM report GROUP BY 1"
    )
    q["b14_time_buckets"] = (
        "SELECT date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour, "
        "count(*) AS spans FROM events GROUP BY 1, 2"
    )

    q["c01_message_split"] = (
        "SELECT true AS readable, count(DISTINCT event_id // 4) AS messages FROM events "
        "UNION ALL SELECT false, count(DISTINCT event_id // 4) FROM events "
        "WHERE (event_id // 4) % 13 = 0 HAVING count(*) > 0"
    )
    q["c02_closed_range"] = _spans(
        "SELECT operation, count(*) AS spans FROM spans WHERE ts BETWEEN "
        "TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00' GROUP BY 1"
    )
    q["c03_half_open_window"] = _decoded(
        "SELECT status_class, count(*) AS spans FROM decoded WHERE "
        "ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:00:00' GROUP BY 1"
    )
    q["c04_trailing_window"] = _spans(
        "SELECT tenant_tier, count(*) AS spans FROM spans WHERE "
        "ts > TIMESTAMP '2024-01-29 12:00:00' AND ts <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY 1"
    )
    recent = (
        "CAST(round(count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15 11:59:50' "
        "AND ts < TIMESTAMP '2024-01-15 12:00:50') / 60) AS BIGINT) AS spans_per_sec"
    )
    q["c05_lagged_rate"] = _spans(f"SELECT count(*) AS total_spans, {recent} FROM spans")
    q["c06_measured_only"] = _minute(
        f"SELECT operation, {_r6('sum(itl_sum) / nullif(sum(itl_cnt), 0)', 'itl_avg')}, "
        f"{_r6('sum(queue_time_sum) / nullif(sum(queue_time_cnt), 0)', 'queue_time_avg')}, "
        f"{_r6('sum(kv_cache_sum) / nullif(sum(kv_cache_cnt), 0)', 'kv_cache_avg')} "
        "FROM minute GROUP BY 1"
    )
    q["c10_point_lookup"] = _decoded(
        "SELECT trace_id, span_id, parent_span_id, request_id FROM decoded WHERE trace_id = 't42'"
    )
    q["c10_indexed_lookup"] = _lake(
        f"SELECT trace_id, count(DISTINCT dt) AS days, count(*) AS spans, {_sum('output_tokens')} FROM lake "
        "WHERE trace_id IN ('t1', 't42', 't777', 't2024') GROUP BY 1"
    )
    q["c10_indexed_lookup_hot"] = _decoded(
        "SELECT request_id, trace_id, span_id, tenant_id, output_tokens FROM decoded "
        "WHERE request_id IN ('r5', 'r42', 'r4711')"
    )
    q["c11_files_by_pattern"] = _lake(
        "SELECT strftime(dt, '%Y%m%d') AS window_day, count(*) AS spans FROM lake GROUP BY 1"
    )
    q["c12_report_slicers"] = _report(
        f"SELECT status_class, count(*) AS spans, {_sum('tokens')} FROM report WHERE "
        "model = 'mistral-7b-instruct' AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' "
        "GROUP BY 1"
    )

    q["d01_cardinality_guard"] = _with(
        [_SPANS, _ALLOW, _GUARDED],
        "SELECT tenant_id, model, region, count(*) AS spans FROM guarded GROUP BY 1, 2, 3",
    )
    unregistered = " UNION ALL ".join(
        f"SELECT '{d.name}' AS dimension, {d.column} AS value, count(*) AS spans FROM spans "
        f"WHERE {d.column} <> '' AND {d.column} NOT IN "
        f"(SELECT value FROM allow WHERE dimension = '{d.name}') GROUP BY 2"
        for d in _R.dimensions
    )
    q["d02_unregistered_values"] = _with([_SPANS, _ALLOW], unregistered)
    print_of = (
        f"(SELECT count(*) AS rows, {_sum('input_tokens')}, {_sum('output_tokens')}, sum({{d}}) AS d, "
        "count(DISTINCT tenant_id) AS tenants, count(DISTINCT trace_id) AS traces FROM {t})"
    )
    exact = ("rows", "input_tokens", "output_tokens", "tenants", "traces")
    q["d04_fingerprint_comparison"] = _lake(
        f"SELECT {', '.join(f's.{c} AS source_{c}, l.{c} AS lake_{c}' for c in exact)}, "
        f"{' AND '.join(f's.{c} = l.{c}' for c in exact)} AND abs(s.d - l.d) <= greatest(1, abs(s.d) * 1e-6) AS agree "
        f"FROM {print_of.format(d='duration_ms', t='again')} s, {print_of.format(d='dur', t='lake')} l"
    )
    q["d05_partition_lag"] = _with(
        [_OFFSETS], "SELECT day, partition, high, position, lag FROM lags"
    )
    q["d05_two_topics"] = (
        "WITH o AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END "
        "AS topic, CAST(event_id % 3 AS INTEGER) AS partition, max(event_id) AS high, "
        "coalesce(max(event_id) FILTER (WHERE event_type = 'purchase'), 0) AS committed "
        "FROM events GROUP BY 1, 2, 3) SELECT day, CAST(sum(high - committed) AS BIGINT) AS total_lag, "
        "max(high - committed) AS max_partition_lag, count(*) AS partitions FROM o GROUP BY 1"
    )
    q["d01_repeated_allowlist"] = q["d01_cardinality_guard"]
    q["d06_probes_in_phases"] = _runs(
        f"SELECT run_id, phase, count(*) AS probes, {_r6('sum(latency_ms)', 'latency_ms')} "
        "FROM inside GROUP BY 1, 2"
    )

    q["e04_conditional_average"] = _spans(
        f"SELECT model, {_r6('avg(ttft_ms)', 'avg_all')}, "
        f"{_r6('avg(ttft_ms) FILTER (WHERE ttft_ms > 0)', 'avg_measured')}, "
        "count(*) FILTER (WHERE ttft_ms > 0) AS measured, "
        f"{_r6('min(duration_ms)', 'shortest')}, {_r6('max(duration_ms)', 'longest')}, "
        "min(region) AS any_region FROM spans GROUP BY 1"
    )
    q["e07_approx_distinct"] = _with(
        [_SPANS, _ALLOW, _GUARDED],
        "SELECT tenant_id, date_trunc('hour', ts) AS hour, count(DISTINCT trace_id) AS traces FROM guarded GROUP BY 1, 2"
    )
    q["e07_shared_traces"] = _with(
        [_SPANS],
        "SELECT day, count(*) FILTER (WHERE bad AND good) AS traces FROM (SELECT date_trunc('day', ts) AS day, trace_id, "
        "bool_or(status_class <> 'ok') AS bad, bool_or(status_class = 'ok') AS good FROM spans GROUP BY 1, 2) "
        "GROUP BY 1 HAVING bool_or(bad) AND bool_or(good)",
    )
    q["e08_exact_distinct"] = _spans(
        "SELECT operation, count(DISTINCT tenant_id) AS tenants, count(DISTINCT tenant_id) "
        "FILTER (WHERE status_class <> 'ok') AS failing_tenants FROM spans GROUP BY 1"
    )

    def quantiles(column: str, **names: float) -> str:
        return ", ".join(_r6(f"quantile_cont({column}, {p})", n) for n, p in names.items())

    q["e11_exact_quantiles"] = _spans(
        f"SELECT model, {quantiles('ttft_ms', p50=0.5, p95=0.95, p99=0.99)} FROM spans "
        "WHERE ttft_ms > 0 GROUP BY 1"
    )
    q["e11_exact_quantiles_lineitem"] = (
        "SELECT l_returnflag, l_linestatus, "
        f"{quantiles('l_extendedprice', p50=0.5, p95=0.95, p99=0.99)} "
        "FROM lineitem GROUP BY 1, 2"
    )
    q["e12_quantile_sketch_accuracy"] = _spans(
        f"SELECT *, round(abs(sketched - exact) / exact, 6) AS relative_error FROM (SELECT operation, count(*) AS n, "
        f"{quantiles('duration_ms', exact=0.95)}, {_held('duration_ms', 0.95)} AS sketched "
        "FROM spans WHERE duration_ms > 0 GROUP BY 1)"
    )
    q["e12_quantile_sketch_lineitem"] = (
        "SELECT *, round(abs(sketched - exact) / exact, 6) AS relative_error FROM (SELECT l_returnflag, count(*) AS n, "
        f"{quantiles('l_extendedprice', exact=0.99)}, {_held('l_extendedprice', 0.99)} AS sketched "
        "FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1)"
    )
    q["e15_state_cascade"] = _minute(
        f"SELECT date_trunc('day', ts_minute) AS day, {_sum('spans')}, {_sum('input_tokens')}, "
        f"{_sum('errors')}, {_r6('max(kv_cache_max)', 'kv_cache_max')} FROM minute GROUP BY 1"
    )
    q["e21_nearest_rank"] = _runs(
        """SELECT h.run_id, h.phase, count(latency_ms) AS n,
        coalesce(round(list_sort(list(latency_ms))[1 + least(count(latency_ms) - 1,
          CAST(floor(count(latency_ms) * 0.50) AS BIGINT))], 6), 0) AS p50,
        coalesce(round(list_sort(list(latency_ms))[1 + least(count(latency_ms) - 1,
          CAST(floor(count(latency_ms) * 0.95) AS BIGINT))], 6), 0) AS p95,
        coalesce(round(list_sort(list(latency_ms))[1 + least(count(latency_ms) - 1,
          CAST(floor(count(latency_ms) * 0.99) AS BIGINT))], 6), 0) AS p99,
        coalesce(round(max(latency_ms), 6), 0) AS max
        FROM phases h LEFT JOIN inside i ON h.run_id = i.run_id AND h.phase = i.phase
        GROUP BY 1, 2"""
    )

    q["g01_minute_rollup"] = _whole_states("minute")
    q["g02_hour_rollup"] = _whole_states("hour")
    q["g04_backfill"] = _minute(
        f"SELECT CAST(ts_minute AS DATE) AS day, {_sum('spans')}, {_sum('output_tokens')}, "
        "CAST(sum(errors) AS BIGINT) AS errors FROM minute WHERE "
        f"ts_minute >= {jan.format('03')} AND ts_minute < {jan.format('17 12:00:00')} GROUP BY 1"
    )
    q["g05_coverage"] = _spans(
        "SELECT min(ts) AS raw_min, max(ts) AS raw_max, count(*) AS raw_rows, "
        "date_trunc('minute', min(ts) FILTER (WHERE late)) AS rollup_min, "
        "date_trunc('minute', max(ts) FILTER (WHERE late)) AS rollup_max, "
        "count(*) FILTER (WHERE late) AS rollup_spans, "
        "count(*) FILTER (WHERE NOT late) AS missing_spans, "
        "count(*) FILTER (WHERE NOT late) > 0 AS needs_backfill "
        f"FROM (SELECT *, ts >= {jan.format('04')} AS late FROM spans)"
    )
    q["g05_coverage_by_minute"] = _spans(
        "SELECT date_trunc('minute', ts) AS ts_minute, count(*) AS raw_rows, "
        "count(*) FILTER (WHERE operation <> 'execute_tool') AS rollup_spans, "
        "count(*) FILTER (WHERE operation = 'execute_tool') AS missing_spans FROM spans "
        "WHERE ts >= (SELECT date_trunc('minute', min(ts)) FROM spans "
        "WHERE operation <> 'execute_tool') GROUP BY 1 "
        "HAVING count(*) FILTER (WHERE operation = 'execute_tool') > 0"
    )
    q["g07_top_k_values"] = _spans(
        "SELECT 'tenant_id' AS dimension, tenant_id AS value, count(*) AS spans FROM spans "
        f"WHERE ts > {jan.format('29')} AND ts <= {jan.format('30')} AND tenant_id <> '' "
        "GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20"
    )
    def bound(total: str) -> str:
        return f"CAST(ceil(({total}) * (3.5::DOUBLE / 2048::DOUBLE)) AS BIGINT) AS bound"

    day = f"ts >= {jan.format('29')} AND ts < {jan.format('30')} AND tenant_id <> ''"
    q["g07_from_states"] = _spans(
        "SELECT 'tenant_id' AS dimension, tenant_id AS value, count(*) AS spans, "
        f"{bound(f'SELECT count(*) FROM spans WHERE {day}')} FROM spans WHERE {day} "
        "GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20"
    )
    q["q26_from_states"] = _with(
        [_SPANS, _ALLOW],
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{d.name}' AS dimension, {d.column} AS value, count(*) AS spans, "
            + bound(f"SELECT count(*) FROM spans WHERE {d.column} <> ''")
            + f" FROM spans WHERE {d.column} <> '' AND {d.column} NOT IN "
            f"(SELECT value FROM allow WHERE dimension = '{d.name}') GROUP BY 2"
            for d in _R.dimensions
        )
        + ") ORDER BY spans DESC, dimension, value LIMIT 50",
    )
    q["g09_allowlist"] = _with(
        [_SPANS, _ALLOW],
        "SELECT dimension, count(*) AS n, min(value) AS first, max(value) AS last "
        "FROM allow GROUP BY 1",
    )
    status = _per_dimension(
        "SELECT '{d}' AS dimension, CAST({b} AS BIGINT) AS budget, "
        "(SELECT count(*) FROM allow WHERE dimension = '{d}') AS allowlisted, "
        "count(DISTINCT {c}) AS observed_distinct, "
        "count(*) FILTER (WHERE {c} = '__other__') AS other_bucket_rows, "
        "count(*) FILTER (WHERE {c} = '__none__') AS none_bucket_rows, count(*) AS total_rows",
        "minute",
    )
    q["g10_cardinality_status"] = _minute(
        "SELECT *, budget - allowlisted AS headroom, "
        f"{_r6('other_bucket_rows / total_rows', 'other_share')}, "
        f"{_r6('none_bucket_rows / total_rows', 'none_share')}, "
        f"observed_distinct <= budget + 2 AS within_budget FROM ({status})"
    )
    q["g12_latency_stats"] = _spans(
        f"SELECT count(*) AS n, {_r6('avg(s)', 'avg_s')}, "
        f"{quantiles('s', p50_s=0.5, p95_s=0.95, p99_s=0.99)}, {_r6('max(s)', 'max_s')} "
        f"FROM (SELECT {_LATENCY} AS s FROM spans)"
    )
    prints = (
        f"count(*) AS rows, {_sum('input_tokens')}, {_sum('output_tokens')}, "
        "round(sum({d}), {n}) AS duration_ms, count(DISTINCT tenant_id) AS tenants, "
        "count(DISTINCT trace_id) AS traces"
    )
    q["g13_source_fingerprint"] = _spans(
        f"SELECT operation, {prints.format(d='duration_ms', n=3)} FROM spans GROUP BY 1"
    )
    q["g14_lake_fingerprint"] = _lake(
        f"SELECT dt, {prints.format(d='dur', n=1)} FROM lake GROUP BY 1"
    )
    q["g15_duplication"] = _lake(
        "SELECT count(*) AS rows, count(DISTINCT span_id) AS distinct_spans, "
        "count(*) - count(DISTINCT span_id) AS duplicates, "
        f"{_r6('(count(*) - count(DISTINCT span_id)) / count(*)', 'duplicate_share')} FROM lake"
    )
    q["g16_lake_stats"] = _lake(
        "SELECT count(*) AS rows, count(DISTINCT dt) AS partitions, count(*) AS rows_by_size FROM lake"
    )
    q["g18_rollup_reduction"] = _minute(
        "SELECT round((SELECT count(*) FROM spans) / count(*), 1) AS value FROM "
        f"({_states(f'''date_trunc('hour', ts_minute) AS ts_hour, {_DIM_LIST}''')})"
    )

    q["w01_dedup"] = _spans(
        f"SELECT span_id, ts, ingested_at, tenant_id, {_r6('duration_ms', 'duration_ms')} FROM spans"
    )
    q["w01_lake_once"] = _spans(
        "SELECT CAST(ts AS DATE) AS dt, count(*) AS spans, count(*) AS distinct_spans, "
        f"{_sum('output_tokens')} FROM spans GROUP BY 1"
    )
    q["w02_counter_difference"] = _growth(
        accepted_spans="accepted_spans", refused_spans="refused_spans", sent_spans="sent_spans"
    )
    q["w03_sort_check"] = _lake(
        "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM lake"
    )
    ranked = (
        "SELECT tenant_id, total_tokens, rank FROM (SELECT tenant_id, total_tokens, "
        "rank() OVER (ORDER BY total_tokens DESC) AS rank FROM "
        f"(SELECT tenant_id, {_sum('tokens', 'total_tokens')} FROM report GROUP BY 1)) "
        "WHERE rank <= {n}"
    )
    q["w05_competition_rank"] = _report(ranked.format(n=25))
    q["w06_counter_resets"] = _runs("SELECT run_id, resets, first_reset_t FROM resets")
    q["w07_recovery"] = _runs(
        "SELECT r.run_id, min(t - greatest(burst_end, coalesce(stall_released_at, 0))) "
        "FILTER (WHERE t >= greatest(burst_end, coalesce(stall_released_at, 0)) "
        "AND total_lag <= 500) AS recovery_s FROM runs r LEFT JOIN samples s "
        "ON r.run_id = s.run_id GROUP BY 1"
    )
    q["w08_peak_rate"] = _runs(
        "SELECT run_id, round(greatest(coalesce(max((sent - ps) / (t - pt)), 0), 0), 6) "
        "AS peak_rate FROM pairs GROUP BY 1"
    )

    q["j02_incremental_states"] = _decoded(
        "SELECT count(*) AS state_spans, count(*) AS raw_spans FROM decoded"
    )
    q["j04_windowed_states"] = _stored(
        f"SELECT CAST(ts_minute AS DATE) AS day, {_sum('spans')}, {_sum('input_tokens')}, "
        f"{_sum('errors')} FROM minute GROUP BY 1"
    )
    q["j06_late_rows"] = _lake(
        "SELECT date_trunc('hour', ts) AS window_start, count(*) AS late_rows, "
        "max(ingested_at) AS last_arrival FROM again "
        "WHERE ingested_at > date_trunc('hour', ts) + INTERVAL 3602 SECOND GROUP BY 1"
    )
    q["j06_feed"] = _with(
        [_SPANS, _AGAIN],
        "SELECT CASE WHEN early THEN 1 ELSE 2 END AS sequence, count(*) AS read, "
        "count(DISTINCT span_id) FILTER (WHERE first) AS kept FROM (SELECT *, early = bool_or(early) OVER "
        "(PARTITION BY span_id) AS first FROM (SELECT *, ingested_at < TIMESTAMP "
        f"'{HALFWAY:%Y-%m-%d}' AS early FROM again)) GROUP BY early",
    )
    q["j07_dedup_stream"] = "SELECT count(*) AS rows, count(*) AS spans FROM events"

    q["m01_retention"] = _spans(
        "SELECT CAST(ts AS DATE) AS dt, count(*) AS spans FROM spans "
        "WHERE ts >= TIMESTAMP '2024-01-18 06:00:00' GROUP BY 1"
    )
    q["m03_hourly_export"] = _spans(
        "SELECT greatest(date_trunc('hour', ts), TIMESTAMP '2024-01-01 00:30:00') AS window_start, "
        "date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS rows FROM spans "
        "WHERE ts >= TIMESTAMP '2024-01-01 00:30:00' GROUP BY 1, 2"
    )
    q["m05_lake_complete"] = _lake(
        "SELECT count(*) AS spans, count(DISTINCT span_id) AS spans_deduped FROM lake"
    )
    q["m07_compaction"] = _minute(
        f"SELECT CAST(ts_minute AS DATE) AS day, {_sum('spans')}, {_sum('output_tokens')}, "
        f"{_sum('errors')} FROM minute GROUP BY 1"
    )
    q["m07_rewrite_after_compaction"] = q["m07_compaction"]
    q["j01_two_streams"] = _spans(
        f"SELECT operation, count(*) AS spans, {_sum('input_tokens')} FROM spans GROUP BY 1"
    )
    q["j11_late_scrapes"] = q["s07_health_sink"]
    q["j11_health_samples"] = q["s07_health_sink"]
    q["m04_late_reexport"] = _spans(
        f"SELECT CAST(ts AS DATE) AS dt, count(*) AS spans, {_sum('output_tokens')} FROM spans GROUP BY 1"
    )
    q["m04_late_feed"] = q["m04_late_reexport"]
    q["m09_run_grading"] = _runs('SELECT run_id, "check", passed, detail FROM graded')
    q["m10_span_accounting"] = _runs(
        "SELECT run_id, emitted_total, delivered, sdk_lost, unaccounted, "
        f"{_r6('generator_spans / generator_target_spans', 'generator_share')}, "
        f"{_r6('delivered / emitted_total', 'delivered_share')}, "
        f"{_r6('unaccounted / emitted_total', 'unaccounted_share')} FROM accounted"
    )
    empty = ", ".join(
        f"count(*) FILTER (WHERE {c} = '') AS no_{c}"
        for c in ("tenant_id", "trace_id", "span_id", "status_class", "service_name", "model")
    )
    q["m11_quality_counts"] = _spans(
        f"""SELECT count(*) AS total_rows, {empty},
        count(*) FILTER (WHERE span_kind = 'unspecified') AS no_span_kind,
        count(*) FILTER (WHERE ts < TIMESTAMP '2020-01-01') AS before_2020,
        count(*) FILTER (WHERE ts > TIMESTAMP '2024-02-02') AS in_the_future,
        count(*) FILTER (WHERE duration_ms <= 0) AS duration_not_positive,
        count(*) FILTER (WHERE duration_ms > 600000) AS duration_over_10_min,
        count(*) FILTER (WHERE operation = 'chat') AS chat_rows,
        count(*) FILTER (WHERE operation = 'chat' AND input_tokens > 0) AS chat_with_tokens,
        count(*) FILTER (WHERE operation = 'chat' AND kv_cache_utilization > 0
          AND kv_cache_utilization <= 1) AS chat_with_kv_cache,
        count(*) FILTER (WHERE operation = 'chat' AND ttft_ms > 0) AS chat_with_ttft FROM spans"""
    )
    n = _sent_attributes()
    q["m11_attribute_counts"] = _decoded(
        f"SELECT count(*) AS total_rows, {_r6(f'avg({n})', 'avg_attributes')}, "
        f"CAST(min({n}) AS INTEGER) AS min_attributes, "
        f"CAST(max({n}) AS INTEGER) AS max_attributes FROM decoded"
    )

    q["q01_spans_per_sec"] = _spans("SELECT round(count(*) / 60, 6) AS value FROM spans")
    q["q01_spans_per_sec_of_range"] = _spans(
        "SELECT round(count(*) / (31 * 86400), 6) AS value FROM spans"
    )
    q["q02_traces"] = _spans("SELECT count(DISTINCT trace_id) AS value FROM spans")
    q["q03_output_tokens_per_sec"] = _spans(
        "SELECT round(sum(output_tokens) / 60, 6) AS value FROM spans"
    )
    q["q04_error_rate"] = _minute(
        f"SELECT {_r6('sum(errors) / nullif(sum(spans), 0)', 'value')} FROM minute"
    )
    q["q05_kv_cache_max"] = _minute(f"SELECT {_r6('max(kv_cache_max)', 'value')} FROM minute")
    q["q06_active_tenants"] = _minute(
        "SELECT count(DISTINCT tenant_id) AS value FROM minute "
        "WHERE tenant_id NOT IN ('__other__', '__none__')"
    )
    q["q07_token_throughput"] = _minute(
        f"SELECT ts_minute AS time, {_sum('input_tokens')}, {_sum('output_tokens')} "
        "FROM minute GROUP BY 1"
    )
    shares = (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
    observed = ", ".join(
        f"round(quantile_disc(ttft_ms, {p}) FILTER (WHERE ttft_ms > 0), 6) AS {c}" for c, p in shares
    )
    q["q08_ttft_quantiles"] = _spans(
        f"SELECT date_trunc('minute', ts) AS time, {observed} FROM spans GROUP BY 1"
    )
    sketched = ", ".join(f"{_held('ttft_ms', p)} AS {c}" for c, p in shares)
    q["q09_ttft_by_model"] = _with(
        [_SPANS, _ALLOW, _GUARDED],
        "SELECT date_trunc('minute', ts) AS time, model, "
        f"{_held('ttft_ms', 0.95)} AS p95 "
        "FROM guarded WHERE model <> '__none__' GROUP BY 1, 2",
    )
    q["q10_kv_cache_series"] = _minute(
        "SELECT ts_minute AS time, "
        f"{_r6('sum(kv_cache_sum) / nullif(sum(kv_cache_cnt), 0)', 'avg')}, "
        f"{_r6('max(kv_cache_max)', 'max')} FROM minute GROUP BY 1"
    )
    q["q11_top_tenants_exact"] = _minute(
        "SELECT tenant_id AS tenant, min(tenant_tier) AS tier, "
        f"{_sum('spans', 'span_count')}, {_sum('output_tokens')}, "
        "round(sum(errors) / nullif(sum(spans), 0), 4) AS error_rate FROM minute GROUP BY 1 "
        "ORDER BY span_count DESC, tenant LIMIT 20"
    )
    q["q11_top_tenants"] = _with(
        [_SPANS, _ALLOW, _GUARDED],
        "SELECT tenant_id AS tenant, min(tenant_tier) AS tier, count(*) AS span_count, "
        f"count(DISTINCT trace_id) AS trace_count, {_sum('output_tokens')}, {_held('ttft_ms', 0.95, 1)} AS ttft_p95_ms, "
        "round(count(*) FILTER (WHERE failed) / count(*), 4) AS error_rate FROM guarded GROUP BY 1 "
        "ORDER BY span_count DESC, tenant LIMIT 20",
    )
    q["q12_errors_by_class"] = _minute(
        f"SELECT ts_minute AS time, status_class, {_sum('spans', 'error_spans')} FROM minute "
        "WHERE status_class <> 'ok' GROUP BY 1, 2"
    )
    last = "FROM health ORDER BY sampled_at DESC LIMIT 1"
    q["q13_current_lag"] = _health(f"SELECT total_lag AS value {last}")
    q["q14_dropped_total"] = _health(f"SELECT send_failed_spans + enqueue_failed_spans AS value {last}")
    q["q15_export_queue"] = _health(
        f"SELECT round(queue_size / nullif(queue_capacity, 0), 6) AS value {last}"
    )
    q["q16_refused_spans"] = _health(f"SELECT refused_spans AS value {last}")
    q["q18_lag_series"] = _health(
        "SELECT sampled_at AS time, total_lag, max_partition_lag AS worst_partition FROM health"
    )
    q["q19_dropped_per_sample"] = _growth(dropped="send_failed_spans + enqueue_failed_spans")
    q["q20_ingest_latency"] = _spans(
        f"SELECT date_trunc('minute', ts) AS time, {quantiles('s', p50=0.5, p95=0.95)} "
        f"FROM (SELECT ts, {_LATENCY} AS s FROM spans) GROUP BY 1"
    )
    q["q21_collector_throughput"] = _growth(accepted="accepted_spans", sent="sent_spans")

    def sentinel_sum(sentinel: str) -> str:
        hits = " + ".join(f"CAST({c} = '{sentinel}' AS INTEGER)" for c in _DIMS)
        return _minute(f"SELECT {_sum(f'spans * ({hits})', 'value')} FROM minute")

    q["q22_unregistered_spans"] = sentinel_sum("__other__")
    q["q23_absent_dimensions"] = sentinel_sum("__none__")
    q["q24_worst_minute"] = _minute(
        f"SELECT max(n) AS value, CAST({_R.max_rows_per_bucket} AS BIGINT) AS bound FROM "
        "(SELECT ts_minute, count(*) AS n FROM minute GROUP BY 1)"
    )
    q["q25_rollup_compression"] = _minute(
        "SELECT round((SELECT count(*) FROM spans) / count(*), 1) AS value FROM minute"
    )
    q["q26_which_unregistered"] = _with(
        [_SPANS, _ALLOW],
        f"SELECT * FROM ({unregistered}) ORDER BY spans DESC, dimension, value LIMIT 50",
    )
    breakdown = (
        "SELECT '{d}' AS dimension, "
        "coalesce(CAST(sum(spans) FILTER (WHERE {c} NOT IN ('__other__', '__none__')) AS BIGINT), 0)"
        " AS registered, "
        "coalesce(CAST(sum(spans) FILTER (WHERE {c} = '__other__') AS BIGINT), 0) AS unregistered, "
        "coalesce(CAST(sum(spans) FILTER (WHERE {c} = '__none__') AS BIGINT), 0) AS absent, "
        "count(DISTINCT {c}) FILTER (WHERE {c} NOT IN ('__other__', '__none__')) "
        "AS distinct_values, CAST({b} AS BIGINT) AS budget"
    )
    q["q27_bucket_breakdown"] = _minute(_per_dimension(breakdown, "minute"))
    series = ", ".join(
        f"coalesce(CAST(sum(spans) FILTER (WHERE {d.column} = '__other__') AS BIGINT), 0) "
        f"AS {d.name}"
        for d in _R.dimensions
    )
    q["q28_unregistered_series"] = _minute(
        f"SELECT m.ts_minute AS time, {series} FROM minute m GROUP BY 1"
    )
    q["q29_live_headline"] = _with(
        [_SPANS, _ALLOW, _GUARDED, _MINUTE, _HEALTH],
        f"SELECT count(*) AS total_spans, {recent}, (SELECT count(*) FROM minute) AS rollup_rows, "
        "(SELECT arg_max(total_lag, sampled_at) FROM health) AS lag, "
        "(SELECT arg_max(send_failed_spans + enqueue_failed_spans, sampled_at) FROM health) "
        "AS dropped_spans FROM spans",
    )
    q["q30_spans_per_minute"] = _minute(
        f"SELECT CAST(epoch(ts_minute) AS BIGINT) AS t, {_sum('spans', 'n')} FROM minute WHERE "
        "ts_minute BETWEEN TIMESTAMP '2024-01-15 11:45:00' AND TIMESTAMP '2024-01-15 12:00:00' "
        "GROUP BY 1"
    )
    q["q31_tenant_shares"] = _minute(
        "SELECT name, n FROM (WITH totals AS (SELECT tenant_id AS name, "
        f"{_sum('spans', 'n')} FROM minute GROUP BY 1), named AS (SELECT * FROM totals "
        "WHERE name <> '__other__' ORDER BY n DESC, name LIMIT 10) "
        "SELECT * FROM named UNION ALL SELECT '__other__', "
        "CAST((SELECT sum(n) FROM totals) - (SELECT sum(n) FROM named) AS BIGINT))"
    )
    q["q32_lake_top_tenants"] = _lake(
        f"SELECT tenant_id, count(*) AS spans, {_sum('output_tokens')}, "
        "round(avg(ttft), 1) AS avg_ttft_ms FROM lake GROUP BY 1 "
        "ORDER BY output_tokens DESC, tenant_id LIMIT 10"
    )
    q["q33_lake_daily_volume"] = _lake(
        "SELECT dt, count(*) AS spans, round(sum(output_tokens) / 1e6, 2) AS m_output_tokens "
        "FROM lake GROUP BY 1"
    )
    q["q34_lake_model_latency"] = _lake(
        "SELECT dt, hour, model, count(*) AS spans, round(quantile_cont(ttft, 0.95), 1) AS ttft_p95 "
        "FROM lake WHERE operation = 'chat' GROUP BY 1, 2, 3"
    )
    q["q35_report_cards"] = _report(
        f"SELECT count(*) AS total_spans, {_sum('tokens', 'total_tokens')}, "
        f"count(DISTINCT tenant_id) AS tenants, {quantiles('ttft_ms', p95_ttft_ms=0.95)} "
        "FROM report"
    )
    q["q36_tokens_by_model"] = _report(
        f"SELECT model, {_sum('tokens', 'total_tokens')} FROM report GROUP BY 1"
    )
    q["q37_report_top_tenants"] = _report(ranked.format(n=10))
    q["q38_report_model_table"] = _report(
        f"SELECT model, count(*) AS total_spans, {quantiles('ttft_ms', p95_ttft_ms=0.95)}, "
        "round(count(*) FILTER (WHERE status_class <> 'ok') / count(*), 6) AS error_share "
        "FROM report GROUP BY 1"
    )
    q["q39_spans_by_status"] = _report(
        "SELECT status_class, count(*) AS total_spans FROM report GROUP BY 1"
    )
    q["q40_landed_summary"] = _with(
        [_SPANS, _ALLOW, _GUARDED, _MINUTE, _AGAIN],
        """SELECT count(*) AS spans, count(DISTINCT tenant_id) AS tenants,
        count(DISTINCT trace_id) AS traces, round(quantile_cont(ttft_ms, 0.95), 1) AS ttft_p95,
        (SELECT CAST(sum(spans) AS BIGINT) FROM minute) AS rollup_spans,
        (SELECT count(*) FROM minute) AS rollup_rows,
        round(count(*) / (SELECT count(*) FROM minute), 6) AS reduction,
        count(DISTINCT trace_id) FILTER (WHERE copied) AS dead_letters,
        (SELECT count(*) FROM again) AS lake_rows,
        (SELECT count(*) - count(DISTINCT span_id) FROM again) AS lake_duplicates,
        (SELECT round((count(*) - count(DISTINCT span_id)) / count(*), 6) FROM again)
          AS lake_duplicate_share FROM spans""",
    )
    q["q41_latency_by_model"] = _spans(
        f"SELECT model, {quantiles('ttft_ms', p95=0.95)} FROM spans "
        "WHERE operation = 'chat' AND model <> '' GROUP BY 1 HAVING count(*) > 100"
    )
    q["q42_tenant_skew"] = _spans(
        "SELECT count(*) AS tenants, CAST(sum(n) AS BIGINT) AS spans, "
        "CAST(sum(n) FILTER (WHERE r <= 5) AS BIGINT) AS top_spans, "
        "round(sum(n) FILTER (WHERE r <= 5) / sum(n), 6) AS top_share FROM "
        "(SELECT tenant_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, tenant_id) "
        "AS r FROM spans GROUP BY 1)"
    )
    totals = ", ".join(_sum(c) for c in ("spans", "input_tokens", "output_tokens", "errors"))
    q["q43_rollup_agreement"] = _minute(
        "SELECT 'raw' AS level, count(*) AS spans, "
        f"{_sum('input_tokens')}, {_sum('output_tokens')}, "
        "count(*) FILTER (WHERE status_class <> 'ok') AS errors FROM spans "
        f"UNION ALL SELECT 'minute', {totals} FROM minute "
        f"UNION ALL SELECT 'hour', {totals} FROM minute"
    )
    q["q44_user_sql"] = _spans(
        f"SELECT model, count(*) AS spans, {_sum('output_tokens')} FROM spans "
        f"WHERE ts >= {jan.format('10')} GROUP BY 1"
    )
    # The same panels over the states the stream wrote.
    q |= {f"{name}_streamed": q[name] for name in STREAMED}
    q["q08_ttft_quantiles_streamed"] = _spans(
        f"SELECT date_trunc('minute', ts) AS time, {sketched} FROM spans GROUP BY 1"
    )
    return q
