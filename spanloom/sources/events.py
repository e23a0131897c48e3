"""Adapters from a plain event log to the tables of the span data model.

The event log is ``(event_id, ts, user_id, event_type, value, props)``; every
figure below is a fixed function of one row, so the tables grow with the log and
every value can be recomputed in another engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.ordered import with_running_sum
from spanloom.registry import Registry, default_registry
from spanloom.schema import COUNT_ATTRIBUTES, EXPORT_COLUMNS, MEASURE_ATTRIBUTES, STRING_ATTRIBUTES


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _pick(key: str, options: list[str] | tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{option}'" for i, option in enumerate(options))
    return f"CASE {key} {arms} END"


def spans_from_events(events: DataFrame, registry: Registry | None = None) -> DataFrame:
    """One span per event. Measures stay doubles so that sums can be compared exactly."""
    models = (registry or default_registry())["model"].values
    # Read once per row and used by many columns below.
    base = events.selectExpr(
        "event_id",
        "user_id",
        "value",
        "date_trunc('millisecond', ts) AS ts",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "event_type = 'signup' AS is_tool",
        "event_type NOT IN ('signup', 'purchase') AS is_call",
        "event_type = 'error' AS failed",
        "CASE event_type WHEN 'signup' THEN 'execute_tool' WHEN 'purchase' THEN 'invoke_agent' "
        "WHEN 'click' THEN 'embeddings' ELSE 'chat' END AS operation",
        "CASE WHEN event_type = 'signup' THEN '' WHEN event_id % 97 = 0 THEN 'shadow-deploy-v9' "
        f"ELSE {_pick('event_id % 5', models)} END AS model",
    )
    return base.selectExpr(
        "ts",
        "concat('t', event_id div 4) AS trace_id",
        "concat('s', event_id) AS span_id",
        "CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('s', event_id - event_id % 4) END "
        "AS parent_span_id",
        "trim(concat(operation, ' ', model)) AS span_name",
        "CASE operation WHEN 'invoke_agent' THEN 'server' WHEN 'execute_tool' THEN 'internal' "
        "ELSE 'client' END AS span_kind",
        "value * 10 + 1 AS duration_ms",
        # Four digits at least; longer numbers stay whole.
        "concat('tenant-', lpad(user_id, greatest(4, length(user_id)), '0')) AS tenant_id",
        "CASE WHEN is_tool THEN '' WHEN user_id < 8 THEN 'enterprise' WHEN user_id < 38 "
        "THEN 'pro' ELSE 'free' END AS tenant_tier",
        "model",
        "operation",
        "CASE operation WHEN 'execute_tool' THEN '' WHEN 'invoke_agent' THEN '/v1/agents/invoke' "
        "WHEN 'embeddings' THEN '/v1/embeddings' ELSE '/v1/chat/completions' END AS route",
        "CASE WHEN is_tool THEN '' WHEN event_id % 211 = 0 THEN 'antarctica-1' ELSE "
        f"{_pick('user_id % 3', ['us-east-1', 'us-west-2', 'eu-central-1'])} END AS region",
        "CASE WHEN failed THEN "
        f"{_pick('event_id % 3', ['server_error', 'timeout', 'client_error'])} "
        "ELSE 'ok' END AS status_class",
        "CASE WHEN is_tool THEN 'tool-runner' ELSE 'inference-gateway' END AS service_name",
        "CAST(IF(is_call, k * 10, 0) AS BIGINT) AS input_tokens",
        "CAST(IF(operation = 'chat', k * 4, 0) AS BIGINT) AS output_tokens",
        "CAST(IF(is_call, k * 3, 0) AS BIGINT) AS cached_prompt_tokens",
        "IF(is_call, CAST(k AS DOUBLE) / 100D, 0D) AS kv_cache_utilization",
        "IF(is_call, value, 0D) AS ttft_ms",
        "IF(is_call, value / 20, 0D) AS itl_ms",
        "IF(is_call AND k > 80, value, 0D) AS queue_time_ms",
        "IF(is_call, 1 + k % 48, 0) AS batch_size",
        "concat('r', event_id) AS request_id",
        "CASE WHEN failed THEN "
        f"{_pick('event_id % 3', ['engine_overloaded', 'deadline_exceeded', 'invalid_request'])} "
        "ELSE '' END AS error_type",
        "timestamp_micros(unix_micros(ts) + CAST(round((value * 10 + 1) * 1000) AS BIGINT) "
        "+ (event_id % 10) * 1000000) AS ingested_at",
    )


def spans_with_redelivery(events: DataFrame, registry: Registry | None = None) -> DataFrame:
    """The spans, with every twentieth delivered a second time a minute later."""
    again = spans_from_events(events.filter(F.col("event_id") % 20 == 0), registry).withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 60 SECONDS")
    )
    return spans_from_events(events, registry).unionByName(again)


def lake_rows(spans: DataFrame) -> DataFrame:
    """Spans in the shape of the lake: the exported columns, ``hour`` and ``dt``."""
    return spans.select(
        *EXPORT_COLUMNS, F.hour("ts").alias("hour"), F.to_date("ts").alias("dt")
    )


def messages_from_spans(spans: DataFrame, *kept: str) -> DataFrame:
    """Spans as trace messages in the wire format: ``(value, topic, partition, offset)``.

    The spans of one trace travel in one message; a trace of the event log has four. Spans are
    gathered by their columns: the wire format takes eight times the room, and is written last.
    ``trace_id`` can be kept beside it, which saves finding it in the message again.
    """
    columns = ["trace_id", "span_id", "parent_span_id", "span_name", "span_kind", "service_name", "ts", "duration_ms"]
    measured = [*STRING_ATTRIBUTES.values(), *(c for c, _ in COUNT_ATTRIBUTES.values()), *MEASURE_ATTRIBUTES.values()]
    columns += [c for c in measured if c not in columns]
    per_trace = spans.groupBy("trace_id").agg(F.collect_list(F.struct(*columns)).alias("members"))
    number_of_trace = F.xxhash64("trace_id")
    return per_trace.select(
        *kept,
        F.to_json(F.struct(F.transform("members", _wire_span).alias("resourceSpans"))).alias("value"),
        F.lit("otel.spans").alias("topic"),
        F.pmod(number_of_trace, F.lit(6)).cast("int").alias("partition"),
        F.pmod(number_of_trace, F.lit(1 << 40)).alias("offset"),
    )


def _wire_span(member: Column) -> Column:
    """A span in the wire format, with its resource."""

    def text(key: str, value: Column) -> Column:
        return F.struct(
            F.lit(key).alias("key"),
            F.struct(
                value.alias("stringValue"),
                F.lit(None).cast("string").alias("intValue"),
                F.lit(None).cast("double").alias("doubleValue"),
            ).alias("value"),
        )

    def whole(key: str, value: Column) -> Column:
        return F.struct(
            F.lit(key).alias("key"),
            F.struct(
                F.lit(None).cast("string").alias("stringValue"),
                value.cast("string").alias("intValue"),
                F.lit(None).cast("double").alias("doubleValue"),
            ).alias("value"),
        )

    def number(key: str, value: Column) -> Column:
        return F.struct(
            F.lit(key).alias("key"),
            F.struct(
                F.lit(None).cast("string").alias("stringValue"),
                F.lit(None).cast("string").alias("intValue"),
                value.cast("double").alias("doubleValue"),
            ).alias("value"),
        )

    attributes = F.array(
        *[text(key, member[c]) for key, c in STRING_ATTRIBUTES.items()],
        *[whole(key, member[c]) for key, (c, _) in COUNT_ATTRIBUTES.items()],
        *[number(key, member[c]) for key, c in MEASURE_ATTRIBUTES.items()],
    )
    # An absent dimension is not sent at all.
    sent = F.filter(
        attributes,
        lambda a: a["value"]["stringValue"].isNull() | (a["value"]["stringValue"] != ""),
    )
    start = F.unix_micros(member["ts"]) * 1000
    end = start + F.round(member["duration_ms"].cast("double") * 1000).cast("bigint") * 1000
    kinds = F.create_map(
        *[F.lit(x) for pair in (("internal", 1), ("server", 2), ("client", 3)) for x in pair]
    )
    span = F.struct(
        member["trace_id"].alias("traceId"),
        member["span_id"].alias("spanId"),
        member["parent_span_id"].alias("parentSpanId"),
        member["span_name"].alias("name"),
        F.try_element_at(kinds, member["span_kind"]).alias("kind"),
        start.cast("string").alias("startTimeUnixNano"),
        end.cast("string").alias("endTimeUnixNano"),
        sent.alias("attributes"),
    )
    resource = F.struct(
        F.array(
            F.struct(
                F.lit("service.name").alias("key"),
                F.struct(member["service_name"].alias("stringValue")).alias("value"),
            )
        ).alias("attributes")
    )
    scopes = F.array(F.struct(F.array(span).alias("spans")))
    return F.struct(resource.alias("resource"), scopes.alias("scopeSpans"))


def health_from_events(events: DataFrame) -> DataFrame:
    """Hourly samples of cumulative counters, with one counter reset planted.

    Accepted, sent and dropped counts are running sums of hourly event counts.
    The counters start again at the 400th hour of the series.
    """
    hour = F.date_trunc("hour", "ts")
    kind = F.col("event_type")
    hourly = events.groupBy(hour.alias("sampled_at")).agg(
        F.count("*").alias("accepted"),
        F.count_if(kind == "signup").alias("refused"),
        F.count_if(kind != "error").alias("sent"),
        F.count_if((kind == "error") & (F.col("event_id") % 3 == 0)).alias("failed"),
        F.count_if((kind == "error") & (F.col("event_id") % 3 == 1)).alias("rejected"),
        F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("ks"),
        F.max(F.get_json_object("props", "$.k").cast("bigint")).alias("top"),
    )
    reset = (
        F.unix_timestamp("sampled_at") - F.lit(1704067200) >= F.lit(400 * 3600)
    ).cast("int")
    marked = hourly.withColumn("life", reset)
    summed = with_running_sum(
        marked,
        "sampled_at",
        ["accepted", "refused", "sent", "failed", "rejected"],
        F.date_trunc("day", "sampled_at"),
        by=["life"],
    )
    return summed.select(
        "sampled_at",
        F.col("ks").alias("total_lag"),
        F.col("top").alias("max_partition_lag"),
        F.lit(6).cast("bigint").alias("partitions"),
        F.col("sum_accepted").alias("accepted_spans"),
        F.col("sum_refused").alias("refused_spans"),
        F.col("sum_sent").alias("sent_spans"),
        F.col("sum_failed").alias("send_failed_spans"),
        F.col("sum_rejected").alias("enqueue_failed_spans"),
        (F.col("ks") % 100).alias("queue_size"),
        F.lit(100).cast("bigint").alias("queue_capacity"),
    )
