"""Table schemas, attribute vocabulary and retention of the span data model.

No column is nullable in meaning: an absent string is ``''`` and an absent
number is ``0``. Queries rely on that contract.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import types as T

# --- fixed values of the wire format ------------------------------------------

# Wire attribute -> promoted string column.
STRING_ATTRIBUTES = {
    "tenant.id": "tenant_id",
    "tenant.tier": "tenant_tier",
    "gen_ai.request.model": "model",
    "gen_ai.operation.name": "operation",
    "http.route": "route",
    "cloud.region": "region",
    "status.class": "status_class",
    "request.id": "request_id",
    "error.type": "error_type",
}

# Wire attribute -> (promoted column, largest value its type holds).
COUNT_ATTRIBUTES = {
    "gen_ai.usage.input_tokens": ("input_tokens", 2**63 - 1),
    "gen_ai.usage.output_tokens": ("output_tokens", 2**63 - 1),
    "llm.cached_prompt_tokens": ("cached_prompt_tokens", 2**63 - 1),
    "llm.batch_size": ("batch_size", 2**31 - 1),
}

# Wire attribute -> promoted float column.
MEASURE_ATTRIBUTES = {
    "llm.kv_cache.utilization": "kv_cache_utilization",
    "llm.time_to_first_token_ms": "ttft_ms",
    "llm.inter_token_latency_ms": "itl_ms",
    "llm.queue_time_ms": "queue_time_ms",
}

SERVICE_ATTRIBUTE = "service.name"

# Ordinal of the span kind on the wire; anything else is "unspecified".
SPAN_KINDS = {1: "internal", 2: "server", 3: "client", 4: "producer", 5: "consumer"}

# --- tables -------------------------------------------------------------------

DIMENSION_COLUMNS = (
    "tenant_id",
    "tenant_tier",
    "model",
    "operation",
    "route",
    "region",
    "status_class",
)

SPANS = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("span_id", T.StringType()),
        T.StructField("parent_span_id", T.StringType()),
        T.StructField("span_name", T.StringType()),
        T.StructField("span_kind", T.StringType()),
        T.StructField("duration_ms", T.FloatType()),
        T.StructField("tenant_id", T.StringType()),
        T.StructField("tenant_tier", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("status_class", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
        T.StructField("cached_prompt_tokens", T.LongType()),
        T.StructField("kv_cache_utilization", T.FloatType()),
        T.StructField("ttft_ms", T.FloatType()),
        T.StructField("itl_ms", T.FloatType()),
        T.StructField("queue_time_ms", T.FloatType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# The lake keeps the typed columns only, named one by one so that a new column
# of the hot table never changes files already written.
EXPORT_COLUMNS = tuple(f.name for f in SPANS if f.name not in ("attributes", "ingested_at"))

LAKE = T.StructType(
    [f for f in SPANS if f.name in EXPORT_COLUMNS]
    + [T.StructField("hour", T.IntegerType()), T.StructField("dt", T.DateType())]
)

MESSAGES = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

DEAD_LETTERS = T.StructType(
    [
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("raw_message", T.StringType()),
    ]
)

OFFSETS = T.StructType(
    [
        T.StructField("consumed_at", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first_offset", T.LongType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("messages", T.LongType()),
    ]
)

HEALTH_COUNTERS = (
    "accepted_spans",
    "refused_spans",
    "sent_spans",
    "send_failed_spans",
    "enqueue_failed_spans",
    "queue_size",
    "queue_capacity",
)

HEALTH = T.StructType(
    [
        T.StructField("sampled_at", T.TimestampType()),
        T.StructField("total_lag", T.LongType()),
        T.StructField("max_partition_lag", T.LongType()),
        T.StructField("partitions", T.LongType()),
    ]
    + [T.StructField(c, T.LongType()) for c in HEALTH_COUNTERS]
)

ALLOWLIST = T.StructType(
    [
        T.StructField("dimension", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# How long each table keeps its rows (fixed values).
RETENTION = {
    "spans_raw": timedelta(hours=48),
    "spans_1m": timedelta(days=7),
    "spans_1h": timedelta(days=90),
    "values_1m": timedelta(days=7),
    "offsets": timedelta(days=30),
    "dead_letters": timedelta(days=7),
    "health": timedelta(days=30),
}
