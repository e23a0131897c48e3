"""Decode trace messages in OTLP JSON into typed span rows.

Every step is total: a malformed span gives a row with empty fields and a
malformed message goes to the dead letters, so no input can stop a stream.

Messages that fit the wire schema, nearly all, are read by ``from_json``. It
reports a message in which any element has another type, and would lose that
element's neighbours; such messages are read again as VARIANT, field by field.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import scalars as S
from spanloom.schema import (
    COUNT_ATTRIBUTES,
    MEASURE_ATTRIBUTES,
    SERVICE_ATTRIBUTE,
    SPAN_KINDS,
    SPANS,
    STRING_ATTRIBUTES,
)


_CORRUPT = "_corrupt"
_VALUE = "struct<stringValue: string, intValue: string, doubleValue: string, boolValue: string>"
_ATTRIBUTES = f"array<struct<key: string, value: {_VALUE}>>"
_SPAN = (
    "struct<traceId: string, spanId: string, parentSpanId: string, name: string, kind: int, "
    f"startTimeUnixNano: string, endTimeUnixNano: string, attributes: {_ATTRIBUTES}>"
)
_RESOURCES = (
    f"array<struct<resource: struct<attributes: {_ATTRIBUTES}>, "
    f"scopeSpans: array<struct<spans: array<{_SPAN}>>>>>"
)


def _get(document: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(document, path, kind)


def _fields(document: Column, names: tuple[str, ...], path: str = "$") -> list[Column]:
    out = []
    for name in names:
        out += [F.lit(name), _get(document, f"{path}.{name}", "string")]
    return out


def _loose_attributes(document: Column, path: str) -> Column:
    kinds = ("stringValue", "intValue", "doubleValue", "boolValue")
    return F.transform(
        _get(document, path, "array<variant>"),
        lambda a: F.named_struct(
            F.lit("key"),
            _get(a, "$.key", "string"),
            F.lit("value"),
            F.named_struct(*_fields(a, kinds, "$.value")),
        ),
    )


def _loose_span(span: Column) -> Column:
    return F.named_struct(
        *_fields(span, ("traceId", "spanId", "parentSpanId", "name")),
        F.lit("kind"),
        _get(span, "$.kind", "int"),
        *_fields(span, ("startTimeUnixNano", "endTimeUnixNano")),
        F.lit("attributes"),
        _loose_attributes(span, "$.attributes"),
    )


def _loose_resources(document: Column) -> Column:
    """The wire schema out of a VARIANT; what has another type becomes null, alone."""
    return F.transform(
        _get(document, "$.resourceSpans", "array<variant>"),
        lambda rs: F.named_struct(
            F.lit("resource"),
            F.named_struct(F.lit("attributes"), _loose_attributes(rs, "$.resource.attributes")),
            F.lit("scopeSpans"),
            F.transform(
                _get(rs, "$.scopeSpans", "array<variant>"),
                lambda ss: F.named_struct(
                    F.lit("spans"),
                    F.transform(_get(ss, "$.spans", "array<variant>"), _loose_span),
                ),
            ),
        ),
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Add ``readable`` and ``resources``, the message in the wire schema.

    A message is readable when its payload is a JSON object.
    """
    is_object = F.col("value").rlike(r"^\s*\{")
    strict = F.from_json(
        "value",
        f"struct<resourceSpans: {_RESOURCES}, {_CORRUPT}: string>",
        {"columnNameOfCorruptRecord": _CORRUPT},
    )
    fits = F.col("__strict").isNotNull() & F.col(f"__strict.{_CORRUPT}").isNull()
    # Parsed a second time only where the first reading did not fit.
    loose = F.when(~F.col("__fits"), F.try_parse_json("value"))
    return (
        messages.withColumn("__strict", F.when(is_object, strict))
        .withColumn("__fits", fits)
        .withColumn("__loose", F.when(is_object, loose))
        .select(
            *messages.columns,
            (F.col("__fits") | F.col("__loose").isNotNull()).alias("readable"),
            F.when(F.col("__fits"), F.col("__strict.resourceSpans"))
            .otherwise(_loose_resources(F.col("__loose")))
            .alias("resources"),
        )
    )


def _any_value(a: Column) -> Column:
    value = a["value"]
    kinds = ("stringValue", "intValue", "doubleValue", "boolValue")
    return F.coalesce(*[value[k] for k in kinds], F.lit(""))


def _resource_value(a: Column) -> Column:
    return F.coalesce(a["value"]["stringValue"], F.lit(""))


def _as_map(keys: Column, values: Column) -> Column:
    """Two arrays to a map. Distinct keys without null, nearly always, need no clean-up."""
    clean = F.size(F.array_except(keys, F.array(F.lit(None).cast("string")))) == F.size(keys)
    built = F.when(clean, F.map_from_arrays(keys, values)).when(
        keys.isNotNull(), S.first_wins_map(F.arrays_zip(keys.alias("k"), values.alias("v")))
    )
    return F.coalesce(built, F.create_map().cast("map<string,string>"))


def _unnest(df: DataFrame, nested: str, name: str, *kept: Column | str) -> DataFrame:
    """One row per array element, and one for each dead letter where those are carried along.

    The outer form keeps the optimizer from adding a size filter below it, which
    would parse every message again.
    """
    dead = ["dead"] if "dead" in df.columns else []
    keep = F.col("__at").isNotNull()
    if dead:
        keep = keep | F.col("dead").isNotNull()
    return (
        df.select(*dead, *kept, F.posexplode_outer(nested).alias("__at", name))
        .filter(keep)
        .drop("__at")
    )


def _arrival(ingested_at: datetime | Column | None) -> Column:
    now = F.current_timestamp() if ingested_at is None else S.instant(ingested_at)
    return F.date_trunc("second", now)


def _dead(ingested_at: datetime | Column | None) -> Column:
    """The dead letter of an unreadable message: its origin and the whole payload, so that it can be replayed."""
    value = F.col("value")
    reason = (
        F.when(value.isNull(), "no payload")
        .when(F.trim(value) == "", "empty payload")
        .when(~value.rlike(r"^\s*\{"), "not a JSON object")
        .otherwise("malformed JSON")
    )
    return F.struct(
        _arrival(ingested_at).alias("ingested_at"),
        "topic",
        "partition",
        "offset",
        reason.alias("error"),
        F.coalesce(value, F.lit("")).alias("raw_message"),
    )


def flatten_messages(parsed: DataFrame) -> DataFrame:
    """One row per span of parsed messages, with its resource's attributes."""
    resources = _unnest(parsed, "resources", "rs")
    scopes = _unnest(
        resources, "rs.scopeSpans", "ss", F.col("rs.resource.attributes").alias("resource")
    )
    return _unnest(scopes, "ss.spans", "span", "resource")


def _decode(parsed: DataFrame, ingested_at: datetime | Column | None) -> DataFrame:
    """Parsed messages to typed spans.

    Each step below is its own projection: a value used by several expressions
    of the next step is computed once.
    """
    dead = ["dead"] if "dead" in parsed.columns else []

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"span.{name}"), F.lit(""))

    listed = flatten_messages(parsed).select(
        *dead,
        text("startTimeUnixNano").alias("start_ns"),
        text("endTimeUnixNano").alias("end_ns"),
        text("traceId").alias("trace_id"),
        text("spanId").alias("span_id"),
        text("parentSpanId").alias("parent_span_id"),
        text("name").alias("span_name"),
        S.kind_name(F.col("span.kind"), SPAN_KINDS).alias("span_kind"),
        F.col("span.attributes.key").alias("keys"),
        F.transform("span.attributes", _any_value).alias("values"),
        F.col("resource.key").alias("resource_keys"),
        F.transform("resource", _resource_value).alias("resource_values"),
    )
    plain = (*dead, "trace_id", "span_id", "parent_span_id", "span_name", "span_kind")
    mapped = listed.select(
        *plain,
        S.nanos_or_zero(F.col("start_ns")).alias("start_ns"),
        S.nanos_or_zero(F.col("end_ns")).alias("end_ns"),
        _as_map(F.col("keys"), F.col("values")).alias("attributes"),
        _as_map(F.col("resource_keys"), F.col("resource_values")).alias("resource"),
    )
    wanted = {
        **STRING_ATTRIBUTES,
        **{key: column for key, (column, _) in COUNT_ATTRIBUTES.items()},
        **MEASURE_ATTRIBUTES,
    }
    named = mapped.select(
        *plain,
        "start_ns",
        "end_ns",
        "attributes",
        S.text_of(F.col("resource"), SERVICE_ATTRIBUTE).alias("service_name"),
        *[S.text_of(F.col("attributes"), key).alias(c) for key, c in wanted.items()],
    )
    typed = {
        "ts": S.millis_timestamp(F.col("start_ns")),
        "duration_ms": F.coalesce(
            F.try_subtract(F.col("end_ns"), F.col("start_ns")) / 1_000_000.0, F.lit(0.0)
        ),
        "ingested_at": _arrival(ingested_at),
    }
    for column, largest in COUNT_ATTRIBUTES.values():
        typed[column] = S.whole_or_zero(F.col(column), largest)
    for column in MEASURE_ATTRIBUTES.values():
        typed[column] = S.float_or_zero(F.col(column))
    return named.select(
        *[typed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SPANS], *dead
    )


def decode_messages(
    messages: DataFrame, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """Spans and dead letters in one pass: the span columns, and ``dead``, null for a span.

    Meant to be persisted before it is taken apart: a filter on ``dead`` would
    otherwise be pushed below the parser and parse once more.
    """
    parsed = parse_messages(messages).select(
        F.when(~F.col("readable"), _dead(ingested_at)).alias("dead"), "resources"
    )
    return _decode(parsed, ingested_at)


def spans_of(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("dead").isNull()).drop("dead")


def dead_letters_of(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("dead").isNotNull()).select("dead.*")


def decode_spans(
    messages: DataFrame, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """All spans of all readable messages, in the schema of the raw table."""
    return _decode(parse_messages(messages).select("resources"), ingested_at)


def dead_letters(
    messages: DataFrame, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """Messages that hold no JSON object."""
    unreadable = parse_messages(messages).filter(~F.col("readable"))
    return unreadable.select(_dead(ingested_at).alias("dead")).select("dead.*")
