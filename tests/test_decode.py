import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spanloom.functions import scalars as S
from spanloom.operators.decode import dead_letters, decode_spans
from spanloom.schema import MESSAGES, SPANS

NOW = datetime(2024, 1, 1, 12)


def attribute(key, **value):
    return {"key": key, "value": value}


def span(**changes):
    base = {
        "traceId": "t",
        "spanId": "s",
        "parentSpanId": "",
        "name": "chat m",
        "kind": 3,
        "startTimeUnixNano": "1704067200123456789",
        "endTimeUnixNano": "1704067201123456789",
        "attributes": [
            attribute("tenant.id", stringValue="tenant-0000"),
            attribute("gen_ai.usage.input_tokens", intValue="420"),
            attribute("llm.kv_cache.utilization", doubleValue=0.45),
            attribute("llm.streaming", boolValue=True),
        ],
    }
    return {**base, **changes}


def message(*spans, resource=None, raw=None):
    if raw is not None:
        return raw
    attributes = [attribute("service.name", stringValue="svc")] if resource is None else resource
    return json.dumps(
        {
            "resourceSpans": [
                {"resource": {"attributes": attributes}, "scopeSpans": [{"spans": list(spans)}]}
            ]
        }
    )


def frame(spark, *values):
    rows = [(v, "otel.spans", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGES)


def decoded(spark, *values):
    return decode_spans(frame(spark, *values), NOW).collect()


def test_a_span_with_every_kind_of_value(spark):
    (row,) = decoded(spark, message(span()))
    assert row["ts"] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert row["duration_ms"] == 1000.0
    assert (row["tenant_id"], row["input_tokens"]) == ("tenant-0000", 420)
    assert row["kv_cache_utilization"] == pytest.approx(0.45)
    assert row["attributes"]["llm.streaming"] == "true"
    assert row["attributes"]["llm.kv_cache.utilization"] == "0.45"
    assert (row["service_name"], row["span_kind"]) == ("svc", "client")
    assert row["model"] == "" and row["ttft_ms"] == 0.0 and row["batch_size"] == 0
    assert row["ingested_at"] == datetime(2024, 1, 1, 12)


def test_schema_and_absence_of_nulls(spark):
    df = decode_spans(frame(spark, message({}), message(span())), NOW)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SPANS]
    assert all(value is not None for row in df.collect() for value in row)


def test_three_levels_flatten(spark):
    nested = json.dumps(
        {
            "resourceSpans": [
                {
                    "resource": {"attributes": [attribute("service.name", stringValue=name)]},
                    "scopeSpans": [
                        {"spans": [span(spanId=f"{name}{scope}{i}") for i in range(2)]}
                        for scope in range(3)
                    ],
                }
                for name in ("a", "b")
            ]
        }
    )
    rows = decoded(spark, nested)
    assert len(rows) == 12
    assert all(row["span_id"].startswith(row["service_name"]) for row in rows)


HOSTILE_SPANS = {
    "a string for a span": "nonsense",
    "attributes are not a list": span(attributes="none"),
    "attributes hold a number": span(attributes=[5, attribute("tenant.id", stringValue="t1")]),
    "null key": span(attributes=[{"key": None, "value": {"stringValue": "x"}}]),
    "no value": span(attributes=[{"key": "tenant.id"}]),
    "unknown value type": span(attributes=[attribute("tenant.id", bytesValue="eA==")]),
    "no start": {k: v for k, v in span().items() if k != "startTimeUnixNano"},
    "start is text": span(startTimeUnixNano="yesterday"),
    "start overflows": span(startTimeUnixNano="9" * 30),
    "start is a fraction": span(startTimeUnixNano="1.5"),
    "span between extremes": span(
        startTimeUnixNano="-9223372036854775808", endTimeUnixNano="9223372036854775807"
    ),
    "kind is text": span(kind="server"),
    "kind is an object": span(kind={"a": 1}),
    "nothing": {},
    "null": None,
}


@pytest.mark.parametrize("name", HOSTILE_SPANS)
def test_a_hostile_span_leaves_its_neighbours_alone(spark, name):
    rows = decoded(spark, message(span(spanId="before"), HOSTILE_SPANS[name], span(spanId="after")))
    found = {row["span_id"] for row in rows}
    assert {"before", "after"} <= found
    good = [row for row in rows if row["span_id"] in ("before", "after")]
    assert all(row["tenant_id"] == "tenant-0000" and row["input_tokens"] == 420 for row in good)
    assert len(rows) == 3
    assert all(value is not None for row in rows for value in row)


def test_mixed_element_types_at_each_level(spark):
    raw = json.dumps(
        {
            "resourceSpans": [
                "text",
                {"scopeSpans": "text"},
                {"resource": 5, "scopeSpans": [7, {"spans": "text"}, {"spans": [span()]}]},
            ]
        }
    )
    (row,) = decoded(spark, raw)
    assert row["span_id"] == "s" and row["service_name"] == ""


def test_repeated_keys_keep_the_first(spark):
    (row,) = decoded(
        spark,
        message(
            span(
                attributes=[
                    attribute("tenant.id", stringValue="first"),
                    attribute("tenant.id", stringValue="second"),
                    {"key": None, "value": {"stringValue": "dropped"}},
                    attribute("http.route", stringValue="/v1/x"),
                ]
            )
        ),
    )
    assert row["tenant_id"] == "first" and row["route"] == "/v1/x"
    assert len(row["attributes"]) == 2


@pytest.mark.parametrize(
    ("kind", "name"),
    [(0, "unspecified"), (1, "internal"), (2, "server"), (3, "client"), (4, "producer"),
     (5, "consumer"), (9, "unspecified")],
)
def test_span_kinds(spark, kind, name):
    assert decoded(spark, message(span(kind=kind)))[0]["span_kind"] == name


def test_time_and_duration(spark):
    (row,) = decoded(spark, message(span(startTimeUnixNano="x")))
    assert row["ts"] == datetime(1970, 1, 1)
    (row,) = decoded(spark, message(span(endTimeUnixNano="1704067200000000000")))
    assert row["duration_ms"] < 0


@pytest.mark.parametrize(
    ("text", "expected"),
    [("420", 420), ("0", 0), ("4294967295", 4294967295), ("4294967296", 0), ("007", 7), ("-1", 0),
     ("+1", 0), ("1.5", 0), (" 12", 0), ("12 ", 0), ("", 0), ("abc", 0), ("9" * 40, 0),
     ("000000000000005", 5)],
)
def test_whole_numbers(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(S.whole_or_zero(F.col("x"), 4294967295)).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("0.5", 0.5), ("-2", -2.0), ("1e3", 1000.0), (" 1", 0.0), ("1 ", 0.0), ("x", 0.0), ("", 0.0),
     ("NaN", 0.0), ("Infinity", 0.0), ("1e99", 0.0), ("3.4028235e38", 3.4028234663852886e38)],
)
def test_floats(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(S.float_or_zero(F.col("x"))).first()[0] == expected


def test_dead_letters(spark):
    good = message(span())
    bad = {
        "truncated": good[:80],
        "empty": "",
        "blank": "  ",
        "null": "null",
        "list": "[1]",
        "text": "hello",
        "long": "{" + "x" * 9000,
    }
    messages = frame(spark, good, "{}", '{"resourceSpans": 5}', None, *bad.values())
    rows = dead_letters(messages, NOW).collect()
    assert len(rows) == len(bad) + 1
    assert {r["error"] for r in rows} == {
        "no payload",
        "empty payload",
        "not a JSON object",
        "malformed JSON",
    }
    assert max(len(r["raw_message"]) for r in rows) == 9001
    assert {r["offset"] for r in rows} == set(range(3, 11))
    assert decode_spans(messages, NOW).count() == 1


def test_messages_are_parsed_once(spark):
    """No filter below the explode may repeat the parser."""
    plan = decode_spans(frame(spark, message(span())), NOW)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json(") == 1
