"""Total scalar conversions and small expressions used across the operators."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aware_utc(value: datetime) -> datetime:
    """A naive value is taken as UTC, so that no machine's time zone is applied."""
    return value.replace(tzinfo=UTC) if value.tzinfo is None else value.astimezone(UTC)


def instant(value: datetime | Column) -> Column:
    """A point in time as a column."""
    return value if isinstance(value, Column) else F.lit(aware_utc(value))


def single_row(df: DataFrame) -> Column:
    """A one-row frame as a struct to take columns from: a scalar subquery, not a join."""
    return df.select(F.struct("*")).scalar()


def utc_text(ts: Column) -> Column:
    """A timestamp as ISO text in the session's zone (UTC), whole seconds."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def whole_or_zero(text: Column, largest: int) -> Column:
    """Digits within range as a long, anything else 0.

    A plain cast would trim blanks and take signs, so the digits are checked
    first. What a long cannot hold is null after the cast.
    """
    number = text.try_cast("bigint")
    return F.when(text.rlike("^[0-9]+$") & (number <= largest), number).otherwise(
        F.lit(0).cast("bigint")
    )


def float_or_zero(text: Column) -> Column:
    """A finite 32-bit float; 0 for anything else, for NaN and for blanks around a number.

    NaN counts as above every number in Spark, so letting it through would make
    it look measured and turn every sum it enters into NaN.
    """
    number = text.try_cast("float")
    finite = number.between(F.lit(-3.4028235e38), F.lit(3.4028235e38))
    return F.when(finite & (F.length(text) == F.length(F.trim(text))), number).otherwise(
        F.lit(0.0).cast("float")
    )


def nanos_or_zero(text: Column) -> Column:
    """A nanosecond count, or 0. Signed, since clocks before the epoch are legal."""
    return F.coalesce(
        F.when(text.rlike("^[-+]?[0-9]+$"), text.try_cast("bigint")), F.lit(0).cast("bigint")
    )


def millis_timestamp(nanos: Column) -> Column:
    """Nanoseconds since the epoch as a timestamp cut to milliseconds."""
    return F.timestamp_millis(F.call_function("div", nanos, F.lit(1_000_000).cast("bigint")))


def kind_name(ordinal: Column, names: dict[int, str], default: str = "unspecified") -> Column:
    """Name of a small enum ordinal."""
    out = None
    for key, value in names.items():
        step = F.when(ordinal == key, F.lit(value)) if out is None else out.when(
            ordinal == key, F.lit(value)
        )
        out = step
    return out.otherwise(F.lit(default))


def first_wins_map(entries: Column) -> Column:
    """Array of ``struct(k, v)`` entries to a map, keeping the first of each key.

    ``map_from_entries`` raises on repeated or null keys, which would end a
    stream, so both are removed before it.
    """
    named = F.filter(entries, lambda e: e["k"].isNotNull())
    keys = F.transform(named, lambda e: e["k"])
    unique = F.filter(named, lambda e, i: F.array_position(keys, e["k"]) == i + 1)
    return F.map_from_entries(unique)


def text_of(attributes: Column, key: str) -> Column:
    """A map value, ``''`` when the key is missing."""
    return F.coalesce(F.try_element_at(attributes, F.lit(key)), F.lit(""))


def measured(value: Column) -> Column:
    """The value where it was measured (above 0), null elsewhere."""
    return F.when(value > 0, value.cast("double"))


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields null over zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def ingest_latency_s() -> Column:
    """Seconds from the end of a span to its arrival."""
    waited = F.unix_millis("ingested_at") - F.unix_millis("ts")
    return (waited - F.col("duration_ms").cast("double")) / 1000.0
