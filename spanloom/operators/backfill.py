"""Fill the minute rollup from raw spans that arrived before it existed."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.scalars import instant, minute_of, utc_text
from spanloom.operators.rollup import coverage, rollup_1h, rollup_1m
from spanloom.registry import Registry
from spanloom.sources.tables import TableStore, time_range


def backfill_states(
    spans: DataFrame, allowlist: DataFrame, registry: Registry, start: datetime, end: datetime
) -> DataFrame:
    """Minute states of the spans in ``[start, end)``: the live rollup over a window."""
    if start >= end:
        raise ValueError(f"empty backfill window: {start} >= {end}")
    ranged = (
        time_range(spans, "ts", start, end)
        if "dt" in spans.columns
        else spans.filter((F.col("ts") >= instant(start)) & (F.col("ts") < instant(end)))
    )
    return rollup_1m(ranged, allowlist, registry)


def backfill(
    store: TableStore,
    registry: Registry,
    start: datetime,
    end: datetime,
    allowlist_version: int | None = None,
) -> int:
    """Write the states of a window and return the number of raw spans in it.

    The write carries an id made of the window, so running it again replaces its
    rows instead of adding them a second time. A window in which other writes have
    rows already is refused: its spans would count twice.
    """
    write_id = f"backfill-{start:%Y%m%dT%H%M%S}-{end:%Y%m%dT%H%M%S}"
    own = [write_id, *(snapshot for _, snapshot in store.snapshots_of("spans_1m", write_id))]
    others = store.read("spans_1m", start, end).filter(~F.col("write_id").isin(own))
    if others.limit(1).count():
        raise ValueError(f"the rollup already has rows in [{start}, {end})")
    states = backfill_states(
        store.read("spans_raw"), store.read_allowlist(allowlist_version), registry, start, end
    )
    store.write(states, "spans_1m", write_id)
    written = store.read("spans_1m").filter(F.col("write_id") == write_id)
    store.write(rollup_1h(written), "spans_1h", write_id)
    return written.agg(F.coalesce(F.sum("spans"), F.lit(0))).first()[0]


def backfill_window(store: TableStore) -> tuple[datetime, datetime] | None:
    """From the oldest raw span to the first minute the rollup covers; None when there is no gap."""
    plan = coverage(store.read("spans_raw"), store.read("spans_1m"))
    minutes = ("raw_min", "raw_max", "rollup_min")
    row = plan.select(
        "needs_backfill", *[utc_text(minute_of(F.col(c))).alias(c) for c in minutes]
    ).first()
    if not row["needs_backfill"]:
        return None
    at = {c: datetime.fromisoformat(row[c]) for c in minutes if row[c]}
    start = at["raw_min"]
    end = at.get("rollup_min", at["raw_max"] + timedelta(minutes=1))
    return (start, end) if start < end else None
