"""Load-experiment tables made of an event log: one run per day.

The day's events are the emitted spans. Counters are running sums over ten-minute
slices, lag follows the events of a slice, and views are the timed probes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.ordered import with_running_sum

SLICE = 600.0


def _run() -> Column:
    return F.date_format("ts", "yyyy-MM-dd")


def _second() -> Column:
    return F.unix_timestamp("ts") % F.lit(86400)


def runs_from_events(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    n = F.count("*")
    errors = F.count_if((kind == "error") & (F.col("event_id") % 4 == 0))
    return (
        events.groupBy(_run().alias("run_id"))
        .agg(
            n.alias("n"),
            F.count_if(kind == "view").alias("views"),
            errors.alias("errors"),
            F.count_if(F.col("event_id") % 50 == 0).alias("refused"),
            F.day(F.min("ts")).alias("day"),
        )
        .select(
            "run_id",
            F.lit(28800.0).alias("baseline_s"),
            F.lit(28800.0).alias("burst_s"),
            F.when(F.col("day") % 7 == 0, 14400.0).otherwise(600.0).alias("sample_interval_s"),
            (F.col("n") - F.col("views")).alias("generator_spans"),
            F.when(F.col("day") % 5 == 0, F.col("n") * 2)
            .otherwise(F.col("n") - F.col("views"))
            .alias("generator_target_spans"),
            F.col("views").alias("endpoint_spans"),
            (F.col("n") - F.col("errors") - F.col("refused")).alias("collector_accepted"),
            F.col("refused").alias("collector_refused"),
            (F.col("n") - F.col("errors") - F.col("refused")).alias("collector_sent"),
            F.lit(0).cast("bigint").alias("collector_dropped"),
            F.when(
                F.col("day") % 6 == 0, F.col("n") - F.col("errors") - F.col("refused") * 4
            )
            .otherwise(F.col("n") - F.col("errors") - F.col("refused"))
            .alias("stored_rows"),
            F.lit(5).cast("bigint").alias("rebalances_before"),
            F.when(F.col("day") % 9 == 0, 6).otherwise(5).cast("bigint").alias(
                "rebalances_after_baseline"
            ),
            F.lit(9).cast("bigint").alias("rebalances_after"),
            F.when(F.col("day") % 2 == 0, 60000.0).alias("stall_released_at"),
            F.lit(0.0).alias("baseline_started_at"),
            F.when(F.col("day") % 3 == 0, 0.0).otherwise(28000.0).alias("baseline_ended_at"),
            F.lit(28800.0).alias("burst_started_at"),
            F.when(F.col("day") % 3 == 0, 0.0).otherwise(58000.0).alias("burst_ended_at"),
        )
    )


def samples_from_events(events: DataFrame) -> DataFrame:
    t = F.floor(_second() / SLICE) * SLICE
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    slices = events.groupBy(_run().alias("run_id"), t.cast("double").alias("t")).agg(
        F.count("*").alias("a"),
        F.count_if(kind != "error").alias("s"),
        F.count_if((kind == "error") & (F.col("event_id") % 4 == 0)).alias("d"),
        (F.sum(k) * 10).alias("total_lag"),
        F.max(k).alias("max_partition_lag"),
        F.max(k).alias("queue_size"),
    )
    # On every eighth day the counters start again at noon.
    life = F.when(
        (F.col("run_id").substr(9, 2).cast("int") % 8 == 0) & (F.col("t") >= 43200), 1
    ).otherwise(0)
    summed = with_running_sum(
        slices.withColumn("life", life),
        "t",
        ["a", "s", "d"],
        F.floor(F.col("t") / 7200.0),
        by=["run_id", "life"],
    )
    return summed.select(
        "run_id",
        "t",
        "total_lag",
        "max_partition_lag",
        F.col("sum_a").alias("accepted"),
        F.col("sum_s").alias("sent"),
        F.col("sum_d").alias("dropped"),
        "queue_size",
    )


def probes_from_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "view").select(
        _run().alias("run_id"),
        _second().cast("double").alias("t"),
        F.col("value").alias("latency_ms"),
        (F.col("event_id") % 10 != 0).alias("ok"),
        F.lit(1).cast("bigint").alias("spans_emitted"),
    )
