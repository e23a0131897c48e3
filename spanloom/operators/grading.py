"""Grading of load experiments: was the run valid, how much was lost, how fast was recovery.

Inputs: ``runs`` (one row per run), ``samples`` (counters over time) and
``probes`` (timed requests). Every check is graded per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.ordered import with_previous
from spanloom.functions.quantiles import exact_quantiles
from spanloom.functions.scalars import ratio

# Thresholds set before any run (fixed values).
RECOVERED_LAG = 500
MIN_GENERATOR_SHARE = 0.90
MIN_DELIVERED_SHARE = 0.95
MIN_PEAK_LAG = 5000
MAX_UNACCOUNTED_SHARE = 0.02
MIN_PROBES_PER_PHASE = 10

CHECKS = (
    "generator_hit_target",
    "load_actually_delivered",
    "no_counter_reset",
    "sampling_resolution",
    "burst_actually_stressed",
    "spans_accounted",
    "endpoint_probed_under_load",
    "lag_reader_is_noninvasive",
)

# Length of the slices a long run is cut into before neighbours are compared.
SLICE_S = 600.0


def span_accounting(runs: DataFrame) -> DataFrame:
    """Spans emitted, delivered and lost at each stage of a run."""
    zero = F.lit(0).cast("bigint")
    emitted = F.col("generator_spans") + F.col("endpoint_spans")
    delivered = F.col("collector_accepted") + F.col("collector_refused")
    staged = runs.select(
        "*",
        emitted.alias("emitted_total"),
        delivered.alias("delivered"),
        # A span the collector refused was delivered; what the sender lost was not.
        F.greatest(zero, emitted - delivered).alias("sdk_lost"),
        F.greatest(zero, F.col("collector_sent") - F.col("stored_rows")).alias("unaccounted"),
    )

    def share(top: str, bottom: str) -> Column:
        return F.coalesce(ratio(F.col(top), F.col(bottom)), F.lit(0.0))

    return staged.select(
        "*",
        share("generator_spans", "generator_target_spans").alias("generator_share"),
        share("delivered", "emitted_total").alias("delivered_share"),
        share("unaccounted", "emitted_total").alias("unaccounted_share"),
    )


def _burst() -> tuple[Column, Column]:
    seen = F.col("burst_ended_at") > F.col("burst_started_at")
    return (
        F.when(seen, F.col("burst_started_at")).otherwise(F.col("baseline_s")),
        F.when(seen, F.col("burst_ended_at")).otherwise(F.col("baseline_s") + F.col("burst_s")),
    )


def _baseline() -> tuple[Column, Column]:
    seen = F.col("baseline_ended_at") > F.col("baseline_started_at")
    return (
        F.when(seen, F.col("baseline_started_at")).otherwise(F.lit(0.0)),
        F.when(seen, F.col("baseline_ended_at")).otherwise(F.col("baseline_s")),
    )


def phases(runs: DataFrame) -> DataFrame:
    """The observed baseline and burst of each run; the nominal lengths where none were recorded."""
    pair = F.array(
        *[
            F.struct(F.lit(name).alias("phase"), a.alias("phase_start"), b.alias("phase_end"))
            for name, (a, b) in (("baseline", _baseline()), ("burst", _burst()))
        ]
    )
    return runs.select("run_id", F.explode(pair).alias("p")).select("run_id", "p.*")


def probes_in_phases(runs: DataFrame, probes: DataFrame) -> DataFrame:
    """Successful probes with the phase they fall into: an interval join within a run."""
    t = F.col("t")
    return (
        probes.filter("ok")
        .join(phases(runs), "run_id")
        .filter((t >= F.col("phase_start")) & (t < F.col("phase_end")))
        .select("run_id", "phase", "t", "latency_ms")
    )


def probe_latency(runs: DataFrame, probes: DataFrame) -> DataFrame:
    """Probe count and latency quantiles (value at position n*p) per run and phase."""
    inside = probes_in_phases(runs, probes)
    counted = inside.groupBy("run_id", "phase").agg(
        F.count("*").alias("n"), F.max("latency_ms").alias("max")
    )
    names = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    ranked = exact_quantiles(
        inside, ["run_id", "phase"], F.col("latency_ms"), names, method="nearest"
    )
    zero = F.lit(0.0)
    return (
        phases(runs)
        .select("run_id", "phase")
        .join(counted, ["run_id", "phase"], "left")
        .join(ranked, ["run_id", "phase"], "left")
        .select(
            "run_id",
            "phase",
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
            *[F.coalesce(c, zero).alias(c) for c in (*names, "max")],
        )
    )


def _consecutive(samples: DataFrame, columns: list[str]) -> DataFrame:
    return with_previous(
        samples, "t", columns, F.floor(F.col("t") / SLICE_S), by=["run_id"]
    )


def counter_resets(samples: DataFrame) -> DataFrame:
    """Per run, how often a cumulative counter fell and when it first did."""
    pairs = _consecutive(samples, ["accepted", "sent", "dropped"])
    fell = (
        (F.col("accepted") < F.col("prev_accepted"))
        | (F.col("sent") < F.col("prev_sent"))
        | (F.col("dropped") < F.col("prev_dropped"))
    )
    return pairs.groupBy("run_id").agg(
        F.count_if(fell).alias("resets"), F.min(F.when(fell, F.col("t"))).alias("first_reset_t")
    )


def peak_rate(samples: DataFrame, column: str = "sent") -> DataFrame:
    """Per run, the fastest growth per second between consecutive samples."""
    pairs = _consecutive(samples, ["t", column])
    elapsed = F.col("t") - F.col("prev_t")
    rate = F.when(elapsed > 0, (F.col(column) - F.col(f"prev_{column}")) / elapsed)
    return pairs.groupBy("run_id").agg(
        F.greatest(F.coalesce(F.max(rate), F.lit(0.0)), F.lit(0.0)).alias("peak_rate")
    )


def recovery(runs: DataFrame, samples: DataFrame) -> DataFrame:
    """Seconds from the end of all pressure until the lag is low again; null if it never was."""
    _, burst_end = _burst()
    origin = F.greatest(burst_end, F.coalesce(F.col("stall_released_at"), F.lit(0.0)))
    ends = runs.select("run_id", origin.alias("origin"))
    calm = samples.filter(F.col("total_lag") <= RECOVERED_LAG).join(ends, "run_id")
    first = (
        calm.filter(F.col("t") >= F.col("origin"))
        .groupBy("run_id")
        .agg(F.min(F.col("t") - F.col("origin")).alias("recovery_s"))
    )
    return ends.select("run_id").join(first, "run_id", "left")


def grade_runs(runs: DataFrame, samples: DataFrame, probes: DataFrame) -> DataFrame:
    """One row per run and check: ``(run_id, check, passed, detail)``."""
    peaks = samples.groupBy("run_id").agg(F.max("total_lag").alias("peak_lag"))
    probed = (
        probes_in_phases(runs, probes)
        .groupBy("run_id")
        .agg(
            F.count_if(F.col("phase") == "baseline").alias("baseline_probes"),
            F.count_if(F.col("phase") == "burst").alias("burst_probes"),
        )
    )
    facts = (
        span_accounting(runs)
        .join(peaks, "run_id", "left")
        .join(probed, "run_id", "left")
        .join(counter_resets(samples), "run_id", "left")
        .fillna(0, ["peak_lag", "baseline_probes", "burst_probes", "resets"])
    )
    c = F.col
    graded = {
        "generator_hit_target": (
            c("generator_share") >= MIN_GENERATOR_SHARE,
            F.format_string(
                "generated %d of %d spans", c("generator_spans"), c("generator_target_spans")
            ),
        ),
        "load_actually_delivered": (
            c("delivered_share") >= MIN_DELIVERED_SHARE,
            F.format_string("delivered %d of %d spans", c("delivered"), c("emitted_total")),
        ),
        "no_counter_reset": (
            c("resets") == 0,
            F.format_string("%d counter resets", c("resets")),
        ),
        "sampling_resolution": (
            c("sample_interval_s") <= c("burst_s") / 4,
            F.format_string(
                "sampled every %.1f s in a burst of %.1f s", c("sample_interval_s"), c("burst_s")
            ),
        ),
        "burst_actually_stressed": (
            c("peak_lag") >= MIN_PEAK_LAG,
            F.format_string("peak lag %d messages", c("peak_lag")),
        ),
        "spans_accounted": (
            c("unaccounted_share") <= MAX_UNACCOUNTED_SHARE,
            F.format_string(
                "%d of %d spans unaccounted", c("unaccounted"), c("emitted_total")
            ),
        ),
        "endpoint_probed_under_load": (
            (c("baseline_probes") >= MIN_PROBES_PER_PHASE)
            & (c("burst_probes") >= MIN_PROBES_PER_PHASE),
            F.format_string(
                "%d baseline probes, %d burst probes", c("baseline_probes"), c("burst_probes")
            ),
        ),
        "lag_reader_is_noninvasive": (
            c("rebalances_after_baseline") == c("rebalances_before"),
            F.format_string(
                "rebalances %d before, %d after the baseline",
                c("rebalances_before"),
                c("rebalances_after_baseline"),
            ),
        ),
    }
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"),
                graded[name][0].alias("passed"),
                graded[name][1].alias("detail"),
            )
            for name in CHECKS
        ]
    )
    return facts.select("run_id", F.explode(rows).alias("r")).select("run_id", "r.*")


def run_validity(graded: DataFrame) -> DataFrame:
    """A run is valid when every check passed."""
    return graded.groupBy("run_id").agg(
        F.bool_and("passed").alias("valid"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )


def run_report(runs: DataFrame, samples: DataFrame, probes: DataFrame) -> DataFrame:
    """One nested row per run with its derived values and checks, ready for ``write.json``."""
    graded = grade_runs(runs, samples, probes)
    checks = graded.groupBy("run_id").agg(
        F.bool_and("passed").alias("valid"),
        # Eight checks per run.
        F.sort_array(F.collect_list(F.struct("check", "passed", "detail"))).alias("checks"),
    )
    latency = (
        probe_latency(runs, probes)
        .groupBy("run_id")
        .agg(
            *[
                F.max(F.when(F.col("phase") == p, F.struct("n", "p50", "p95", "p99", "max"))).alias(
                    f"{p}_latency"
                )
                for p in ("baseline", "burst")
            ]
        )
    )
    peaks = samples.groupBy("run_id").agg(F.max("total_lag").alias("peak_lag"))
    return (
        span_accounting(runs)
        .join(peaks, "run_id", "left")
        .join(recovery(runs, samples), "run_id", "left")
        .join(latency, "run_id", "left")
        .join(checks, "run_id", "left")
    )


def write_run_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)
