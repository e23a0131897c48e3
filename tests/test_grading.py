import pytest
from pyspark.sql import functions as F

from spanloom.operators import grading

RUN = {
    "run_id": "healthy", "baseline_s": 45.0, "burst_s": 60.0, "sample_interval_s": 1.0,
    "generator_spans": 600_000, "generator_target_spans": 600_000, "endpoint_spans": 0,
    "collector_accepted": 600_000, "collector_refused": 0, "collector_sent": 600_000,
    "collector_dropped": 0, "stored_rows": 600_000, "rebalances_before": 5,
    "rebalances_after_baseline": 5, "rebalances_after": 9, "stall_released_at": None,
    "baseline_started_at": 0.0, "baseline_ended_at": 45.0, "burst_started_at": 45.0,
    "burst_ended_at": 105.0,
}
SCHEMA = (
    "run_id string, baseline_s double, burst_s double, sample_interval_s double, "
    "generator_spans long, generator_target_spans long, endpoint_spans long, "
    "collector_accepted long, collector_refused long, collector_sent long, "
    "collector_dropped long, stored_rows long, rebalances_before long, "
    "rebalances_after_baseline long, rebalances_after long, stall_released_at double, "
    "baseline_started_at double, baseline_ended_at double, burst_started_at double, "
    "burst_ended_at double"
)


def samples(run_id="healthy", lag=50_000, reset_at=None):
    rows = []
    for t in range(200):
        counter = t * 100 if reset_at is None or t < reset_at else (t - reset_at) * 100
        rows.append((run_id, float(t), lag if 45 <= t < 105 else 0, 0, counter, t * 100, 0, 0))
    return rows


def probes(run_id="healthy", until=200):
    return [(run_id, float(t), 8.0, True, 1) for t in range(until)]


def frames(spark, runs, sample_rows, probe_rows):
    return (
        spark.createDataFrame([tuple(r[k] for k in RUN) for r in runs], SCHEMA),
        spark.createDataFrame(
            sample_rows,
            "run_id string, t double, total_lag long, max_partition_lag long, accepted long, "
            "sent long, dropped long, queue_size long",
        ),
        spark.createDataFrame(
            probe_rows,
            "run_id string, t double, latency_ms double, ok boolean, spans_emitted long",
        ),
    )


BROKEN = {
    "generator_hit_target": ({"generator_target_spans": 700_000}, {}, {}),
    "load_actually_delivered": ({"collector_accepted": 500_000}, {}, {}),
    "no_counter_reset": ({}, {"reset_at": 120}, {}),
    "sampling_resolution": ({"sample_interval_s": 20.0}, {}, {}),
    "burst_actually_stressed": ({}, {"lag": 4999}, {}),
    "spans_accounted": ({"stored_rows": 580_000}, {}, {}),
    "endpoint_probed_under_load": ({}, {}, {"until": 50}),
    "lag_reader_is_noninvasive": ({"rebalances_after_baseline": 6}, {}, {}),
}


def test_a_healthy_run_passes_and_each_fault_fails_its_own_check(spark):
    runs, sample_rows, probe_rows = [RUN], samples(), probes()
    for name, (changes, sample_changes, probe_changes) in BROKEN.items():
        runs.append({**RUN, **changes, "run_id": name})
        sample_rows += samples(name, **sample_changes)
        probe_rows += probes(name, **probe_changes)
    graded = grading.grade_runs(*frames(spark, runs, sample_rows, probe_rows))
    failed = {}
    for r in graded.collect():
        failed.setdefault(r["run_id"], set())
        if not r["passed"]:
            failed[r["run_id"]].add(r["check"])
    assert failed.pop("healthy") == set()
    assert failed == {name: {name} for name in BROKEN}
    valid = {r["run_id"]: r["valid"] for r in grading.run_validity(graded).collect()}
    assert valid["healthy"] and not any(v for k, v in valid.items() if k != "healthy")


def test_refused_spans_count_as_delivered(spark):
    run = {**RUN, "collector_accepted": 500_000, "collector_refused": 100_000}
    runs, *_ = frames(spark, [run], samples(), probes())
    row = grading.span_accounting(runs).first()
    assert (row["sdk_lost"], row["delivered_share"]) == (0, 1.0)


def test_a_run_without_samples_or_probes_fails_but_is_graded(spark):
    runs, sample_df, probe_df = frames(spark, [RUN], samples("x"), probes("x"))
    graded = grading.grade_runs(runs, sample_df, probe_df)
    failed = {r["check"] for r in graded.filter("not passed").collect()}
    assert failed == {"burst_actually_stressed", "endpoint_probed_under_load"}


def test_recovery_starts_after_burst_and_stall(spark):
    late = {**RUN, "run_id": "late", "stall_released_at": 130.5}
    never = {**RUN, "run_id": "never"}
    rows = samples() + samples("late")
    rows += [(r[0], r[1], 9000, *r[3:]) for r in samples("never")]
    runs, sample_df, _ = frames(spark, [RUN, late, never], rows, probes())
    found = {r["run_id"]: r["recovery_s"] for r in grading.recovery(runs, sample_df).collect()}
    assert found == {"healthy": 0.0, "late": 0.5, "never": None}


def test_probe_latency_takes_the_value_at_its_position(spark):
    probe_rows = [("healthy", 1.0 + i / 100, float(i), i != 5, 1) for i in range(40)]
    runs, _, probe_df = frames(spark, [RUN], samples(), probe_rows)
    found = {r["phase"]: r for r in grading.probe_latency(runs, probe_df).collect()}
    values = sorted(float(i) for i in range(40) if i != 5)
    row = found["baseline"]
    assert (row["n"], row["p50"], row["max"]) == (39, values[int(39 * 0.5)], 39.0)
    assert row["p95"] == values[min(38, int(39 * 0.95))]
    assert found["burst"]["n"] == 0 and found["burst"]["p95"] == 0.0


def test_peak_rate(spark):
    _, sample_df, _ = frames(spark, [RUN], samples(), probes())
    bent = sample_df.withColumn("sent", F.when(F.col("t") >= 50, F.col("sent") + 900).otherwise(
        F.col("sent")))
    assert grading.peak_rate(bent).first()["peak_rate"] == pytest.approx(1000.0)


def test_report_round_trip(spark, folder):
    report = grading.run_report(*frames(spark, [RUN], samples(), probes()))
    grading.write_run_report(report, folder + "/report")
    row = spark.read.json(folder + "/report").first()
    assert row["valid"] is True and row["peak_lag"] == 50_000 and len(row["checks"]) == 8
    assert row["baseline_latency"]["n"] == 45 and row["recovery_s"] == 0.0
