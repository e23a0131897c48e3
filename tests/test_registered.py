"""Registered queries against the same question in SQL, in another engine.

A selection runs by default; SPANLOOM_ALL_QUERIES=1 runs all of them.
"""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from registered import oracles as registered_oracles
from registered import queries as registered_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = registered_queries.queries(), registered_oracles.oracle_sql()
QUICK = (
    "s01_message_stream s14_metrics_text s15_offset_lag b05_decoded_spans b02_attribute_map "
    "d01_cardinality_guard d02_unregistered_values e11_exact_quantiles e21_nearest_rank "
    "g02_hour_rollup g10_cardinality_status g12_latency_stats g15_duplication w01_dedup "
    "w03_sort_check w08_peak_rate m09_run_grading q09_ttft_by_model q11_top_tenants_exact "
    "q19_dropped_per_sample q27_bucket_breakdown q31_tenant_shares q34_lake_model_latency "
    "q37_report_top_tenants q43_rollup_agreement q44_user_sql q29_live_headline c01_message_split "
    "c05_lagged_rate d01_repeated_allowlist d05_two_topics j01_two_streams j04_windowed_states "
    "j11_health_samples m04_late_reexport m07_rewrite_after_compaction j07_dedup_stream "
    "c10_indexed_lookup c10_indexed_lookup_hot w01_lake_once j06_feed g07_from_states q26_from_states s02_replay "
    "j11_late_scrapes e07_shared_traces e12_quantile_sketch_accuracy q11_top_tenants s01_offset_gaps j05_lag_margin "
    "q08_ttft_quantiles_streamed q11_top_tenants_streamed q27_bucket_breakdown_streamed q43_rollup_agreement_streamed"
).split()
NAMES = sorted(ORACLES) if os.environ.get("SPANLOOM_ALL_QUERIES") else QUICK


@pytest.fixture(scope="module")
def engine(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, engine, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = engine.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered(df.collect(), df.columns) == ordered(cursor.fetchall(), columns)


def test_every_query_is_covered():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"q17_active_files"}
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and rows[0]["span_count"] >= rows[-1]["span_count"]
