"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
# these run jobs of their own while the query is built
EAGER = {"forecast_gbt", "feature_importance", "kmeans_profiles", "stream_raw_to_clean", "stream_curated",
         "compaction_preserves_rows", "compaction_live", "stream_exact_clean", "stream_fanout_counts", "schema_promotion", "sorted_lookup", "write_integrity", "mixed_source_union", "csv_roundtrip", "format_sizes"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_and_no_pair_products(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEval", "ArrowEval", "MapInPandas", "FlatMapGroups"):
        assert node not in text, f"{name}: {node}"


@pytest.mark.parametrize("name", ["latest_per_key", "latest_state_enriched", "dedup_keep_first", "gauge_latest"])
def test_newest_rows_are_limited_before_the_exchange(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    text = plan(QUERIES["tension_bands"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    assert "l_comment" not in text


def test_filters_reach_the_scan(spark, sf_dir):
    assert "GreaterThanOrEqual(p_size,1)" in plan(QUERIES["valid_range_filter"](spark, sf_dir))
    assert "In(event_type, [purchase,signup])" in plan(QUERIES["gauge_ratio"](spark, sf_dir))


def test_large_sides_are_not_broadcast_by_hint(spark, sf_dir):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("latest_state_enriched", "lag_features", "star_projection", "fk_orphans", "alert_episodes"):
            assert "BroadcastHashJoin" not in plan(QUERIES[name](spark, sf_dir)), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
