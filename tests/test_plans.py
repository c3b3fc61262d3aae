"""Properties of physical plans that decide how a query scales."""

from __future__ import annotations

import pytest

from pluvia.operators import joins, quality, reshape, stats, temporal
from pluvia.plans import catalog, inputs
from pluvia.session import materialise, scratch_path, scratch_root

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def users(spark):
    return materialise(inputs.event_series(spark, SF_DIR, "user_id"), "users")


def test_series_window_is_one_window_and_one_shuffle(users):
    text = plan(temporal.lag_features(users, ["user_id"]))
    assert text.count("Exchange") == 1 and "SinglePartition" not in text
    assert text.count("+- Window") + text.count("Window [") >= 1 and text.count("windowspecdefinition") == 7


def test_null_drop_is_pushed_to_the_scan(users):
    text = plan(reshape.drop_incomplete(users))
    assert "IsNotNull(precipitation_sum)" in text.split("PushedFilters:")[1]
    assert "PushedFilters: []" in plan(users.na.drop())


def test_only_the_used_columns_are_read(spark):
    text = plan(inputs.daily_series(spark, SF_DIR))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    text = plan(quality.key_violations(inputs.table(spark, SF_DIR, "lineitem"), ["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text and "partial_count" in text


def test_statistics_are_one_pass(users):
    text = plan(stats.describe_numeric(users))
    assert text.count("FileScan") == 1 and "partial_stddev_samp" in text


def test_measured_side_is_broadcast_and_larger_is_not(spark, users):
    stations = inputs.stations(spark, SF_DIR)
    assert "BroadcastHashJoin" in plan(joins.attach_stations(users, stations, ["user_id"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.lookup_join(users, reshape.prefix_columns(stations), ["user_id"], broadcast_bytes=0))
        assert "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_are_not_shuffled_for_the_join(spark):
    """With one key on half the rows, the hot part meets a broadcast and the rest a shuffle."""
    rows = materialise(spark.range(4000).selectExpr("IF(id % 2 = 0, 0, id) AS k", "id"), "rows")
    lookup = materialise(spark.range(4000).selectExpr("id AS k", "repeat('x', 100) AS name"), "lookup")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.lookup_join(rows, lookup, ["k"], broadcast_bytes=10_000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 1 and "Union" in text
    assert text.count("ReadSchema: struct<k:bigint,id:bigint>") == 2  # the rows side, after one grouped count


def test_no_query_plans_a_product_of_two_tables(spark):
    for name in ("station_join", "location_join", "etl_trusted", "dq_orphans", "dq_cascade"):
        text = plan(catalog.QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_blocks_shuffle_no_more_than_their_own_columns(users):
    text = plan(temporal.lag_features_blocked(users, ["user_id"]))
    window = text.split("Window [")[1]
    assert "hashpartitioning(_block" in text and "struct(" not in window


def test_scratch_folder_is_the_one_the_session_names(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    assert root.startswith(named.rstrip("/") if named else "/tmp/run-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        get = staticmethod(lambda key, default: None)

    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session)


def test_window_over_a_bucketed_table_needs_no_shuffle(spark, users):
    from pluvia.sources import sinks

    path = scratch_path(spark, "bucketed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    table = sinks.write_bucketed(users, name, ["user_id"], ["time"], 4, path)
    text = plan(temporal.lag_features(table, ["user_id"]))
    assert "Exchange" not in text and "Window" in text
