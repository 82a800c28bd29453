"""Physical plans with broadcasts off, as for tables too large to broadcast."""

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
KEYS = [
    "AGG5_lap_stats", "AGG11_exact_and_sketch", "DET1_overtakes", "DET2_battles", "GR7_overtake_edges",
    "GR15_dangling_edges", "GQ8_recent_overtakes", "GQ11_graph_statistics", "JN4_asof_lap",
    "JN10_events_in_laps", "SNK7_edge_upsert", "WIN1_mark_duplicates", "WIN5_stints", "WIN8_zscores",
]


def plan(spark, key):
    return entry.queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key", KEYS)
def test_no_pairwise_join_and_no_python(spark, no_broadcast, key):
    text = plan(spark, key)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in text


def test_top_lists_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(spark, "TOP1_uniform_sample")
    assert "TakeOrderedAndProject" in plan(spark, "TOP4_top_k")


def test_group_limit_runs_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "FLT9_limit_per_session")


def test_scan_reads_only_needed_columns(spark):
    text = plan(spark, "AGG12_out_degree")
    assert "l_suppkey" in text
    assert "l_extendedprice" not in text and "o_totalprice" not in text


def test_payload_is_parsed_once(spark):
    edges = entry.queries()["GR7_overtake_edges"](spark, SF_DIR)
    optimized = edges._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("battle_type") <= 2  # the payload schema appears in one parser call
