"""Physical-plan checks: the shapes that keep the queries scalable."""

import pytest

from feedlens.plans import QUERIES
from tests.conftest import SMOKE


def plan(spark, name):
    df = QUERIES[name](spark, SMOKE)
    return df._jdf.queryExecution().executedPlan().toString()


def test_stratified_sample_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(spark, "stratified_sample")


@pytest.mark.parametrize("name", ["cosine_cross", "topk_themes", "primary_theme", "topk_margin", "semantic_mapping"])
def test_theme_scoring_meets_blocks_of_both_sides(spark, name):
    p = plan(spark, name)
    assert "FlatMapCoGroupsInArrow" in p and "from_json" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["confidence_stats", "confidence_boxplot", "cluster_drilldown", "mapping_confidence"])
def test_order_statistics_have_no_value_map(spark, name):
    assert "percentile" not in plan(spark, name)


def test_dedup_aggregates_map_side(spark):
    p = plan(spark, "dedup_keep_best")
    assert "partial_max_by" in p


def test_tfidf_vocabulary_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(spark, "tfidf_top_terms")


@pytest.mark.parametrize("name", ["batch_assign", "budget_cutoff", "cost_ledger"])
def test_ordered_ops_have_no_global_window(spark, name):
    p = plan(spark, name)
    assert "Window" not in p and "SinglePartition" not in p


def test_silhouette_never_materialises_pairs(spark):
    p = plan(spark, "silhouette_exact")
    assert "FlatMapCoGroupsInPandas" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_text_profile_prunes_columns(spark):
    p = plan(spark, "text_profile")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_cluster_prompts_are_chunked(spark):
    df = QUERIES["render_cluster_prompt"](spark, SMOKE)
    assert df.agg({"n_lines": "max"}).first()[0] <= 1000


def test_filters_reach_the_parquet_scan(spark):
    p = spark.read.parquet(f"{SMOKE}/events.parquet").where("event_type = 'error'").select("event_id")
    p = p._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in p and "ReadSchema: struct<event_id:bigint,event_type:string>" in p


def test_every_theme_is_scored(spark):
    from feedlens.plans import fixtures
    fixtures.register(spark, SMOKE)
    assert spark.table("v_theme_vectors").count() == spark.table("v_themes").count() == 25
