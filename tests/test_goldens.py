"""Goldens from the reference's checked-in outputs (G1-G4), read as data from tests/data."""

import json
import os

import pytest
from pyspark.sql import functions as F

from feedlens.functions import ratings
from feedlens.operators import mapping, profile, quality
from feedlens.sources import files
from tests.conftest import DATA


def test_g1_sample_profile(spark):
    """Length, words, lexicon sentiment and bin of the 20 sampled comments (multi-line CSV)."""
    df = files.read_sample_csv(spark, os.path.join(DATA, "sample_20.csv"))
    assert df.count() == 20
    prof = profile.profile_text(df.withColumnRenamed("length", "g_length").withColumnRenamed("word_count", "g_words")
                                .withColumnRenamed("rough_sentiment", "g_sent").withColumnRenamed("length_bin", "g_bin"),
                                "comment")
    bad = prof.where((F.col("length") != F.col("g_length")) | (F.col("word_count") != F.col("g_words")) |
                     (F.col("rough_sentiment") != F.col("g_sent")) | (F.col("length_bin") != F.col("g_bin"))).collect()
    assert not bad, [(r["comment"][:40], r["length"], r["g_length"], r["word_count"], r["g_words"]) for r in bad]
    strata = sorted((r["count"] for r in df.groupBy("length_bin", "rough_sentiment").count().collect()), reverse=True)
    assert strata == [3, 3, 3, 3, 3, 3, 2]


@pytest.fixture(scope="module")
def g2_members(spark):
    dist = json.load(open(os.path.join(DATA, "g2_cluster_sentiment.json")))
    rows = [(int(c), s, n) for c, d in dist.items() for s, n in d.items()]
    counts = spark.createDataFrame(rows, "cluster_id int, sentiment string, n int")
    return counts.select("cluster_id", "sentiment", F.explode(F.array_repeat(F.lit(1), F.col("n"))).alias("_"))


def test_g2_cluster_statistics(g2_members):
    sizes = quality.cluster_sizes(g2_members)
    st = quality.size_stats(sizes).first()
    assert (st["num_clusters"], st["min_size"], st["max_size"], st["mean_size"], st["median_size"]) == \
        (38, 102, 752, 254.5, 213.0)
    bal = quality.size_balance(sizes).first()
    assert bal["range_ratio"] == pytest.approx(7.372549019607843, rel=1e-9)
    assert bal["coefficient_variation"] == pytest.approx(0.5205795166838574, rel=1e-9)
    legacy = {r["cluster_id"]: r["size_legacy"] for r in quality.legacy_size_pairing(sizes).collect()}
    true = {r["cluster_id"]: r["size"] for r in sizes.collect()}
    assert [legacy[i] for i in range(5)] == [102, 111, 118, 137, 137]
    assert legacy[37] == 752 and true[36] == 752  # the reference's mis-pairing (Q6)


def test_g2_sentiment_coherence(g2_members):
    c = quality.sentiment_coherence(g2_members).first()
    assert c["mean_dominant_pct"] == pytest.approx(69.07509073195283, rel=1e-9)
    assert (c["clusters_gt_70"], c["clusters_gt_80"], c["total_clusters"]) == (14, 8, 38)
    top = [r["label"] for r in quality.top_coherent(g2_members, 5).orderBy("rank").collect()]
    assert top == ["Cluster 31: 97% dominant", "Cluster 15: 94% dominant", "Cluster 12: 92% dominant",
                   "Cluster 26: 88% dominant", "Cluster 17: 88% dominant"]


@pytest.fixture(scope="module")
def g3(spark):
    m = spark.createDataFrame(json.load(open(os.path.join(DATA, "g3_mappings.json"))),
                              "cluster_id int, primary_theme string, primary_category string, "
                              "primary_confidence double, status string")
    themes = files.read_themes(spark, os.path.join(DATA, "themes.json"))
    return m, themes


def test_g3_themes_file(g3):
    _, themes = g3
    rows = themes.orderBy("theme_pos").collect()
    assert len(rows) == 15 and rows[0]["theme"] == "Account Access" and rows[-1]["theme"] == "Pricing & Fees"
    assert [r["theme_pos"] for r in rows] == list(range(15))


def test_g3_distribution_and_confidence(g3):
    m, themes = g3
    usage = {r["theme"]: r["n"] for r in mapping.theme_usage(m).collect()}
    assert usage == {"App Performance": 9, "Trust & Security": 6, "Core Banking Features": 4, "Navigation & Design": 4,
                     "Account Access": 4, "Updates & Versions": 3, "Response Time": 3, "General Satisfaction": 2,
                     "Cards & Payments": 2, "Pricing & Fees": 1}
    cats = {r["category"]: r["n"] for r in mapping.category_usage(m).collect()}
    assert cats == {"Online Experience": 16, "Company & Brand": 9, "Account Management": 6, "Product & Features": 4,
                    "Customer Service": 3}
    c = mapping.confidence_report(m).first()
    assert c["mean"] == pytest.approx(0.8886842105263159, rel=1e-9)
    assert c["median"] == pytest.approx(0.92) and c["std"] == pytest.approx(0.06258346227792548, rel=1e-9)
    assert (c["min"], c["max"], c["high"], c["medium"], c["low"]) == (0.75, 0.98, 38, 0, 0)


def test_g3_coverage_balance_consistency(g3):
    m, themes = g3
    cov = mapping.theme_coverage(m, themes).first()
    assert (cov["themes_used"], cov["themes_total"], cov["categories_used"]) == (10, 15, 5)
    assert cov["coverage_pct"] == pytest.approx(66.66666666666666)
    unused = [(r["theme"], r["category"]) for r in mapping.unused_themes(themes, m).orderBy("theme_pos").collect()]
    assert unused == [("Account Settings", "Account Management"), ("Issue Resolution", "Customer Service"),
                      ("Staff Behaviour", "Customer Service"), ("New Features", "Product & Features"),
                      ("Integrations", "Product & Features")]
    bal = mapping.category_balance(m).first()
    assert bal["max_category_pct"] == pytest.approx(42.10526315789473)
    assert bal["min_category_pct"] == pytest.approx(7.894736842105263)
    assert bal["balance_ratio"] == pytest.approx(5.333333333333333)
    con = mapping.mapping_consistency(m).first()
    assert (con["themes_with_multiple_clusters"], con["total_themes_used"], con["consistency_score"]) == (9, 10, 0.9)
    groups = {}
    for r in mapping.theme_clusters(m).collect():
        groups.setdefault(r["theme"], []).append(r["cluster_id"])
    assert sorted(groups["App Performance"]) == [1, 3, 12, 15, 16, 17, 27, 28, 37]
    assert sorted(groups["Cards & Payments"]) == [14, 19]


def test_g3_sample_mappings(spark, g3):
    m, _ = g3
    ins = spark.createDataFrame([(0, "Fees")], "cluster_id int, cluster_name string")
    s = mapping.sample_mappings(m, ins, 5).orderBy("rank").collect()
    assert [r["cluster_id"] for r in s] == [0, 2, 3, 17, 18]
    assert s[0]["cluster_name"] == "Fees" and s[1]["cluster_name"] == "N/A"


def test_g4_verdicts(spark):
    """Sub-ratings of the three published evaluations -> their overall verdicts."""
    sub = [("extraction", q) for q in ("EXCELLENT", "EXCELLENT", "EXCELLENT", "FAIR")] + \
          [("clustering", q) for q in ("FAIR", "POOR", "GOOD", "FAIR", "POOR", "EXCELLENT")] + \
          [("mapping", q) for q in ("EXCELLENT", "EXCELLENT", "GOOD", "GOOD", "EXCELLENT", "EXCELLENT", "EXCELLENT")]
    df = spark.createDataFrame([(1, s, q) for s, q in sub], "run int, stage string, rating string")
    got = {r["stage"]: r["verdict"] for r in ratings.overall_verdict(df, ["run"]).collect()}
    assert got == {"extraction": "EXCELLENT", "clustering": "FAIR", "mapping": "GOOD"}


def test_g4_published_metrics_reproduce_sub_ratings(spark):
    """The ladders give the published quality labels for the published metric values."""
    cases = [("extraction_success_rate", 0.9984, None, "EXCELLENT"), ("mean_aspect_confidence", 0.91, None, "EXCELLENT"),
             ("mean_aspects_per_comment", 3.18, None, "EXCELLENT"),
             ("sentiment_balance", 100 * 6552 / 15874, 100 * 9039 / 15874, "FAIR"),
             ("duplicate_pct", 39.08, None, "GOOD"), ("cost_per_comment", 5.1873 / 5000, None, "EXCELLENT"),
             ("silhouette", 0.06573, None, "FAIR"), ("davies_bouldin", 3.16042, None, "POOR"),
             ("size_ratio", 752 / 102, None, "GOOD"), ("mean_dominant_sentiment_pct", 69.075, None, "FAIR"),
             ("cluster_coverage_pct", 100 * 9671 / 15287, None, "POOR"), ("interpretability_rate", 1.0, None, "EXCELLENT"),
             ("mean_mapping_confidence", 0.8887, None, "EXCELLENT"), ("high_confidence_share_pct", 100.0, None, "EXCELLENT"),
             ("theme_coverage", 66.67, 5, "GOOD"), ("category_balance", 42.105, 7.895, "GOOD"),
             ("consistency_score", 0.9, None, "EXCELLENT"), ("cost_per_cluster", 0.029 / 38, None, "EXCELLENT")]
    df = spark.createDataFrame([(m, float(x), None if y is None else float(y), e) for m, x, y, e in cases],
                               "metric string, x double, y double, expected string")
    for m, _, _, e in cases:
        got = df.where(F.col("metric") == m).select(ratings.rate(m, "x", "y")).first()[0]
        assert got == e, (m, got, e)
