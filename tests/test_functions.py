"""Unit tests for scalar column functions: text, bins, JSON, fences, ladders."""

import math

import pytest
from pyspark.sql import functions as F

from feedlens.functions import binning, jsonparse, ratings, text


def one(spark, value, expr_fn, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(expr_fn(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize("s", ["a b  c", "  lead and trail  ", "nbsp split", "sep\x1cinfo\x1fsep",
                               "tab\tnew\nline", "", "   ", "ünïcödé wörds ❤"])
def test_word_count_matches_python_split(spark, s):
    assert one(spark, s, text.word_count) == len(s.split())


@pytest.mark.parametrize("s", ["  x  ", " x ", "\n\tx y\r\n", "x", ""])
def test_strip_matches_python(spark, s):
    assert one(spark, s, text.strip_ws) == s.strip()


def test_normalize_name_reference_vs_word_boundary(spark):
    df = spark.createDataFrame([(" The breathe test ",)], "t string")
    ref, wb = df.select(text.normalize_name("t"), text.normalize_name("t", word_boundary=True)).first()
    assert ref == " breathe test ".strip().lower().replace("the ", "") == "breatest"
    assert wb == "breathe test"


@pytest.mark.parametrize("value,label", [(0, None), (1, "short"), (50, "short"), (51, "medium"), (200, "medium"),
                                         (201, "long"), (10 ** 9, "long"), (-3, None)])
def test_bins_are_right_closed(spark, value, label):
    edges, labels = binning.SAMPLE_BINS
    assert one(spark, value, lambda c: binning.bin_column(c, edges, labels), "t long") == label


@pytest.mark.parametrize("s,expected", [
    ("I love it, works great", "positive"),
    ("terrible and slow, can't log in", "negative"),
    ("Good but crashes", "neutral"),          # 'good' vs 'crash' -> 1:1
    ("GOODGOOD good", "positive"),           # distinct words count once
    ("nothing here", "neutral"),
])
def test_lexicon_polarity(spark, s, expected):
    assert one(spark, s, text.lexicon_polarity) == expected


@pytest.mark.parametrize("raw,ok", [
    ('{"aspects": [{"aspect": "a", "sentiment": "positive", "confidence": 0.9}]}', True),
    ('{"aspects": []} trailing words', False),
    ('[{"aspects": []}]', False),
    ('"just a string"', False),
    ("{}", True),
    ("{},{}", False),
    ('{"aspects": [{"aspect": "a"', False),
    ("", False),
])
def test_strict_parse(spark, raw, ok):
    got = one(spark, raw, lambda c: jsonparse.strict_from_json(c, jsonparse.EXTRACTION_SCHEMA))
    assert (got is not None) == ok


def test_quoted_and_bare_numbers_both_parse(spark):
    df = spark.createDataFrame([('{"aspects": [{"aspect": "a", "confidence": "0.25"}, {"aspect": "b", "confidence": 0.5}]}',)],
                               "t string")
    p = df.select(jsonparse.strict_from_json("t", jsonparse.EXTRACTION_SCHEMA).alias("p"))
    vals = [r[0] for r in p.select(F.explode("p.aspects").alias("a")).select(jsonparse.to_double("a.confidence")).collect()]
    assert vals == [0.25, 0.5]


def _py_fence_a(s):
    s = s.strip()
    if s.startswith("```json"):
        s = s[7:]
    elif s.startswith("```"):
        s = s[3:]
    if s.endswith("```"):
        s = s[:-3]
    return s.strip()


def _py_fence_b(s):
    s = s.strip()
    if s.startswith("```"):
        s = s.split("```")[1]
        if s.startswith("json"):
            s = s[4:]
    return s


FENCED = ["```json\n{\"a\": 1}\n```", "```\n{}\n```", "  {\"a\": 1}  ", "```json{}```", "```", "``````",
          "```json\n{}\n``` and more", "```jsonx{}```", "{}```", "```json ```", "text ``` more ``` end",
          "\n\n```json\n{\"k\": \"```\"}\n```\n"]


@pytest.mark.parametrize("s", FENCED)
def test_fence_variants_match_python(spark, s):
    a, b = spark.createDataFrame([(s,)], "t string").select(jsonparse.strip_fence_a("t"), jsonparse.strip_fence_b("t")).first()
    assert a == _py_fence_a(s)
    assert b == _py_fence_b(s)


# Each ladder at and around its thresholds (table 2.10).
LADDER_CASES = [
    ("extraction_success_rate", 0.9984, None, "EXCELLENT"), ("extraction_success_rate", 0.95, None, "GOOD"),
    ("extraction_success_rate", 0.90, None, "FAIR"), ("extraction_success_rate", 0.80, None, "POOR"),
    ("mean_aspect_confidence", 0.91, None, "EXCELLENT"), ("mean_aspect_confidence", 0.75, None, "FAIR"),
    ("mean_aspects_per_comment", 3.0, None, "EXCELLENT"), ("mean_aspects_per_comment", 5.0, None, "EXCELLENT"),
    ("mean_aspects_per_comment", 2.5, None, "GOOD"), ("mean_aspects_per_comment", 6.0, None, "GOOD"),
    ("mean_aspects_per_comment", 2.49, None, "FAIR"), ("mean_aspects_per_comment", 6.01, None, "FAIR"),
    ("sentiment_balance", 41.27, 56.94, "FAIR"), ("sentiment_balance", 50, 30, "EXCELLENT"),
    ("sentiment_balance", 40, 20, "GOOD"), ("sentiment_balance", 39.9, 30, "POOR"), ("sentiment_balance", 75, 10, "POOR"),
    ("duplicate_pct", 39.08, None, "GOOD"), ("duplicate_pct", 40, None, "GOOD"), ("duplicate_pct", 40.01, None, "EXCELLENT"),
    ("cost_per_comment", 0.001037, None, "EXCELLENT"), ("cost_per_comment", 0.005, None, "GOOD"),
    ("cost_per_comment", 0.02, None, "POOR"),
    ("silhouette", 0.0657, None, "FAIR"), ("silhouette", 0.0, None, "POOR"), ("silhouette", 0.31, None, "GOOD"),
    ("silhouette", 0.51, None, "EXCELLENT"),
    ("davies_bouldin", 3.16, None, "POOR"), ("davies_bouldin", 1.0, None, "GOOD"), ("davies_bouldin", 0.99, None, "EXCELLENT"),
    ("size_ratio", 7.37, None, "GOOD"), ("size_ratio", 5, None, "GOOD"), ("size_ratio", 20, None, "POOR"),
    ("mean_dominant_sentiment_pct", 69.08, None, "FAIR"), ("mean_dominant_sentiment_pct", 80, None, "GOOD"),
    ("cluster_coverage_pct", 100.0, None, "EXCELLENT"), ("cluster_coverage_pct", 63.3, None, "POOR"),
    ("cluster_coverage_pct", 95.5, None, "GOOD"),
    ("interpretability_rate", 1.0, None, "EXCELLENT"), ("interpretability_rate", 0.85, None, "FAIR"),
    ("mean_mapping_confidence", 0.8887, None, "EXCELLENT"),
    ("high_confidence_share_pct", 100.0, None, "EXCELLENT"), ("high_confidence_share_pct", 90.0, None, "EXCELLENT"),
    ("high_confidence_share_pct", 69.9, None, "FAIR"),
    ("theme_coverage", 66.67, 5, "GOOD"), ("theme_coverage", 80, 5, "EXCELLENT"), ("theme_coverage", 80, 4, "GOOD"),
    ("theme_coverage", 39, 5, "POOR"),
    ("category_balance", 42.1, 7.89, "GOOD"), ("category_balance", 49, 11, "EXCELLENT"), ("category_balance", 70, 3, "POOR"),
    ("consistency_score", 0.9, None, "EXCELLENT"), ("consistency_score", 0.5, None, "FAIR"),
    ("cost_per_cluster", 0.00076, None, "EXCELLENT"), ("cost_per_cluster", 0.2, None, "POOR"),
    ("coherence_label", 0.0657, None, "Low"), ("coherence_label", 0.2, None, "Medium"), ("coherence_label", 0.31, None, "High"),
]


def test_ladders(spark):
    rows = [(m, float(x), None if y is None else float(y), exp) for m, x, y, exp in LADDER_CASES]
    df = spark.createDataFrame(rows, "metric string, x double, y double, expected string")
    got = None
    for m in ratings.LADDERS:
        r = ratings.rate(m, "x", "y")
        got = F.when(F.col("metric") == m, r) if got is None else got.when(F.col("metric") == m, r)
    bad = df.withColumn("got", got).where(F.col("got") != F.col("expected")).collect()
    assert not bad, bad


def test_every_ladder_is_covered():
    assert {m for m, *_ in LADDER_CASES} == set(ratings.LADDERS)


def test_seeded_key_is_portable():
    from feedlens.functions.hashing import MODULUS, MULTIPLIER
    assert (12345 % MODULUS * MULTIPLIER + 42) % MODULUS < MODULUS
    assert not math.isnan(MULTIPLIER)
