"""The evaluation reports, section by section: the values of the parsed JSON against the SQL of each section's query."""

import json

import pytest

from feedlens.functions import ratings
from feedlens.plans import ORACLE, QUERIES
from tests.conftest import SMOKE

SECTIONS = {
    "clustering_report": {"cluster_statistics": "cluster_size_stats", "size_balance": "cluster_balance",
                          "sentiment_coherence": "sentiment_coherence", "silhouette": "silhouette_exact", "davies_bouldin": "davies_bouldin",
                          "coverage": "cluster_coverage", "interpretability": "insight_success"},
    "mapping_report": {"confidence": "mapping_confidence", "theme_coverage": "theme_coverage", "category_balance": "category_balance",
                       "consistency": "mapping_consistency"},
    "extraction_report": {"success_rate": "success_rate", "cost_summary": "token_cost"},
}
STAGE = {"clustering_report": ("clustering", 6), "mapping_report": ("mapping", 7), "extraction_report": ("extraction", 4)}


@pytest.mark.parametrize("name", sorted(SECTIONS))
def test_report_values(spark, duck, name):
    report = json.loads(QUERIES[name](spark, SMOKE).first()["report"])
    for section, query in SECTIONS[name].items():
        cur = duck.execute(ORACLE[query])
        expected = dict(zip([d[0] for d in cur.description], cur.fetchone()))
        shared = set(expected) & set(report[section])
        assert len(shared) >= min(len(expected), 2), (section, expected, report[section])
        for c in shared:
            got = report[section][c]
            assert got == (pytest.approx(expected[c], abs=1e-5) if isinstance(expected[c], float) else expected[c]), (section, c)
    stage, n = STAGE[name]
    found = [v for s in report.values() for k, v in s.items() if k in ("rating", "tier_rating")]
    verdict = report["overall_assessment"]
    assert verdict["n_ratings"] == n
    if name == "clustering_report":
        found = [report[s]["rating"] for s in ("size_balance", "sentiment_coherence", "silhouette", "davies_bouldin", "coverage", "interpretability")]
    elif name == "mapping_report":
        found.append(ratings.EXCELLENT)  # business logic
        assert [m["rank"] for m in report["sample_mappings"]["mappings"]] == [1, 2, 3, 4, 5]
        assert {"total_cost_usd", "cost_per_cluster", "rating"} <= set(report["cost_efficiency"])
    else:
        found = [report[s]["rating"] for s in ("success_rate", "confidence_scores", "aspects_per_comment", "sentiment_distribution")]
    assert (verdict["n_excellent"], verdict["n_good"]) == (found.count(ratings.EXCELLENT), found.count(ratings.GOOD))
    rules, fallback = ratings.VERDICT_RULES[stage]
    held = [label for label, rule in rules if eval(rule.format(e=verdict["n_excellent"], g=verdict["n_good"]).replace("AND", "and"))]
    assert verdict["verdict"] == (held or [fallback])[0]
