"""Ward merges, exact ranks, block scoring, the parallel JSON reader and the weighted silhouette against brute force."""

import json

import numpy as np
import pytest

from feedlens.operators import clustering, quality, ranks, similarity, ward
from feedlens.sources import files as sources
from feedlens.sources.json_map import keyed_entries
from tests.test_hierarchy import blobs, frame, pair_distances


# ---------------------------------------------------------------- Ward

def brute_ward(x):
    """The sequential algorithm: the cheapest pair of all, again and again."""
    means, sizes, out = {i: v.copy() for i, v in enumerate(x)}, {i: 1.0 for i in range(len(x))}, []
    while len(means) > 1:
        keys = sorted(means)
        cost, a, b = min((sizes[a] * sizes[b] / (sizes[a] + sizes[b]) * ((means[a] - means[b]) ** 2).sum(), a, b)
                         for i, a in enumerate(keys) for b in keys[i + 1:])
        n = sizes[a] + sizes[b]
        means[a] = (sizes[a] * means[a] + sizes[b] * means[b]) / n
        sizes[a] = n
        del means[b], sizes[b]
        out.append((a, b, cost, n))
    return out


@pytest.mark.parametrize("block,last", [(16, 8), (1000, 1000)])
def test_ward_merges_are_those_of_the_sequential_algorithm(spark, block, last):
    x = np.vstack([blobs([12, 9, 3, 14], spread=0.8, far=4, seed=3)[0], np.random.default_rng(2).normal(size=(8, 3)) * 5])
    got = ward.merges(frame(spark, x), "vec_id", block=block, last=last)
    rows = sorted((r["cost"], r["a"], r["b"], r["size"]) for r in got.collect())
    expected = sorted((c, a, b, n) for a, b, c, n in brute_ward(x))
    assert [r[1:] for r in rows] == [e[1:] for e in expected]
    assert np.allclose([r[0] for r in rows], [e[0] for e in expected])
    assert sum(r[0] for r in rows) == pytest.approx(((x - x.mean(0)) ** 2).sum())


def test_ward_rounds_do_not_grow_with_equal_points_or_chains(spark, monkeypatch):
    copies = np.repeat(np.random.default_rng(4).integers(-200, 200, (2, 3)).astype(float), 40, 0)
    x = np.vstack([copies, np.cumsum(np.arange(40.0, 0, -1))[:, None] * np.ones(3)])
    written, real = [], ward.materialize
    monkeypatch.setattr(ward, "materialize", lambda df, name: (written.append(name), real(df, name))[1])
    got = ward.merges(frame(spark, x), "vec_id", block=16, last=8).collect()
    assert len(written) < 20  # a round for each merge of the copies, or of the chain, wrote several tables
    expected = sorted((a, b, n) for a, b, _, n in brute_ward(x))
    assert sorted((r["a"], r["b"], r["size"]) for r in got) == expected
    assert sum(r["cost"] for r in got) == pytest.approx(((x - x.mean(0)) ** 2).sum())


@pytest.mark.parametrize("kind", ["noise", "lattice", "simplex"])
def test_ward_merges_across_groups_and_beyond_short_lists(spark, monkeypatch, kind):
    grid = np.stack(np.meshgrid(np.arange(5.0), np.arange(4.0)), -1).reshape(-1, 2)
    x = {"noise": np.random.default_rng(8).normal(size=(45, 5)), "lattice": grid, "simplex": np.eye(16)}[kind]
    monkeypatch.setattr(ward, "GROUP_BYTES", 15 * (8 * x.shape[1] + 16 * 3))  # several groups of some 15 clusters
    monkeypatch.setattr(ward, "MATRIX", 1)
    monkeypatch.setattr(ward, "NEAR", 3)
    got = ward.merges(frame(spark, x), "vec_id", block=6, last=8).collect()
    expected = brute_ward(x)
    if kind != "simplex":  # there all costs stay equal but for rounding
        assert sorted((r["a"], r["b"], r["size"]) for r in got) == sorted((a, b, n) for a, b, _, n in expected)
    assert np.allclose(sorted(r["cost"] for r in got), sorted(e[2] for e in expected))
    assert len({r["b"] for r in got}) == len(x) - 1 == len(got)


def test_ward_of_ids_that_repeat_or_are_null(spark):
    x = np.random.default_rng(9).normal(size=(30, 3))
    x[5] = x[4]
    rows = [(None if i == 20 else i // 2, v.tolist()) for i, v in enumerate(x)]
    got = ward.merges(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", block=6, last=4).collect()
    assert len(got) == 29 and sorted(r["cost"] for r in got) == pytest.approx(sorted(e[2] for e in brute_ward(x)))
    assert [(r["a"], r["b"], r["size"]) for r in got if r["cost"] == 0] == [(2, 2, 2.0)]


def test_ward_cut_finds_planted_clusters_and_handles_few_points(spark):
    x, of = blobs([15, 20, 10, 5], spread=0.3, far=10, seed=4)
    got = {r["vec_id"]: r["cluster_id"] for r in ward.ward(frame(spark, x), "vec_id", 4, block=16, last=10).collect()}
    assert len({(got[i], int(of[i])) for i in range(len(x))}) == 4 and len(set(got.values())) == 4
    few = ward.ward(frame(spark, x[:3]), "vec_id", 20).collect()
    assert sorted((r["vec_id"], r["cluster_id"]) for r in few) == [(0, 0), (1, 1), (2, 2)]
    assert ward.ward(spark.createDataFrame([], "vec_id long, v array<double>"), "vec_id").count() == 0


def test_every_method_by_name(spark):
    x, _ = blobs([12, 15, 11], spread=0.2, far=12, seed=6)
    points = frame(spark, x)
    for method, kw in (("kmeans", {"max_clusters": 5, "n_init": 2}), ("density", {"min_cluster_size": 5}), ("hierarchical", {"n_clusters": 3})):
        labelled, meta = clustering.cluster(points, "vec_id", method, **kw)
        row = meta.first()
        assert labelled.count() == len(x) and row["method"] == method and row["n_clusters"] >= 3
        assert (row["silhouette_score"] is None) == (row["noise_points"] > 0)


# ---------------------------------------------------------------- exact ranks

def test_order_statistics_equal_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [(g, float(v), float(w)) for g, n in (("a", 101), ("b", 2), ("c", 1), (None, 40)) for v, w in rng.normal(size=(n, 2)).round(1)]
    rows += [("a", 0.5, None)] * 60 + [("d", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    wanted = {"q1": ("x", 0.25), "med": ("x", 0.5), "q9": ("y", 0.9), "upper": ("x", None)}
    got = {r["g"]: r for r in ranks.order_statistics(df, wanted, ["g"]).collect()}
    assert set(got) == {"a", "b", "c", None}
    for g, r in got.items():
        x = np.array([v for k, v, _ in rows if k == g and v is not None])
        y = np.array([w for k, _, w in rows if k == g and w is not None])
        assert r["q1"] == pytest.approx(np.percentile(x, 25)) and r["med"] == pytest.approx(np.median(x))
        assert r["q9"] == pytest.approx(np.percentile(y, 90)) and r["upper"] == sorted(x)[len(x) // 2]
    whole = ranks.order_statistics(df, {"med": ("x", 0.5)}).first()
    assert whole["med"] == pytest.approx(np.median([v for _, v, _ in rows if v is not None]))
    assert ranks.order_statistics(df.limit(0), {"med": ("x", 0.5)}).first()["med"] is None


# ---------------------------------------------------------------- block scoring

@pytest.mark.parametrize("theme_bytes,item_block", [(16 << 20, 2048), (400, 7)])
def test_ranked_themes_equal_brute_force_with_ties(spark, theme_bytes, item_block):
    rng = np.random.default_rng(1)
    t = rng.normal(size=(40, 5))
    t[17], t[30], t[8] = t[3], t[3], 0            # equal themes and one of norm 0
    x = np.vstack([rng.normal(size=(25, 5)), t[3] * 2, np.zeros(5)])
    themes = spark.createDataFrame([(i, f"t{i}", f"c{i % 3}", v.tolist()) for i, v in enumerate(t)],
                                   "theme_pos int, theme string, category string, v array<double>")
    items = frame(spark, x)
    norm = lambda m: np.sqrt((m * m).sum(1))
    den = norm(x)[:, None] * norm(t)[None, :]
    sims = np.divide(x @ t.T, den, out=np.zeros(den.shape), where=den > 0)
    for k in (3, None):
        got = {r["vec_id"]: r["matches"] for r in similarity.ranked_themes(items, themes, "vec_id", k, item_block=item_block,
                                                                           theme_bytes=theme_bytes).collect()}
        for i in range(len(x)):
            order = sorted(range(40), key=lambda j: (-round(sims[i, j], 12), j))[:k]
            assert [m["theme_pos"] for m in got[i]] == order
            assert np.allclose([m["sim"] for m in got[i]], sims[i, order])


def test_no_theme_no_match(spark):
    themes = spark.createDataFrame([], "theme_pos int, theme string, category string, v array<double>")
    assert similarity.ranked_themes(frame(spark, np.ones((3, 2))), themes, "vec_id", 3).count() == 0


# ---------------------------------------------------------------- one JSON document by byte ranges

DOC = {str(i): {"cluster_name": f'n "{i}", {{x}}: [y]\\', "summary": "a,b" * (i % 7) + "\n é \U0001F600 }", "primary_sentiment": "neutral",
                "key_themes": [f"k{j},}}" for j in range(i % 4)]} for i in range(60)}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", ["97", "1000", "10m"])
def test_one_document_is_read_by_ranges(spark, tmp_path, indent, size):
    path = f"{tmp_path}/doc.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(DOC, f, indent=indent, ensure_ascii=indent is None)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        entries = keyed_entries(spark, path)
        assert json.loads("{" + ",".join(r["text"] for r in entries.orderBy("entry").collect()) + "}") == DOC
        if size == "97":
            assert spark.read.option("lineSep", ",").text(path).rdd.getNumPartitions() > 10
        got = {str(r["cluster_id"]): r for r in sources.read_insights(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert set(got) == set(DOC)
    for k, v in DOC.items():
        assert {c: got[k][c] for c in ("cluster_name", "summary", "primary_sentiment", "key_themes")} == v


def test_field_of_a_document_among_others(spark, tmp_path):
    doc = {"metadata": {"method": "full, {a}", "total_clusters": 2, "successful": 1, "timestamp": "t"},
           "mappings": {str(i): {"cluster_id": i, "primary_theme": f"T{i},", "status": "success", "primary_confidence": 0.5} for i in range(30)},
           "other": {"mappings": {"x": 1}, "y": [1, 2, {"z": 3}]}}
    for name, indent in (("a", None), ("b", 2)):
        with open(f"{tmp_path}/{name}.json", "w") as f:
            json.dump(doc, f, indent=indent)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    try:
        for name in "ab":
            meta, rows = sources.read_mappings(spark, f"{tmp_path}/{name}.json")
            assert sorted((r["cluster_id"], r["primary_theme"]) for r in rows.collect()) == [(i, f"T{i},") for i in range(30)]
            assert tuple(meta.first()) == ("t", "full, {a}", 2, 1)
        empty = f"{tmp_path}/e.json"
        open(empty, "w").write('{"mappings": {}, "metadata": {}}')
        assert sources.read_mappings(spark, empty)[1].count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


# ---------------------------------------------------------------- weighted silhouette

@pytest.mark.parametrize("n", [300, 900, 2400])
def test_weighted_silhouette_is_near_the_exact_one(spark, n):
    sizes = [n // 3, n // 2, n - n // 3 - n // 2 - 12, 12]    # a hot cluster and a small one
    x, of = blobs(sizes, spread=1.5, far=3, seed=n)
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, of))], "vec_id long, v array<double>, cluster_id long")
    d = pair_distances(x)
    sums = np.stack([d[:, of == c].sum(1) for c in range(4)], 1)
    count = np.bincount(of)
    rows = np.arange(len(x))
    a = sums[rows, of] / (count[of] - 1)
    mean = sums / count
    mean[rows, of] = np.inf
    exact = ((mean.min(1) - a) / np.maximum(a, mean.min(1))).mean()
    got = quality.silhouette_sampled(df, "vec_id", epsilon=0.25).first()
    anchors = quality.silhouette_anchors(df, "vec_id", epsilon=0.25).count()
    assert got["n"] == len(x) and abs(got["silhouette_estimate"] - exact) < 0.05
    assert anchors < len(x) or n < 1000
    whole = quality.silhouette_sampled(df, "vec_id", epsilon=0.01).first()["silhouette_estimate"]
    assert whole == pytest.approx(exact, abs=1e-9)
