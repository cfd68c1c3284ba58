"""Neighbour joins, spanning tree, density hierarchy, k sweep and Ward merges against brute force."""

import math

import numpy as np
import pytest

from feedlens.operators import blocks, clustering, hierarchy, kmeans, neighbours


def frame(spark, x, ids=None):
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(range(len(x)) if ids is None else ids, x)], "vec_id long, v array<double>")


def blobs(sizes, spread=0.3, far=10.0, dims=3, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(len(sizes), dims)) * far
    x = np.vstack([c + rng.normal(scale=spread, size=(n, dims)) for c, n in zip(centres, sizes)])
    return x, np.repeat(np.arange(len(sizes)), sizes)


def pair_distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


# ---------------------------------------------------------------- neighbours

CASES = {"blobs": blobs([40, 60, 5, 30])[0], "noise": np.random.default_rng(1).normal(size=(70, 4)),
         "ties": np.repeat(np.arange(12.0)[:, None], 4, 0), "few": np.arange(3.0)[:, None], "one": np.zeros((1, 2))}


@pytest.mark.parametrize("case,block", [("blobs", 8), ("noise", 1000), ("ties", 8), ("few", 8), ("one", 1000)])
def test_nearest_and_radius_are_exact(spark, case, block):
    x = CASES[case]
    cells = neighbours.cells(frame(spark, x), "vec_id", block=block)
    d = pair_distances(x)
    near, _ = neighbours.nearest(cells, 4)
    got = {r["id"]: (r["d"], r["other"]) for r in near.collect()}
    for i in range(len(x)):
        order = sorted((d[i, j], j) for j in range(len(x)) if j != i)[:4]
        assert list(got.get(i, ([], []))[0]) == [p[0] for p in order]
        if case != "ties":
            assert list(got.get(i, ([], []))[1]) == [p[1] for p in order]
    eps = 1.0
    edges, _ = neighbours.within_radius(cells, eps)
    assert sorted((r["a"], r["b"], r["d"]) for r in edges.collect()) == sorted(
        (i, j, d[i, j]) for i in range(len(x)) for j in range(i + 1, len(x)) if d[i, j] <= eps)


def test_clustered_points_are_compared_far_less_than_in_all_pairs(spark):
    x, _ = blobs([60] * 20, spread=0.2, far=20, seed=4)
    cells = neighbours.cells(frame(spark, x), "vec_id", block=100)
    everything = len(x) * (len(x) - 1) / 2
    for _, compared in (neighbours.nearest(cells, 3), neighbours.within_radius(cells, 1.0)):
        n = compared.first()["compared"]
        assert 0 < n < 0.2 * everything


def test_no_points_have_no_neighbours(spark):
    empty = spark.createDataFrame([], "vec_id long, v array<double>")
    assert neighbours.cells(empty, "vec_id") is None
    assert hierarchy.hdbscan(empty, "vec_id").count() == 0


# ---------------------------------------------------------------- density hierarchy

def mutual_reachability(x, min_samples):
    d = pair_distances(x)
    core = np.sort(d + np.where(np.eye(len(x), dtype=bool), np.inf, 0), 1)[:, min_samples - 2] if min_samples > 1 else np.zeros(len(x))
    return np.maximum(np.maximum(d, core[:, None]), core[None, :])


def components(points, linked):
    left, out = set(points), []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            p = todo.pop()
            part.add(p)
            new = {q for q in left if linked[p, q]}
            left -= new
            todo += new
        out.append(part)
    return out


def brute_hdbscan(x, m, min_samples):
    """Top-down: a cluster splits where the edges below its heaviest needed weight no longer hold it together."""
    w = mutual_reachability(x, min_samples)
    lam = lambda t: 1 / max(t, hierarchy.LEAST)
    labels = np.full(len(x), -1)

    def bottleneck(points):
        inside, rest, top = {min(points)}, set(points) - {min(points)}, 0.0
        while rest:
            t, q = min((w[p, q], q) for p in inside for q in rest)
            top = max(top, t)
            inside.add(q)
            rest.remove(q)
        return top

    def grow(points, birth):
        """(stability, clusters below it) of a cluster; follows it down while it only loses points."""
        s, below, points = 0.0, [], set(points)
        everything = set(points)
        while True:
            t = bottleneck(points)
            parts = components(points, w < t)
            big = [c for c in parts if len(c) >= m]
            if len(big) == 1:
                s += (len(points) - len(big[0])) * (lam(t) - birth)
                points = big[0]
                continue
            s += len(points) * (lam(t) - birth)
            below = [grow(c, lam(t)) for c in big]
            return {"points": everything, "s": s, "below": below}

    def select(c):
        best = math.fsum(sorted(select(b) for b in c["below"]))
        c["wins"] = c["s"] >= best
        return c["s"] if c["wins"] else best

    def mark(c):
        if c["wins"]:
            labels[list(c["points"])] = min(c["points"])
        else:
            for b in c["below"]:
                mark(b)
    if len(x) >= max(m, 2):
        root = grow(range(len(x)), 0.0)
        select(root)
        for b in root["below"]:
            mark(b)
    return labels


def kruskal_weights(w):
    order = sorted((w[i, j], i, j) for i in range(len(w)) for j in range(i))
    parent, out = list(range(len(w))), []

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for t, i, j in order:
        if find(i) != find(j):
            parent[find(i)] = find(j)
            out.append(t)
    return out


TREES = {"blobs": blobs([25, 40, 4, 30, 2], seed=2)[0], "near_blobs": blobs([30, 30, 30], spread=1.5, far=3, dims=2, seed=6)[0],
         "doubles": np.repeat(blobs([8, 9], seed=1)[0], 3, 0)}


@pytest.mark.parametrize("case,block,edges", [("blobs", 16, 30), ("near_blobs", 1000, 10**6), ("doubles", 1000, 15)])
def test_density_clusters_are_those_of_the_brute_force_tree(spark, case, block, edges):
    x = TREES[case]
    points = frame(spark, x)
    tree = hierarchy.spanning_tree(points, "vec_id", min_samples=3, block=block).collect()
    w = mutual_reachability(x, 3)
    assert all(r["w"] == w[r["a"], r["b"]] for r in tree)
    linked = np.full((len(x), len(x)), np.inf)
    for r in tree:
        linked[r["a"], r["b"]] = linked[r["b"], r["a"]] = r["w"]
    assert kruskal_weights(linked) == kruskal_weights(w)
    labelled = hierarchy.hdbscan(points, "vec_id", min_cluster_size=3, block=block, edges_per_task=edges)
    expected = brute_hdbscan(x, 3, 3)
    assert [r["cluster_id"] for r in labelled.orderBy("vec_id").collect()] == expected.tolist()
    got = hierarchy.summary(labelled).first()
    assert (got["n_clusters"], got["noise_points"]) == (len(set(expected.tolist()) - {-1}), int((expected == -1).sum()))


def test_planted_clusters_and_noise_are_found(spark):
    x, of = blobs([30, 50, 40], spread=0.2, far=15, seed=8)
    noise = np.random.default_rng(9).uniform(-60, 60, size=(6, 3))
    labelled = hierarchy.hdbscan(frame(spark, np.vstack([x, noise])), "vec_id", min_cluster_size=5)
    got = np.array([r["cluster_id"] for r in labelled.orderBy("vec_id").collect()])
    for c in range(3):
        values, counts = np.unique(got[:len(x)][of == c], return_counts=True)
        assert counts.max() > 0.9 * (of == c).sum() and values[counts.argmax()] >= 0
    assert len(set(got[:len(x)].tolist()) - {-1}) >= 3


# ---------------------------------------------------------------- k sweep

def test_sweep_selects_the_planted_number_of_clusters(spark):
    x, of = blobs([20] * 9, spread=0.3, far=12, seed=5)
    scores, labelled = kmeans.sweep(frame(spark, x), "vec_id", max_clusters=14, n_init=4)
    rows = scores.orderBy("k").collect()
    assert [r["k"] for r in rows] == list(range(3, 15))
    assert [r["k"] for r in rows if r["selected"]] == [9]
    got = {r["vec_id"]: r["cluster_id"] for r in labelled.collect()}
    assert len({(got[i], int(of[i])) for i in range(len(x))}) == 9


def test_sweep_silhouettes_and_costs_are_those_of_its_labels(spark):
    x = np.random.default_rng(11).normal(size=(80, 3))
    packed = kmeans.B.pack_points(frame(spark, x), "vec_id", block=17)
    ks = [3, 5, 8]
    fitted = kmeans.fit_all(packed, ks, n_init=3)
    labelled = kmeans.label_all(packed, {k: c for k, (c, _, _) in fitted.items()})
    own = np.zeros((80, 3), int)
    for r in labelled.collect():
        own[kmeans.B.ids(r["ids"])] = np.frombuffer(r["labels"], np.int32).reshape(r["n"], -1)
    d = pair_distances(x)
    got = {r["k"]: r["silhouette"] for r in kmeans.silhouettes(labelled, ks).collect()}
    for m, k in enumerate(ks):
        centres, cost, _ = fitted[k]
        assert ((x - centres[own[:, m]]) ** 2).sum() == pytest.approx(cost)
        for c in range(k):  # converged: centres are the means of their points, up to the tolerance
            assert np.allclose(centres[c], x[own[:, m] == c].mean(0), atol=0.05)
        s = []
        for i in range(80):
            mean = [d[i, own[:, m] == c].sum() / max(1, (own[:, m] == c).sum() - (c == own[i, m])) for c in range(k)]
            a, b = mean[own[i, m]], min(v for c, v in enumerate(mean) if c != own[i, m])
            s.append((b - a) / max(a, b) if (own[:, m] == own[i, m]).sum() > 1 else 0.0)
        assert got[k] == pytest.approx(np.mean(s), abs=1e-9)


def test_sweep_passes_read_points_once_dealt_evenly_to_the_cores(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(600, 3)) + 50
    packed = kmeans.B.pack_points(frame(spark, x), "vec_id", block=20)
    seen, real = [], kmeans._moved
    monkeypatch.setattr(kmeans, "_moved", lambda points, models: (seen.append(points), real(points, models))[1])
    fitted = kmeans.fit_all(packed, [4, 6], n_init=2)
    assert all(p is seen[0] for p in seen)  # each pass planned a query that read the table and shuffled its sums
    held = seen[0].mapPartitions(lambda ms: [sum(len(m) for m in ms)]).collect()
    assert len(held) == min(spark.sparkContext.defaultParallelism, packed.count()) and sum(held) == 600 and max(held) < 3 * 600 / len(held)
    for centres, cost, _ in fitted.values():
        assert cost == pytest.approx(((x[:, None] - centres[None]) ** 2).sum(-1).min(1).sum(), rel=1e-7)


def test_sweep_of_few_equal_or_no_points(spark):
    assert kmeans.sweep(spark.createDataFrame([], "vec_id long, v array<double>"), "vec_id")[0].count() == 0
    scores, labelled = kmeans.sweep(frame(spark, np.ones((6, 2))), "vec_id")
    assert [r["k"] for r in scores.collect()] == [3] and labelled.count() == 6


def test_sweep_ships_points_not_sums_and_passes_have_several_tasks(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 3))
    packed = kmeans.B.pack_points(frame(spark, x), "vec_id", block=20)
    assert len(packed.inputFiles()) > 8  # files that small were coalesced into one, so one task did every pass
    ks = [3, 5]
    centres = {k: rng.normal(size=(k, 3)) for k in ks}
    scores = kmeans.silhouettes(kmeans.label_all(packed, centres), ks)
    assert "CoGroup" not in scores._jdf.queryExecution().toString()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for r in scores.collect():
        own = ((x[:, None] - centres[r["k"]][None]) ** 2).sum(-1).argmin(1)
        size = np.bincount(own, minlength=r["k"])
        sums = np.stack([d[:, own == c].sum(1) for c in range(r["k"])], 1)
        rows = np.arange(len(x))
        a, mean = sums[rows, own] / (size[own] - 1), sums / size
        mean[rows, own] = np.inf
        s = np.where(size[own] > 1, (mean.min(1) - a) / np.maximum(a, mean.min(1)), 0)
        assert r["silhouette"] == pytest.approx(s.mean(), abs=1e-9)


def test_runs_of_kmeans_move_in_the_same_passes_on_several_tasks(spark):
    x = np.vstack([blobs([200, 150, 180, 120, 90], spread=2.0, far=2.0, dims=4, seed=8)[0], np.zeros((30, 4))])
    table = frame(spark, x).select("v").coalesce(1)  # one file of one row group: every pass of a run was one task's work
    packed = blocks.matrices(table, len(x)).persist()
    assert packed.getNumPartitions() > 1
    assert sorted(map(tuple, np.vstack(packed.collect()))) == sorted(map(tuple, x))
    rng = np.random.default_rng(3)
    starts = {i: x[rng.choice(len(x), 6, replace=False)] for i in range(4)} | {4: np.vstack([x[:3], np.full((1, 4), 1e6)])}
    spark.sparkContext.setJobGroup("lloyd", "")
    got = kmeans.lloyd(packed, starts)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("lloyd")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == max(passes for _, _, passes in got.values())  # each run had jobs of its own
    for i, centres in starts.items():
        passes, moved = 0, np.inf
        while moved > 1e-4:
            d = ((x[:, None] - centres[None]) ** 2).sum(-1)
            own, cost = d.argmin(1), d.min(1).sum()
            new = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
            moved, centres, passes = np.sqrt(((new - centres) ** 2).sum(1)).max(), new, passes + 1
        assert np.allclose(got[i][0], centres) and got[i][1] == pytest.approx(cost) and got[i][2] == passes
    assert {i: (p, c) for i, (_, c, p) in kmeans.lloyd(packed, starts, max_iter=1).items()}.keys() == starts.keys()
    assert all(p == 0 and c is starts[i] for i, (c, _, p) in kmeans.lloyd(packed, starts, max_iter=0).items())
    packed.unpersist()


@pytest.mark.parametrize("parts", [1, 3])
def test_kmeans_fit_is_the_best_of_spark_mls_runs(spark, parts):
    from pyspark.ml.clustering import KMeans
    x = blobs([150, 120, 90, 60], spread=2.5, far=2.0, dims=5, seed=9)[0]
    points = frame(spark, x).repartition(parts, "vec_id").cache()
    fit = clustering.kmeans_fit(points, 5, seed=42, n_init=3)
    feats = clustering._features(points, "v").select("features").cache()
    runs = [KMeans(k=5, seed=42 + i, maxIter=300).fit(feats) for i in range(3)]
    best = min(runs, key=lambda m: m.summary.trainingCost)
    assert np.allclose(fit.clusterCenters(), best.clusterCenters())
    assert fit.summary.trainingCost == pytest.approx(best.summary.trainingCost) and fit.summary.numIter == best.summary.numIter
    labels = [{r["vec_id"]: r["cluster_id"] for r in clustering.assign(m, points).collect()} for m in (fit, best)]
    assert labels[0] == labels[1] and len(labels[0]) == len(x)
    assert clustering.assign(fit, points).dtypes == clustering.assign(best, points).dtypes
    assert clustering.assign(fit, points.limit(0)).count() == 0


@pytest.mark.parametrize("bad", [None, [1.0, float("nan")], [1.0, float("inf")], [1.0, None]])
def test_kmeans_fit_refuses_vectors_that_are_no_points(spark, bad):
    points = spark.createDataFrame([(i, v) for i, v in enumerate([[0.0, 1.0], [5.0, 5.0], [0.0, 1.5], bad])], "vec_id long, v array<double>")
    with pytest.raises(Exception):
        clustering.kmeans_fit(points, 2, n_init=2)
