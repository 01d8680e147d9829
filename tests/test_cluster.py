"""Pairwise statistics and density clustering against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlens.operators import cluster as CL
from eventlens.operators import vectors as V


def blobs(seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(scale=10.0, size=(3, 8))
    pts, labels = [], []
    for c in range(3):
        for _ in range(20):
            pts.append(centers[c] + rng.normal(scale=0.05, size=8))
            labels.append(c)
    for _ in range(5):
        pts.append(rng.normal(scale=60.0, size=8))
        labels.append(-1)
    return np.array(pts), np.array(labels)


def to_df(spark, pts, labels=None):
    rows = [(i, [float(x) for x in p], int(labels[i]) if labels is not None else 0) for i, p in enumerate(pts)]
    return spark.createDataFrame(rows, "id long, vec array<double>, label int")


def prim_mst_weight(d):
    n = len(d)
    seen = np.zeros(n, bool)
    best = np.full(n, np.inf)
    best[0] = 0
    total = 0.0
    for _ in range(n):
        i = int(np.argmin(np.where(seen, np.inf, best)))
        total += best[i]
        seen[i] = True
        best = np.minimum(best, d[i])
    return total


def test_knn_and_core(spark):
    pts, _ = blobs()
    df = to_df(spark, pts)
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    core = {r["id"]: r["core"] for r in CL.core_distances(df, 3).collect()}
    want = np.sort(d, axis=1)[:, 2]
    assert all(core[i] == pytest.approx(want[i], rel=1e-9) for i in range(len(pts)))


def test_mst_matches_prim(spark):
    pts, _ = blobs(5)
    df = to_df(spark, pts)
    core = CL.core_distances(df, 3)
    mst = CL.boruvka_mst(df.select("id", "vec").join(core, "id"), blocks=2).collect()
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    cd = {r["id"]: r["core"] for r in core.collect()}
    c = np.array([cd[i] for i in range(len(pts))])
    mr = np.maximum(d, np.maximum(c[:, None], c[None, :]))
    assert len(mst) == len(pts) - 1
    assert sum(r["w"] for r in mst) == pytest.approx(prim_mst_weight(mr), rel=1e-9)


def test_hdbscan_planted_blobs(spark):
    pts, truth = blobs()
    got = {r["id"]: r["label"] for r in CL.hdbscan_labels(to_df(spark, pts).select("id", "vec"), 5).collect()}
    lab = np.array([got[i] for i in range(len(pts))])
    assert set(lab[truth == -1]) == {-1}
    for c in range(3):
        members = lab[truth == c]
        assert len(set(members)) == 1 and members[0] != -1
    assert len(set(lab[truth >= 0])) == 3


def test_silhouette_brute(spark):
    pts, truth = blobs()
    got = V.silhouette(to_df(spark, pts, truth)).first()["silhouette"]
    m = truth != -1
    p, lab = pts[m], truth[m]
    d = np.sqrt(((p[:, None, :] - p[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(p)):
        own = lab == lab[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == o].mean() for o in set(lab) if o != lab[i])
        s.append((b - a) / max(a, b))
    assert got == pytest.approx(float(np.mean(s)), rel=1e-9)


def test_silhouette_single_cluster_null(spark):
    pts, _ = blobs()
    assert V.silhouette(to_df(spark, pts, np.zeros(len(pts), int))).first()["silhouette"] is None


def test_kmeans_planted(spark):
    pts, truth = blobs()
    m = truth != -1
    labels, cost = V.kmeans_labels(to_df(spark, pts[m]), k=3, n_init=3)
    got = {r["id"]: r["label"] for r in labels.collect()}
    for c in range(3):
        assert len({got[i] for i in np.where(truth[m] == c)[0]}) == 1
    assert cost < 10


def test_argmax_config_first_wins(spark):
    df = spark.createDataFrame([(2, 0.5), (3, 0.7), (5, 0.7), (7, None)], "mcs int, sil double")
    assert CL.argmax_config(df, "sil", "mcs").first()["mcs"] == 3


def test_best_run_per_stage(spark):
    # literal run history (fixture for the operator only; not a registered query)
    runs = spark.createDataFrame([(2, 1, 0.503, 0.917), (2, 2, 0.497, 0.916), (2, 3, 0.498, 0.917),
                                  (1, 1, 0.70, 0.93), (1, 2, 0.70, 0.94)],
                                 "stage int, epoch int, rougeLsum double, bertscore_f1 double")
    got = {r["stage"]: r["epoch"] for r in CL.best_run(runs, "stage", "rougeLsum").collect()}
    assert got == {2: 1, 1: 1}
