"""Registered queries: vectors, pairwise statistics, clustering."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.operators import cells as CE
from eventlens.operators import cluster as CL
from eventlens.operators import forest as FO
from eventlens.operators import vectors as V
from eventlens.session import cut_lineage
from eventlens.sources import fixtures as FX

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(c, name=None):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


W = FX.with_views(FX.SQL_VECTORS)
SQL_NORM = """v_norm AS (SELECT id, label, list_transform(CAST(vec AS DOUBLE[]), lambda x: x / sqrt(list_sum(list_transform(CAST(vec AS DOUBLE[]), lambda y: y * y)))) AS nv FROM v_vectors)"""
SQL_PAIRS = """v_d AS (SELECT a.id, b.id AS nbr, a.label, b.label AS nbr_label,
  list_distance(CAST(a.vec AS DOUBLE[]), CAST(b.vec AS DOUBLE[])) AS dist FROM v_vectors a JOIN v_vectors b ON a.id <> b.id)"""


def vectors(spark, d):
    return FX.vectors(spark, d)


@register("vec_l2_normalize", FX.with_views(FX.SQL_VECTORS, SQL_NORM) + """SELECT id, CAST(len(nv) AS INTEGER) AS dim,
  round(sqrt(list_sum(list_transform(nv, lambda x: x * x))), 6) AS norm, round(nv[1], 6) AS v1 FROM v_norm""")
def q_vec_l2_normalize(spark, d):
    v = vectors(spark, d).select("id", V.l2_normalize("vec").alias("nv"))
    return v.select("id", F.size("nv").alias("dim"), r6(V.l2_norm("nv"), "norm"),
                    r6(F.col("nv")[0].cast("double"), "v1"))


@register("vec_norm_check", W + """SELECT round(avg(n), 6) AS mean_norm, round(min(n), 6) AS min_norm,
  round(max(n), 6) AS max_norm, count(*) AS n FROM (SELECT sqrt(list_sum(list_transform(CAST(vec AS DOUBLE[]), lambda y: y * y))) AS n FROM v_vectors)""")
def q_vec_norm_check(spark, d):
    c = V.norm_check(vectors(spark, d))
    return c.select(r6("mean_norm"), r6("min_norm"), r6("max_norm"), "n")


@register("vec_pair_distance", FX.with_views(FX.SQL_VECTORS, SQL_PAIRS) + """SELECT id, nbr, round(dist, 6) AS dist,
  CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rank FROM v_d) WHERE rank <= 5""")
def q_vec_pair_distance(spark, d):
    k = V.knn(vectors(spark, d), 5)
    return k.select("id", "nbr", r6("dist"), "rank")


@register("vec_cell_knn")
def q_vec_cell_knn(spark, d):
    """Neighbours by the cell index; ``sample_recall`` is what the probes alone reached on the sample queries."""
    v = vectors(spark, d).select("id", "vec")
    model = CE.fit_cells(v, 5)
    return CE.cell_knn(v, 5, model).select("id", "nbr", r6("dist"), "rank", F.lit(model.recall).alias("sample_recall"))


@register("vec_cell_recall")
def q_vec_cell_recall(spark, d):
    """Share of the true five neighbours of every vector that the cell index finds."""
    v = vectors(spark, d).select("id", "vec")
    found = CE.cell_knn(v, 5, CE.fit_cells(v, 5))
    return CE.knn_recall(found, V.knn(v, 5)).select("n_true", r6("recall"), (F.col("recall") >= 0.95).alias("reached"))


SQL_CORE = """v_core AS (SELECT id, dist AS core FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rk FROM v_d) WHERE rk = 2)"""


@register("clu_core_distance", FX.with_views(FX.SQL_VECTORS, SQL_PAIRS, SQL_CORE) + "SELECT id, round(core, 6) AS core FROM v_core")
def q_clu_core_distance(spark, d):
    return CL.core_distances(vectors(spark, d), 2).select("id", r6("core"))


@register("clu_mutual_reach", FX.with_views(FX.SQL_VECTORS, SQL_PAIRS, SQL_CORE) + """
SELECT d.id, d.nbr, round(greatest(a.core, b.core, d.dist), 6) AS mreach
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rk FROM v_d) d
JOIN v_core a ON a.id = d.id JOIN v_core b ON b.id = d.nbr WHERE d.rk <= 2""")
def q_clu_mutual_reach(spark, d):
    nn = cut_lineage(V.knn(vectors(spark, d), 2))  # one search gives cores and neighbours
    core = CL.core_of(nn, 2)
    j = (nn.join(core, "id").join(core.select(F.col("id").alias("nbr"), F.col("core").alias("core_b")), "nbr"))
    return j.select("id", "nbr", r6(F.greatest("core", "core_b", "dist"), "mreach"))


SQL_SIL = """v_s AS (SELECT id, label, nbr_label, sum(dist) AS s, count(*) AS c FROM v_d
  WHERE label <> -1 AND nbr_label <> -1 GROUP BY 1, 2, 3),
v_own AS (SELECT id, label, count(*) FILTER (WHERE true) AS x FROM v_vectors WHERE label <> -1 GROUP BY 1, 2),
v_sz AS (SELECT label, count(*) AS n FROM v_vectors WHERE label <> -1 GROUP BY 1),
v_pt AS (SELECT o.id, z.n AS n_own, (SELECT s / c FROM v_s WHERE v_s.id = o.id AND v_s.nbr_label = o.label) AS a,
  (SELECT min(s / c) FROM v_s WHERE v_s.id = o.id AND v_s.nbr_label <> o.label) AS b FROM v_own o JOIN v_sz z USING (label)),
v_sil AS (SELECT CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS sv FROM v_pt)"""


@register("clu_silhouette", FX.with_views(FX.SQL_VECTORS, SQL_PAIRS, SQL_SIL) + """
SELECT round(CASE WHEN (SELECT count(DISTINCT label) FROM v_vectors WHERE label <> -1) >= 2 THEN avg(sv) END, 6) AS silhouette FROM v_sil""")
def q_clu_silhouette(spark, d):
    return V.silhouette(vectors(spark, d)).select(r6("silhouette"))


@register("clu_kmeans")
def q_clu_kmeans(spark, d):
    labels, _cost = V.kmeans_labels(vectors(spark, d), k=20)
    return labels


MCS_SWEEP = (2, 3, 5)


def cell_neighbours(v, k):
    """Neighbours by the cell index, written once."""
    return cut_lineage(CE.cell_knn(v, k, CE.fit_cells(v, k)))


NEIGHBOURS = 15


def sql_tree(edges: str, nodes: str) -> str:
    """Minimum spanning forest of ``v_e (u, v, w)``: edges no heavier than the lightest worst edge of any other path.

    Edges are numbered by (w, u, v); nine squarings of the path closure cover paths of up to 512 edges.
    """
    steps = "".join(f""",
v_b{i + 1} AS MATERIALIZED (SELECT a.u, b.v, min(greatest(a.r, b.r)) AS r FROM v_b{i} a JOIN v_b{i} b ON a.v = b.u GROUP BY 1, 2)""" for i in range(9))
    return f"""v_e AS ({edges}),
v_r AS MATERIALIZED (SELECT u, v, w, CAST(row_number() OVER (ORDER BY w, u, v) AS INTEGER) AS r FROM v_e),
v_b0 AS MATERIALIZED (SELECT u, v, r FROM v_r UNION ALL SELECT v, u, r FROM v_r UNION ALL SELECT id, id, 0 FROM ({nodes})){steps}
SELECT e.u, e.v, round(e.w, 6) AS w FROM v_r e JOIN v_b9 b ON b.u = e.u AND b.v = e.v WHERE b.r = e.r"""


SQL_EXACT = """v_core2 AS MATERIALIZED (SELECT id, dist AS core FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rk FROM v_d) WHERE rk = 2)"""
SQL_NEAR = f"""v_near AS MATERIALIZED (SELECT id, nbr, dist, rk FROM (SELECT id, nbr, dist, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rk FROM v_d)
  WHERE rk <= {NEIGHBOURS}),
v_core2 AS MATERIALIZED (SELECT id, dist AS core FROM v_near WHERE rk = 2)"""


@register("clu_mst", FX.with_views(FX.SQL_VECTORS, SQL_PAIRS, SQL_EXACT) + ", " + sql_tree(
    "SELECT d.id AS u, d.nbr AS v, greatest(a.core, b.core, d.dist) AS w FROM v_d d JOIN v_core2 a ON a.id = d.id JOIN v_core2 b ON b.id = d.nbr WHERE d.id < d.nbr",
    "SELECT id FROM v_vectors"))
def q_clu_mst(spark, d):
    v = vectors(spark, d).select("id", "vec")
    pts = v.join(CL.core_distances(v, 2), "id")
    return CL.boruvka_mst(pts).select("u", "v", r6("w"))


@register("clu_forest", FX.with_views(FX.SQL_VECTORS, SQL_PAIRS, SQL_NEAR) + ", " + sql_tree(
    """SELECT least(n.id, n.nbr) AS u, greatest(n.id, n.nbr) AS v, min(greatest(a.core, b.core, n.dist)) AS w
    FROM v_near n JOIN v_core2 a ON a.id = n.id JOIN v_core2 b ON b.id = n.nbr GROUP BY 1, 2""", "SELECT id FROM v_vectors"))
def q_clu_forest(spark, d):
    """Spanning forest of the graph of each vector's 15 nearest neighbours: rounds read the edge table alone."""
    v = vectors(spark, d).select("id", "vec")
    return FO.spanning_forest(FO.reachability_edges(V.knn(v, NEIGHBOURS), 2)).select("u", "v", r6("w"))


@register("clu_forest_cells")
def q_clu_forest_cells(spark, d):
    """The same forest over neighbours that the cell index finds: leaves that can hold none of them are not compared."""
    v = vectors(spark, d).select("id", "vec")
    found = CE.cell_knn(v, NEIGHBOURS, CE.fit_cells(v, NEIGHBOURS))
    return FO.spanning_forest(FO.reachability_edges(found, 2)).select("u", "v", r6("w"))


@register("clu_hdbscan")
def q_clu_hdbscan(spark, d):
    v = vectors(spark, d).select("id", "vec")
    return CL.hdbscan_labels(v, 5, neighbours=cell_neighbours(v, NEIGHBOURS))


def sweep(spark, d):
    v = cut_lineage(vectors(spark, d).select("id", "vec"))
    n = v.count()
    # one search serves every min_cluster_size of the sweep
    nn = cell_neighbours(v, NEIGHBOURS)

    def one(mcs):
        lab = cut_lineage(CL.hdbscan_labels(v, mcs, neighbours=nn))
        rep = CL.cluster_report(lab)
        sil = V.silhouette(lab.join(v, "id"))
        return cut_lineage(rep.join(sil, how="inner", on=F.lit(True)).select(
            F.lit(mcs).alias("min_cluster_size"), "n_clusters", "n_noise",
            F.round(100 * (1 - F.col("n_noise") / F.lit(n)), 1).alias("pct_clustered"),
            F.round("silhouette", 4).alias("silhouette")))

    # Each is a row of many small jobs: they run side by side.
    with ThreadPoolExecutor(max_workers=len(MCS_SWEEP)) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, MCS_SWEEP))


@register("clu_sweep")
def q_clu_sweep(spark, d):
    return sweep(spark, d)


@register("clu_compare")
def q_clu_compare(spark, d):
    s = sweep(spark, d).select(F.concat(F.lit("HDBSCAN (mcs="), F.col("min_cluster_size").cast("string"), F.lit(")"))
                               .alias("method"), "n_clusters", "n_noise", "silhouette")
    v = vectors(spark, d).select("id", "vec")
    km = cut_lineage(V.kmeans_labels(v, k=20)[0])
    rep = CL.cluster_report(km)
    sil = V.silhouette(km.join(v, "id"))
    k = rep.join(sil, how="inner", on=F.lit(True)).select(
        F.lit("K-Means (k=20)").alias("method"), "n_clusters", F.lit(0).cast("bigint").alias("n_noise"),
        F.round("silhouette", 4).alias("silhouette"))
    return s.unionByName(k)


@register("argmax_config")
def q_argmax_config(spark, d):
    return CL.argmax_config(sweep(spark, d), "silhouette", "min_cluster_size")
