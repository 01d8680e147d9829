"""Registered queries: pre-grouped clusters, live clusters, packing, ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens.operators import clean as C
from eventlens.operators import groups as G
from eventlens.operators import ordering as O
from eventlens.operators import profile as P
from eventlens.plans import sqlparts as S
from eventlens.plans.ingest import SQL_CLEAN, SQL_DEDUP
from eventlens.sources import fixtures as FX

QUERIES = {}
ORACLES = {}

TEST_BUDGET = G.MAX_INPUT_TOKENS  # the configured budget


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _ltrim(x):
    return f"regexp_replace({x}, '^{S.WS}+', '')"


_SUM0 = _ltrim("coalesce(summary, '')")
_SUM1 = _ltrim(f"substr({_SUM0}, 3)")
SQL_PARSED = f"""v_parsed AS (
SELECT conv_id AS cluster_id,
  list_filter(list_transform(string_split(document, '|||||'), lambda a: {S.strip('a')}), lambda a: a <> '') AS articles,
  CASE WHEN starts_with({_SUM0}, '– ') THEN {_SUM1} ELSE {_SUM0} END AS reference_summary
FROM v_groups)"""


def sql_pack(budget: int) -> str:
    return f"""v_x AS (SELECT cluster_id, unnest(articles) AS a, generate_subscripts(articles, 1) AS pos FROM v_parsed),
v_t AS (SELECT cluster_id, pos, a, {S.tokens('a')} AS toks FROM v_x),
v_p AS (SELECT *, len(toks) AS n, coalesce(sum(len(toks)) OVER (PARTITION BY cluster_id ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM v_t WHERE len(toks) > 0),
v_k AS (SELECT cluster_id, pos, CASE WHEN p + n <= {budget} THEN a
        ELSE array_to_string(list_slice(toks, 1, {budget} - p), ' ') END AS piece FROM v_p WHERE p < {budget}),
v_packed AS (SELECT cluster_id, string_agg(piece, chr(10) || chr(10) ORDER BY pos) AS multi_doc_input,
        count(*) AS n_packed FROM v_k GROUP BY cluster_id)"""


W_PARSED = FX.with_views(FX.SQL_GROUPS, SQL_PARSED)


def clusters(spark, d):
    return G.parse_clusters(FX.raw_groups(spark, d))


@register("grp_parse_cluster", W_PARSED + """SELECT cluster_id, CAST(len(articles) AS INTEGER) AS n_articles,
  array_to_string(articles, chr(1)) AS articles, reference_summary FROM v_parsed""")
def q_grp_parse_cluster(spark, d):
    c = clusters(spark, d)
    return c.select("cluster_id", F.size("articles").alias("n_articles"),
                    F.array_join("articles", "\x01").alias("articles"), "reference_summary")


@register("grp_preview", W_PARSED + """SELECT cluster_id,
  array_to_string(list_transform(articles, lambda a: left(a, 120)), chr(1)) AS previews FROM v_parsed""")
def q_grp_preview(spark, d):
    c = clusters(spark, d)
    return c.select("cluster_id", F.array_join(F.transform("articles", lambda a: F.left(a, F.lit(120))), "\x01")
                    .alias("previews"))


SQL_STATS_LONG = f"""v_long AS (
SELECT 'articles_per_cluster' AS measure, CAST(len(articles) AS BIGINT) AS value FROM v_parsed
UNION ALL SELECT 'total_chars_per_cluster', CAST(coalesce(list_sum(list_transform(articles, lambda a: length(a))), 0) AS BIGINT) FROM v_parsed
UNION ALL SELECT 'summary_words_per_cluster', CAST({S.word_count('reference_summary')} AS BIGINT) FROM v_parsed)"""


@register("agg_cluster_stats", FX.with_views(FX.SQL_GROUPS, SQL_PARSED, SQL_STATS_LONG) + """,
r AS (SELECT measure, value, row_number() OVER (PARTITION BY measure ORDER BY value) - 1 AS i,
      count(*) OVER (PARTITION BY measure) AS n FROM v_long)
SELECT measure, min(value) AS min, max(value) AS max, round(avg(value), 1) AS mean,
  max(value) FILTER (WHERE i = n // 2) AS median FROM r GROUP BY measure""")
def q_agg_cluster_stats(spark, d):
    return P.grouped_rank_stats(G.cluster_stats(clusters(spark, d)), "measure", "value")


@register("agg_size_distribution", W_PARSED + """SELECT CAST(len(articles) AS INTEGER) AS n_articles, count(*) AS n
FROM v_parsed GROUP BY 1""")
def q_agg_size_distribution(spark, d):
    c = clusters(spark, d).select(F.size("articles").alias("n_articles"))
    return P.value_distribution(c, "n_articles")


@register("pack_multidoc", FX.with_views(FX.SQL_GROUPS, SQL_PARSED, sql_pack(TEST_BUDGET)) +
          "SELECT cluster_id, multi_doc_input, n_packed FROM v_packed")
def q_pack_multidoc(spark, d):
    c = clusters(spark, d)
    long = c.select("cluster_id", F.posexplode("articles").alias("pos", "text"))
    return G.pack_groups(long, "cluster_id", ["pos"], ["cluster_id", "pos"], "text", TEST_BUDGET)


@register("build_group_inputs", FX.with_views(FX.SQL_GROUPS, SQL_PARSED, sql_pack(1024)) + f"""
SELECT cast(v.cluster_id AS varchar) AS cluster_id, 'multinews' AS source, CAST(len(v.articles) AS INTEGER) AS n_articles,
  coalesce(p.multi_doc_input, '') AS multi_doc_input, v.reference_summary,
  {S.first_sentence('v.reference_summary')} AS reference_headline,
  array_to_string(list_transform(v.articles, lambda a: left(a, 120)), chr(1)) AS source_articles_preview
FROM v_parsed v LEFT JOIN v_packed p USING (cluster_id)""")
def q_build_group_inputs(spark, d):
    g = G.group_inputs(clusters(spark, d), 1024)
    return g.withColumn("source_articles_preview", F.array_join("source_articles_preview", "\x01"))


# ---- live clusters: cleaned articles x vector labels ----------------------------

SQL_LABELLED = """v_labelled AS (
SELECT c.*, v.label FROM (SELECT * FROM v_clean_all WHERE word_count >= 20) c JOIN v_vectors v ON v.id = c.ord)"""
W_LIVE = FX.with_views(FX.SQL_RAW_ARTICLES, SQL_DEDUP, SQL_CLEAN, FX.SQL_VECTORS, SQL_LABELLED)


def labelled(spark, d):
    arts = C.clean_unique(FX.raw_articles(spark, d))
    labels = FX.vectors(spark, d).select("id", "label")
    return G.attach_labels(arts, labels)


@register("join_article_vector", W_LIVE + "SELECT ord, label, word_count FROM v_labelled")
def q_join_article_vector(spark, d):
    return labelled(spark, d).select("ord", "label", "word_count")


@register("rank_by_published", W_LIVE + """SELECT label, ord, CAST(row_number() OVER (PARTITION BY label
  ORDER BY "publishedAt" ASC NULLS LAST, ord) AS INTEGER) AS position FROM v_labelled WHERE label <> -1""")
def q_rank_by_published(spark, d):
    return G.rank_by_published(labelled(spark, d)).select("label", "ord", "position")


@register("grp_articles_by_label", W_LIVE + """SELECT label AS cluster_id, ord,
  CAST(row_number() OVER (PARTITION BY label ORDER BY ord) AS INTEGER) AS member_pos FROM v_labelled WHERE label <> -1""")
def q_grp_articles_by_label(spark, d):
    return G.group_members(labelled(spark, d))


@register("flt_min_cluster", W_LIVE + """SELECT label AS cluster_id, count(*) AS size FROM v_labelled
WHERE label <> -1 GROUP BY label HAVING count(*) >= 2""")
def q_flt_min_cluster(spark, d):
    return G.min_cluster_filter(labelled(spark, d), 2)


@register("topk_cluster_titles", W_LIVE + """, r AS (SELECT label, ord, left(title, 85) AS t,
  row_number() OVER (PARTITION BY label ORDER BY ord) AS rn, count(*) OVER (PARTITION BY label) AS size
  FROM v_labelled WHERE label <> -1)
SELECT label AS cluster_id, size, string_agg(t, chr(10) ORDER BY rn) FILTER (WHERE rn <= 10) AS titles,
  greatest(size - 10, 0) AS more FROM r GROUP BY label, size""")
def q_topk_cluster_titles(spark, d):
    t = G.top_cluster_titles(labelled(spark, d))
    return t.withColumn("titles", F.array_join("titles", "\n"))


def sql_live_pack(budget: int) -> str:
    return f"""v_lt AS (SELECT label, ord, "publishedAt", text, {S.tokens('text')} AS toks FROM v_labelled WHERE label <> -1),
v_lp AS (SELECT *, len(toks) AS n, coalesce(sum(len(toks)) OVER (PARTITION BY label ORDER BY "publishedAt" ASC NULLS LAST, ord
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p,
        row_number() OVER (PARTITION BY label ORDER BY "publishedAt" ASC NULLS LAST, ord) AS rn FROM v_lt WHERE len(toks) > 0),
v_lk AS (SELECT label, rn, CASE WHEN p + n <= {budget} THEN text
        ELSE array_to_string(list_slice(toks, 1, {budget} - p), ' ') END AS piece FROM v_lp WHERE p < {budget}),
v_lpacked AS (SELECT label, string_agg(piece, chr(10) || chr(10) ORDER BY rn) AS multi_doc_input FROM v_lk GROUP BY label),
v_prev AS (SELECT label, count(*) AS size, string_agg(left(title, 120), chr(1) ORDER BY "publishedAt" ASC NULLS LAST, ord) AS previews
        FROM v_labelled WHERE label <> -1 GROUP BY label)"""


@register("build_live_inputs", W_LIVE + ", " + sql_live_pack(TEST_BUDGET) + """
SELECT cast(v.label AS varchar) AS cluster_id, 'newsapi' AS source, v.size AS n_articles,
  coalesce(p.multi_doc_input, '') AS multi_doc_input, CAST(NULL AS varchar) AS reference_summary,
  CAST(NULL AS varchar) AS reference_headline
FROM v_prev v LEFT JOIN v_lpacked p USING (label)""")
def q_build_live_inputs(spark, d):
    return G.live_inputs(labelled(spark, d), TEST_BUDGET)


@register("build_live_previews", W_LIVE + """SELECT cast(label AS varchar) AS cluster_id,
  CAST(row_number() OVER (PARTITION BY label ORDER BY "publishedAt" ASC NULLS LAST, ord) AS INTEGER) AS position,
  left(title, 120) AS preview FROM v_labelled WHERE label <> -1""")
def q_build_live_previews(spark, d):
    return G.live_previews(labelled(spark, d))


@register("rank_dense_id", FX.with_views(FX.SQL_RAW_ARTICLES, SQL_DEDUP, SQL_CLEAN) + """
SELECT row_number() OVER (ORDER BY c.category_rank, c.ord) - 1 AS row, c.url, c.title
FROM (SELECT a.*, d.category_rank FROM v_clean_all a JOIN v_dedup d USING (ord) WHERE a.word_count >= 20) c""")
def q_rank_dense_id(spark, d):
    f = C.unique_flags(FX.raw_articles(spark, d)).where("keep")
    return O.global_ordinal(f.select("category_rank", "ord", "url", "title"), ["category_rank", "ord"]) \
        .select("row", "url", "title")
