"""Registered queries: generation, end-to-end runs, evaluation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens.operators import evaluate as EV
from eventlens.operators import groups as G
from eventlens.operators import prep as PR
from eventlens.operators import score as SC
from eventlens.operators import summarize as SU
from eventlens.operators.hooks import get_hook
from eventlens.plans import sqlparts as S
from eventlens.plans.groups import SQL_PARSED, sql_pack
from eventlens.sources import files as IO
from eventlens.sources import fixtures as FX
from eventlens.sources.tables import read_table

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


def group_items(spark, d):
    """Pre-grouped clusters -> pipeline items (reference budget 1024)."""
    return G.group_inputs(G.parse_clusters(FX.raw_groups(spark, d)), 1024)


def _sql_rtoks(x):
    return f"list_filter(string_split(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


SQL_EXTRACTIVE = f"""v_items AS (SELECT cast(v.cluster_id AS varchar) AS cluster_id, coalesce(p.multi_doc_input, '') AS doc
  FROM v_parsed v LEFT JOIN v_packed p USING (cluster_id)),
v_s0 AS (SELECT cluster_id, {S.sentences('doc')} AS ss FROM v_items),
v_es AS (SELECT cluster_id, unnest(ss) AS sent, generate_subscripts(ss, 1) - 1 AS pos FROM v_s0),
v_tok AS (SELECT cluster_id, pos, unnest({_sql_rtoks('sent')}) AS term FROM v_es),
v_tf AS (SELECT cluster_id, term, count(*) AS tf FROM v_tok GROUP BY 1, 2),
v_df AS (SELECT term, count(*) AS df FROM v_tf GROUP BY 1),
v_ew AS (SELECT t.cluster_id, t.term, t.tf * (ln((SELECT count(*) FROM v_items) / d.df) + 1) AS weight
  FROM v_tf t JOIN v_df d USING (term)),
v_sc AS (SELECT k.cluster_id, k.pos, avg(w.weight) AS score FROM v_tok k JOIN v_ew w USING (cluster_id, term) GROUP BY 1, 2),
v_er AS (SELECT s.cluster_id, s.pos, s.sent, round(coalesce(c.score, 0.0), 9) AS score, {S.tokens('s.sent')} AS toks
  FROM v_es s LEFT JOIN v_sc c USING (cluster_id, pos)),
v_ep AS (SELECT *, len(toks) AS n, coalesce(sum(len(toks)) OVER (PARTITION BY cluster_id ORDER BY score DESC, pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM v_er WHERE len(toks) > 0),
v_ek AS (SELECT cluster_id, pos, CASE WHEN p + n <= 128 THEN sent ELSE array_to_string(list_slice(toks, 1, 128 - p), ' ') END AS piece
  FROM v_ep WHERE p < 128),
v_sum AS (SELECT cluster_id, string_agg(piece, ' ' ORDER BY pos) AS summary FROM v_ek GROUP BY 1),
v_gen AS (SELECT i.cluster_id, {S.strip(f"array_to_string(list_slice({S.tokens(S.first_sentence('i.doc'))}, 1, 48), ' ')")} AS generated_headline,
  {S.strip("coalesce(u.summary, '')")} AS generated_summary FROM v_items i LEFT JOIN v_sum u USING (cluster_id))"""


@register("sum_extractive", FX.with_views(FX.SQL_GROUPS, SQL_PARSED, sql_pack(1024), SQL_EXTRACTIVE) +
          "SELECT cluster_id, generated_headline, generated_summary FROM v_gen")
def q_sum_extractive(spark, d):
    return SU.extractive(group_items(spark, d))


def _lead_sql(x, n):
    return S.strip(f"array_to_string(list_slice({S.tokens(S.first_sentence(x))}, 1, {n}), ' ')")


@register("sum_two_stage", FX.with_views(FX.SQL_GROUPS, SQL_PARSED, sql_pack(1024)) + f"""
SELECT cluster_id, n_articles, generated_headline,
  {_lead_sql("generated_headline || chr(10) || doc", 128)} AS generated_summary FROM (
  SELECT cast(v.cluster_id AS varchar) AS cluster_id, CAST(len(v.articles) AS INTEGER) AS n_articles,
    coalesce(p.multi_doc_input, '') AS doc, {_lead_sql("coalesce(p.multi_doc_input, '')", 48)} AS generated_headline
  FROM v_parsed v LEFT JOIN v_packed p USING (cluster_id))""")
def q_sum_two_stage(spark, d):
    items = group_items(spark, d)
    out = SU.two_stage(items, get_hook("generator", "lead-headline"), get_hook("generator", "lead-summary"))
    return out.select("cluster_id", "n_articles", "generated_headline", "generated_summary")


def group_results(spark, d):
    """Pre-grouped clusters -> items -> extractive generation -> results."""
    items = group_items(spark, d)
    gen = SU.extractive(items)
    return items.join(gen, "cluster_id")


@register("sum_end_to_end", FX.with_views(FX.SQL_GROUPS, SQL_PARSED, sql_pack(1024), SQL_EXTRACTIVE) + f"""
SELECT cast(v.cluster_id AS varchar) AS cluster_id, CAST(len(v.articles) AS INTEGER) AS n_articles,
  {S.first_sentence('v.reference_summary')} AS reference_headline, g.generated_headline, g.generated_summary
FROM v_parsed v JOIN v_gen g ON g.cluster_id = cast(v.cluster_id AS varchar)""")
def q_sum_end_to_end(spark, d):
    r = group_results(spark, d)
    return r.select("cluster_id", "n_articles", "reference_headline", "generated_headline", "generated_summary")


def embeddings(spark, d):
    return read_table(spark, d, "embeddings")


SQL_CONSISTENCY = f"""v_sz AS (SELECT max(vec_id) + 1 AS size FROM embeddings),
v_side AS (SELECT cluster_id, 'pred' AS side, {_sql_rtoks('generated_headline')} AS toks FROM v_gen
  UNION ALL SELECT cluster_id, 'ref', {_sql_rtoks('generated_summary')} FROM v_gen),
v_tv AS (SELECT s.cluster_id, s.side, s.pos, CAST(e.embedding AS DOUBLE[]) AS vec
  FROM (SELECT cluster_id, side, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM v_side) s, v_sz
  JOIN embeddings e ON e.vec_id = ('0x' || left(md5(s.tok), 8))::BIGINT % v_sz.size),
v_sim AS (SELECT p.cluster_id, p.pos AS ppos, r.pos AS rpos, list_cosine_similarity(p.vec, r.vec) AS sim
  FROM v_tv p JOIN v_tv r ON p.cluster_id = r.cluster_id AND p.side = 'pred' AND r.side = 'ref'),
v_pm AS (SELECT cluster_id, avg(m) AS pr FROM (SELECT cluster_id, ppos, max(sim) AS m FROM v_sim GROUP BY 1, 2) GROUP BY 1),
v_rm AS (SELECT cluster_id, avg(m) AS rc FROM (SELECT cluster_id, rpos, max(sim) AS m FROM v_sim GROUP BY 1, 2) GROUP BY 1),
v_any AS (SELECT DISTINCT cluster_id FROM v_tv)"""


@register("score_consistency", FX.with_views(FX.SQL_GROUPS, SQL_PARSED, sql_pack(1024), SQL_EXTRACTIVE, SQL_CONSISTENCY) + """
SELECT a.cluster_id, round(coalesce(pr, 0.0), 6) AS consistency_bertscore_p, round(coalesce(rc, 0.0), 6) AS consistency_bertscore_r,
  round(CASE WHEN coalesce(pr, 0) + coalesce(rc, 0) <> 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END, 6) AS consistency_bertscore_f1
FROM v_any a LEFT JOIN v_pm USING (cluster_id) LEFT JOIN v_rm USING (cluster_id)""")
def q_score_consistency(spark, d):
    r = group_results(spark, d)
    g = EV.greedy_pairs(r, "cluster_id", "generated_headline", "generated_summary", embeddings(spark, d))
    return g.select("cluster_id", r6("precision", "consistency_bertscore_p"), r6("recall", "consistency_bertscore_r"),
                    r6("f1", "consistency_bertscore_f1"))


@register("eval_groups")
def q_eval_groups(spark, d):
    rep = EV.evaluate_groups(group_results(spark, d), embeddings(spark, d))
    return rep.select("section", "metric", r6("value"))


def chained_results(spark, d):
    """Chained single-document run on the labelled test split (D2 inputs)."""
    pairs = FX.labelled_pairs(spark, d)
    test = PR.filter_by_length(pairs.where(F.col("split") == "test"))
    items = PR.stage_targets(PR.stage1_rows(test), PR.stage2_rows(test))
    gen = SU.extractive(items)
    return items.join(gen, "cluster_id")


@register("sum_chained", FX.with_views(FX.SQL_PAIRS) + f"""SELECT cluster_id, generated_headline,
  {_lead_sql("generated_headline || chr(10) || article", 96)} AS generated_summary, reference_headline, reference_summary FROM (
  SELECT cast(s1.id AS varchar) AS cluster_id, {_lead_sql("s1.article", 32)} AS generated_headline, s1.article,
    s1.headline AS reference_headline, coalesce(s2.target, '') AS reference_summary
  FROM (SELECT id, article, {S.headline('highlights')} AS headline FROM v_pairs
        WHERE split = 'test' AND {S.word_count('article')} >= 50 AND highlights <> '') s1
  LEFT JOIN (SELECT id, max_by(target, ord) AS target FROM
        (SELECT id, ord, {S.headline('highlights')} AS headline, {S.summary_target('highlights')} AS target FROM v_pairs
         WHERE split = 'test' AND {S.word_count('article')} >= 50 AND highlights <> '')
        WHERE headline <> '' AND target <> '' GROUP BY id) s2 ON s1.id = s2.id
  WHERE s1.headline <> '')""")
def q_sum_chained(spark, d):
    """Chained run on the labelled test split, with limits of its own for each stage, written to the results sink and read back."""
    pairs = FX.labelled_pairs(spark, d)
    test = PR.filter_by_length(pairs.where(F.col("split") == "test"))
    items = PR.stage_targets(PR.stage1_rows(test), PR.stage2_rows(test))
    out = SU.two_stage(items, get_hook("generator", "lead-headline").with_options(max_tokens=32),
                       get_hook("generator", "lead-summary").with_options(max_tokens=96))
    path = IO.save_nested(out, IO.scratch_dir(spark, "chained"))
    return spark.read.parquet(path).select("cluster_id", "generated_headline", "generated_summary", "reference_headline", "reference_summary")


@register("eval_chained")
def q_eval_chained(spark, d):
    rep = EV.evaluate_chained(chained_results(spark, d), embeddings(spark, d))
    return rep.select("section", "metric", r6("value"))


@register("eval_final_table")
def q_eval_final_table(spark, d):
    emb = embeddings(spark, d)
    reports = {
        "stage1_test_metrics": None,  # training runs are not part of this engine (A10: omitted)
        "stage2_test_metrics": None,
        "cnn_dm_chained": EV.evaluate_chained(chained_results(spark, d), emb),
        "multinews_e2e": EV.evaluate_groups(group_results(spark, d), emb),
    }
    t = EV.final_table(reports)
    return t.select("report", "section", "metric", r6("value"), "value_fmt")


@register("eval_compare_reports")
def q_eval_compare_reports(spark, d):
    emb = embeddings(spark, d)
    a = EV.evaluate_chained(chained_results(spark, d), emb).where(F.col("section") == "summary_vs_reference")
    b = EV.evaluate_groups(group_results(spark, d), emb).where(F.col("section") == "summary_vs_reference")
    return EV.compare_reports(a, b, "cnn_dm_chained", "multinews_e2e")


@register("eval_ablation_delta")
def q_eval_ablation_delta(spark, d):
    """Single-document (first article) vs multi-document input, same generator."""
    clusters = G.parse_clusters(FX.raw_groups(spark, d))
    multi = G.group_inputs(clusters, 1024)
    single = G.group_inputs(clusters.withColumn("articles", F.slice("articles", 1, 1)), 1024) \
        .drop("reference_summary").join(multi.select("cluster_id", "reference_summary"), "cluster_id")
    arms = None
    for arm, items in (("single_doc", single), ("multi_doc", multi)):
        res = items.join(SU.extractive(items), "cluster_id")
        sc = SC.rouge_all(res, "cluster_id", "generated_summary", "reference_summary", stem=True)
        m = EV.long_form(arm, SC.mean_score(sc, ["rouge1", "rouge2", "rougeL", "rougeLsum"])) \
            .withColumnRenamed("section", "arm")
        arms = m if arms is None else arms.unionByName(m)
    return EV.ablation_delta(arms, "single_doc", "multi_doc").select("metric", r6("base"), r6("test"), r6("delta"))
