"""Registered queries: ROUGE, soft token matching, rating means."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens.operators import evaluate as EV
from eventlens.operators import score as SC
from eventlens.operators.hooks import get_hook
from eventlens.session import cut_lineage
from eventlens.sources import files as IO
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


def r6(c):
    return F.round(F.col(c), 6).alias(c)


def sql_toks(x):
    return f"list_filter(string_split(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


W = FX.with_views(FX.SQL_SCORED)


def scored(spark, d):
    return FX.scored_pairs(spark, d)


@register("rouge_tokens", W + f"""SELECT pair_id, array_to_string({sql_toks('prediction')}, ' ') AS pred_tokens,
  array_to_string({sql_toks('reference')}, ' ') AS ref_tokens FROM v_scored""")
def q_rouge_tokens(spark, d):
    s = scored(spark, d)
    return s.select("pair_id", F.array_join(SC.rouge_tokens("prediction"), " ").alias("pred_tokens"),
                    F.array_join(SC.rouge_tokens("reference"), " ").alias("ref_tokens"))


def sql_rouge_n(n: int, tag: str) -> str:
    if n == 1:
        grams = "unnest(toks)"
    else:
        grams = f"unnest(list_transform(range(1, len(toks) - {n - 2}), lambda i: array_to_string(list_slice(toks, i, i + {n - 1}), ' ')))"
    return f"""t{tag} AS (SELECT pair_id, 1 AS p, {sql_toks('prediction')} AS toks FROM v_scored
  UNION ALL SELECT pair_id, 0 AS p, {sql_toks('reference')} AS toks FROM v_scored),
g{tag} AS (SELECT pair_id, p, {grams} AS gram FROM t{tag}),
c{tag} AS (SELECT pair_id, gram, sum(p) AS cp, sum(1 - p) AS cr FROM g{tag} GROUP BY 1, 2),
s{tag} AS (SELECT pair_id, sum(least(cp, cr)) AS o, sum(cp) AS np, sum(cr) AS nr FROM c{tag} GROUP BY 1),
f{tag} AS (SELECT v.pair_id, coalesce(o, 0) / greatest(coalesce(np, 0), 1) AS pr, coalesce(o, 0) / greatest(coalesce(nr, 0), 1) AS rc
  FROM v_scored v LEFT JOIN s{tag} USING (pair_id)),
r{tag} AS (SELECT pair_id, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f FROM f{tag})"""


@register("rouge_ngram", W + ", " + sql_rouge_n(1, "1") + ", " + sql_rouge_n(2, "2") + """
SELECT pair_id, round(r1.f, 6) AS rouge1, round(r2.f, 6) AS rouge2 FROM r1 JOIN r2 USING (pair_id)""")
def q_rouge_ngram(spark, d):
    s = scored(spark, d)
    r1 = SC.rouge_n(s, 1).select("pair_id", F.col("fmeasure").alias("rouge1"))
    r2 = SC.rouge_n(s, 2).select("pair_id", F.col("fmeasure").alias("rouge2"))
    return r1.join(r2, "pair_id").select("pair_id", r6("rouge1"), r6("rouge2"))


@register("rouge_mean", W + ", " + sql_rouge_n(1, "1") + ", " + sql_rouge_n(2, "2") + """
SELECT round(sum(r1.f) / greatest(count(*), 1), 6) AS rouge1, round(sum(r2.f) / greatest(count(*), 1), 6) AS rouge2
FROM r1 JOIN r2 USING (pair_id)""")
def q_rouge_mean(spark, d):
    s = scored(spark, d)
    r1 = SC.rouge_n(s, 1).select("pair_id", F.col("fmeasure").alias("rouge1"))
    r2 = SC.rouge_n(s, 2).select("pair_id", F.col("fmeasure").alias("rouge2"))
    m = SC.mean_score(s.select("pair_id").join(r1, "pair_id", "left").join(r2, "pair_id", "left"),
                      ["rouge1", "rouge2"])
    return m.select(r6("rouge1"), r6("rouge2"))


# LCS as the longest increasing run of match positions: reading matches by prediction
# position and, inside one, by falling reference position, each position replaces the
# first greater-or-equal end of the runs kept so far.
SQL_LCS = f"""l0 AS (SELECT pair_id, {sql_toks('prediction')} AS pt, {sql_toks('reference')} AS rt FROM v_scored),
lp AS (SELECT pair_id, unnest(pt) AS tok, generate_subscripts(pt, 1) AS i FROM l0),
lr AS (SELECT pair_id, unnest(rt) AS tok, generate_subscripts(rt, 1) AS j FROM l0),
lm AS (SELECT pair_id, list(j ORDER BY i, j DESC) AS js FROM lp JOIN lr USING (pair_id, tok) GROUP BY pair_id),
lc AS (SELECT pair_id, len(list_reduce(js, lambda ends, j: list_concat(list_filter(ends, lambda e: e < j), [j],
    list_slice(ends, len(list_filter(ends, lambda e: e < j)) + 2, len(ends))), CAST([] AS BIGINT[]))) AS n FROM lm),
lf AS (SELECT pair_id, coalesce(n, 0) / greatest(len(pt), 1) AS pr, coalesce(n, 0) / greatest(len(rt), 1) AS rc FROM l0 LEFT JOIN lc USING (pair_id)),
rl AS (SELECT pair_id, pr, rc, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f FROM lf)"""


@register("rouge_l", W + ", " + SQL_LCS + """
SELECT pair_id, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f, 6) AS fmeasure FROM rl""")
def q_rouge_l(spark, d):
    return SC.rouge_l(scored(spark, d)).select("pair_id", r6("precision"), r6("recall"), r6("fmeasure"))


@register("rouge_lsum")
def q_rouge_lsum(spark, d):
    return SC.rouge_lsum(scored(spark, d)).select("pair_id", r6("precision"), r6("recall"), r6("fmeasure"))


@register("topk_best_worst", W + ", " + SQL_LCS + """
SELECT "end", pair_id, "rougeL" FROM (SELECT 'worst' AS "end", pair_id, round(f, 6) AS "rougeL" FROM rl ORDER BY f, pair_id LIMIT 5)
UNION ALL SELECT "end", pair_id, "rougeL" FROM (SELECT 'best' AS "end", pair_id, round(f, 6) AS "rougeL" FROM rl ORDER BY f DESC, pair_id DESC LIMIT 5)""")
def q_topk_best_worst(spark, d):
    # Read twice, for the best and for the worst: the scores are written once.
    s = cut_lineage(SC.rouge_l(scored(spark, d)).select("pair_id", F.col("fmeasure").alias("rougeL")))
    return SC.best_worst(s, "rougeL", "pair_id", 5).select("end", "pair_id", r6("rougeL"))


W_TV = FX.with_views(FX.SQL_TOKEN_VECTORS)


@register("score_greedy_match", W_TV + """, s AS (
SELECT p.pair_id, p.pos AS ppos, r.pos AS rpos,
  list_cosine_similarity(CAST(p.vec AS DOUBLE[]), CAST(r.vec AS DOUBLE[])) AS sim
FROM v_token_vectors p JOIN v_token_vectors r ON p.pair_id = r.pair_id AND p.side = 'pred' AND r.side = 'ref'),
pm AS (SELECT pair_id, avg(m) AS pr FROM (SELECT pair_id, ppos, max(sim) AS m FROM s GROUP BY 1, 2) GROUP BY 1),
rm AS (SELECT pair_id, avg(m) AS rc FROM (SELECT pair_id, rpos, max(sim) AS m FROM s GROUP BY 1, 2) GROUP BY 1)
SELECT pair_id, round(pr, 6) AS precision, round(rc, 6) AS recall,
  round(CASE WHEN pr + rc <> 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END, 6) AS f1 FROM pm JOIN rm USING (pair_id)""")
def q_score_greedy_match(spark, d):
    g = SC.greedy_match(FX.token_vectors(spark, d))
    return g.select("pair_id", r6("precision"), r6("recall"), r6("f1"))


@register("eval_human_means", FX.with_views(FX.SQL_RATINGS) + """SELECT criterion, round(avg(rating), 6) AS mean_rating,
  count(*) AS n FROM v_ratings GROUP BY criterion""")
def q_eval_human_means(spark, d):
    r = FX.ratings(spark, d)
    return r.groupBy("criterion").agg(F.round(F.avg("rating"), 6).alias("mean_rating"),
                                      F.count(F.lit(1)).alias("n"))


@register("rouge_stemmed")
def q_rouge_stemmed(spark, d):
    """J9-J12 with Porter stemming (the reference's scoring mode)."""
    r = SC.rouge_all(scored(spark, d), stem=True)
    return r.select("pair_id", r6("rouge1"), r6("rouge2"), r6("rougeL"), r6("rougeLsum"))


@register("score_metric_hooks", W + f""", m AS (SELECT pair_id, list_distinct({sql_toks('prediction')}) AS p, list_distinct({sql_toks('reference')}) AS r,
    length(coalesce(prediction, '')) AS lp, length(coalesce(reference, '')) AS lr FROM v_scored),
o AS (SELECT *, len(list_intersect(p, r)) / greatest(len(p), 1) AS pr, len(list_intersect(p, r)) / greatest(len(r), 1) AS rc FROM m)
SELECT pair_id, round(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END, 6) AS token_f1,
  round(CASE WHEN greatest(lp, lr) = 0 THEN 1.0 ELSE least(lp, lr) / greatest(lp, lr) END, 6) AS length_ratio FROM o""")
def q_score_metric_hooks(spark, d):
    """A native and a Python metric through the same hook contract."""
    s = scored(spark, d)
    native = SC.score_with(s, get_hook("metric", "token-f1"), "token_f1")
    python = SC.score_with(s, get_hook("metric", "length-ratio"), "length_ratio")
    return native.join(python, "pair_id").select("pair_id", r6("token_f1"), r6("length_ratio"))


# ---- stage metrics (A10, J17, D6, H2) -------------------------------------------

def stage_reports(spark, d):
    """Two stages' metric files: stage 1 written from the scored pairs, stage 2 with other keys; a third path has no file."""
    m = q_rouge_mean(spark, d).selectExpr("rouge1 AS final_test_rouge1", "rouge2 AS final_test_rouge2", "1.5 AS train_loss")
    one = EV.long_form("stage1", m).select("metric", "value")
    two = EV.long_form("stage2", m.selectExpr("final_test_rouge2 / 2 AS final_test_rouge2", "final_test_rouge1 AS final_test_rouge1_best")).select("metric", "value")
    paths = [EV.save_stage_metrics(x, IO.scratch_dir(spark, "metrics")) for x in (one, two)]
    paths.append(IO.scratch_dir(spark, "no-metrics"))
    return {f"stage{i + 1}_test_metrics": EV.read_stage_metrics(spark, p, f"stage{i + 1}") for i, p in enumerate(paths)}


W_STAGES = W + ", " + sql_rouge_n(1, "1") + ", " + sql_rouge_n(2, "2") + """, mm AS (
SELECT round(sum(r1.f) / greatest(count(*), 1), 6) AS m1, round(sum(r2.f) / greatest(count(*), 1), 6) AS m2 FROM r1 JOIN r2 USING (pair_id)),
st AS (SELECT 1 AS stage, 'final_test_rouge1' AS metric, m1 AS value FROM mm UNION ALL SELECT 1, 'final_test_rouge2', m2 FROM mm
  UNION ALL SELECT 2, 'final_test_rouge2', m2 / 2 FROM mm UNION ALL SELECT 2, 'final_test_rouge1_best', m1 FROM mm)"""


@register("eval_stage_metrics", W_STAGES + """
SELECT 'stage' || stage || '_test_metrics' AS report, 'stage' || stage AS section, metric, round(value, 6) AS value, printf('%.4f', value) AS value_fmt FROM st""")
def q_eval_stage_metrics(spark, d):
    t = EV.final_table(stage_reports(spark, d))
    return t.select("report", "section", "metric", F.round("value", 6).alias("value"), "value_fmt")


@register("eval_compare_stages", W_STAGES + """
SELECT metric, coalesce(max(printf('%.4f', value)) FILTER (WHERE stage = 1), '—') AS stage1,
  coalesce(max(printf('%.4f', value)) FILTER (WHERE stage = 2), '—') AS stage2 FROM st GROUP BY metric""")
def q_eval_compare_stages(spark, d):
    """Metric names of both stages, an em dash where one has none."""
    r = {k: v.where(F.col("metric").startswith(EV.FINAL_PREFIX)) for k, v in stage_reports(spark, d).items() if v is not None}
    return EV.compare_reports(r["stage1_test_metrics"], r["stage2_test_metrics"], "stage1", "stage2")
