"""Registered queries: entities, rankings, event cards."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens.functions import text as T
from eventlens.operators import entities as EN
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


SQL_TOKENS = r"""v_pc AS (SELECT cluster_id, regexp_extract_all(text, '\s*\S+') AS ps FROM v_entity_text),
v_pp AS (SELECT cluster_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS tpos FROM v_pc),
v_tk AS (SELECT cluster_id, tpos, regexp_replace(piece, '^\s+', '') AS tok,
  coalesce(sum(length(piece)) OVER (PARTITION BY cluster_id ORDER BY tpos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  + length(piece) - length(regexp_replace(piece, '^\s+', '')) AS start FROM v_pp),
v_wd AS (SELECT cluster_id, tpos, regexp_replace(tok, '[.,;:!?)\]"'']+$', '') AS word, start FROM v_tk),
v_w AS (SELECT *, CAST(start + length(word) AS INTEGER) AS "end" FROM v_wd WHERE word <> ''),
v_g AS (
  SELECT cluster_id, start, "end", word AS phrase FROM v_w
  UNION ALL SELECT cluster_id, start, e2, phrase FROM (SELECT cluster_id, start,
     word || ' ' || lead(word, 1) OVER w AS phrase, lead("end", 1) OVER w AS e2 FROM v_w WINDOW w AS (PARTITION BY cluster_id ORDER BY tpos)) WHERE phrase IS NOT NULL
  UNION ALL SELECT cluster_id, start, e3, phrase FROM (SELECT cluster_id, start,
     word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w AS phrase, lead("end", 2) OVER w AS e3 FROM v_w WINDOW w AS (PARTITION BY cluster_id ORDER BY tpos)) WHERE phrase IS NOT NULL),
v_ents AS (
  SELECT g.cluster_id, g.phrase AS text, 'GPE' AS label, CAST(g.start AS INTEGER) AS start, CAST(g."end" AS INTEGER) AS "end"
  FROM v_g g JOIN (SELECT DISTINCT n_name FROM nation) n ON n.n_name = g.phrase
  UNION ALL SELECT cluster_id, word, 'DATE', CAST(start AS INTEGER), "end" FROM v_w WHERE regexp_full_match(word, '[0-9]{4}-[0-9]{2}-[0-9]{2}'))"""
W = FX.with_views(FX.SQL_ENTITY_TEXT, SQL_TOKENS)


def entities(spark, d):
    return EN.extract_entities(FX.entity_texts(spark, d), FX.gazetteer(spark, d))


@register("ner_extract", W + 'SELECT cluster_id, text, label, start, "end" FROM v_ents')
def q_ner_extract(spark, d):
    return entities(spark, d)


@register("ner_count_entities", W + "SELECT text, label, count(*) AS count FROM v_ents GROUP BY 1, 2")
def q_ner_count_entities(spark, d):
    return EN.count_entities(entities(spark, d))


@register("ner_rank_entities", W + """SELECT cluster_id, text, label, count,
  CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY count DESC, text, label) AS INTEGER) AS rank
FROM (SELECT cluster_id, text, label, count(*) AS count FROM v_ents GROUP BY 1, 2, 3)""")
def q_ner_rank_entities(spark, d):
    return EN.rank_entities(entities(spark, d))


@register("card_highlight", W + """, v_e AS (SELECT cluster_id, list_sort(list(DISTINCT {'s': start, 'n': -"end", 'l': label})) AS es
  FROM v_ents GROUP BY 1),
v_k AS (SELECT t.cluster_id, t.text, list_reduce(coalesce(e.es, []), lambda acc, x: CASE WHEN x.s >= acc.last
    THEN {'last': -x.n, 'kept': list_append(acc.kept, x)} ELSE acc END,
    {'last': 0, 'kept': CAST([] AS STRUCT(s INTEGER, n INTEGER, l VARCHAR)[])}) AS k
  FROM v_entity_text t LEFT JOIN v_e e USING (cluster_id))
SELECT cluster_id, array_to_string(list_transform(k.kept, lambda x, i:
    substring(text, CASE WHEN i = 1 THEN 0 ELSE -k.kept[i - 1].n END + 1, x.s - CASE WHEN i = 1 THEN 0 ELSE -k.kept[i - 1].n END)
    || '<span class="ent ent-' || x.l || '">' || substring(text, x.s + 1, -x.n - x.s) || '</span>'), '')
  || substring(text, k.last + 1) AS html FROM v_k""")
def q_card_highlight(spark, d):
    t = EN.with_entities(FX.entity_texts(spark, d), FX.gazetteer(spark, d))
    return t.select("cluster_id", EN.highlight(F.col("text"), F.col("entities")).alias("html"))


SQL_CARDS = """v_rank AS (SELECT cluster_id, text, label, count,
  row_number() OVER (PARTITION BY cluster_id ORDER BY count DESC, text, label) AS rank
  FROM (SELECT cluster_id, text, label, count(*) AS count FROM v_ents GROUP BY 1, 2, 3)),
v_cards AS (SELECT t.cluster_id, """ + "{head} AS headline, t.text AS summary," + """
  (SELECT string_agg(r.text || ':' || r.label || ':' || r.count, '; ' ORDER BY r.rank) FROM v_rank r WHERE r.cluster_id = t.cluster_id) AS entities,
  (SELECT string_agg(DISTINCT a.source_name, '; ' ORDER BY a.source_name) FROM v_raw_articles a WHERE a.ord = t.cluster_id) AS sources
  FROM v_entity_text t)"""


def _cards_sql():
    from eventlens.plans import sqlparts as S
    return SQL_CARDS.replace("{head}", S.first_sentence("t.text"))


W_CARDS = FX.with_views(FX.SQL_ENTITY_TEXT, FX.SQL_RAW_ARTICLES, SQL_TOKENS, _cards_sql())


def cards(spark, d):
    t = FX.entity_texts(spark, d)
    summaries = t.select("cluster_id", T.first_sentence("text").alias("headline"), F.col("text").alias("summary"))
    ranked = EN.rank_entities(entities(spark, d))
    srcs = FX.raw_articles(spark, d).where(F.col("source.name").isNotNull()) \
        .select(F.col("ord").alias("cluster_id"), F.col("source.name").alias("source"))
    return EN.build_cards(summaries, ranked, srcs)


def _flat(c):
    ents = F.array_join(F.transform("entities", lambda e: F.concat_ws(":", e["text"], e["label"], e["count"].cast("string"))), "; ")
    return c.select("cluster_id", "headline", "summary", F.when(F.size("entities") > 0, ents).alias("entities"),
                    F.when(F.size("sources") > 0, F.array_join("sources", "; ")).alias("sources"))


@register("card_build", W_CARDS + "SELECT cluster_id, headline, summary, entities, sources FROM v_cards")
def q_card_build(spark, d):
    return _flat(cards(spark, d))


@register("card_join_results", FX.with_views(FX.SQL_ENTITY_TEXT, SQL_TOKENS) + """
SELECT t.cluster_id, count(e.text) AS n_entities FROM v_entity_text t LEFT JOIN v_ents e USING (cluster_id) GROUP BY 1""")
def q_card_join_results(spark, d):
    t = FX.entity_texts(spark, d).select("cluster_id")
    return t.join(entities(spark, d), "cluster_id", "left").groupBy("cluster_id") \
        .agg(F.count("text").alias("n_entities"))


@register("card_filter", FX.with_views(FX.SQL_ENTITY_TEXT, FX.SQL_RAW_ARTICLES) + """
SELECT t.cluster_id, a.category, a."publishedAt" AS published FROM v_entity_text t JOIN v_raw_articles a ON a.ord = t.cluster_id
WHERE a.category = 'science' AND a."publishedAt" >= '2024-01-10' AND a."publishedAt" <= '2024-01-20'""")
def q_card_filter(spark, d):
    t = FX.entity_texts(spark, d).select("cluster_id")
    a = FX.raw_articles(spark, d).select(F.col("ord").alias("cluster_id"), "category", "publishedAt",
                                         F.col("source.name").alias("source"))
    c = t.join(a, "cluster_id").select(
        "cluster_id", F.array("category").alias("categories"),
        F.when(F.col("source").isNotNull(), F.array("source")).otherwise(F.array().cast("array<string>")).alias("sources"),
        F.col("publishedAt").alias("first_published"), F.col("publishedAt").alias("last_published"), "category")
    f = EN.filter_cards(c, category="science", date_from="2024-01-10", date_to="2024-01-20")
    return f.select("cluster_id", "category", F.col("first_published").alias("published"))
