"""Registered queries: live-article ingest, cleaning and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens.functions import text as T
from eventlens.operators import clean as C
from eventlens.operators import profile as P
from eventlens.plans import sqlparts as S
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


W_RAW = FX.with_views(FX.SQL_RAW_ARTICLES)
# DuckDB twin of dedup_first_url.
SQL_DEDUP = """v_dedup AS (
SELECT * FROM v_raw_articles WHERE coalesce(url, '') <> ''
QUALIFY row_number() OVER (PARTITION BY url ORDER BY category_rank, ord) = 1)"""
SQL_CLEAN = f"""v_stage AS (
SELECT ord, {S.title_suffix(S.normalize('title'), "coalesce(source_name, '')")} AS title,
  {S.normalize('description')} AS description,
  {S.normalize(S.strip_truncation('content'))} AS content,
  url, "publishedAt", coalesce(source_name, '') AS source, category, author
FROM v_dedup),
v_clean_all AS (
SELECT *, {S.word_count('text')} AS word_count, {S.paywall('content')} AS is_paywall_preview
FROM (SELECT *, {S.assemble('title', 'description', 'content')} AS text FROM v_stage))"""
W_CLEAN = FX.with_views(FX.SQL_RAW_ARTICLES, SQL_DEDUP, SQL_CLEAN)


def raw(spark, d):
    return FX.raw_articles(spark, d)


def deduped(spark, d):
    return C.dedup_first_url(raw(spark, d))


def cleaned(spark, d):
    return C.clean_unique(raw(spark, d))


@register("dedup_first_url", W_RAW + """, v_d AS (SELECT * FROM v_raw_articles WHERE coalesce(url,'') <> ''
QUALIFY row_number() OVER (PARTITION BY url ORDER BY category_rank, ord) = 1)
SELECT url, ord, category, category_rank FROM v_d""")
def q_dedup_first_url(spark, d):
    return deduped(spark, d).select("url", "ord", "category", "category_rank")


@register("clean_articles", W_CLEAN + """
SELECT ord, title, description, content, text, url, "publishedAt", source, category, author,
  word_count, is_paywall_preview FROM v_clean_all WHERE word_count >= 20""")
def q_clean_articles(spark, d):
    return cleaned(spark, d)


@register("agg_clean_stats", W_CLEAN + """
SELECT count(*) AS input, count(*) FILTER (WHERE word_count < 20) AS dropped_short,
  count(*) FILTER (WHERE word_count >= 20 AND is_paywall_preview) AS paywall_flagged,
  count(*) FILTER (WHERE word_count >= 20) AS kept FROM v_clean_all""")
def q_agg_clean_stats(spark, d):
    return C.clean_stats(C.unique_flags(raw(spark, d)), flagged=True)


@register("agg_source_diversity", W_RAW + """, v_d AS (SELECT * FROM v_raw_articles WHERE coalesce(url,'') <> ''
QUALIFY row_number() OVER (PARTITION BY url ORDER BY category_rank, ord) = 1),
per AS (SELECT coalesce(nullif(source_name, ''), '<unknown>') AS source, count(*) AS n_articles FROM v_d GROUP BY 1)
SELECT source, n_articles, (SELECT count(*) FROM per) AS n_sources FROM per""")
def q_agg_source_diversity(spark, d):
    return C.source_diversity(deduped(spark, d))


@register("topk_sources", W_RAW + """, v_d AS (SELECT * FROM v_raw_articles WHERE coalesce(url,'') <> ''
QUALIFY row_number() OVER (PARTITION BY url ORDER BY category_rank, ord) = 1)
SELECT coalesce(nullif(source_name, ''), '<unknown>') AS source, count(*) AS n_articles FROM v_d
GROUP BY 1 ORDER BY n_articles DESC, source LIMIT 10""")
def q_topk_sources(spark, d):
    return C.top_sources(deduped(spark, d), 10)


@register("agg_category_kept", W_RAW + """, v_d AS (SELECT * FROM v_raw_articles WHERE coalesce(url,'') <> ''
QUALIFY row_number() OVER (PARTITION BY url ORDER BY category_rank, ord) = 1)
SELECT f.category, f.fetched, coalesce(k.kept_after_dedup, 0) AS kept_after_dedup
FROM (SELECT category, count(*) AS fetched FROM v_raw_articles GROUP BY 1) f
LEFT JOIN (SELECT category, count(*) AS kept_after_dedup FROM v_d GROUP BY 1) k USING (category)""")
def q_agg_category_kept(spark, d):
    return C.category_kept(raw(spark, d))


@register("eda_category_counts", W_CLEAN + """
SELECT category, count(*) AS n_articles, count(DISTINCT source) AS n_sources,
  count(*) FILTER (WHERE is_paywall_preview) AS n_flagged
FROM v_clean_all WHERE word_count >= 20 GROUP BY category""")
def q_eda_category_counts(spark, d):
    return C.category_profile(cleaned(spark, d))


@register("dq_residue_counts", W_CLEAN + """
SELECT count(*) FILTER (WHERE regexp_matches(text, '[‘’“”–—]')) AS smart_quotes,
  count(*) FILTER (WHERE contains(text, '…')) AS ellipses,
  count(*) FILTER (WHERE regexp_matches(text, '\\[\\+[0-9]+[ \\t\\n\\r]*chars?\\]')) AS markers,
  count(*) FILTER (WHERE contains(text, chr(13)) OR contains(text, chr(10))) AS line_breaks
FROM v_clean_all WHERE word_count >= 20""")
def q_dq_residue_counts(spark, d):
    return C.residue_counts(cleaned(spark, d))


@register("agg_rank_percentiles", W_CLEAN + """, v AS (SELECT word_count FROM v_clean_all WHERE word_count >= 20),
r AS (SELECT word_count, row_number() OVER (ORDER BY word_count) - 1 AS i, count(*) OVER () AS n FROM v)
SELECT CAST(min(word_count) AS INTEGER) AS min,
  CAST(max(word_count) FILTER (WHERE i = n // 4) AS INTEGER) AS p25,
  CAST(max(word_count) FILTER (WHERE i = n // 2) AS INTEGER) AS median,
  CAST(max(word_count) FILTER (WHERE i = 3 * n // 4) AS INTEGER) AS p75,
  CAST(max(word_count) AS INTEGER) AS max FROM r""")
def q_agg_rank_percentiles(spark, d):
    return P.rank_profile(cleaned(spark, d), "word_count")


@register("eda_wordcount_quantiles", W_CLEAN + """, v AS (SELECT word_count FROM v_clean_all WHERE word_count >= 20)
SELECT CAST(min(word_count) AS INTEGER) AS min,
  CAST(trunc(quantile_cont(word_count, 0.25)) AS INTEGER) AS p25,
  CAST(trunc(quantile_cont(word_count, 0.5)) AS INTEGER) AS median,
  CAST(trunc(quantile_cont(word_count, 0.75)) AS INTEGER) AS p75,
  CAST(trunc(quantile_cont(word_count, 0.95)) AS INTEGER) AS p95,
  CAST(max(word_count) AS INTEGER) AS max, round(avg(word_count), 1) AS mean FROM v""")
def q_eda_wordcount_quantiles(spark, d):
    return P.quantile_row(cleaned(spark, d), "word_count")


# ---- scalar text functions, each over a whole driver table ----------------

@register("txt_strip_truncation", W_RAW + f"SELECT ord, {S.strip_truncation('content')} AS out FROM v_raw_articles")
def q_txt_strip_truncation(spark, d):
    return raw(spark, d).select("ord", T.strip_truncation_marker("content").alias("out"))


@register("txt_html_unescape", f"SELECT page_id, {S.unescape('html')} AS out FROM pages")
def q_txt_html_unescape(spark, d):
    return read_table(spark, d, "pages").select("page_id", T.html_unescape("html").alias("out"))


@register("txt_strip_tags", f"SELECT page_id, {S.strip_tags('html')} AS out FROM pages")
def q_txt_strip_tags(spark, d):
    return read_table(spark, d, "pages").select("page_id", T.strip_tags("html").alias("out"))


@register("txt_ascii_quotes", W_RAW + f"SELECT ord, {S.ascii_quotes('description')} AS out FROM v_raw_articles")
def q_txt_ascii_quotes(spark, d):
    return raw(spark, d).select("ord", T.ascii_quotes("description").alias("out"))


@register("txt_collapse_ws", f"SELECT doc_id, {S.collapse_text('text')} AS out FROM documents")
def q_txt_collapse_ws(spark, d):
    return read_table(spark, d, "documents").select("doc_id", T.collapse_text_ws("text").alias("out"))


@register("txt_normalize", W_RAW + f"SELECT ord, {S.normalize('title')} AS out FROM v_raw_articles")
def q_txt_normalize(spark, d):
    return raw(spark, d).select("ord", T.normalize_text("title").alias("out"))


@register("txt_strip_title_suffix", W_RAW + f"""SELECT ord,
  {S.title_suffix(S.normalize('title'), "coalesce(source_name, '')")} AS out FROM v_raw_articles""")
def q_txt_strip_title_suffix(spark, d):
    r = raw(spark, d)
    src = F.coalesce(F.col("source.name"), F.lit(""))
    return r.select("ord", T.strip_title_suffix(T.normalize_text("title"), src).alias("out"))


@register("txt_assemble", W_RAW + f"""SELECT ord, {S.assemble(S.normalize('title'), S.normalize('description'),
  S.normalize(S.strip_truncation('content')))} AS out FROM v_raw_articles""")
def q_txt_assemble(spark, d):
    r = raw(spark, d)
    return r.select("ord", T.assemble_text(T.normalize_text("title"), T.normalize_text("description"),
                                           T.normalize_text(T.strip_truncation_marker("content"))).alias("out"))


@register("txt_word_count", f"SELECT doc_id, {S.word_count('text')} AS n_words FROM documents")
def q_txt_word_count(spark, d):
    return read_table(spark, d, "documents").select("doc_id", T.word_count("text").alias("n_words"))


@register("txt_paywall_flag", W_RAW + f"""SELECT ord, {S.paywall(S.normalize(S.strip_truncation('content')))} AS flag
FROM v_raw_articles""")
def q_txt_paywall_flag(spark, d):
    r = raw(spark, d)
    return r.select("ord", T.is_paywall_preview(T.normalize_text(T.strip_truncation_marker("content"))).alias("flag"))


@register("txt_sentence_split", f"SELECT doc_id, {S.sentence_split('text')} AS out FROM documents")
def q_txt_sentence_split(spark, d):
    return read_table(spark, d, "documents").select("doc_id", T.sentence_split("text").alias("out"))


@register("txt_first_sentence", f"SELECT doc_id, {S.first_sentence('text')} AS out FROM documents")
def q_txt_first_sentence(spark, d):
    return read_table(spark, d, "documents").select("doc_id", T.first_sentence("text").alias("out"))
