"""Registered queries: sources, sinks, alignment, streaming, payload metadata."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from eventlens.operators import clean as C
from eventlens.operators import groups as G
from eventlens.operators import prep as PR
from eventlens.operators import vectors as V
from eventlens.operators.hooks import get_hook
from eventlens.plans.groups import W_LIVE, labelled, sql_live_pack
from eventlens.plans.ingest import SQL_CLEAN, SQL_DEDUP, W_CLEAN
from eventlens.plans.prep import W_HEAD
from eventlens.plans.vectors import SQL_PAIRS, SQL_SIL
from eventlens.session import cut_lineage
from eventlens.sources import files as IO
from eventlens.sources import fixtures as FX
from eventlens.streaming import live as LV

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

FLAT_ARTICLE = StructType(IO.RAW_ARTICLE.fields + [StructField("category", StringType()), StructField("ord", LongType())])
CLEAN_ARTICLE = StructType([StructField("ord", LongType())] + [
    StructField(c, IntegerType() if c == "word_count" else BooleanType() if c == "is_paywall_preview" else StringType())
    for c in C.CLEAN_COLUMNS])


@register("ingest_tag_category", W_RAW + "SELECT category, url, title, ord FROM v_raw_articles")
def q_ingest_tag_category(spark, d):
    root = IO.land_responses(FX.raw_articles(spark, d), IO.scratch_dir(spark, "responses"))
    r = IO.read_responses(spark, root)
    return r.select("category", "url", "title", F.col("_ord").alias("ord"))


@register("scan_articles_json", W_RAW + "SELECT ord, url, title, category FROM v_raw_articles")
def q_scan_articles_json(spark, d):
    raw = FX.raw_articles(spark, d).drop("category_rank")
    path = IO.save_snapshot(raw, IO.scratch_dir(spark, "raw"))
    return IO.read_articles(spark, path, FLAT_ARTICLE).select("ord", "url", "title", "category")


@register("scan_articles_json_arrays", W_RAW + "SELECT ord, url, title, category FROM v_raw_articles")
def q_scan_articles_json_arrays(spark, d):
    """A1: files that hold a JSON array of articles each."""
    path = IO.save_article_arrays(FX.raw_articles(spark, d).drop("category_rank"), IO.scratch_dir(spark, "arrays"))
    return IO.read_articles(spark, path, FLAT_ARTICLE, multi_line=True).select("ord", "url", "title", "category")


@register("scan_latest_snapshot", W_CLEAN + "SELECT ord, url FROM v_clean_all WHERE word_count >= 20")
def q_scan_latest_snapshot(spark, d):
    root = IO.scratch_dir(spark, "snapshots")
    clean = C.clean_unique(FX.raw_articles(spark, d))
    IO.save_snapshot(clean.where(F.col("category") == "sports"), root, "articles_00000000T000000Z")
    IO.save_snapshot(clean, root)
    return IO.read_latest_snapshot(spark, root, CLEAN_ARTICLE).select("ord", "url")


@register("sink_snapshot_roundtrip", W_CLEAN + """SELECT ord, title, text, word_count, is_paywall_preview
FROM v_clean_all WHERE word_count >= 20""")
def q_sink_snapshot_roundtrip(spark, d):
    clean = C.clean_unique(FX.raw_articles(spark, d))
    path = IO.save_snapshot(clean, IO.scratch_dir(spark, "clean"))
    return IO.read_articles(spark, path, CLEAN_ARTICLE).select("ord", "title", "text", "word_count", "is_paywall_preview")


@register("sink_payload_roundtrip", W_LIVE + """SELECT label AS cluster_id, count(*) AS size, count(*) AS n_members
FROM v_labelled WHERE label <> -1 GROUP BY label""")
def q_sink_payload_roundtrip(spark, d):
    # Cleaned and labelled once; entries, positions and members all read it.
    lab = cut_lineage(labelled(spark, d).select("ord", "label", "title", "text", "publishedAt", "source", "url"))
    root = IO.scratch_dir(spark, "payload")
    # Payload as two tables: one row per cluster, one row per member.
    entries = G.live_cluster_entries(lab, G.MAX_INPUT_TOKENS)
    ranked = G.rank_by_published(lab).select("ord", "position")
    members = lab.where("label <> -1").join(ranked, "ord").select(F.col("label").alias("cluster_id"), "position", "ord", "title",
                                                                  "publishedAt", "source", "url")
    IO.save_nested(entries, f"{root}/clusters")
    IO.save_nested(members, f"{root}/members", "json")
    e = spark.read.parquet(f"{root}/clusters")
    m = spark.read.schema("cluster_id int, position int, ord bigint, title string, publishedAt string, "
                          "source string, url string").json(f"{root}/members")
    nm = m.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_members"))
    return e.join(nm, "cluster_id", "left").select("cluster_id", "size", F.coalesce("n_members", F.lit(0)).alias("n_members"))


@register("sink_split_roundtrip", W_HEAD + "SELECT split, id, headline FROM v_lab WHERE ok AND headline <> ''")
def q_sink_split_roundtrip(spark, d):
    ds = PR.stage_dataset(FX.labelled_pairs(spark, d), PR.stage1_rows)
    path = IO.save_split_dataset(ds, IO.scratch_dir(spark, "splits"))
    return spark.read.parquet(path).select("split", "id", "headline")


@register("scan_split_parquet", W_HEAD + "SELECT id, headline FROM v_lab WHERE ok AND headline <> '' AND split = 'test'")
def q_scan_split_parquet(spark, d):
    ds = PR.stage_dataset(FX.labelled_pairs(spark, d), PR.stage1_rows)
    path = IO.save_split_dataset(ds, IO.scratch_dir(spark, "splits"))
    return IO.read_split(spark, path, "test").select("id", "headline")


@register("check_embedding_alignment", FX.with_views(FX.SQL_RAW_ARTICLES, SQL_DEDUP, SQL_CLEAN, FX.SQL_VECTORS) + """,
a AS (SELECT ord FROM v_clean_all WHERE word_count >= 20)
SELECT (SELECT count(*) FROM a) AS n_articles, (SELECT count(*) FROM v_vectors) AS n_vectors,
  (SELECT count(*) FROM a WHERE ord NOT IN (SELECT id FROM v_vectors)) AS missing_vectors,
  (SELECT count(*) FROM v_vectors WHERE id NOT IN (SELECT ord FROM a)) AS missing_articles""")
def q_check_embedding_alignment(spark, d):
    clean = C.clean_unique(FX.raw_articles(spark, d))
    return IO.alignment_counts(clean, FX.vectors(spark, d))


@register("stream_live_dedup", W_CLEAN + "SELECT url, title FROM v_clean_all WHERE word_count >= 20")
def q_stream_live_dedup(spark, d):
    landing = LV.land_articles(FX.raw_articles(spark, d).select(
        *[f.name for f in IO.RAW_ARTICLE.fields], "category", "ord", "category_rank"), IO.scratch_dir(spark, "landing"))
    out, ckpt = IO.scratch_dir(spark, "stream-out"), IO.scratch_dir(spark, "stream-ckpt")
    LV.run_available_now(LV.live_dedup_stream(spark, landing), out, ckpt)
    return spark.read.parquet(out).select("url", "title")


SQL_LABELLED_VECTORS = "v_lvec AS (SELECT v.* FROM v_vectors v JOIN v_labelled l ON l.ord = v.id)"
MEMBER_SCHEMA = "cluster_id int, position int, ord bigint, title string, publishedAt string, source string, url string"


@register("cluster_payload", W_LIVE + ", " + sql_live_pack(G.MAX_INPUT_TOKENS) + ", " + ", ".join(
    (SQL_LABELLED_VECTORS, SQL_PAIRS.replace("v_vectors", "v_lvec"), SQL_SIL.replace("v_vectors", "v_lvec"))) + """,
v_pos AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY "publishedAt" ASC NULLS LAST, ord) AS position FROM v_labelled WHERE label <> -1),
v_mem AS (SELECT label, bit_xor(('0x' || left(md5(concat_ws('|', cast(position AS varchar), cast(ord AS varchar), title, coalesce("publishedAt", '-'), source, url)), 15))::BIGINT) AS members
  FROM v_pos GROUP BY label)
SELECT 'labels' AS method, (SELECT count(DISTINCT label) FROM v_labelled WHERE label <> -1) AS n_clusters,
  (SELECT count(*) FROM v_labelled WHERE label = -1) AS n_noise, (SELECT count(*) FROM v_labelled) AS n_articles,
  round(CASE WHEN (SELECT count(DISTINCT label) FROM v_labelled WHERE label <> -1) >= 2 THEN (SELECT avg(sv) FROM v_sil) END, 6) AS silhouette_score,
  '1024' AS budget, 'fixture labels' AS labels_from, v.label AS cluster_id, v.size, coalesce(p.multi_doc_input, '') AS multi_doc_input, m.members
FROM v_prev v LEFT JOIN v_lpacked p USING (label) JOIN v_mem m USING (label)""")
def q_cluster_payload(spark, d):
    """Entries, members and metadata of one labelling, written, read back and compared by content."""
    lab = cut_lineage(labelled(spark, d).select("ord", "label", "title", "text", "publishedAt", "source", "url"))
    ranked = G.rank_by_published(lab).select("ord", "position")
    members = lab.join(ranked, "ord", "left").select(F.col("label").alias("cluster_id"), "position", "ord", "title", "publishedAt", "source", "url")
    # The labelling is the fixture's; its silhouette is measured on the same articles' vectors.
    sil = V.silhouette(FX.vectors(spark, d).join(lab.select(F.col("ord").alias("id")), "id")).first()["silhouette"]
    root = IO.save_payload(G.live_cluster_entries(lab), members, IO.scratch_dir(spark, "payload"), "labels",
                           {"budget": G.MAX_INPUT_TOKENS, "labels_from": "fixture labels"}, sil)
    meta, clusters, rows = IO.read_payload(spark, root, MEMBER_SCHEMA)
    line = F.concat_ws("|", F.col("position").cast("string"), F.col("ord").cast("string"), "title", F.coalesce("publishedAt", F.lit("-")), "source", "url")
    digest = rows.where("cluster_id <> -1").groupBy("cluster_id").agg(
        F.bit_xor(F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long")).alias("members"))
    return clusters.join(digest, "cluster_id").join(F.broadcast(meta), F.lit(True)).select(  # one-row metadata
        "method", "n_clusters", "n_noise", "n_articles", F.round("silhouette_score", 6).alias("silhouette_score"),
        F.col("params")["budget"].alias("budget"), F.col("params")["labels_from"].alias("labels_from"),
        "cluster_id", "size", "multi_doc_input", "members")


@register("vec_encode_hook", W_CLEAN + """, c AS (SELECT ord, list_transform(range(97, 123), lambda x: length(lower(text)) - length(replace(lower(text), chr(CAST(x AS INTEGER)), ''))) AS n
  FROM v_clean_all WHERE word_count >= 20),
v AS (SELECT ord, n, sqrt(list_sum(list_transform(n, lambda x: x * x))) AS norm FROM c)
SELECT ord, CAST(len(n) AS INTEGER) AS dim, round(n[1] / norm, 4) AS a, round(n[5] / norm, 4) AS e, round(n[26] / norm, 4) AS z FROM v""")
def q_vec_encode_hook(spark, d):
    """An encoder hook over whole cleaned texts."""
    enc = V.encode_with(C.clean_unique(FX.raw_articles(spark, d)), get_hook("encoder", "letter-profile"), "text", "ord")
    at = lambda i, name: F.round(F.col("vec")[i].cast("double"), 4).alias(name)
    return enc.select("ord", F.size("vec").alias("dim"), at(0, "a"), at(4, "e"), at(25, "z"))


@register("vec_encode")
def q_vec_encode(spark, d):
    clean = C.clean_unique(FX.raw_articles(spark, d))
    enc = V.encode_hashing(clean, "text", "ord", 384)
    return enc.select("ord", F.size("vec").alias("dim"), F.round(V.l2_norm("vec"), 4).alias("norm"), "vec")
