"""Input views derived from the driver tables (see FIXTURES.md).

Each view exists twice: as a Spark DataFrame builder (what the queries read)
and as a DuckDB ``WITH`` fragment (what the oracle SQL reads).  Both derive
every row from the given tables, so work grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.text import ordered_concat
from eventlens.sources.tables import read_table, spread

CATEGORIES = ("business", "entertainment", "general", "health", "science", "sports", "technology")


def _mod(c: str, n: int) -> Column:
    return F.col(c) % F.lit(n)


def _first_line(c: str) -> Column:
    return F.substring_index(F.col(c), "\n", 1)


def _second_line(c: str) -> Column:
    # split_part(text, '\n', 2): '' when there is no second line
    parts = F.split(F.col(c), "\n")
    return F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_raw_articles`` in the nested raw-article schema (A1 shape).

    Extra columns ``ord`` and ``category_rank`` carry the response order and
    the configured category order that first-URL-wins dedup depends on.
    """
    d = spread(read_table(spark, sf_dir, "documents"))
    cat = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (_mod("doc_id", 7) + 1).cast("int"))
    url = (
        F.when(_mod("doc_id", 37) == 3, F.lit(None).cast("string"))
        .when(_mod("doc_id", 41) == 4, F.lit(""))
        .when(_mod("doc_id", 5) == 1, F.concat(F.lit("https://n.example/"), (F.col("doc_id") - 1).cast("string")))
        .otherwise(F.concat(F.lit("https://n.example/"), F.col("doc_id").cast("string")))
    )
    source_name = F.when(_mod("doc_id", 13) == 0, F.lit(None).cast("string")).otherwise(F.col("source"))
    head = _first_line("text")
    title = F.concat(
        F.when(_mod("doc_id", 4) == 0, F.concat(F.lit("<b>"), head, F.lit("</b> &amp; more"))).otherwise(head),
        F.when(_mod("doc_id", 2) == 0, F.concat(F.lit(" - "), F.upper("source")))
        .when(_mod("doc_id", 3) == 0, F.concat(F.lit(" | "), F.col("source")))
        .otherwise(F.lit("...")),
    )
    description = (
        F.when(_mod("doc_id", 3) == 0, F.col("text"))
        .when(_mod("doc_id", 3) == 1, F.lit("“Then” it’s more — details…"))
        .otherwise(F.lit(None).cast("string"))
    )
    content = (
        F.when(_mod("doc_id", 17) == 0, F.concat(F.lit("Subscribe for unlimited access. "), F.col("text")))
        .when(F.col("n_chars") > 200, F.concat(F.col("text"), F.lit("… [+"),
                                                (F.col("n_chars") - 200).cast("string"), F.lit(" chars]")))
        .otherwise(F.col("text"))
    )
    published = (
        F.when(_mod("doc_id", 11) == 0, F.lit(None).cast("string"))
        .when(_mod("doc_id", 23) == 0, F.lit(""))
        .otherwise(F.concat(F.lit("2024-01-"), F.lpad((1 + _mod("doc_id", 28)).cast("string"), 2, "0"),
                            F.lit("T00:00:00Z")))
    )
    return d.select(
        F.col("doc_id").alias("ord"),
        _mod("doc_id", 7).alias("category_rank"),
        F.struct(F.lit(None).cast("string").alias("id"), source_name.alias("name")).alias("source"),
        F.lit(None).cast("string").alias("author"),
        title.alias("title"),
        description.alias("description"),
        content.alias("content"),
        url.alias("url"),
        published.alias("publishedAt"),
        cat.alias("category"),
    )


def raw_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_groups``: conversations folded into ``document`` joined by ``|||||``.

    The fold is an ordered aggregation per conversation (a handful of turns).
    """
    c = read_table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(
        ordered_concat("text", "turn", "|||||").alias("document"),
        F.concat(F.lit("– "), F.max_by("text", "turn")).alias("summary"),
    )


def labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_pairs``: labelled (article, highlights) rows with a split column."""
    d = spread(read_table(spark, sf_dir, "documents"))
    split = (F.when(_mod("doc_id", 10) < 8, F.lit("train"))
             .when(_mod("doc_id", 10) == 8, F.lit("validation")).otherwise(F.lit("test")))
    article = (F.when(_mod("doc_id", 6) == 0, F.concat(F.lit("LONDON, England (CNN) -- "), F.col("text")))
               .when(_mod("doc_id", 6) == 1, F.concat(F.lit("(CNN) -- "), F.col("text")))
               .otherwise(F.col("text")))
    highlights = (
        F.when(_mod("doc_id", 29) == 0, F.lit(""))
        .when(_mod("doc_id", 31) == 0, F.concat(F.lit("\n"), _first_line("text")))
        .otherwise(F.concat(_first_line("text"), F.lit(" .\n"), _second_line("text"), F.lit(" , too .")))
    )
    return d.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), split.alias("split"),
                    article.alias("article"), highlights.alias("highlights"))


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_scored``: (prediction, reference) = (user turn, next assistant turn)."""
    c = read_table(spark, sf_dir, "conversations")
    p = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prediction"))
    r = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference"))
    return p.join(r, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("pair_id"), "prediction", "reference")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_vectors``: every ninth vector is noise (label -1)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"),
                    F.when(_mod("vec_id", 9) == 0, F.lit(-1)).otherwise(F.col("label")).alias("label"))


def token_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_token_vectors``: pairs of 10 prediction + 10 reference token vectors."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        _mod("vec_id", 20).alias("pos"),
        F.floor(F.col("vec_id") / 20).cast("bigint").alias("pair_id"),
        F.when(_mod("vec_id", 2) == 0, F.lit("pred")).otherwise(F.lit("ref")).alias("side"),
        F.col("embedding").alias("vec"),
    )


def entity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_entity_text``: a place name twice and one ISO date per text."""
    d = spread(read_table(spark, sf_dir, "documents"))
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension: a broadcast is bounded by construction.
    j = d.join(F.broadcast(n), F.col("n_nationkey") == (F.col("doc_id") % 25))
    return j.select(
        F.col("doc_id").alias("cluster_id"),
        F.concat(F.col("text"), F.lit(" "), F.col("n_name"), F.lit(" 2024-01-"),
                 F.lpad((1 + F.col("doc_id") % 28).cast("string"), 2, "0"), F.lit(" "), F.col("n_name")).alias("text"),
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity dictionary: nation names as GPE."""
    n = read_table(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("phrase"), F.lit("GPE").alias("label"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_ratings``: 1-5 ratings of five criteria, one row each, derived from labels and ids."""
    lab = read_table(spark, sf_dir, "labels")
    rated = {"accuracy": 1 + 4 * F.col("quality"), "fluency": 5 - 4 * F.col("toxic"), "conciseness": 1 + F.col("doc_id") % 5,
             "coherence": 2 + F.col("quality") + F.col("doc_id") % 3, "coverage": 5 - F.col("doc_id") % 4}
    rows = F.array(*[F.struct(F.lit(k).alias("criterion"), v.cast("long").alias("rating")) for k, v in rated.items()])
    return lab.select(F.col("doc_id").alias("item_id"), F.explode(rows).alias("r")).select("item_id", "r.criterion", "r.rating")


# --------------------------------------------------------------------------
# DuckDB fragments (oracle side).  Names match the Spark builders above.
# --------------------------------------------------------------------------

SQL_RAW_ARTICLES = """v_raw_articles AS (
SELECT doc_id AS ord, doc_id % 7 AS category_rank,
  CASE doc_id % 7 WHEN 0 THEN 'business' WHEN 1 THEN 'entertainment' WHEN 2 THEN 'general'
    WHEN 3 THEN 'health' WHEN 4 THEN 'science' WHEN 5 THEN 'sports' ELSE 'technology' END AS category,
  CASE WHEN doc_id % 37 = 3 THEN NULL WHEN doc_id % 41 = 4 THEN ''
    WHEN doc_id % 5 = 1 THEN 'https://n.example/' || cast(doc_id - 1 AS varchar)
    ELSE 'https://n.example/' || cast(doc_id AS varchar) END AS url,
  CASE WHEN doc_id % 13 = 0 THEN NULL ELSE source END AS source_name,
  CAST(NULL AS varchar) AS author,
  CASE WHEN doc_id % 4 = 0 THEN '<b>' || split_part(text, chr(10), 1) || '</b> &amp; more'
    ELSE split_part(text, chr(10), 1) END
    || CASE WHEN doc_id % 2 = 0 THEN ' - ' || upper(source)
       WHEN doc_id % 3 = 0 THEN ' | ' || source ELSE '...' END AS title,
  CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN '“Then” it’s more — details…' ELSE NULL END AS description,
  CASE WHEN doc_id % 17 = 0 THEN 'Subscribe for unlimited access. ' || text
    WHEN n_chars > 200 THEN text || '… [+' || cast(n_chars - 200 AS varchar) || ' chars]'
    ELSE text END AS content,
  CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 23 = 0 THEN ''
    ELSE '2024-01-' || lpad(cast(1 + doc_id % 28 AS varchar), 2, '0') || 'T00:00:00Z' END AS "publishedAt"
FROM documents)"""

SQL_GROUPS = """v_groups AS (
SELECT conv_id, string_agg(text, '|||||' ORDER BY turn) AS document,
  '– ' || max_by(text, turn) AS summary FROM conversations GROUP BY conv_id)"""

SQL_PAIRS = """v_pairs AS (
SELECT doc_id AS id, doc_id AS ord,
  CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split,
  CASE WHEN doc_id % 6 = 0 THEN 'LONDON, England (CNN) -- ' || text WHEN doc_id % 6 = 1 THEN '(CNN) -- ' || text ELSE text END AS article,
  CASE WHEN doc_id % 29 = 0 THEN '' WHEN doc_id % 31 = 0 THEN chr(10) || split_part(text, chr(10), 1)
    ELSE split_part(text, chr(10), 1) || ' .' || chr(10) || split_part(text, chr(10), 2) || ' , too .' END AS highlights
FROM documents)"""

SQL_SCORED = """v_scored AS (
SELECT p.conv_id * 100 + p.turn AS pair_id, p.text AS prediction, r.text AS reference
FROM conversations p JOIN conversations r ON p.conv_id = r.conv_id AND r.turn = p.turn + 1
WHERE p.role = 'user' AND r.role = 'assistant')"""

SQL_VECTORS = """v_vectors AS (
SELECT vec_id AS id, embedding AS vec, CASE WHEN vec_id % 9 = 0 THEN -1 ELSE label END AS label FROM embeddings)"""

SQL_TOKEN_VECTORS = """v_token_vectors AS (
SELECT vec_id % 20 AS pos, cast(floor(vec_id / 20) AS bigint) AS pair_id,
  CASE WHEN vec_id % 2 = 0 THEN 'pred' ELSE 'ref' END AS side, embedding AS vec FROM embeddings)"""

SQL_ENTITY_TEXT = """v_entity_text AS (
SELECT d.doc_id AS cluster_id, d.text || ' ' || n.n_name || ' 2024-01-' || lpad(cast(1 + d.doc_id % 28 AS varchar), 2, '0') || ' ' || n.n_name AS text
FROM documents d JOIN nation n ON n.n_nationkey = d.doc_id % 25)"""

SQL_RATINGS = """v_ratings AS (
SELECT doc_id AS item_id, 'accuracy' AS criterion, 1 + 4 * quality AS rating FROM labels
UNION ALL SELECT doc_id, 'fluency', 5 - 4 * toxic FROM labels
UNION ALL SELECT doc_id, 'conciseness', 1 + doc_id % 5 FROM labels
UNION ALL SELECT doc_id, 'coherence', 2 + quality + doc_id % 3 FROM labels
UNION ALL SELECT doc_id, 'coverage', 5 - doc_id % 4 FROM labels)"""


def with_views(*fragments: str) -> str:
    """``WITH a AS (..), b AS (..)`` prefix for oracle queries."""
    return "WITH " + ",\n".join(fragments) + "\n"
