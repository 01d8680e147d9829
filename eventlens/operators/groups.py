"""Event groups: parsing pre-grouped rows, ordering, packing, payloads.

Packing (F3) has one meaning and one tokenizer argument: articles without a
token are left out, the others follow in order until the budget is used, and
the article that crosses it is cut to the tokens that remain.

* ``pack_array`` is a fold over the articles of a group that already sits in
  one row (a parsed multi-article document): no shuffle, one step an article.
* ``pack_groups`` takes one row for each article.  Token counts are added up by
  a distributed prefix sum over keys alone (``segmented_scan``), so a group
  that holds a third of all rows is scanned by many tasks; the texts of the
  rows that fall inside the budget are fetched afterwards.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.functions import text as T
from eventlens.operators.ordering import rank_within_group, segmented_scan

# ---- fixed values -------------------------------------------------------------
ARTICLE_SEPARATOR = "|||||"
SUMMARY_PREFIX = "– "
PACK_SEPARATOR = "\n\n"
MAX_INPUT_TOKENS = 1024
PREVIEW_CHARS = 120
# -------------------------------------------------------------------------------


def split_articles(document) -> Column:
    """B18 articles: split on the literal separator, strip, drop empties."""
    parts = F.split(T._c(document), r"\Q" + ARTICLE_SEPARATOR + r"\E")
    return F.filter(F.transform(parts, T.strip_ws), lambda a: a != "")


def clean_summary(summary) -> Column:
    """B18 summary: left-strip, drop a leading ``– ``, left-strip again."""
    s = T.lstrip_ws(F.coalesce(T._c(summary), F.lit("")))
    return F.when(s.startswith(SUMMARY_PREFIX), T.lstrip_ws(F.substring(s, len(SUMMARY_PREFIX) + 1, 1 << 30))) \
        .otherwise(s)


def parse_clusters(raw: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``cluster_id, articles, reference_summary`` from raw grouped rows."""
    return raw.select(F.col(id_col).alias("cluster_id"), split_articles("document").alias("articles"),
                      clean_summary("summary").alias("reference_summary"))


@dataclass(frozen=True)
class Tokenizer:
    """What packing and truncation need of a tokenizer, as column expressions."""

    count: Callable[[Column], Column]  # text -> number of tokens, 0 for null
    head: Callable[[Column, Column], Column]  # text, n -> the text of its first n tokens


#: Whitespace words; a cut text is joined by single spaces.
WORDS = Tokenizer(lambda text: F.size(T.word_tokens(text)).cast("long"),
                  lambda text, n: F.array_join(F.slice(T.word_tokens(text), F.lit(1), n.cast("int")), " "))


@lru_cache(maxsize=4)
def _loaded(factory):
    """One tokenizer for each worker process."""
    return factory()


def model_tokenizer(factory: Callable) -> Tokenizer:
    """L3: the tokenizer of a model.  ``factory()``, a module-level function, returns an object with ``encode`` and ``decode``.

    It is loaded once in a worker and runs over Arrow batches, so it suits long
    tables (``pack_groups``, truncation), not array elements.
    """
    def count(text: pa.Array) -> pa.Array:
        tok = _loaded(factory)
        return pa.array([len(tok.encode(t)) if t else 0 for t in text.to_pylist()], pa.int64())

    def head(text: pa.Array, n: pa.Array) -> pa.Array:
        tok = _loaded(factory)
        return pa.array([t and tok.decode(tok.encode(t)[:k]) for t, k in zip(text.to_pylist(), n.to_pylist())], pa.string())

    return Tokenizer(lambda c: arrow_udf(count, "long")(c), lambda c, n: arrow_udf(head, "string")(c, n))


def pack_array(articles, budget: int = MAX_INPUT_TOKENS, tokenizer: Tokenizer = WORDS) -> Column:
    """F3 on an in-row array of article texts; the tokenizer must be native.

    One fold: each article is counted once, and the pieces kept are ``budget``
    at most, since each uses a token.
    """
    counted = F.transform(T._c(articles), lambda a: F.struct(a.alias("a"), tokenizer.count(a).alias("n")))
    start = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<string>").alias("out"))

    def step(acc, e):
        room = F.lit(budget) - acc["used"]
        piece = F.when(e["n"] <= room, e["a"]).otherwise(tokenizer.head(e["a"], room))
        return F.when((e["n"] == 0) | (room <= 0), acc).otherwise(
            F.struct((acc["used"] + e["n"]).alias("used"), F.array_append(acc["out"], piece).alias("out")))

    return F.array_join(F.aggregate(counted, start, step)["out"], PACK_SEPARATOR)


def pack_groups(rows: DataFrame, group: str, order_cols: list, key_cols: list[str], text: str = "text",
                budget: int = MAX_INPUT_TOKENS, tokenizer: Tokenizer = WORDS) -> DataFrame:
    """F3 on one row for each article: ``group, multi_doc_input, n_packed``.

    ``order_cols`` orders the articles of a group totally; ``key_cols`` names the
    columns that tell rows apart.  Articles without a token are dropped before
    anything is ranked, so they use up neither budget nor rank, and groups
    without any token have no row.  At most ``budget`` rows of a group are
    packed, whatever its size, so the concatenation is bounded.
    """
    named = [c for c in rows.columns if c != text]
    keys = rows.select(*named, tokenizer.count(F.col(text)).alias("_n")).where("_n > 0")  # C6
    scanned = segmented_scan(keys, [group], order_cols, {"_prior": "_n"}, rank="_rank")
    inside = scanned.where(F.col("_prior") < budget).select(*key_cols, F.col(group).alias("_group"), "_n", "_prior", "_rank")
    # Late materialisation: the texts of the packed rows only.
    kept = rows.select(*key_cols, F.col(text).alias("_text")).join(inside, key_cols)
    room = F.lit(budget) - F.col("_prior")
    whole = F.col("_n") <= room
    cut = tokenizer.head(F.when(~whole, F.col("_text")), room)
    return kept.select("_group", "_rank", F.when(whole, F.col("_text")).otherwise(cut).alias("_piece")) \
        .groupBy(F.col("_group").alias(group)).agg(T.ordered_concat("_piece", "_rank", PACK_SEPARATOR).alias("multi_doc_input"),
                                                   F.count(F.lit(1)).alias("n_packed"))


def group_inputs(clusters: DataFrame, budget: int = MAX_INPUT_TOKENS) -> DataFrame:
    """Pipeline items for pre-grouped clusters (map-only, no shuffle)."""
    return clusters.select(
        F.col("cluster_id").cast("string").alias("cluster_id"),
        F.lit("multinews").alias("source"),
        F.size("articles").alias("n_articles"),
        pack_array("articles", budget).alias("multi_doc_input"),
        F.col("reference_summary"),
        T.first_sentence("reference_summary").alias("reference_headline"),
        F.transform("articles", lambda a: F.left(a, F.lit(PREVIEW_CHARS))).alias("source_articles_preview"),
    )


def cluster_stats(clusters: DataFrame) -> DataFrame:
    """E5 input in long form: (measure, value) per cluster."""
    m = F.explode(F.array(
        F.struct(F.lit("articles_per_cluster").alias("measure"), F.size("articles").cast("long").alias("value")),
        F.struct(F.lit("total_chars_per_cluster").alias("measure"),
                 F.aggregate("articles", F.lit(0).cast("long"), lambda acc, a: acc + F.length(a)).alias("value")),
        F.struct(F.lit("summary_words_per_cluster").alias("measure"),
                 T.word_count("reference_summary").cast("long").alias("value")),
    ))
    return clusters.select(m.alias("_m")).select("_m.measure", "_m.value")


# ---- live articles grouped by a cluster label ---------------------------------

def attach_labels(articles: DataFrame, labels: DataFrame, key: str = "ord", label_key: str = "id") -> DataFrame:
    """Articles joined to their cluster label (and vector) on the row key."""
    return articles.join(labels.withColumnRenamed(label_key, key), key)


def published_order() -> list:
    """F2 order: ``publishedAt`` ascending, nulls last, ties by insertion order."""
    return [F.col("publishedAt").asc_nulls_last(), F.col("ord").asc()]


def rank_by_published(labelled: DataFrame, group: str = "label") -> DataFrame:
    """``group, ord, publishedAt, position`` of each article inside its cluster (noise excluded).

    Keys alone are sorted; join other columns by ``ord``, which is another one
    for every article, so a hot cluster stays dealt over all tasks.
    """
    keys = labelled.where(F.col(group) != -1).select(group, "ord", "publishedAt")
    return rank_within_group(keys, [group], published_order(), "position")


def group_members(labelled: DataFrame, group: str = "label") -> DataFrame:
    """E13 (+C5): members per cluster in first-seen order, long form (skew-safe)."""
    r = rank_within_group(labelled.where(F.col(group) != -1).select(group, "ord"), [group], ["ord"], "member_pos")
    return r.select(F.col(group).alias("cluster_id"), "ord", "member_pos")


def cluster_sizes(labelled: DataFrame, group: str = "label") -> DataFrame:
    return (labelled.where(F.col(group) != -1).groupBy(F.col(group).alias("cluster_id"))
            .agg(F.count(F.lit(1)).alias("size")))


def live_cluster_entries(labelled: DataFrame, budget: int = MAX_INPUT_TOKENS, group: str = "label",
                         tokenizer: Tokenizer = WORDS) -> DataFrame:
    """E14 entries: ``cluster_id, size, multi_doc_input`` in published order."""
    members = labelled.where(F.col(group) != -1).select(group, "publishedAt", "ord", "text")
    packed = pack_groups(members, group, published_order(), ["ord"], "text", budget, tokenizer)
    sizes = cluster_sizes(labelled, group)
    return (sizes.join(packed.withColumnRenamed(group, "cluster_id"), "cluster_id", "left")
            .select("cluster_id", "size", F.coalesce("multi_doc_input", F.lit("")).alias("multi_doc_input")))


def live_inputs(labelled: DataFrame, budget: int = MAX_INPUT_TOKENS, group: str = "label",
                tokenizer: Tokenizer = WORDS) -> DataFrame:
    """One pipeline item per live cluster (packed input, null references).

    The per-article title previews are a separate long table
    (``live_previews``): a cluster may hold a large share of all articles,
    so its previews are never folded into one row.
    """
    entries = live_cluster_entries(labelled, budget, group, tokenizer)
    return entries.select(
        F.col("cluster_id").cast("string").alias("cluster_id"), F.lit("newsapi").alias("source"),
        F.col("size").alias("n_articles"), "multi_doc_input",
        F.lit(None).cast("string").alias("reference_summary"), F.lit(None).cast("string").alias("reference_headline"))


def live_previews(labelled: DataFrame, group: str = "label") -> DataFrame:
    """J5 previews in long form: ``cluster_id, position, preview`` (title[:120])."""
    ranked = rank_by_published(labelled, group).select("ord", "position")
    return labelled.where(F.col(group) != -1).select(group, "ord", "title").join(ranked, "ord").select(
        F.col(group).cast("string").alias("cluster_id"), "position", F.left("title", F.lit(PREVIEW_CHARS)).alias("preview"))


def top_cluster_titles(labelled: DataFrame, k: int = 10, chars: int = 85, group: str = "label") -> DataFrame:
    """Clusters by size (desc), first ``k`` member titles each, and how many more."""
    members = labelled.where(F.col(group) != -1)
    w = Window.partitionBy(group).orderBy("ord")
    first = members.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)  # partial group limit
    titles = first.groupBy(F.col(group).alias("cluster_id")).agg(
        F.array_sort(F.collect_list(F.struct("_r", F.left("title", F.lit(chars)).alias("t")))).alias("_t"))
    sizes = cluster_sizes(labelled, group)
    return (sizes.join(titles, "cluster_id")
            .select("cluster_id", "size", F.transform("_t", lambda e: e["t"]).alias("titles"),
                    F.greatest(F.col("size") - k, F.lit(0)).alias("more"))
            .orderBy(F.col("size").desc(), F.col("cluster_id")))


def min_cluster_filter(labelled: DataFrame, min_size: int = 2, group: str = "label") -> DataFrame:
    """Clusters with at least ``min_size`` members (noise excluded)."""
    return cluster_sizes(labelled, group).where(F.col("size") >= min_size)
