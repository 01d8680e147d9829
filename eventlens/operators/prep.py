"""Labelled-pair preparation: length filter, stage-1/stage-2 tables, funnel.

One scan feeds everything: the head-per-split, the length filter and both
row builders are projections / filters of the same DataFrame, and the funnel
is one conditional aggregate over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions import text as T
from eventlens.operators.ordering import head_per_group

# ---- fixed values (configuration of the reference) --------------------------
MIN_ARTICLE_WORDS = 50
STAGE2_SEPARATOR = "\n"
SPLIT_SIZES = {"train": 50000, "validation": 1000, "test": 1000}  # passed explicitly where a cap is wanted
SPLITS = ("train", "validation", "test")
# -----------------------------------------------------------------------------


def check_split(split: str) -> str:
    """A4 allow-list: unknown split names are rejected."""
    if split not in SPLITS:
        raise ValueError(f"no split named {split!r}; the splits are {', '.join(SPLITS)}")
    return split


def head_per_split(pairs: DataFrame, sizes: dict[str, int] | None = None) -> DataFrame:
    """A5: first ``n`` rows of each split by ordinal, before any filtering; without ``sizes`` all rows of all splits."""
    if sizes is None:
        return pairs.where(F.col("split").isin(*SPLITS))
    for s in sizes:
        check_split(s)
    lim = F.element_at(F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(v))]), F.col("split"))
    tagged = pairs.withColumn("_n", lim).where(F.col("_n").isNotNull())
    return head_per_group(tagged, ["split"], "ord", None, n_col="_n").drop("_n")


def length_ok(article="article", highlights="highlights"):
    """C2 predicate: article >= 50 words AND non-empty highlights."""
    h = F.col(highlights)
    return (T.word_count(article) >= MIN_ARTICLE_WORDS) & h.isNotNull() & (h != "")


def filter_by_length(pairs: DataFrame) -> DataFrame:
    return pairs.where(length_ok())


def with_labels(pairs: DataFrame) -> DataFrame:
    return (pairs.withColumn("headline", T.derive_headline("highlights"))
            .withColumn("target", T.derive_summary_target("highlights")))


def stage1_rows(pairs: DataFrame) -> DataFrame:
    """J1 + C3: ``id, article, headline`` with a non-empty headline."""
    extra = [c for c in ("split", "ord") if c in pairs.columns]
    return (pairs.withColumn("headline", T.derive_headline("highlights"))
            .where(F.col("headline") != "").select(*extra, "id", "article", "headline"))


def stage2_rows(pairs: DataFrame, separator: str = STAGE2_SEPARATOR) -> DataFrame:
    """J2 + C3: ``id, input, target, headline``; both labels non-empty."""
    extra = [c for c in ("split", "ord") if c in pairs.columns]
    w = with_labels(pairs).where((F.col("headline") != "") & (F.col("target") != ""))
    return w.select(*extra, "id", F.concat("headline", F.lit(separator), "article").alias("input"),
                    "target", "headline")


def stage_dataset(pairs: DataFrame, builder, sizes: dict[str, int] | None = None) -> DataFrame:
    """Head per split -> length filter -> builder, with a ``split`` column."""
    return pairs.transform(lambda d: head_per_split(d, sizes)).transform(filter_by_length).transform(builder)


def funnel(pairs: DataFrame, sizes: dict[str, int] | None = None) -> DataFrame:
    """Requested / fetched / after filter / after builder / dropped, per stage and split."""
    sizes = sizes or SPLIT_SIZES
    head = with_labels(head_per_split(pairs, sizes))
    ok = length_ok()
    req = F.element_at(F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(v))]), F.col("split"))
    per = head.groupBy("split").agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(ok).alias("after_length_filter"),
        F.count_if(ok & (F.col("headline") != "")).alias("s1"),
        F.count_if(ok & (F.col("headline") != "") & (F.col("target") != "")).alias("s2"),
    ).withColumn("requested", req.cast("bigint"))
    stages = F.explode(F.array(
        F.struct(F.lit(1).alias("stage"), F.col("s1").alias("after_builder")),
        F.struct(F.lit(2).alias("stage"), F.col("s2").alias("after_builder"))))
    return per.select("split", "requested", "fetched", "after_length_filter",
                      (F.col("fetched") - F.col("after_length_filter")).alias("length_dropped"),
                      stages.alias("_s")).select(
        "_s.stage", "split", "requested", "fetched", "after_length_filter", "_s.after_builder", "length_dropped")


def stage_targets(stage1: DataFrame, stage2: DataFrame) -> DataFrame:
    """Stage-1 rows LEFT JOIN stage-2 targets on id (last duplicate wins).

    The per-id winner is a ``max_by`` aggregate (map-side combine) rather than
    a window, so a repeated id cannot pile up in one task.
    """
    t = stage2.groupBy("id").agg(F.max_by("target", "ord").alias("target"))
    j = stage1.join(t, "id", "left")
    return j.select(
        F.col("id").cast("string").alias("cluster_id"),
        F.lit("cnn_dm_test").alias("source"),
        F.lit(1).alias("n_articles"),
        F.col("article").alias("multi_doc_input"),
        F.coalesce("target", F.lit("")).alias("reference_summary"),
        F.col("headline").alias("reference_headline"),
        F.array(T.preview("article")).alias("source_articles_preview"),
    )


# ---- EDA over labelled pairs -------------------------------------------------

# fixed values: boilerplate prefix patterns (first line of an article)
PREFIX_PATTERNS = (
    ("(CNN) -- (plain)", r"^\s*\(CNN\)\s*--"),
    ("CITY (CNN) -- (dateline)", r"^\s*[A-Z][A-Za-z .,]{2,40}\(CNN\)\s*--"),
    ("(Reuters) -- (plain)", r"^\s*\(Reuters\)\s*--"),
    ("CITY, COUNTRY (Reuters) -- (Reuters dateline)", r"^\s*[A-Z][A-Za-z .,]{2,60}\(Reuters\)\s*--"),
    ("By <Author> starts (byline)", r"^\s*By\s+[A-Z]"),
    ("ALL-CAPS opening (e.g., WASHINGTON)", r"^\s*[A-Z]{3,}(?:\s+[A-Z]{2,})*\s*[,.:]"),
)


def _java_ws(p: str) -> str:
    return "(?U)" + p.replace(r"\s", T.WS)


def prefix_frequency(pairs: DataFrame) -> DataFrame:
    """E10 + D5: matches of each prefix pattern on the first line, with percent.

    One scan with one conditional count per pattern (no pattern x row join);
    the six counts are then unpivoted.
    """
    first = F.substring_index(F.col("article"), "\n", 1)
    aggs = [F.count_if(first.rlike(_java_ws(p))).alias(f"c{i}") for i, (_, p) in enumerate(PREFIX_PATTERNS)]
    r = pairs.agg(F.count(F.lit(1)).alias("total"), *aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("pattern"), F.col(f"c{i}").alias("count"))
                               for i, (n, _) in enumerate(PREFIX_PATTERNS)]))
    out = r.select("total", rows.alias("_p")).select("_p.pattern", "_p.count", "total")
    return out.select("pattern", "count", F.round(F.col("count") / F.col("total") * 100, 1).alias("pct"))


def eda_lengths_long(pairs: DataFrame) -> DataFrame:
    """Per-row word counts of article, highlights, v1 headline, summary target."""
    from eventlens.operators.profile import unpivot_counts
    summary_v1 = T.collapse_ws(F.replace(F.col("highlights"), F.lit("\n"), F.lit(" ")))
    return unpivot_counts(pairs, "id", {
        "article": T.word_count("article"),
        "highlights": T.word_count("highlights"),
        "headline": T.word_count(T.strip_dateline("article")),
        "summary_target": T.word_count(summary_v1),
    })


def tokenize_truncate(rows: DataFrame, src: str, tgt: str, max_in: int, max_out: int,
                      tokenizer=None) -> DataFrame:
    """``id, input_ids, labels`` token lists truncated, source columns dropped, no padding.

    ``tokenizer`` maps a string Column to an array Column (L3 plug-in);
    the default is the whitespace word tokenizer.
    """
    tok = tokenizer or T.word_tokens
    extra = [c for c in ("split",) if c in rows.columns]
    return rows.select(*extra, "id", F.slice(tok(F.col(src)), 1, max_in).alias("input_ids"),
                       F.slice(tok(F.col(tgt)), 1, max_out).alias("labels"))


def sample_seeded(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Deterministic sample of ``n`` rows: order by ``md5(seed || id)``.

    The same rows come back on any partitioning; the top-n is a partial
    (per-partition) top-k, so no full sort happens.
    """
    key = F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.col(id_col).cast("string")))
    return df.withColumn("_k", key).orderBy("_k", id_col).limit(n).drop("_k")
