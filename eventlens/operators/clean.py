"""Article ingest: first-URL-wins dedup, cleaning, and their counters.

Raw articles follow the nested schema of FIXTURES.md (``source`` is a struct)
plus two ordering columns: ``category_rank`` (configured category order) and
``ord`` (response order inside a category).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType

from eventlens.functions import text as T

MIN_TEXT_WORDS = 20  # fixed value: articles below this many words are dropped

CLEAN_COLUMNS = ("title", "description", "content", "text", "url", "publishedAt", "source",
                 "category", "author", "word_count", "is_paywall_preview")

_TYPES = {"word_count": IntegerType(), "is_paywall_preview": BooleanType()}
CLEAN_SCHEMA = tuple((c, _TYPES.get(c, StringType())) for c in CLEAN_COLUMNS)


def with_url(df: DataFrame) -> DataFrame:
    """C4: rows with a null or empty URL never enter the dedup."""
    return df.where(F.coalesce(F.col("url"), F.lit("")) != "")


RANK_BITS, POSITION_BITS = 15, 48


def arrival_order(rank="category_rank", position="ord") -> Column:
    """Category order and position as one long that sorts alike (15 and 48 bits; an error beyond them, nulls last).

    A single long is what a hash aggregate can hold in place, so winners are
    chosen without sorting rows.
    """
    r = F.coalesce(F.col(rank).cast("long"), F.lit(2**RANK_BITS - 1))
    p = F.coalesce(F.col(position).cast("long"), F.lit(2**POSITION_BITS - 1))
    fits = r.between(0, 2**RANK_BITS - 1) & p.between(0, 2**POSITION_BITS - 1)
    return F.when(fits, F.shiftleft(r, POSITION_BITS).bitwiseOR(p)).otherwise(
        F.raise_error(F.lit("category rank or position does not fit the packed order")).cast("long"))


def first_copies(df: DataFrame, order_cols=("category_rank", "ord")) -> DataFrame:
    """The packed order (column ``_order``) of the first copy of each URL; reads keys alone."""
    return (with_url(df).select("url", arrival_order(*order_cols).alias("_order"))
            .groupBy("url").agg(F.min("_order").alias("_order")).select("_order"))


def dedup_first_url(df: DataFrame, order_cols=("category_rank", "ord"), keys: DataFrame | None = None) -> DataFrame:
    """keep the first occurrence of each URL in (category order, position).

    Winners are chosen on keys: a hash aggregate over (URL, packed order), which
    combines map-side, so a URL repeated across a third of all rows is one row
    for each input partition.  The payload is fetched late, by a semi join on
    the packed order.  That key is another one for every row, so copies of a hot
    URL are dealt over all tasks, and a query reads only the payload columns it
    uses.  ``order_cols`` must tell rows apart, as (category, position in its
    response) does.  ``keys`` is the table the winners are chosen on, where ``df``
    was derived from it row by row.
    """
    rows = with_url(df).withColumn("_order", arrival_order(*order_cols))
    return rows.join(first_copies(df if keys is None else keys, order_cols), "_order", "left_semi").select(*df.columns)


def bind(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that are worked out once.

    ``inline`` of a one-element array is a boundary that Catalyst neither
    collapses nor pushes a filter through, so text expressions that feed several
    columns and a filter run once a row.
    """
    return df.select(*df.columns, F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def clean_flags(df: DataFrame, carry: tuple = ()) -> DataFrame:
    """B11 without the length filter: every cleaned field plus ``keep``.

    ``carry`` names extra input columns passed through unchanged.
    """
    src = F.coalesce(F.col("source.name"), F.lit(""))
    kept = [c for c in df.columns if c in ("ord", "category_rank") or c in carry]
    staged = bind(df.select(*kept, "title", "description", "content", "url", "publishedAt", src.alias("source"), "category", "author"),
                  _content=T.strip_truncation_marker("content"))
    staged = bind(staged.drop("content"), _title=T.normalize_text("title"), _description=T.normalize_text("description"),
                  content=T.normalize_text("_content")).drop("title", "description", "_content")
    staged = bind(staged.withColumnRenamed("_description", "description"), title=T.strip_title_suffix("_title", F.col("source"))).drop("_title")
    staged = bind(staged, text=T.assemble_text("title", "description", "content"))
    # Cleaned text is single-spaced.
    staged = bind(staged, word_count=T.single_spaced_count("text"), is_paywall_preview=T.is_paywall_preview("content", T.single_spaced_count("content")))
    return staged.select(*kept, "title", "description", "content", "url", "publishedAt", "source", "category", "author",
                         "text", "word_count", "is_paywall_preview", (F.col("word_count") >= MIN_TEXT_WORDS).alias("keep"))


def clean_articles(df: DataFrame, keep_order: bool = True, carry: tuple = ()) -> DataFrame:
    """B11 + C1: cleaned articles with at least 20 words."""
    extra = ["ord"] if keep_order and "ord" in df.columns else []
    return clean_flags(df, carry).where("keep").select(*extra, *carry, *CLEAN_COLUMNS)


def unique_flags(raw: DataFrame) -> DataFrame:
    """F1 then B11, evaluated as B11 then F1 (cleaning is row-wise).

    The text work runs at scan parallelism before the join that keeps the first
    copies, and what is shuffled is normalised text instead of raw markup.
    """
    return dedup_first_url(clean_flags(raw), keys=raw)


def clean_unique(raw: DataFrame, carry: tuple = ()) -> DataFrame:
    """Deduplicated, cleaned articles with at least 20 words (F1 + B11 + C1)."""
    return unique_flags(raw).where("keep").select("ord", *carry, *CLEAN_COLUMNS)


def clean_stats(df: DataFrame, flagged: bool = False) -> DataFrame:
    """Input / dropped_short / paywall_flagged (kept rows) / kept, one row."""
    f = df if flagged else clean_flags(df)
    return f.agg(
        F.count(F.lit(1)).alias("input"),
        F.count_if(~F.col("keep")).alias("dropped_short"),
        F.count_if(F.col("keep") & F.col("is_paywall_preview")).alias("paywall_flagged"),
        F.count_if(F.col("keep")).alias("kept"),
    )


def source_diversity(df: DataFrame) -> DataFrame:
    """Articles per source name (``<unknown>`` default) + distinct sources."""
    name = F.coalesce(F.nullif(F.col("source.name"), F.lit("")), F.lit("<unknown>"))
    per = df.groupBy(name.alias("source")).agg(F.count(F.lit(1)).alias("n_articles"))
    total = per.agg(F.count(F.lit(1)).alias("n_sources"))
    # one-row scalar attached to every group row
    return per.join(F.broadcast(total), how="inner", on=F.lit(True))


def top_sources(df: DataFrame, k: int = 10) -> DataFrame:
    """G1: top-k sources by count; ties broken by name so the cut is stable."""
    per = source_diversity(df).select("source", "n_articles")
    return per.orderBy(F.col("n_articles").desc(), F.col("source").asc()).limit(k)


def category_kept(raw: DataFrame) -> DataFrame:
    """Fetched and kept-after-dedup per category.

    Both sides are per-category aggregates (a handful of rows), so the final
    join is between two tiny results.
    """
    fetched = raw.groupBy("category").agg(F.count(F.lit(1)).alias("fetched"))
    kept = dedup_first_url(raw).groupBy("category").agg(F.count(F.lit(1)).alias("kept_after_dedup"))
    return (fetched.join(kept, "category", "left")
            .select("category", "fetched", F.coalesce("kept_after_dedup", F.lit(0)).alias("kept_after_dedup")))


def category_profile(clean: DataFrame) -> DataFrame:
    """Per category count, distinct sources and paywall-flagged count."""
    return clean.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.count_distinct("source").alias("n_sources"),
        F.count_if("is_paywall_preview").alias("n_flagged"),
    )


def residue_counts(clean: DataFrame) -> DataFrame:
    """Leftover smart quotes, ellipses, truncation markers, CR/LF in ``text``."""
    t = F.col("text")
    smart = F.lit(False)
    for ch in T.SMART_FROM:
        smart = smart | t.contains(ch)
    return clean.agg(
        F.count_if(smart).alias("smart_quotes"),
        F.count_if(t.contains("…")).alias("ellipses"),
        F.count_if(t.rlike(r"\[\+\d+\s*chars?\]")).alias("markers"),
        F.count_if(t.contains("\r") | t.contains("\n")).alias("line_breaks"),
    )
