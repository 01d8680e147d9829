"""Evaluation reports: per-section metric tables in long form.

A report is a DataFrame ``(section, metric, value DOUBLE)``.  Sections are
optional (A10): a missing input simply contributes no rows, and reports are
combined with ``unionByName``.  Formatting (B23) and side-by-side comparison
(D6) are projections / a full outer join over these small tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators import score as SC
from eventlens.session import cut_lineage

EM_DASH = "—"  # fixed value: shown for a metric missing on one side


def long_form(section: str, wide: DataFrame) -> DataFrame:
    """One-row wide metrics -> ``(section, metric, value)`` rows."""
    cols = wide.columns
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                             for c in cols]))
    return wide.select(st.alias("_m")).select(F.lit(section).alias("section"), "_m.metric", "_m.value")


PAIRS_PER_BLOCK = 512


def greedy_pairs(df: DataFrame, id_col: str, pred: str, ref: str, table: DataFrame,
                 table_id: str = "vec_id", table_vec: str = "embedding") -> DataFrame:
    """J13 over text pairs: per-pair P/R/F from looked-up token vectors.

    Token -> row ``(first 32 bits of md5(token)) mod size`` of ``table`` (a
    hashing lookup: deterministic, model-free, and reproducible in any SQL
    engine).  The distinct tokens of all pairs form a dictionary, and each
    fetches its vector once.  Pairs are dealt into blocks of about 512; a block
    gets the vectors of its distinct tokens, once each, and meets its pairs in a
    co-group, so no vector is shuffled for an occurrence.  A token whose row is
    missing stays and matches nothing.  Pairs without any token have no row.
    """
    blocks = max(1, -(-df.count() // PAIRS_PER_BLOCK))
    pairs = df.select(F.col(id_col), SC.rouge_tokens(pred).alias("_p"), SC.rouge_tokens(ref).alias("_r")) \
              .where((F.size("_p") > 0) | (F.size("_r") > 0)).withColumn("_block", F.pmod(F.xxhash64(id_col), F.lit(blocks)))
    need = pairs.select("_block", F.explode(F.array_union("_p", "_r")).alias("tok")).distinct()
    size = table.agg((F.max(table_id) + 1).alias("_size"))
    row = F.pmod(F.conv(F.substring(F.md5("tok"), 1, 8), 16, 10).cast("long"), F.col("_size"))
    words = need.select("tok").distinct().join(F.broadcast(size), how="left", on=F.lit(True)).withColumn("_row", row)  # one-row size
    vec = F.col(table_vec)
    if table.schema[table_vec].dataType.simpleString() != "array<float>":  # floats stay so on the way and are widened in the block
        vec = vec.cast("array<double>")
    vecs = table.select(F.col(table_id).alias("_row"), vec.alias("vec"))
    known = need.join(words.join(vecs, "_row", "left").select("tok", "vec"), "tok").select(F.col("_block").alias("_at"), "tok", "vec")
    kind = df.schema[id_col].dataType.simpleString()  # ids keep their type
    return pairs.groupBy("_block").cogroup(known.groupBy("_at")).applyInArrow(
        SC.greedy_block(id_col), f"{id_col} {kind}, precision double, recall double, f1 double")


def soft_means(df: DataFrame, id_col: str, pred: str, ref: str, table: DataFrame, prefix: str = "") -> DataFrame:
    """Mean soft P/R/F over all pairs (pairs without tokens score 0)."""
    g = greedy_pairs(df, id_col, pred, ref, table)
    j = df.select(id_col).join(g, id_col, "left")
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    return j.agg(*[(F.sum(F.coalesce(c, F.lit(0.0))) / n).alias(f"{prefix}bertscore_{k}")
                   for c, k in (("precision", "p"), ("recall", "r"), ("f1", "f1"))])


def rouge_means(df: DataFrame, id_col: str, pred: str, ref: str, stem: bool = True) -> DataFrame:
    scores = SC.rouge_all(df, id_col, pred, ref, stem)
    return SC.mean_score(scores, ["rouge1", "rouge2", "rougeL", "rougeLsum"])


def evaluate_groups(results: DataFrame, table: DataFrame, id_col: str = "cluster_id", stem: bool = True) -> DataFrame:
    """N, summary vs reference (ROUGE + soft match), headline-summary consistency.

    Headline vs reference is deliberately not scored for pre-grouped data.
    """
    # One materialisation feeds every metric branch (no per-branch recompute).
    results = cut_lineage(results.select(id_col, "generated_headline", "generated_summary", "reference_summary"))
    n = results.agg(F.count(F.lit(1)).alias("n_clusters"))
    summ = rouge_means(results, id_col, "generated_summary", "reference_summary", stem) \
        .join(soft_means(results, id_col, "generated_summary", "reference_summary", table), how="inner", on=F.lit(True))
    cons = soft_means(results, id_col, "generated_headline", "generated_summary", table, "consistency_")
    return (long_form("meta", n).unionByName(long_form("summary_vs_reference", summ))
            .unionByName(long_form("headline_summary_consistency", cons)))


def evaluate_chained(results: DataFrame, table: DataFrame, id_col: str = "cluster_id", stem: bool = True) -> DataFrame:
    """Adds headline vs reference headline scores."""
    results = cut_lineage(results.select(id_col, "generated_headline", "generated_summary",
                                         "reference_headline", "reference_summary"))
    n = results.agg(F.count(F.lit(1)).alias("n_examples"))
    head = rouge_means(results, id_col, "generated_headline", "reference_headline", stem) \
        .join(soft_means(results, id_col, "generated_headline", "reference_headline", table), how="inner", on=F.lit(True))
    summ = rouge_means(results, id_col, "generated_summary", "reference_summary", stem) \
        .join(soft_means(results, id_col, "generated_summary", "reference_summary", table), how="inner", on=F.lit(True))
    cons = soft_means(results, id_col, "generated_headline", "generated_summary", table, "consistency_")
    return (long_form("meta", n).unionByName(long_form("headline_vs_reference", head))
            .unionByName(long_form("summary_vs_reference", summ))
            .unionByName(long_form("headline_summary_consistency", cons)))


FINAL_PREFIX = "final_test_"  # fixed value: keys of a stage's test metrics


def save_stage_metrics(metrics: DataFrame, path: str) -> str:
    """Metrics of a training stage ``(metric, value)`` as one JSON object."""
    one = metrics.agg(F.map_from_entries(F.collect_list(F.struct("metric", F.col("value").cast("double")))).alias("metrics"))
    one.write.mode("overwrite").json(path)
    return path


def read_stage_metrics(spark: SparkSession, path: str | None, stage: str) -> DataFrame | None:
    """A10: a stage's metrics as report rows; None where there is no such file."""
    if path is None:
        return None
    try:
        read = spark.read.schema("metrics map<string,double>").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return read.select(F.lit(stage).alias("section"), F.explode("metrics").alias("metric", "value"))


def fmt(value: Column) -> Column:
    """Four decimals; missing -> em dash."""
    # format_string renders a null as the word "null".
    return F.when(value.isNull(), F.lit(EM_DASH)).otherwise(F.format_string("%.4f", value))


def compare_reports(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """D6 + H2: metric-name union of two reports, missing side shown as em dash."""
    a = left.select("metric", F.col("value").alias("_l"))
    b = right.select("metric", F.col("value").alias("_r"))
    return (a.join(b, "metric", "full_outer")
            .select("metric", fmt(F.col("_l")).alias(left_name), fmt(F.col("_r")).alias(right_name))
            .orderBy("metric"))


def final_table(reports: dict[str, DataFrame | None]) -> DataFrame:
    """J17 data: every present report's rows with a formatted value (A10).

    Per-stage test metrics (from a training run) contribute only their
    ``final_test_*`` keys.
    """
    out = None
    for name, rep in reports.items():
        if rep is None:
            continue
        r = rep.select(F.lit(name).alias("report"), "section", "metric", "value")
        if name.startswith("stage"):
            r = r.where(F.col("metric").startswith(FINAL_PREFIX))
        out = r if out is None else out.unionByName(r)
    return out.withColumn("value_fmt", fmt(F.col("value")))


def ablation_delta(arms: DataFrame, base_arm: str, test_arm: str) -> DataFrame:
    """Metrics pivoted by arm and the difference ``test - base``."""
    p = arms.groupBy("metric").pivot("arm", [base_arm, test_arm]).agg(F.first("value"))
    return p.select("metric", F.col(base_arm).alias("base"), F.col(test_arm).alias("test"),
                    (F.col(test_arm) - F.col(base_arm)).alias("delta"))
