"""Headline and summary generation.

* ``extractive`` (J7) is the built-in generator, fully relational: sentences
  are exploded, term and document frequencies are aggregates, a sentence's
  score is the mean TF-IDF weight of its terms, and the summary packs the
  best sentences into the output budget and restores document order.  The
  only windows are per item over its sentences (bounded by the input budget).
* ``two_stage`` (J6) is the plug-in point for a model: two generator hooks
  (``operators/hooks.py``), each with its own batch size and limits.  Stage 2
  sees ``headline + separator + input``; outputs are stripped.
  ``lead_generator`` is a model-free stand-in, a native expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions import text as T
from eventlens.operators.hooks import Hook, apply_hook, register_hook
from eventlens.operators.score import rouge_tokens
from eventlens.session import cut_lineage

# ---- fixed values (generation limits of the reference configuration) -------
HEADLINE_MAX_TOKENS = 48
SUMMARY_MAX_TOKENS = 128
STAGE2_SEPARATOR = "\n"
SCORE_DECIMALS = 9
# -----------------------------------------------------------------------------


def first_words(c, n: int):
    return F.array_join(F.slice(T.word_tokens(c), 1, n), " ")


def sentence_scores(items: DataFrame, id_col: str = "cluster_id", doc: str = "multi_doc_input") -> DataFrame:
    """Per (item, sentence position): sentence text and mean TF-IDF weight.

    ``idf = ln(N / df) + 1`` with ``N`` items and ``df`` items containing the
    term; a term's weight in an item is ``tf * idf``; sentences without
    terms score 0.  Scores are rounded to 9 places so ties are exact.
    """
    sents = items.select(id_col, F.posexplode(T.sentences(doc)).alias("pos", "sent"))
    toks = sents.select(id_col, "pos", F.explode(rouge_tokens("sent")).alias("term"))
    # Where a term stands travels with its frequency, so the tokens themselves are shuffled once.
    tf = toks.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"), F.collect_list("pos").alias("at"))
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_items = items.agg(F.count(F.lit(1)).alias("n_items"))
    idf = dfreq.join(F.broadcast(n_items), how="inner", on=F.lit(True)).select(
        "term", (F.log(F.col("n_items") / F.col("df")) + 1).alias("idf"))
    w = tf.join(idf, "term").select(id_col, F.explode("at").alias("pos"), (F.col("tf") * F.col("idf")).alias("weight"))
    per = w.groupBy(id_col, "pos").agg(F.avg("weight").alias("score"))
    return (sents.join(per, [id_col, "pos"], "left")
            .select(id_col, "pos", "sent", F.round(F.coalesce("score", F.lit(0.0)), SCORE_DECIMALS).alias("score")))


def extractive(items: DataFrame, id_col: str = "cluster_id", doc: str = "multi_doc_input",
               budget: int = SUMMARY_MAX_TOKENS, headline_max: int = HEADLINE_MAX_TOKENS) -> DataFrame:
    """``generated_headline`` (first sentence) and ``generated_summary``.

    Summary: sentences ranked by score (ties: earlier first); whole sentences
    are kept while the running word count fits ``budget``, the first that
    overflows is cut to the remainder, later ones are dropped; the kept
    sentences are joined in document order.
    """
    # Sentences, document frequencies and headlines all read the items: they are written once.
    items = cut_lineage(items.select(id_col, doc))
    sc = sentence_scores(items, id_col, doc).withColumn("_toks", T.word_tokens("sent"))
    sc = sc.withColumn("_n", F.size("_toks").cast("long")).where(F.col("_n") > 0)
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("pos").asc())
    prior = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sc = sc.withColumn("_p", prior).where(F.col("_p") < budget)
    piece = F.when(F.col("_p") + F.col("_n") <= budget, F.col("sent")).otherwise(
        F.array_join(F.slice("_toks", F.lit(1), (F.lit(budget) - F.col("_p")).cast("int")), " "))
    summ = sc.withColumn("_piece", piece).groupBy(id_col).agg(
        T.ordered_concat("_piece", "pos", " ").alias("generated_summary"))
    head = items.select(id_col, first_words(T.first_sentence(doc), headline_max).alias("generated_headline"))
    return head.join(summ, id_col, "left").select(
        id_col, T.strip_ws("generated_headline").alias("generated_headline"),
        T.strip_ws(F.coalesce("generated_summary", F.lit(""))).alias("generated_summary"))


# ---- pluggable batch generation (J6) -------------------------------------------

def lead_generator(max_tokens: int) -> Hook:
    """Model-free stand-in: first sentence, then its first ``max_tokens`` words."""
    return Hook(column=_lead, options=(("max_tokens", max_tokens),))


def _lead(text: Column, max_tokens: int) -> Column:
    return first_words(T.first_sentence(text), max_tokens)


register_hook("generator", "lead-headline", lead_generator(HEADLINE_MAX_TOKENS))
register_hook("generator", "lead-summary", lead_generator(SUMMARY_MAX_TOKENS))


def two_stage(items: DataFrame, headline: Hook, summary: Hook, separator: str = STAGE2_SEPARATOR,
              doc: str = "multi_doc_input") -> DataFrame:
    """Stage 1 headline from the input; stage 2 summary from headline + sep + input."""
    first = apply_hook(items, headline, doc, "_h_raw")
    second = apply_hook(first.withColumn("_s2_in", F.concat(F.coalesce("_h_raw", F.lit("")), F.lit(separator), F.col(doc))), summary, "_s2_in", "_s_raw")
    return (second.withColumn("generated_headline", T.strip_ws("_h_raw"))
            .withColumn("generated_summary", T.strip_ws("_s_raw"))
            .drop("_h_raw", "_s_raw", "_s2_in"))
