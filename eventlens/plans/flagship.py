"""Flagship: live articles -> first-URL dedup -> clean -> event inputs -> summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlens.operators import clean as C
from eventlens.operators import groups as G
from eventlens.operators import summarize as SU
from eventlens.sources import fixtures as FX


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lazy plan: F1 -> B11 -> D1 -> F2/F3 (J5) -> J7."""
    articles = C.clean_unique(FX.raw_articles(spark, sf_dir))
    labelled = G.attach_labels(articles, FX.vectors(spark, sf_dir).select("id", "label"))
    items = G.live_inputs(labelled, G.MAX_INPUT_TOKENS)
    generated = SU.extractive(items)
    return items.join(generated, "cluster_id").select(
        "cluster_id", "source", "n_articles", "multi_doc_input", "generated_headline", "generated_summary")
