"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.sources.tables import read_table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm.quality import quality_rules
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm.suffix import dedup_passages
    return dedup_passages(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.to_json("spans").alias("spans"), F.sha2("text", 256).alias("text_sha256"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm import lm_score
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.score_corpus(lm_score.with_target(docs, read_table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm import lattice
    done = lattice.encode(read_table(spark, sf_dir, "documents"), with_text=False)
    # A null text has no ids, which is its exact form too.
    return done.select(F.col("id").alias("doc_id"), "n_tokens", "ids", F.coalesce("exact", F.lit(True)).alias("exact"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm.decontaminate import contamination
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    doc_id = F.when(F.col("id") != -(2**63), F.col("id"))  # the operator's mark of a null id
    return found.select(doc_id.alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def _fold(parts: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm import toxicity
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    index = toxicity.fit(docs, labels.where(_fold(5) != 0))
    return toxicity.score_toxicity(docs, index).select("doc_id", (_fold(5) == 0).alias("held_out"), "score", "predicted", "evidence")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm.jaccard import jaccard_join
    return jaccard_join(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "n_links", "class_size")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm import langid
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(_fold(4) != 2))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm.chat import format_chats, read_back
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return read_back(format_chats(turns.unionByName(more)))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm.substring import dedup_substrings
    return dedup_substrings(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm.simhash import simhash_components
    return simhash_components(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _repeat_tail(text: pa.Array, h: pa.Array) -> pa.Array:
    """Input of operator 12: from word g % n on, every word repeats those of the first p, where g = h // 10."""
    out = []
    for t, x in zip(text.to_pylist(), h.to_pylist()):
        words = (t or "").encode().split()
        if words:
            n, g = len(words), x // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]
        out.append(b" ".join(words).decode())
    return pa.array(out, pa.string())


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents with the periodic tails that the contract of operator 12 plants, where crc32 of the id ends in 0."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"))
    chosen = F.col("h") % 10 == 0
    # Only chosen texts go to Python; the rest stay as they are.
    tail = arrow_udf(_repeat_tail, "string")(F.when(chosen, F.col("text")), "h")
    return rows.withColumn("tail", tail).select("doc_id", F.when(chosen, F.col("tail")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm.squares import periodic_runs
    docs = with_periods(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return periodic_runs(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), lines.alias("lines"), "collapsed").select(
        "doc_id", "n_runs", F.col("top.s").alias("start"), (-F.col("top.l")).alias("length"), F.col("top.p").alias("period"),
        F.floor(-1000 * F.col("top.l") / F.col("top.p")).alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") == 0, "").otherwise(F.concat(F.array_join("lines", "\n"), F.lit("\n"))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.llm import codebook
    from eventlens.session import cut_lineage
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    model = codebook.train(vectors)
    coded = cut_lineage(codebook.compress(vectors, model).select("vec_id", "label", "code", "error"))
    return codebook.group_error(coded).select("vec_id", "code", "error", "label_error", F.lit(model.sha256()).alias("codebooks_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_suffix_dedup, op3_lm_scoring, op4_sentencepiece, op5_decontaminate, op6_toxicity,
                                 op7_jaccard_join, op8_language_id, op9_chat_formatting, op10_substring_dedup,
                                 op11_simhash_dedup, op12_periodic_runs, op13_vector_codes, pipeline)}

_OP1 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
spans AS (SELECT doc_id, unnest(range(1, greatest(1, len(words) - 3))) AS i, words FROM w),
grams AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM spans),
marked AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
steps AS (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS s FROM marked),
rep AS (SELECT doc_id, sum(s)::BIGINT AS n FROM steps GROUP BY doc_id),
c AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             len(lines) AS n_lines, len(list_filter(words, lambda x: list_contains([{stop}], lower(x)))) AS n_stop,
             length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS n_letters, length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
             length(text) - length(replace(text, '!', '')) AS n_bang
      FROM w LEFT JOIN rep USING (doc_id)),
v AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND NOT (n_words >= 1 AND (100 * word_chars < 200 * n_words OR 100 * word_chars > 1500 * n_words))
        AND NOT (word_chars >= 1 AND 100 * n_symbols > 10 * word_chars) AND NOT (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)
        AND NOT (n_words >= 50 AND 100 * n_stop < 2 * n_words) AND NOT (n_letters >= 50 AND 100 * n_upper > 60 * n_letters)
        AND NOT (n_words >= 20 AND 100 * n_bang > 50 * n_words)) AS kept
FROM v"""


def _op1_sql() -> str:
    from eventlens.llm.quality import STOP_WORDS
    return _OP1.format(stop=", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS))))


ORACLES: dict[str, str] = {"op1_quality_rules": _op1_sql()}
