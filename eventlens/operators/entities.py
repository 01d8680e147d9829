"""Entity extraction, ranking, and event cards.

No statistical NER model is available offline, so extraction is dictionary
plus pattern based (our documented choice): text is cut into whitespace
tokens with character offsets, a trie of the dictionary's phrases is walked
along the tokens of each text inside its row, and ISO dates are found by
pattern.  "Low confidence" has no defined threshold in the reference; we
read it as a minimum mention count.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# ---- fixed values -------------------------------------------------------------
ENTITY_TYPES = ("PERSON", "ORG", "GPE", "DATE", "EVENT")
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"
TRAILING_PUNCT = ".,;:!?)]\"'"
# -------------------------------------------------------------------------------

#: Dictionary rows that every worker may hold as a trie; a larger dictionary is joined instead.
TRIE_PHRASES = 200_000

MENTIONS = "array<struct<text:string,label:string,start:int,end:int>>"
_TOKEN = re.compile(r"\S+", re.ASCII)
_DATE = re.compile(DATE_PATTERN, re.ASCII)
_END = ""  # no word is empty, so the empty key holds a phrase's labels


def tokens(text: str) -> list[tuple[str, int]]:
    """Whitespace tokens without trailing punctuation, and their 0-based start; empty ones are left out."""
    out = []
    for m in _TOKEN.finditer(text):
        word = m.group().rstrip(TRAILING_PUNCT)
        if word:
            out.append((word, m.start()))
    return out


def phrase_trie(rows) -> dict:
    """Nested word tables of ``(phrase, label)`` rows; the labels of a phrase stand under the empty word."""
    root: dict = {}
    for phrase, label in rows:
        words = phrase.split(" ")
        if not all(words):
            continue  # words of a match are joined by single spaces, so such a phrase never occurs
        node = root
        for w in words:
            node = node.setdefault(w, {})
        node.setdefault(_END, set()).add(label)
    return root


def mentions(text: str, trie: dict) -> list[tuple[str, str, int, int]]:
    """Every dictionary phrase, nested and overlapping ones too, and every ISO date: text, label, start, end."""
    words = tokens(text)
    out = []
    for i, (word, start) in enumerate(words):
        node = trie.get(word)
        j = i
        while node is not None:
            if _END in node:
                end = words[j][1] + len(words[j][0])
                phrase = " ".join(w for w, _ in words[i:j + 1])
                out += [(phrase, label, start, end) for label in sorted(node[_END])]
            j += 1
            node = node.get(words[j][0]) if j < len(words) else None
        if len(word) == 10 and _DATE.fullmatch(word):
            out.append((word, "DATE", start, start + 10))
    return out


def _lists(rows: list[list[tuple]]) -> pa.Array:
    """Lists of mentions as one Arrow column."""
    flat = [m for r in rows for m in r]
    ends = [0]
    for r in rows:
        ends.append(ends[-1] + len(r))
    cols = list(zip(*flat)) if flat else [(), (), (), ()]
    fields = [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.int32()))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["text", "label", "start", "end"]))


def _by_trie(trie, text: Column) -> Column:
    def run(column: pa.Array) -> pa.Array:
        return _lists([mentions(t, trie.value) if t else [] for t in column.to_pylist()])
    return arrow_udf(run, MENTIONS)(text)


def _token_lists(column: pa.Array) -> pa.Array:
    return _lists([[(w, "", s, s + len(w)) for w, s in tokens(t)] if t else [] for t in column.to_pylist()])


def _by_join(df: DataFrame, dictionary: DataFrame, id_col: str, text: str) -> DataFrame:
    """Mentions by a join of word runs with a dictionary too large to hold; only run lengths that occur in it."""
    lengths = sorted(r[0] for r in dictionary.select(F.size(F.split("phrase", " ")).alias("n")).distinct().collect())
    toks = df.select(id_col, arrow_udf(_token_lists, MENTIONS)(F.col(text)).alias("t"))
    runs = None
    for n in lengths:
        at = F.when(F.size("t") >= n, F.sequence(F.lit(1), F.size("t") - (n - 1))).otherwise(F.array().cast("array<int>"))
        own = toks.select(id_col, F.explode(F.transform(at, lambda i: F.struct(  # noqa: B023 - used before n changes
            F.array_join(F.transform(F.slice("t", i, F.lit(n)), lambda e: e["text"]), " ").alias("phrase"),
            F.element_at("t", i)["start"].alias("start"), F.element_at("t", i + F.lit(n - 1))["end"].alias("end")))).alias("r"))
        runs = own if runs is None else runs.unionByName(own)
    found = runs.select(id_col, "r.*").join(dictionary, "phrase").select(id_col, F.col("phrase").alias("text"), "label", "start", "end")
    dates = toks.select(id_col, F.explode("t").alias("m")).select(id_col, "m.*").where(F.col("text").rlike(f"^{DATE_PATTERN}$")) \
                .withColumn("label", F.lit("DATE"))
    return found.unionByName(dates)


def with_entities(df: DataFrame, gazetteer: DataFrame, text: str = "text", types: tuple | None = ENTITY_TYPES,
                  name: str = "entities") -> DataFrame:
    """Add the mentions of each text as an array, for dictionaries of ``TRIE_PHRASES`` rows at most (an error beyond)."""
    rows = gazetteer.where("phrase is not null and label is not null").select("phrase", "label").distinct().limit(TRIE_PHRASES + 1).collect()
    if len(rows) > TRIE_PHRASES:
        raise ValueError(f"more than {TRIE_PHRASES} phrases: use extract_entities, which joins them")
    trie = df.sparkSession.sparkContext.broadcast(phrase_trie(rows))
    found = _by_trie(trie, F.col(text))
    if types is not None:
        found = F.filter(found, lambda e: e["label"].isin(list(types)))
    return df.withColumn(name, found)


def extract_entities(df: DataFrame, gazetteer: DataFrame, id_col: str = "cluster_id", text: str = "text",
                     types: tuple | None = ENTITY_TYPES) -> DataFrame:
    """``id, text, label, start, end`` from a phrase dictionary + dates.

    ``gazetteer`` has ``phrase, label``; a phrase of any number of words matches
    where its words follow each other as tokens.  ``types`` filters labels (C7);
    ``None`` keeps every type.  The dictionary's size is checked: up to
    ``TRIE_PHRASES`` rows it goes to the workers as a trie and nothing is
    shuffled; beyond, the word runs of each text are joined with it.  Both give
    the same rows.  Null texts have no entities.
    """
    dictionary = gazetteer.where("phrase is not null and label is not null").select("phrase", "label").distinct()
    if dictionary.limit(TRIE_PHRASES + 1).count() > TRIE_PHRASES:
        out = _by_join(df, dictionary, id_col, text)
        return out if types is None else out.where(F.col("label").isin(list(types)))
    rows = with_entities(df.select(id_col, text), dictionary, text, types, "_m")
    return rows.select(id_col, F.explode("_m").alias("_m")).select(id_col, "_m.*")


def count_entities(entities: DataFrame) -> DataFrame:
    """Mentions per (text, label), most frequent first."""
    return (entities.groupBy("text", "label").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), "text", "label"))


def rank_entities(entities: DataFrame, id_col: str = "cluster_id", min_count: int = 1,
                  top: int | None = None) -> DataFrame:
    """per cluster, pooled mentions counted and ranked (count desc, text, label)."""
    c = entities.groupBy(id_col, "text", "label").agg(F.count(F.lit(1)).alias("count")) \
        .where(F.col("count") >= min_count)
    w = Window.partitionBy(id_col).orderBy(F.col("count").desc(), "text", "label")
    r = c.withColumn("rank", F.row_number().over(w))
    return r.where(F.col("rank") <= top) if top else r


def highlight(text_col, entities_col):
    """Wrap mentions in ``<span class="ent ent-LABEL">`` by their offsets.

    Of mentions that overlap, the one that starts first counts, then the longer
    one, then the lesser label; mentions that are null or reach outside the text
    are left out.  The text is cut at the chosen offsets and joined once, so
    markup is never searched and a name equal to a markup word does no harm.
    """
    size = F.length(text_col)
    valid = F.filter(F.coalesce(entities_col, F.array().cast(MENTIONS)),
                     lambda e: F.coalesce((e["start"] >= 0) & (e["end"] > e["start"]) & (e["end"] <= size), F.lit(False)))
    # Plain struct order: start, then the longest, then the label.
    ordered = F.array_sort(F.transform(valid, lambda e: F.struct(e["start"].alias("start"), (-e["end"]).alias("back"), e["label"].alias("label"))))
    start = F.struct(F.lit(0).alias("last"), F.array().cast("array<struct<start:int,back:int,label:string>>").alias("kept"))
    kept = F.aggregate(ordered, start, lambda acc, e: F.when(e["start"] >= acc["last"], F.struct(
        (-e["back"]).alias("last"), F.array_append(acc["kept"], e).alias("kept"))).otherwise(acc))["kept"]

    def html(found):
        def piece(e, i):
            before = F.when(i == 0, F.lit(0)).otherwise(-F.get(found, i - 1)["back"])
            return F.concat(F.substring(text_col, before + 1, e["start"] - before), F.lit('<span class="ent ent-'), e["label"], F.lit('">'),
                            F.substring(text_col, e["start"] + 1, -e["back"] - e["start"]), F.lit("</span>"))
        last = F.when(F.size(found) == 0, F.lit(0)).otherwise(-F.get(found, F.size(found) - 1)["back"])
        return F.concat(F.array_join(F.transform(found, piece), ""), F.substring(text_col, last + 1, size))

    # A one-element array binds the chosen mentions, so they are worked out once.
    return F.element_at(F.transform(F.array(kept), html), 1)


def build_cards(summaries: DataFrame, ranked: DataFrame, sources: DataFrame, id_col: str = "cluster_id",
                top: int | None = None) -> DataFrame:
    """J19 + D3: headline, summary, top entities and sources per event.

    ``top`` cuts the entity lists by rank; by default all of an event's distinct
    entities and source names are listed.
    """
    ents = (ranked if top is None else ranked.where(F.col("rank") <= top)).groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("rank", "text", "label", "count"))).alias("entities"))
    srcs = sources.groupBy(id_col).agg(F.array_sort(F.collect_set("source")).alias("sources"))
    return (summaries.join(ents, id_col, "left").join(srcs, id_col, "left")
            .select(id_col, "headline", "summary",
                    F.coalesce("entities", F.array().cast("array<struct<rank:int,text:string,label:string,count:bigint>>"))
                    .alias("entities"),
                    F.coalesce("sources", F.array().cast("array<string>")).alias("sources")))


def filter_cards(cards: DataFrame, category: str | None = None, source: str | None = None,
                 date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Cards whose articles match category / source / published range (our contract)."""
    cond = F.lit(True)
    if category is not None:
        cond = cond & F.array_contains("categories", category)
    if source is not None:
        cond = cond & F.array_contains("sources", source)
    if date_from is not None:
        cond = cond & (F.col("last_published") >= date_from)
    if date_to is not None:
        cond = cond & (F.col("first_published") <= date_to)
    return cards.where(cond)
