"""Column text functions against literal edge cases."""

import html
import re

import pytest
from pyspark.sql import functions as F

from eventlens.functions import text as T
from eventlens.operators import clean as C


def one(spark, col_fn, *values, schema=None):
    n = len(values)
    cols = [f"c{i}" for i in range(n)]
    df = spark.createDataFrame([tuple(values)], schema or ", ".join(f"{c} string" for c in cols))
    return df.select(col_fn(*[F.col(c) for c in cols]).alias("o")).first()["o"]


@pytest.mark.parametrize("raw, want", [
    (None, ""), ("", ""), ("Hello world… [+123 chars]", "Hello world"),
    ("Hello... [+5 chars]", "Hello..."), ("abc [+1 char]  ", "abc"), ("no marker ", "no marker"),
])
def test_strip_truncation(spark, raw, want):
    assert one(spark, T.strip_truncation_marker, raw) == want


def test_unescape_before_tags(spark):
    # &lt;b&gt; becomes a tag and is then removed by the tag stripper
    assert one(spark, T.normalize_text, "a &lt;b&gt;bold&lt;/b&gt; &amp; c") == "a bold & c"
    assert one(spark, T.html_unescape, "&copy; &middot; &#39;x&#39; &amp;lt;") == html.unescape("&copy; &middot; &#39;x&#39; &amp;lt;")


def test_normalize_quotes_ellipsis_ws(spark):
    assert one(spark, T.normalize_text, "“Hi” it’s — ok…\r\n next word") == "\"Hi\" it's - ok... next word"
    assert one(spark, T.normalize_text, None) == ""


@pytest.mark.parametrize("title, src, want", [
    ("Big news - Reuters", "Reuters", "Big news"),
    ("Big news | reuters", "Reuters ", "Big news"),
    ("Big news - Reuters", None, "Big news - Reuters"),
    ("Reuters", "Reuters", "Reuters"),
    (" - Reuters", "Reuters", ""),
    ("Big news - AP", "Reuters", "Big news - AP"),
])
def test_title_suffix(spark, title, src, want):
    assert one(spark, T.strip_title_suffix, title, src) == want


def test_assemble(spark):
    assert one(spark, T.assemble_text, "Title...", "Desc here", "desc here and more") == "Title. desc here and more"
    assert one(spark, T.assemble_text, "T", "D", "C") == "T. D C"
    assert one(spark, T.assemble_text, "", "", "only content") == "only content"


@pytest.mark.parametrize("s, n", [(None, 0), ("", 0), ("   ", 0), (" a  b\n c\x1d d e ", 5)])
def test_word_count(spark, s, n):
    assert one(spark, T.word_count, s) == n == (len(s.split()) if s else 0)


def test_paywall(spark):
    assert one(spark, T.is_paywall_preview, "Subscribe for unlimited access today") is True
    assert one(spark, T.is_paywall_preview, " ".join(["word"] * 50) + " subscribe") is False
    assert one(spark, T.is_paywall_preview, "plain short text") is False


def test_sentence_split_and_first(spark):
    s = "The U.S. Army moved. Then 3 more came! 'Quoted' end?  lower case. Next"
    py = [x.strip() for x in re.split(r"(?<=[.!?])\s+(?=[A-Z0-9\"'])", s.strip()) if x.strip()]
    assert one(spark, T.sentence_split, s) == "\n".join(py)
    assert one(spark, T.first_sentence, s) == py[0] == "The U.S."


def test_dateline_and_headline(spark):
    assert one(spark, T.strip_dateline, "LONDON, England (CNN) -- Something happened. More.") == "Something happened."
    assert one(spark, T.derive_headline, "\nsecond") == ""
    assert one(spark, T.derive_headline, "first bullet , here .\nsecond") == "first bullet, here."
    assert one(spark, T.derive_summary_target, "a .\nb !") == "a. b!"


def test_clean_word_boundary(spark):
    """19 words are dropped, 20 kept (title adds one word + a period)."""
    def raw(n_words):
        return ("x", None, "T", None, " ".join(["w"] * n_words), "u", "2024", "c")
    schema = ("url_id string, author string, title string, description string, content string, "
              "url string, publishedAt string, category string")
    df = spark.createDataFrame([raw(18), raw(19)], schema).withColumn(
        "source", F.struct(F.lit(None).cast("string").alias("id"), F.lit("S").alias("name")))
    out = C.clean_articles(df, keep_order=False).collect()
    assert [r["word_count"] for r in out] == [20]


def test_group_separator_literal(spark):
    from eventlens.operators.groups import clean_summary, split_articles
    assert one(spark, split_articles, "a|||||b||||||c|||||  |||||") == ["a", "b", "|c"]
    assert one(spark, clean_summary, "  – text  ") == "text  "
