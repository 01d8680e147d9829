"""Scalar text functions as native Spark Column expressions.

Everything here stays inside the JVM (whole-stage codegen) except
``html_unescape``, which needs the HTML5 entity table and runs as an Arrow
UDF.  Regexes are Java regexes; ``(?U)`` makes ``\\s`` Unicode aware,
and the ``\\x1c-\\x1f`` separators are added so whitespace matches the
behaviour of Python's ``str.split()``.
"""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from eventlens.functions.stem import ROWS_HELD

# All whitespace characters of Python's ``str.isspace``, and the same set as a Java class.
WS_CHARS = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
WS = r"[\s\x1c-\x1f]"
WS_RUN = r"(?U)" + WS + "+"

# ---- fixed values (must equal the reference for identical results) --------
# Truncation marker appended by the news API free tier: an ellipsis, then ``[+N chars]``; here what follows ``[+``.
TRUNCATION_OPEN = "[+"
TRUNCATION_REST = r"(?U)^\d+" + WS + r"*chars?\]$"
# Smart punctuation folded to ASCII: left/right single quote, left/right
# double quote, en dash, em dash.
SMART_FROM = "‘’“”–—"
SMART_TO = "''\"\"--"
# Title suffix separators, tried in this order.
TITLE_SEPARATORS = (" - ", " — ", " | ")
# Paywall keywords (lower case) and the word limit under which they count.
PAYWALL_KEYWORDS = (
    "per month",
    "subscribe",
    "sign in",
    "cancel anytime",
    "unlimited access",
    "complete digital access",
    "start your free trial",
)
PAYWALL_MAX_WORDS = 50
# Sentence boundary: after . ! ? and before a capital, digit or quote.
SENTENCE_BOUNDARY = r"(?<=[.!?])" + r"(?U)" + WS + r"+(?=[A-Z0-9\"'])"
# Legacy dateline prefix removed from first sentences.
DATELINE_PREFIX = r"^" + WS + r"*(?:[A-Z][A-Za-z .,'\-]{1,40})?\(CNN\)" + WS + r"*--" + WS + r"*"
# Space before sentence punctuation (tokenisation artefact in labelled pairs).
SPACE_BEFORE_PUNCT = r"(?U)" + WS + r"+([.!?,:;])"
# -----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace."""
    return F.trim(_c(c), F.lit(WS_CHARS))


def rstrip_ws(c) -> Column:
    return F.rtrim(_c(c), F.lit(WS_CHARS))


def lstrip_ws(c) -> Column:
    return F.ltrim(_c(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """Every whitespace run becomes one space, then strip (B5 tail)."""
    return F.trim(F.regexp_replace(_c(c), WS_RUN, " "))


def strip_truncation_marker(c) -> Column:
    """B1: drop a trailing ``… [+N chars]`` marker, then right-strip; null -> ''.

    Only what follows the last ``[+`` is matched, so the cost does not grow with the text.
    """
    x = rstrip_ws(F.coalesce(_c(c), F.lit("")))
    rest = F.substring_index(x, TRUNCATION_OPEN, -1)
    size = F.length(x) - F.length(rest) - len(TRUNCATION_OPEN)  # negative where there is no opening
    head = rstrip_ws(F.left(x, size))
    cut = F.when(head.endswith("…"), rstrip_ws(F.left(head, F.length(head) - 1))).otherwise(head)
    return F.when(x.endswith("]") & (size >= 0) & rest.rlike(TRUNCATION_REST), cut).otherwise(x)


@arrow_udf(StringType())
def _html_unescape_udf(s: pa.Array) -> pa.Array:
    # Some rows are Python objects at a time, however large the batch.
    parts = [pa.array([x and html.unescape(x) for x in s.slice(i, ROWS_HELD).to_pylist()], pa.string()) for i in range(0, len(s), ROWS_HELD)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def html_unescape(c) -> Column:
    """B2: HTML5 character references (named and numeric) decoded."""
    x = _c(c)
    # Only values containing '&' are shipped to Python; every other row
    # crosses the Arrow boundary as a null and keeps its JVM value.
    return F.coalesce(_html_unescape_udf(F.when(x.contains("&"), x)), x)


def strip_tags(c) -> Column:
    """Every ``<...>`` tag becomes one space."""
    return F.regexp_replace(_c(c), r"<[^>]+>", " ")


def ascii_quotes(c) -> Column:
    """Smart quotes and dashes folded to ASCII."""
    return F.translate(_c(c), SMART_FROM, SMART_TO)


def collapse_text_ws(c) -> Column:
    """Ellipsis to three dots, line breaks and whitespace runs to one space."""
    x = F.replace(_c(c), F.lit("…"), F.lit("..."))
    return collapse_ws(x)


def normalize_text(c) -> Column:
    """Unescape -> strip tags -> ASCII quotes -> whitespace; null/'' -> ''."""
    x = F.coalesce(_c(c), F.lit(""))
    return collapse_text_ws(ascii_quotes(strip_tags(html_unescape(x))))


def strip_title_suffix(title, source) -> Column:
    """Drop a final `` - S``/`` — S``/`` | S`` naming the source (any case).

    Null/empty title or source: title unchanged.  Otherwise the title is
    right-stripped and the first separator (in the fixed order) whose
    ``sep + lower(strip(source))`` ends the lower-cased title is cut off.
    """
    t, s = _c(title), _c(source)
    tr = rstrip_ws(t)
    src = F.lower(strip_ws(s))
    lt = F.lower(tr)
    out = tr
    for sep in reversed(TITLE_SEPARATORS):  # reversed: first in list wins
        suffix = F.concat(F.lit(sep), src)
        cut = rstrip_ws(F.left(tr, F.length(tr) - F.length(suffix)))
        out = F.when(lt.endswith(suffix), cut).otherwise(out)
    no_op = t.isNull() | (t == "") | s.isNull() | (s == "")
    return F.when(no_op, t).otherwise(out)


def assemble_text(title, description, content) -> Column:
    """``title.`` + description (unless content repeats it) + content.

    The description is skipped when the lower-cased content starts with the
    first 60 characters of the lower-cased description.
    """
    t, d, c = _c(title), _c(description), _c(content)
    has_t = t.isNotNull() & (t != "")
    has_d = d.isNotNull() & (d != "")
    has_c = c.isNotNull() & (c != "")
    repeats = has_c & F.lower(c).startswith(F.left(F.lower(d), F.lit(60)))
    t_part = F.when(has_t, F.concat(F.rtrim(t, F.lit(".")), F.lit(".")))
    d_part = F.when(has_d & ~F.coalesce(repeats, F.lit(False)), d)
    c_part = F.when(has_c, c)
    return strip_ws(F.concat_ws(" ", t_part, d_part, c_part))


def word_tokens(c) -> Column:
    """Whitespace tokens (``str.split()``), never containing empty strings."""
    return F.filter(F.split(F.coalesce(_c(c), F.lit("")), WS_RUN), lambda x: x != "")


def word_count(c) -> Column:
    """Number of whitespace-separated tokens; null/'' -> 0."""
    return F.size(word_tokens(c))


def single_spaced_count(c) -> Column:
    """B9 for stripped text whose words are parted by single spaces, as B6 and B8 leave it."""
    x = _c(c)
    return F.when(F.coalesce(x, F.lit("")) == "", 0).otherwise(F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1)


def is_paywall_preview(c, words: Column | None = None) -> Column:
    """A paywall keyword present AND fewer than 50 words (``words``, counted here if not given)."""
    x = F.coalesce(_c(c), F.lit(""))
    low = F.lower(x)
    hit = F.lit(False)
    for kw in PAYWALL_KEYWORDS:
        hit = hit | low.contains(kw)
    # Few texts are that short, so the count goes first.
    return (x != "") & ((word_count(x) if words is None else words) < PAYWALL_MAX_WORDS) & hit


def normalize_punct_spacing(c) -> Column:
    """Drop whitespace before ``. ! ? , : ;``, collapse, strip."""
    x = F.regexp_replace(_c(c), SPACE_BEFORE_PUNCT, "$1")
    return collapse_ws(x)


def derive_headline(highlights) -> Column:
    """First bullet (text before the first newline), B12-normalised."""
    h = F.coalesce(_c(highlights), F.lit(""))
    return normalize_punct_spacing(F.substring_index(h, "\n", 1))


def derive_summary_target(highlights) -> Column:
    """Bullets joined into one line, B12-normalised."""
    h = F.coalesce(_c(highlights), F.lit(""))
    return normalize_punct_spacing(F.replace(h, F.lit("\n"), F.lit(" ")))


def sentences(c) -> Column:
    """B15 array form: split at sentence boundaries, strip, drop empties."""
    x = strip_ws(F.coalesce(_c(c), F.lit("")))
    parts = F.split(x, SENTENCE_BOUNDARY)
    return F.filter(F.transform(parts, strip_ws), lambda s: s != "")


def sentence_split(c) -> Column:
    """Sentences joined by a newline (ROUGE-Lsum input form)."""
    return F.array_join(sentences(c), "\n")


def first_sentence(c) -> Column:
    """Text up to the first sentence boundary, stripped; null -> ''."""
    x = strip_ws(F.coalesce(_c(c), F.lit("")))
    return strip_ws(F.element_at(F.split(x, SENTENCE_BOUNDARY, 2), 1))


def strip_dateline(c) -> Column:
    """Legacy headline = first sentence minus a ``CITY (CNN) --`` prefix."""
    return strip_ws(F.regexp_replace(first_sentence(c), DATELINE_PREFIX, ""))


def preview(c, n: int = 120) -> Column:
    """First ``n`` characters."""
    return F.left(_c(c), F.lit(n))


def ordered_concat(value, order, sep: str) -> Column:
    """Aggregate: ``value`` strings joined by ``sep`` in ``order`` order.

    Only for groups whose size is bounded by construction (a conversation's
    turns, the <= budget rows of a packed input).
    """
    pairs = F.array_sort(F.collect_list(F.struct(_c(order).alias("k"), _c(value).alias("v"))))
    return F.array_join(F.transform(pairs, lambda e: e["v"]), sep)
