"""Operator 1: quality rules as one native projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
SEPARATORS = "[\\x20\\x09-\\x0D]+"

# Function words of the four languages, counted by the stop-word rules.
STOP_WORDS = (
    "a and are as at be by for from in is it of on or that the this to was with "
    "auf das dem den der des die ein eine im in ist mit nicht sich und von zu für "
    "au avec ce dans de des du en est et la le les ne pas pour que qui sur un une "
    "al con de del el en es la las lo los no por que se su un una y").split()


@dataclass(frozen=True)
class Rule:
    """A document fails if ``numerator / denominator`` lies outside ``low..high``.

    The ratio is judged only where the denominator is at least ``least``; it is
    compared as ``100 * numerator`` against whole percents of the denominator,
    so no division or rounding is involved.
    """

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None
    least: int = 1

    def failed(self) -> Column:
        n, d = 100 * F.col(self.numerator), F.col(self.denominator)
        out = F.lit(False)
        if self.low is not None:
            out = out | (n < self.low * d)
        if self.high is not None:
            out = out | (n > self.high * d)
        return (d >= self.least) & out


#: Percent thresholds; mean word length is word_chars per word (200 % = 2 letters).
RULES = (
    Rule("short_or_long_words", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols", "n_symbols", "word_chars", high=10),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=30, least=4),
    Rule("few_stop_words", "n_stop_words", "n_words", low=2, least=50),
    Rule("upper_case", "n_upper", "n_letters", high=60, least=50),
    Rule("exclamations", "n_exclamations", "n_words", high=50, least=20),
)


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, wherever the optimiser moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def windows(words: Column) -> Column:
    """A hash of every run of five words, in order."""
    return F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))


def repeated_words(windows_: Column) -> Column:
    """Words that lie in a window found twice or more in the text, the first one included.

    Windows are sorted with their positions; equal neighbours mark positions,
    and sorted positions p count min(5, next p - p) words each.
    """
    placed = F.array_sort(F.transform(windows_, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = lambda p: F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    marked = _let(placed, lambda p: F.array_sort(F.array_distinct(F.flatten(F.filter(pairs(p), lambda x: x.isNotNull())))))
    steps = _let(marked, lambda m: F.zip_with(m, F.slice(m, 2, F.size(m)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)


def measures(text: Column) -> Column:
    """All counts of a text as one struct; words, lines and windows are made once."""
    words = F.array_remove(F.split(text, SEPARATORS), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    chars = lambda out: (F.length(text) - F.length(F.translate(text, out, ""))).cast("long")

    def counted(s: Column, w: Column) -> Column:
        # Most texts repeat no window: those skip the sort.
        repeats = F.when(F.size(F.array_distinct(w)) < F.size(w), repeated_words(w)).otherwise(F.lit(0).cast("long"))
        return F.struct(
            _size(s["words"]).alias("n_words"), F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            chars("#*$%&|<>").alias("n_symbols"), _size(s["lines"]).alias("n_lines"),
            (_size(s["lines"]) - _size(F.array_distinct(s["lines"]))).alias("n_dup_lines"), repeats.alias("n_repeat_words"),
            _size(F.filter(s["words"], lambda x: F.lower(x).isin(*sorted(set(STOP_WORDS))))).alias("n_stop_words"),
            F.length(F.regexp_replace(text, "[^\\p{L}]+", "")).cast("long").alias("n_letters"),
            F.length(F.regexp_replace(text, "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"),
            chars("!").alias("n_exclamations"))

    return _let(F.struct(words.alias("words"), lines.alias("lines")), lambda s: _let(windows(s["words"]), lambda w: counted(s, w)))


def quality_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the measures and the verdict of every rule to each document.

    Added (same names are replaced): n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words, n_stop_words, n_letters, n_upper,
    n_exclamations (long), base_failed, failed_rules (array of names), kept.

    A document is kept if it passes the base rule (10 words or more, and at most
    20 % of its words inside five-word windows that occur twice or more) and
    every rule of ``rules``.  Everything is a built-in expression in projections
    over the scan: no Python, no shuffle.  Equal windows are found by 64-bit
    hash within one document.

    Defined results: null counts as a text without words; texts without words
    have all counts 0 and fail the base rule.  Lines are split at \\n, and only
    lines with a word count.  Repeated rows, null ids and empty tables need no
    special care, as each row stands alone.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words",
           "n_letters", "n_upper", "n_exclamations", "base_failed", "failed_rules", "kept"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(row, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # A generator of one row: filters on the verdict stay above it instead of repeating the work.
    judged = base.select("row", F.explode(F.array(measures(F.col("text")))).alias("m")).select("row", "m.*")
    failed = F.filter(F.array(*[F.when(r.failed(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    judged = judged.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))) \
                   .withColumn("failed_rules", failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return judged.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in own], *own)
