"""Operator 10: substring dedup by super-k-mer partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import segments as S

WINDOW = 20
GRAM = 4


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Remove every word covered by a window of ``window`` words whose sequence also starts earlier.

    Earlier: in a document with a smaller id, or further left in the same one;
    windows are judged on the input.  Words are runs of anything but space and
    \\t \\n \\v \\f \\r.  Consecutive windows that share a minimiser travel as one
    packed string to its bucket, where all windows are sorted and runs of equal
    ones (confirmed on the bytes) keep only their first occurrence.

    Returns the input columns, with ``n_words``, ``n_removed`` and ``kept_text``
    (kept words joined by one space) added; columns of these names are replaced.

    Defined results: null or empty text -> 0, 0, ''.  Texts under ``window``
    words are never touched.  A null id counts as the smallest id.  Rows that
    repeat an id and text are one document: each gets the same result and none
    removes words of another.  Rows that repeat an id with another text are
    separate documents, ordered by a hash of the text.  An empty table gives an
    empty table.
    """
    keyed = S.keyed(docs, id_col, text_col)
    hits = S.repeated_ranges(keyed, window, gram, S.repeated_by_sorting)
    out = S.remove(keyed, hits, one_space=True)
    own = ("n_words", "n_removed", "kept_text")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in own],
                      F.col("cut.n_words").alias("n_words"), F.col("cut.n_removed").alias("n_removed"),
                      F.col("cut.text").alias("kept_text"))
