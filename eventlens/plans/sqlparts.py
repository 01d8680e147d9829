"""DuckDB expression builders for the oracle side of each query.

These spell the reference semantics in plain SQL (RE2 regexes, no
lookaround, no HTML decoder) so the driver can check the Spark results
against an independent engine.  Whitespace classes are written out.
"""

from __future__ import annotations

WS = r"[ \t\n\r\x0b\x0c]"


def coalesce_empty(x: str) -> str:
    return f"coalesce({x}, '')"


def rstrip(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+$', '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def unescape(x: str) -> str:
    """Entities present in the fixtures; ``&amp;`` last (single-pass decode)."""
    out = x
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                    ("&copy;", "©"), ("&middot;", "·")):
        out = f"replace({out}, '{ent}', '{ch}')"
    return f"replace({out}, '&amp;', '&')"


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


def ascii_quotes(x: str) -> str:
    return f"translate({x}, '‘’“”–—', '''''\"\"--')"


def collapse_text(x: str) -> str:
    return collapse(f"replace({x}, '…', '...')")


def normalize(x: str) -> str:
    return collapse_text(ascii_quotes(strip_tags(unescape(coalesce_empty(x)))))


def strip_truncation(x: str) -> str:
    return rstrip(f"regexp_replace({coalesce_empty(x)}, '{WS}*…?{WS}*\\[\\+[0-9]+{WS}*chars?\\]{WS}*$', '')")


def title_suffix(t: str, s: str) -> str:
    src = f"lower({strip(s)})"
    tr = rstrip(t)
    arms = []
    for sep in (" - ", " — ", " | "):
        suf = f"('{sep}' || {src})"
        arms.append(f"WHEN ends_with(lower({tr}), {suf}) THEN {rstrip(f'left({tr}, length({tr}) - length({suf}))')}")
    return (f"CASE WHEN {t} IS NULL OR {t} = '' OR {s} IS NULL OR {s} = '' THEN {t} "
            f"ELSE CASE {' '.join(arms)} ELSE {tr} END END")


def assemble(t: str, d: str, c: str) -> str:
    t_part = f"CASE WHEN {t} <> '' THEN rtrim({t}, '.') || '.' END"
    rep = f"({c} <> '' AND starts_with(lower({c}), left(lower({d}), 60)))"
    d_part = f"CASE WHEN {d} <> '' AND NOT coalesce({rep}, false) THEN {d} END"
    c_part = f"CASE WHEN {c} <> '' THEN {c} END"
    return strip(f"concat_ws(' ', {t_part}, {d_part}, {c_part})")


def tokens(x: str) -> str:
    return f"list_filter(string_split_regex({coalesce_empty(x)}, '{WS}+'), lambda w: w <> '')"


def word_count(x: str) -> str:
    return f"CAST(len({tokens(x)}) AS INTEGER)"


# The same paywall keywords as eventlens.functions.text, spelled out so that the oracle does not import the code it checks.
PAYWALL = ("per month", "subscribe", "sign in", "cancel anytime", "unlimited access",
           "complete digital access", "start your free trial")


def paywall(x: str) -> str:
    hits = " OR ".join(f"contains(lower({x}), '{k}')" for k in PAYWALL)
    return f"({coalesce_empty(x)} <> '' AND ({hits}) AND {word_count(x)} < 50)"


def punct_spacing(x: str) -> str:
    return collapse(f"regexp_replace({x}, '{WS}+([.!?,:;])', '\\1', 'g')")


def headline(h: str) -> str:
    return punct_spacing(f"split_part({coalesce_empty(h)}, chr(10), 1)")


def summary_target(h: str) -> str:
    return punct_spacing(f"replace({coalesce_empty(h)}, chr(10), ' ')")


# Sentence boundary without lookaround: mark ``[.!?] ws+ [A-Z0-9"']`` with a
# control character, then split on it (the two classes are disjoint).
def sentences(x: str) -> str:
    marked = f"regexp_replace({strip(coalesce_empty(x))}, '([.!?]){WS}+([A-Z0-9\"''])', '\\1\x01\\2', 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"


def sentence_split(x: str) -> str:
    return f"array_to_string({sentences(x)}, chr(10))"


def first_sentence(x: str) -> str:
    marked = f"regexp_replace({strip(coalesce_empty(x))}, '([.!?]){WS}+([A-Z0-9\"''])', '\\1\x01\\2')"
    return strip(f"split_part({marked}, chr(1), 1)")


def strip_dateline(x: str) -> str:
    pat = f"^{WS}*(?:[A-Z][A-Za-z .,''\\-]{{1,40}})?\\(CNN\\){WS}*--{WS}*"
    return strip(f"regexp_replace({first_sentence(x)}, '{pat}', '')")
