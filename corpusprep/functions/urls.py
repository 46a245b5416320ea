"""Dictionary URL handling (X7, X8) and API payload parsing (X9, X10), as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import q
from .tokens import py_strip, py_strip_sql

# Fixed value: the payload is a JSON array of objects with an optional "meaning".
PAYLOAD_SCHEMA = "array<struct<meaning:string>>"
QUOTED = '"([^"]*)"'
# Neutral defaults; pass the real endpoints when running against a dictionary service.
RAW_BASE = "https://dictionary.example/dictionary?"
API_BASE = "https://dictionary.example/api/words?query="


def param_value(url: Column, param: str) -> Column:
    """``url.split(param)[1]``: the text between the first and second occurrence of ``param``."""
    return F.substring_index(F.substring_index(url, param, 2), param, -1)


def param_value_sql(url: str, param: str) -> str:
    return f"split_part({url}, {q(param)}, 2)"


def unquote(c: Column) -> Column:
    """Percent-decoding that keeps '+' (Python ``unquote``): valid escapes are decoded, a '%' that starts
    none stays."""
    plain = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(plain), c)


def unquote_sql(e: str) -> str:
    return f"url_decode({e})"


def quote(c: Column) -> Column:
    """Python ``quote(s, safe='/')`` from the form encoder: space → %20, keep '/' and '~'."""
    e = F.url_encode(c)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return e


def quote_sql(e: str) -> str:
    return f"replace(url_encode({e}), '%2F', '/')"


def dictionary_urls(url: Column, param: str, name: str, raw_base: str = RAW_BASE, api_base: str = API_BASE):
    """(lemma, raw_url, api_url) for a lexicon URL carrying ``param``."""
    lemma = unquote(param_value(url, param))
    part = F.concat(F.lit(f"{name}="), quote(lemma))
    return lemma, F.concat(F.lit(raw_base), part), F.concat(F.lit(api_base), quote(part))


def dictionary_urls_sql(url: str, param: str, name: str, raw_base: str = RAW_BASE, api_base: str = API_BASE):
    lemma = unquote_sql(param_value_sql(url, param))
    part = f"({q(name + '=')} || {quote_sql(lemma)})"
    return lemma, f"({q(raw_base)} || {part})", f"({q(api_base)} || {quote_sql(part)})"


def _one_meaning(m: Column) -> Column:
    quoted = F.regexp_extract_all(m, F.lit(QUOTED), 1)
    t = F.when(F.size(quoted) > 0, F.array_join(quoted, ", ")).otherwise(F.replace(m, F.lit('"'), F.lit("")))
    for a, b in (("\\[", "["), ("\\]", "]"), ("\\<", "<")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return py_strip(t)


def meanings_text(payload: Column) -> Column:
    """Non-empty meanings; quoted parts joined ', ' (else quotes dropped); unescape
    ``\\[ \\] \\<``; strip; items joined '; '."""
    items = F.from_json(payload, PAYLOAD_SCHEMA)
    ms = F.filter(F.transform(items, lambda it: it["meaning"]), lambda m: m.isNotNull() & (m != ""))
    return F.array_join(F.transform(ms, _one_meaning), "; ")


def meanings_text_sql(meanings_list: str) -> str:
    one = (f"CASE WHEN len(regexp_extract_all(m_, {q(QUOTED)}, 1)) > 0 THEN array_to_string(regexp_extract_all(m_, {q(QUOTED)}, 1), ', ') "
           f"ELSE replace(m_, '\"', '') END")
    for a, b in (("\\[", "["), ("\\]", "]"), ("\\<", "<")):
        one = f"replace({one}, {q(a)}, {q(b)})"
    one = py_strip_sql(one)
    return f"array_to_string(list_transform(list_filter({meanings_list}, lambda m_: m_ IS NOT NULL AND m_ <> ''), lambda m_: {one}), '; ')"
