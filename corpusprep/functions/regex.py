"""Regex building blocks that behave like Python's Unicode ``re`` classes on both engines.

Spark uses java.util.regex, the DuckDB oracle uses RE2. Neither engine's ``\\w``, ``\\s`` or
``\\b`` agrees with Python's Unicode semantics, so every rule is written with the explicit
classes below. Java patterns use lookarounds for word boundaries; RE2 has none, so its
renderings capture the neighbouring character instead (``(^|[^W])x($|[^W])``).
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``\w`` is letters, numbers and underscore (no combining marks);
# Python's ``\s`` / ``str.isspace`` is the Unicode White_Space set plus U+001C..U+001F.
WORD = r"\p{L}\p{N}_"
SPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
DIGIT = r"\p{Nd}"

W = f"[{WORD}]"
NW = f"[^{WORD}]"
S = f"[{SPACE}]"
# The same set for Java alone: one property instead of ten ranges that are tried one by one.
JS = r"[\p{IsWhite_Space}\x1c-\x1f]"
# A stretch of word characters and dots from its first digit on, with the word character before it and with
# what a '+' joins to it: no number, letter or fraction sign outside touches a digit inside.
DIGITS_J = f"(?:{DIGIT}|{W}(?={DIGIT}))[{WORD}.]*+(?:{JS}*+\\+{JS}*+{DIGIT}[{WORD}.]*+)*+"


def _decimal_digit_table() -> tuple[str, str]:
    """All BMP decimal digits (category Nd) and their ASCII values, built from the Unicode data.

    Python's ``int``/``float`` accept any Nd digit; Spark's casts accept ASCII only, so digits
    are mapped to ASCII before a numeric cast.
    """
    src, dst = [], []
    for cp in range(0x80, 0x10000):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.digit(ch)))
    return "".join(src), "".join(dst)


ND_SRC, ND_DST = _decimal_digit_table()


def ascii_digits(c: Column) -> Column:
    return F.translate(c, ND_SRC, ND_DST)


def ascii_digits_sql(e: str) -> str:
    return f"translate({e}, {q(ND_SRC)}, {q(ND_DST)})"


def q(s: str) -> str:
    """SQL string literal (DuckDB standard strings: backslashes are literal)."""
    return "'" + s.replace("'", "''") + "'"


def bound(value: Column, fn) -> Column:
    """``fn(value)`` with the value evaluated once, however often ``fn`` reads it: inside a lambda or a branch Spark
    evaluates a repeated expression anew each time."""
    return F.get(F.transform(F.array(value), lambda v: fn(v)), F.lit(0))


MARK = "\u0001"


def sub_with(c: Column, pattern: str, fn) -> Column:
    """``re.sub(pattern, fn, text)`` as native columns (no Python UDF).

    Fast path: ``regexp_replace`` wraps every match in U+0001 marks, a single-character
    ``split`` (no regex compile) cuts the text, and odd positions are the matches, so ``fn`` is
    applied to them. Texts that already contain U+0001 take the exact path instead: regex
    ``split`` (text between matches) zipped with ``regexp_extract_all`` (the matches), which find
    the same matches in the same order. A text without a match stays as it is. ``c`` is referenced more
    than once: callers bind it first (a rule with ``stage=True``).
    """
    marked = F.regexp_replace(c, pattern, f"{MARK}$0{MARK}")
    fast = F.array_join(
        F.transform(F.split(marked, MARK), lambda p, i: F.when(i % 2 == 1, fn(p)).otherwise(p)), "")
    parts = F.split(c, pattern)
    matches = F.regexp_extract_all(c, F.lit(pattern), 0)
    exact = F.array_join(
        F.zip_with(parts, matches, lambda p, m: F.concat(p, F.when(m.isNull(), F.lit("")).otherwise(fn(m)))), "")
    return F.when(~c.rlike(pattern), c).when(F.instr(c, MARK) == 0, fast).otherwise(exact)


def sub_with_long(c: Column, pattern: str, fn) -> Column:
    """:func:`sub_with` for an ``fn`` of many steps: it stands once in the expression, whose two paths only cut the
    text (with U+0001 in it, into the texts between matches interleaved with the matches), so plans stay small."""
    marked = F.regexp_replace(c, pattern, f"{MARK}$0{MARK}")
    exact = F.flatten(F.zip_with(F.split(c, pattern), F.regexp_extract_all(c, F.lit(pattern), 0), lambda p, m: F.array(p, m)))
    parts = F.when(F.instr(c, MARK) == 0, F.split(marked, MARK)).otherwise(exact)
    changed = F.transform(parts, lambda p, i: F.when((i % 2 == 1) & p.isNotNull(), fn(p)).otherwise(p))
    return F.when(c.rlike(pattern), F.array_join(changed, "")).otherwise(c)


def sub_with_sql(e: str, pattern: str, fn_sql, next_aware: bool = False) -> str:
    """DuckDB rendering of :func:`sub_with`; ``fn_sql(match[, next_part])`` maps SQL to SQL.

    ``e`` must be a plain column reference (the caller binds it in its own stage).
    """
    p = q(pattern)
    parts = f"regexp_split_to_array({e}, {p})"
    ms = f"regexp_extract_all({e}, {p}, 0)"
    if next_aware:
        z = f"list_zip({parts}, {ms}, {parts}[2:])"
        body = f"CASE WHEN z_[2] IS NULL THEN '' ELSE {fn_sql('z_[2]', 'z_[3]')} END"
    else:
        z = f"list_zip({parts}, {ms})"
        body = f"CASE WHEN z_[2] IS NULL THEN '' ELSE {fn_sql('z_[2]')} END"
    return (
        f"(CASE WHEN regexp_matches({e}, {p}) THEN array_to_string(list_transform({z}, "
        f"lambda z_: z_[1] || {body}), '') ELSE {e} END)"
    )
