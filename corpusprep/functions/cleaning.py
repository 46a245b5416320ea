"""Chains A (source transliteration) and E (target translation) as ordered rule tables.

column to a DataFrame and whose ``sql_select`` gives the DuckDB twin.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import number_chain
from .regex import JS, NW, S, SPACE, W, q
from .rules import Chain, Dead, Expr, MapChars, Regex, Replace, Translate, char_class

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour), in the reference's order.
# ---------------------------------------------------------------------------------------------
SOURCE_CHAR_MAP = {
    "X": "x", "×": "x", "ā": "a", "Ş": "Ṣ", "ş": "ṣ",
    "Ș": "Ṣ", "ș": "ṣ", "Ț": "Ṭ", "ț": "ṭ", "İ": "I",
    "Ī": "I", "ī": "i", "Î": "I", "î": "i", "ı": "i",
    "h": "ḫ", "H": "Ḫ", "ḥ": "ḫ", "Ḥ": "Ḫ", "=": "-",
    "(": "{", ")": "}", "—": "-", "–": "-",
}
TARGET_CHAR_MAP = {
    "X": "x", "ʾ": "'", "Ş": "Ṣ", "ş": "ṣ",
    "ș": "ṣ", "Ț": "Ṭ", "ț": "ṭ", "ḫ": "h",
    "Ḫ": "H", "ḥ": "ḫ", "Ḥ": "Ḫ",
}
SUPERSCRIPTS = "⁰¹²³⁴⁵⁶⁷⁸⁹⁻°˚"
SUBSCRIPTS = "₀₁₂₃₄₅₆₇₈₉"
SOURCE_DELETE = "\"ʺʾ’´ʼˊ˘ˋˇˈʿʹ'`^˹˺⸢⸣⌜⌝「」⌈⌋⌊⌉˻˼⸤⸥≪≫《》⟪⟫«»〈〉⟨⟩˃‹›⁽⁾ˁˀ"
SOURCE_TO_SPACE = "!?⸮ʔ⸮,/;˷˴|:⁺*"
TARGET_DELETE = "\"ʺˊ˘ˋˇˈʿ`^˹˺⸢⸣⌜⌝「」⌈⌋⌊⌉˻˼⸤⸥≪≫《》⟪⟫«»〈〉⟨⟩˃‹›⁽⁾ˁˀ"
TARGET_TO_APOSTROPHE = "ʹ'ʾ´ʼ"
APOSTROPHE = "’"
TARGET_GAP_DELETE = "˹˺⸢⸣「」⌈⌋⌊|[]"
TARGET_GAP_TO_SPACE = "/*+"
SUBSCRIPT_LETTERS = "a-zA-ZšŠṣṢṭṬḫḪ"
GRAMMAR_NOTES = ["fem\\.", "sing\\.", "pl\\.", "plural", "f\\.", "plur\\."]
SIGLA = ["K", "Rs", "lR"]
EDGE_MARKERS = ["le\\.e\\.", "lo\\.e\\.", "l\\.o\\.e\\.", "obv\\.", "rev\\.", "r\\.e\\.", "u\\.e\\."]
GAP = "<gap>"


def _dedupe(chars: str) -> str:
    return "".join(dict.fromkeys(chars))


# ---------------------------------------------------------------------------------------------
# shared rule builders
# ---------------------------------------------------------------------------------------------
def _null_to_empty(rid: str) -> Expr:
    return Expr(rid, "NULL → ''", fn=lambda c: F.coalesce(c.cast("string"), F.lit("")),
                fn_sql=lambda e: f"coalesce(CAST({e} AS VARCHAR), '')")


def _word(rid: str, words: str, rep: str, note: str, flags: str = "", java_words: str | None = None) -> Regex:
    """Replace whole words (Python ``\\b``): literal first, boundaries by lookaround."""
    java = f"{flags}(?:{java_words or words})(?<!{W}(?:{java_words or words}))(?!{W})"
    re2 = f"{flags}(^|{NW})(?:{words})($|{NW})"
    return Regex(rid, note, java=java, jrep=rep, re2=re2, rrep=f"\\1{rep}\\2", passes=2)


def _edge_markers(rid: str) -> Regex:
    alts = "|".join(EDGE_MARKERS)
    # the first letter is looked at before the boundary, which costs more
    java = f"(?=[{_dedupe(''.join(m[0] for m in EDGE_MARKERS))}])(?<!{W})(?:{alts}){JS}*"
    # consecutive markers always follow a '.' or a space, so one RE2 match can take a run of them
    re2 = f"(^|{NW})(?:(?:{alts}){S}*)+"
    return Regex(rid, "drop edge markers", java=java, jrep="", re2=re2, rrep="\\1")


def _annotation_list(rid: str, words: list[str], note: str) -> Regex:
    alts = "|".join(words)
    pat = lambda s: f"\\({s}*(?:{alts})(?:{s}+(?:{alts}))*{s}*\\)"
    return Regex(rid, note, java=pat(JS), jrep="", re2=pat(S), needs="(")


def _bracket_gap(rid: str) -> Regex:
    return Regex(rid, "[ x ? ] → [xxx]", java=f"\\[(?:{JS}|[x?])*+\\]", jrep="[xxx]", re2=f"\\[[{SPACE}x?]*\\]")


def _spaced_dots(rid: str) -> Expr:
    from .regex import sub_with, sub_with_sql

    pat = f"(?:\\.{S}+){{2,}}\\."
    return Expr(rid, ". . . → ...", stage=True,
                fn=lambda c: sub_with(c, pat.replace(S, JS), lambda m: F.replace(m, F.lit(" "), F.lit(""))),
                fn_sql=lambda e: sub_with_sql(e, pat, lambda m: f"replace({m}, ' ', '')"))


def _dots_and_ellipsis(rid: str) -> list[Regex]:
    pat = f"\\.{{3,}}(?:{S}+\\.{{3,}})*"
    return [
        Regex(rid + "a", "3+ dots → gap", java=pat.replace(S, JS), jrep=GAP, re2=pat),
        Regex(rid + "b", "ellipsis → gap", java="……|…", jrep=GAP, plain=(("……", GAP), ("…", GAP))),
    ]


def _protect_gap(rid: str, delete: str, to_space: str = "") -> Expr:
    """Keep ``<gap>``, delete / blank other characters between gaps, pad gaps with spaces.

    Characters change one by one, so Spark need not cut the text: gaps are padded where they stand,
    before a deletion can make new ones, and a deleted character that is part of ``<gap>`` is kept there.
    """
    in_gap = {"<": "(?<!<(?=gap>))", ">": "(?<!<gap>)"}

    def protect(c: Column) -> Column:
        edges, rest = set(in_gap) & set(delete), "".join(ch for ch in delete if ch not in in_gap)
        if set(rest + to_space) & set(GAP + " "):
            raise ValueError("letters of a gap cannot be deleted")
        c = F.regexp_replace(c, "[<>]" + "".join(in_gap.values()), "") if edges else c
        c = F.replace(c, F.lit(GAP), F.lit(f" {GAP} "))
        if to_space:
            return F.translate(c, to_space + rest, " " * len(to_space))
        return F.translate(c, rest, "") if rest else c

    def clean_sql(p: str) -> str:
        p = f"regexp_replace({p}, {q(char_class(delete))}, '', 'g')"
        return f"regexp_replace({p}, {q(char_class(to_space))}, ' ', 'g')" if to_space else p

    return Expr(
        rid, "protect gap, clean, pad",
        fn=protect,
        fn_sql=lambda e: f"array_to_string(list_transform(string_split({e}, {q(GAP)}), lambda p_: {clean_sql('p_')}), {q(' ' + GAP + ' ')})",
    )


def _whitespace(rid: str) -> list:
    return [
        # a run that is one space already is no match: most runs are
        Regex(rid + "a", "whitespace runs → space", java=f"{JS}(?<! (?!{JS})){JS}*", jrep=" ", re2=f"{S}+"),
        Expr(rid + "b", "strip spaces then hyphens", fn=lambda c: F.btrim(F.btrim(c, F.lit(" ")), F.lit("-")),
             fn_sql=lambda e: f"trim(trim({e}, ' '), '-')"),
        Replace(rid + "c", "tighten hyphens", pairs=((" -", "-"), ("- ", "-"))),
    ]


def _collapse_gaps(rid: str) -> Regex:
    return Regex(rid, "collapse gap runs", java=f"{GAP}(?:[ \\-\\t]*{GAP})+", jrep=GAP)


# ---------------------------------------------------------------------------------------------
# Chain A
# ---------------------------------------------------------------------------------------------
def _subscripts_rule() -> Expr:
    from .regex import sub_with, sub_with_sql

    # The letter is matched too (translate leaves it alone): same digits as a lookbehind.
    java = f"[{SUBSCRIPT_LETTERS}]\\p{{Nd}}+"
    re2 = java
    return Expr("A17", "digits after a letter → subscripts", stage=True, near_digits=True,
                fn=lambda c: sub_with(c, java, lambda m: F.translate(m, "0123456789", SUBSCRIPTS)),
                fn_sql=lambda e: sub_with_sql(e, re2, lambda m: f"translate({m}, '0123456789', {q(SUBSCRIPTS)})"))


def source_chain() -> Chain:
    src_map = "".join(SOURCE_CHAR_MAP)
    dst_map = "".join(SOURCE_CHAR_MAP.values())
    to_space = _dedupe(SOURCE_TO_SPACE)
    delete = _dedupe(SUPERSCRIPTS + SOURCE_DELETE)
    rules = [
        _null_to_empty("A01"),
        Regex("A02", "seal impression with letter", java=f"{JS}*Seal Impression [A-Z]{JS}*", jrep="", re2=f"{S}*Seal Impression [A-Z]{S}*", needs="Seal Impression"),
        Replace("A03", "seal impression", pairs=(("Seal Impression", ""),), needs="Seal Impression"),
        Replace("A04", "broken → xxx", pairs=(("broken", "xxx"),)),
        Replace("A05", "12 dashes", pairs=(("-" * 12, ""),)),
        Replace("A06", "rulings", pairs=(("---- Single Ruling ----", ""), ("---- Double Ruling ----", ""))),
        Translate("A07", "character map", src=src_map, dst=dst_map),
        Replace("A08", "determinatives", pairs=(("ᵈ", "{d}"), ("ᵏⁱ", "{ki}"))),
        Replace("A09", "double braces", pairs=(("{{", "{"), ("}}", "}"))),
        Replace("A10", "doubled marks", pairs=(("??", "?"), ("!!", "!"), ("//", "/"))),
        Replace("A11", "-/", pairs=(("-/", "-"),)),
        Replace("A12", "{?} {!}", pairs=(("{?}", ""), ("{!}", ""))),
        Dead("A13", "(?) (!): parentheses mapped to braces by A07"),
        Translate("A14+A15", "delete marks; punctuation → space", src=to_space + delete, dst=" " * len(to_space)),
    ]
    rules += list(number_chain(live_brackets="[]", months=False, written_fractions=False).rules)
    rules += [
        _subscripts_rule(),
        Dead("A18", "(fem. ...) notes: parentheses gone"),
        Dead("A19", "(K Rs lR): parentheses gone"),
        _edge_markers("A20"),
        _word("A21", "PN|Pn", GAP, "PN → gap", java_words="P[Nn]"),
        _word("A22", "break", "", "break → '' (broken was already xxx)"),
        _bracket_gap("A23"),
        MapChars("A24", "remove square brackets", groups=(("[]", ""),)),
        _spaced_dots("A25"),
        *_dots_and_ellipsis("A26"),
        Regex("A28a", "xx+ → gap", java="xx+", jrep=GAP),
        _word("A28b", "x", GAP, "word x → gap"),
        Dead("A29", "{large break}, {N broken lines}: removed by A22 and A04"),
        _protect_gap("A30", delete="<>"),
        *_whitespace("A31"),
        Replace("A32", "glue full stops", pairs=((" .", "."), (". ", "."))),
        Dead("A33", "> . / > : / > ’: removed by A32, A15, A14"),
        _collapse_gaps("A34"),
        Replace("A35", "{ <gap> } → gap", pairs=(("{ <gap> }", GAP),)),
    ]
    return Chain("A", tuple(rules))


# ---------------------------------------------------------------------------------------------
# Chain E
# ---------------------------------------------------------------------------------------------
def target_chain() -> Chain:
    src_map = "".join(TARGET_CHAR_MAP)
    dst_map = "".join(TARGET_CHAR_MAP.values())
    apostrophes = _dedupe(TARGET_TO_APOSTROPHE)
    delete = _dedupe(SUPERSCRIPTS + SUBSCRIPTS + TARGET_DELETE)
    rules = [
        _null_to_empty("E01"),
        Translate("E02", "character map", src=src_map, dst=dst_map),
        Replace("E03", "{?} {!} (?) (!)", pairs=(("{?}", ""), ("{!}", ""), ("(?)", ""), ("(!)", ""))),
        Translate("E04+E05+E06", "delete super/subscripts and marks; apostrophes → ’",
                  src=apostrophes + delete, dst=APOSTROPHE * len(apostrophes)),
    ]
    rules += list(number_chain(live_brackets="()[]", months=True, written_fractions=True).rules)
    rules += [
        _annotation_list("E08", GRAMMAR_NOTES, "drop grammatical notes"),
        _annotation_list("E09", SIGLA, "drop (K Rs lR)"),
        _edge_markers("E10"),
        _word("E11", "PN|Pn", GAP, "PN → gap", java_words="P[Nn]"),
        _bracket_gap("E12"),
        _spaced_dots("E13a"),
        *_dots_and_ellipsis("E13b"),
        Regex("E14a", "xx+ → gap (any case)", java="[xX][xX]+", jrep=GAP),
        _word("E14b", "[xX]", GAP, "word x → gap"),
        Replace("E15a", "{large break}", pairs=(("{large break}", GAP),)),
        Regex("E15b", "{N broken lines}", java=f"\\{{\\p{{Nd}}+{JS}+broken{JS}+lines\\}}", jrep=GAP, re2=f"\\{{\\p{{Nd}}+{S}+broken{S}+lines\\}}", needs="{"),
        _protect_gap("E16", delete=TARGET_GAP_DELETE, to_space=TARGET_GAP_TO_SPACE),
        *_whitespace("E17"),
        Replace("E18", "tighten after gap", pairs=(("> .", ">."), ("> :", ">:"))),
        _collapse_gaps("E19a"),
        Replace("E19b", "{ <gap> } → gap", pairs=(("{ <gap> }", GAP),)),
        Dead("E19c", "[ <gap> ]: brackets deleted by E16"),
    ]
    return Chain("E", tuple(rules))


SOURCE = source_chain()
TARGET = target_chain()
