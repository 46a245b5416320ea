"""Chain F: number canonicalisation (bracketed integers, additions, Roman months, fractions).

Every rule is a native column expression. Replacement-by-function rules use
:func:`regex.sub_with` (split + extract_all + transform), the addition rule folds to a fixed point
with ``aggregate``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import DIGIT, JS, NW, S, W, ascii_digits, ascii_digits_sql, bound, q, sub_with, sub_with_long, sub_with_sql
from .rules import Chain, Dead, Expr, Regex

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------------------------
# Bracket pairs whose bracketed integers are unwrapped, in order.
BRACKETS = [("(", ")"), ("[", "]"), ("˹", "˺"), ("⌈", "⌋"), ("「", "」"), ("⸢", "⸣")]
# "Month"/"month" + Roman numeral → Arabic.
ROMAN_MONTHS = {
    "I": "1", "II": "2", "III": "3", "IV": "4", "V": "5", "VI": "6",
    "VII": "7", "VIII": "8", "IX": "9", "X": "10", "XI": "11", "XII": "12",
}
# Written fractions → Unicode fraction characters, applied in this order.
FRACTION_TEXT = [
    ("1", "6", "⅙"), ("1", "4", "¼"), ("1", "3", "⅓"), ("1", "2", "½"),
    ("2", "3", "⅔"), ("3", "4", "¾"), ("5", "6", "⅚"),
]
# The largest denominator of the fractions that decimal parts are rounded to.
MAX_DENOMINATOR = 12
# The oracle's form of the same rounding: a decimal part whose nearest fraction with denominator
# <= 12 is one of these seven lies in an open interval between midpoints to the Farey neighbours.
FRACTION_INTERVALS = [
    ("⅙", 13 / 84, 23 / 132),
    ("¼", 17 / 72, 23 / 88),
    ("⅓", 19 / 60, 23 / 66),
    ("½", 21 / 44, 23 / 44),
    ("⅔", 43 / 66, 41 / 60),
    ("¾", 65 / 88, 55 / 72),
    ("⅚", 109 / 132, 71 / 84),
]
# Characters after which a space is put when a digit precedes them.
FRACTION_CHARS = "¼½¾⅓⅔⅕⅖⅗⅘⅙⅚⅛⅜⅝⅞"
SMALL_DECIMAL = 0.0001

NUM = f"{DIGIT}+(?:\\.{DIGIT}+)?"
ADD = f"({NUM}){S}*\\+{S}*({NUM})"
# Numbers joined by '+', with all digits and dots beside them: whatever a sum can meet in a later pass.
# The outer loop gives nothing back either: Java runs it without recursion, however long a sum is.
SUMS_J = f"{DIGIT}[{DIGIT}.]*+(?:{JS}*+\\+{JS}*+{DIGIT}[{DIGIT}.]*+)++"
FRAC = f"({DIGIT}+){S}+({DIGIT}+)/({DIGIT}+)|({DIGIT}+)/({DIGIT}+)"
# digit first, then the left boundary as a fixed-width lookbehind (cheaper than leading with it)
DEC_J = f"{DIGIT}(?<!{W}{DIGIT}){DIGIT}*\\.{DIGIT}+(?!{W})"
DEC_R = f"(^|{NW})({DIGIT}+\\.{DIGIT}+)"


# ---------------------------------------------------------------------------------------------
# number → text
# ---------------------------------------------------------------------------------------------
def fmt_number(v: Column) -> Column:
    """Integral → integer text; otherwise 5 decimals with trailing zeros and dot removed.

    ``format_number`` with a pattern rounds the exact binary value (like Python's ``%.5f``),
    unlike ``format_string``.
    """
    as_int = F.when(F.abs(v) < F.lit(9.0e18), v.cast("bigint").cast("string")).otherwise(
        F.call_function("format_number", v, F.lit("0"))
    )
    frac = F.regexp_replace(F.regexp_replace(F.call_function("format_number", v, F.lit("0.00000")), "0+$", ""), "\\.$", "")
    return F.when(v == F.floor(v), as_int).otherwise(frac)


def fmt_number_sql(v: str) -> str:
    return (
        f"(CASE WHEN {v} = floor({v}) THEN CAST(CAST({v} AS HUGEINT) AS VARCHAR) "
        f"ELSE regexp_replace(regexp_replace(printf('%.5f', {v}), '0+$', ''), '\\.$', '') END)"
    )


def _num(c: Column) -> Column:
    return ascii_digits(c).try_cast("double")


def _num_sql(e: str) -> str:
    return f"TRY_CAST({ascii_digits_sql(e)} AS DOUBLE)"


# ---------------------------------------------------------------------------------------------
# a + b → sum, to a fixed point
# ---------------------------------------------------------------------------------------------
def _add_once(c: Column) -> Column:
    def one(m: Column) -> Column:
        a = _num(F.regexp_extract(m, ADD, 1))
        b = _num(F.regexp_extract(m, ADD, 2))
        return F.coalesce(bound(a + b, fmt_number), m)

    return sub_with(c, ADD.replace(S, JS), one)


def add_fixed_point(c: Column) -> Column:
    """Additions to a fixed point. Passes go over the stretches with additions alone, not over the text around
    them: a sum stays between the characters beside its stretch, so it meets no number outside."""
    return sub_with_long(c, SUMS_J, _add_all)


def _add_all(c: Column) -> Column:
    """Every pass adds the numbers on both sides of each second '+' of a chain, so a chain of n signs
    needs log2(n) + 1 passes. Only signs between digits count; a text without one takes no pass."""
    k = F.regexp_count(c, F.lit(f"{DIGIT}{JS}*\\+(?={JS}*{DIGIT})"))
    passes = F.when(k > 0, F.ceil(F.log2(k.cast("double"))) + 1).otherwise(0).cast("int")
    return F.aggregate(F.array_repeat(F.lit(0), passes), c, lambda acc, _: _add_once(acc))


def add_fixed_point_sql(e: str) -> str:
    def one(m: str) -> str:
        a = _num_sql(f"regexp_extract({m}, {q(ADD)}, 1)")
        b = _num_sql(f"regexp_extract({m}, {q(ADD)}, 2)")
        return f"coalesce({fmt_number_sql(f'({a} + {b})')}, {m})"

    step = sub_with_sql("acc_", ADD, one)
    return (
        f"list_reduce(list_prepend({e}, list_transform(range(length({e}) - length(replace({e}, '+', ''))), "
        f"lambda z_: NULL::VARCHAR)), lambda acc_, z_: {step})"
    )


# ---------------------------------------------------------------------------------------------
# "i n/d" and "n/d" → decimal text (n/0 keeps the original text)
# ---------------------------------------------------------------------------------------------
def _fraction_value(c: Column) -> Column:
    def one(m: Column) -> Column:
        mixed = F.regexp_extract(m, FRAC, 1) != ""
        i = _num(F.regexp_extract(m, FRAC, 1))
        v_mixed = i + F.try_divide(_num(F.regexp_extract(m, FRAC, 2)), _num(F.regexp_extract(m, FRAC, 3)))
        v_plain = F.try_divide(_num(F.regexp_extract(m, FRAC, 4)), _num(F.regexp_extract(m, FRAC, 5)))
        return F.coalesce(bound(F.when(mixed, v_mixed).otherwise(v_plain), fmt_number), m)

    return sub_with(c, FRAC.replace(S, JS), one)


def _fraction_value_sql(e: str) -> str:
    def one(m: str) -> str:
        g = lambda k: _num_sql(f"regexp_extract({m}, {q(FRAC)}, {k})")
        mixed = f"regexp_extract({m}, {q(FRAC)}, 1) <> ''"
        v = (
            f"(CASE WHEN {mixed} THEN {g(1)} + CASE WHEN {g(3)} = 0 THEN NULL ELSE {g(2)} / {g(3)} END "
            f"ELSE CASE WHEN {g(5)} = 0 THEN NULL ELSE {g(4)} / {g(5)} END END)"
        )
        return f"coalesce({fmt_number_sql(v)}, {m})"

    return sub_with_sql(e, FRAC, one)


# ---------------------------------------------------------------------------------------------
# decimals → integer (tiny decimal part) or Unicode fraction
# ---------------------------------------------------------------------------------------------
SCALE, HALF_SCALE = 2**53, 2**40


def _as_struct(n: Column, d: Column) -> Column:
    return F.struct(n.alias("n"), d.alias("d"))


def nearest_fraction(x: Column, max_denominator: int = MAX_DENOMINATOR, out: Callable[[Column, Column], Column] = _as_struct) -> Column:
    """``out(n, d)`` of the fraction n / d nearest to 0 <= x < 1 with d <= max_denominator (of two, the
    convergent). Continued-fraction descent in integers, on x in units of 2^-53.

    A step takes the quotient of the last two remainders; the first convergent whose denominator would
    pass the limit gives way to the last one or to the largest semiconvergent within the limit. x lies
    between those two, so which is nearer is told by their midpoint, compared with all bits of x.
    Denominators grow at least like the Fibonacci numbers, which bounds the steps.
    """
    if not 1 <= max_denominator <= 500:
        raise ValueError("max_denominator must lie between 1 and 500")
    steps, a, b = 2, 1, 1
    while b <= max_denominator:
        steps, a, b = steps + 1, b, a + b
    num = F.floor(x * F.lit(float(SCALE))).cast("bigint")
    n, limit, one = (lambda v: F.lit(v).cast("bigint")), F.lit(max_denominator).cast("bigint"), F.lit(SCALE).cast("bigint")
    scaled = x * F.lit(float(HALF_SCALE))
    start = F.struct(F.floor(scaled).cast("bigint").alias("high"), (scaled - F.floor(scaled)).alias("low"), n(0).alias("p0"), n(1).alias("q0"), n(1).alias("p1"), n(0).alias("q1"), num.alias("r0"), one.alias("r1"), F.lit(False).alias("done"))

    def step(s: Column, _: Column) -> Column:
        quotient = F.call_function("div", s["r0"], s["r1"])
        q2 = s["q0"] + quotient * s["q1"]
        stop = s["done"] | (s["r1"] == 0)
        further = F.struct(
            s["high"].alias("high"), s["low"].alias("low"), s["p1"].alias("p0"), s["q1"].alias("q0"), (s["p0"] + quotient * s["p1"]).alias("p1"), q2.alias("q1"),
            s["r1"].alias("r0"), (s["r0"] - quotient * s["r1"]).alias("r1"), F.lit(False).alias("done"))
        return F.when(stop, s).when(q2 > limit, s.withField("done", F.lit(True))).otherwise(further)

    def nearest(s: Column) -> Column:
        k = F.call_function("div", limit - s["q0"], s["q1"])
        p, q = s["p0"] + k * s["p1"], s["q0"] + k * s["q1"]
        both, twice = s["p1"] * q + p * s["q1"], F.lit(2) * q * s["q1"]  # the midpoint is both / twice
        left = (both * F.lit(HALF_SCALE) - s["high"] * twice).cast("double")
        past = s["low"] * twice  # exact: x below 2^-21 is nearest to 0 by far, others leave few bits
        upper = s["p1"] * q > p * s["q1"]
        last = ~s["done"] | (upper & (past >= left)) | (~upper & (past <= left))
        return F.when(last, out(s["p1"], s["q1"])).otherwise(out(p, q))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, nearest)


def _decimal_to_fraction_one(m: Column) -> Column:
    def sign(n: Column, d: Column) -> Column:
        found = F.lit(None).cast("string")
        for top, bottom, ch in FRACTION_TEXT:
            found = F.when((n == int(top)) & (d == int(bottom)), F.lit(ch)).otherwise(found)
        return found

    def text(v: Column) -> Column:
        ip = F.floor(v)
        with_sign = lambda frac: F.when(ip == 0, frac).otherwise(F.concat(ip.cast("string"), F.lit(" "), frac))
        return (
            F.when(v.isNull(), m)
            .when(v - ip < F.lit(SMALL_DECIMAL), ip.cast("string"))
            .otherwise(F.coalesce(bound(nearest_fraction(v - ip, out=sign), with_sign), m))
        )

    return bound(_num(m), text)


def _decimal_to_fraction_one_sql(m: str) -> str:
    v = _num_sql(m)
    ip = f"CAST(floor({v}) AS BIGINT)"
    dp = f"({v} - floor({v}))"
    cases = " ".join(
        f"WHEN {dp} > {lo!r}::DOUBLE AND {dp} < {hi!r}::DOUBLE THEN {q(ch)}" for ch, lo, hi in FRACTION_INTERVALS
    )
    frac = f"(CASE {cases} ELSE NULL END)"
    return (
        f"(CASE WHEN {v} IS NULL THEN {m} WHEN {dp} < {SMALL_DECIMAL!r}::DOUBLE THEN CAST({ip} AS VARCHAR) "
        f"WHEN {frac} IS NOT NULL THEN (CASE WHEN {ip} = 0 THEN {frac} ELSE CAST({ip} AS VARCHAR) || ' ' || {frac} END) "
        f"ELSE {m} END)"
    )


def _decimals(c: Column) -> Column:
    return sub_with(c, DEC_J, _decimal_to_fraction_one)


def _decimals_sql(e: str) -> str:
    """RE2 has no lookaround. The match carries its left boundary character (group 1); the right
    boundary is checked on the first character of the following part: a maximal digit run
    followed by a word character is left unchanged, as Python's ``\\b`` would leave it."""
    p = q(DEC_R)

    def one(m: str, nxt: str) -> str:
        b1 = f"regexp_extract({m}, {p}, 1)"
        n = f"regexp_extract({m}, {p}, 2)"
        return (f"(CASE WHEN regexp_matches(left(coalesce({nxt}, ''), 1), {q(W)}) THEN {m} "
                f"ELSE {b1} || {_decimal_to_fraction_one_sql(n)} END)")

    return sub_with_sql(e, DEC_R, one, next_aware=True)


# ---------------------------------------------------------------------------------------------
# chain builder
# ---------------------------------------------------------------------------------------------
def number_chain(live_brackets: str = "()[]˹˺⌈⌋「」⸢⸣", months: bool = True, written_fractions: bool = True) -> Chain:
    """Chain F. The arguments switch off the parts the calling chain has already made dead."""
    rules = []
    for i, (o, c) in enumerate(BRACKETS):
        pat = f"\\{o}(\\+?{DIGIT}+)\\{c}" if o in "([" else f"{o}(\\+?{DIGIT}+){c}"
        live = o in live_brackets
        rules.append(
            Regex(f"F02.{i}", f"unwrap {o}n{c}", live=live, java=pat, jrep="$1", re2=pat, rrep="\\1")
            if live
            else Dead(f"F02.{i}", f"unwrap {o}n{c}: brackets removed earlier")
        )
    rules.append(Expr("F03", "a+b to a fixed point", stage=True, near_digits=True, fn=add_fixed_point, fn_sql=add_fixed_point_sql))
    for roman in ROMAN_MONTHS:  # each pattern ends at a word boundary, so the order does not matter
        rid = f"F05.{roman}"
        if not months:
            rules.append(Dead(rid, "Month → Montḫ earlier"))
        elif "X" in roman:
            rules.append(Dead(rid, "X → x earlier"))
        else:
            java = f"([Mm]onth)(?<!{W}[Mm]onth){JS}+{roman}(?!{W})"
            re2 = f"(^|{NW})([Mm]onth){S}+{roman}($|{NW})"
            rules.append(
                Regex(rid, "Roman month", java=java, jrep=f"$1 {ROMAN_MONTHS[roman]}", re2=re2,
                      rrep=f"\\1\\2 {ROMAN_MONTHS[roman]}\\3", passes=2, needs="onth")
            )
    for n, d, ch in FRACTION_TEXT:
        rid = f"F06.{n}/{d}"
        pat = f"{n}{S}*/{S}*{d}"
        rules.append(Regex(rid, "written fraction", java=pat.replace(S, JS), jrep=ch, re2=pat, needs="/") if written_fractions else Dead(rid, "/ removed earlier"))
    rules.append(
        Expr("F07", "n/d → decimal", stage=True, fn=_fraction_value, fn_sql=_fraction_value_sql)
        if written_fractions
        else Dead("F07", "/ removed earlier")
    )
    p8 = f"({DIGIT}+\\.{DIGIT}{{5}}){DIGIT}+"
    rules.append(Regex("F08", "cut decimals after 5 digits", java=p8, jrep="$1", re2=p8, rrep="\\1", near_digits=True))
    rules.append(Expr("F09", "decimal → int or fraction char", stage=True, near_digits=True, fn=_decimals, fn_sql=_decimals_sql))
    p11 = f"({DIGIT})([{FRACTION_CHARS}])"
    rules.append(Regex("F11", "space between digit and fraction", java=p11, jrep="$1 $2", re2=p11, rrep="\\1 \\2", near_digits=True))
    return Chain("F", tuple(rules))

