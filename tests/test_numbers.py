"""Chain F pieces: fraction intervals against exact rational rounding, number formatting."""

from fractions import Fraction

import pytest
from helpers import run_chain, run_col

from corpusprep.functions import numbers as NU
from corpusprep.functions.rules import Chain


def nearest_char(dp: float):
    signs = {Fraction(int(n), int(d)): sign for n, d, sign in NU.FRACTION_TEXT}
    return signs.get(Fraction(dp).limit_denominator(12))


def interval_char(dp: float):
    for ch, lo, hi in NU.FRACTION_INTERVALS:
        if lo < dp < hi:
            return ch
    return None


def test_intervals_equal_limit_denominator_on_all_five_digit_decimals():
    for k in range(1, 100000):
        dp = k / 100000
        assert interval_char(dp) == nearest_char(dp), dp


def test_format_rounds_exact_binary_value(spark):
    from pyspark.sql import functions as F

    got = run_col(spark, lambda c: NU.fmt_number(c.cast("double")), ["2.000015", "0.30000000000000004", "4", "1.5"])
    assert got == ["2.00001", "0.3", "4", "1.5"]


def test_sums_need_few_passes(spark):
    """Signs without digits on both sides cost no pass over the text."""
    import time

    texts = ["ab+cd " * 100_000, "+".join(map(str, range(20_000)))]
    t = time.time()
    got = run_chain(spark, _rules("F03"), texts)
    assert got == [texts[0], str(sum(range(20_000)))] and time.time() - t < 30


def _rules(*ids):
    c = NU.number_chain()
    return Chain("t", tuple(r for r in c.rules if r.id in ids or any(r.id.startswith(i + ".") for i in ids)))


@pytest.mark.parametrize("ids,text,expected", [
    (("F03",), "1+2+3+4", "10"),
    (("F03",), "me-+e-er", "me-+e-er"),
    (("F03",), "+".join(["1"] * 1000), "1000"),
    (("F03",), "1.5+2.5+a 3 + 4+b+5+6", "4+a 7+b+11"),
    (("F03",), "0.1+0.2", "0.3"),
    (("F06",), "1/20", "½0"),
    (("F06",), "11/2", "1½"),
    (("F07",), "2 3/8", "2.375"),
    (("F07",), "5/0", "5/0"),
    (("F08",), "3.1415926", "3.14159"),
    (("F09",), "0.33 0.35 2.5 3.00001 1.5a 224.145.138.68", "⅓ 0.35 2 ½ 3 1.5a 224.145.138 ⅔"),
    (("F11",), "2½", "2 ½"),
    (("F02",), "(12) [+3] ˹4˺", "12 +3 4"),
])
def test_number_rules(spark, ids, text, expected):
    assert run_chain(spark, _rules(*ids), [text]) == [expected]


def test_nearest_fraction_is_limit_denominator(spark):
    """All denominators from 1 to 50, shares of five digits and exact binary ones, against the standard library."""
    from fractions import Fraction

    from pyspark.sql import functions as F

    values = sorted({k / 100000 for k in range(1, 100000, 487)} | {a / b for b in (2, 3, 7, 12, 49, 64) for a in range(1, b)} | {0.0, 0.99999, 1e-5})
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in (1, 2, 3, 5, 12, 13, 31, 50):
        got = df.select("x", NU.nearest_fraction(F.col("x"), n).alias("f")).select("x", "f.n", "f.d").collect()
        for r in got:
            want = Fraction(r.x).limit_denominator(n)
            assert (r.n, r.d) == (want.numerator, want.denominator), (r, n)


def test_a_number_is_computed_once(spark):
    """Its parts, its sign and its form read the same value: the descent stands in the plan once for each path of sub_with."""
    df = spark.createDataFrame([("1.5 and 0.333 and 2.00001 and 7.77",)], "x string")
    out = df.select(NU._decimals(df["x"]).alias("o"))
    assert out.first()["o"] == "1 ½ and ⅓ and 2 and 7.77"
    assert out._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 2
