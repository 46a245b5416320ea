"""How often texts are gone through: number rules over stretches with digits only, rules without their literal not at
all, and no lambda for a token between a text and its dictionary; results stay those of whole passes."""

import re

import chain_ref as R
import pytest
from helpers import run_chain
from pyspark.sql import functions as F

from corpusprep.functions.cleaning import SOURCE, TARGET
from corpusprep.functions.numbers import number_chain
from corpusprep.functions.regex import sub_with, sub_with_long
from corpusprep.operators import dictionary as DI


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_number_rules_share_one_pass(spark):
    df = SOURCE.apply(spark.createDataFrame([("a",)], "t string"), "t", "o")
    # decimals, sums and subscripts are looked for in the stretches that one pass over the text cuts out
    whole = [x for x in plan(df).split("\n") if "Project" in x]
    assert sum("\\p{Nd}" in x for x in whole) <= 2


def test_rules_are_left_out_without_their_literal(spark):
    p = plan(TARGET.apply(spark.createDataFrame([("a",)], "t string"), "t", "o"))
    for literal in ("onth", "/", "(", "{"):
        assert re.search(rf"Contains\(o#\d+, {re.escape(literal)}\)", p)


def test_tokens_meet_the_dictionary_without_lambdas(spark):
    df = spark.createDataFrame([("1", "a")], "i string, t string")
    dct = spark.createDataFrame([("a", "b")], "key string, definition string")
    lines = DI.annotate(df, dct, "t")._jdf.queryExecution().executedPlan().toString().split("\n")
    explode = next(i for i, x in enumerate(lines) if "Generate explode(concat(" in x)
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(__id" in x)
    assert exchange < explode and not any("lambdafunction" in x for x in lines[exchange:explode + 2])


ODD = [
    "1.7+2.3.4+5+6", "0.5+0.5.5+1 + 2", "x3+4y5 +6", "½5+1", "a12.5b 3.5½", "𝟜½ x𝟜5 𝟜+1", "1+2+.5+1", ".5+6 + 7.", "b2+3.25", "šu4.5 2.5à5",
    "<<gap>gap>", "<gap<gap>", "<g|ap>", "a<gap>>b", " \x1c\x85 a \n b", "Seal Impression A Seal Impression B c", "………", "Month  IV month\tVIII 1/2/3 5/3/4",
]


@pytest.mark.parametrize("name,chain,ref", [("A", SOURCE, R.SOURCE), ("E", TARGET, R.TARGET)])
def test_results_are_those_of_whole_passes(spark, name, chain, ref):
    given = [t for t in ODD if "𝟜" not in t]
    assert run_chain(spark, chain, given) == [R.run(ref, t) for t in given]


def test_number_rules_one_by_one_agree_with_the_chain(spark):
    """Every rule over the whole text, as single rules run, gives what the shared pass gives; marks may be in the text."""
    given = ODD + [f"\u0001{t}\u0001 {t}" for t in ODD] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, x string")
    for r in number_chain().live():
        df = df.withColumn("x", r.spark(F.col("x"))).localCheckpoint()
    assert run_chain(spark, number_chain(), given) == [r["x"] for r in df.orderBy("i").collect()]


def test_long_stretches(spark):
    """A stretch of any length is one match: loops of its pattern do not recurse."""
    n = 20_000
    given = ["+".join(map(str, range(n))), "a1.5 + 2" * n, "[" + "x ?" * n + "]", " ".join(["7"] * n), "1." * n, "\n" * n]
    got = run_chain(spark, SOURCE, given)
    assert got == [str(n * (n - 1) // 2), "a₃.5" * n, "<gap>", given[3], given[4], ""]


@pytest.mark.parametrize("sub_with", [sub_with, sub_with_long])
def test_marks_in_the_text(spark, sub_with):
    df = spark.createDataFrame([("a\u00011b22\u0001",), ("\u0001",), (None,), ("7",)], "t string")
    got = [r[0] for r in df.select(sub_with(F.col("t"), "[0-9]+", lambda m: F.concat(F.lit("<"), m, F.lit(">")))).collect()]
    assert got == ["a\u0001<1>b<22>\u0001", "\u0001", None, "<7>"]


def test_first_of_several_spellings_and_unknown_tokens(spark):
    df = spark.createDataFrame([("THE (the) none The",), ("",), (None,)], "t string")
    dct = spark.createDataFrame([("the", "one"), ("THE", ""), (None, "n")], "key string, definition string")
    got = sorted(r["o"] for r in DI.annotate(df, dct, "t", "o").collect())
    assert got == ["", "", "THE (the) {one} none The {one}"]
