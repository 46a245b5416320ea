"""Chains A and E: whole rows, one or more cases per live rule, dead rules stay dead."""

import pytest
from helpers import run_chain

from corpusprep.functions.cleaning import SOURCE, TARGET
from corpusprep.functions.rules import Chain

# Own strings: an ellipsis inside a word, determinatives, full stops inside signs, text without change.
WHOLE = [
    ("a-na bé-li… ma qí-bi(ki)", "a-na bé-li <gap> ma qí-bi{ki}"),
    ("KÙ.BABBAR ša ni-iš-ku-nu-ma", "KÙ.BABBAR ša ni-iš-ku-nu-ma"),
    ("um-ma tap-pá-u-ni-ma", "um-ma tap-pá-u-ni-ma"),
    ("li-+im-tum ù be-ul„-tum", "li-+im-tum ù be-ul„-tum"),
]


def only(chain, *ids):
    return Chain("t", tuple(r for r in chain.rules if r.id in ids))


def test_whole_rows(spark):
    assert run_chain(spark, SOURCE, [w[0] for w in WHOLE]) == [w[1] for w in WHOLE]


@pytest.mark.parametrize("text,expected", [
    ("hatti (ki) ā=X", "ḫatti {ki} a-<gap>"),
    ("ᵈIM", "{d}IM"),
    ("a-na(??) b", "a-na b"),
    ("a PN b", "a <gap> b"),
    ("a-na. b", "a-na.b"),
    ("{large break}", "{large }"),
    ("a12 šu4 à5 b₂1", "a₁₂ šu₄ à5 b₂1"),
    ("1+2+3+4", "10"),
    ("1 + 2.5 a 3+4 +5", "3 ½ a 12"),
    ("0.33 0.35 2.5 3.00001", "⅓ 0.35 2 ½ 3"),
    ("x ax x4 x₄ x,x x", "<gap> ax x₄ x₄ <gap>"),
    ("- a", " a"),
    (None, ""),
    ("", ""),
    ("foo Seal Impression A bar", "foobar"),
    ("PN PN PN", "<gap>"),
    ("obv.rev.obv.rev.x", "<gap>"),
    ("a ... ... b....c", "a <gap> b <gap> c"),
])
def test_source_chain_cases(spark, text, expected):
    assert run_chain(spark, SOURCE, [text]) == [expected]


@pytest.mark.parametrize("ids,text,expected", [
    (("A02",), "foo Seal Impression A bar", "foobar"),
    (("A20",), "obv. a-na rev.b xobv. c", "a-na b xobv. c"),
    (("A23",), "a [x x] b [?] c []", "a [xxx] b [xxx] c [xxx]"),
    (("A25",), "a . . . b. c", "a ... b. c"),
    (("A26a",), "a ... ... b....c", "a <gap> b<gap>c"),
    (("A28b",), "x ax x4 x₄ x,x x", "<gap> ax x4 x₄ <gap>,<gap> <gap>"),
    (("A31a", "A31b", "A31c"), "- a", " a"),
    (("A34",), "<gap> - <gap> <gap> a", "<gap> a"),
    (("A17",), "a12 šu4 à5 b₂1", "a₁₂ šu₄ à5 b₂1"),
])
def test_single_source_rules(spark, ids, text, expected):
    assert run_chain(spark, only(SOURCE, *ids), [text]) == [expected]


@pytest.mark.parametrize("text,expected", [
    ("he (fem. pl.) went (K Rs) x", "he went <gap>"),
    ("Assur's", "Assur’s"),
    ("{5 broken lines}", "<gap>"),
    ("Month IV", "Month 4"),
    ("Month X", "Month <gap>"),
    ("Month IX", "Month Ix"),
    ("2 3/8", "2.375"),
    ("5/0", "5 0"),
    ("0.33", "⅓"),
    ("2½", "2 ½"),
    ("1/20 11/2", "½0 1 ½"),
    ("ḫarrān Ḫ", "harrān H"),
    ("(3) [4]", "3 4"),
])
def test_target_chain_cases(spark, text, expected):
    assert run_chain(spark, TARGET, [text]) == [expected]


def test_e08_alone(spark):
    assert run_chain(spark, only(TARGET, "E08"), ["he (fem. pl.) went (K Rs) x"]) == ["he  went (K Rs) x"]


def test_dead_rules_are_listed_not_applied():
    dead_a = {r.id for r in SOURCE.rules if not r.live}
    assert {"A13", "A18", "A19", "A29", "A33"} <= dead_a
    assert all(r.live for r in SOURCE.live())


def test_chain_stages_bind_multi_reference_rules():
    for chain in (SOURCE, TARGET):
        for stage in chain.stages():
            assert all(not r.stage for r in stage[1:])
