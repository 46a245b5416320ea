"""Byte tokens, decoding, BLEU against a plain-Python scorer, scoring passthrough."""

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bleu_ref import corpus_bleu_local
from helpers import run_col
from corpusprep.functions import bytetok as BT
from corpusprep.operators import bleu as BL
from corpusprep.operators import scoring as SC


def test_byte_ids(spark):
    [ids] = run_col(spark, BT.byte_ids, ["aḫ"])
    assert ids[:5] == [100, 228, 187, 174, 1] and len(ids) == 512 and set(ids[5:]) == {0}
    [empty] = run_col(spark, BT.byte_ids, [""])
    assert empty[0] == 1 and len(empty) == 512


def test_special_token_strings(spark):
    texts = ["a</s>b<pad><unk><extra_id_0>é<extra_id_124>", "a</s>", "<extra_id_125>", "</s", "a" * 508 + "<extra_id_7><extra_id_8><extra_id_9>b"]
    got = run_col(spark, BT.byte_ids, texts)
    assert got[0][:11] == [100, 1, 101, 0, 2, 259, 198, 172, 383, 1, 0] and all(len(g) == 512 for g in got)
    assert got[1][:3] == [100, 1, 0]
    assert got[2][:3] == [b + 3 for b in b"<ex"] and got[3][:5] == [*(b + 3 for b in b"</s"), 1, 0]
    assert got[4][507:] == [100, 266, 267, 268, 1]
    assert run_col(spark, lambda c: BT.byte_ids(c, max_len=None), ["a<pad>", "</s>", "x"]) == [[100, 0, 1], [1], [123, 1]]


@pytest.mark.parametrize("n", [510, 511, 512, 600])
def test_truncation(spark, n):
    [ids] = run_col(spark, BT.byte_ids, ["a" * n])
    kept = min(n, 511)
    assert ids[:kept] == [100] * kept and ids[kept] == 1 and len(ids) == 512


def test_roundtrip(spark):
    texts = ["aḫ šum₄ <gap>", "é" * 300, ""]
    got = run_col(spark, lambda c: BT.decode_ids(BT.byte_ids(c)), texts)
    # 300 × 2-byte character: 511 bytes keep 255 whole characters, the cut one is dropped
    assert got == ["aḫ šum₄ <gap>", "é" * 255, ""]


def test_whole_texts_and_valid_replacement_characters(spark):
    texts = ["a\ufffdb", "é" * 5000, "\ufffd\ufffd", "", "日\ufffd😀"]
    assert run_col(spark, lambda c: BT.decode_ids(BT.byte_ids(c, max_len=None)), texts) == texts
    # broken sequences are dropped, also right before a valid U+FFFD
    broken = [0xE2, 0x82, 0xEF, 0xBF, 0xBD, 0xFF, 0x41]
    df = spark.createDataFrame([([b + 3 for b in broken] + [1, 0, 300],)], "ids array<int>")
    assert df.select(BT.decode_ids(F.col("ids"))).collect()[0][0] == "\ufffdA"


def _bleu(spark, hyps, refs):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(zip(hyps, refs))], "id int, h string, r string")
    return BL.bleu_from_stats(BL.bleu_stats(df, "id", "h", "r")).collect()[0]


def test_bleu_identical_is_100(spark):
    assert _bleu(spark, ["the cat sat on the mat ."], ["the cat sat on the mat ."]).bleu == pytest.approx(100.0)


def test_bleu_disjoint_is_0(spark):
    r = _bleu(spark, ["a b c d e"], ["v w x y z"])
    assert r.bleu == 0 and corpus_bleu_local(["a b c d e"], ["v w x y z"]) == 0
    assert (r.precision_1, r.bp) == (0, 1)


def test_bleu_brevity_and_reference_scorer(spark):
    hyps = ["the cat sat on the mat", "there is a cat, on 3.5 mats-", "short", "a b"]
    refs = ["the cat is on the mat", "there is a cat on 3.5 mats", "a much longer reference sentence here", "a b c"]
    r = _bleu(spark, hyps, refs)
    assert r.bp < 1.0
    assert r.bleu == pytest.approx(corpus_bleu_local(hyps, refs), rel=1e-9)


def test_bleu_tokenizer(spark):
    [tok] = run_col(spark, BL.tokenize_13a, ["Hello, world. 3.5-4 &amp; (x)"])
    assert tok == ["Hello", ",", "world", ".", "3.5", "-", "4", "&", "(", "x", ")"]


def test_predict_blank_passthrough(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "  "), (3, None), (4, "x y")], "k long, t string")
    got = {r.k: r.predicted_translation for r in SC.predict(df, SC.reverse_words, "t").collect()}
    assert got == {1: "c b a", 2: "", 3: "", 4: "y x"}
    s = SC.prediction_summary(SC.predict(df, SC.reverse_words, "t")).collect()[0]
    assert (s.rows, s.non_empty) == (4, 2)


def test_whole_texts_are_turned_into_ids_once(spark):
    """The closing eos is looked up in the ids: they stand once in the plan for plain texts and once for texts with specials."""
    df = spark.createDataFrame([("a</s>b",), ("é",), (None,), ("x</s>",)], "t string")
    out = df.select(BT.byte_ids(F.col("t"), max_len=None).alias("ids"))
    assert [r["ids"] for r in out.collect()] == [[100, 1, 101, 1], [198, 172, 1], [1], [123, 1]]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("conv(") == 2


def _odd_texts(n, seed):
    rng = random.Random(seed)
    marks = [chr(c) for c in range(9, 14)] + [chr(c) for c in range(28, 128)] + list(".,.,--  159aB") + ["\x85", "\xa0", "\u2003", "\u3000", "\u200b", "é", "\u0663", "😀"]
    whole = ["<skipped>", "-\n", "&quot;", "&amp;", "&lt;", "&gt;", "...", ". .", "5.,5", "1-2", " - "]
    return ["".join(rng.choice(whole if rng.random() < 0.15 else marks) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_bleu_tokenizer_matches_its_sql(spark):
    texts = ["", None, *_odd_texts(600, 1)]
    con = duckdb.connect()
    con.register("texts", pa.table({"i": range(len(texts)), "t": pa.array(texts, pa.string())}))
    want = [r[0] for r in con.execute(f"SELECT {BL.tokenize_13a_sql('t')} FROM texts ORDER BY i").fetchall()]
    assert run_col(spark, BL.tokenize_13a, texts) == want


def test_bleu_explodes_words_not_ngrams(spark):
    """One record a word, the texts tokenised once, and a single exchange of rows for all orders."""
    df = spark.createDataFrame([(1, "a b c d e", "a b c"), (2, "x", ""), (3, None, "y z")], "id int, h string, r string")
    rows = BL.word_rows(df, "id", "h", "r").collect()
    assert sorted((r.w1, r.w2, r.w3, r.w4, r.h, r.r) for r in rows if r["_rid"] == 1 and r.h)[:2] == [("a", "b", "c", "d", 1, 0), ("b", "c", "d", "e", 1, 0)]
    assert len(rows) == 5 + 3 + 1 + 2 and sum(r.h for r in rows) == 6
    run = BL.bleu_stats(df, "id", "h", "r")._jdf.queryExecution()
    rules = len(BL.TOKENIZE_13A)
    assert run.optimizedPlan().toString().count("regexp_replace(") == 2 * rules
    assert run.executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_bleu_pools_rows_that_share_an_id(spark):
    rng = random.Random(3)
    def text():
        return rng.choice([None, "", " ".join(rng.choice("a b c A . 3.5".split()) for _ in range(rng.randrange(12)))])
    rows = [(rng.choice([None, *range(60)]), text(), text()) for _ in range(120)] + [(1000 + i, text(), text()) for i in range(40)]
    got = BL.bleu_stats(spark.createDataFrame(rows, "id int, h string, r string").repartition(5), "id", "h", "r").collect()[0].asDict()
    con = duckdb.connect()
    ids, hyps, refs = zip(*rows)
    con.register("texts", pa.table({"id": pa.array(ids, pa.int32()), "h": pa.array(hyps, pa.string()), "r": pa.array(refs, pa.string())}))
    cur = con.execute(BL.bleu_stats_sql("SELECT * FROM texts", "id", "h", "r"))
    assert got == dict(zip([c[0] for c in cur.description], cur.fetchone()))
    assert got["match_1"] > 0 and got["total_4"] > 0


def test_bleu_of_no_rows(spark):
    df = spark.createDataFrame([], "id int, h string, r string")
    assert set(BL.bleu_stats(df, "id", "h", "r").collect()[0].asDict().values()) == {0}
    assert _bleu(spark, [None], [""]).bleu == 0
