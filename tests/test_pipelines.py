"""File formats and end-to-end jobs on small CSV/JSONL fixtures; the streaming path."""

import json
import os

import pandas as pd
from pyspark.sql import functions as F

from corpusprep.operators import scoring as SC
from corpusprep.plans import pipelines as PL
from corpusprep.sources import readers as R
from corpusprep.streaming import clean_stream as CS


def _csv(path, rows, cols):
    pd.DataFrame(rows, columns=cols).to_csv(path, index=False)
    return str(path)


def _read_csv_dir(path):
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    return pd.concat([pd.read_csv(os.path.join(path, f), dtype=str, keep_default_na=False) for f in files])


def test_build_corpus_and_split(spark, tmp_path):
    train = _csv(tmp_path / "train.csv", [
        ("d1", "a-na PN x ša-lim", "to PN, greetings"),
        ("d2", 'ki-ma "quoted, text"\nnext line', "as\nsaid"),
        ("d3", "lone doc", "alone"),
    ], ["oare_id", "transliteration", "translation"])
    sents = _csv(tmp_path / "sents.csv", [("d1", "s1", "1", "to PN"), ("d1", "s2", "3", "greetings"),
                                          ("d2", "t1", "1", None)],
                 ["text_uuid", "sentence_uuid", "first_word_number", "translation"])
    defs = _csv(tmp_path / "defs.csv", [("ša-lim", "r", "a", "well"), ("a-na", "r", "a", '"to, for"')],
                ["word", "raw_url", "api_url", "definition"])
    test = _csv(tmp_path / "test.csv", [("0", "t", "1", "2", "a-na ša-lim")],
                ["id", "text_id", "line_start", "line_end", "transliteration"])
    out = str(tmp_path / "out")
    PL.build_corpus(spark, train, sents, defs, test, out)
    tr = _read_csv_dir(f"{out}/train_clean")
    assert sorted(tr.oare_id) == ["d1", "d1", "d2", "d3"]
    s1 = tr[(tr.oare_id == "d1") & (tr.sentence_uuid == "s1")].iloc[0]
    assert s1.transliteration_with_annotations == "a-na {to, for} <gap>"
    te = _read_csv_dir(f"{out}/test_clean")
    assert te.iloc[0].transliteration_with_annotations == "a-na {to, for} ša-lim {well}"

    PL.make_split(spark, f"{out}/train_clean", f"{out}/split")
    meta = [json.loads(line) for f in os.listdir(f"{out}/split/meta") if f.endswith(".json")
            for line in open(f"{out}/split/meta/{f}")]
    assert meta == [{"train_rows": 3, "validation_rows": 1}]
    PL.tokenize_splits(spark, f"{out}/split", f"{out}/tok")
    tok = spark.read.parquet(f"{out}/tok/tokens")
    assert tok.count() == 4 and tok.filter(F.size("input_ids") != 512).count() == 0


def test_lexicon_reader_and_definitions(spark, tmp_path):
    p = tmp_path / "lex.csv"
    p.write_text("type,form,x,y,url\nword,abu,,,https://d/x?word=abu\nword,short\nPN,Aššur,,,https://d/x?word=A\n"
                 "word,abu,,,https://d/x?word=other\nword,ummu,,,https://d/nothing\n", encoding="utf-8")
    lex = R.read_lexicon_csv(spark, str(p))
    assert lex.count() == 5
    payloads = spark.createDataFrame([("https://d/x?word=abu", '[{"meaning": "\\"father\\""}]')], "url string, payload string")
    counters = PL.build_definitions(spark, str(p), payloads, str(tmp_path / "out")).collect()[0]
    assert (counters.queued, counters.written, counters.fetched) == (2, 1, 1)
    d = _read_csv_dir(str(tmp_path / "out/definitions/version=1"))
    assert d.to_dict("records") == [{"word": "abu", "raw_url": "https://dictionary.example/dictionary?word=abu",
                                     "api_url": "https://dictionary.example/api/words?query=word%3Dabu",
                                     "definition": "father"}]


def test_definitions_bind_by_header_name(spark, tmp_path):
    for name, text in (("a", "definition,word\n\"to, for\",a-na\n"), ("b", "word,definition\na-na,to\nNA,none\n,blank\n"), ("c", "word\nx\n")):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    read = lambda n: [(r.word, r.definition) for r in R.read_definitions_csv(spark, str(tmp_path / f"{n}.csv")).collect()]
    assert read("a") == [("a-na", "to, for")]
    assert read("b") == [("a-na", "to"), ("NA", "none")]
    assert read("c") == [("x", "")]


def test_rows_keep_the_order_of_their_files(spark, tmp_path):
    """Spark packs larger files first; ordinals follow the names of the files and the rows in them."""
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("word,definition\nw,first\n")
    (folder / "b.csv").write_text("word,definition\n" + "".join(f"w{i},{'x' * 50}\n" for i in range(3000)) + "w,second\n")
    (folder / "c.csv").write_text("word,definition\nw,last\n")
    from corpusprep.operators import dictionary as DI

    d = {r.key: r.definition for r in DI.build_dictionary(R.read_definitions_csv(spark, str(folder))).collect()}
    assert d["w"] == "last" and len(d) == 3001
    rows = R.read_csv_strings(spark, str(folder), ordinal="o").orderBy("o").collect()
    assert [rows[0].definition, rows[-2].definition, rows[-1].definition] == ["first", "second", "last"]


def test_missing_cells_are_a_parameter(spark, tmp_path):
    p = _csv(tmp_path / "m.csv", [("NA", "n/a"), ("x", "null"), ("", "None")], ["a", "b"])
    assert [tuple(r) for r in R.read_csv_strings(spark, p).collect()] == [(None, None), ("x", None), (None, None)]
    assert [tuple(r) for r in R.read_csv_strings(spark, p, missing=()).collect()] == [("NA", "n/a"), ("x", "null"), (None, "None")]
    assert R.read_csv_strings(spark, p, multi_line=False).count() == 3


def test_quoted_line_break_in_lexicon(spark, tmp_path):
    p = tmp_path / "lex.csv"
    p.write_text('word,"a\nbu",,,https://d/x?word=abu\nword,b,,,u\n', encoding="utf-8")
    assert [(r.form, r.url) for r in R.read_lexicon_csv(spark, str(p)).collect()] == [("a\nbu", "https://d/x?word=abu"), ("b", "u")]


def test_written_values_keep_their_spaces(spark, tmp_path):
    from corpusprep.sources import writers as W

    rows = [(" a b ", "\tx"), ("  ", 'q"q')]
    W.write_csv(spark.createDataFrame(rows, "a string, b string").coalesce(1), str(tmp_path / "w"))
    assert sorted(map(tuple, _read_csv_dir(str(tmp_path / "w")).values.tolist())) == sorted(rows)
    assert sorted(tuple(r) for r in R.read_csv_strings(spark, str(tmp_path / "w"), missing=()).collect()) == sorted(rows)


def test_typed_csv(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    p = _csv(tmp_path / "t.csv", [("a", 1), ("b", 2)], ["k", "n"])
    schema = StructType([StructField("k", StringType()), StructField("n", IntegerType())])
    assert [tuple(r) for r in R.read_csv_typed(spark, p, schema).collect()] == [("a", 1), ("b", 2)]


def test_scoring_from_another_folder(tmp_path):
    """The workers get the package from the driver: no path has to be set for them."""
    import subprocess
    import sys

    code = """
import sys
sys.path.insert(0, %r)
from corpusprep.session import local_session
from corpusprep.operators import scoring as SC
s = local_session(2)
df = s.createDataFrame([(1, "a b")], "k long, t string")
print("RESULT", SC.predict(df, SC.reverse_words, "t").collect()[0].predicted_translation)
""" % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert "RESULT b a" in out.stdout, out.stderr[-2000:]


def test_missing_definitions_file_is_empty(spark, tmp_path):
    assert R.read_definitions_csv(spark, str(tmp_path / "nope.csv")).count() == 0


def test_score_writes_quoted_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "")], "k long, t string")
    PL.score(df, "k", "t", SC.reverse_words, str(tmp_path / "pred"))
    text = "".join(open(os.path.join(tmp_path / "pred", f)).read() for f in os.listdir(tmp_path / "pred") if f.endswith(".csv"))
    assert '"1","a b","b a"' in text


def test_streaming_cleaning(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([("1", "a-na PN (ki)", "to PN"), ("2", "x xx", "Month IV")],
                          "oare_id string, transliteration string, translation string").write.parquet(str(src / "part1"))
    from corpusprep.operators import dictionary as DI
    dct = DI.build_dictionary(spark.createDataFrame([("a-na", "to", 1)], "word string, definition string, ordinal long"))
    schema = spark.read.parquet(str(src / "part1")).schema
    q = CS.start_cleaning(spark, str(src / "part1"), schema, dct, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    out = {r.oare_id: (r.transliteration_clean, r.transliteration_with_annotations, r.translation_clean)
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out == {"1": ("a-na <gap> {ki}", "a-na {to} <gap> {ki}", "to <gap>"), "2": ("<gap>", "<gap>", "Month 4")}
