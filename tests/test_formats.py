"""Rows that do not parse, splits as partitions, counters of the write, versions of a resumable job."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from corpusprep.operators import dictionary as DI
from corpusprep.operators import split as SP
from corpusprep.plans import pipelines as PL
from corpusprep.sources import readers as R
from corpusprep.sources import versions as V
from corpusprep.sources import writers as W

SCHEMA = StructType([StructField("k", StringType()), StructField("n", IntegerType()), StructField("absent", StringType())])


def test_rows_that_do_not_parse_keep_their_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,n\na,1\nb\n"c\nc",3,x\nd,four\ne, 5 \nNA,\n', encoding="utf-8")
    checked = R.read_csv_checked(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert sorted(map(tuple, R.good(checked).collect()), key=repr) == sorted([("a", 1, None), ("e", 5, None), (None, None, None)], key=repr)
    found = R.bad(checked).orderBy("row").collect()
    assert [(r.row, r.reason, r.record) for r in found] == [
        (1, "not 2 fields", "b"), (2, "not 2 fields", '"c\nc",3,x'), (3, "n is not int", '{"k":"d","n":"four"}')]
    assert all(r.file.endswith("/a.csv") and r.block == 0 for r in found)
    # without types only the number of fields can be wrong, and every row is in one channel
    plain = R.read_csv_checked(spark, str(tmp_path / "a.csv"))
    assert (R.good(plain).count(), R.bad(plain).count()) == (4, 2)
    assert sorted(r.k for r in R.good(plain).select("k").collect() if r.k) == ["a", "d", "e"]  # whichever columns are used


def test_several_files_and_no_header(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("1,x\n2\n3,y\n")
    checked = R.read_csv_checked(spark, str(tmp_path), names=["n", "k"], multi_line=False)
    assert sorted((os.path.basename(r.file), r.record) for r in R.bad(checked).collect()) == [("a.csv", "2"), ("b.csv", "2")]
    assert R.good(checked).count() == 4


def test_short_lexicon_rows(spark, tmp_path):
    (tmp_path / "l.csv").write_text('type,form,x,y,url\nword,abu,,,https://d/x\nword,"sh""ort"\n\nword,b,,,u,1,2,3,4\n')
    checked = R.read_lexicon_checked(spark, str(tmp_path / "l.csv"))
    assert [(r.reason, r.record) for r in R.bad(checked).collect()] == [("fewer than 5 fields", 'word,"sh""ort"')]
    assert sorted(r.form for r in R.good(checked).collect()) == ["abu", "b", "form"]


def test_a_split_is_a_partition(spark, tmp_path):
    rows = spark.createDataFrame([("a", "é", "train"), ("b", None, "train"), ("c", "z", "validation")], "input_text string, target_text string, split string")
    assert W.write_jsonl_by_split(rows, str(tmp_path / "p")) == {"train_rows": 2, "validation_rows": 1}
    back = R.read_pair_splits(spark, str(tmp_path / "p"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    plan = back.filter("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "split#" in plan.split("PartitionFilters")[1][:80]
    assert back.filter("split = 'train'").inputFiles() and all("split=train" in f for f in back.filter("split = 'train'").select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    by_name = R.read_pair_splits(spark, {"train": str(tmp_path / "p/split=train"), "validation": str(tmp_path / "p/split=validation")})
    assert sorted(map(tuple, by_name.collect()), key=repr) == sorted(map(tuple, back.collect()), key=repr)


def test_empty_split_is_counted(spark, tmp_path):
    none = spark.createDataFrame([], "input_text string, target_text string, split string")
    assert W.write_jsonl_by_split(none, str(tmp_path / "p")) == {"train_rows": 0, "validation_rows": 0}


def test_make_split_evaluates_the_rows_once(spark, tmp_path):
    """Three passes over the keys for the cut, one over the rows: the input's rows are read four times."""
    from pyspark.sql import Observation

    n = 500
    spark.range(n).select(F.col("id").cast("string").alias("oare_id"), F.lit(None).cast("string").alias("sentence_uuid"), F.concat(F.lit("t"), "id").alias("transliteration_with_annotations"),
                          F.lit("x").alias("translation")).write.option("header", True).csv(str(tmp_path / "in"))
    PL.make_split(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    meta = [json.loads(line) for f in os.listdir(tmp_path / "out/meta") if f.endswith(".json") for line in open(tmp_path / "out/meta" / f)]
    assert meta == [{"train_rows": 450, "validation_rows": 50}]
    split = SP.split_exact(spark.range(n).select(F.col("id").cast("string").alias("k")), F.col("k"))
    seen = Observation()
    split.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy("split").json(str(tmp_path / "once"))
    assert seen.get["n"] == n


PAYLOADS = [(f"https://d/x?word=w{i}", json.dumps([{"meaning": f"meaning {i}"}])) for i in range(4)]


def queue_of(spark, *rows):
    return spark.createDataFrame([(t, u, i) for i, (t, u) in enumerate(rows)], "token string, url string, ordinal long")


def test_a_second_run_parses_only_what_is_new(spark, tmp_path):
    payloads = spark.createDataFrame(PAYLOADS, "url string, payload string")
    out = str(tmp_path / "out")
    first = [("a", PAYLOADS[0][0]), ("b", PAYLOADS[0][0]), ("c", PAYLOADS[1][0]), ("no", "https://d/nothing")]
    counters = lambda r: tuple(r.collect()[0])
    assert counters(PL.add_definitions(queue_of(spark, *first), payloads, out, "word=", "word")) == (4, 3, 2, 1)
    assert counters(PL.add_definitions(queue_of(spark, *first), payloads, out, "word=", "word")) == (4, 0, 0, 0)
    # the known URL keeps its stored text even if its payload is gone; unknown payloads give ''
    gone = payloads.filter(F.col("url") != PAYLOADS[0][0])
    more = [*first, ("d", PAYLOADS[0][0]), ("e", PAYLOADS[2][0]), ("f", "https://d/x?word=unknown")]
    assert counters(PL.add_definitions(queue_of(spark, *more), gone, out, "word=", "word")) == (7, 3, 2, 1)
    rows = {r.word: (r.definition, r.parsed) for r in V.read_versions(spark, f"{out}/store", DI.STORE_SCHEMA).collect()}
    assert rows == {"a": ("meaning 0", True), "b": ("meaning 0", True), "c": ("meaning 1", True), "d": ("meaning 0", False), "e": ("meaning 2", True), "f": ("", True)}
    back = R.read_definitions_csv(spark, f"{out}/definitions")
    assert {r.word for r in back.collect()} == set("abcdef")


def test_a_version_without_its_mark_does_not_count(spark, tmp_path):
    root = str(tmp_path / "store")
    assert V.committed(spark, root) == [] and V.read_versions(spark, root, "a int").count() == 0
    assert V.add_version(spark.range(3).select(F.col("id").cast("int").alias("a")), root) == 1
    assert V.add_version(spark.range(2).select(F.col("id").cast("int").alias("a")), root) == 2
    os.remove(f"{root}/version=2/_SUCCESS")
    assert V.committed(spark, root) == [1] and V.read_versions(spark, root, "a int").count() == 3
    assert V.add_version(spark.range(5).select(F.col("id").cast("int").alias("a")), root) == 2
    assert V.read_versions(spark, root, "a int").count() == 8 and V.read_versions(spark, root, "a int", upto=1).count() == 3


@pytest.mark.parametrize("share", [0.1, 0.5])
def test_group_split_of_the_exact_size(spark, share):
    """Whole groups, at most one group above the law's size, for even, skewed and missing keys."""
    cases = {
        "even": spark.range(1000).select((F.col("id") % 97).cast("string").alias("g"), "id"),
        "third in one": spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"), "id"),
        "one": spark.range(100).select(F.lit(None).cast("string").alias("g"), "id"),
    }
    for df in cases.values():
        out = SP.split_group_exact(df, F.col("g"), share=share)
        groups = out.groupBy("g").agg(F.count_distinct("split").alias("sides"), F.count("*").alias("n"), F.max("split").alias("s"),
                                      F.max(SP.order_hash(F.coalesce("g", F.lit("")))).alias("h")).orderBy("h").collect()
        law, n_val = SP.validation_size(df.count(), share), sum(g.n for g in groups if g.s == "validation")
        last = [g for g in groups if g.s == "validation"][-1]
        assert all(g.sides == 1 for g in groups) and n_val >= law > n_val - last.n
        assert [g.s for g in groups] == sorted((g.s for g in groups), reverse=True)  # in hash order
    assert SP.split_group_exact(spark.range(0).select(F.lit("x").alias("g")), F.col("g")).count() == 0
