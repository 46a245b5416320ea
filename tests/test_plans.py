"""Plan shape: pushdown and pruning reach the scans, no row-at-a-time Python UDF anywhere, the
dictionary is broadcast, the exact split never sorts the data globally."""

import pytest

import __spark_entry__ as E
from corpusprep.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "scan_filter_pairs")
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)" in p
    p = plan(spark, "align_sentences")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p and "lang" not in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_at_a_time_python(spark, name):
    p = plan(spark, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    if name not in ("predict_blank_passthrough", "predict_loaded", "prediction_summary", "segment_table"):
        assert "MapInPandas" not in p and "MapInArrow" not in p


def test_annotation_broadcasts_dictionary(spark):
    assert "BroadcastHashJoin" in plan(spark, "annotate")


def test_exact_split_has_no_global_sort_or_window(spark):
    p = plan(spark, "split_exact")
    assert "Window" not in p and "SinglePartition" not in p and "TakeOrderedAndProject" not in p


def test_annotation_identifies_rows_below_the_explode(spark):
    """The row's hash is computed once a row, not once a token; rows and glosses meet in one exchange by it."""
    lines = plan(spark, "annotate").split("\n")
    generate = next(i for i, x in enumerate(lines) if "Generate explode" in x and "__row" in "".join(lines[i:i + 1]) or "Generate explode(concat(" in x)
    identity = [i for i, x in enumerate(lines) if "md5(" in x]
    assert identity and min(identity) > generate  # a plan prints its inputs below
    assert sum("Exchange hashpartitioning(__id" in x for x in lines) == 1
    assert not any("posexplode" in x or "array_sort" in x for x in lines[:generate])


def test_fallback_texts_are_cleaned_apart_from_the_sentences(spark):
    """Chain A stands twice in the plan: over the sentences' own pieces, and over documents; no text of a document
    travels with a sentence through the alignment."""
    p = E.queries()["clean_train"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Seal Impression") <= 2 * 3 + 8  # the damage itself names it too
    for line in p.split("\n"):
        if "Join" in line and "_doc" in line:
            assert "_last_text" not in line


def test_named_splits_prune_partitions(spark):
    df = E.queries()["named_splits"](spark, SF).filter("split = 'validation'")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in p
