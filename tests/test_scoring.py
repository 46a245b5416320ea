"""Batches by bytes, set-up once a worker, halving after failures."""

import os
import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import scoring as SC
from corpusprep.operators import stats as ST


def test_batches_hold_their_budget_and_the_order():
    r = random.Random(1)
    for _ in range(200):
        texts = ["é" * r.randint(0, 30) for _ in range(r.randint(0, 40))]
        max_bytes, max_rows = r.randint(1, 80), r.randint(1, 9)
        cuts = list(SC.packed(texts, max_bytes, max_rows))
        assert [i for a, b in cuts for i in range(a, b)] == list(range(len(texts)))
        for a, b in cuts:
            size = sum(len(t.encode()) for t in texts[a:b])
            assert b - a <= max_rows and (size <= max_bytes or b - a == 1)


def test_failed_batches_are_halved():
    calls = []

    def predictor(texts):
        calls.append(len(texts))
        if sum(map(len, texts)) > 40:
            raise MemoryError
        return [t.upper() for t in texts]

    texts = [f"text {i:03d}" for i in range(100)]
    runner = SC.Runner(predictor, 10_000, 64, (MemoryError,))
    assert runner.all(texts) == [t.upper() for t in texts]
    assert runner.max_rows <= 5 and calls[-1] <= 5  # the smaller size is kept
    with pytest.raises(MemoryError):
        SC.Runner(predictor, 10_000, 64, (MemoryError,)).all(["x" * 41])
    with pytest.raises(ValueError):
        SC.Runner(lambda ts: ts[1:], 10, 10, ()).all(["a", "b"])
    with pytest.raises(ZeroDivisionError):  # other errors are not swallowed
        SC.Runner(lambda ts: 1 / 0, 10, 10, (MemoryError,)).all(["a"])


def test_same_predictions_for_any_budget(spark):
    rows = [(i, None if i % 11 == 0 else " " if i % 7 == 0 else f"w{i} " * (i % 40)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(5)
    want = {i: " ".join(reversed((t or "").split())) for i, t in rows}
    for kw in ({}, {"batch_bytes": 1}, {"batch_bytes": 200, "batch_rows": 3}):
        out = SC.predict(df, SC.reverse_words, "t", **kw)
        assert {r.k: r.predicted_translation for r in out.collect()} == want
    with pytest.raises(ValueError):
        SC.predict(df, None, "t")


def test_the_model_is_set_up_once_a_worker(spark, tmp_path):
    folder = str(tmp_path)

    def setup():
        import os as o
        import uuid

        open(o.path.join(folder, f"{o.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda texts: [t[::-1] for t in texts]

    df = spark.range(400).select(F.concat(F.lit("row "), F.col("id")).alias("t")).repartition(40)
    assert sorted(r.predicted_translation for r in SC.predict(df, None, "t", setup=setup).collect()) == sorted(f"row {i}"[::-1] for i in range(400))
    pids = [f.split("-")[0] for f in os.listdir(folder)]
    assert len(pids) == len(set(pids)) <= 40


def test_merged_sketches_are_as_good_as_exact_ranks(spark):
    df = spark.range(40_000).select((F.col("id") % 4).alias("part"), F.repeat(F.lit("x"), (F.pow(F.rand(1), 3) * 3000).cast("int")).alias("t"))
    merged = ST.merge_sketches(ST.length_sketches(df, "part", ["t"]), ["column"])
    found = ST.rank_errors(ST.sketch_quantiles(merged, tuple(i / 20 for i in range(1, 20))), df, ["t"]).collect()
    assert len(found) == 19 and all(r.rows == 40_000 and r.error <= ST.KLL_ERROR for r in found)
    small = ST.length_sketches(df.limit(0), "part", ["t"])
    assert small.count() == 0
