import random

import numpy as np
import pytest

from corpusprep.llm import negatives as N
from oracle import compare, duck


@pytest.mark.parametrize("size,bias", [(64, 256), (0, 0), (1, 1), (3, 2**40), (5, 3), (64, 2**12), (64, 2**28), (2, 2**62)])
def test_packed_scores_are_exact(size, bias):
    r = random.Random(size + bias)
    p = N.Packing(size, bias)
    draw = lambda n: np.array([[r.choice([-bias, bias, r.randint(-bias, bias)]) for _ in range(size)] for _ in range(n)], p.plain).reshape(n, size)
    c, a = draw(23), draw(7)
    sums = a.sum(axis=1) if size else np.zeros(7, p.plain)
    got = p.scores(c, np.ascontiguousarray(p.shifted(a).T), sums)
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(i, j)) for j in a] for i in c]


def brute(rows, positives=5, negatives=3, low=50, high=95, every=50):
    """rows: (id, label, vector). Ids are unique or null."""
    use = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    first = lambda found: sorted(found, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
    out = []
    for i, label, v in use:
        if i is None or i % every:
            continue
        others = [(j, dot(v, w), m == label) for j, m, w in use if j is None or j != i]
        for p, ps, _ in first([x for x in others if x[2]])[:positives]:
            band = first([x for x in others if not x[2] and low * ps <= 100 * x[1] <= high * ps])[:negatives]
            out += [(i, p, k, n, ps, ns) for k, (n, ns, _) in enumerate(band, 1)]
    fits = lambda x: x if abs(x) <= N.LONG else None
    return sorted(((*x[:4], fits(x[4]), fits(x[5])) for x in out), key=repr)


SCHEMA = "vec_id long, label string, vector array<long>, score string, anchor string, rank int"


def mined(spark, rows, **more):
    table = spark.createDataFrame([(*r, "s", "a", 1) for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(x) for x in N.mine(table, table["vec_id"] % 50 == 0, **more).collect()), key=repr)


@pytest.mark.parametrize("anchors,wide", [(2048, 1), (3, 1), (2048, 10**13)])
def test_against_brute_force(spark, anchors, wide):
    """Ties, repeated vectors, short and empty vectors, nulls in every column, negative and zero scores, many blocks, wide numbers."""
    r = random.Random(anchors + wide)
    rows = [(i, r.choice([*"abc"]), [wide * r.randint(-2, 6) for _ in range(r.choice([4, 4, 4, 3, 0]))]) for i in range(260)]
    rows += [(i, "a", [wide, wide, wide, wide]) for i in range(300, 420)] + [(i, "b", [wide, wide, wide, 0]) for i in range(420, 520)]
    rows += [(None, "a", [wide] * 4), (None, "b", [wide, wide, wide, 0]), (550, None, [wide] * 4), (600, "a", None), (650, "a", [1, None]), (700, "alone", [9 * wide] * 4), (750, "a", [0] * 4)]
    assert mined(spark, rows, anchors=anchors) == brute(rows)


def test_repeated_ids_are_the_anchor_itself(spark):
    rows = [(50, "a", [2, 0]), (50, "a", [2, 0]), (50, "b", [2, 1]), (1, "a", [3, 0]), (2, "b", [2, 0]), (3, "c", [2, 0])]
    assert mined(spark, rows) == [(50, 1, 1, 2, 6, 4), (50, 1, 2, 3, 6, 4), (50, 2, 1, 3, 4, 4)][:2]


def test_empty_tables_and_parameters(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert N.mine(empty, empty["vec_id"] % 50 == 0).count() == 0
    assert mined(spark, [(1, "a", [1]), (2, "a", [1]), (3, "b", [1])]) == []  # no anchors
    rows = [(0, "a", [10]), (1, "a", [10]), (2, "a", [8]), (3, "b", [7]), (4, "b", [9]), (5, "c", [2])]
    assert mined(spark, rows, positives=1, negatives=2, low=0, high=100) == brute(rows, 1, 2, 0, 100)


def test_not_finite_components(spark, tmp_path):
    from corpusprep.llm.registry import op13_negatives

    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.1], 1), (1, [0.9, 0.0], 1), (2, [nan, 1.0], 1), (3, [inf, 1.0], 1), (4, [None, 1.0], 1), (5, None, 1), (6, [1.0, 1.0], None),
            (8, [0.7, 0.0], 2), (9, [-inf, 0.0], 2), (7, [0.6, -0.001], 1), (10, [0.5, 0.5], 3)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(x) for x in op13_negatives(spark, str(tmp_path)).collect())
    q = [(i, 2 if i == 7 else 2 if i == 0 else c, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v, c in rows if i not in (2, 3, 4, 5, 6, 9)]
    assert got == brute(q) and got


def test_query_matches_sql(spark):
    from corpusprep.llm.registry import OP13_SQL, op13_negatives

    sf = "/root/testdata/sf0.001"
    assert compare(spark, sf, op13_negatives, OP13_SQL, duck(sf))["hash_match"]
