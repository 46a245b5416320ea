import pytest
from pyspark.sql import functions as F

from corpusprep.llm import mixing


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 0.5, "b": 0.3, "c": 0.2}, {f"s{i}": 1 + i % 3 for i in range(20)}, {"a": 0.97, "b": 0.01, "c": 0.02}])
def test_less_than_one_block_off_in_a_cycle(weights):
    q = mixing.quotas(weights, 1000)
    assert sum(q.values()) == 1000 and min(q.values()) >= 1
    done = dict.fromkeys(q, 0)
    for t, (s, k) in enumerate(mixing.edf_cycle(q), 1):
        assert k == done[s]
        done[s] += 1
        assert all(abs(done[x] * 1000 - q[x] * t) < 1000 for x in q)


def test_phases_use_every_block():
    blocks, weights = {"a": 7, "b": 2000, "c": 1, "d": 0}, {"a": 1, "b": 2, "c": 5, "d": 1}
    phases = mixing.plan(blocks, weights, 100)
    used = {s: sum(p.blocks.get(s, 0) for p in phases) for s in blocks}
    assert used == blocks and sum(p.length for p in phases) == sum(blocks.values())
    assert mixing.plan({}, weights) == []


def brute_order(rows, weights, seed, block_rows, cycle):
    """Simulation slot by slot: (doc_id, source) -> position."""
    import hashlib

    weights = {mixing.OTHER: sum(weights.values()) / len(weights)} | weights
    queues = {}
    for rid, s in sorted(rows, key=lambda r: (hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0)):
        queues.setdefault(s if s in weights else mixing.OTHER, []).append(rid)
    blocks = {s: [q[i:i + block_rows] for i in range(0, len(q), block_rows)] for s, q in queues.items()}
    slot, out = 0, []
    while any(blocks.values()):
        live = {s: b for s, b in blocks.items() if b}
        q = mixing.quotas({s: weights[s] for s in live}, cycle)
        done, t = dict.fromkeys(live, 0), 0
        while all(live.values()):
            free = [s for s in live if done[s] * cycle // q[s] <= t]
            s = min(free, key=lambda s: (-(-(done[s] + 1) * cycle // q[s]), s))
            out += [(rid, slot, slot * block_rows + i) for i, rid in enumerate(blocks[s].pop(0))]
            done[s] += 1
            slot, t = slot + 1, t + 1
    return sorted(out, key=repr)


def test_rows_against_a_simulation(spark):
    rows = [(i, f"s{i % 3}") for i in range(200)] + [(1000 + i, "s0") for i in range(300)] + [(2000, None), (2001, "unknown"), (None, "s1"), (None, None)]
    df = spark.createDataFrame([(r[0], r[1], "t") for r in rows], "doc_id long, source string, slot string").repartition(5)
    weights = {"s0": 1.0, "s1": 3.0, "s2": 2.0}
    timed, (slot, pos) = mixing.positions(df, weights, "x", 4, 50)
    got = sorted(((r["doc_id"], r[slot], r[pos]) for r in timed.collect()), key=repr)
    assert got == brute_order(rows, weights, "x", 4, 50)
    mixed = mixing.mix(df, weights, "x", 4, 50)
    assert mixed.columns == df.columns
    order = [r["doc_id"] for r in mixed.withColumn("i", F.monotonically_increasing_id()).orderBy("i").collect()]
    assert order == [g[0] for g in sorted(got, key=lambda g: g[2])]


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(empty, {"a": 1.0}).count() == 0
    same = spark.createDataFrame([(1, "a", "t")] * 40, "doc_id long, source string, text string")
    timed, (_, pos) = mixing.positions(same, {"a": 1.0})
    assert sorted(r[pos] for r in timed.collect()) == list(range(40))
    with pytest.raises(ValueError):
        mixing.positions(same, {"a": 0})


def test_query_positions_all_rows(spark):
    import corpus_pipeline
    from corpusprep.llm.registry import op3_mixing

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(((r["doc_id"], r["slot"], r["position"]) for r in op3_mixing(spark, sf).collect()), key=repr)
    assert got == brute_order(rows, corpus_pipeline.MIX_WEIGHTS, "mix", mixing.BLOCK_ROWS, mixing.CYCLE)


@pytest.mark.parametrize("weights", [{f"s{i:02d}": 1 + i % 2 for i in range(20)}, {"a": 1 / 3, "b": 2 / 3}, {"a": 0.7, "b": 0.2995, "c": 0.0005}, {"a": 0.1234567890123, "b": 0.8765432109877}])
def test_less_than_one_block_off_the_weights_over_many_cycles(weights):
    from fractions import Fraction

    blocks = {s: int(9000 * w / sum(weights.values())) + 1 for s, w in weights.items()}
    phases = mixing.plan(blocks, weights)
    total, done = sum(map(Fraction, weights.values())), dict.fromkeys(weights, 0)
    assert phases[0].length > 8000 and {s: sum(p.blocks.get(s, 0) for p in phases) for s in blocks} == blocks
    for t in range(1, phases[0].length + 1):
        s, k = phases[0].slots[(t - 1) % phases[0].cycle]
        assert k + (t - 1) // phases[0].cycle * phases[0].quota[s] == done[s]
        done[s] += 1
        for x, w in weights.items():
            assert abs(done[x] - float(Fraction(w) / total * t)) < 1 + 1e-9, (x, t)


def test_rows_of_weights_without_a_short_cycle(spark):
    rows = [(i, f"s{i % 2}") for i in range(400)] + [(1000 + i, "s0") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    with pytest.raises(ValueError, match="slots"):  # the driver's schedule is bounded by the weights alone
        mixing.positions(df, {"s0": 0.8765432109877, "s1": 0.1234567890123}, "x", 4)
    weights = {"s0": 0.8765, "s1": 0.1235}
    timed, (slot, pos) = mixing.positions(df, weights, "x", 4)
    assert sorted(((r["doc_id"], r[slot], r[pos]) for r in timed.collect()), key=repr) == brute_order(rows, weights, "x", 4, 1000)


def test_no_python_in_plan(spark):
    import re

    from corpusprep.llm.registry import op3_mixing

    plan = op3_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow|ExistingRDD", plan)
