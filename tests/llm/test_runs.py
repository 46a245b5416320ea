import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from corpusprep.llm import runs as R

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(w, shortest=6, least=4):
    """All lags, all places; periods checked against every smaller one."""
    n, out = len(w), []
    for q in range(1, n // least + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            x = w[i:j + q]
            if len(x) >= max(shortest, least * q) and not any(x[p:] == x[:len(x) - p] for p in range(1, q)):
                out.append((i, len(x), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_text(r):
    letters, t = [b"a", b"b", b"c", b"d", b"e"][:r.randint(1, 5)], []
    for _ in range(r.randint(0, 6)):
        if r.random() < 0.6:
            p = [r.choice(letters) for _ in range(r.randint(1, 9))]
            x = p * r.randint(1, 8)
            t += x[:len(x) - r.randint(0, len(p) - 1)]
        else:
            t += [r.choice([*letters, b"%f" % r.random()]) for _ in range(r.randint(0, 10))]
    return t


def test_runs_against_brute_force():
    r = random.Random(5)
    for _ in range(800):
        texts, least, shortest = [some_text(r) for _ in range(r.randint(0, 5))], r.choice([3, 4, 4, 5]), r.choice([1, 6, 9])
        for t, (found, stays) in zip(texts, R.runs_of(texts, shortest, least), strict=True):
            want = brute(t, shortest, least)
            drop = {i for s, n, q in want for i in range(s + q, s + n)}
            assert found == want
            assert drop == (set() if stays is None else {i for i in range(len(t)) if not stays[i]})


def test_every_word_of_a_segment_is_frequent_in_it():
    import numpy as np

    r = random.Random(6)
    for _ in range(200):
        ids = np.array([r.randint(0, 9) if r.random() < 0.8 else 100 + r.randint(0, 50) for _ in range(r.randint(1, 120))])
        a, b = R.segments(ids, np.array([0]), np.array([len(ids)]), 4, 6)
        left, stack = [], [(0, len(ids))]
        while stack:  # the plain recursion
            s, e = stack.pop()
            part = ids[s:e].tolist()
            cuts = [s + i for i, x in enumerate(part) if part.count(x) < 4]
            if not cuts:
                left += [(s, e)] if e - s >= 6 else []
            else:
                stack += [(x + 1, y) for x, y in zip([s - 1, *cuts], [*cuts, e], strict=True) if y > x + 1]
        assert sorted(left) == list(zip(a.tolist(), b.tolist()))


def test_long_texts_take_no_quadratic_time():
    r = random.Random(7)
    fib = [[b"a"], [b"a", b"b"]]
    while len(fib[-1]) < 200_000:
        fib.append(fib[-1] + fib[-2])
    peeled = [b"%d" % (i // 3) for i in range(200_000)]
    for t in (fib[-1], [b"a"] * 200_000, [r.choice([b"a", b"b"]) for _ in range(200_000)], [b"%d" % (i % 40_000) for i in range(200_000)], peeled):
        (found, _), = R.runs_of([t])
        assert all(n >= max(6, 4 * q) for _, n, q in found)
    assert [x for x, _ in R.runs_of([[b"%d" % (i % 40_000) for i in range(200_000)]])] == [[(0, 200_000, 40_000)]]


def contract(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute([x.encode() for x in w])
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_against_brute_force(spark, tmp_path):
    """Nulls, blank and long texts, repeated rows and ids, ties, planted repetitions, extra columns."""
    from corpusprep.llm.registry import op12_runs

    r = random.Random(8)
    rows = [(None, None), (None, "a a a a a a"), (1, ""), (2, " \n\t"), (3, "x\x0by\x0cz z " * 5), (4, "a b " * 4 + "c d " * 4), (5, "Ab aB " * 6)]
    rows += [(i, " ".join(x.decode() for x in some_text(r) + some_text(r))) for i in range(10, 250)] + [(6, "a " * 3000)] * 2
    rows += [(i, " ".join(str(k) for k in range(i % 60))) for i in range(250, 450)]
    spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, runs string, w int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = op12_runs(spark, str(tmp_path))
    assert tuple(out.columns) == COLUMNS
    assert sorted((tuple(x) for x in out.collect()), key=repr) == sorted((contract(*x) for x in rows), key=repr)


def test_query_on_a_whole_table(spark):
    from corpusprep.llm.registry import op12_runs

    sf = "/root/testdata/sf0.001"
    docs = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    short = {d: t for d, t in docs if len(WORD.findall(t or "")) < 2000}
    got = {x["doc_id"]: tuple(x) for x in op12_runs(spark, sf).collect()}
    assert len(got) == len(docs) and all(got[d] == contract(d, t) for d, t in short.items())


def test_find_runs_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "go go go go go go now", "x"), (2, None, None)], "doc_id long, text string, collapsed_ string")
    out = R.find_runs(docs).orderBy("doc_id").collect()
    assert [(x["collapsed"], [tuple(y) for y in x["runs"]], x["collapsed_"]) for x in out] == [("go now", [(0, 6, 1)], "x"), ("", [], None)]
    assert R.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        R.find_runs(docs.withColumnRenamed("collapsed_", "Collapsed"))
    with pytest.raises(ValueError):
        R.find_runs(docs, min_exponent=2)
