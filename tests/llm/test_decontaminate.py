import random

import pytest

from corpusprep.llm import decontaminate as D
from oracle import compare, duck


def brute(text, items, window=10):
    """Every window of every item against every place of the text."""
    w, hit, ids = D.words(text), set(), set()
    for item, t in items:
        x = D.words(t)
        k = min(window, len(x))
        grams = {tuple(x[i:i + k]) for i in range(len(x) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in grams:
                ids.add(item)
                hit.update(range(i, i + k))
    return len(w), hit, ids


def some_items(r, letters):
    return [(str(i), " ".join(r.choice(letters) for _ in range(r.choice([0, 1, 3, 5, 9, 10, 11, 14, 30])))) for i in range(r.randint(1, 6))]


def test_automaton_against_brute_force():
    r = random.Random(1)
    for _ in range(300):
        letters = [*"abcd"][:r.randint(1, 4)]
        items, window = some_items(r, letters), r.choice([3, 5, 10])
        known = D.compile_block([(i, D.words(t), True) for i, t in items if D.words(t)], window) if any(t for _, t in items) else None
        for _ in range(4):
            text = " ".join(r.choice(letters + ["zz"]) if r.random() < 0.9 else r.choice(items)[1] for _ in range(r.randint(0, 40)))
            _, hit, ids = brute(text, items, window)
            spans, found, longest = known.scan(D.words(text)) if known else ([], set(), 0)
            assert {x for s, e in spans for x in range(s, e)} == hit and found == ids
            assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and longest <= max([e - s for s, e in spans], default=0)


def test_words_are_the_contracts():
    import re

    text = "Ab-c9 É\x00ñ_x\x7f{Z}~ é`a@b[c]"
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    assert [w.decode() for w in D.words(text)] == re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    assert D.words(None) == D.words("") == D.words(" .\n") == []


SCHEMA = "doc_id long, text string, item string, Spans0 string"


def edge_docs(items):
    long = items[0][1]
    rows = [(1, None, "a", None), (2, "", "a", "b"), (3, "...", None, None), (4, long.upper(), "x", "y"), (4, long.upper(), "x", "y"), (None, "q " + long + " q", None, None),
            (5, "filler words " * 50_000 + long, "x", None), (6, items[1][1], None, None), (7, " ".join(long.split()[:9]), None, None)]
    return rows


@pytest.mark.parametrize("block_words", [200_000, 40])
def test_scan_on_edge_rows(spark, block_words):
    """Nulls, empty and very long texts, repeated rows and items, item ids null or repeated, one or many blocks, an item longer than a block."""
    r = random.Random(2)
    letters = [f"w{i}" for i in range(30)]
    items = [("1", " ".join(r.choice(letters) for _ in range(120))), ("2", "only three words"), ("2", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), ("", "w7 w7 w7 w7"), ("9", None), ("10", "")]
    items += [(str(20 + i), " ".join(r.choice(letters) for _ in range(15))) for i in range(12)]
    table = spark.createDataFrame([(None if i == "" else int(i), t, "clash") for i, t in [*items, items[1]]], "item_id long, text string, n_words string")
    rows = edge_docs(items) + [(100 + i, " ".join(r.choice([x for _, x in items if x] + letters) for _ in range(20)), None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = D.scan(docs, table, block_words=block_words).collect()
    got = sorted(((x["doc_id"], x["text"], x["n_words"], tuple(tuple(s) for s in x["spans"]), tuple(x["items"])) for x in out), key=repr)
    want = []
    for doc, text, *_ in rows:
        n, hit, ids = brute(text, items)
        spans, last = [], None
        for h in sorted(hit):
            if last is None or h > last + 1:
                spans.append([h, h + 1])
            spans[-1][1] = h + 1
            last = h
        want.append((doc, text, n, tuple(map(tuple, spans)), tuple(sorted(ids))))
    assert got == sorted(want, key=repr)


def test_spans_that_touch_are_one():
    items = [("a", "x y"), ("b", "z t")]
    known = D.compile_block([(i, D.words(t), True) for i, t in items], 10)
    assert known.scan(D.words("q x y z t x y")) == ([(1, 7)], {"a", "b"}, 2)
    assert D.merged([(0, 2), (5, 6)], [(2, 4), (5, 9)]) == [(0, 4), (5, 9)]


def test_empty_tables_and_names(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d", "s")], "doc_id long, text string, SPANS string")
    with pytest.raises(ValueError):
        D.scan(docs, items)
    plain = docs.drop("SPANS")
    assert D.scan(plain.limit(0), items).count() == 0
    assert [(r["n_words"], r["spans"], r["items"], r["longest"]) for r in D.scan(plain, items.limit(0)).collect()] == [(4, [], [], 0)]
    assert D.scan(plain, items, drop_text=True).columns == ["doc_id", *D.NAMES]


def test_decontaminate_removes_spans_and_documents(spark):
    item = " ".join(f"w{i}" for i in range(20))
    clean = "nothing to see here, really nothing. "
    rows = [(1, clean * 20 + item.upper() + ", the end", "p"), (2, item + " tail", "p"), (3, clean, "p"), (4, None, None), (5, "", None), (None, clean, "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = D.decontaminate(docs, items)
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"], r["spans"]) for r in out.collect()), key=repr) == sorted(
        [(1, clean * 20 + ", the end", "p"), (3, clean, "p"), (4, None, None), (5, "", None), (None, clean, "p")], key=repr)
    kept = D.decontaminate(docs, items, max_words=25, max_coverage=1.0)
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(t or "" for _, t, _ in rows)


def test_query_matches_sql(spark):
    from corpusprep.llm.registry import OP11_SQL, op11_decontaminate

    sf = "/root/testdata/sf0.001"
    assert compare(spark, sf, op11_decontaminate, OP11_SQL, duck(sf))["hash_match"]
