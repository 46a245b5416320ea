import random
import re

import numpy as np
import pytest
import xxhash

from corpusprep.llm import components, simhash


def brute_fingerprint(text, shingle=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, max_bits=2):
    """rows (id, fingerprint) -> smallest reachable id of each row."""
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= max_bits:
                comp[find(i)] = find(j)
    low = {}
    for i, (rid, _) in enumerate(rows):
        if rid is not None:
            low[find(i)] = min(low.get(find(i), rid), rid)
    return [low.get(find(i)) for i in range(len(rows))]


def test_code_is_perfect():
    for code, rows in ((simhash.GOLAY, 2048), (simhash.HAMMING, 16)):
        patterns, mask = simhash._covering(code, 2)[0]
        assert mask.sum() == rows and patterns.shape[1] == 1  # each syndrome has one leader within the radius


@pytest.mark.parametrize("blocks,replicas", [(2, 61), (3, 153)])
def test_covering_finds_every_close_pair(blocks, replicas):
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**63), 2**63, size=2000, dtype=np.int64)
    assert abs(len(simhash.covering_anchors(x, 2, blocks)[0]) / len(x) - replicas) < 3
    for t in (0, 1, 2, 3):
        x = rng.integers(-(2**63), 2**63, size=500, dtype=np.int64)
        flips = [rng.choice(64, size=rng.integers(0, t + 1), replace=False) for _ in x]
        y = np.array([np.int64(np.uint64(a) ^ np.uint64(sum(1 << int(b) for b in f))) if False else a ^ np.array(sum(1 << int(b) for b in f), dtype=np.uint64).astype(np.int64) for a, f in zip(x, flips)])
        anchors, rows = simhash.covering_anchors(y, t, blocks)
        have = set(zip(rows.tolist(), anchors.tolist()))
        assert len(have) == len(anchors)
        assert all((i, int(h)) in have for i, h in enumerate(simhash.home_anchor(x, blocks)))


def test_fingerprint_cases(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " \n", "A", "a B", "a b c", "É a b c d", *[" ".join(rng.choices("ab cd Ef gh \x0b".split(" "), k=rng.randrange(1, 60))) for _ in range(60)]]
    for size in (1 << 20, 5):
        monkeypatch.setattr(simhash, "_PIECE", size)
        for t in texts:
            assert simhash.fingerprint(t) == brute_fingerprint(t), (size, t)


def near_texts(rng, n=120):
    out = []
    for _ in range(n // 6):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(3, 400))]
        for _ in range(6):
            edited = list(words)
            edited[rng.randrange(len(words))] = f"w{rng.randrange(5000)}"
            out.append(" ".join(edited))
    return out


def test_components_against_all_pairs(spark):
    rng = random.Random(2)
    texts = near_texts(rng) + [None, "", None, "one", "ONE", "one"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "one", "y"), (None, "lonely text of its own", "y"), (3, texts[3], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = sorted((str(r["id"]), r["fp"] % 2**64, r["component"]) for r in simhash.simhash_components(df).collect())
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = sorted((str(f[0]), f[1], c) for f, c in zip(fps, brute_components(fps)))
    assert got == want
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns
    ids = sorted((str(r["doc_id"]), r["text"]) for r in kept.collect())
    roots = {c for c in brute_components(fps) if c is not None}
    assert ids == sorted([(str(c), texts[c]) for c in roots] + [("None", "lonely text of its own")])


def test_query_on_whole_table(spark):
    from corpusprep.llm.registry import op1_simhash

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fps = [(d["doc_id"], brute_fingerprint(d["text"])) for d in docs]
    want = sorted((i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_components(fps)))
    assert sorted(tuple(r) for r in op1_simhash(spark, sf).collect()) == want


def test_chain_and_empty(spark):
    from corpusprep.llm.components import connected_components

    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert len(got) == 203 and len({got[i] for i in range(201)}) == 1 and got[1000] == got[1001] != got[0]
    assert connected_components(links.limit(0)).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(empty).count() == 0 and simhash.near_dedup(empty).count() == 0


def test_three_blocks_give_the_same_links(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(-(2**63), 2**63, size=150, dtype=np.int64)
    fps = list(base)
    for x in base:
        for _ in range(3):
            bits = rng.choice(64, size=rng.integers(1, 4), replace=False)
            fps.append(x ^ np.array(sum(1 << int(b) for b in bits), dtype=np.uint64).astype(np.int64))
    table = spark.createDataFrame([(int(x),) for x in set(fps)], "fp long")
    known = [int(x) for x in set(fps)]
    want = {(u, v) for u in known for v in known if u < v and ((u ^ v) % 2**64).bit_count() <= 2}
    for blocks in (2, 3):
        assert {tuple(r) for r in simhash.fingerprint_links(table, 2, blocks).collect()} == want
    with pytest.raises(ValueError):
        simhash.fingerprint_links(table, 2, 4)


@pytest.mark.parametrize("query", ["components", "near_dedup"])
def test_no_table_of_documents_or_fingerprints_is_broadcast(spark, monkeypatch, query):
    """A broadcast join builds its table in the driver's memory, and it is chosen by the compressed size."""
    plans, write = [], simhash.saved

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    for module in (simhash, components):
        monkeypatch.setattr(module, "saved", seen)
    rng = random.Random(4)
    df = spark.createDataFrame(list(enumerate(near_texts(rng))), "doc_id long, text string")
    out = simhash.simhash_components(df) if query == "components" else simhash.near_dedup(df)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans)
    assert not any("Broadcast" in p for p in plans)
