import hashlib

import pyarrow as pa

from corpusprep.llm import exact
from oracle import compare, duck


def test_directory_doubling():
    buckets = exact.split_directory({0: 10, 1: 10, 2**16 - 1: 5000}, bucket_rows=12)
    assert sum(1 << (16 - d) for _, d, _ in buckets) == 2**16 and [b[0] for b in buckets] == sorted(b[0] for b in buckets)
    assert (0, 16, 10) in buckets and (2**16 - 1, 16, 5000) in buckets  # a full cell stays as a chain
    own = exact.owners(buckets, 4)
    assert (own[1:] >= own[:-1]).all() and own.max() <= 3
    assert exact.split_directory({}) == [(0, 0, 0)]


def brute(rows):
    groups = {}
    for rid, text, *_ in rows:
        groups.setdefault((text or "").encode().lower(), []).append(rid)
    out = []
    for norm, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = True
        for i in ids:
            kept = i == keep and stays
            stays &= not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(norm).hexdigest()))
    return sorted(out, key=repr)


def test_groups_and_kept_rows(spark):
    long = "long " * 200_000
    rows = [(1, "A b", "p"), (2, "a B", "q"), (2, "a B", "q"), (3, None, "r"), (4, "", None), (5, "É", "p"), (6, "é", "p"), (7, long, "s"), (8, long.upper(), "s"),
            (None, "null id", "a"), (None, "NULL id", "b"), (9, "null", "c"), (None, "a b", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, size string").repartition(3)
    got = sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["sha"]).hex()) for r in exact.exact_groups(df).collect()), key=repr)
    assert got == brute(rows)
    kept = exact.exact_dedup(df)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]), r["size"]) for r in kept.collect()) == [
        ("2", "q"), ("4", None), ("5", "p"), ("6", "p"), ("8", "s"), ("9", "c"), ("None", "a")]


def test_equal_keys_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact, "_key", lambda digest: 5)
    entries = [list(exact._merge_batches(exact.owners([(0, 0, 9)], 1), 0, 1)(iter(spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "A"), (4, "c"), (5, "b")], "id long, text string").toArrow().to_batches())))]
    out = [r for b in exact._chain_batches(2, 0, 1)(iter(entries[0])) for r in b.to_pylist()]
    assert sorted((r["c0"], r["c4"]) for r in out) == [(3, 2), (4, 1), (5, 2)]


def test_workers_hold_and_return_small_pieces():
    """Texts of a whole batch are not held beside it, and batches leave in pieces: an executor's memory does not go by the copies."""
    texts = [f"{i} " + "wide text " * 500 for i in range(3000)] + ["3 " + "WIDE text " * 500] * 3 + [None, "", "y" * (3 * exact.PIECE_BYTES)]
    batch = pa.RecordBatch.from_pydict({"c0": pa.array(range(len(texts)), pa.int64()), "c1": pa.array(texts, pa.string())})
    held = pa.total_allocated_bytes()
    table, tops, merged = exact.owners([(0, 0, 9)], 1), [], []
    for b in exact._merge_batches(table, 0, 1)(iter([batch])):
        tops.append(pa.total_allocated_bytes() - held)
        assert b.num_rows == 1 or b.num_rows <= exact.PIECE_ROWS and b.column(1).nbytes <= exact.PIECE_BYTES + 8 * b.num_rows
        merged += b.to_pylist()
        del b
    assert len(tops) > 3 and sorted(tops)[-2] < batch.nbytes
    assert [(r["c0"], r["c5"]) for r in merged if r["c5"] > 1] == [(3002, 4), (3004, 2)] and len(merged) == 3002
    entries = pa.Table.from_pylist(sorted(merged, key=lambda r: r["c3"])).cast(pa.schema(
        [("c0", pa.int64()), ("c1", pa.string()), ("c2", pa.int32()), ("c3", pa.int64()), ("c4", pa.binary()), ("c5", pa.int64())])).combine_chunks().to_batches()
    out = list(exact._chain_batches(2, 0, 1)(iter(entries + entries)))
    assert max(b.num_rows for b in out) <= exact.PIECE_ROWS + 1 and len(out) > 6
    assert sum(r["c4"] for b in exact._chain_batches(2, 0, 1)(iter(entries)) for r in b.to_pylist()) == len(texts)


def test_an_open_chain_passes_from_batch_to_batch():
    """Copies of a text that lie in several batches are one group; its row does not keep the batches it came from."""
    schema = pa.schema([("c0", pa.int64()), ("c1", pa.string()), ("c2", pa.int32()), ("c3", pa.int64()), ("c4", pa.binary()), ("c5", pa.int64())])
    make = lambda rows: pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
    held, most = pa.total_allocated_bytes(), []

    def batches():
        yield make([(1, "wide " * 200_000, 0, 4, b"w", 1), (500, "same", 0, 5, b"s", 2)])
        for i in range(5):
            yield make([(i, "same", 0, 5, b"s", 2)])
            most.append(pa.total_allocated_bytes() - held)

    out = []
    for b in exact._chain_batches(2, 0, 1)(batches()):
        out += [(r["c0"], r["c4"]) for r in b.select(["c0", "c4"]).to_pylist()]
        del b
    assert out == [(1, 1), (500, 12)]
    assert max(most) < 100_000


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert exact.exact_groups(empty).count() == 0 and exact.exact_dedup(empty).count() == 0


def test_query_matches_sql(spark):
    from corpusprep.llm.registry import OP2_SQL, op2_exact_dedup

    sf = "/root/testdata/sf0.001"
    assert compare(spark, sf, op2_exact_dedup, OP2_SQL, duck(sf))["hash_match"]


def index_rows(spark, path):
    buckets, version = exact.read_directory(spark, path)
    rows = {}
    for r in exact._buckets(spark, path, buckets).collect():
        norm = exact.normalised(r["text"])
        assert norm not in rows and r["key"] == exact._key(hashlib.sha256(norm).digest()) and bytes(r["sha"]) == hashlib.sha256(norm).digest()
        cell = (r["key"] % 2**64) >> (64 - exact.MAX_DEPTH)
        first, depth = next((f, d) for f, d, _, _ in reversed(buckets) if f <= cell)
        assert r["bucket"] == first and cell < first + (1 << (exact.MAX_DEPTH - depth))
        rows[norm] = (r["id"], r["size"])
    assert sum(k for _, _, k, _ in buckets) == len(rows)
    return rows, buckets, version


def grouped(rows):
    out = {}
    for rid, text in rows:
        norm = exact.normalised(text)
        old = out.get(norm, (None, 0))
        out[norm] = (max((x for x in (old[0], rid) if x is not None), default=None), old[1] + 1)
    return out


def test_an_index_is_kept_looked_up_and_extended(spark, tmp_path):
    path = str(tmp_path / "index")
    first = [(i, f"text {i % 150}") for i in range(200)] + [(None, "no id"), (None, None), (500, "")]
    make = lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(3)
    exact.write_index(make(first), path, bucket_rows=20)
    rows, buckets, version = index_rows(spark, path)
    assert rows == grouped(first) and version == 1 and len(buckets) > 5 and max(b[2] for b in buckets) <= 20
    # a second batch: copies in another case, new texts, repeated rows; untouched buckets keep their files
    second = [(900 + i, f"TEXT {i}") for i in range(3)] + [(1000 + i, f"new {i}") for i in range(10)] + [(2, "text 2")]
    exact.add_to_index(make(second), path, bucket_rows=20)
    rows, after, version = index_rows(spark, path)
    assert rows == grouped(first + second) and version == 2
    assert {b[3] for b in after} == {1, 2} and {b[:2] for b in after if b[3] == 1} <= {b[:2] for b in buckets}
    # a third one overflows buckets: the directory doubles where they are
    third = [(5000 + i, f"many {i}") for i in range(600)]
    exact.add_to_index(make(third), path, bucket_rows=20)
    rows, last, version = index_rows(spark, path)
    assert rows == grouped(first + second + third) and len(last) > len(after) and max(b[2] for b in last) <= 20
    asked = [(1, "Text 7"), (2, "many 599"), (3, "unknown"), (4, None), (None, "NO ID"), (1, "Text 7")]
    got = sorted(((r["doc_id"], r["text"], r["known_id"], r["known_size"], r["key"]) for r in exact.look_up(make(asked), path).collect()), key=repr)
    want = grouped(first + second + third)
    assert got == sorted(((i, t, *want.get(exact.normalised(t), (None, None)), "x") for i, t in asked), key=repr)


def test_a_lost_run_leaves_the_index_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(30)], "doc_id long, text string")
    exact.write_index(docs, path)
    before = index_rows(spark, path)[0]

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(exact, "_save_directory", lost)
        try:
            exact.add_to_index(docs, path)
        except RuntimeError:
            pass
    assert index_rows(spark, path)[0] == before
    exact.add_to_index(docs, path)  # what the lost run left behind is written over
    assert index_rows(spark, path)[0] == {t: (i, 2 * n) for t, (i, n) in before.items()}
