"""Exact dedup over an extendible-hash index on shared files.

Key: the first 64 bits of the SHA-256 of a text after lower-casing A-Z. The directory starts as one
bucket and doubles: an overfull bucket is split on its next key bit until it holds at most
``bucket_rows`` distinct keys or the depth limit is reached; what is still too much stays in the
bucket as a chain. Contiguous runs of buckets, hence key ranges, belong to owner tasks. Entries go to
their owner, which walks its range in key order, chains the texts of equal keys, compares their bytes,
and writes its bucket file of finished groups to the shared folder. Copies are merged inside each
Arrow batch before the shuffle, so a text that fills a third of the table reaches its owner as one
entry a batch.

The index can be kept: write_index puts directory and bucket files into a folder, look_up finds which texts of a
table it holds, and add_to_index takes in a further batch, reading and rewriting only the buckets that it
touches and splitting those that overflow. Every change is a new version; the directory, written last,
makes it valid, so a run that is lost half-way leaves the index as it was.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import col, for_workers, partitions, private, refuse, saved
from corpusprep.sources.versions import committed

MAX_DEPTH = 16  # directory of at most 2^16 cells: the only thing that reaches the driver
BUCKET_ROWS = 4096
PIECE_ROWS, PIECE_BYTES = 512, 1 << 20  # of the batches that leave a worker


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes A-Z only


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def _entry_batches(batches):
    for b in batches:
        digests = [hashlib.sha256(normalised(t.as_py())).digest() for t in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([_key(d) for d in digests], pa.int64()), pa.array(digests, pa.binary())], names=["id", "key", "sha"])


def split_directory(cells: dict[int, int], bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> list[tuple[int, int, int]]:
    """Directory doubling on the histogram of the keys' first ``max_depth`` bits.

    Returns buckets (first cell, local depth, keys) in key order; together they cover all cells.
    """
    sums = [0]
    for c in range(1 << max_depth):
        sums.append(sums[-1] + cells.get(c, 0))
    out, todo = [], [(0, 0)]
    while todo:
        first, depth = todo.pop()
        width = 1 << (max_depth - depth)
        keys = sums[first + width] - sums[first]
        if keys > bucket_rows and depth < max_depth:
            todo += [(first + width // 2, depth + 1), (first, depth + 1)]
        else:
            out.append((first, depth, keys))
    return out


def owners(buckets: list[tuple[int, int, int]], n: int, max_depth: int = MAX_DEPTH) -> np.ndarray:
    """Owner of each cell: contiguous runs of whole buckets with about equal numbers of keys."""
    total, before = max(1, sum(k for _, _, k in buckets)), 0
    table = np.zeros(1 << max_depth, dtype=np.int32)
    for first, depth, keys in buckets:
        table[first:first + (1 << (max_depth - depth))] = min(n - 1, before * n // total)
        before += keys
    return table


def _pick(rows: list[int], ids, rest) -> int:
    """Of rows with equal texts: the largest id, nulls last, ties by the other columns' values."""
    return max(rows, key=lambda i: (ids[i] is not None, ids[i] or 0, rest(i)))


def _merge_batches(table: np.ndarray, id_at: int, text_at: int):
    """Rows of docs -> one row for each distinct text of a batch, with owner, key, sha and count.

    Only digests are held for a batch; texts of equal digests are normalised again and their bytes compared. The rows
    leave in pieces, so beside the batch a worker holds little."""

    def run(batches):
        for b in batches:
            texts = b.column(text_at)
            norm = lambda i, texts=texts: normalised(texts[i].as_py())
            by_digest: dict[bytes, list[list[int]]] = {}
            groups, digests, sizes = [], [], []
            for i in range(b.num_rows):
                text = norm(i)
                digest = hashlib.sha256(text).digest()
                same = by_digest.setdefault(digest, [])
                group = next((g for g in same if norm(g[0]) == text), None)
                if group is None:
                    group = []
                    same.append(group)
                    groups.append(group)
                    digests.append(digest)
                    sizes.append(len(text))
                group.append(i)
            ids = b.column(id_at).to_pylist() if any(len(g) > 1 for g in groups) else None
            rest = lambda i, b=b: repr(b.slice(i, 1).to_pylist())
            best = [g[0] if len(g) == 1 else _pick_largest(g, ids, rest) for g in groups]
            keys = [_key(d) for d in digests]
            cell = (np.array(keys, dtype=np.int64).view(np.uint64) >> np.uint64(64 - MAX_DEPTH)).astype(np.int64)
            for at, to in _pieces(sizes):
                kept = b.take(pa.array(best[at:to], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(table[cell[at:to]], pa.int32()), pa.array(keys[at:to], pa.int64()), pa.array(digests[at:to], pa.binary()),
                     pa.array([len(g) for g in groups[at:to]], pa.int64())],
                    names=[f"c{i}" for i in range(b.num_columns + 4)])

    return run


def _pieces(sizes: list[int]):
    """(from, to) of stretches of at most PIECE_ROWS rows and, but for a single row, PIECE_BYTES bytes of text."""
    at = held = 0
    for i, size in enumerate(sizes):
        if i > at and (i - at >= PIECE_ROWS or held + size > PIECE_BYTES):
            yield at, i
            at, held = i, 0
        held += size
    if sizes:
        yield at, len(sizes)


def _pick_largest(rows: list[int], ids, rest) -> int:
    top = max((ids[i] for i in rows if ids[i] is not None), default=None)
    tied = [i for i in rows if ids[i] == top]
    return tied[0] if len(tied) == 1 else _pick(tied, ids, rest)


def _chain_batches(n_cols: int, id_at: int, text_at: int):
    """Entries in key order -> finished groups: the row that stays, its key, sha and the group's size.

    No row outlives its batch but those of the chain that is still open, which are copied out of it."""

    def run(batches):
        at_key, chain, done = None, [], []  # chain: [text, row, id, sha, size]

        def flush():
            rows = [e[1] for e in done]
            sizes, shas = pa.array([e[4] for e in done], pa.int64()), pa.array([e[3] for e in done], pa.binary())
            table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            done.clear()
            return pa.RecordBatch.from_arrays([*table.columns[:n_cols], table.column(n_cols + 1), shas, sizes],
                                              names=[f"c{i}" for i in range(n_cols + 3)])

        held = 0
        for b in batches:
            keys, shas, counts = (b.column(n_cols + k).to_pylist() for k in (1, 2, 3))
            ids, texts = b.column(id_at).to_pylist(), b.column(text_at)
            for i, key in enumerate(keys):
                if key != at_key:
                    done += chain
                    at_key, chain = key, []
                text = normalised(texts[i].as_py())
                row, rid = b.slice(i, 1), ids[i]
                for e in chain:
                    if e[0] == text:
                        e[4] += counts[i]
                        if (rid is not None, rid or 0) > (e[2] is not None, e[2] or 0) or (
                                rid == e[2] and repr(row.to_pylist()[0]) > repr(e[1].to_pylist()[0])):
                            e[1], e[2] = row, rid
                        break
                else:
                    chain.append([text, row, rid, shas[i], counts[i]])
                    held += len(text)
                if len(done) >= PIECE_ROWS or held > PIECE_BYTES and done:
                    held = 0
                    yield flush()
            if done:
                held = 0
                yield flush()
            for e in chain:
                e[1] = e[1].take(pa.array([0], pa.int64()))  # a slice would keep the whole batch
        done += chain
        if done:
            yield flush()

    return run


def text_entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, sha) of every row, saved in the shared folder."""
    for_workers(docs.sparkSession)
    slim = docs.select(col(id_col).cast("long"), col(text_col).cast("string"))
    return saved(slim.mapInArrow(_entry_batches, "id long, key long, sha binary"), "exact-entries")


def build_directory(entries: DataFrame, bucket_rows: int = BUCKET_ROWS) -> list[tuple[int, int, int]]:
    """The directory of all distinct keys; at most 2^MAX_DEPTH counts reach the driver."""
    cell = F.shiftrightunsigned("key", 64 - MAX_DEPTH).cast("int")
    counts = entries.groupBy("key").agg(F.lit(1).alias("one")).groupBy(cell.alias("cell")).count()
    return split_directory({r["cell"]: r["count"] for r in counts.collect()}, bucket_rows)


def build_index(docs: DataFrame, directory: list[tuple[int, int, int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: the columns of docs of the row that stays, then the three private
    columns key, sha and size (last in this order).

    The row that stays has the largest id; null ids come last; ties are broken by the other columns.
    """
    spark = docs.sparkSession
    for_workers(spark)
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    n, own, key, sha, size = partitions(spark), *private(docs, "owner", "key", "sha", "size")
    extra = [T.StructField(own, T.IntegerType()), T.StructField(key, T.LongType()), T.StructField(sha, T.BinaryType()), T.StructField(size, T.LongType())]
    nullable = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]
    merged = docs.mapInArrow(_merge_batches(owners(directory, n), id_at, text_at), T.StructType(nullable + extra))
    owned = merged.repartitionById(n, F.col(own)).sortWithinPartitions(key)
    return owned.mapInArrow(_chain_batches(len(docs.columns), id_at, text_at), T.StructType(nullable + extra[1:]))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, one for each distinct text (equal after lower-casing A-Z; null is empty).

    An empty table gives no rows. Columns and their order are those of docs.
    """
    directory = build_directory(text_entries(docs, id_col, text_col))
    return build_index(docs, directory, id_col, text_col).select(*[col(c) for c in docs.columns])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, sha (binary).

    Of rows that repeat both id and text, one is kept. A group whose ids are all null has keep_id
    null and keeps one row.
    """
    spark = docs.sparkSession
    entries = text_entries(docs, id_col, text_col)
    directory = build_directory(entries)
    slim = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    index = build_index(slim, directory, "id", "text")
    key, sha, size = index.columns[-3:]
    index = saved(index.select(F.col("id").alias("keep_id"), F.col(sha).alias("sha"), F.col(size).alias("group_size")), "exact-index")
    rows = entries.groupBy("id", "sha").agg(F.count(F.lit(1)).alias("n"))
    return (
        rows.join(index.filter("group_size > 1"), "sha", "left")
        .select("id", "sha", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
        .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
        .select("id", "keep_id", "group_size", "kept", "sha")
    )


# -- an index kept on shared files ------------------------------------------------------------------
_BUCKET_SCHEMA = "key long, sha binary, text string, id long, size long"
_DIRECTORY_SCHEMA = "first int, depth int, keys long, version int"


def _cell(key):
    return F.shiftrightunsigned(key, 64 - MAX_DEPTH).cast("int")


def _save_directory(spark, path: str, buckets: list[tuple[int, int, int, int]], version: int) -> None:
    """buckets: (first cell, local depth, keys, version of its file), at most 2^MAX_DEPTH."""
    spark.createDataFrame(buckets, _DIRECTORY_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/directory/version={version}")


def read_directory(spark, path: str) -> tuple[list[tuple[int, int, int, int]], int]:
    """The buckets of the last complete version, in key order, and its number."""
    done = committed(spark, f"{path}/directory")
    if not done:
        raise ValueError(f"no index at {path}")
    rows = spark.read.schema(_DIRECTORY_SCHEMA).parquet(f"{path}/directory/version={done[-1]}").collect()
    return sorted((r["first"], r["depth"], r["keys"], r["version"]) for r in rows), done[-1]


def _cells_of(spark, buckets: list[tuple[int, int, int, int]]) -> DataFrame:
    """(cell, bucket, version) of all 2^MAX_DEPTH cells: bounded, so it may be broadcast."""
    rows = spark.createDataFrame(buckets, _DIRECTORY_SCHEMA)
    width = F.pow(F.lit(2.0), F.lit(MAX_DEPTH) - F.col("depth")).cast("int")
    return rows.select(F.explode(F.sequence("first", F.col("first") + width - 1)).alias("cell"), F.col("first").alias("bucket"), F.col("version"))


def _buckets(spark, path: str, buckets: list[tuple[int, int, int, int]], only: set[int] | None = None) -> DataFrame:
    """The groups in the files of some buckets, with ``bucket``: only their folders are read."""
    out = spark.createDataFrame([], _BUCKET_SCHEMA + ", bucket int")
    by_version: dict[int, list[int]] = {}
    for first, _, keys, version in buckets:
        if keys and (only is None or first in only):
            by_version.setdefault(version, []).append(first)
    for version, firsts in sorted(by_version.items()):
        files = spark.read.schema(_BUCKET_SCHEMA + ", bucket int").parquet(f"{path}/buckets/version={version}")
        out = out.unionByName(files.filter(F.col("bucket").isin(firsts)))
    return out


def _write_buckets(groups: DataFrame, path: str, buckets: list[tuple[int, int, int, int]], version: int) -> None:
    """One file a bucket, sorted by key. Contiguous runs of buckets go to one task."""
    spark = groups.sparkSession
    n = partitions(spark)
    table = owners([(f, d, k) for f, d, k, _ in buckets], n)
    own = spark.createDataFrame([(f, int(table[f])) for f, _, _, _ in buckets], "bucket int, part int")
    cells = _cells_of(spark, buckets).join(own, "bucket").select("cell", "bucket", "part")
    placed = groups.withColumn("cell", _cell(F.col("key"))).join(F.broadcast(cells), "cell")
    placed = placed.repartitionById(n, F.col("part")).sortWithinPartitions("bucket", "key", "sha").drop("cell", "part")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/buckets/version={version}")


def _groups(docs: DataFrame, buckets: list[tuple[int, int, int]], id_col: str, text_col: str) -> DataFrame:
    slim = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    index = build_index(slim, buckets, "id", "text")
    key, sha, size = index.columns[-3:]
    return index.select(F.col(key).alias("key"), F.col(sha).alias("sha"), F.coalesce("text", F.lit("")).alias("text"), "id", F.col(size).alias("size"))


def write_index(docs: DataFrame, path: str, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """A new index of the texts of docs below ``path``: bucket files of (key, sha, text, id, size), one row a distinct
    text with its largest id and number of rows, and the directory. An empty table gives an empty index."""
    spark = docs.sparkSession
    directory = build_directory(text_entries(docs, id_col, text_col), bucket_rows)
    buckets = [(*b, 1) for b in directory]
    _write_buckets(_groups(docs, directory, id_col, text_col), path, buckets, 1)
    _save_directory(spark, path, buckets, 1)


def look_up(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str] = ("known_id", "known_size")) -> DataFrame:
    """docs plus the id and the group size that the index holds for the row's text (null: not in the index). The
    directory names the bucket of every key; texts meet by bucket and key, and their bytes decide."""
    refuse(docs, *names)
    spark = docs.sparkSession
    for_workers(spark)
    buckets, _ = read_directory(spark, path)
    key, bucket, norm, cell = private(docs, "key", "bucket", "norm", "cell")
    rows = docs.withColumn(norm, _normal(F.coalesce(col(text_col).cast("string"), F.lit(""))))
    digest = F.substring(F.sha2(F.col(norm).cast("binary"), 256), 1, 16)
    rows = rows.withColumn(key, _signed_hex(digest)).withColumn(cell, _cell(F.col(key)))
    rows = rows.join(F.broadcast(_cells_of(spark, buckets).select(F.col("cell").alias(cell), F.col("bucket").alias(bucket))), cell)
    held = _buckets(spark, path, buckets).select(
        F.col("bucket").alias(bucket + "2"), F.col("key").alias(key + "2"), _normal(F.col("text")).alias(norm + "2"), F.col("id").alias(names[0]), F.col("size").alias(names[1]))
    same = (F.col(bucket) == F.col(bucket + "2")) & (F.col(key) == F.col(key + "2")) & (F.col(norm) == F.col(norm + "2"))
    return rows.join(held, same, "left").select(*[col(c) for c in docs.columns], *names)


def _normal(text):
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _signed_hex(digest):
    """The signed 64-bit number of 16 hex digits."""
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def add_to_index(docs: DataFrame, path: str, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Take the texts of docs into the index: groups grow and keep their largest id, new texts are new groups. Only
    buckets that docs' keys fall into are read and written again; those that overflow are split."""
    spark = docs.sparkSession
    buckets, version = read_directory(spark, path)
    new = saved(_groups(docs, [b[:3] for b in buckets], id_col, text_col), "exact-batch")
    cells = new.select(_cell(F.col("key")).alias("cell")).distinct()
    touched = {r["bucket"] for r in cells.join(F.broadcast(_cells_of(spark, buckets)), "cell").select("bucket").distinct().collect()}  # at most 2^MAX_DEPTH
    if not touched:
        return
    both = _buckets(spark, path, buckets, touched).drop("bucket").unionByName(new)
    groups = both.groupBy("key", "sha", _normal(F.col("text")).alias("norm")).agg(
        F.max_by("text", F.struct(F.col("id").isNotNull(), F.col("id"), F.col("text"))).alias("text"), F.max("id").alias("id"), F.sum("size").alias("size")).drop("norm")
    groups = saved(groups.select("key", "sha", "text", "id", "size"), "exact-grown")
    counts = {r["cell"]: r["count"] for r in groups.groupBy(_cell(F.col("key")).alias("cell")).count().collect()}
    grown = []
    for first, depth, _, _ in (b for b in buckets if b[0] in touched):
        width = 1 << (MAX_DEPTH - depth)
        inside = {c - first: n for c, n in counts.items() if first <= c < first + width}
        grown += [(first + f, depth + d, k, version + 1) for f, d, k in split_directory(inside, bucket_rows, MAX_DEPTH - depth)]
    kept = [b for b in buckets if b[0] not in touched]
    _write_buckets(groups, path, sorted(kept + grown), version + 1)
    _save_directory(spark, path, sorted(kept + grown), version + 1)
