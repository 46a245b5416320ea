"""Hard-negative mining with exact integer scores from Kronecker-packed products.

Vectors are integers. For a set of anchors, every task packs its candidates: components are shifted by a
bias so that none is negative, and the same component of several candidates is placed in separate fields
of one wide integer. The anchor's components are shifted too. One multiplication a component of the
anchor then serves all candidates of the word; fields are so wide that sums of all components never run
into the next field. Unpacked sums less the bias terms are the exact inner products.

Words have 64 bits where a field fits (two fields for unit vectors of 64 components in steps of 1/256),
else as many bits as LANES fields need (Python integers, slower, exact for any size).

Anchors are taken in blocks of bounded size, broadcast one at a time; the vectors of all rows are read in
place for every block, and only the best few candidates of each task are shuffled. First pass: the
positives (same label). Second pass: the different-label rows within each positive's band of scores.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import col, for_workers, forget, saved, work_dir

ANCHORS = 2048  # anchors a block
LANES = 8
CHUNK = 1024  # candidates scored at a time
LONG, WIDEST = 2**63 - 1, 10**38 - 1  # WIDEST: of decimal(38, 0)


class Packing:
    """Fields for vectors of ``size`` components of at most ``bias`` in magnitude."""

    def __init__(self, size: int, bias: int):
        self.size, self.bias = size, bias
        self.bits = max(1, (size * (2 * bias) ** 2).bit_length())
        self.lanes = 64 // self.bits if self.bits <= 62 else LANES
        self.kind, self.plain = (np.uint64, np.int64) if self.bits <= 62 else (object, object)

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """Candidates (rows) become words: candidate lane * words + i is field ``lane`` of word i."""
        n = -(-len(rows) // self.lanes)
        full = np.zeros((n * self.lanes, self.size), self.kind)
        full[:len(rows)] = self.shifted(rows)
        full = full.reshape(self.lanes, n, self.size)
        out = full[0].copy()
        for lane in range(1, self.lanes):
            out += full[lane] << self._number(lane * self.bits)
        return out

    def shifted(self, rows: np.ndarray) -> np.ndarray:
        return (rows.astype(self.plain) + self.bias).astype(self.kind)

    def _number(self, x: int):
        return np.uint64(x) if self.kind is np.uint64 else x

    def scores(self, rows: np.ndarray, anchors: np.ndarray, anchor_sums: np.ndarray) -> np.ndarray:
        """Exact inner products, candidates by anchors; ``anchors`` shifted, components first."""
        words = self.pack(rows)
        sums = words @ anchors if self.kind is object else np.einsum("wd,da->wa", words, anchors)
        low = self._number((1 << self.bits) - 1)
        fields = np.concatenate([(sums >> self._number(lane * self.bits)) & low for lane in range(self.lanes)])[:len(rows)]
        plain = fields.astype(self.plain)
        own = rows.astype(self.plain).sum(axis=1) if self.size else np.zeros(len(rows), self.plain)
        return plain - self.bias * own[:, None] - self.bias * anchor_sums[None, :] - self.size * self.bias**2


class Best:
    """The k best (score, then smaller id, null ids last) of every column, from candidates in any order."""

    def __init__(self, columns: int, k: int, least: np.ndarray):
        """least: what a score must reach, by column."""
        self.k, self.need = k, least.copy()
        self.column, self.score = np.zeros(0, np.int64), np.zeros(0, least.dtype)
        self.id, self.null = np.zeros(0, np.int64), np.zeros(0, bool)
        self.last = np.full(columns, LONG)  # the id of the k-th best

    def offer(self, column: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        use = (score > self.need[column]) | (ids < self.last[column])  # equal scores count with a smaller id only
        if not use.any():
            return
        column, score, ids, null = column[use], score[use], ids[use], null[use]
        self.column, self.score = np.append(self.column, column), np.append(self.score, score)
        self.id, self.null = np.append(self.id, ids), np.append(self.null, null)
        if self.score.dtype == object:
            order = np.array(sorted(range(len(self.score)), key=lambda i: (self.column[i], -self.score[i], self.null[i], self.id[i])))
        else:
            order = np.lexsort((self.id, self.null, -self.score, self.column))
        c = self.column[order]
        head = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        rank = np.arange(len(c)) - np.repeat(head, np.diff(np.append(head, len(c))))
        order = order[rank < self.k]
        last = rank[rank < self.k] == self.k - 1
        self.column, self.score, self.id, self.null = (x[order] for x in (self.column, self.score, self.id, self.null))
        full = self.column[last]
        self.need[full], self.last[full] = self.score[last], np.where(self.null[last], LONG, self.id[last])


def _matrix(column: pa.Array, size: int, kind) -> np.ndarray:
    """A list column as rows of ``size`` components; shorter vectors end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), size), kind)
    if len(flat):
        out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class Block:
    """A block of anchors, as broadcast: ids, labels and vectors; ``bands`` are the positives' bands."""

    def __init__(self, ids: list, labels: list, rows: np.ndarray, packing: Packing, bands=None):
        self.null = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.known = {x: k for k, x in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([self.known[x] for x in labels], np.int64)
        self.packing, self.bands = packing, bands
        self.sums = rows.astype(packing.plain).sum(axis=1) if packing.size else np.zeros(len(ids), packing.plain)
        self.shifted = np.ascontiguousarray(packing.shifted(rows).T)
        self.order = np.argsort(self.ids, kind="stable")

    def itself(self, ids: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(candidate, anchor) pairs of one id: such rows count as the anchor itself."""
        a = self.ids[self.order]
        low, high = np.searchsorted(a, ids), np.searchsorted(a, ids, side="right")
        n = np.where(null, 0, high - low)
        at = np.repeat(np.arange(len(ids)), n)
        anchor = self.order[np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
        real = ~self.null[anchor]
        return at[real], anchor[real]


def _rows(batches, packing: Packing):
    """(ids, null, labels, vectors) by at most CHUNK rows; the first chunks are small, to learn what a score needs."""
    size = 32
    for b in batches:
        at = 0
        while at < b.num_rows:
            part = b.slice(at, size)
            at, size = at + size, min(CHUNK, 2 * size)
            ids = part.column(0)
            yield (ids.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(ids.is_null()), part.column(1).to_pylist(),
                   _matrix(part.column(2), packing.size, packing.plain))


def _none(packing: Packing, n: int) -> np.ndarray:
    return np.full(n, -(2**62) if packing.plain is np.int64 else -(2**400), packing.plain)


def _positives(sent, k: int):
    def run(batches):
        block: Block = sent.value
        p, best = block.packing, Best(len(block.ids), k, _none(block.packing, len(block.ids)) + 1)
        for ids, null, labels, rows in _rows(batches, p):
            code = np.array([block.known.get(x, -1) for x in labels], np.int64)
            for label in np.unique(code[code >= 0]).tolist():
                mine, columns = np.flatnonzero(code == label), np.flatnonzero(block.labels == label)
                scores = p.scores(rows[mine], block.shifted[:, columns], block.sums[columns])
                self_at, self_col = block.itself(ids[mine], null[mine])
                place = np.searchsorted(columns, self_col)
                own = (place < len(columns)) & (columns[np.minimum(place, len(columns) - 1)] == self_col)
                scores[self_at[own], place[own]] = _none(p, 1)[0]
                i, j = np.nonzero(scores >= best.need[columns][None, :])
                best.offer(columns[j], scores[i, j], ids[mine][i], null[mine][i])
        yield from _emit(best, lambda c: {"anchor": pa.array(c, pa.int64())})

    return run


def _negatives(sent, k: int):
    def run(batches):
        block: Block = sent.value
        p, (owner, low, high) = block.packing, block.bands  # by band: anchor, smallest and largest score
        best = Best(len(owner), k, low)
        for ids, null, labels, rows in _rows(batches, p):
            code = np.array([block.known.get(x, -1) for x in labels], np.int64)
            scores = p.scores(rows, block.shifted, block.sums)
            scores[code[:, None] == block.labels[None, :]] = _none(p, 1)[0]
            scores[block.itself(ids, null)] = _none(p, 1)[0]
            for turn in _turns(owner):  # one band of every anchor at a time
                mine = scores if len(turn) == scores.shape[1] else scores[:, owner[turn]]
                i, j = np.nonzero((mine >= best.need[turn][None, :]) & (mine <= high[turn][None, :]))
                best.offer(turn[j], mine[i, j], ids[i], null[i])
        yield from _emit(best, lambda c: {"band": pa.array(c, pa.int64())})

    return run


def _turns(owner: np.ndarray) -> list[np.ndarray]:
    """Bands (sorted by anchor) in turns that hold each anchor once at most."""
    head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    nth = np.arange(len(owner)) - np.repeat(head, np.diff(np.append(head, len(owner))))
    return [np.flatnonzero(nth == t) for t in range(int(nth.max(initial=-1)) + 1)]


def _emit(best: Best, key):
    score = pa.array(best.score, pa.int64()) if best.score.dtype != object else pa.array(
        [Decimal(max(-WIDEST, min(WIDEST, int(s)))) for s in best.score], pa.decimal128(38, 0))
    yield pa.RecordBatch.from_pydict(key(best.column) | {"id": pa.array(best.id, pa.int64(), mask=best.null), "score": score})


def _top(partial: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _bands(found: list, low: int, high: int, packing: Packing):
    """Rows (anchor, rank, id, score) sorted; a band runs from low % to high % of the positive's score, both included."""
    owner = np.array([r["anchor"] for r in found], np.int64)
    lows = np.array([-(-low * int(r["score"]) // 100) for r in found], packing.plain)
    highs = np.array([high * int(r["score"]) // 100 for r in found], packing.plain)
    return owner, lows, highs


def usable(rows: DataFrame, vector_col: str, label_col: str) -> DataFrame:
    """Rows with a label and a vector of finite components only."""
    v, wild = col(vector_col), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return rows.filter(col(label_col).isNotNull() & v.isNotNull()).filter(~F.coalesce(F.exists(v, wild), F.lit(False)))


def mine(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, id_col: str = "vec_id",
         label_col: str = "label", vector_col: str = "vector", anchors: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor and each of its
    ``positives`` best rows of the same label, the ``negatives`` best rows of another label whose score lies between
    low and high per cent of the positive's score. Scores are exact inner products; ties go by smaller id.

    ``is_anchor`` is a condition on rows. Ids are integers, vectors arrays of integers. Rows with a null label, vector or
    component take no part; a shorter vector counts as filled with zeros. A row with a null id is never an anchor; as a
    candidate it comes last among ties and is reported as null. Rows that share an anchor's id count as the anchor
    itself; rows of an anchor's id that differ are anchors of their own, equal ones are one anchor. Scores beyond long
    order exactly (up to 38 digits) and are reported as null. No rows or no anchors give no rows.
    """
    if not 0 <= low <= high:
        raise ValueError("0 <= low <= high")
    spark = rows.sparkSession
    for_workers(spark)
    vector = col(vector_col)
    kept = usable(rows, vector_col, label_col).select(
        col(id_col).cast("long").alias("id"), col(label_col).alias("label"), vector.cast("array<long>").alias("vector"),
        (F.coalesce(is_anchor, F.lit(False)) & col(id_col).isNotNull()).alias("anchor"))
    table = saved(kept, "vectors")
    seen = table.agg(F.max(F.size("vector")).alias("size"), F.max(F.array_max("vector")).alias("high"),
                     F.min(F.array_min("vector")).alias("low"), F.count_if("anchor").alias("n")).first()
    out = work_dir(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    blocks = -(-(seen["n"] or 0) // anchors)
    if blocks:
        packing = Packing(seen["size"] or 0, max(abs(seen["high"] or 0), abs(seen["low"] or 0)))
        some = table.filter("anchor").select("id", "label", "vector").distinct()
        some = saved(some.withColumn("block", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)).cast("int")), "anchors")
        slim = table.select("id", "label", "vector")
        for n in range(blocks):
            _mine_block(slim, some.filter(F.col("block") == n), packing, positives, negatives, low, high, f"{out}/block={n}")
        forget(some)
        result = spark.read.schema(schema).parquet(*[f"{out}/block={n}" for n in range(blocks)])
    else:
        result = spark.createDataFrame([], schema)
    return result


def _mine_block(table: DataFrame, block: DataFrame, packing: Packing, positives: int, negatives: int, low: int, high: int, path: str) -> None:
    spark, kind = table.sparkSession, "decimal(38,0)" if packing.plain is object else "long"
    held = sorted(block.select("id", "label", "vector").collect(), key=lambda r: (r["id"], repr(r["label"]), r["vector"]))
    rows = np.zeros((len(held), packing.size), packing.plain)
    for i, r in enumerate(held):
        rows[i, :len(r["vector"])] = r["vector"]
    ids, labels = [r["id"] for r in held], [r["label"] for r in held]
    sent = spark.sparkContext.broadcast(Block(ids, labels, rows, packing))
    best = _top(table.mapInArrow(_positives(sent, positives), f"anchor long, id long, score {kind}"), "anchor", positives)
    found = sorted(best.collect(), key=lambda r: (r["anchor"], r["rank"]))  # at most positives a row of the block
    sent.unpersist()
    bands = _bands(found, low, high, packing)
    sent = spark.sparkContext.broadcast(Block(ids, labels, rows, packing, bands))
    best = _top(table.mapInArrow(_negatives(sent, negatives), f"band long, id long, score {kind}"), "band", negatives)
    names = spark.createDataFrame(
        [(n, ids[r["anchor"]], r["id"], r["score"]) for n, r in enumerate(found)], f"band long, anchor_id long, positive_id long, positive_score {kind}")
    best.join(F.broadcast(names), "band").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("positive_score").try_cast("long").alias("positive_score"), F.col("score").try_cast("long").alias("negative_score")).write.parquet(path)
    sent.unpersist()
