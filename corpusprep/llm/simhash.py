"""SimHash near-dedup by anchor-point covering.

A 64-bit fingerprint is cut into blocks, each with a perfect code: every word of the block's bits is
within the code's covering radius of exactly one code word. Anchors are tuples of code words, one a block.
A fingerprint's home anchor are its nearest code words. If two fingerprints differ by at most t bits, e1 of
them in the first block, e2 in the second and so on, then each block of one is within radius + e of
the other's home word. So a fingerprint is replicated to all anchors within radius + e of its blocks for
e1 + e2 + ... <= t, and homes meet replicas per anchor. No pair within t bits is missed; the exact bit
distance of each candidate decides.

``blocks`` = 2: two blocks of 23 bits with the binary Golay code [23, 12] (radius 3), 18 bits free: about 60
replicas on 2^24 anchors for t = 2. ``blocks`` = 3: one more block of 15 bits with the Hamming code [15, 11]
(radius 1), 3 bits free: 153 replicas on 2^35 anchors. The candidates of a fingerprint are replicas * distinct
fingerprints / anchors: two blocks cost least up to some 10^8 distinct fingerprints, three up to 10^11.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import col, for_workers, no_broadcast, private, row_hash, saved
from corpusprep.llm.components import connected_components

SEED = 42

@dataclass(frozen=True)
class Code:
    """A perfect cyclic code: length, generator polynomial and covering radius."""

    bits: int
    poly: int
    radius: int

    @property
    def checks(self) -> int:
        return self.poly.bit_length() - 1


GOLAY = Code(23, 0b110001110101, 3)  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
HAMMING = Code(15, 0b10011, 1)  # x^4 + x + 1
CODES = {2: (GOLAY, GOLAY), 3: (GOLAY, GOLAY, HAMMING)}
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_PIECE = 1 << 20


def _syndrome(words: np.ndarray, code: Code) -> np.ndarray:
    """Remainder of the words, as polynomials, by the code's generator: 0 for code words."""
    out = words.copy()
    for bit in range(code.bits - 1, code.checks - 1, -1):
        out = np.where((out >> bit) & 1, out ^ (code.poly << (bit - code.checks)), out)
    return out


@functools.cache
def _covering(code: Code, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For e = 0..max_bits: by syndrome, the error patterns which lead to code words at distance
    radius + e (at most the radius for e = 0), padded, and the mask of the real ones."""
    out, rows = [], 1 << code.checks
    for e in range(max_bits + 1):
        weights = range(code.radius + 1) if e == 0 else [code.radius + e]
        pats = np.array([sum(1 << b for b in bits) for w in weights for bits in combinations(range(code.bits), w)], dtype=np.int64)
        syn = _syndrome(pats, code)
        order = np.argsort(syn, kind="stable")
        syn, pats = syn[order], pats[order]
        counts = np.bincount(syn, minlength=rows)
        place = np.arange(len(syn)) - np.repeat(np.cumsum(counts) - counts, counts)
        table = np.zeros((rows, max(1, counts.max())), dtype=np.int64)
        table[syn, place] = pats
        out.append((table, np.arange(table.shape[1])[None, :] < counts[:, None]))
    return out


def _blocks(fp: np.ndarray, blocks: int) -> list[tuple[Code, int, np.ndarray]]:
    """(code, first bit, the block's bits) of every block."""
    out, at = [], 0
    for code in CODES[blocks]:
        out.append((code, at, (fp >> at) & (1 << code.bits) - 1))
        at += code.bits
    return out


def home_anchor(fp: np.ndarray, blocks: int = 2) -> np.ndarray:
    """The nearest code words of the blocks, as one number."""
    anchor = np.zeros(len(fp), dtype=np.int64)
    for code, at, word in _blocks(fp, blocks):
        anchor |= (word ^ _covering(code, 0)[0][0][_syndrome(word, code), 0]) << at
    return anchor


def covering_anchors(fp: np.ndarray, max_bits: int, blocks: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, index into fp) for every anchor which a fingerprint is replicated to."""
    # partial anchors, the rows they are of, and how many of the max_bits are used up
    anchors, rows, used = np.zeros(len(fp), dtype=np.int64), np.arange(len(fp)), np.zeros(len(fp), dtype=np.int64)
    for code, at, word in _blocks(fp, blocks):
        syndrome, parts = _syndrome(word, code), []
        for e, (table, real) in enumerate(_covering(code, max_bits)):
            may = np.flatnonzero(used + e <= max_bits)
            of = rows[may]
            mask = real[syndrome[of]]
            near = (word[of][:, None] ^ table[syndrome[of]]) << at
            parts.append(((anchors[may][:, None] | near)[mask], np.repeat(of, mask.sum(axis=1)), np.repeat(used[may] + e, mask.sum(axis=1))))
        anchors, rows, used = (np.concatenate(x) for x in zip(*parts, strict=True))
    return anchors, rows


def _word_pieces(data: bytes) -> Iterator[list[bytes]]:
    """Words of the lower-cased text, a bounded piece at a time."""
    pos = 0
    while pos < len(data):
        cut = _SPACE.search(data, pos + _PIECE) if pos + _PIECE < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[pos:end].lower().split()
        pos = end


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles; 0 for a text without words."""
    ones, total, tail = np.zeros(64, dtype=np.int64), 0, []

    def add(hashes: list[int]) -> None:
        nonlocal total
        h = np.array(hashes, dtype="<u8")
        ones[:] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        total += len(h)

    for words in _word_pieces((text or "").encode("utf-8", "surrogatepass")):
        words = tail + words
        if len(words) >= shingle:
            grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
            add(list(map(xxhash.xxh64_intdigest, grams, repeat(SEED))))
        tail = words[len(words) - shingle + 1:] if shingle > 1 and len(words) >= shingle else words if shingle > 1 else []
    if not total and tail:
        add([xxhash.xxh64_intdigest(b" ".join(tail), SEED)])
    bits = (2 * ones > total).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def _signed(values) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _fingerprint_batches(shingle: int):
    def run(batches):
        for b in batches:
            fps = _signed([fingerprint(t.as_py(), shingle) for t in b.column(2)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], names=["id", "row", "fp"])

    return run


def _anchor_batches(max_bits: int | None, blocks: int):
    """fp -> (anchor, fp): the home anchor (None) or all anchors of the covering."""

    def run(batches):
        for b in batches:
            every = b.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(every), 4096):
                fp = every[at:at + 4096]
                anchor, rows = (home_anchor(fp, blocks), slice(None)) if max_bits is None else covering_anchors(fp, max_bits, blocks)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[rows])], names=["anchor", "fp"])

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = 2, blocks: int = 2) -> DataFrame:
    """(u, v): all pairs u < v of the distinct fingerprints ``fps.fp`` within ``max_bits`` bits. ``blocks``: 2 or 3
    (the same pairs either way).

    A fingerprint has at most sum C(64, i), i <= max_bits, partners: links are bounded per row.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    if blocks not in CODES:
        raise ValueError("blocks must be 2 or 3")
    for_workers(fps.sparkSession)
    home = fps.select("fp").mapInArrow(_anchor_batches(None, blocks), "anchor long, u long").select("anchor", "u")
    near = fps.select("fp").mapInArrow(_anchor_batches(max_bits, blocks), "anchor long, v long").select("anchor", "v")
    close = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    return home.join(no_broadcast(near), "anchor").filter(close).select("u", "v").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_bits: int = 2, blocks: int = 2) -> DataFrame:
    """One row per document: id, row (hash of the whole row), fp (signed 64 bits), component.

    component is the smallest non-null id among all documents reachable over links of at most
    ``max_bits`` differing bits (null if all of them have a null id). A null or empty text has
    fingerprint 0 and links like any other; repeated rows stay repeated; an empty table gives no
    rows; other columns of docs are not touched.
    """
    for_workers(docs.sparkSession)
    slim = docs.select(col(id_col).cast("long").alias("id"), row_hash(docs).alias("row"), col(text_col).cast("string").alias("t"))
    fps = saved(slim.mapInArrow(_fingerprint_batches(shingle), "id long, row long, fp long"), "simhash-fp")
    classes = saved(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-class")
    comps = connected_components(fingerprint_links(classes, max_bits, blocks))
    linked = saved(classes.join(no_broadcast(comps.withColumnRenamed("node", "fp")), "fp"), "simhash-linked")
    low = linked.groupBy("root").agg(F.min("first").alias("low"))
    linked = saved(linked.join(no_broadcast(low), "root").select("fp", "low"), "simhash-low")
    named = saved(
        classes.join(no_broadcast(linked.withColumn("has", F.lit(True))), "fp", "left")
        .select("fp", F.when(F.col("has"), F.col("low")).otherwise(F.col("first")).alias("component")), "simhash-named",
    )
    return fps.join(no_broadcast(named), "fp").select("id", "row", "fp", "component")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               max_bits: int = 2, blocks: int = 2) -> DataFrame:
    """The rows of docs, one for each component: that with the smallest id (ties: smallest row hash).

    Columns and their order are those of docs. Rows equal in all columns count as one row.
    """
    marks = saved(simhash_components(docs, id_col, text_col, shingle, max_bits, blocks), "simhash-marks")
    best = marks.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("b"))
    # a component without any id has component null, and is told apart by its fingerprint only then
    best = marks.filter("component is null").groupBy("fp").agg(F.min(F.struct(F.lit(True).alias("no_id"), "id", "row")).alias("b")) \
        .select("b").unionAll(best.filter("component is not null").select("b"))
    rid, rrow = private(docs, "keep_id", "keep_row")
    keep = best.select(F.col("b.id").alias(rid), F.col("b.row").alias(rrow))
    out = docs.withColumn(rrow, row_hash(docs)).join(
        no_broadcast(keep.withColumnRenamed(rrow, rrow + "2")),
        (F.col(rrow) == F.col(rrow + "2")) & col(id_col).cast("long").eqNullSafe(F.col(rid)), "left_semi")
    # rows equal in all columns share their mark; without any, the texts need no second exchange
    if not marks.groupBy("id", "row").count().filter("count > 1").isEmpty():
        out = out.dropDuplicates([id_col, rrow])
    return out.select(*[col(c) for c in docs.columns])
