"""Periodic runs of words: recursive frequency splitting, then a lag scan.

A run is a stretch of consecutive words whose smallest period q repeats at least ``min_exponent`` times
and has at least ``min_length`` words, and which no neighbouring word extends. Every word of a run occurs at
least min_exponent times in it. So a word that occurs less often within its segment (at first: the
document) belongs to no run: it splits the segment, which makes other words rarer, and so on until
nothing changes. What is left is scanned for lags: m-grams of words get ranks by doubling m, and a
stretch of positions whose m-gram last occurred exactly q words before (m / 2 < q <= m) is the inside
of a run with period q. A primitive period cannot recur at a smaller distance, so the nearest earlier
place decides, and each run appears whole at one level only.

Splitting looks at a word again only when its count has changed: of the pieces of a segment, only the
smaller ones are counted anew, n log n in all. No step is quadratic in a text's length.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import for_workers, refuse

MIN_LENGTH, MIN_EXPONENT = 6, 4
CHUNK_WORDS = 1 << 15  # texts are worked on together up to so many words (fits caches); a longer text goes alone


def words(text: str | None) -> list[bytes]:
    """Maximal pieces without ASCII white space (bytes.split knows no other)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def segments(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal segments of at least ``shortest`` words in which every word occurs at
    least ``least`` times. starts, ends: the documents' places in ids, ascending."""
    n = len(ids)
    span = n + 1
    places = np.sort(ids * span + np.arange(n))  # by word, then place: a word's places in a range are neighbours
    a, b = starts, ends
    word, seg = ids[_ranges(a, b - a)], np.repeat(np.arange(len(a)), b - a)  # what to count: words of segments
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(a):
        low = np.searchsorted(places, word * span + a[seg])
        times = np.searchsorted(places, word * span + b[seg]) - low
        rare = (times > 0) & (times < least)
        cut = np.unique(places[_ranges(low[rare], times[rare])] % span)
        owner = np.searchsorted(a, cut, side="right") - 1
        cuts = np.bincount(owner, minlength=len(a))
        whole = (cuts == 0) & (b - a >= shortest)
        done.append((a[whole], b[whole]))
        split = cuts > 0
        # pieces between the cuts, with the segment that they come from
        pa_, pb = np.sort(np.concatenate([a[split], cut + 1])), np.sort(np.concatenate([cut, b[split]]))
        size = pb - pa_
        parent = np.repeat(np.flatnonzero(split), cuts[split] + 1)
        order = np.lexsort((-size, parent))
        first = np.concatenate([[True], parent[order][1:] != parent[order][:-1]]) if len(order) else np.zeros(0, bool)
        largest = np.zeros(len(size), bool)
        largest[order[first]] = True
        alive = size >= shortest
        number = np.cumsum(alive) - 1
        heir = np.full(len(a), -1)  # the largest piece of a split segment, if it goes on
        keep = largest & alive
        heir[parent[keep]] = number[keep]
        # all words of the smaller pieces; in the largest piece only the words that went elsewhere
        small = ~largest
        at = _ranges(pa_[small], size[small])
        own = np.repeat(np.where(alive, number, -1)[small], size[small])
        gone = np.concatenate([at, cut])
        to = np.concatenate([heir[np.repeat(parent[small], size[small])], heir[owner]])
        word, seg = np.concatenate([ids[at], ids[gone]]), np.concatenate([own, to])
        word, seg = word[seg >= 0], seg[seg >= 0]
        a, b = pa_[alive], pb[alive]
    if not done:
        return starts[:0], ends[:0]
    a, b = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(a)
    return a[order], b[order]


def lag_scan(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int, min_exponent: int) -> list[np.ndarray]:
    """(start, length, period) arrays of all runs within the segments, by start, then period."""
    sizes = ends - starts
    at = _ranges(starts, sizes)
    low, high = np.full(len(ids), -1), np.full(len(ids), -1)
    low[at], high[at] = np.repeat(starts, sizes), np.repeat(ends, sizes)
    rank = np.full(len(ids), -1)
    rank[at] = ids[at]
    found, m = [], 1
    while len(at):
        order = at[np.argsort(rank[at], kind="stable")]
        before, here = order[:-1], order[1:]
        same = (rank[before] == rank[here]) & (before >= low[here])
        lag = here - before
        near = same & (lag > m // 2) & (lag <= m)
        c, d = here[near], lag[near]
        by_place = np.argsort(c)
        c, d = c[by_place], d[by_place]
        if len(c):
            new = np.concatenate([[True], (c[1:] != c[:-1] + 1) | (d[1:] != d[:-1])])
            i = np.flatnonzero(new)
            period = d[i]
            start, stop = c[i] - period, c[np.append(i[1:], len(c)) - 1] + m
            good = stop - start >= np.maximum(min_length, min_exponent * period)
            found.append((start[good], (stop - start)[good], period[good]))
        # on to m-grams of twice the length: only those seen twice in a segment that is long enough
        twice = np.zeros(len(ids), bool)
        twice[before[same]] = twice[here[same]] = True
        rank[at[~twice[at]]] = -1
        at = np.sort(at[twice[at]])
        at = at[(at + 2 * m <= high[at]) & (high[at] - low[at] >= min_exponent * (m + 1))]
        at = at[rank[at + m] >= 0]
        pair = rank[at] * (rank.max(initial=0) + 1) + rank[at + m]
        rank[:] = -1
        rank[at] = np.unique(pair, return_inverse=True)[1]
        m *= 2
    if not found:
        return [np.zeros(0, np.int64)] * 3
    runs = [np.concatenate(x) for x in zip(*found)]
    order = np.lexsort((runs[2], runs[0]))
    return [x[order] for x in runs]


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
    """Per text: its runs as (start, length, period), by start, then period, and which words stay (those that no run
    holds after its first period; None: all)."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    a, b = segments(ids, ends - sizes, ends, min_exponent, max(min_length, min_exponent))
    start, length, period = lag_scan(ids, a, b, min_length, min_exponent)
    covered = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covered, start + period, 1)
    np.add.at(covered, start + length, -1)
    stays = np.cumsum(covered)[:-1] == 0
    cuts = np.searchsorted(start, np.append(ends - sizes, len(ids) + 1))
    for i, (s, e) in enumerate(zip(ends - sizes, ends, strict=True)):
        lo, hi = cuts[i], cuts[i + 1]
        if lo == hi:
            yield [], None
        else:
            yield list(zip((start[lo:hi] - s).tolist(), length[lo:hi].tolist(), period[lo:hi].tolist(), strict=True)), stays[s:e]


def strongest(found: Column) -> Column:
    """The run with the greatest exact length / period of a sorted array of runs (the first of equal ones), else null."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(found, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def _chunks(texts: list[list[bytes]]):
    part, n = [], 0
    for t in texts:
        if part and n + len(t) > CHUNK_WORDS:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t)
    if part:
        yield part


def _run_batches(text_at: int, min_length: int, min_exponent: int, drop_text: bool, step: int = 512):
    def run(batches):
        for b in batches:
            found, kept = [], []
            for at in range(0, b.num_rows, step):
                for part in _chunks([words(t) for t in b.column(text_at).slice(at, step).to_pylist()]):
                    for ws, (runs, stays) in zip(part, runs_of(part, min_length, min_exponent), strict=True):
                        found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                        left = ws if stays is None else [w for w, k in zip(ws, stays.tolist(), strict=True) if k]
                        kept.append(b" ".join(left))
            columns = list(b.columns)
            if drop_text:
                del columns[text_at]
            columns += [pa.array(found, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, text_col: str = "text",
              names: tuple[str, str] = ("runs", "collapsed"), drop_text: bool = False) -> DataFrame:
    """docs plus the runs of every text (words numbered from 0; sorted by start, then period) and the text's
    words without the repetitions, joined by one space.

    A null, empty or blank text has no runs and collapses to ''. Rows repeat as they do in docs. min_exponent is
    at least 3. A column of docs named like one of ``names`` (in any case) is an error.
    """
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    fields = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields if not (drop_text and f.name == text_col)]
    refuse(docs.drop(text_col) if drop_text else docs, *names)
    for_workers(docs.sparkSession)
    schema = T.StructType([*fields, T.StructField(names[0], RUNS), T.StructField(names[1], T.StringType())])
    return docs.mapInArrow(_run_batches(docs.columns.index(text_col), min_length, min_exponent, drop_text), schema)
