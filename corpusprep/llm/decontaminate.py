"""Benchmark decontamination by generalised suffix automata over words.

The items' texts become words (A-Z lower-cased; letters, digits and all non-ASCII characters). Blocks
of items of at most ``block_words`` words each become one generalised suffix automaton, built in a
task: its states are the classes of word sequences with the same ends in the items. A document's
words are streamed through it: after every word the state and the length of the longest match that
ends there are known. A match of ``window`` words or more holds a window of some item; an item with
fewer words counts when it occurs as a whole. Matched spans that are too long, or documents of which
too much is matched, are removed.

A block bounds what a task holds and what is broadcast (about 200 bytes a word in a worker). A longer
item is cut into pieces that overlap by window - 1 words, so that no window is lost. With several
blocks, documents pass through one block after the other.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import col, for_workers, forget, private, refuse, saved

WINDOW = 10
BLOCK_WORDS = 200_000
# A-Z to a-z; all other ASCII but letters and digits separates words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x20]+")
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Builder:
    """Generalised suffix automaton: every text is added from the root, shared parts are reused."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, moves: dict[int, int], link: int, length: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of the sequences of q that end a suffix of p followed by c."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, ids: list[int]) -> None:
        last = 0
        for c in ids:
            q = self.next[last].get(c)
            if q is not None:
                last = self._split(last, c, q)
                continue
            new, p = self._state({}, 0, self.length[last] + 1), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, c, self.next[p][c])
            last = new


@dataclass
class Automaton:
    """One block, ready to stream words through.

    go: state * len(vocab) + word -> state; level: for a state with sequences of ``window`` words or more,
    the state of the last ``window`` of them; short: whole short items that end there, as (length, key);
    items: the item ids of a level state or short key; least: the fewest words that count.
    """

    window: int
    vocab: dict[bytes, int]
    go: dict[int, int]
    link: list[int]
    length: list[int]
    level: list[int]
    short: dict[int, list[tuple[int, int]]]
    items: dict[int, list[str]]
    least: int

    def matches(self, ids: np.ndarray):
        """(place, length, state) after every word at which the longest match has ``least`` words."""
        go, link, length, least, size = self.go.get, self.link, self.length, self.least, len(self.vocab)
        known = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).astype(np.int8)))
        for a, b in known.reshape(-1, 2).tolist():  # words of no item reset the automaton
            if b - a < least:
                continue
            state = n = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                to = go(state * size + c)
                while to is None:
                    state = link[state]
                    n = length[state]
                    to = go(state * size + c)
                state = to
                n += 1
                if n >= least:
                    yield i, n, state

    def scan(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Merged spans of words (end exclusive) inside windows, the items' ids, the longest match."""
        ids = np.fromiter(map(self.vocab.get, tokens, repeat(-1)), np.int64, len(tokens))
        spans: list[tuple[int, int]] = []
        keys: set[int] = set()
        longest = 0
        for i, n, state in self.matches(ids):
            size = 0
            if n >= self.window:
                size = n
                keys.add(self.level[state])
            for k, key in self.short.get(state, ()):
                if k <= n:
                    size = max(size, k)
                    keys.add(key)
            if size:
                longest = max(longest, size)
                _push(spans, i + 1 - size, i + 1)
        return spans, {x for k in keys for x in self.items[k]}, longest


def _push(spans: list[tuple[int, int]], start: int, end: int) -> None:
    """Append a span that ends last of all; spans that touch it become one."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append((start, end))


def compile_block(texts: list[tuple[str, list[bytes], bool]], window: int) -> Automaton:
    """texts: (item id, words, whole item). Pieces of long items are not whole."""
    vocab: dict[bytes, int] = {}
    coded = [(item, [vocab.setdefault(w, len(vocab)) for w in ws], whole) for item, ws, whole in texts]
    made = Builder()
    for ids in sorted({tuple(ids) for _, ids, _ in coded}):
        made.add(ids)
    link, length, size = made.link, made.length, max(1, len(vocab))
    level = [0] * len(link)
    by_length = np.argsort(length, kind="stable").tolist()
    for s in by_length:
        if length[s] >= window:
            level[s] = s if length[link[s]] < window else level[link[s]]
    items: dict[int, set[str]] = {}
    ends: dict[int, dict[int, int]] = {}  # state -> length -> key of a short item
    for item, ids, whole in coded:
        state = 0
        for j, c in enumerate(ids):
            state = made.next[state][c]
            if j + 1 >= window:
                items.setdefault(level[state], set()).add(item)
        if whole and len(ids) < window:
            key = ends.setdefault(state, {}).setdefault(len(ids), -1 - len(items))
            items.setdefault(key, set()).add(item)
    short: dict[int, list[tuple[int, int]]] = {}
    if ends:
        for s in by_length[1:]:
            found = sorted(ends.get(s, {}).items()) + short.get(link[s], [])
            if found:
                short[s] = found
    least = min([window, *(k for e in ends.values() for k in e)])
    go = {s * size + c: t for s, moves in enumerate(made.next) for c, t in moves.items()}
    # a word of the vocabulary starts a match: the root always has a move
    return Automaton(window, vocab, go, link, length, level, short, {k: sorted(v) for k, v in items.items()}, least)


def _build_group(window: int, block_words: int):
    """Fill blocks of at most block_words words; one pickled automaton a block."""
    def run(group: pa.Table) -> pa.Table:
        made, texts, n = [], [], 0
        step = block_words - window + 1
        for item, text in zip(group.column("item").to_pylist(), group.column("text").to_pylist(), strict=True):
            ws = words(text)
            pieces = [ws[i:i + block_words] for i in range(0, max(1, len(ws) - window + 1), step)] if ws else []
            for piece in pieces:
                if n + len(piece) > block_words:
                    made.append(_packed(texts, window))
                    texts, n = [], 0
                texts.append((item, piece, len(pieces) == 1))
                n += len(piece)
        if texts:
            made.append(_packed(texts, window))
        return pa.table({"automaton": pa.array(made, pa.binary())})

    return run


def _packed(texts, window: int) -> bytes:
    return pickle.dumps(compile_block(texts, window), protocol=5)


def compile_items(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """A saved table (automaton binary), one row a block. Rows of one item_id are one item; a null id is
    the item '', a null text has no words. No words at all give no rows."""
    if window < 1 or block_words < 2 * window:
        raise ValueError("window must be positive, block_words at least twice as large")
    for_workers(items.sparkSession)
    texts = items.select(F.coalesce(col(item_col).cast("string"), F.lit("")).alias("item"), col(text_col).cast("string").alias("text"))
    # the number of blocks goes by the items alone, not by how Spark deals them out
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // (4 * block_words)))
    texts = texts.distinct().withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    return saved(texts.groupBy("block").applyInArrow(_build_group(window, block_words), "automaton binary"), "automata")


_LOADED: dict[str, Automaton] = {}


def _automaton(block) -> Automaton:
    """The broadcast block; a worker unpickles it once and holds one at a time."""
    name, data = block.value
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = pickle.loads(data)
    return _LOADED[name]


def _scan_batches(block, text_at: int, found_at: int | None, drop_text: bool, step: int = 256):
    """Append n_words, spans, items and longest, or merge them into the last four columns."""
    def run(batches):
        known = _automaton(block) if block is not None else None
        for b in batches:
            n_words, spans, items, longest = [], [], [], []
            for at in range(0, b.num_rows, step):
                for text in b.column(text_at).slice(at, step).to_pylist():
                    ws = words(text)
                    s, x, n = known.scan(ws) if known else ([], set(), 0)
                    n_words.append(len(ws))
                    spans.append(s)
                    items.append(x)
                    longest.append(n)
            columns = list(b.columns)
            if found_at is not None:
                old = [b.column(found_at + i).to_pylist() for i in (1, 2, 3)]
                spans = [merged(s, [(p["start"], p["end"]) for p in o]) for s, o in zip(spans, old[0], strict=True)]
                items = [x.union(o) for x, o in zip(items, old[1], strict=True)]
                longest = [max(n, o) for n, o in zip(longest, old[2], strict=True)]
                columns = columns[:found_at]
            if drop_text:
                del columns[text_at]
            columns += [pa.array(n_words, pa.int64()), pa.array([[{"start": a, "end": e} for a, e in s] for s in spans], _SPAN),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(longest, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(a + b):
        if out and out[-1][1] >= s:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


NAMES = ("n_words", "spans", "items", "longest")


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", names: tuple[str, str, str, str] = NAMES, drop_text: bool = False) -> DataFrame:
    """docs plus: the number of words, the merged spans of words (from 0, end exclusive) inside windows of
    items, the ids of those items (sorted), and the length of the longest match that counts (in words;
    matches of items longer than a block may be cut to block_words).

    A null or wordless text has 0 words and no spans; without items nothing is found. Rows repeat as they
    do in docs. A column of docs named like one of ``names`` (in any case) is an error.
    """
    refuse(docs.drop(text_col) if drop_text else docs, *names)
    spark = docs.sparkSession
    blocks = compile_items(items, window, block_words, item_col, item_text_col)
    numbered = [r[0] for r in blocks.select(F.sha2("automaton", 256)).distinct().collect()]  # one short name a block
    text_at, width = docs.columns.index(text_col), len(docs.columns)
    own = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]
    found = [T.StructField(n, t) for n, t in zip(names, (T.LongType(), SPAN, T.ArrayType(T.StringType()), T.LongType()), strict=True)]
    out, old = docs, None
    for i, name in enumerate(sorted(numbered) or [None]):
        data = blocks.filter(F.sha2("automaton", 256) == name).first()[0] if name else None
        sent = spark.sparkContext.broadcast((name, bytes(data))) if name else None
        last = i + 1 >= len(numbered)
        fields = [f for f in own if not (drop_text and last and f.name == text_col)] + found
        out = out.mapInArrow(_scan_batches(sent, text_at, width if i else None, drop_text and last), T.StructType(fields))
        if not last:
            out = saved(out, "decontaminate")
            if old is not None:
                forget(old)
            old = out
            sent.unpersist()
    forget(blocks)
    return out


def _cut_batches(text_at: int, spans_at: int, max_words: int):
    def run(batches):
        for b in batches:
            texts = []
            for text, spans in zip(b.column(text_at).to_pylist(), b.column(spans_at).to_pylist(), strict=True):
                long = [(s["start"], s["end"]) for s in spans if s["end"] - s["start"] > max_words]
                texts.append(without(text, long) if long else text)
            columns = list(b.columns)
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the characters from the first to the last word of every span."""
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    out, at = [], 0
    for s, e in spans:
        out.append(data[at:places[s][0]])
        at = places[e - 1][1]
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, items: DataFrame, max_words: int = 9, max_coverage: float = 0.5, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs without the documents of which more than ``max_coverage`` of the words is matched, and without the
    matched spans of more than ``max_words`` words in the others. Columns stay as they are; null texts stay null."""
    marks = private(docs, *NAMES)
    marked = scan(docs, items, window, block_words, text_col, item_col, item_text_col, tuple(marks))
    hit = F.aggregate(col(marks[1]), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    kept = marked.filter(hit <= max_coverage * col(marks[0]))
    cut = kept.mapInArrow(_cut_batches(docs.columns.index(text_col), len(docs.columns) + 1, max_words), kept.schema)
    return cut.select(*[col(c) for c in docs.columns])
