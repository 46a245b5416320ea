"""Byte-level BPE: pre-tokenisation by vectorised scans, then cached pair merging.

Code points become symbols (class of the character, what follows it, contraction starts). Each symbol
is a function on the states of a small automaton; functions compose associatively, so the state before
every character follows from a blocked prefix scan: all blocks are composed side by side, the few block
results are chained, and a second sweep reads off where pieces start. Pieces are merged by rank, each
distinct piece once a cache; token ids keep the byte offsets needed to map them back to the text.
"""

from __future__ import annotations

import base64
import functools
import heapq
import struct
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusprep.llm.common import for_workers, refuse, send_file

# Unicode's White_Space property, and the contractions of the pattern.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

SPACE, WHITE, LETTER, NUMBER, OTHER = range(5)
# States: what the piece before the next character is.
NEW, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_WHITE, OPEN_SPACE, REST_1, REST_2 = range(8)
_STATES, _BLOCK, _CHUNK = 8, 256, 1 << 20
_RESET = 15  # written between two texts: leads to NEW from every state (contraction 1 does not occur)
_CACHE_LIMIT = 400_000  # about 200 bytes each


@functools.cache
def char_classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for cp in range(sys.maxunicode + 1):
        c = unicodedata.category(chr(cp))[0]
        if c == "L":
            table[cp] = LETTER
        elif c == "N":
            table[cp] = NUMBER
    table[WHITE_SPACE] = WHITE
    table[32] = SPACE
    return table


@functools.cache
def transitions() -> tuple[np.ndarray, np.ndarray]:
    """For symbol = class + 5 * follow + 15 * contraction: next state of each state, and whether a
    piece starts at the character. follow: 0 end of text, 1 white space, 2 other; contraction: 0 or
    the length of a contraction that could start here (2 or 3)."""
    step = np.zeros((60, _STATES), dtype=np.uint8)
    starts = np.zeros((60, _STATES), dtype=bool)
    inside = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}
    for sym in range(60):
        cls, follow, contraction = sym % 5, sym // 5 % 3, sym // 15
        for state in range(_STATES):
            if state in (REST_1, REST_2):
                new, start = NEW if state == REST_1 else REST_1, False
            elif cls in (SPACE, WHITE):
                # the last white character before other text stands alone, or opens the next piece
                last = follow == 2
                new = (OPEN_SPACE if cls == SPACE else NEW) if last else IN_WHITE
                start = last or state != IN_WHITE
            elif state == OPEN_SPACE:
                new, start = inside[cls], False
            elif contraction and state != IN_OTHER:
                new, start = (REST_1 if contraction == 2 else REST_2), True
            else:
                new, start = inside[cls], state != inside[cls]
            step[sym, state], starts[sym, state] = new, start
    step[_RESET] = NEW
    return step, starts


def symbols(cps: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """Symbols of the characters ``cps``; ``ahead``: up to two characters after them."""
    n = len(cps)
    full = np.concatenate([cps, ahead[:2]])
    cls = char_classes()[full]
    follow = np.zeros(n, dtype=np.uint8)
    nxt = cls[1:n + 1]
    follow[:len(nxt)] = np.where(nxt <= WHITE, 1, 2)
    sym = cls[:n] + 5 * follow
    at = np.nonzero(cps == 0x27)[0]
    if len(at):
        padded = np.concatenate([full, np.zeros(2, dtype=full.dtype)])
        a, b = padded[at + 1], padded[at + 2]
        for word in CONTRACTIONS:
            hit = a == ord(word[0]) if len(word) == 1 else (a == ord(word[0])) & (b == ord(word[1]))
            sym[at[hit]] = sym[at[hit]] % 15 + 15 * (1 + len(word))
    return sym


def scan(sym: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Start flags of all characters and the state after them, by a blocked scan of functions."""
    step, starts = transitions()
    n = len(sym)
    if n == 0:
        return np.zeros(0, dtype=bool), state
    blocks = -(-n // _BLOCK)
    padded = np.full(blocks * _BLOCK, 0, dtype=np.uint8)
    padded[:n] = sym
    grid = np.ascontiguousarray(padded.reshape(blocks, _BLOCK).T)
    # Compose each block's functions from its last character backwards. As soon as such a tail is
    # constant, so is the block's whole function: few characters of a block are needed.
    func = np.tile(np.arange(_STATES, dtype=np.uint8), (blocks, 1))
    todo = np.arange(blocks)
    for row in grid[::-1]:
        part = np.take_along_axis(func[todo], step[row[todo]], axis=1)
        func[todo] = part
        todo = todo[(part != part[:, :1]).any(axis=1)]
        if not len(todo):
            break
    flat = step.ravel()
    into = np.empty(blocks, dtype=np.uint8)
    for i, f in enumerate(func.tolist()):  # chain the blocks' results
        into[i] = state
        state = f[state]
    flags = np.empty((_BLOCK, blocks), dtype=bool)
    started, now = starts.ravel(), into
    tail = n - (blocks - 1) * _BLOCK
    for j, row in enumerate(grid):
        if j == tail:
            state = int(now[-1])
        index = row.astype(np.int32) * _STATES + now
        flags[j] = started[index]
        now = flat[index]
    if tail == _BLOCK:
        state = int(now[-1])
    return flags.T.ravel()[:n], state


def piece_starts(text: str) -> np.ndarray:
    """Offsets (code points) where the pieces of the text start."""
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out, state = [], NEW
    for at in range(0, len(cps), _CHUNK):
        flags, state = scan(symbols(cps[at:at + _CHUNK], cps[at + _CHUNK:at + _CHUNK + 2]), state)
        out.append(np.nonzero(flags)[0] + at)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def many_starts(texts: list[str]) -> list[list[int]]:
    """piece_starts of many texts, scanned together: every text starts in state NEW again."""
    out, group, size = [], [], 0
    for t in [*texts, None]:
        if group and (t is None or size + len(t) > _CHUNK):
            out += _starts_together(group)
            group, size = [], 0
        if t is not None:
            group.append(t)
            size += len(t) + 1
    return out


def _starts_together(texts: list[str]) -> list[list[int]]:
    if len(texts) == 1:
        return [piece_starts(texts[0]).tolist()]
    # a zero stands between two texts and becomes the reset symbol
    lens = np.array([len(t) for t in texts])
    cps = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum(lens + 1) - 1
    sym = symbols(cps, cps[:0])
    cuts = ends[:-1]
    last = ends - 1
    ok = lens > 0
    sym[last[ok]] = char_classes()[cps[last[ok]]]  # nothing follows the last character
    for back in (1, 2):  # nor does a contraction reach over the end
        near = ends - back
        hit = near[(lens >= back)]
        wide = sym[hit] // 15 >= back + 1 if back == 1 else sym[hit] // 15 > back
        sym[hit[wide]] %= 15
    sym[cuts] = _RESET
    flags, _ = scan(sym, NEW)
    flags[cuts] = False
    at = np.nonzero(flags)[0]
    begin = ends - lens
    bounds = np.searchsorted(at, np.concatenate([begin, [len(cps) + 1]]))
    return [(at[bounds[i]:bounds[i + 1]] - begin[i]).tolist() for i in range(len(texts))]


class _Pieces(dict):
    """Piece -> its ids, packed; pieces that are not known are merged and kept, up to a limit."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge

    def __missing__(self, piece: str) -> bytes:
        got = self.merge(piece.encode("utf-8", "replace"))
        got = struct.pack(f"<{len(got)}I", *got)
        if len(piece) <= 64:
            if len(self) >= _CACHE_LIMIT:
                self.clear()
            self[piece] = got
        return got


class Vocabulary:
    """Ranks of a byte-level BPE file, with a bounded cache of merged pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        by_id = sorted(self.ranks.items(), key=lambda x: x[1])
        if [i for _, i in by_id] != list(range(len(by_id))):
            raise ValueError("ranks must be 0, 1, 2, ...")
        self.blob = np.frombuffer(b"".join(t for t, _ in by_id), dtype=np.uint8)
        self.sizes = np.array([len(t) for t, _ in by_id], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.cache = _Pieces(self.merge)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: adjacent parts of the lowest rank are merged first, leftmost on ties."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        return self._merge_short(piece) if len(piece) <= 48 else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        ranks, none = self.ranks, len(self.ranks)
        get = ranks.get
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            del pairs[i]
            parts[i] += parts.pop(i + 1)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap: n log n, for runs of signs or letters without an end."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # parts by start: end, part before
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (b := before[i]) >= 0 and (r := ranks.get(piece[b:stop])) is not None:
                heapq.heappush(heap, (r, b, stop))
        return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]

    def _packed(self, text: str, starts: list[int]) -> bytes:
        if not text:
            return b""
        cache = self.cache
        return b"".join([cache[text[a:b]] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)])

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [self._packed(t, s) for t, s in zip(texts, many_starts(texts), strict=True)]

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(x, dtype="<u4").tolist() for x in self.encode_packed(texts)]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self._packed(text, piece_starts(text).tolist()), dtype="<u4").tolist()

    def offsets(self, ids) -> np.ndarray:
        """Byte offset at which each token ends: token i covers bytes offsets[i - 1] to offsets[i]."""
        return np.cumsum(self.sizes[np.asarray(ids, dtype=np.int64)])

    def decode(self, ids) -> bytes:
        """The bytes of the tokens, gathered from the vocabulary by the tokens' offsets."""
        ids = np.asarray(ids, dtype=np.int64)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        return self.blob[np.arange(ends[-1]) + np.repeat(self.begins[ids] - (ends - sizes), sizes)].tobytes()


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary a Python worker; its cache serves all tasks that the worker runs."""
    return Vocabulary(path)


def _encode_batches(name: str, text_at: int, offsets: bool, decoded: bool, step: int = 512):
    def run(batches):
        vocab = vocabulary(SparkFiles.get(name))
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                ids = vocab.encode_packed([t or "" for t in part.column(text_at).to_pylist()])
                extra = [pa.array(ids, pa.binary())]
                if offsets:
                    extra.append(pa.array([vocab.offsets(np.frombuffer(x, dtype="<u4")) for x in ids], pa.list_(pa.int64())))
                if decoded:
                    extra.append(pa.array([vocab.decode(np.frombuffer(x, dtype="<u4")) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=[f"c{i}" for i in range(part.num_columns + len(extra))])

    return run


def _decode_batches(name: str, ids_at: int, step: int = 512):
    def run(batches):
        vocab = vocabulary(SparkFiles.get(name))
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                texts = [None if x is None else vocab.decode(np.frombuffer(x, dtype="<u4")) for x in part.column(ids_at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[f"c{i}" for i in range(part.num_columns + 1)])

    return run


def _with(df: DataFrame, *fields: T.StructField) -> T.StructType:
    return T.StructType([*(T.StructField(f.name, f.dataType, True) for f in df.schema.fields), *fields])


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", offsets_col: str | None = None,
           decoded_col: str | None = None) -> DataFrame:
    """docs plus the token ids as little-endian unsigned 32-bit integers (binary).

    A null or empty text has no ids. ``offsets_col``: also the byte offset where each token ends.
    ``decoded_col``: also the bytes that the ids decode to, in the same pass over the rows. A column of docs
    named like one of these is an error. The rank file is sent to the workers with the application.
    """
    refuse(docs, ids_col, offsets_col, decoded_col)
    for_workers(docs.sparkSession)
    fields = [T.StructField(ids_col, T.BinaryType())]
    if offsets_col:
        fields.append(T.StructField(offsets_col, T.ArrayType(T.LongType())))
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.BinaryType()))
    return docs.mapInArrow(_encode_batches(send_file(docs.sparkSession, path), docs.columns.index(text_col), bool(offsets_col), bool(decoded_col)), _with(docs, *fields))


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """tokens plus the bytes that the ids stand for; null ids give null. A column named like bytes_col is an error."""
    refuse(tokens, bytes_col)
    for_workers(tokens.sparkSession)
    return tokens.mapInArrow(_decode_batches(send_file(tokens.sparkSession, path), tokens.columns.index(ids_col)), _with(tokens, T.StructField(bytes_col, T.BinaryType())))
