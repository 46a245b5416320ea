"""Secret scans by one deterministic automaton over bytes.

All rules go into one non-deterministic automaton; the subset construction makes it deterministic and
partition refinement minimises it. Its transition arrays tell after every byte which rules have a match
that ends there: one pass over the text for all rules. Small automata of single rules, one for the
reversed rule, then find the start and the longest end of each match; matches of a rule do not overlap,
leftmost first.

Rules are regular expressions of literals, classes, groups, alternatives and greedy repeats over ASCII.
For a rule, a match that ends first must not start after one that ends later (true when, as here, a
rule's shortest matches hold no whole match of the same rule).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusprep.llm.common import for_workers, refuse


@dataclass(frozen=True)
class Rule:
    """``least``: smallest length of ``group`` (0: the whole match); shorter matches are dropped."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    ignore_case: bool = False


# The three base kinds come first. Sequences of 24 and more are found as such: a
# longest match of [0-9a-f]+ is one of [0-9a-f]{24,} exactly if it is long enough.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("private_key", r"-----BEGIN (RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----", 20),
)
BASE = ("assign", "access", "hex")


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, ops, start: int, fold: bool, back: bool) -> int:
        """Append a parsed expression after ``start``; returns its end state. back: reversed."""
        for op, arg in reversed(list(ops)) if back else ops:
            if op in (C.LITERAL, C.IN):
                chars = self.chars([(op, arg)] if op is C.LITERAL else arg, fold)
                end = self.state()
                self.moves[start].append((chars, end))
                start = end
            elif op is C.SUBPATTERN:
                start = self.add(arg[3], start, fold, back)
            elif op is C.BRANCH:
                end = self.state()
                for branch in arg[1]:
                    first = self.state()
                    self.free[start].append(first)
                    self.free[self.add(branch, first, fold, back)].append(end)
                start = end
            elif op is C.MAX_REPEAT:
                least, most, item = arg
                for _ in range(least):
                    start = self.add(item, start, fold, back)
                if most is C.MAXREPEAT:
                    first = self.state()
                    self.free[start].append(first)
                    self.free[self.add(item, first, fold, back)].append(first)
                    start = first
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.free[start].append(end)
                        start = self.add(item, start, fold, back)
                    self.free[start].append(end)
                    start = end
            else:
                raise ValueError(f"not allowed in a rule: {op}")
        return start

    @staticmethod
    def chars(items, fold: bool) -> frozenset[int]:
        out: set[int] = set()
        for op, arg in items:
            if op is C.LITERAL:
                out.add(arg)
            elif op is C.RANGE:
                out |= set(range(arg[0], arg[1] + 1))
            else:
                raise ValueError(f"not allowed in a class: {op}")
        if max(out) > 127:
            raise ValueError("rules are ASCII")
        if fold:
            out |= {ord(chr(c).swapcase()) for c in out if chr(c).isalpha()}
        return frozenset(out)

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def compile_rules(rules: tuple[Rule, ...], anywhere: bool, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Minimal automaton: next state by [state, byte] and the mask of rules matched in each state.
    State 0 is the start. anywhere: matches may start at any byte."""
    nfa = _Nfa()
    start, ends = nfa.state(), {}
    for i, rule in enumerate(rules):
        first = nfa.state()
        nfa.free[start].append(first)
        ends[nfa.add(_parser.parse(rule.pattern), first, rule.ignore_case, back)] = 1 << i
    begin = nfa.closure([start])
    number, sets, table = {begin: 0}, [begin], []
    for own in sets:  # grows while it is read
        to = [set(begin) if anywhere else set() for _ in range(256)]
        for s in own:
            for chars, t in nfa.moves[s]:
                for c in chars:
                    to[c] |= nfa.closure([t])
        row = []
        for states in map(frozenset, to):
            if states not in number:
                number[states] = len(sets)
                sets.append(states)
            row.append(number[states])
        table.append(row)
    step = np.array(table)
    accept = np.array([sum(m for e, m in ends.items() if e in s) for s in sets])
    # partition refinement: states are equal if they accept alike and lead to equal states
    block = np.unique(accept, return_inverse=True)[1].ravel()
    while True:
        new = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if new.max() == block.max():
            break
        block = new
    rank = np.full(block.max() + 1, -1)
    heads = []
    for s in range(len(sets)):  # numbers in order of discovery, the start first
        if rank[block[s]] < 0:
            rank[block[s]] = len(heads)
            heads.append(s)
    return rank[block[step[heads]]], accept[heads]


def _linked(step: np.ndarray, accept: np.ndarray) -> list[list]:
    """Rows that hold their successors themselves; entry 256 is the mask, 257 whether it is dead."""
    rows: list[list] = [[] for _ in step]
    for s, row in enumerate(rows):
        row += [rows[t] for t in step[s].tolist()]
        row += [int(accept[s]), bool(accept[s] == 0 and (step[s] == s).all())]
    return rows


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.all = _linked(*compile_rules(rules, anywhere=True))[0]
        self.ahead = [_linked(*compile_rules((r,), anywhere=False))[0] for r in rules]
        self.behind = [_linked(*compile_rules((r,), anywhere=False, back=True))[0] for r in rules]
        self.exact = [re.compile(r.pattern.encode(), re.I if r.ignore_case else 0) for r in rules]

    def ends(self, data: bytes) -> list[tuple[int, int, int]]:
        """(first end, last end, mask of rules) of every stretch of ends with one mask: the pass over all bytes."""
        row, out, mask, since = self.all, [], 0, 0
        for i, c in enumerate(data, 1):
            row = row[c]
            now = row[256]
            if now != mask:
                if mask:
                    out.append((since, i - 1, mask))
                mask, since = now, i
        if mask:
            out.append((since, len(data), mask))
        return out

    def _first(self, k: int, data: bytes, low: int, end: int) -> int:
        row, best = self.behind[k], -1
        for i in range(end - 1, low - 1, -1):
            row = row[data[i]]
            if row[256]:
                best = i
            elif row[257]:
                break
        return best

    def _last(self, k: int, data: bytes, start: int) -> int:
        row, best = self.ahead[k], -1
        for i in range(start, len(data)):
            row = row[data[i]]
            if row[256]:
                best = i + 1
            elif row[257]:
                break
        return best

    @staticmethod
    def _stops(hits: list[tuple[int, int, int]], k: int, low):
        """The ends of rule k one after the other, without those up to low(), the end of the last match."""
        for first, last, mask in hits:
            if mask >> k & 1:
                end = first
                while (end := max(end, low() + 1)) <= last:
                    yield end
                    end += 1

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, sorted: every rule's leftmost matches that do not overlap."""
        hits, out = self.ends(data), []
        for k, rule in enumerate(self.rules):
            low = 0
            for stop in self._stops(hits, k, lambda: low):
                start = self._first(k, data, low, stop)
                if start < 0:
                    continue
                low = self._last(k, data, start)
                size = low - start
                if rule.group:  # the group inside the match that was found
                    size = len(self.exact[k].fullmatch(data, start, low).group(rule.group))
                if size >= rule.least:
                    out.append((start, k, low))
        return sorted(out)

    def spans(self, text: str | None) -> list[dict]:
        data = (text or "").encode("utf-8", "surrogatepass")
        found = self.scan(data)
        if found and len(data) != len(text):  # bytes to code points
            cuts = sorted({x for s, _, e in found for x in (s, e)})
            place, at, n = {}, 0, 0
            for c in cuts:
                n += len(data[at:c].decode("utf-8", "surrogatepass"))
                at, place[c] = c, n
            found = [(place[s], k, place[e]) for s, k, e in found]
        return [{"kind": self.rules[k].kind, "start": s, "end": e} for s, k, e in found]


@functools.cache
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Compiled once in every Python worker."""
    return Scanner(rules)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan_batches(rules: tuple[Rule, ...], text_at: int):
    def run(batches):
        scan = scanner(rules)
        for b in batches:
            found = pa.array([scan.spans(t.as_py()) for t in b.column(text_at)], _ARROW)
            yield pa.RecordBatch.from_arrays([*b.columns, found], names=[f"c{i}" for i in range(b.num_columns + 1)])

    return run


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """docs plus the spans of all rules (code points, end exclusive), sorted by start, then rule.

    A null text is empty and has no spans; an empty table gives no rows. A column named like ``spans_col`` is an error.
    """
    refuse(docs, spans_col)
    for_workers(docs.sparkSession)
    schema = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in docs.schema.fields), T.StructField(spans_col, SPANS)])
    return docs.mapInArrow(_scan_batches(rules, docs.columns.index(text_col)), schema)
