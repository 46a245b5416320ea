"""Ordered, declarative rule chains.

A rule knows how to express itself as a Spark ``Column`` and as a DuckDB SQL expression (the
oracle). A chain is an ordered list of rules. Rules whose expression reads its input more than
once carry ``stage=True``: the chain binds the input to a column first, so Catalyst keeps one
``Project`` per stage instead of re-inlining (and re-evaluating) the whole upstream regex chain.
Rules with ``needs`` cannot match in a text without that literal: consecutive rules with the same one
are left out for such texts, which Spark tells by a plain search instead of a regex pass each.
Rules with ``near_digits`` read and change nothing outside the stretches that ``regex.DIGITS_J``
matches: several of them in a row are applied to those short stretches instead of the whole text.
Dead rules (whose input an earlier rule always removes) stay in the table with ``live=False`` so
a reviewer can check them one by one; they are not applied.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import groupby
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .regex import DIGITS_J, bound, q, sub_with_long


@dataclass(frozen=True)
class Rule:
    id: str
    note: str = ""
    live: bool = True
    stage: bool = False
    needs: str | None = None
    near_digits: bool = False

    def spark(self, c: Column) -> Column:  # pragma: no cover - abstract
        raise NotImplementedError

    def sql(self, e: str) -> str:  # pragma: no cover - abstract
        raise NotImplementedError


@dataclass(frozen=True)
class Replace(Rule):
    """Literal replacements applied one after the other (each a single left-to-right pass)."""

    pairs: tuple[tuple[str, str], ...] = ()

    def spark(self, c: Column) -> Column:
        for old, new in self.pairs:
            c = F.replace(c, F.lit(old), F.lit(new))
        return c

    def sql(self, e: str) -> str:
        for old, new in self.pairs:
            e = f"replace({e}, {q(old)}, {q(new)})"
        return e


@dataclass(frozen=True)
class Translate(Rule):
    """Simultaneous character map; source characters beyond ``dst`` are deleted."""

    src: str = ""
    dst: str = ""

    def spark(self, c: Column) -> Column:
        return F.translate(c, self.src, self.dst)

    def sql(self, e: str) -> str:
        return f"translate({e}, {q(self.src)}, {q(self.dst)})"


def char_class(chars: str) -> str:
    """A regex character class matching exactly ``chars`` (each escaped)."""
    return "[" + "".join("\\" + ch if ch in "\\^-[]&" else ch for ch in dict.fromkeys(chars)) + "]"


FEW_CHARS = 3  # so many literal replacements cost less than a regex pass


@dataclass(frozen=True)
class MapChars(Rule):
    """Simultaneous character map written as one pass per target value.

    Spark's ``translate`` allocates per character; a regex character class is a cheap scan. Only
    valid when no target character is itself a source character (so passes cannot interact):
    ``groups`` is ``((chars, replacement), ...)``.
    """

    groups: tuple[tuple[str, str], ...] = ()

    def spark(self, c: Column) -> Column:
        for chars, rep in self.groups:
            if len(chars) <= FEW_CHARS:
                c = Replace(self.id, pairs=tuple((ch, rep) for ch in chars)).spark(c)
            else:
                c = F.regexp_replace(c, char_class(chars), rep)
        return c

    def sql(self, e: str) -> str:
        for chars, rep in self.groups:
            e = f"regexp_replace({e}, {q(char_class(chars))}, {q(rep)}, 'g')"
        return e


@dataclass(frozen=True)
class Regex(Rule):
    """``regexp_replace``. ``java``/``jrep`` for Spark; ``re2``/``rrep`` for DuckDB (defaults to
    the Java ones); ``passes`` repeats the RE2 form where neighbouring matches share a captured
    boundary character. ``plain`` pairs are literal replacements with the same result, for Spark."""

    java: str = ""
    jrep: str = ""
    re2: str | None = None
    rrep: str | None = None
    passes: int = 1
    plain: tuple[tuple[str, str], ...] = ()

    def spark(self, c: Column) -> Column:
        if self.plain:
            return Replace(self.id, pairs=self.plain).spark(c)
        return F.regexp_replace(c, self.java, self.jrep)

    def sql(self, e: str) -> str:
        pat = self.java if self.re2 is None else self.re2
        rep = self.jrep if self.rrep is None else self.rrep
        for _ in range(self.passes):
            e = f"regexp_replace({e}, {q(pat)}, {q(rep)}, 'g')"
        return e


@dataclass(frozen=True)
class Expr(Rule):
    """Any other column function, with its SQL twin."""

    fn: Callable[[Column], Column] | None = None
    fn_sql: Callable[[str], str] | None = None

    def spark(self, c: Column) -> Column:
        return self.fn(c)

    def sql(self, e: str) -> str:
        return self.fn_sql(e)


@dataclass(frozen=True)
class Dead(Rule):
    """Listed for review; never applied."""

    live: bool = False


@dataclass(frozen=True)
class Chain:
    name: str
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    def live(self) -> list[Rule]:
        return [r for r in self.rules if r.live]

    def then(self, other: "Chain") -> "Chain":
        return Chain(f"{self.name}+{other.name}", self.rules + other.rules)

    # -- Spark ------------------------------------------------------------------------------
    def stages(self) -> list[list[Rule]]:
        """Group live rules into stages; a ``stage`` rule always opens a new one."""
        out: list[list[Rule]] = [[]]
        for r in self.live():
            if r.stage and out[-1]:
                out.append([])
            out[-1].append(r)
        return [s for s in out if s]


    def apply(self, df: DataFrame, src: str, dst: str) -> DataFrame:
        """Add ``dst`` = chain(``src``) as one projection per stage; rules with the same ``needs`` in a row share
        one, with the test for it, and so do rules ``near_digits``."""
        df = df.withColumn(dst, F.col(src))
        for near_digits, run in groupby(self.live(), lambda r: r.near_digits):
            run = list(run)
            if near_digits and len(run) > 1:
                df = df.withColumn(dst, sub_with_long(F.col(dst), DIGITS_J, Chain(self.name, tuple(run)).spark))
                continue
            for stage in Chain(self.name, tuple(run)).stages():
                for needs, rules in groupby(stage, lambda r: r.needs):
                    c = F.col(dst)
                    for r in rules:
                        c = r.spark(c)
                    df = df.withColumn(dst, F.when(F.contains(F.col(dst), F.lit(needs)), c).otherwise(F.col(dst)) if needs else c)
        return df

    def spark(self, c: Column) -> Column:
        """The chain as one expression, for short texts inside a lambda."""
        for r in self.live():
            c = bound(c, r.spark) if r.stage else r.spark(c)
        return c

    # -- DuckDB -----------------------------------------------------------------------------
    def sql_stages(self, col: str = "t") -> list[str]:
        """One SQL expression per stage, each over the plain column ``col``."""
        exprs = []
        for stage in self.stages():
            e = col
            for r in stage:
                e = r.sql(e)
            exprs.append(e)
        return exprs

    def sql_select(self, base_sql: str, src_expr: str, keep: str, out: str) -> str:
        """A DuckDB query: ``SELECT keep, chain(src_expr) AS out FROM (base_sql)`` as nested stages."""
        sql = f"SELECT {keep}, {src_expr} AS t FROM ({base_sql}) b0"
        for i, e in enumerate(self.sql_stages("t")):
            sql = f"SELECT * REPLACE ({e} AS t) FROM ({sql}) s{i}"
        return f"SELECT * EXCLUDE (t), t AS {out} FROM ({sql}) fin"
