"""Mixing sources to target weights by Pfair scheduling.

Every source is put into a seeded order and cut into blocks of ``block_rows`` rows. Time is a row of
slots, one block each. With a weight of w out of W, block k of a source is released at floor(k W / w)
and due at ceil((k + 1) W / w), in exact fractions; earliest-deadline-first gives each slot to the
released block with the nearest deadline. One resource that is fully used is always schedulable this
way, so at every slot of a phase each source is less than one block from its exact share.

All rows are kept. When a source runs out, the phase ends and the weights of the others are scaled up.
The schedule repeats after W slots, the weights taken as whole numbers without a common factor; W may
not exceed MAX_SLOTS (weights of up to four digits that add up to 1 pass). Only the block counts of the sources named
in ``weights`` reach the driver, which works out at most W slots for each phase, however many blocks there
are. Rows get their slots by DataFrame operations alone; what they are joined with has at most W rows a
phase and one phase a source, so its size is bounded by the weights alone.
"""

from __future__ import annotations

import heapq
import json
import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import col, partitions, private, saved

CYCLE = 1000
BLOCK_ROWS = 16
MAX_SLOTS = 50_000
OTHER = "(other)"  # all sources without a weight of their own, nulls included
_CELL_BITS = 16  # cells of the seeded order: a source's window is cut into 2^16 parts


def exact(w) -> Fraction:
    """A weight as a fraction: a float as the simplest one that is equal to it, else as its decimal digits."""
    if not isinstance(w, float):
        return Fraction(w)
    simple = Fraction(w).limit_denominator(10**6)
    return simple if float(simple) == w else Fraction(repr(w))


def quotas(weights: dict[str, float], cycle: int) -> dict[str, Fraction]:
    """The exact share of each source in ``cycle`` slots, in blocks."""
    w = {s: exact(x) for s, x in weights.items()}
    total = sum(w.values())
    return {s: x * cycle / total for s, x in w.items()}


def whole(q: dict[str, Fraction]) -> dict[str, int]:
    """Shares as whole numbers without a common factor."""
    q = {s: Fraction(x) for s, x in q.items()}
    by = math.lcm(*[x.denominator for x in q.values()])
    n = {s: int(x * by) for s, x in q.items()}
    return {s: x // math.gcd(*n.values()) for s, x in n.items()}


def edf(n: dict[str, int]):
    """The (source, block) of each slot, without end, for whole shares."""
    size = sum(n.values())
    waiting, ready, t = [(0, s, 0) for s in sorted(n)], [], 0
    while True:
        while waiting and waiting[0][0] <= t:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * size // n[s]), s, k))
        due, s, k = heapq.heappop(ready)
        if due <= t:
            raise AssertionError("a block missed its deadline")
        yield s, k
        heapq.heappush(waiting, ((k + 1) * size // n[s], s, k + 1))
        t += 1


def edf_cycle(q: dict[str, Fraction]) -> list[tuple[str, int]]:
    """The (source, block) of each slot until the schedule repeats."""
    n = whole(q)
    return [x for x, _ in zip(edf(n), range(sum(n.values())))]


@dataclass(frozen=True)
class Phase:
    start_slot: int
    length: int
    cycle: int
    quota: dict[str, int]
    first_block: dict[str, int]
    blocks: dict[str, int]
    slots: list[tuple[str, int]]


def plan(blocks: dict[str, int], weights: dict[str, float], cycle: int = CYCLE) -> list[Phase]:
    """Phases of the whole schedule: each ends with the last block of some source. The unit of the
    shares, ``cycle``, has no influence: the schedule repeats after as many slots as the weights need."""
    left, used, at, out = {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0), 0, []
    while left:
        q = whole(quotas({s: weights[s] for s in left}, cycle))
        size, slots = sum(q.values()), []
        for s, k in edf(q):
            slots.append((s, k))
            if k + 1 == left[s] or len(slots) == size:
                break
        if len(slots) < size:  # a source runs out before the schedule repeats
            size = len(slots)
            q = dict.fromkeys(q, 0)
            for s, _ in slots:
                q[s] += 1
        place = {x: i for i, x in enumerate(slots)}
        length = min((n - 1) // q[s] * size + place[s, (n - 1) % q[s]] + 1 for s, n in left.items() if q[s])
        took = {s: length // size * q[s] for s in left}
        for s, _ in slots[:length % size]:
            took[s] += 1
        out.append(Phase(at, length, size, q, {s: used[s] for s in left}, took, slots))
        used = {s: used[s] + took.get(s, 0) for s in used}
        left = {s: n - took[s] for s, n in left.items() if n > took[s]}
        at += length
    return out


def _literal(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from a JSON literal: no Python worker reads it."""
    fields = [f.split() for f in schema.split(", ")]
    text = json.dumps([{name: x for (name, _), x in zip(fields, r, strict=True)} for r in rows])
    kind = f"array<struct<{', '.join(': '.join(f) for f in fields)}>>"
    return spark.range(1).select(F.explode(F.from_json(F.lit(text), kind)).alias("r")).select("r.*")


def _schedule_tables(spark, phases: list[Phase]) -> tuple[DataFrame, DataFrame]:
    """Spans (phase, source, first and end block, quota, start) and places (phase, source, block, slot)."""
    spans = [(i, s, p.first_block[s], p.first_block[s] + p.blocks[s], p.quota[s], p.start_slot, p.cycle) for i, p in enumerate(phases) for s in p.quota if p.blocks[s]]
    places = [(i, s, k, t) for i, p in enumerate(phases) for t, (s, k) in enumerate(p.slots)]
    return (_literal(spark, spans, "p int, s string, b0 bigint, b1 bigint, q bigint, t0 bigint, cycle bigint"),
            _literal(spark, places, "p int, s string, k bigint, place bigint"))


def positions(docs: DataFrame, weights: dict[str, float], seed: str = "mix", block_rows: int = BLOCK_ROWS, cycle: int = CYCLE,
              id_col: str = "doc_id", source_col: str = "source", carry: bool = False) -> tuple[DataFrame, list[str]]:
    """docs' rows with slot and position, and the names of these two private columns.

    ``weights``: target weight of each source, all above 0, with a schedule of at most MAX_SLOTS slots; sources
    without one, and null, share that of ``OTHER`` (the mean weight if not given). position = slot * block_rows + place in the block
    orders all rows; the last block of a source may be short, so positions have gaps. A source's rows
    are ordered by the MD5 of seed and id, then id, then all columns; rows equal in all of them may swap. ``carry``:
    keep all columns of docs, else only id and source. An empty table gives no rows.
    """
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be above 0")
    weights = {OTHER: sum(exact(w) for w in weights.values()) / len(weights)} | weights
    spark = docs.sparkSession
    src, order, cell, row, base, slot, pos = private(docs, "src", "order", "cell", "row", "base", "slot", "position")
    known = F.create_map(*[x for s in weights for x in (F.lit(s), F.lit(True))])
    named = col(source_col).cast("string")
    of = F.when(F.coalesce(known[named], F.lit(False)), named).otherwise(F.lit(OTHER))
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(col(id_col).cast("string"), F.lit(""))))
    keep = [col(c) for c in (docs.columns if carry else dict.fromkeys((id_col, source_col)))]
    rows = docs.select(*keep, of.alias(src), digest.alias(order))
    rows = rows.withColumn(cell, F.conv(F.substring(order, 1, _CELL_BITS // 4), 16, 10).cast("int"))
    slim = docs.select(of.alias("s"), digest.alias("d")).select("s", F.conv(F.substring("d", 1, _CELL_BITS // 4), 16, 10).cast("int").alias("c"))
    cells = saved(slim.groupBy("s", "c").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    sizes = {r["s"]: r["n"] for r in cells.groupBy("s").agg(F.sum("n").alias("n")).collect()}
    slots = sum(whole(quotas({s: weights[s] for s in sizes}, cycle)).values()) if sizes else 0
    if slots > MAX_SLOTS:
        raise ValueError(f"the schedule of these weights repeats after {slots} slots, more than {MAX_SLOTS}: give them fewer digits")
    phases = plan({s: -(-n // block_rows) for s, n in sizes.items()}, weights, cycle)
    spans, places = _schedule_tables(spark, phases)
    # rows before a cell, in two steps: among the 2^8 cells of its group, and among the 2^8 groups of its source
    group = F.shiftright("c", _CELL_BITS // 2)
    earlier = lambda keys, by: F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    groups = cells.groupBy("s", group.alias("g")).agg(F.sum("n").alias("n")).select(F.col("s").alias("s2"), F.col("g").alias("g2"), earlier(["s"], "g").alias("before"))
    inside = cells.withColumn("g", group).select("s", "g", "c", earlier(["s", "g"], "c").alias("inside"))
    bases = inside.join(groups, (F.col("s") == F.col("s2")) & (F.col("g") == F.col("g2"))).select(
        F.col("s").alias(src + "s"), F.col("c").alias(cell + "c"), (F.col("inside") + F.col("before")).alias(base))
    tie = F.xxhash64(*[c for c in keep])
    within = Window.partitionBy(src, cell).orderBy(order, id_col, tie)
    ranked = rows.join(bases, (F.col(src) == F.col(src + "s")) & (F.col(cell) == F.col(cell + "c"))).withColumn(row, F.row_number().over(within) + F.col(base) - 1)
    block = F.floor(F.col(row) / block_rows).cast("long")
    ranked = ranked.withColumn(base, block)
    timed = (
        ranked.join(F.broadcast(spans), (F.col(src) == F.col("s")) & (F.col(base) >= F.col("b0")) & (F.col(base) < F.col("b1"))).drop("s")
        .join(F.broadcast(places.withColumnRenamed("p", "pp")), (F.col("p") == F.col("pp")) & (F.col(src) == F.col("s")) & (F.col("k") == (F.col(base) - F.col("b0")) % F.col("q")))
        .withColumn(slot, F.col("t0") + F.floor((F.col(base) - F.col("b0")) / F.col("q")) * F.col("cycle") + F.col("place"))
        .withColumn(pos, F.col(slot) * block_rows + F.col(row) % block_rows)
    )
    return timed.select(*keep, slot, pos), [slot, pos]


def mix(docs: DataFrame, weights: dict[str, float], seed: str = "mix", block_rows: int = BLOCK_ROWS, cycle: int = CYCLE,
        id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """All rows of docs in the scheduled order: partition i holds the i-th run of positions, sorted."""
    n = partitions(docs.sparkSession)
    timed, (_, pos) = positions(docs, weights, seed, block_rows, cycle, id_col, source_col, carry=True)
    total = max(1, docs.count() + block_rows * (len(weights) + 1))
    part = F.least(F.lit(n - 1), F.floor(F.col(pos) * n / total)).cast("int")
    return timed.repartitionById(n, part).sortWithinPartitions(pos).select(*[col(c) for c in docs.columns])
