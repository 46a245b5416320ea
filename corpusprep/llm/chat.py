"""Chat formatting from reply trees, in DataFrame functions only.

Messages form trees by their parents. Iterative self-joins double the distance that each message looks
up its tree, so paths of any depth need a logarithmic number of joins. Leaves are ranked by the mean
score along their path; each chosen path is formatted as one conversation.

Template: ``[ROLE]role[/ROLE]`` opens a turn; then ``<s>text</s>`` for an assistant (under the loss
mask) or ``[INST]text[/INST]`` for all others. A control string inside a text or a role gets one more
word joiner (U+2060) after its bracket than it has; reading back takes one away.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import forget, saved

JOINER = "⁠"
LEARNED = "assistant"
_CONTROL = r"(/?(?:s>|INST\]|ROLE\]))"
_OPEN = r"([<\[])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + f"({JOINER}*)" + _CONTROL, f"$1$2{JOINER}$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + JOINER + f"({JOINER}*)" + _CONTROL, "$1$2$3")


def conversation_tree(rows: DataFrame) -> DataFrame:
    """A table of conversations (conv_id, turn, role, text) as reply trees without branches: every
    row answers the one before it. Rows of one turn follow each other by role, then text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = F.row_number().over(order).cast("long")
    return rows.select(F.col("conv_id").alias("tree"), at.alias("node"), F.when(at > 1, at - 1).alias("parent"),
                       F.col("role"), F.col("text"), F.lit(0.0).alias("score"))


def _parents(slim: DataFrame) -> DataFrame:
    """slim with ``up``: the parent if the tree has it and it is another message, else null (a root)."""
    has = slim.select(F.col("tree").alias("t2"), F.col("node").alias("n2"))
    joined = slim.join(has, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("parent") == F.col("n2")) & (F.col("parent") != F.col("node")), "left")
    return joined.select("tree", "node", "score", F.col("n2").alias("up"))


def _rounds(slim: DataFrame) -> int:
    """Doublings after which every message of the largest tree has passed its root, unless it is on or below a cycle."""
    largest = slim.groupBy("tree").count().agg(F.max("count")).first()[0] or 1
    return int(largest).bit_length() + 1


def _cut_cycles(linked: DataFrame, rounds: int) -> DataFrame:
    """linked (tree, node, score, up) with every cycle cut above its smallest message, which becomes a root.

    Pointers are doubled until they have made more steps than a tree has messages: where they point
    then lies on a cycle, and the smallest message that such a pointer has passed is that of its cycle.
    """
    at = saved(linked.filter("up IS NOT NULL").select("tree", "node", "up", F.col("node").alias("low")), "chat-cycle")
    for _ in range(rounds):
        above = at.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), F.col("up").alias("up2"), F.col("low").alias("low2"))
        new = saved(at.join(above, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("up") == F.col("n2")))
                    .select("tree", "node", F.col("up2").alias("up"), F.least("low", "low2").alias("low")), "chat-cycle")
        forget(at)
        at = new
    on = at.select("tree", F.col("up").alias("node")).distinct()
    lowest = at.join(on.select(F.col("tree").alias("t2"), F.col("node").alias("n2")), F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2")), "left_semi")
    cut = lowest.filter("node = low").select(F.col("tree").alias("t2"), F.col("node").alias("n2"))
    out = linked.join(cut, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2")), "left")
    return saved(out.select("tree", "node", "score", F.when(F.col("n2").isNull(), F.col("up")).alias("up")), "chat-linked")


def _levels(linked: DataFrame, rounds: int) -> tuple[list[DataFrame], DataFrame] | None:
    """Jump tables (tree, node, up) for distances 1, 2, 4, ..., and (tree, node, depth, total) of every
    node: the length of its path from the root and the sum of the scores on it. None if some message has
    no root after ``rounds`` doublings.

    Only nodes that have not reached their root are joined again, so a few deep trees cost a few rows a level.
    """
    state = linked.select("tree", "node", "up", F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"))
    jumps, ended = [], []
    while True:
        still, ends = state.filter("up IS NOT NULL"), state.filter("up IS NULL").drop("up")
        ended.append(ends)
        if still.isEmpty():
            return jumps, functools.reduce(DataFrame.unionAll, ended)
        if len(jumps) > rounds:
            return None
        jumps.append(still.select("tree", "node", "up"))
        known = functools.reduce(DataFrame.unionAll, [x.withColumn("up", F.lit(None).cast("long")) for x in ended], still.select("tree", "node", "depth", "total", "up"))
        above = known.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("total").alias("s2"))
        state = saved(
            still.join(above, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("up") == F.col("n2")))
            .select("tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("total") + F.col("s2")).alias("total")), "chat-up")


def reply_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, back): the nodes of the ``top`` best root-to-leaf paths of each tree;
    back is the distance to the leaf.

    messages: tree, node (unique in its tree, not null), parent, score (null counts as 0). Parents may have
    any number. A message whose parent is null, missing or itself is a root; of messages that answer each
    other in a cycle the smallest becomes a root. Ties go to the longer path, then to the smaller leaf.
    """
    slim = messages.select("tree", F.col("node").cast("long").alias("node"), F.col("parent").cast("long").alias("parent"),
                           F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    linked = saved(_parents(saved(slim, "chat-slim")), "chat-linked")
    rounds = _rounds(linked)
    found = _levels(linked, rounds)
    if found is None:
        linked = _cut_cycles(linked, rounds)
        found = _levels(linked, rounds)
    jumps, nodes = found
    answered = linked.filter("up IS NOT NULL").select(F.col("tree").alias("t2"), F.col("up").alias("n2")).distinct()
    leaves = nodes.join(answered, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2")), "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), F.desc("depth"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)  # ranked within each task first
    paths = saved(chosen.select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("back")), "chat-path")
    for k, jump in enumerate(jumps):
        step = jump.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), "up")
        more = paths.join(step, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2"))).select(
            "tree", "leaf", "rank", F.col("up").alias("node"), (F.col("back") + 2**k).alias("back"))
        longer = saved(paths.unionAll(more), "chat-path")
        forget(paths)
        paths = longer
    return paths


def one_per_node(messages: DataFrame) -> DataFrame:
    """(tree, node, parent, score, role, text): of rows that share tree and node, the smallest by parent, score, role
    and text (nulls first). Rows without a node are left out: nothing can be said of their place."""
    parts = [F.col("parent").cast("long").alias("parent"), F.col("score").cast("double").alias("score"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")]
    rows = messages.filter(F.col("node").isNotNull()).select("tree", F.col("node").cast("long").alias("node"), F.struct(*parts).alias("row"))
    return rows.groupBy("tree", "node").agg(F.min("row").alias("row")).select("tree", "node", "row.*")


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """(tree, leaf, rank, formatted, loss_spans): one conversation per path. loss_spans: start and end
    (code points of formatted, end exclusive) of the texts under the loss mask. Null texts and roles are empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    learn = role == LEARNED
    head = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE]"), F.when(learn, "<s>").otherwise("[INST]"))
    tail = F.when(learn, "</s>").otherwise("[/INST]")
    turns = messages.select(F.col("tree").alias("t2"), F.col("node").cast("long").alias("n2"), head.alias("head"), escape(text).alias("body"), tail.alias("tail"), learn.alias("learn"))
    rows = paths.join(turns, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2")))
    before = F.sum(F.length("head") + F.length("body") + F.length("tail")).over(
        Window.partitionBy("tree", "leaf", "rank").orderBy(F.desc("back")).rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0).cast("long")) + F.length("head")
    rows = rows.withColumn("turn", F.struct((-F.col("back")).alias("at"), F.concat("head", "body", "tail").alias("piece"), F.col("learn").alias("learn"),
                                            start.alias("start"), (start + F.length("body")).alias("end")))
    out = rows.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return out.select("tree", "leaf", "rank", F.array_join(F.col("turns.piece"), "").alias("formatted"),
                      F.transform(F.filter("turns", lambda x: x["learn"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """Turns read back from a formatted conversation: array of (role, text, learned)."""
    def turn(part):
        body = F.substring_index(part, "[/ROLE]", -1)
        learned = body.startswith("<s>")
        text = F.when(learned, F.substr(body, F.lit(4), F.length(body) - 7)).otherwise(F.substr(body, F.lit(7), F.length(body) - 13))
        return F.struct(unescape(F.substring_index(part, "[/ROLE]", 1)).alias("role"), unescape(text).alias("text"), learned.alias("learned"))

    return F.transform(F.filter(F.split(formatted, r"\[ROLE\]"), lambda x: x != ""), turn)


def format_chats(messages: DataFrame, top: int = 1, unique: bool = False) -> DataFrame:
    """The best ``top`` paths of every reply tree as conversations. An empty table gives no rows; extra
    columns are ignored; of rows that repeat a (tree, node) pair one counts (see one_per_node; ``unique``
    skips this where the caller knows that there are none)."""
    messages = messages if unique else saved(one_per_node(messages), "chat-messages")
    return format_paths(messages, reply_paths(messages, top))
