"""Corpus BLEU (B6) as a distributed aggregation.

Tokeniser: the "13a" rules (Post 2018, the WMT mteval-v13a tokenisation): drop ``<skipped>``,
join ``-\\n`` line breaks, turn newlines into spaces, unescape four HTML entities, pad ASCII
punctuation with spaces, split full stops and commas unless next to a digit, split a dash after a
digit, split on whitespace. Score: Papineni et al. (2002) geometric mean of clipped n-gram
precisions (n = 1..4) with brevity penalty; an n with no match gets the "exp" smoothing
(1 / 2^k for the k-th such n).

Plan: rows are hash-partitioned once by row id. Each word of either side becomes one record with the three
words after it, and the 4-grams are counted on that partitioning (no further exchange). Counts of shorter n-grams are
sums of those of the longer ones they begin, so each order is aggregated from the groups of the next longer one,
which carry the matches and totals along. The sums fold into one small global aggregate. No join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.regex import q
from ..functions.tokens import split_ws_sql

MAX_ORDER = 4
# A partition's word records take many times the room of its texts: so many times more partitions keep them in memory.
SMALLER = 8

# The 13a tokenisation rules, in order (pattern, replacement).
TOKENIZE_13A = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
# The same rules and whitespace for Spark. Java looks up the characters below 256 that a class lists one by one in a table, but
# tries ranges one after another. The space is left out of the first rule: padding it changes no token.
PUNCTUATION_JAVA = (r'([!"#$%&()*+/:;<=>?@\[\\\]^_`{|}~])', " $1 ")
SPACES_JAVA = r"[ \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
HTML_ENTITIES = [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]


def tokenize_13a(c: Column) -> Column:
    t = F.coalesce(c, F.lit(""))
    t = F.replace(F.replace(F.replace(t, F.lit("<skipped>"), F.lit("")), F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(" "))
    for a, b in HTML_ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.concat(F.lit(" "), t, F.lit(" "))
    for pat, rep in [PUNCTUATION_JAVA, *TOKENIZE_13A[1:]]:
        t = F.regexp_replace(t, pat, rep)
    return F.filter(F.split(t, SPACES_JAVA), lambda w: w != "")


def tokenize_13a_sql(e: str) -> str:
    t = f"coalesce({e}, '')"
    t = f"replace(replace(replace({t}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for a, b in HTML_ENTITIES:
        t = f"replace({t}, {q(a)}, {q(b)})"
    t = f"(' ' || {t} || ' ')"
    for pat, rep in TOKENIZE_13A:
        t = f"regexp_replace({t}, {q(pat)}, {q(rep.replace('$', chr(92)))}, 'g')"
    return split_ws_sql(t)


def word_rows(df: DataFrame, row_id: str, hyp: str, ref: str) -> DataFrame:
    """(_rid, w1..w4, h, r): one row per word on either side, with the words after it (null past the end)."""
    t = df.select(F.col(row_id).alias("_rid"), tokenize_13a(F.col(hyp)).alias("_th"), tokenize_13a(F.col(ref)).alias("_tr"))

    def windows(tok: str, h: int) -> Column:
        return F.arrays_zip(*[F.slice(tok, n, F.size(tok)) for n in range(1, MAX_ORDER + 1)], F.array_repeat(F.lit(h), F.size(tok)))

    # the array is built inside explode: of an array column Spark would infer a filter that tokenises anew
    words = t.select("_rid", F.explode(F.concat(windows("_th", 1), windows("_tr", 0))).alias("_w"))
    h = F.col(f"_w.`{MAX_ORDER}`").cast("long")
    return words.select("_rid", *[F.col(f"_w.`{n}`").alias(f"w{n + 1}") for n in range(MAX_ORDER)], h.alias("h"), (1 - h).alias("r"))


def bleu_stats(df: DataFrame, row_id: str, hyp: str, ref: str) -> DataFrame:
    """One row: sys_len, ref_len, match_1..4, total_1..4."""
    parts = SMALLER * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grams = word_rows(df.select(row_id, hyp, ref).repartition(parts, row_id), row_id, hyp, ref)
    done: list[str] = []
    for n in range(MAX_ORDER, 0, -1):
        # here the groups of the next longer n-grams are the rows; those cut short by the end of a text count too
        grams = grams.groupBy("_rid", *[f"w{i}" for i in range(1, n + 1)]).agg(F.sum("h").alias("h"), F.sum("r").alias("r"), *[F.sum(c).alias(c) for c in done])
        whole = F.col(f"w{n}").isNotNull()
        grams = grams.select(
            "*", F.when(whole, F.least("h", "r")).otherwise(0).alias(f"match_{n}"), F.when(whole, F.col("h")).otherwise(0).alias(f"total_{n}"))
        done += [f"match_{n}", f"total_{n}"]

    def total(col: str, name: str) -> Column:
        return F.coalesce(F.sum(col), F.lit(0)).cast("long").alias(name)

    return grams.agg(
        total("h", "sys_len"), total("r", "ref_len"),
        *[total(c, c) for what in ("match", "total") for c in (f"{what}_{n}" for n in range(1, MAX_ORDER + 1))],
    )


def bleu_stats_sql(base_sql: str, row_id: str, hyp: str, ref: str) -> str:
    grams = " UNION ALL ".join(
        f"SELECT rid, {n} AS n, array_to_string(list_slice(tok, i, i + {n - 1}), ' ') AS g, {h} AS h, {1 - h} AS r "
        f"FROM (SELECT rid, tok, unnest(range(1, len(tok) - {n - 2})) AS i FROM t{side} WHERE len(tok) >= {n})"
        for n in range(1, MAX_ORDER + 1) for side, h in (("h", 1), ("r", 0))
    )
    m = ", ".join(f"coalesce(sum(CASE WHEN n = {n} THEN least(h, r) END), 0)::BIGINT AS match_{n}" for n in range(1, MAX_ORDER + 1))
    tot = ", ".join(f"coalesce(sum(CASE WHEN n = {n} THEN h END), 0)::BIGINT AS total_{n}" for n in range(1, MAX_ORDER + 1))
    return f"""
WITH b AS (SELECT {row_id} AS rid, {tokenize_13a_sql(hyp)} AS th, {tokenize_13a_sql(ref)} AS tr FROM ({base_sql})),
th AS (SELECT rid, th AS tok FROM b), tr AS (SELECT rid, tr AS tok FROM b),
g AS (SELECT rid, n, g, sum(h) AS h, sum(r) AS r FROM ({grams}) GROUP BY rid, n, g)
SELECT (SELECT coalesce(sum(len(th)), 0)::BIGINT FROM b) AS sys_len, (SELECT coalesce(sum(len(tr)), 0)::BIGINT FROM b) AS ref_len,
       {m}, {tot} FROM g"""


def bleu_from_stats(stats: DataFrame) -> DataFrame:
    """Score, four precisions and brevity penalty from one stats row (all on the executors)."""
    c = F.col
    precisions = []
    smooth = F.lit(1.0)
    # a corpus without any match scores 0: there is nothing to smooth
    matched = F.lit(False)
    for n in range(1, MAX_ORDER + 1):
        matched = matched | (c(f"match_{n}") > 0)
    alive = matched
    for n in range(1, MAX_ORDER + 1):
        m, t = c(f"match_{n}").cast("double"), c(f"total_{n}").cast("double")
        alive = alive & (t > 0)
        zero = alive & (m == 0)
        smooth = F.when(zero, smooth * 2).otherwise(smooth)
        p = F.when(~alive, F.lit(0.0)).when(m == 0, F.lit(100.0) / (smooth * t)).otherwise(F.lit(100.0) * m / t)
        precisions.append(p)
    sys_len, ref_len = c("sys_len").cast("double"), c("ref_len").cast("double")
    bp = F.when(sys_len < ref_len, F.when(sys_len > 0, F.exp(F.lit(1.0) - ref_len / sys_len)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0))
    logs = [F.when(p > 0, F.log(p)).otherwise(F.lit(-9999999999.0)) for p in precisions]
    score = bp * F.exp((logs[0] + logs[1] + logs[2] + logs[3]) / MAX_ORDER)
    return stats.select(
        score.alias("bleu"), *[p.alias(f"precision_{i + 1}") for i, p in enumerate(precisions)], bp.alias("bp"),
        "sys_len", "ref_len",
    )


def bleu_from_stats_sql(stats_sql: str) -> str:
    smooth = "1.0"
    alive = "(" + " OR ".join(f"match_{n} > 0" for n in range(1, MAX_ORDER + 1)) + ")"
    ps = []
    for n in range(1, MAX_ORDER + 1):
        m, t = f"match_{n}::DOUBLE", f"total_{n}::DOUBLE"
        alive = f"({alive} AND {t} > 0)"
        smooth = f"(CASE WHEN {alive} AND {m} = 0 THEN {smooth} * 2 ELSE {smooth} END)"
        ps.append(f"(CASE WHEN NOT {alive} THEN 0.0 WHEN {m} = 0 THEN 100.0 / ({smooth} * {t}) ELSE 100.0 * {m} / {t} END)")
    bp = "(CASE WHEN sys_len < ref_len THEN (CASE WHEN sys_len > 0 THEN exp(1.0 - ref_len::DOUBLE / sys_len) ELSE 0.0 END) ELSE 1.0 END)"
    logs = " + ".join(f"(CASE WHEN {p} > 0 THEN ln({p}) ELSE -9999999999.0 END)" for p in ps)
    cols = ", ".join(f"{p} AS precision_{i + 1}" for i, p in enumerate(ps))
    return f"SELECT {bp} * exp(({logs}) / {MAX_ORDER}) AS bleu, {cols}, {bp} AS bp, sys_len, ref_len FROM ({stats_sql})"
