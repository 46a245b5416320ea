"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Statistics come from each whole text. Each distinct labelled text counts once and falls into one of two
halves. On the tuning half a cutoff of a rule is worth the low-quality texts it rejects less the good
ones; every rule takes its best cutoff, and a stratum's rules are put in the order of their worth. The
holdout half then tests growing sets of rules: the first, the first two, and so on. Let n be the good
holdout texts of a stratum and k those that any rule of the set rejects: P(Bin(n, alpha) <= k) <=
delta / m shows, at level delta over all m strata (Bonferroni), that the false rejection rate of the
whole set is below alpha. The first failure ends the sequence (fixed-sequence testing), so the sets of one
stratum need no further correction. A stratum with too few labels to show anything gets no cutoff: all its
documents are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import col, saved

WINDOW = 8
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
STRATA = ("en", "fr", "de", "es")  # all other languages, and null, form one more stratum
REST = "other"
RULES = ("symbols", "dup_lines", "repeats", "long_words")
TOP = 1000  # rule values are whole numbers from 0 to TOP


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One slim row per document: id, stratum, text_key (MD5), n_words, word_chars, n_symbols, n_lines (with a word),
    n_dup_lines, n_repeat_words. A null text has no words. Windows are compared by a 64-bit hash."""
    lang = col(lang_col).cast("string")
    d = docs.select(
        col(id_col).cast("long").alias("id"), F.when(lang.isin(*STRATA), lang).otherwise(REST).alias("stratum"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("t"))
    d = d.withColumn("w", F.array_remove(F.split("t", SPACES), "")).withColumn(
        "lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.select(
        "id", "stratum", "w", F.md5(F.col("t").cast("binary")).alias("text_key"), F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    n = F.col("n_words").cast("int")
    stats = [c for c in d.columns if c != "w"]
    # hashes of 1, 2, 4 and 8 words, each from the one before
    d = d.select(*stats, F.when(n >= WINDOW, F.transform("w", lambda x: F.xxhash64(x))).otherwise(F.array().cast("array<bigint>")).alias("h"))
    size = 1
    while size < WINDOW:
        left = F.greatest(F.size("h") - size, F.lit(0))
        d = d.select(*stats, F.zip_with(F.slice("h", 1, left), F.slice("h", size + 1, left), lambda a, b: F.xxhash64(a, b)).alias("h"))
        size *= 2
    d = d.select(*stats, F.when(F.size(F.array_distinct("h")) < F.size("h"), F.col("h")).otherwise(F.array().cast("array<bigint>")).alias("h"))
    d = d.select(*stats, F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))).alias("s"))
    twice = F.filter("s", lambda x, i: (x["h"] == F.get("s", i - 1)["h"]) | (x["h"] == F.get("s", i + 1)["h"]))
    d = d.select(*stats, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("p"))
    new = F.transform("p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW))))
    return d.select(*stats, F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_values() -> list[Column]:
    """The rules' values in the order of RULES: whole numbers, larger is worse, 0 without words."""
    def share(a, b, by):
        return F.coalesce(F.least(F.lit(TOP), F.floor(F.col(a) * by / F.nullif(F.col(b), F.lit(0)))), F.lit(0)).cast("int")

    return [share("n_symbols", "word_chars", 1000), share("n_dup_lines", "n_lines", 1000), share("n_repeat_words", "n_words", 1000), share("word_chars", "n_words", 10)]


def most_rejections(n: Column, alpha: float, level: Column) -> Column:
    """The largest k with P(Bin(n, alpha) <= k) <= level; -1 if there is none. The terms of the
    distribution follow from each other by their logarithms."""
    odds = F.log(F.lit(alpha / (1 - alpha)))
    zero = F.struct((n * F.log(F.lit(1 - alpha))).alias("term"), F.lit(0.0).alias("cdf"), F.lit(-1).cast("long").alias("best"))

    def step(s, k):
        cdf = s["cdf"] + F.exp(s["term"])
        return F.struct((s["term"] + F.log((n - k).cast("double") / (k + 1)) + odds).alias("term"), cdf.alias("cdf"),
                        F.when(cdf <= level, k).otherwise(s["best"]).alias("best"))

    upto = F.ceil(n * alpha).cast("long")  # beyond the mean the distribution function is above any usual level
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), F.least(upto, n - 1)), zero, step)["best"]).otherwise(-1)


def labelled_texts(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """(stratum, good, holdout, v1, v2, ...): every distinct labelled text that passes the base rules once, with its
    rules' values. labels: doc_id and quality (1 good, 0 bad; null rows are left out). Of several labels of a
    document or of copies of a text the smallest counts."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg((F.min("quality") > 0).alias("good"))
    rows = stats.filter(~base_failed()).join(known, F.col("id") == F.col("label_id"))
    names = [f"v{i}" for i in range(1, len(RULES) + 1)]
    rows = rows.select("stratum", "text_key", "good", *[v.alias(n) for n, v in zip(names, rule_values(), strict=True)])
    texts = rows.groupBy("stratum", "text_key").agg(F.bool_and("good").alias("good"), *[F.min(n).alias(n) for n in names])  # copies have equal values
    holdout = F.conv(F.substring(F.md5(F.concat(F.lit("holdout"), F.col("text_key"))), 1, 2), 16, 10).cast("int") % 2 == 1
    return texts.select("stratum", "good", holdout.alias("holdout"), *names)


def thresholds(stats: DataFrame, labels: DataFrame, alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff): a rule rejects values above its cutoff. No row: the rule rejects nothing.

    All rules of a stratum together reject fewer than alpha of its good texts, for all strata at once with a
    confidence of 1 - delta (see labelled_texts for what counts).
    """
    texts = saved(labelled_texts(stats, labels), "quality-texts")
    m = texts.select("stratum").distinct().count()
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"v{i}").alias("value")) for i, r in enumerate(RULES, 1)])).alias("x")
    worth = F.sum(F.when(F.col("good"), -1).otherwise(1)).alias("worth")
    hist = texts.filter(~F.col("holdout")).select("stratum", "good", values).groupBy("stratum", "x.rule", "x.value").agg(worth)
    # at most strata x rules x (TOP + 1) rows from here on
    above = Window.partitionBy("stratum", "rule").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    cuts = hist.select("stratum", "rule", "value", F.coalesce(F.sum("worth").over(above), F.lit(0)).alias("gain")).filter("gain > 0")
    best = cuts.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "value")).alias("best")).select("stratum", "rule", "best.gain", F.col("best.value").alias("cutoff"))
    place = F.row_number().over(Window.partitionBy("stratum").orderBy(F.desc("gain"), "rule"))
    best = saved(best.select("stratum", "rule", "cutoff", place.alias("place")), "quality-cutoffs")
    # the place of the first rule of its stratum that rejects a good holdout text
    wide = best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.struct("cutoff", "place"))).alias(f"c{i}") for i, r in enumerate(RULES, 1)])
    held = texts.filter("holdout AND good").join(F.broadcast(wide), "stratum", "left")
    first = F.least(*[F.when(F.col(f"v{i}") > F.col(f"c{i}.cutoff"), F.col(f"c{i}.place")) for i in range(1, len(RULES) + 1)])
    lost = held.select("stratum", first.alias("first")).groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.count_if(F.col("first") <= i) for i in range(1, len(RULES) + 1)]).alias("k"))
    limit = lost.select("stratum", "k", most_rejections(F.col("n"), alpha, F.lit(delta / max(1, m))).alias("k_max"))
    shown = best.join(limit, "stratum").filter(F.element_at("k", F.col("place")) <= F.col("k_max"))
    return shown.select("stratum", "rule", "cutoff")


def judge(stats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """stats with base_failed and kept. ``cutoffs`` has at most strata x rules rows, so it is broadcast."""
    wide = cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])
    good = F.lit(True)
    for r, v in zip(RULES, rule_values(), strict=True):
        good &= F.coalesce(v <= F.col(f"cut_{r}"), F.lit(True))
    out = stats.join(F.broadcast(wide), "stratum", "left").withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & good).drop(*[f"cut_{r}" for r in RULES])


def quality(docs: DataFrame, labels: DataFrame, alpha: float = 0.01, delta: float = 0.05, id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: statistics, base_failed and kept. Repeated rows stay repeated; a document
    with a null id is judged but has no label; empty tables give no rows or no cutoffs."""
    stats = saved(statistics(docs, id_col, text_col, lang_col), "quality-stats")
    return judge(stats, thresholds(stats, labels, alpha, delta))
