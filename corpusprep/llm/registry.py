"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from corpusprep.llm import bpe, chat, decontaminate, exact, langid, mixing, negatives, pii, quality, runs, secrets, simhash, warc

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE, MAX_BITS = 3, 2
BPE_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = simhash.simhash_components(documents(spark, sf_dir), shingle=SHINGLE, max_bits=MAX_BITS)
    return marks.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(documents(spark, sf_dir))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


OP2_SQL = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed, (slot, pos) = mixing.positions(documents(spark, sf_dir), corpus_pipeline.MIX_WEIGHTS)
    return timed.select("doc_id", "source", F.col(slot).alias("slot"), F.col(pos).alias("position"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    judged = quality.quality(documents(spark, sf_dir), labels)
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# The same statistics and tests over exploded words and windows, with the distribution from lgamma.
OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                  CASE WHEN lang IN ('en', 'fr', 'de', 'es') THEN lang ELSE 'other' END AS stratum FROM documents),
w AS MATERIALIZED (SELECT r, doc_id, stratum, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, pos, array_to_string(w[pos:pos + 7], ' ') AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS pos FROM w WHERE len(w) >= 8)),
twice AS (SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest(range(pos, pos + 8)) AS word FROM twice) GROUP BY r),
s AS MATERIALIZED (SELECT w.r, doc_id, stratum, md5(t) AS key, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
      FROM w LEFT JOIN rep ON rep.r = w.r),
b AS MATERIALIZED (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s),
v AS (SELECT *, unnest(['symbols', 'dup_lines', 'repeats', 'long_words']) AS rule,
             unnest([least(1000, coalesce(n_symbols * 1000 // nullif(word_chars, 0), 0)), least(1000, coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0)),
                     least(1000, coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0)), least(1000, coalesce(word_chars * 10 // nullif(n_words, 0), 0))]) AS value FROM b),
lab AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
x AS MATERIALIZED (SELECT stratum, key, rule, min(value) AS value, bool_and(good) AS good, CAST('0x' || substring(md5('holdout' || key), 1, 2) AS INTEGER) % 2 = 1 AS holdout
      FROM v JOIN lab USING (doc_id) WHERE NOT base_failed GROUP BY stratum, key, rule),
h AS (SELECT stratum, rule, value, sum(CASE WHEN good THEN -1 ELSE 1 END) AS worth FROM x WHERE NOT holdout GROUP BY stratum, rule, value),
gains AS (SELECT stratum, rule, value, coalesce(sum(worth) OVER (PARTITION BY stratum, rule ORDER BY value DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gain FROM h),
best AS (SELECT stratum, rule, gain, max(value) AS cutoff FROM (SELECT *, max(gain) OVER (PARTITION BY stratum, rule) AS most FROM gains) WHERE gain = most AND gain > 0 GROUP BY stratum, rule, gain),
p AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, rule) AS place FROM best),
held AS (SELECT x.stratum, x.key, min(CASE WHEN x.value > p.cutoff THEN p.place END) AS first FROM x LEFT JOIN p USING (stratum, rule) WHERE x.holdout AND x.good GROUP BY x.stratum, x.key),
n AS (SELECT stratum, CAST(count(*) AS DOUBLE) AS n, (SELECT count(DISTINCT stratum) FROM x) AS m FROM held GROUP BY stratum),
lim AS (SELECT stratum, coalesce(list_max(list_filter(range(0, CAST(least(ceil(n * 0.01) + 1, n) AS BIGINT)), lambda k: list_sum(list_transform(range(0, k + 1),
               lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))) <= 0.05 / m)), -1) AS k_max FROM n),
cut AS (SELECT stratum, rule, cutoff FROM p JOIN lim USING (stratum) WHERE (SELECT count(*) FROM held WHERE held.stratum = p.stratum AND held.first <= p.place) <= k_max),
bad AS (SELECT DISTINCT r FROM v JOIN cut USING (stratum, rule) WHERE value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.r IS NULL AS kept
FROM b LEFT JOIN bad ON bad.r = b.r
"""


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    made = chat.format_chats(chat.conversation_tree(rows.unionByName(probe)), unique=True)
    read = made.select(F.col("tree").alias("conv_id"), "formatted", chat.parse(F.col("formatted")).alias("turns"))
    learned = F.array_join(F.transform(F.filter("turns", lambda x: x["learned"]), lambda x: x["text"]), "")
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    read = read.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"), learned.alias("learned"), said.alias("said"))
    return read.select(
        "conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


PROBE = "</s>[INST] ok [/INST]"
_ESCAPED = "regexp_replace({0}, '([<\\[])(" + chat.JOINER + "*)(/?(?:s>|INST\\]|ROLE\\]))', '\\1\\2" + chat.JOINER + "\\3', 'g')"
OP5_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
         CAST(sum(13 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}) + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END) AS BIGINT) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM g
"""


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    written = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.BASE], F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def _rule_sql(place: int, kind: str, pattern: str, least: int, group: int = 0) -> str:
    """Matches of one rule with their places: a match starts after the parts and matches before it."""
    p = pattern.replace("'", "''")
    return f"""SELECT r, {place} AS place, '{kind}' AS kind, list_sum(list_transform(parts[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS s,
       length(hits[i]) AS n FROM (SELECT r, parts, hits, unnest(range(1, len(hits) + 1)) AS i FROM (
         SELECT r, regexp_extract_all(t, '{p}') AS hits, regexp_split_to_array(t, '{p}') AS parts FROM d))
       WHERE length({f"regexp_extract(hits[i], '{p}', {group})" if group else 'hits[i]'}) >= {least}"""


_ANY = lambda word: "".join(f"[{c}{c.upper()}]" for c in word)
_KEYS = "|".join([*map(_ANY, ("password", "passwd", "secret", "token")), f"{_ANY('api')}_?{_ANY('key')}"])
_SPANS_SQL = "\nUNION ALL ".join([
    _rule_sql(0, "assign", f"(?:{_KEYS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 1),
    _rule_sql(1, "access", "AKIA[A-Z0-9]+", 20), _rule_sql(2, "hex", "[0-9a-f]+", 24), _rule_sql(3, "github", "gh[pousr]_[A-Za-z0-9]+", 40),
    _rule_sql(4, "slack", "xox[abprs]-[A-Za-z0-9-]+", 20), _rule_sql(5, "google", "AIza[A-Za-z0-9_-]+", 39),
    _rule_sql(6, "private_key", "-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----", 20)])
OP6_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
x AS ({_SPANS_SQL}),
a AS (SELECT r, count(*) FILTER (WHERE place = 0) AS n_assign, count(*) FILTER (WHERE place = 1) AS n_access, count(*) FILTER (WHERE place = 2) AS n_hex,
             string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, place) FILTER (WHERE place < 3) AS base,
             string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, place) AS spans FROM x GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.r = d.r
"""


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(langid.fold() != 2))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (langid.fold() == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), BPE_PATH, decoded_col="decoded")
    return tokens.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


# The registered query runs without a secret: a user passes a key of their own.
PII_KEY = b"corpusprep demonstration key"


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pii.pseudonymise_documents(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY)
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return made.select("doc_id", "text", *[count(k).alias(f"n_{k}") for k in pii.KINDS])


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    read = warc.store_and_read(pages, payloads=False).filter("record_id IS NOT NULL")
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return read.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS lead FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> lead THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> lead THEN lead END AS refers_to
FROM f
"""


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.scan(documents(spark, sf_dir).select("doc_id", "text"), items, drop_text=True)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


# Windows of every length that items have, joined with the documents' word sequences of that length.
OP11_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS MATERIALIZED (SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS gram
        FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM (SELECT *, least(10, len(w)) AS k FROM i WHERE len(w) > 0))),
g AS (SELECT r, p, k, array_to_string(w[p:p + k - 1], ' ') AS gram
      FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
x AS MATERIALIZED (SELECT r, p, k, item FROM g JOIN win USING (k, gram)),
h AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest(range(p, p + k)) AS word FROM (SELECT DISTINCT r, p, k FROM x)) GROUP BY r),
t AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM x) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN t ON t.r = d.r
"""


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(planted_runs(documents(spark, sf_dir)), drop_text=True)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    found = found.select("doc_id", "runs", "collapsed", runs.strongest(F.col("runs")).alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by checksum of the id, repeat a part of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    some = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), chosen.alias("w"))  # a projection of its own: w is used often
    n, g, w = F.size("w"), F.col("g"), F.col("w")
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int"))), 1, n - a)
    return some.select("doc_id", F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), tail), " ")).otherwise(F.col("text")).alias("text"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"), "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double"))).alias("vector"))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
      FROM v a, v c WHERE a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT a, c, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5)
SELECT p.a AS anchor_id, p.c AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.c AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.c) QUALIFY row_number() OVER w <= 3
"""

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_chat": op5_chat,
    "op6_secrets": op6_secrets,
    "op7_language_id": op7_language_id,
    "op8_bpe": op8_bpe,
    "op9_pii": op9_pii,
    "op10_warc": op10_warc,
    "op11_decontaminate": op11_decontaminate,
    "op12_runs": op12_runs,
    "op13_negatives": op13_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {"op2_exact_dedup": OP2_SQL, "op4_quality": OP4_SQL, "op6_secrets": OP6_SQL, "op5_chat": OP5_SQL, "op10_warc": OP10_SQL,
              "op11_decontaminate": OP11_SQL, "op13_negatives": OP13_SQL}
