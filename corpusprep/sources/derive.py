"""Reference-shaped tables derived from the driver tables, each with its DuckDB twin.

The reference reads transcribed documents, sentence start numbers, a dictionary, a lexicon of
dictionary URLs, API payloads and training pairs. The driver ships generic text tables instead;
these adapters derive the same shapes with Spark, so every query's work grows with the input:

=============  =============================================================================
documents      ``oare_id`` = doc_id, ``transliteration`` = text + deterministic damage that
               exercises the cleaning rules, ``translation`` = whole text + damage; appended: bare
               documents (copies under ids of their own) without sentences and translation
sentences      one row per text line with a token: word number of the line's first word (running
               token count, computed in-row - no shuffle); appended: sentences whose number is
               missing, 0, not a number or taken, without a translation
definitions    benchmark words; a bounded definition text from the items that use the word
lexicon        pages: row type ('PN' for spam hosts, 'word' for https, ' word ' padded
               otherwise), a form (language and page number of the URL's path) and the page URL
payloads       one JSON array of ``{"meaning": ...}`` per page URL, built from the page HTML
pairs          conversations: a user turn and the assistant turn that follows it
=============  =============================================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.regex import q
from ..functions.tokens import split_ws, split_ws_sql
from ..session import spread

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Fixed values of the synthetic damage (ours, not the reference's). Rows for rare cases are appended: every
# row of the driver's tables keeps its whole text, number and translation.
BARE = 47  # ids divisible by it appear once more as a document without sentences and translation
ODD = 31  # ids divisible by it have one more sentence, with one of ODD_NUMBERS
ODD_NUMBERS = (None, "0", "n/a", "1")
BLANK = 61  # a turn whose conversation and turn add up to a multiple of it has a blank row beside it
ROMAN = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------------------------
# documents
# ---------------------------------------------------------------------------------------------
def _s(c: Column) -> Column:
    return c.cast("string")


def source_damage(text: Column, i: Column) -> Column:
    return F.concat(
        text, F.lit(" obv. ["), _s(i % 9), F.lit("] "), _s(i % 5), F.lit("+"), _s(i % 7),
        F.lit("+1 x xx … a-lim(ki) šu"), _s(i % 10), F.lit(" PN "), _s(i % 4), F.lit("."),
        _s(i % 1000), F.lit(" [x x] . . . ᵈUTU Seal Impression "), F.char(F.lit(65) + i % 26),
        F.lit(" rev. ki-ma (??) ša=X "), _s(i % 3), F.lit(" broken ≪tup-pí≫ ⸢"), _s(i % 8),
        F.lit("⸣ ------------ ---- Single Ruling ---- a break b ---- Double Ruling ----"),
    )


def source_damage_sql(text: str, i: str) -> str:
    return (
        f"concat({text}, ' obv. [', {i} % 9, '] ', {i} % 5, '+', {i} % 7, "
        f"'+1 x xx … a-lim(ki) šu', {i} % 10, ' PN ', {i} % 4, '.', {i} % 1000, "
        f"' [x x] . . . ᵈUTU Seal Impression ', chr(CAST(65 + {i} % 26 AS INTEGER)), "
        f"' rev. ki-ma (??) ša=X ', {i} % 3, ' broken ≪tup-pí≫ ⸢', {i} % 8, '⸣ ------------ ---- Single Ruling ---- a break b ---- Double Ruling ----')"
    )


def target_damage(text: Column, i: Column) -> Column:
    roman = F.element_at(F.array(*[F.lit(r) for r in ROMAN]), (i % 12 + 1).cast("int"))
    return F.concat(
        text, F.lit(" (fem. pl.) "), _s(i % 3), F.lit(" "), _s(i % 8), F.lit("/"), _s(i % 6),
        F.lit(" in Month "), roman, F.lit(" Assur's (K) ₂ {"), _s(i % 7), F.lit(" broken lines} ("),
        _s(i % 4), F.lit(") ["), _s(i % 6), F.lit("] 0."), _s(i % 100), F.lit(" X PN 2 1/2 u.e. . . ."),
    )


def target_damage_sql(text: str, i: str) -> str:
    roman = "[" + ", ".join(q(r) for r in ROMAN) + f"][{i} % 12 + 1]"
    return (
        f"concat({text}, ' (fem. pl.) ', {i} % 3, ' ', {i} % 8, '/', {i} % 6, ' in Month ', {roman}, "
        f"' Assur''s (K) ₂ {{', {i} % 7, ' broken lines}} (', {i} % 4, ') [', {i} % 6, '] 0.', {i} % 100, "
        f"' X PN 2 1/2 u.e. . . .')"
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    copies = F.when(d.doc_id % BARE == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    d = d.select("doc_id", "text", "lang", F.explode(copies).alias("bare"))
    return d.select(
        F.concat(d.doc_id.cast("string"), F.when(d.bare, F.lit("-bare")).otherwise(F.lit(""))).alias("oare_id"),
        source_damage(d.text, d.doc_id).alias("transliteration"),
        F.when(~d.bare, target_damage(d.text, d.doc_id)).alias("translation"),
        "lang",
        d.doc_id.alias("doc_ordinal"),
    )


def documents_sql() -> str:
    return (
        f"SELECT CAST(doc_id AS VARCHAR) || CASE WHEN bare THEN '-bare' ELSE '' END AS oare_id, {source_damage_sql('text', 'doc_id')} AS transliteration, "
        f"CASE WHEN NOT bare THEN {target_damage_sql('text', 'doc_id')} END AS translation, "
        f"lang, doc_id AS doc_ordinal FROM (SELECT *, false AS bare FROM documents UNION ALL "
        f"SELECT *, true AS bare FROM documents WHERE doc_id % {BARE} = 0)"
    )


# ---------------------------------------------------------------------------------------------
# sentences
# ---------------------------------------------------------------------------------------------
def _line_key(doc_id: Column, pos: Column) -> Column:
    """Composite key of a line: positions have up to ten digits, so keys never meet."""
    return F.concat(doc_id.cast("string"), F.lit("-"), F.lpad(pos.cast("string"), 10, "0"))


def _line_key_sql(doc_id: str, pos: str) -> str:
    return f"(CAST({doc_id} AS VARCHAR) || '-' || lpad(CAST({pos} AS VARCHAR), 10, '0'))"


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line starts computed inside the row (prefix sums with ``aggregate``): no shuffle. An odd
    sentence is one more element of its document's lines, without a translation."""
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = F.split(d.text, "\n")
    counts = F.transform(lines, lambda l: F.size(split_ws(l)))
    prefix = F.aggregate(
        counts, F.array(F.lit(1)), lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c))
    )
    prefix = F.slice(prefix, 1, F.size(lines))
    rows = F.transform(F.arrays_zip(lines.alias("line"), counts.alias("n"), prefix.alias("start")), lambda r, i: F.struct(
        i.alias("pos"), r["line"].alias("line"), r["n"].alias("n"), r["start"].cast("string").alias("start"), F.lit(False).alias("odd")))
    number = F.element_at(F.array(*[F.lit(v) for v in ODD_NUMBERS]), ((d.doc_id / ODD) % len(ODD_NUMBERS) + 1).cast("int"))
    odd = F.struct(F.lit(0).alias("pos"), F.lit(None).cast("string").alias("line"), F.lit(1).alias("n"), number.alias("start"), F.lit(True).alias("odd"))
    rows = F.when((d.doc_id % ODD == 0) & d.text.isNotNull(), F.concat(rows, F.array(odd))).otherwise(rows)
    x = d.select("doc_id", F.explode(rows).alias("r")).select("doc_id", "r.*").filter(F.col("n") > 0)
    return x.select(
        x.doc_id.cast("string").alias("text_uuid"),
        F.concat(_line_key(x.doc_id, x.pos), F.when(x.odd, F.lit("-odd")).otherwise(F.lit(""))).alias("sentence_uuid"),
        x.start.alias("first_word_number"),
        x.line.alias("translation"),
        x.pos.cast("long").alias("sent_ordinal"),
    )


def sentences_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN {'NULL' if v is None else q(v)}" for i, v in enumerate(ODD_NUMBERS))
    return f"""
SELECT CAST(doc_id AS VARCHAR) AS text_uuid,
       {_line_key_sql('doc_id', 'pos')} AS sentence_uuid,
       CAST(1 + coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS VARCHAR)
         AS first_word_number,
       line AS translation,
       CAST(pos AS BIGINT) AS sent_ordinal
FROM (SELECT doc_id, line, pos - 1 AS pos, len({split_ws_sql('line')}) AS n
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM documents))
WHERE n > 0
UNION ALL
SELECT CAST(doc_id AS VARCHAR) AS text_uuid, {_line_key_sql('doc_id', '0')} || '-odd' AS sentence_uuid,
       CASE (doc_id // {ODD}) % {len(ODD_NUMBERS)} {cases} END AS first_word_number, NULL AS translation, 0::BIGINT AS sent_ordinal
FROM documents WHERE doc_id % {ODD} = 0 AND text IS NOT NULL"""


# ---------------------------------------------------------------------------------------------
# test documents (T3): the lines of all documents
# ---------------------------------------------------------------------------------------------
def test_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    x = d.select("doc_id", F.posexplode(F.split(d.text, "\n")).alias("pos", "line"))
    n = F.size(split_ws(x.line))
    return x.select(
        _line_key(x.doc_id, x.pos).alias("id"),
        x.doc_id.cast("string").alias("text_id"),
        (x.pos + 1).cast("string").alias("line_start"),
        (x.pos + n).cast("string").alias("line_end"),
        source_damage(x.line, x.doc_id + x.pos).alias("transliteration"),
    )


def test_documents_sql() -> str:
    dmg = source_damage_sql("line", "(doc_id + pos)")
    return f"""
SELECT {_line_key_sql('doc_id', 'pos')} AS id, CAST(doc_id AS VARCHAR) AS text_id,
       CAST(pos + 1 AS VARCHAR) AS line_start, CAST(pos + len({split_ws_sql('line')}) AS VARCHAR) AS line_end,
       {dmg} AS transliteration
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
      FROM documents)"""


# ---------------------------------------------------------------------------------------------
# definitions (T5): word, definition, ordinal (file order)
# ---------------------------------------------------------------------------------------------
ORDINAL_STRIDE = 2**32  # positions in an array are below 2^31, so ordinals never meet


def _definition(n: Column, lo: Column, hi: Column, word: Column) -> Column:
    """Bounded text per word: one-letter words get '' (blocks the lower-case fallback), words in
    one item a quoted gloss, words in 4+ items four ';' (rejected by the annotator)."""
    return (
        F.when(F.length(word) == 1, F.lit(""))
        .when(n == 1, F.concat(F.lit('" only in item '), lo.cast("string"), F.lit(' "')))
        .when(n >= 4, F.concat(F.lit("common; in "), n.cast("string"), F.lit(" items; first "), lo.cast("string"),
                               F.lit("; last "), hi.cast("string"), F.lit("; more")))
        .otherwise(F.concat(F.lit("in "), n.cast("string"), F.lit(" items; first "), lo.cast("string"),
                            F.lit("; last "), hi.cast("string")))
    )


def _definition_sql(n: str, lo: str, hi: str, word: str) -> str:
    return (
        f"CASE WHEN length({word}) = 1 THEN '' "
        f"WHEN {n} = 1 THEN '\" only in item ' || {lo} || ' \"' "
        f"WHEN {n} >= 4 THEN 'common; in ' || {n} || ' items; first ' || {lo} || '; last ' || {hi} || '; more' "
        f"ELSE 'in ' || {n} || ' items; first ' || {lo} || '; last ' || {hi} END"
    ).replace('\\"', '"')


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    t = b.select("item_id", F.posexplode(split_ws(b.text)).alias("pos", "word"))
    g = t.groupBy("word").agg(
        F.count_distinct("item_id").alias("n"),
        F.min("item_id").alias("lo"),
        F.max("item_id").alias("hi"),
        F.min(t.item_id * ORDINAL_STRIDE + t.pos).alias("ordinal"),
    )
    return g.select("word", _definition(g.n, g.lo, g.hi, g.word).alias("definition"), "ordinal")


def definitions_sql() -> str:
    d = _definition_sql("n", "lo", "hi", "word")
    return f"""
SELECT word, {d} AS definition, ordinal FROM (
  SELECT word, count(DISTINCT item_id) AS n, min(item_id) AS lo, max(item_id) AS hi,
         min(item_id * {ORDINAL_STRIDE} + pos) AS ordinal
  FROM (SELECT item_id, unnest({split_ws_sql('text')}) AS word,
               generate_subscripts({split_ws_sql('text')}, 1) - 1 AS pos FROM benchmark)
  GROUP BY word)"""


# ---------------------------------------------------------------------------------------------
# lexicon (T4) and payloads (T14) from pages
# ---------------------------------------------------------------------------------------------
PAGE_FORM = r"://[^/]+/([a-z]+/[0-9]+)"
URL_PARAM = "ref="


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return p.select(
        F.when(p.url.contains("spam"), F.lit("PN")).when(p.url.startswith("https"), F.lit("word"))
        .otherwise(F.lit(" word ")).alias("row_type"),
        F.concat(F.lit(" "), F.regexp_extract(p.url, PAGE_FORM, 1)).alias("form"),
        F.concat(p.url, F.lit(" ")).alias("url"),
        p.page_id.alias("ordinal"),
    )


def lexicon_sql() -> str:
    return (
        "SELECT CASE WHEN contains(url, 'spam') THEN 'PN' WHEN starts_with(url, 'https') THEN 'word' ELSE ' word ' END AS row_type, "
        f"' ' || regexp_extract(url, {q(PAGE_FORM)}, 1) AS form, url || ' ' AS url, page_id AS ordinal FROM pages"
    )


TITLE = r"<title>([^<]*)</title>"
PARAGRAPH = r"<p>([^<]*)</p>"


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"meaning": ...}`` items: the page title, then each paragraph, every other one with two
    quoted words and an escaped bracket (the forms X10 handles), then an item without meaning."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    paras = F.regexp_extract_all(p.html, F.lit(PARAGRAPH), 1)
    items = F.transform(
        paras,
        lambda t, k: F.when(
            k % 2 == 0,
            F.concat(F.lit('"'), F.substring_index(t, " ", 1), F.lit('" \\[x\\] "'), F.substring_index(t, " ", -1), F.lit('"')),
        ).otherwise(t),
    )
    meanings = F.concat(F.array(F.regexp_extract(p.html, TITLE, 1)), items)
    arr = F.transform(meanings, lambda m: F.struct(m.alias("meaning")))
    arr = F.concat(arr, F.array(F.struct(F.lit(None).cast("string").alias("meaning"))))
    return p.select(p.url, F.to_json(arr).alias("payload"))


def payloads_sql() -> str:
    items = (
        f"list_transform(regexp_extract_all(html, {q(PARAGRAPH)}, 1), lambda t_, k_: CASE WHEN (k_ - 1) % 2 = 0 "
        "THEN '\"' || split_part(t_, ' ', 1) || '\" \\[x\\] \"' || split_part(t_, ' ', -1) || '\"' ELSE t_ END)"
    )
    return (
        f"SELECT url, list_concat([regexp_extract(html, {q(TITLE)}, 1)], {items}) AS meanings FROM pages"
    )


# ---------------------------------------------------------------------------------------------
# inputs of the predictor: the turns, and blank rows beside some of them
# ---------------------------------------------------------------------------------------------
def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    blank = c.filter((c.conv_id + c.turn) % BLANK == 0).select("conv_id", (-1 - c.turn).alias("turn"), F.lit(" ").alias("text"))
    return c.unionByName(blank)


def turns_sql() -> str:
    return (f"SELECT conv_id, turn, text FROM conversations UNION ALL "
            f"SELECT conv_id, -1 - turn AS turn, ' ' AS text FROM conversations WHERE (conv_id + turn) % {BLANK} = 0")


# ---------------------------------------------------------------------------------------------
# pairs (T9)
# ---------------------------------------------------------------------------------------------
def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn t with assistant turn t+1 of the same conversation: an equi-join on
    (conv_id, turn), so a very long conversation does not become one window partition."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    u = c.filter(c.role == "user").select("conv_id", "turn", F.col("text").alias("input_text"))
    a = c.filter(c.role == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target_text")
    )
    return u.join(a, ["conv_id", "turn"], "inner")


def pairs_sql() -> str:
    return (
        "SELECT u.conv_id, u.turn, u.text AS input_text, a.text AS target_text "
        "FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 "
        "WHERE u.role = 'user' AND a.role = 'assistant'"
    )
