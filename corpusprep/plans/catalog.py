"""The query catalog: every operator as a Spark plan over the driver tables, plus its DuckDB SQL.

``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, duckdb_sql or None)``. Column names of
both sides are identical. Queries read whole tables; derived tables come from
:mod:`corpusprep.sources.derive`.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import SOURCE, TARGET
from ..operators import dictionary as DI
from ..sources import derive as D

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, sql)
        return fn

    return deco


# ---------------------------------------------------------------------------------------------
# cleaning chains
# ---------------------------------------------------------------------------------------------
@register("clean_source", SOURCE.sql_select(D.documents_sql(), "transliteration", "oare_id", "transliteration_clean"))
def clean_source(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.documents(spark, sf).select("oare_id", "transliteration")
    return SOURCE.apply(docs, "transliteration", "transliteration_clean").select("oare_id", "transliteration_clean")


@register("clean_target", TARGET.sql_select(D.documents_sql(), "translation", "oare_id", "translation_clean"))
def clean_target(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.documents(spark, sf).select("oare_id", "translation")
    return TARGET.apply(docs, "translation", "translation_clean").select("oare_id", "translation_clean")


# ---------------------------------------------------------------------------------------------
# dictionary and annotation
# ---------------------------------------------------------------------------------------------
def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return DI.build_dictionary(D.definitions(spark, sf))


DICTIONARY_SQL = DI.build_dictionary_sql(D.definitions_sql())


@register("dictionary_build", DICTIONARY_SQL)
def dictionary_build(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary(spark, sf)


_CLEAN_DOCS_SQL = SOURCE.sql_select(D.documents_sql(), "transliteration", "oare_id", "transliteration_clean")


@register("annotate", DI.annotate_sql(_CLEAN_DOCS_SQL, DICTIONARY_SQL, "transliteration_clean"))
def annotate(spark: SparkSession, sf: str) -> DataFrame:
    """Minimum slice: damaged documents → chain A → tokens → dictionary join → glossed text."""
    clean = clean_source(spark, sf)
    return DI.annotate(clean, dictionary(spark, sf), "transliteration_clean")


# ---------------------------------------------------------------------------------------------
# alignment and corpus assembly
# ---------------------------------------------------------------------------------------------
from ..functions.tokens import py_strip_sql  # noqa: E402
from ..operators import align as AL  # noqa: E402

_ALIGN_SQL = AL.align_sentences_sql(D.documents_sql(), D.sentences_sql())
_ALIGN_X_SQL = AL.align_sentences_sql(D.documents_sql(), D.sentences_sql(), extra=True)
_FALLBACK_SQL = f"""
SELECT *,
  (({py_strip_sql('transliteration')} = '') AND last_text IS NOT NULL AND last_text <> '') AS fallback_transliteration,
  (translation = '' AND last_translation IS NOT NULL AND last_translation <> '') AS fallback_translation
FROM ({_ALIGN_X_SQL})"""
_FALLBACK_OUT_SQL = f"""
SELECT oare_id, sentence_id AS sentence_uuid,
  CASE WHEN fallback_transliteration THEN last_text ELSE transliteration END AS transliteration,
  CASE WHEN fallback_translation THEN last_translation ELSE translation END AS translation,
  fallback_transliteration, fallback_translation, sord
FROM ({_FALLBACK_SQL})"""
_UNALIGNED_SQL = f"""
SELECT * FROM ({D.documents_sql()}) d
WHERE NOT EXISTS (SELECT 1 FROM ({_ALIGN_SQL}) a WHERE a.oare_id = d.oare_id)"""


@register("align_sentences", _ALIGN_SQL)
def align_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return AL.align_sentences(D.documents(spark, sf), D.sentences(spark, sf))


@register("align_fallback", f"SELECT * EXCLUDE (sord) FROM ({_FALLBACK_OUT_SQL})")
def align_fallback(spark: SparkSession, sf: str) -> DataFrame:
    a = AL.align_sentences(D.documents(spark, sf), D.sentences(spark, sf), keep_doc_fallback=True)
    fb = AL.with_fallback(a)
    return fb.select("oare_id", F.col("sentence_id").alias("sentence_uuid"), F.col("_t").alias("transliteration"),
                     F.col("_tr2").alias("translation"), "fallback_transliteration", "fallback_translation")


@register("unaligned_docs", _UNALIGNED_SQL)
def unaligned_docs(spark: SparkSession, sf: str) -> DataFrame:
    return AL.unaligned_documents(D.documents(spark, sf), D.sentences(spark, sf))


def _clean_train_sql() -> str:
    rows = f"""
SELECT oare_id, sentence_uuid, transliteration AS _src, translation AS _tgt FROM ({_FALLBACK_OUT_SQL})
UNION ALL
SELECT oare_id, NULL AS sentence_uuid, transliteration AS _src, translation AS _tgt FROM ({_UNALIGNED_SQL})"""
    a = SOURCE.sql_select(rows, "_src", "oare_id, sentence_uuid, _tgt", "transliteration")
    e = TARGET.sql_select(a, "_tgt", "oare_id, sentence_uuid, transliteration", "translation")
    ann = DI.annotate_sql(e, DICTIONARY_SQL, "transliteration")
    return f"SELECT oare_id, sentence_uuid, transliteration, transliteration_with_annotations, translation FROM ({ann})"


CLEAN_TRAIN_SQL = _clean_train_sql()


@register("clean_train", CLEAN_TRAIN_SQL)
def clean_train(spark: SparkSession, sf: str) -> DataFrame:
    return AL.build_clean_train(D.documents(spark, sf), D.sentences(spark, sf), dictionary(spark, sf))


def _clean_test_sql() -> str:
    a = SOURCE.sql_select(D.test_documents_sql(), "transliteration",
                          "id, text_id, line_start, line_end, transliteration", "transliteration_clean")
    return DI.annotate_sql(a, DICTIONARY_SQL, "transliteration_clean")


@register("clean_test", _clean_test_sql())
def clean_test(spark: SparkSession, sf: str) -> DataFrame:
    return AL.build_clean_test(D.test_documents(spark, sf), dictionary(spark, sf))


# ---------------------------------------------------------------------------------------------
# single rule families on whole documents (chain F parts, subscripts, gaps, token edges)
# ---------------------------------------------------------------------------------------------
from ..functions import numbers as NU  # noqa: E402
from ..functions.rules import Chain  # noqa: E402
from ..functions.tokens import edge_strip, edge_strip_sql, split_ws, split_ws_sql  # noqa: E402


def _rules(chain: Chain, ids: list[str]) -> Chain:
    return Chain("+".join(ids), tuple(r for r in chain.rules if r.id in ids or any(r.id.startswith(i + ".") for i in ids)))


_F = NU.number_chain()
_FAMILIES = {
    "canon_numbers": (_F, "translation"),
    "canon_sum": (_rules(_F, ["F03"]), "transliteration"),
    "canon_fraction": (_rules(_F, ["F06", "F07", "F08", "F09", "F11"]), "translation"),
    "canon_month": (_rules(_F, ["F05"]), "translation"),
    "subscript_digits": (_rules(SOURCE, ["A17"]), "transliteration"),
    "gap_collapse": (_rules(SOURCE, ["A23", "A24", "A25", "A26a", "A26b", "A28a", "A28b", "A30", "A31a", "A31b", "A31c", "A34", "A35"]), "transliteration"),
}


def _family(name: str, chain: Chain, col: str):
    def fn(spark: SparkSession, sf: str) -> DataFrame:
        docs = D.documents(spark, sf).select("oare_id", col)
        return chain.apply(docs, col, "out").select("oare_id", "out")

    register(name, chain.sql_select(D.documents_sql(), col, "oare_id", "out"))(fn)


for _name, (_chain, _col) in _FAMILIES.items():
    _family(_name, _chain, _col)


@register("edge_strip_tokens", f"""
SELECT oare_id, len(tok) AS tokens, len(list_filter(tok, lambda x_: {edge_strip_sql('x_')} = '')) AS emptied,
       array_to_string(list_transform(tok, lambda x_: {edge_strip_sql('x_')}), ' ') AS stripped
FROM (SELECT oare_id, {split_ws_sql('transliteration')} AS tok FROM ({D.documents_sql()}))""")
def edge_strip_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """X1 + X2: whitespace tokens and their edge-stripped forms, per document."""
    d = D.documents(spark, sf).select("oare_id", split_ws(F.col("transliteration")).alias("tok"))
    stripped = F.transform("tok", edge_strip)
    return d.select("oare_id", F.size("tok").cast("long").alias("tokens"),
                    F.size(F.filter(stripped, lambda x: x == "")).cast("long").alias("emptied"),
                    F.array_join(stripped, " ").alias("stripped"))


# ---------------------------------------------------------------------------------------------
# pairs, splits, byte tokens, stats
# ---------------------------------------------------------------------------------------------
from ..functions import bytetok as BT  # noqa: E402
from ..operators import split as SP  # noqa: E402
from ..operators import stats as ST  # noqa: E402

_PAIRS_SQL = SP.prepare_pairs_sql(D.pairs_sql(), "input_text", "target_text", ["conv_id", "turn"])
_PAIR_KEY_SQL = "(CAST(conv_id AS VARCHAR) || '|' || CAST(turn AS VARCHAR))"


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return SP.prepare_pairs(D.pairs(spark, sf), "input_text", "target_text", ["conv_id", "turn"])


def _pair_key() -> "F.Column":
    return F.concat(F.col("conv_id").cast("string"), F.lit("|"), F.col("turn").cast("string"))


@register("scan_filter_pairs", _PAIRS_SQL)
def scan_filter_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf)


_SPLIT_SQL = SP.split_exact_sql(_PAIRS_SQL, _PAIR_KEY_SQL)


@register("split_exact", _SPLIT_SQL)
def split_exact(spark: SparkSession, sf: str) -> DataFrame:
    return SP.split_exact(_pairs(spark, sf), _pair_key())


@register("split_group", SP.split_group_sql(_PAIRS_SQL, "CAST(conv_id AS VARCHAR)"))
def split_group(spark: SparkSession, sf: str) -> DataFrame:
    return SP.split_group(_pairs(spark, sf), F.col("conv_id").cast("string"))


@register("split_counts", SP.split_counts_sql(_SPLIT_SQL))
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return SP.split_counts(split_exact(spark, sf))


@register("byte_tokens", f"""
SELECT conv_id, turn, {BT.byte_ids_sql('input_text')} AS input_ids,
       {BT.attention_mask_sql(BT.byte_ids_sql('input_text'))} AS attention_mask,
       {BT.byte_ids_sql('target_text')} AS labels
FROM ({_PAIRS_SQL})""")
def byte_tokens(spark: SparkSession, sf: str) -> DataFrame:
    p = _pairs(spark, sf)
    ids = BT.byte_ids(F.col("input_text"))
    return p.select("conv_id", "turn", ids.alias("input_ids"), BT.attention_mask(ids).alias("attention_mask"),
                    BT.byte_ids(F.col("target_text")).alias("labels"))


_MARKED_SQL = "(input_text || '</s>' || target_text || '<extra_id_' || CAST(turn * 7 % 130 AS VARCHAR) || '><pad>' || CASE WHEN turn % 4 = 0 THEN '</s>' ELSE '' END)"


@register("byte_tokens_special", f"SELECT conv_id, turn, {BT.special_ids_sql('marked')} AS input_ids FROM (SELECT conv_id, turn, {_MARKED_SQL} AS marked FROM ({_PAIRS_SQL}))")
def byte_tokens_special(spark: SparkSession, sf: str) -> DataFrame:
    """B1: both sides of a pair in one sequence, with the strings of special tokens between and behind them."""
    tail = F.concat(F.lit("<extra_id_"), (F.col("turn") * 7 % 130).cast("string"), F.lit("><pad>"), F.when(F.col("turn") % 4 == 0, "</s>").otherwise(""))
    marked = F.concat("input_text", F.lit("</s>"), "target_text", tail)
    return _pairs(spark, sf).select("conv_id", "turn", marked.alias("marked")).select("conv_id", "turn", BT.byte_ids(F.col("marked")).alias("input_ids"))


@register("byte_length_stats", ST.length_stats_sql(_SPLIT_SQL, "split", ["input_text", "target_text"]))
def byte_length_stats(spark: SparkSession, sf: str) -> DataFrame:
    return ST.length_stats(split_exact(spark, sf), "split", ["input_text", "target_text"])


_PREVIEWS = {"transliteration": 200, "translation": 100}


@register("text_previews", ST.previews_sql(D.documents_sql(), ["oare_id"], _PREVIEWS))
def text_previews(spark: SparkSession, sf: str) -> DataFrame:
    """Heads of both texts of every document."""
    return ST.previews(D.documents(spark, sf), ["oare_id"], _PREVIEWS)


@register("byte_roundtrip", f"SELECT oare_id, coalesce(translation, '') AS decoded FROM ({D.documents_sql()})")
def byte_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """decode(encode(x)) is x for every whole document translation."""
    d = D.documents(spark, sf)
    return d.select("oare_id", BT.decode_ids(BT.byte_ids(F.col("translation"), max_len=None)).alias("decoded"))


# ---------------------------------------------------------------------------------------------
# BLEU
# ---------------------------------------------------------------------------------------------
from ..operators import bleu as BL  # noqa: E402

_BLEU_BASE_SQL = "SELECT doc_id, lower(text) AS hyp, text AS ref FROM documents"
_BLEU_STATS_SQL = BL.bleu_stats_sql(_BLEU_BASE_SQL, "doc_id", "hyp", "ref")


def _bleu_input(spark: SparkSession, sf: str) -> DataFrame:
    d = D.read_table(spark, sf, "documents")
    return d.select("doc_id", F.lower("text").alias("hyp"), F.col("text").alias("ref"))


@register("bleu_stats", _BLEU_STATS_SQL)
def bleu_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Corpus BLEU sufficient statistics: lower-cased documents against the originals."""
    return BL.bleu_stats(_bleu_input(spark, sf), "doc_id", "hyp", "ref")


@register("bleu_score", BL.bleu_from_stats_sql(_BLEU_STATS_SQL))
def bleu_score(spark: SparkSession, sf: str) -> DataFrame:
    return BL.bleu_from_stats(bleu_stats(spark, sf))


# ---------------------------------------------------------------------------------------------
# scoring through a pluggable predictor
# ---------------------------------------------------------------------------------------------
from ..functions.tokens import py_strip_sql as _pss  # noqa: E402
from ..operators import scoring as SC  # noqa: E402

_BLANK_TEXT_SQL = _pss("coalesce(text, '')")
_PRED_SQL = (f"SELECT conv_id, turn, CASE WHEN {_BLANK_TEXT_SQL} = '' THEN '' "
             f"ELSE array_to_string(list_reverse({split_ws_sql('text')}), ' ') END AS predicted_translation "
             f"FROM ({D.turns_sql()})")


@register("predict_blank_passthrough", _PRED_SQL)
def predict_blank_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    """Blank inputs skip the predictor and get ''; rows keep their columns."""
    return SC.predict(D.turns(spark, sf), SC.reverse_words, "text").drop("text")


@register("prediction_summary", f"SELECT count(*) AS rows, count(*) FILTER (WHERE length(predicted_translation) > 0) AS non_empty FROM ({_PRED_SQL})")
def prediction_summary(spark: SparkSession, sf: str) -> DataFrame:
    return SC.prediction_summary(predict_blank_passthrough(spark, sf))


@register("segment_table", f"""
SELECT p.conv_id, p.turn, p.input_text, p.target_text, coalesce(q.predicted_translation, '') AS predicted_translation
FROM ({_PAIRS_SQL}) p LEFT JOIN ({_PRED_SQL}) q ON p.conv_id = q.conv_id AND p.turn = q.turn""")
def segment_table(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with the prediction made for their input turn, joined by key."""
    return SC.segment_table(_pairs(spark, sf), predict_blank_passthrough(spark, sf), ["conv_id", "turn"])


# ---------------------------------------------------------------------------------------------
# lexicon, URLs, payloads
# ---------------------------------------------------------------------------------------------
from ..functions import urls as U  # noqa: E402

_QUEUE_SQL = DI.extract_lexicon_sql(D.lexicon_sql())
_PARAM, _NAME = D.URL_PARAM, "word"


@register("lexicon_first_seen", _QUEUE_SQL)
def lexicon_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return DI.extract_lexicon(D.lexicon(spark, sf))


def _url_cols_sql() -> str:
    lemma, raw, api = U.dictionary_urls_sql("url", _PARAM, _NAME)
    return f"{lemma} AS lemma, {raw} AS raw_url, {api} AS api_url"


@register("url_params", f"SELECT token, url, {_url_cols_sql()} FROM ({_QUEUE_SQL}) WHERE contains(url, '{_PARAM}')")
def url_params(spark: SparkSession, sf: str) -> DataFrame:
    q = DI.extract_lexicon(D.lexicon(spark, sf)).filter(F.col("url").contains(_PARAM))
    lemma, raw, api = U.dictionary_urls(F.col("url"), _PARAM, _NAME)
    return q.select("token", "url", lemma.alias("lemma"), raw.alias("raw_url"), api.alias("api_url"))


_MEANINGS_SQL = f"SELECT url, {U.meanings_text_sql('list_append(meanings, NULL)')} AS definition FROM ({D.payloads_sql()})"


@register("payload_meanings", _MEANINGS_SQL)
def payload_meanings(spark: SparkSession, sf: str) -> DataFrame:
    p = D.payloads(spark, sf)
    return p.select("url", U.meanings_text(F.col("payload")).alias("definition"))


@register("fetch_counters", f"""
SELECT count(*) AS queued, count(*) FILTER (WHERE contains(url, '{_PARAM}')) AS written,
       count(DISTINCT CASE WHEN contains(url, '{_PARAM}') THEN url END) AS fetched,
       count(*) FILTER (WHERE contains(url, '{_PARAM}')) - count(DISTINCT CASE WHEN contains(url, '{_PARAM}') THEN url END) AS reused
FROM ({_QUEUE_SQL})""")
def fetch_counters(spark: SparkSession, sf: str) -> DataFrame:
    return DI.fetch_counters(DI.extract_lexicon(D.lexicon(spark, sf)), _PARAM)


@register("definitions_assembled", f"""
SELECT q.token AS word, {U.dictionary_urls_sql('q.url', _PARAM, _NAME)[1]} AS raw_url,
       {U.dictionary_urls_sql('q.url', _PARAM, _NAME)[2]} AS api_url, coalesce(m.definition, '') AS definition
FROM ({_QUEUE_SQL}) q LEFT JOIN ({_MEANINGS_SQL}) m ON m.url = q.url
WHERE contains(q.url, '{_PARAM}')""")
def definitions_assembled(spark: SparkSession, sf: str) -> DataFrame:
    """Each queued token with its URL's definition (payload parsed once per URL)."""
    return DI.assemble_definitions(DI.extract_lexicon(D.lexicon(spark, sf)), D.payloads(spark, sf), _PARAM, _NAME)


# ---------------------------------------------------------------------------------------------
# QA report
# ---------------------------------------------------------------------------------------------
QA_N, QA_SEED = 5, 42


def _qa_sql() -> str:
    keys = (f"SELECT oare_id FROM (SELECT DISTINCT oare_id FROM ({D.documents_sql()})) "
            f"ORDER BY md5('{QA_SEED}|' || oare_id), oare_id LIMIT {QA_N}")
    docs = f"SELECT * FROM ({D.documents_sql()}) WHERE oare_id IN ({keys})"
    sents = f"SELECT * FROM ({D.sentences_sql()}) WHERE text_uuid IN ({keys})"
    al = AL.align_sentences_sql(docs, sents, with_order=True)
    rows = f"""
SELECT oare_id, sentence_no, transliteration AS raw_transliteration, translation AS raw_translation FROM ({al})
UNION ALL
SELECT oare_id, 1 AS sentence_no, transliteration AS raw_transliteration, translation AS raw_translation
FROM ({docs}) d WHERE NOT EXISTS (SELECT 1 FROM ({al}) a WHERE a.oare_id = d.oare_id)"""
    a = SOURCE.sql_select(rows, "raw_transliteration", "oare_id, sentence_no, raw_transliteration, raw_translation", "clean_transliteration")
    e = TARGET.sql_select(a, "raw_translation", "oare_id, sentence_no, raw_transliteration, raw_translation, clean_transliteration", "clean_translation")
    return DI.annotate_sql(e, DICTIONARY_SQL, "clean_transliteration", out="annotated_transliteration")


@register("qa_sample", _qa_sql())
def qa_sample(spark: SparkSession, sf: str) -> DataFrame:
    return AL.qa_report(D.documents(spark, sf), D.sentences(spark, sf), dictionary(spark, sf), QA_N, QA_SEED)


@register("lexicon_url_map", DI.build_dictionary_sql(
    f"SELECT form AS word, url AS definition, ordinal FROM ({D.lexicon_sql()}) "
    f"WHERE row_type = 'word' AND {_pss('form')} <> '' AND {_pss('url')} <> ''", out_value="url"))
def lexicon_url_map(spark: SparkSession, sf: str) -> DataFrame:
    """Token variants → URL, last row wins."""
    return DI.lexicon_url_map(D.lexicon(spark, sf))


# ---------------------------------------------------------------------------------------------
# file formats: tables written in the reference's formats and read back
# ---------------------------------------------------------------------------------------------
from ..session import scratch  # noqa: E402
from ..sources import readers as R  # noqa: E402
from ..sources import writers as W  # noqa: E402
from . import pipelines as PL  # noqa: E402

_CSV_COLUMNS = ["oare_id", "transliteration", "translation", "lang"]


def _documents_csv(spark: SparkSession, sf: str, quote_all: bool) -> str:
    path = scratch(spark, "documents-csv")
    W.write_csv(D.documents(spark, sf).select(*_CSV_COLUMNS), path, quote_all=quote_all)
    return path


_CSV_SQL = f"SELECT oare_id, nullif(transliteration, '') AS transliteration, nullif(translation, '') AS translation, lang FROM ({D.documents_sql()})"


@register("csv_roundtrip", _CSV_SQL)
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + S1: whole texts with quotes and line breaks through CSV; an empty cell is a missing one."""
    return R.read_csv_strings(spark, _documents_csv(spark, sf, False), missing=("",))


@register("csv_quoted_roundtrip", _CSV_SQL)
def csv_quoted_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K2 + S1: the same with every field quoted."""
    return R.read_csv_strings(spark, _documents_csv(spark, sf, True), missing=("",))


# every page as a CSV row with its number; beside some of them a row with another number of fields, and one whose number is none
_RAGGED, _NO_NUMBER = 5, 7


def _pages_csv(spark: SparkSession, sf: str) -> str:
    from ..session import spread

    path = scratch(spark, "pages-csv")
    p = spread(D.read_table(spark, sf, "pages").select("page_id", "url"))
    n = p.page_id.cast("string")
    lines = F.array(
        F.concat(n, F.lit(","), p.url),
        F.when(p.page_id % _RAGGED == 0, F.concat(n, F.lit(","), p.url, F.lit(",more"))),
        F.when(p.page_id % _NO_NUMBER == 0, F.concat(F.lit("no"), n, F.lit(","), p.url)))
    p.select(F.explode(F.array_compact(lines)).alias("value")).write.text(path)
    return path


def _pages_checked(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("page_id", LongType()), StructField("url", StringType())])
    return R.read_csv_checked(spark, _pages_csv(spark, sf), schema, names=["page_id", "url"])


@register("csv_good_rows", "SELECT page_id, url FROM pages")
def csv_good_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Typed rows of a CSV that also holds rows that do not parse."""
    return R.good(_pages_checked(spark, sf))


@register("csv_bad_rows", f"""
SELECT 'not 2 fields' AS reason, page_id || ',' || url || ',more' AS record FROM pages WHERE page_id % {_RAGGED} = 0
UNION ALL
SELECT 'page_id is not bigint' AS reason, '{{"page_id":"no' || page_id || '","url":"' || url || '"}}' AS record FROM pages WHERE page_id % {_NO_NUMBER} = 0""")
def csv_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of that CSV that do not parse, with the reason (their place depends on the files)."""
    return R.bad(_pages_checked(spark, sf)).select("reason", "record")


def _lexicon_csv(spark: SparkSession, sf: str) -> str:
    """Positional rows of eight fields; beside every row of type PN a short one."""
    path = scratch(spark, "lexicon-csv")
    lex = D.lexicon(spark, sf)
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    full = F.concat_ws(",", quoted(F.col("row_type")), quoted(F.col("form")), F.lit(""), F.lit(""), quoted(F.col("url")), F.lit(""), F.lit(""), F.lit("x"))
    short = F.when(F.col("row_type") == "PN", F.concat_ws(",", F.lit("word"), quoted(F.col("form"))))
    lex.select(F.explode(F.array_compact(F.array(full, short))).alias("value")).write.text(path)
    return path


@register("lexicon_csv", f"SELECT row_type, form, url FROM ({D.lexicon_sql()})")
def lexicon_csv(spark: SparkSession, sf: str) -> DataFrame:
    """S3: positional lexicon rows; short ones are skipped."""
    return R.read_lexicon_csv(spark, _lexicon_csv(spark, sf)).select("row_type", "form", "url")


@register("lexicon_bad_rows", f"""SELECT 'fewer than 5 fields' AS reason, 'word,"' || form || '"' AS record FROM ({D.lexicon_sql()}) WHERE row_type = 'PN'""")
def lexicon_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """S3: the short rows, as they stand in the file."""
    return R.bad(R.read_lexicon_checked(spark, _lexicon_csv(spark, sf))).select("reason", "record")


@register("definitions_csv", f"SELECT word, definition FROM ({D.definitions_sql()}) WHERE {_pss('word')} <> ''")
def definitions_csv(spark: SparkSession, sf: str) -> DataFrame:
    """K5 + S4: definitions written and read back by the header's names."""
    path = scratch(spark, "definitions-csv")
    d = D.definitions(spark, sf).select("word", F.lit("r").alias("raw_url"), F.lit("a").alias("api_url"), "definition")
    W.write_definitions(d, path)
    return R.read_definitions_csv(spark, path).select("word", F.coalesce("definition", F.lit("")).alias("definition"))


@register("missing_inputs", f"SELECT id, '' AS transliteration_clean, '' AS transliteration_with_annotations FROM ({D.test_documents_sql()})")
def missing_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """S6 + S7 + G9: a test table without a text column and a dictionary file that is not there."""
    none = DI.build_dictionary(R.read_definitions_csv(spark, scratch(spark, "no-such-file")))
    return AL.build_clean_test(D.test_documents(spark, sf).select("id"), none)


# ---------------------------------------------------------------------------------------------
# splits: named partitions, counters of the write, groups of the exact size, length sketches
# ---------------------------------------------------------------------------------------------
def _written_split(spark: SparkSession, sf: str) -> tuple[str, dict[str, int]]:
    path = scratch(spark, "pairs")
    return path, W.write_jsonl_by_split(split_exact(spark, sf).select("input_text", "target_text", "split"), path)


@register("named_splits", f"SELECT input_text, target_text, split FROM ({_SPLIT_SQL})")
def named_splits(spark: SparkSession, sf: str) -> DataFrame:
    """K3 + S5 + U2: JSONL written by split, read back as one table; a split is a partition."""
    return R.read_pair_splits(spark, _written_split(spark, sf)[0])


@register("split_meta", SP.split_counts_sql(_SPLIT_SQL))
def split_meta(spark: SparkSession, sf: str) -> DataFrame:
    """AG6 + K4: the metadata counted while the splits are written, read back from its file."""
    path, counts = _written_split(spark, sf)
    W.write_split_meta(spark, counts, path + "-meta")
    return spark.read.schema("train_rows long, validation_rows long").json(path + "-meta")


@register("split_group_exact", SP.split_group_exact_sql(_PAIRS_SQL, "CAST(conv_id AS VARCHAR)"))
def split_group_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations kept whole, as many as hold the law's number of rows."""
    return SP.split_group_exact(_pairs(spark, sf), F.col("conv_id").cast("string"))


_TEXTS, _RANKS = ["transliteration", "translation"], (0.05, 0.25, 0.5, 0.75, 0.95)


@register("length_sketches", f"""
SELECT c AS column, r AS rank, (SELECT count(*) FROM ({D.documents_sql()})) AS rows, true AS within_error
FROM (SELECT unnest({_TEXTS}) AS c), (SELECT unnest([{', '.join(map(str, _RANKS))}]::DOUBLE[]) AS r)""")
def length_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches of the lengths by language, written, read back and merged; their quantiles' exact ranks
    lie within the sketch's error of the ranks asked for."""
    path, docs = scratch(spark, "sketches"), D.documents(spark, sf)
    by_language = ST.length_sketches(docs, "lang", _TEXTS)
    by_language.write.parquet(path)
    merged = ST.merge_sketches(spark.read.schema(by_language.schema).parquet(path), ["column"])
    checked = ST.rank_errors(ST.sketch_quantiles(merged, _RANKS), docs, _TEXTS)
    return checked.select("column", "rank", "rows", (F.col("error") <= ST.KLL_ERROR).alias("within_error"))


# ---------------------------------------------------------------------------------------------
# scoring with a loaded model, resumed definitions, fractions of any denominator
# ---------------------------------------------------------------------------------------------
@register("predict_loaded", _PRED_SQL)
def predict_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The model is set up once a worker, texts go to it in batches of at most 4 kB."""
    return SC.predict(D.turns(spark, sf), None, "text", setup=lambda: SC.reverse_words, batch_bytes=4096).drop("text")


def _resumed(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """A run over the tokens whose dictionary pages are https, then one over all."""
    path, queue = scratch(spark, "definitions"), DI.extract_lexicon(D.lexicon(spark, sf))
    PL.add_definitions(queue.filter(F.col("url").startswith("https")), D.payloads(spark, sf), path, _PARAM, _NAME)
    return path, PL.add_definitions(queue, D.payloads(spark, sf), path, _PARAM, _NAME)


@register("definitions_resumed", f"SELECT word, raw_url, api_url, definition FROM ({QUERIES['definitions_assembled'][1]})")
def definitions_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """G6 + K5: all versions together are what one run over the whole queue would have written."""
    from ..sources import versions as V

    return V.read_versions(spark, _resumed(spark, sf)[0] + "/store", DI.STORE_SCHEMA).select("word", "raw_url", "api_url", "definition")


_LATER = f"contains(url, '{_PARAM}') AND NOT starts_with(url, 'https')"
_KNOWN = f"SELECT url FROM ({_QUEUE_SQL}) WHERE contains(url, '{_PARAM}') AND starts_with(url, 'https')"


@register("resume_counters", f"""
SELECT count(*) AS queued, count(*) FILTER (WHERE {_LATER}) AS written,
       count(DISTINCT CASE WHEN {_LATER} AND url NOT IN ({_KNOWN}) THEN url END) AS fetched,
       count(*) FILTER (WHERE {_LATER}) - count(DISTINCT CASE WHEN {_LATER} AND url NOT IN ({_KNOWN}) THEN url END) AS reused
FROM ({_QUEUE_SQL})""")
def resume_counters(spark: SparkSession, sf: str) -> DataFrame:
    """AG7: the counters of the second run."""
    return _resumed(spark, sf)[1]


@register("definitions_head", f"""
SELECT word, raw_url, api_url, definition FROM ({QUERIES['definitions_assembled'][1]})
WHERE word IN (SELECT token FROM ({_QUEUE_SQL}) ORDER BY ordinal LIMIT 20)""")
def definitions_head(spark: SparkSession, sf: str) -> DataFrame:
    """P13 + L4: the dry run's first 20 tokens in file order."""
    from ..sources import versions as V

    path = scratch(spark, "definitions-head")
    PL.add_definitions(DI.extract_lexicon(D.lexicon(spark, sf)), D.payloads(spark, sf), path, _PARAM, _NAME, limit=20)
    return V.read_versions(spark, path + "/store", DI.STORE_SCHEMA).select("word", "raw_url", "api_url", "definition")


_SHARE = 99_991  # prime, so that the shares have no common denominator


@register("nearest_fractions", f"""
SELECT doc_id, p.n, p.d FROM (
  SELECT doc_id, list_min(list_transform(range(1, 51), lambda d: struct_pack(
           off := round(abs(x * d - round(x * d)) / d, 12), d := CAST(d AS BIGINT), n := CAST(round(x * d) AS BIGINT)))) AS p
  FROM (SELECT doc_id, (n_chars % {_SHARE}) / {_SHARE}::DOUBLE AS x FROM documents))""")
def nearest_fractions(spark: SparkSession, sf: str) -> DataFrame:
    """F10 for any denominator: the nearest fraction with a denominator up to 50 of a share of every document."""
    x = (F.col("n_chars") % _SHARE).cast("double") / F.lit(float(_SHARE))
    near = NU.nearest_fraction(x, 50)
    return D.read_table(spark, sf, "documents").select("doc_id", near.alias("f")).select("doc_id", "f.n", "f.d")
