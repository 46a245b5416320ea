"""Readers for the reference's file formats (S1-S7): CSV with all-string columns, positional
lexicon CSV, dictionary CSV, JSONL pair splits, and the optional-column guard.

Rows that do not parse are not lost: the ``*_checked`` readers keep every row of the input and add a column
``problem`` (NULL for good rows) with the file, the place in it, the reason and the record as it stands.
:func:`good` and :func:`bad` take the two channels apart; both read the input once each, by columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.tokens import py_strip


def _strings(cols: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# The cells that the public dataframe reader takes as missing by default.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
           "NULL", "NaN", "None", "n/a", "nan", "null")


def file_order() -> Column:
    """Position of a row in its input: file, split of the file, row within the split. Rows of several
    files sort as the files' names do, however Spark packs them into tasks."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def read_csv_strings(spark: SparkSession, path: str, missing: tuple[str, ...] = MISSING, multi_line: bool = True,
                     ordinal: str | None = None) -> DataFrame:
    """Header row, quoted multi-line fields, every column a string (no inference).

    Columns bind by the header's names; files whose headers differ are an error. Cells in
    ``missing`` become NULL, quoted or not. ``multi_line=False`` lets Spark split large files, for
    inputs without line breaks inside quotes; with it, one file is one task. ``ordinal`` adds file_order().
    """
    r = spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
    df = r.option("enforceSchema", False).csv(path)
    names = df.columns
    cells = [F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) if missing else F.col(f"`{c}`") for c in names]
    return df.select(*cells, *([file_order().alias(ordinal)] if ordinal else []))


PROBLEM = "problem"
_RAW, _AT = "_record_as_read", "_place_as_read"


def _misfit(names: list[str]) -> Column:
    """Whether a row has another number of fields. Spark refuses queries of the raw record alone, so a field is
    named beside it, in a condition that always holds."""
    return F.col(_RAW).isNotNull() & (F.coalesce(F.length(F.col(f"`{names[-1]}`")), F.lit(0)) >= 0)


def _place(reason: Column, record: Column) -> Column:
    """The problem of a row: where it stands (file, split of the file, row within the split) and why."""
    at = F.col(_AT)
    return F.when(reason.isNotNull(), F.struct(
        at["file"].alias("file"), at["block"].alias("block"), at["row"].bitwiseAND(F.lit((1 << 33) - 1)).alias("row"), reason.alias("reason"), record.alias("record")))


def _numbered(raw: DataFrame) -> DataFrame:
    """raw with the place of every row (a projection of its own: a number is given to each row, good or bad)."""
    return raw.withColumn(_AT, file_order())


def good(checked: DataFrame) -> DataFrame:
    """The rows that parse, without the problem column."""
    return checked.filter(F.col(PROBLEM).isNull()).drop(PROBLEM)


def bad(checked: DataFrame) -> DataFrame:
    """(file, block, row, reason, record) of the rows that do not."""
    return checked.filter(F.col(PROBLEM).isNotNull()).select(f"{PROBLEM}.*")


def header_names(spark: SparkSession, path: str) -> list[str]:
    """The names in the first row of the input's files."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path).columns


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | None = None, missing: tuple[str, ...] = MISSING, multi_line: bool = True,
                     ordinal: str | None = None, names: list[str] | None = None) -> DataFrame:
    """S1 / S2 with a ``problem`` channel: rows with more or fewer fields than the header, and, given a
    ``schema``, cells that are not of their column's type (the cell is NULL then). Columns bind by the
    header's names, or by ``names`` in files without a header; a column of the schema without one is NULL."""
    header = names is None
    names = names or header_names(spark, path)
    raw = (spark.read.option("header", header).option("enforceSchema", not header).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
           .option("columnPruning", False)  # fields are counted whichever columns are used
           .schema(StructType([*_strings(names).fields, StructField(_RAW, StringType(), True)])).csv(path))
    text = {c: F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")) if missing else F.col(f"`{c}`") for c in names}
    reason = F.when(_misfit(names), F.lit(f"not {len(names)} fields"))
    cells = [text[c].alias(c) for c in names]
    if schema is not None:
        cells = []
        for f in schema.fields:
            value = text.get(f.name, F.lit(None).cast("string"))
            kind = f.dataType.simpleString()
            typed = value if kind == "string" else F.trim(value).try_cast(f.dataType)
            reason = F.coalesce(reason, F.when(value.isNotNull() & typed.isNull(), F.lit(f"{f.name} is not {kind}")))
            cells.append(typed.alias(f.name))
    record = F.coalesce(F.col(_RAW), F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])))
    return _numbered(raw).select(*cells, _place(reason, record).alias(PROBLEM), *([F.col(_AT).alias(ordinal)] if ordinal else []))


def read_csv_typed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The QA report's typed read, with an explicit schema instead of inference. Cells of another type are
    NULL; :func:`read_csv_checked` tells which."""
    return read_csv_checked(spark, path, schema).drop(PROBLEM)


def read_lexicon_checked(spark: SparkSession, path: str, min_fields: int = 5, width: int = 8, multi_line: bool = True) -> DataFrame:
    """S3: positional rows without usable headers: (row_type, form, url, ordinal, problem), fields 0, 1 and 4
    plus the row's file position. Rows with fewer than ``min_fields`` fields (Spark pads them with NULL) are
    a problem; blank lines are no rows."""
    schema = _strings([*[f"_c{i}" for i in range(width)], _RAW])
    raw = (spark.read.option("header", False).option("mode", "PERMISSIVE").option("escape", '"').option("columnNameOfCorruptRecord", _RAW)
           .option("emptyValue", "").option("multiLine", multi_line).schema(schema).csv(path))
    full = F.col(f"_c{min_fields - 1}").isNotNull()
    return _numbered(raw).select(F.col("_c0").alias("row_type"), F.col("_c1").alias("form"), F.col("_c4").alias("url"), F.col(_AT).alias("ordinal"),
                      _place(F.when(~full, F.lit(f"fewer than {min_fields} fields")), F.col(_RAW)).alias(PROBLEM))


def read_lexicon_csv(spark: SparkSession, path: str, min_fields: int = 5, width: int = 8, multi_line: bool = True) -> DataFrame:
    """S3: the good rows of :func:`read_lexicon_checked` (the reference skips short rows)."""
    return good(read_lexicon_checked(spark, path, min_fields, width, multi_line))


def read_definitions_csv(spark: SparkSession, path: str) -> DataFrame:
    """S4 + S7: (word, definition, ordinal) by the header's names; rows without a word are skipped;
    a missing file is an empty dictionary, a missing column is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "word string, definition string, ordinal struct<file:string,block:bigint,row:bigint>")
    d = ensure_columns(read_csv_strings(spark, path, missing=(), ordinal="ordinal"), ["word", "definition"])
    return d.select("word", "definition", "ordinal").filter(F.col("word").isNotNull() & (py_strip(F.col("word")) != ""))


PAIR_SCHEMA = _strings(["input_text", "target_text"])


def read_pair_splits(spark: SparkSession, paths: str | dict[str, str]) -> DataFrame:
    """JSONL of (input_text, target_text) with a ``split`` column. A folder holds one subfolder
    ``split=<name>`` a split (as written by write_jsonl_by_split): partition discovery names the rows, and a
    filter on ``split`` reads only its files. A dict of name → path takes any files (UNION ALL)."""
    if isinstance(paths, str):
        schema = StructType([*PAIR_SCHEMA.fields, StructField("split", StringType(), True)])
        return spark.read.schema(schema).json(paths)
    out = None
    for name, path in paths.items():
        df = spark.read.schema(PAIR_SCHEMA).json(path).withColumn("split", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


def ensure_columns(df: DataFrame, columns: list[str], default: str = "") -> DataFrame:
    """Add any missing column as a constant (the reference's ``'col' in df.columns`` guard)."""
    for c in columns:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(default))
    return df
