"""Batch scoring through a pluggable predictor.

The model is not part of the engine. It comes as a function ``predict(texts: list[str]) -> list[str]`` or, for a
model that has to be loaded, as ``setup() -> predict``, called once in every Python worker however many
tasks it runs. Texts go to the predictor in batches bounded by bytes and by rows; when a batch fails with
one of the ``retry`` errors (a device out of memory), it is halved until it passes, and the smaller size
is kept for the rest of the task. Blank inputs never reach the predictor; they get ''. The package is
sent to the workers first, so a session can be started from any folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

Predictor = Callable[[list], list]
BATCH_BYTES, BATCH_ROWS = 1 << 20, 256
# One entry a worker: the predictor that setup made.
_READY: dict[str, Predictor] = {}


def reverse_words(texts: list) -> list:
    """A deterministic stand-in model: the input's whitespace tokens in reverse order."""
    return [" ".join(reversed(t.split())) for t in texts]


def packed(texts: list[str], max_bytes: int, max_rows: int) -> Iterator[tuple[int, int]]:
    """(from, to) of neighbouring texts that hold at most max_bytes of UTF-8 and max_rows texts; a longer
    text goes alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t.encode("utf-8", "surrogatepass"))
        if i > start and (size + n > max_bytes or i - start >= max_rows):
            yield start, i
            start = i
            size = 0
        size += n
    if start < len(texts):
        yield start, len(texts)


class Runner:
    """One task's batches: the budget shrinks when the predictor fails for want of memory."""

    def __init__(self, predictor: Predictor, max_bytes: int, max_rows: int, retry: tuple[type[BaseException], ...]):
        self.predictor, self.max_bytes, self.max_rows, self.retry = predictor, max_bytes, max_rows, retry

    def batch(self, texts: list[str]) -> list[str]:
        try:
            out = list(self.predictor(texts))
        except self.retry:
            if len(texts) == 1:
                raise
            half = len(texts) // 2
            self.max_rows = max(1, min(self.max_rows, half))
            return self.batch(texts[:half]) + self.batch(texts[half:])
        if len(out) != len(texts):
            raise ValueError(f"the predictor returned {len(out)} texts for {len(texts)}")
        return out

    def all(self, texts: list[str]) -> list[str]:
        out: list[str] = []
        while len(out) < len(texts):  # the budget may have changed after a batch
            start, end = next(packed(texts[len(out):len(out) + self.max_rows], self.max_bytes, self.max_rows))
            out += self.batch(texts[len(out) + start:len(out) + end])
        return out


def predict(df: DataFrame, predictor: Predictor | None, text: str, out: str = "predicted_translation", setup: Callable[[], Predictor] | None = None,
            batch_bytes: int = BATCH_BYTES, batch_rows: int = BATCH_ROWS, retry: tuple[type[BaseException], ...] = (MemoryError,)) -> DataFrame:
    """df plus ``out`` = prediction for non-blank texts, '' for blank/NULL ones. All columns travel with
    their row, so no join back is needed. An existing ``out`` is replaced. Exactly one of ``predictor`` and
    ``setup`` is given; predictions do not depend on the budgets as long as the predictor treats every text alone."""
    if (predictor is None) == (setup is None) or batch_bytes < 1 or batch_rows < 1:
        raise ValueError("give either predictor or setup, and positive budgets")
    ship_package(df.sparkSession)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from corpusprep.operators import scoring

        if setup is None:
            model = predictor
        else:
            if name not in scoring._READY:
                scoring._READY.clear()
                scoring._READY[name] = setup()
            model = scoring._READY[name]
        runner = scoring.Runner(model, batch_bytes, batch_rows, retry)
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            full = [i for i, t in enumerate(texts) if t.strip()]
            res = [""] * len(texts)
            for i, r in zip(full, runner.all([texts[i] for i in full]), strict=True):
                res[i] = r
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(res, pa.string())], names=[*b.schema.names, out])

    rows = df.drop(out)
    at = rows.columns.index(text)
    fields = [T.StructField(f.name, f.dataType, True) for f in rows.schema.fields]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.StringType())]))


def prediction_summary(pred: DataFrame, out: str = "predicted_translation") -> DataFrame:
    """Row count and non-empty predictions."""
    return pred.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.length(F.col(out)) > 0).alias("non_empty"))


def segment_table(pairs: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    """Input, target and prediction side by side, joined by key (never by position)."""
    return pairs.join(pred, keys, "left").select(
        *keys, "input_text", "target_text", F.coalesce(F.col("predicted_translation"), F.lit("")).alias("predicted_translation")
    )
