"""The cleaning chains and gloss annotation on Structured Streaming.

The reference is batch-only; its row rules are stateless, so they run unchanged on a stream.
Annotation needs a per-row re-assembly (an aggregate), so it runs per micro-batch through
``foreachBatch``, where each batch is an ordinary DataFrame and the dictionary a broadcast side.
Exactly-once output comes from the sink's batch id (each batch overwrites its own directory) and
the checkpoint location of the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.cleaning import SOURCE, TARGET
from ..operators import dictionary as DI


def clean_stream(stream: DataFrame, source_col: str | None = "transliteration",
                 target_col: str | None = "translation") -> DataFrame:
    """Stateless: adds ``<col>_clean`` columns to a streaming (or static) DataFrame."""
    out = stream
    if source_col:
        out = SOURCE.apply(out, source_col, f"{source_col}_clean")
    if target_col:
        out = TARGET.apply(out, target_col, f"{target_col}_clean")
    return out


def start_cleaning(spark: SparkSession, input_dir: str, schema: StructType, dictionary: DataFrame,
                   output_dir: str, checkpoint_dir: str, fmt: str = "parquet",
                   available_now: bool = True) -> StreamingQuery:
    """File stream in ``input_dir`` → chains → glosses per micro-batch → Parquet in ``output_dir``."""
    stream = spark.readStream.schema(schema).format(fmt).load(input_dir)
    cleaned = clean_stream(stream)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        annotated = DI.annotate(batch, dictionary, "transliteration_clean")
        annotated.write.mode("overwrite").parquet(f"{output_dir}/batch={batch_id}")

    w = cleaned.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
