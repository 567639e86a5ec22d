"""The row-wise part of the URL and PII stage over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gleaner.functions.unicode import unicode_cleanup
from gleaner.operators.urlpii import redact_pii


def clean_stream(docs: DataFrame, text: str = "text") -> DataFrame:
    """Character clean-up and redaction; no state, so no watermark is needed."""
    return redact_pii(docs.withColumn(text, unicode_cleanup(F.col(text))), text)


def redact_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: StructType, files_per_trigger: int = 1000
) -> StreamingQuery:
    """Redact the JSONL files of ``source`` not seen before and append them to ``target``.

    Runs once over what is there; the checkpoint folder remembers finished
    files, so a rerun after a failure takes up the rest.
    """
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(source)
    writer = clean_stream(docs).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.option("path", target).outputMode("append").trigger(availableNow=True).start()
