"""Cleaning of documents as they arrive; the same projection as in batch."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from presswork.functions.text import clean_text, strip_dates


def clean_stream(spark: SparkSession, source: str, target: str, schema, state: str) -> StreamingQuery:
    """Clean every Parquet file of ``source`` once and append to ``target``.

    Row-wise work only, so there is no state besides the list of files done.
    """
    docs = spark.readStream.schema(schema).parquet(source)
    cleaned = docs.withColumn("content_cleaned", clean_text(strip_dates(F.col("content"))))
    writer = cleaned.writeStream.format("parquet").option("checkpointLocation", state)
    return writer.trigger(availableNow=True).start(target)
