"""The row-local operators on a stream of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textveil.operators.detect import Detector
from textveil.operators.rewrite import deidentify


def stream_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents as they arrive in a folder of parquet files."""
    return spark.readStream.schema(schema).parquet(path)


def deidentify_stream(docs: DataFrame, key: str, text: str, detectors: tuple[Detector, ...], policy: dict, out: str, checkpoint: str):
    """Start rewriting a stream; detection, resolution and stitching happen within
    a row, so no state is kept and the result is that of a batch."""
    return deidentify(docs, key, text, detectors, policy).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
