"""Append-only streams: the batch operators on streaming frames, written by a triggered run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sourcetrail.operators import extract, quality
from sourcetrail.operators.observed import stream_expect
from sourcetrail.sources import feeds


def append_table(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def measurements_from_files(
    spark: SparkSession, landing: str, root: str, glob: str = "*.pdf", pages: Column | None = None
) -> None:
    """documents -> pages -> measurements, each a table under ``root`` that only ever grows.

    Documents and measurements that break a warning stay; a ``StreamCounts`` listener has their numbers."""
    from pyspark.sql import functions as F

    documents = feeds.read_documents(spark, landing, glob, stream=True)
    documents = stream_expect(documents, "documents", quality.document_rules())
    append_table(documents, f"{root}/documents", f"{root}/_checkpoints/documents").awaitTermination()

    stored = feeds.read_table(spark, f"{root}/documents", documents.schema, stream=True)
    page_list = extract.text_pages(F.col("content")) if pages is None else pages
    error = F.when(page_list.isNull(), F.lit("content is not readable text"))
    read = quality.expect(extract.document_pages(stored, page_list, error), quality.page_rules(), "drop")
    kept = read.drop("source_path", "size_bytes", "uploaded_at")
    append_table(kept, f"{root}/pages", f"{root}/_checkpoints/pages").awaitTermination()

    page_stream = feeds.read_table(spark, f"{root}/pages", kept.schema, stream=True)
    found = quality.expect(extract.extract_measurements(page_stream), quality.measurement_rules(), "drop")
    found = stream_expect(found, "measurements", quality.measurement_warnings())
    append_table(found, f"{root}/measurements", f"{root}/_checkpoints/measurements").awaitTermination()
