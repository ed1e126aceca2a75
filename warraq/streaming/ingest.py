"""Incremental ingest: new files of page records become paragraphs once each (SRC12), with the sink's own record of what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from warraq.sources.pages import PAGE, paragraphs


def page_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Paragraphs of the page records in all files of the folder, those that arrive later included."""
    pages = spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files_per_batch).json(folder)
    return paragraphs(pages)


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str) -> None:
    """Takes in what is there now and stops; the checkpoint remembers it, so a rerun takes only what is new. A lost executor repeats its task, not the batch's rows."""
    query = page_stream(spark, folder).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).partitionBy("source").trigger(availableNow=True).start()
    query.awaitTermination()
