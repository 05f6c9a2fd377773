"""Incremental file ingestion with the file source and its checkpoint.

Each run takes the files that arrived since the last one and stops
(``availableNow``). The checkpoint is the ledger of processed files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tabloom.sources.store import ROWS_PER_BUCKET, upsert_into


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, fmt: str = "json", **options
) -> DataFrame:
    """A stream over the files of a folder, present and future."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)


def ingest(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append everything new to a Parquet sink, each file exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", sink)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def for_each_batch(
    stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]
) -> None:
    """Run ``apply`` on each batch of new files.

    A batch may be delivered again after a failure, so ``apply`` must be
    repeatable; the table store's upsert and insert are.
    """
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_stream(
    stream: DataFrame,
    checkpoint: str,
    path: str,
    schema: StructType,
    key: Sequence[str],
    update_cols: Sequence[str],
    order_by: Sequence[str],
    keep: str = "first",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """Merge each batch of new files into a stored table."""

    def apply(batch: DataFrame, _batch_id: int) -> None:
        upsert_into(
            batch.sparkSession,
            path,
            schema,
            batch,
            key,
            update_cols,
            order_by,
            keep=keep,
            rows_per_bucket=rows_per_bucket,
        )

    for_each_batch(stream, checkpoint, apply)
