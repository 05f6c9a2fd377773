"""The ledger of ingested files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import schemas
from tabloom.functions.values import is_staged_file
from tabloom.sources.store import append_rows, read_rows


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Staged CSV and JSON files the ledger does not hold yet."""
    return listing.where(is_staged_file(F.col("file_name"))).join(
        ledger.select("file_name"), "file_name", "left_anti"
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path, schemas.PROCESSED_FILES)


def commit_files(spark: SparkSession, path: str, loaded: DataFrame) -> None:
    """Record the ``file_name`` of loaded files; call after their data is stored."""
    append_rows(spark, path, schemas.PROCESSED_FILES, loaded.select("file_name"))
