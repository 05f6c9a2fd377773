"""Declared schemas and column presets of the film catalogue."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


_TEXT, _INT, _BOOL, _TIME = (
    T.StringType(),
    T.IntegerType(),
    T.BooleanType(),
    T.TimestampType(),
)

MOVIES = _schema(
    movie_id=_TEXT,
    primary_title=_TEXT,
    original_title=_TEXT,
    start_year=_INT,
    runtime_min=_INT,
    num_votes=_INT,
    label=_BOOL,
    subset=_TEXT,
    title_changed=_BOOL,
    title_length=_INT,
    audit_time=_TIME,
)
# Where a film was staged last: its rows' order in the files.
PLACE = _schema(staged_file=_TEXT, staged_block=T.LongType(), staged_row=T.LongType())
STORED_MOVIES = T.StructType([*MOVIES.fields, *PLACE.fields])
DIRECTING = _schema(director_id=_TEXT, movie_id=_TEXT, audit_time=_TIME)
WRITING = _schema(writer_id=_TEXT, movie_id=_TEXT, audit_time=_TIME)
PROCESSED_FILES = _schema(file_name=_TEXT, audit_time=_TIME)

# Fixed values from here on: the names are the data's own.
# Raw files: the header of the index column is empty; every value is read as
# text and typed by the cleaning step.
RAW_UNLABELLED = [
    "tconst",
    "primaryTitle",
    "originalTitle",
    "startYear",
    "endYear",
    "runtimeMinutes",
    "numVotes",
]
RAW_TRAIN = [*RAW_UNLABELLED, "label"]

# An upsert overwrites these and keeps title_changed, title_length, audit_time.
MOVIE_UPDATE_COLS = [
    "primary_title",
    "original_title",
    "start_year",
    "runtime_min",
    "num_votes",
    "label",
    "subset",
]
FEATURES = [
    "runtime_min",
    "num_votes",
    "director_avg_score",
    "director_count",
    "writer_avg_score",
    "writer_count",
]
# Equal content in these columns makes two film rows duplicates.
MOVIE_CONTENT_COLS = [*MOVIE_UPDATE_COLS, "title_changed", "title_length"]
MOVIE_DUPLICATE_COLS = [
    "primary_title",
    "original_title",
    "start_year",
    "runtime_min",
    "num_votes",
]
