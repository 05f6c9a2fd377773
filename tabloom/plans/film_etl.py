"""Staged files to the four stored tables, incrementally.

Films go first (the relations refer to them), the ledger last: a run that dies
in between is repeated without harm. Nothing is lost: pairs whose film has not
arrived wait in a table of their own and are tried again by every run, and film
rows without an id or a year are stored by the file they came from.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom import schemas
from tabloom.functions.values import file_route
from tabloom.operators.cleaning import clean_bridge, clean_movies, tag_subsets
from tabloom.operators.skew import lookup_join
from tabloom.session import materialize, read_if_exists
from tabloom.sources import files, ledger, store

RELATIONS = {
    "directing": ("director", "director_id", schemas.DIRECTING),
    "writing": ("writer", "writer_id", schemas.WRITING),
}


@dataclass
class LoadResult:
    """What one run loaded and ignored, its rejected films, all waiting pairs.

    ``loaded`` and ``ignored`` have a ``file_name`` a row.
    """

    loaded: DataFrame
    ignored: DataFrame
    rejected_movies: DataFrame | None = None
    orphans: dict[str, DataFrame] = field(default_factory=dict)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of movies, directing, writing, processed_files."""
    schema = {
        "movies": schemas.MOVIES,
        "directing": schemas.DIRECTING,
        "writing": schemas.WRITING,
        "processed_files": schemas.PROCESSED_FILES,
    }[name]
    read = store.read_rows if name == "processed_files" else store.read_table
    return read(spark, f"{root}/{name}", schema)


def placed_movies(spark: SparkSession, root: str) -> DataFrame:
    """The films with the place of their staged row: ``scoring.INPUT_ORDER``."""
    return store.read_table(spark, f"{root}/movies", schemas.STORED_MOVIES)


def waiting(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Pairs of directing or writing whose film has not arrived yet."""
    pairs = _pair_schema(RELATIONS[name][1])
    return store.read_version(spark, f"{root}/waiting_{name}", pairs)


def rejected(spark: SparkSession, root: str) -> DataFrame | None:
    """Film rows without an id or a year, with the file they came from."""
    return read_if_exists(spark, f"{root}/rejected_movies")


def _pair_schema(person: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (person, "movie_id")])


def run(
    spark: SparkSession,
    staging: str,
    root: str,
    *,
    refresh_derived: bool = False,
    loose_routes: bool = False,
    json_layout: str = "records",
    rows_per_bucket: int = store.ROWS_PER_BUCKET,
) -> LoadResult:
    """Load the files of ``staging`` the ledger does not know yet.

    Any mix of new files will do; a file that matches no route is not recorded.
    An upsert keeps title_changed and title_length of a known film as they
    were, unless ``refresh_derived``. Of several staged rows of one film the
    first one counts, by file path and then as they stand in the file.
    """
    known = F.coalesce(F.col("route").isin("train", "val", "test", *RELATIONS), F.lit(False))
    new = materialize(
        ledger.new_files(
            files.list_inputs(spark, staging),
            ledger.read_ledger(spark, f"{root}/processed_files"),
        ).withColumn("route", file_route(F.col("file_name"), loose_routes)),
        "listing",
    )
    names = new.select("file_name")
    result = LoadResult(names.where(known), names.where(~known))

    paths = files.paths_by(new.where(known), "route")
    parts = {
        subset: files.read_csv(
            spark,
            paths[subset],
            schemas.RAW_TRAIN if subset == "train" else schemas.RAW_UNLABELLED,
            place="place",
        )
        for subset in ("train", "val", "test")
        if subset in paths
    }
    if parts:
        staged = tag_subsets(parts)
        if "label" not in staged.columns:
            staged = staged.withColumn("label", F.lit(None).cast("string"))
        # The text is parsed once; medians, rejects and the load read what is stored.
        movies, broken = clean_movies(materialize(staged, "staged"))
        at = zip(schemas.PLACE.names, ("file", "block", "row"), strict=True)
        movies = movies.withColumns({c: F.col(f"place.{f}") for c, f in at})
        store.replace_parts(
            broken.withColumn("file", F.col("place.file")).drop("place"),
            f"{root}/rejected_movies",
            "file",
        )
        result.rejected_movies = broken.drop("place")
        derived = ["title_changed", "title_length"] if refresh_derived else []
        store.upsert_into(
            spark,
            f"{root}/movies",
            schemas.STORED_MOVIES,
            movies,
            ["movie_id"],
            [*schemas.MOVIE_UPDATE_COLS, *schemas.PLACE.names, *derived],
            ["place"],
            rows_per_bucket=rows_per_bucket,
        )
    for name, (raw_person, person, schema) in RELATIONS.items():
        before = waiting(spark, root, name)
        if name in paths:
            raw = files.read_json(spark, paths[name], ["movie", raw_person], json_layout)
            renames = {raw_person: person, "movie": "movie_id"}
            new = clean_bridge(raw, renames, distinct=False)
            pairs = new.unionByName(before).distinct()
        elif parts and not before.isEmpty():
            pairs = before
        else:
            continue
        # One join tells the accepted pairs from those that wait, and both are
        # read from what it stores.
        movies = table(spark, root, "movies").select("movie_id", F.lit(True).alias("known"))
        told = materialize(lookup_join(pairs, movies, ["movie_id"]), "pairs")
        store.insert_new(
            spark,
            f"{root}/{name}",
            schema,
            told.where("known").drop("known"),
            [person, "movie_id"],
            [person],
            rows_per_bucket=rows_per_bucket,
            unique=True,
        )
        store.write_version(
            spark, f"{root}/waiting_{name}", told.where("known IS NULL").drop("known")
        )
        result.orphans[name] = waiting(spark, root, name)
    if paths:
        ledger.commit_files(spark, f"{root}/processed_files", result.loaded)
    return result

