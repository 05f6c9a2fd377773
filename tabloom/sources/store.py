"""Keyed Parquet tables that take incremental batches.

A table is a set of buckets by the low bits of a hash of its key. Every change
writes the buckets it touches to a folder of its own and then a manifest, which
names the folders that make up each bucket; the manifest takes its place by a
rename that fails if the place is taken. Readers go by the newest manifest, so
a change that dies before the rename has not happened, and is just repeated.

``path/data/<commit>/bucket=<name>``  rows
``path/keys/<commit>/bucket=<name>``  a filter over their keys, for inserts
``path/_manifest/<number>.json``      buckets, their row counts and commits

Only an insert asks the filters, so only inserts write them: what an upsert has
written is read by the next insert into that bucket.

A bucket that grows past ``rows_per_bucket`` is split by one more bit of the
hash when it is next rewritten; the number of buckets follows the table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabloom.operators.dedupe import keep_one
from tabloom.operators.merge import conform, upsert
from tabloom.session import materialize, read_if_exists

BUCKET = "bucket"
ROWS_PER_BUCKET = 4_000_000
_HASH = "__hash"
_MOST_COMMITS = 8  # of one bucket, before an insert puts them together
_UPSERTED = "-upsert"  # at the end of a commit's name: it has no key filter
_BITS_PER_KEY, _PROBES = 16, 4
_BLOCK_BITS = 32_768  # of one bitmap of the bitmap functions


class ConcurrentChange(RuntimeError):
    """Another writer has changed the table since this change began."""


@dataclass(frozen=True)
class Bucket:
    """The keys whose hash ends in the ``bits`` bits of ``value``."""

    bits: int
    value: int
    commits: dict[str, int] = field(default_factory=dict)  # rows by commit

    @property
    def name(self) -> str:
        return f"{self.bits}-{self.value}"

    @property
    def rows(self) -> int:
        return sum(self.commits.values())

    def split(self, limit: int, more: int) -> list[Bucket]:
        """Empty buckets in its place, so many that ``more`` rows fit in too."""
        extra, expected = 0, self.rows + more
        while expected > limit:
            extra, expected = extra + 1, expected / 2
        return [
            Bucket(self.bits + extra, self.value | i << self.bits) for i in range(1 << extra)
        ]


@dataclass
class Manifest:
    """The buckets of a table at one version; they cover all hashes once."""

    version: int = 0
    buckets: list[Bucket] = field(default_factory=lambda: [Bucket(0, 0)])

    def name_of(self, hashed: str = _HASH) -> Column:
        """The bucket's name for a key's hash."""
        by_bits: dict[int, list[int]] = {}
        for bucket in self.buckets:
            by_bits.setdefault(bucket.bits, []).append(bucket.value)

        def low(bits: int) -> Column:
            return F.col(hashed).bitwiseAND(F.lit((1 << bits) - 1))

        # The most usual length takes all that the lists of the others do not.
        most, *others = sorted(by_bits, key=lambda b: -len(by_bits[b]))
        name = F.concat(F.lit(f"{most}-"), low(most).cast("string"))
        for bits in others:
            own = F.concat(F.lit(f"{bits}-"), low(bits).cast("string"))
            name = F.when(low(bits).isin(by_bits[bits]), own).otherwise(name)
        return name

    def places(self) -> set[tuple[str, str]]:
        return {(c, b.name) for b in self.buckets for c in b.commits}


class _Files:
    """The table's folder, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.system = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def versions(self) -> list[int]:
        found = self.system.globStatus(self.path("_manifest/*.json")) or []
        return sorted(int(s.getPath().getName().partition(".")[0]) for s in found)

    def manifest(self, version: int) -> Manifest:
        name = f"{self.root}/_manifest/{version:010d}.json"
        text = self.spark.read.text(name, wholetext=True).head()["value"]
        return Manifest(
            version, [Bucket(b["bits"], b["value"], b["commits"]) for b in json.loads(text)]
        )

    def latest(self) -> Manifest | None:
        versions = self.versions()
        return self.manifest(versions[-1]) if versions else None

    def publish(self, manifest: Manifest) -> None:
        """Put a manifest in its place, if no other has taken it."""
        text = json.dumps([vars(b) for b in manifest.buckets])
        draft = self.path(f"_manifest/.{uuid.uuid4().hex}")
        stream = self.system.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        place = self.path(f"_manifest/{manifest.version:010d}.json")
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.system.makeQualified(place).toUri(), self.conf
        )
        kinds = self.jvm.org.apache.hadoop.fs.Options.Rename
        strict = self.spark.sparkContext._gateway.new_array(kinds, 0)
        try:
            context.rename(
                self.system.makeQualified(draft), self.system.makeQualified(place), strict
            )
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            self.system.delete(draft, False)
            raise ConcurrentChange(
                f"{self.root} has a version {manifest.version} already"
            ) from error

    def forget(self, version: int) -> None:
        """Delete a version that no reader can still begin with."""
        if version not in self.versions():
            return
        gone = self.manifest(version).places()
        for later in (version + 1, version + 2):
            gone -= self.manifest(later).places()
        for commit, bucket in gone:
            for kind in ("data", "keys"):
                self.system.delete(self.path(f"{kind}/{commit}/{BUCKET}={bucket}"), True)
        self.system.delete(self.path(f"_manifest/{version:010d}.json"), False)


@dataclass
class _Table:
    files: _Files
    schema: StructType
    key: list[str]
    limit: int

    @property
    def spark(self) -> SparkSession:
        return self.files.spark

    def hashed(self, df: DataFrame) -> DataFrame:
        # The hash depends on the type, so the key takes the table's type first.
        typed = df.withColumns(
            {k: F.col(k).cast(self.schema[k].dataType) for k in self.key}
        )
        return typed.withColumn(_HASH, F.xxhash64(*self.key))

    def start(self, rows: int) -> Manifest:
        """What a new table begins with: buckets for its first batch."""
        return Manifest(0, Bucket(0, 0).split(self.limit, rows))

    def read(self, buckets: Iterable[Bucket], columns: Sequence[str] | None = None):
        paths = [
            f"{self.files.root}/data/{commit}/{BUCKET}={b.name}"
            for b in buckets
            for commit in b.commits
        ]
        if not paths:
            rows = self.spark.createDataFrame([], self.schema)
        else:
            rows = self.spark.read.schema(self.schema).parquet(*paths)
        return rows.select(*(columns or self.schema.names))

    def write(
        self, rows: DataFrame, manifest: Manifest, filters: bool
    ) -> tuple[str, dict[str, int]]:
        """Store ``rows`` by bucket; the commit's name and its rows by bucket."""
        commit = uuid.uuid4().hex + ("" if filters else _UPSERTED)
        folder = f"{self.files.root}/data/{commit}"
        # One task per bucket would put a large bucket through one task; the batch
        # is spread by bucket and a row hash instead, and AQE sizes the tasks.
        (
            self.hashed(rows)
            .withColumn(BUCKET, manifest.name_of())
            .drop(_HASH)
            .hint("rebalance", BUCKET)
            .write.partitionBy(BUCKET)
            .parquet(folder)
        )
        written = self.spark.read.schema(
            StructType([*self.schema.fields]).add(BUCKET, "string")
        ).parquet(folder)
        counts = {r[BUCKET]: r["count"] for r in written.groupBy(BUCKET).count().collect()}
        if counts and filters:
            self._write_filter(written, commit, counts)
        return commit, counts

    # Key filters: per commit and bucket a Bloom filter, cut into bitmaps, so
    # that a key's probes all fall into one row.

    def _blocks_of(self, keys: DataFrame, blocks: DataFrame) -> DataFrame:
        """``blocks`` has the number of bitmaps by bucket (and commit)."""
        return keys.join(F.broadcast(blocks), BUCKET).withColumn(
            "block", F.pmod(F.xxhash64(F.lit(0), _HASH), "blocks")
        )

    def _probes(self) -> Column:
        second, third = (
            F.pmod(F.xxhash64(F.lit(i), _HASH), F.lit(_BLOCK_BITS)) for i in (1, 2)
        )
        return F.array(
            *[
                F.pmod(second + i * third.bitwiseOR(F.lit(1)), F.lit(_BLOCK_BITS))
                for i in range(_PROBES)
            ]
        )

    def _write_filter(self, rows: DataFrame, commit: str, counts: dict[str, int]) -> None:
        sizes = [(name, _blocks(n)) for name, n in counts.items()]
        blocks = self.spark.createDataFrame(sizes, f"{BUCKET} string, blocks long")
        keys = self.hashed(rows.select(*self.key, BUCKET)).select(BUCKET, _HASH)
        place = [BUCKET, "block"]
        # Hashes are brought together first: partial bitmaps of every task would be
        # as many as tasks times blocks. Each probe has a bitmap of its own, so that
        # a hash is sorted once and not once a probe.
        bitmaps = [F.bitmap_construct_agg(self._probes()[i]) for i in range(_PROBES)]
        (
            self._blocks_of(keys, blocks)
            .select(*place, _HASH)
            .repartition(*place)
            .groupBy(*place)
            .agg(F.array(*bitmaps).alias("bitmaps"))
            .select(*place, F.explode("bitmaps").alias("bitmap"))
            .groupBy(*place)
            .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
            .write.partitionBy(BUCKET)
            .parquet(f"{self.files.root}/keys/{commit}")
        )

    def may_hold(self, batch: DataFrame, buckets: list[Bucket]) -> DataFrame:
        """Keys of ``batch`` (with hash and bucket) that the filters do not rule out."""
        bare = [b.name for b in buckets if any(c.endswith(_UPSERTED) for c in b.commits)]
        unknown = batch.where(F.col(BUCKET).isin(bare)).select(*self.key, BUCKET)
        sizes = [
            (b.name, commit, _blocks(n))
            for b in buckets
            if b.name not in bare
            for commit, n in b.commits.items()
        ]
        if not sizes:
            return unknown
        blocks = self.spark.createDataFrame(
            sizes, f"{BUCKET} string, commit string, blocks long"
        )
        paths = [f"{self.files.root}/keys/{c}/{BUCKET}={n}" for n, c, _ in sizes]
        at = F.split("_metadata.file_path", "/")
        filters = (
            self.spark.read.schema("block long, bitmap binary")
            .parquet(*paths)
            .select(
                "block",
                "bitmap",
                F.element_at(at, -3).alias("commit"),
                F.substring_index(F.element_at(at, -2), "=", -1).alias(BUCKET),
            )
        )
        asked = self._blocks_of(batch.select(*self.key, _HASH, BUCKET), blocks).withColumn(
            "probes", self._probes()
        )
        held = asked.join(filters, ["commit", BUCKET, "block"]).where(
            F.forall("probes", lambda p: _bit("bitmap", p))
        )
        return held.select(*self.key, BUCKET).distinct().unionByName(unknown)

    def commit(self, before: Manifest, buckets: list[Bucket]) -> None:
        self.files.publish(Manifest(before.version + 1, buckets))
        # The version before stays for readers that have begun.
        self.files.forget(before.version - 1)


def _blocks(rows: int) -> int:
    return max(1, -(-rows * _BITS_PER_KEY // _BLOCK_BITS))


def _bit(bitmap: str, position: Column) -> Column:
    byte = F.substring(F.col(bitmap), (position / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.floor(value / F.pow(F.lit(2), position % 8)) % 2 == 1


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of the newest version, or an empty frame before the first batch."""
    files = _Files(spark, path)
    manifest = files.latest()
    return _Table(files, schema, [], 0).read(manifest.buckets if manifest else [])


def upsert_into(
    spark: SparkSession,
    path: str,
    schema: StructType,
    staged: DataFrame,
    key: Sequence[str],
    update_cols: Sequence[str],
    order_by: Sequence[str],
    *,
    keep: str = "first",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """Merge ``staged`` into the table; only touched buckets are rewritten, once."""
    table = _Table(_Files(spark, path), schema, list(key), rows_per_bucket)
    before = table.files.latest()
    batch = materialize(table.hashed(staged), "batch")
    now = before or table.start(batch.count())
    new = Counter(
        {r[0]: r[1] for r in batch.groupBy(now.name_of()).count().collect()}
    )  # a number per bucket
    if not new:
        return
    touched = [b for b in now.buckets if new[b.name]]
    untouched = [b for b in now.buckets if not new[b.name]]
    pieces = [p for b in touched for p in b.split(rows_per_bucket, new[b.name])]
    merged = upsert(
        table.read(touched), batch.drop(_HASH), key, update_cols, order_by, keep=keep
    )
    commit, counts = table.write(merged, Manifest(0, untouched + pieces), filters=False)
    written = [
        Bucket(p.bits, p.value, {commit: counts[p.name]} if p.name in counts else {})
        for p in pieces
    ]
    table.commit(now, untouched + written)


def insert_new(
    spark: SparkSession,
    path: str,
    schema: StructType,
    staged: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    unique: bool = False,
) -> None:
    """Add the staged rows whose key is new, the first of a key by ``order_by``.

    Stored rows are read only where the key filters say that a staged key may be
    among them, and rewritten only where a bucket is split or has been added to
    many times. ``unique``: ``staged`` is a stored frame with one row a key, which
    needs no copy of its own.
    """
    key = list(key)
    table = _Table(_Files(spark, path), schema, key, rows_per_bucket)
    before = table.files.latest()
    one = table.hashed(staged)
    if not unique:
        one = materialize(keep_one(one, key, order_by), "batch")
    now = before or table.start(one.count())
    batch = one.withColumn(BUCKET, now.name_of())
    named = {b.name: b for b in now.buckets}
    touched = [named[r[0]] for r in batch.select(BUCKET).distinct().collect()]
    if not touched:
        return
    if any(b.commits for b in touched):
        known = known_keys(table, batch, touched)
        fresh = materialize(batch.join(known, key, "left_anti"), "fresh")
    else:
        fresh = batch  # nothing is stored where these rows go
    counted = Counter({r[0]: r[1] for r in fresh.groupBy(BUCKET).count().collect()})
    if not counted:
        return
    grown = [named[name] for name in counted]
    rewritten = [
        b
        for b in grown
        if len(b.commits) >= _MOST_COMMITS or b.rows + counted[b.name] > rows_per_bucket
    ]
    pieces = [p for b in rewritten for p in b.split(rows_per_bucket, counted[b.name])]
    added = [b for b in grown if b not in rewritten]
    rest = [b for b in now.buckets if b not in grown]
    rows = conform(fresh, spark.createDataFrame([], schema))
    if rewritten:
        rows = rows.unionByName(table.read(rewritten))
    commit, counts = table.write(rows, Manifest(0, rest + added + pieces), filters=True)
    written = [
        Bucket(b.bits, b.value, {**b.commits, **_part(commit, counts, b.name)})
        for b in added + pieces
    ]
    table.commit(now, rest + written)


def _part(commit: str, counts: dict[str, int], name: str) -> dict[str, int]:
    return {commit: counts[name]} if name in counts else {}


def known_keys(table: _Table, batch: DataFrame, touched: list[Bucket]) -> DataFrame:
    """The keys of ``batch`` that the table holds, by its filters and then its rows."""
    possible = materialize(table.may_hold(batch, touched), "possible")
    asked = {r[0] for r in possible.select(BUCKET).distinct().collect()}
    stored = table.read([b for b in touched if b.name in asked], table.key)
    return possible.select(*table.key).join(stored, table.key, "left_semi")


def vacuum(spark: SparkSession, path: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete what changes that died have left; returns the commits' names.

    A commit that no manifest names may belong to a change that is still
    running, so only those are deleted that have not been touched for a while.
    """
    files = _Files(spark, path)
    named = {c for v in files.versions() for c, _ in files.manifest(v).places()}
    limit = (time.time() - 3600 * older_than_hours) * 1000
    gone = set()
    for kind in ("data", "keys"):
        for status in files.system.globStatus(files.path(f"{kind}/*")) or []:
            commit = status.getPath().getName()
            if commit not in named and status.getModificationTime() <= limit:
                files.system.delete(status.getPath(), True)
                gone.add(commit)
    return sorted(gone)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions below ``path``, ascending."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    names = [status.getPath().getParent().getName() for status in found or []]
    return sorted(int(name.partition("=")[2]) for name in names)


def read_version(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest complete version, or an empty frame before the first one."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={versions[-1]}")


def write_version(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Replace a small table: readers see the old version until the new one is whole.

    ``rows`` may be read from the table itself. The version before the new one
    stays for readers that have begun; older ones are deleted.
    """
    versions = _versions(spark, path)
    number = versions[-1] + 1 if versions else 1
    # Overwrite: a lost run may have left part of this version.
    rows.write.mode("overwrite").parquet(f"{path}/version={number}")
    for old in versions[:-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={old}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_parts(rows: DataFrame, path: str, part: str) -> None:
    """Store rows by the value of ``part``, replacing what it had before."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part)
        .parquet(path)
    )


def read_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that is only appended to, or an empty frame before the first rows."""
    stored = read_if_exists(spark, path)
    return spark.createDataFrame([], schema) if stored is None else stored.select(*schema.names)


def append_rows(
    spark: SparkSession, path: str, schema: StructType, staged: DataFrame
) -> None:
    """Append every row, missing columns filled with their defaults."""
    empty = spark.createDataFrame([], schema)
    conform(staged, empty).write.mode("append").parquet(path)
