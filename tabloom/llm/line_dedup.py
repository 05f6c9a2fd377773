"""Fuzzy line dedup: MinHash bands, exact Jaccard, distributed union-find."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import (
    Scratch,
    gram_hashes,
    id_key,
    id_value,
    in_chunk_pairs,
    mix,
    sorted_groups,
    whole_groups,
)
from tabloom.llm.components import connected_components
from tabloom.operators.skew import lookup_join

BANDS, ROWS = 16, 4  # a pair at 0.8 shares no band once in 4,500 times
SHINGLE = 8  # characters
CHUNK = 1024
_SOME = 256  # lines compared pair by pair, then all with all at once
_EACH = 3  # pairs for each line that are compared one by one
_DIRECT = 64  # lines above which a line of a larger group is looked up by its shingles
_COLUMNS = 1 << 13  # shingles of one step of the latter
_NEARLY = 0.999  # hashes may meet: a pair is dropped only well below the threshold
_FACTORS = np.random.default_rng(5).integers(
    0, 1 << 32, BANDS * ROWS, np.uint32
) | np.uint32(1)
_PIECE = 1 << 18  # characters hashed at a time
_KEY_BYTES = 5  # of a band's key; lines of other bands that meet are compared in vain
_BUCKET = 1 << 19  # keys that are sorted at a time
_BUCKETS_PER_TASK = 2
_WORDS = {4: "<u4", 8: "<u8"}  # that hold a shingle of so many Latin-1 characters


def normal(line: str) -> str:
    """A line as it is compared: lower case, white space runs as one space."""
    return " ".join(line.lower().split())


def digest(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode())


def band_keys(lines: list[str], shingle: int) -> np.ndarray:
    """A key per line and band: the hash of ``ROWS`` minima over its shingles.

    Each is the lowest ``_KEY_BYTES`` of a hash; the band's number is put above them.
    """
    out = np.empty((len(lines), BANDS), np.int64)
    begin = 0
    while begin < len(lines):
        end, size = begin, 0
        while end < len(lines) and (end == begin or size < _PIECE):
            size += len(lines[end])
            end += 1
        out[begin:end] = _band_keys(lines[begin:end], shingle)
        begin = end
    return out


def _band_keys(lines: list[str], shingle: int) -> np.ndarray:
    lengths = np.array([len(x) for x in lines])
    points = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
    grams = gram_hashes(points.astype(np.uint64), shingle)
    begins = np.cumsum(lengths) - lengths
    inside = np.ones(len(points), bool)  # false where a shingle would leave its line
    for back in range(1, shingle):
        inside[begins + lengths - back] = False
    grams = (grams[inside[: len(grams)]] >> np.uint64(32)).astype(np.uint32)
    counts = lengths - shingle + 1
    starts = np.cumsum(counts) - counts
    minima = np.empty((BANDS * ROWS, len(lines)), np.uint64)
    for k, factor in enumerate(_FACTORS):
        minima[k] = np.minimum.reduceat(grams * factor, starts)
    keys = np.empty((len(lines), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(lines), band + 1, np.uint64)
        for row in minima[band * ROWS : (band + 1) * ROWS]:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + row)
        keys[:, band] = key & np.uint64((1 << 8 * _KEY_BYTES) - 1) | np.uint64(
            band << 8 * _KEY_BYTES
        )
    return keys.view(np.int64)


def packed(keys: np.ndarray) -> list[bytes]:
    """Each line's keys without the bands' numbers."""
    parts = keys.astype("<i8").view(np.uint8).reshape(-1, BANDS, 8)[:, :, :_KEY_BYTES]
    data, size = parts.tobytes(), BANDS * _KEY_BYTES
    return [data[i : i + size] for i in range(0, len(data), size)]


def unpacked(bands: list[bytes]) -> np.ndarray:
    """The inverse of ``packed``."""
    parts = np.zeros((len(bands), BANDS, 8), np.uint8)
    data = np.frombuffer(b"".join(bands), np.uint8)
    parts[:, :, :_KEY_BYTES] = data.reshape(-1, BANDS, _KEY_BYTES)
    keys = parts.reshape(len(bands), -1).view("<i8").astype(np.int64, copy=False)
    return keys | np.arange(BANDS, dtype=np.int64) << 8 * _KEY_BYTES


def _line_rows(rows: DataFrame, shingle: int) -> DataFrame:
    """A row per line that is not blank: place, digest, copies and band keys.

    ``row`` is the text's hash: together with the id it names a row, also
    where ids are null or repeat. Of a line that stands in several places of a
    slice the first has the number of its ``copies`` there and its band keys, the
    others 0 and null. A line shorter than a shingle has null for its band keys: as
    its own only shingle it is near no other line, and its digest finds its copies.
    """
    schema = "key long, row long, line long, digest binary, copies long, bands binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                lines, numbers, ends = [], [], []
                for text in part.column("text").to_pylist():
                    # No line's lower case depends on the lines around it.
                    for i, raw in enumerate((text or "").lower().split("\n")):
                        if line := " ".join(raw.split()):
                            lines.append(line)
                            numbers.append(i)
                    ends.append(len(lines))
                keys, own = (
                    np.repeat(part.column(c).to_numpy(), np.diff(ends, prepend=0))
                    for c in ("key", "row")
                )
                digests = list(map(digest, lines))
                first: dict[bytes, int] = {}
                copies = np.ones(len(lines), np.int64)
                for i, name in enumerate(digests):
                    j = first.setdefault(name, i)
                    if j != i:
                        if (keys[i], own[i], numbers[i]) < (keys[j], own[j], numbers[j]):
                            first[name], i, j = i, j, i
                        copies[j], copies[i] = copies[i] + copies[j], 0
                bands_of: list[bytes | None] = [None] * len(lines)
                whole = [i for i in first.values() if len(lines[i]) >= shingle]
                found = packed(band_keys([lines[i] for i in whole], shingle))
                for i, own_keys in zip(whole, found, strict=True):
                    bands_of[i] = own_keys
                columns = [
                    pa.array(keys, pa.int64()),
                    pa.array(own, pa.int64()),
                    pa.array(numbers, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(copies),
                    pa.array(bands_of, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``line_id`` and ``words`` (the line as it is compared) of wanted lines."""
    by_document = wanted.groupBy("key", "row").agg(
        F.collect_list(F.struct("line", "line_id")).alias("lines")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = [], []
            for text, lines in zip(
                batch.column("text").to_pylist(),
                batch.column("lines").to_pylist(),
                strict=True,
            ):
                own = text.split("\n")
                ids += [x["line_id"] for x in lines]
                texts += [normal(own[x["line"]]) for x in lines]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string())],
                ["line_id", "words"],
            )

    # Rows that repeat an id and text have one entry there, and may be many.
    found = lookup_join(docs, by_document, ["key", "row"], "inner")
    return found.mapInArrow(run, "line_id long, words string")


class Groups:
    """Which positions are connected so far."""

    def __init__(self, size: int):
        self.above = list(range(size))
        self.count = size

    def find(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return i

    def link(self, i: int, j: int) -> bool:
        """True if that connects two groups."""
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.above[max(i, j)] = min(i, j)
        self.count -= 1
        return True


def similar_links(
    lines: list[str],
    shingle: int,
    threshold: float,
    may_meet: Callable[[int, np.ndarray], np.ndarray],
    first: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Links that connect what all pairs with Jaccard >= ``threshold`` connect.

    Shingles are counted by 64-bit hashes; a pair that passes is compared as
    texts. ``may_meet`` says which of some positions a line is to be compared
    with; a pair that is connected already is not. ``first`` may hold what it says
    of the first line and the others.
    """
    groups, links = Groups(len(lines)), []
    everything = np.arange(len(lines))
    sets: dict[int, set[str]] = {}
    numbers: dict[int, np.ndarray | None] = {}

    def shingles(i: int) -> set[str]:
        if i not in sets:
            x = lines[i]
            sets[i] = {x[k : k + shingle] for k in range(len(x) - shingle + 1)}
        return sets[i]

    def numbered(i: int) -> np.ndarray | None:
        if i not in numbers:
            numbers[i] = _shingle_numbers(lines[i], shingle)
        return numbers[i]

    def link(i: int, j: int) -> None:
        a, b = numbered(i), numbered(j)
        if a is None or b is None:
            a, b = shingles(i), shingles(j)
        if min(len(a), len(b)) >= threshold * max(len(a), len(b)):
            shared = len(a & b) if isinstance(a, set) else _in_both(a, b)
            if shared >= threshold * (len(a) + len(b) - shared) and groups.link(i, j):
                links.append((i, j))

    # Lines of a group are mostly near the first ones, or met in a band before.
    left = _EACH * len(lines)
    for j in range(len(lines) - 1):
        if groups.count == 1 or not left:
            break
        later = everything[j + 1 :]
        for i in (later[may_meet(j, later)] if j or first is None else first).tolist():
            if groups.count == 1 or not left:
                break
            if groups.find(i) != groups.find(j):
                left -= 1
                link(i, j)
    if groups.count == 1 or left:
        return links
    if len(lines) <= _SOME:
        codes, owners = _codes(lines, shingle)
        shared, sizes = _shared(owners, codes, len(lines))
        close = shared >= _NEARLY * threshold * (sizes[:, None] + sizes - shared)
        for i in everything[:-1].tolist():
            near = i + 1 + np.flatnonzero(close[i, i + 1 :])
            near = [j for j in near.tolist() if groups.find(i) != groups.find(j)]
            if near:
                for j in np.array(near)[may_meet(i, np.array(near))].tolist():
                    if groups.find(i) != groups.find(j):
                        link(i, j)
        return links
    similar = None
    # First the lines that nothing has reached yet, each with all its partners;
    # then, while there are several groups, the others. A line that was asked
    # has been compared with all that it may meet.
    asked = np.zeros(len(lines), bool)
    reached = np.zeros(len(lines), bool)
    for only_unreached in (True, False):
        for i in everything.tolist():
            if groups.count == 1:
                break
            if asked[i] or (only_unreached and reached[i]):
                continue
            asked[i] = True
            others = np.flatnonzero(~asked)
            others = others[may_meet(i, others)]
            own = groups.find(i)
            others = [j for j in others.tolist() if groups.find(j) != own]
            if len(others) > _DIRECT:
                similar = similar or _postings(lines, shingle, threshold)
                close = similar(i)
                others = [j for j in others if close[j]]
            for j in others:
                if groups.find(i) != groups.find(j):
                    link(i, j)
                reached[j] |= groups.find(i) == groups.find(j)
    return links


def _postings(
    lines: list[str], shingle: int, threshold: float
) -> Callable[[int], np.ndarray]:
    """Tells which lines are near a given one, as far as hashes tell."""
    codes, owners = _codes(lines, shingle)
    span = int(codes.max()) + 1
    # Each line has a shingle once from here on.
    pairs = np.sort(owners * span + codes)
    owners, codes = np.divmod(pairs[np.append(True, pairs[1:] != pairs[:-1])], span)
    ends = np.cumsum(np.bincount(owners, minlength=len(lines)))
    sizes = np.diff(ends, prepend=0)
    postings = owners[np.argsort(codes, kind="stable")]
    begins = np.concatenate([[0], np.cumsum(np.bincount(codes))])

    def similar(i: int) -> np.ndarray:
        own = codes[ends[i] - sizes[i] : ends[i]]
        met = np.concatenate([postings[begins[g] : begins[g + 1]] for g in own])
        shared = np.bincount(met, minlength=len(lines))
        return shared >= _NEARLY * threshold * (sizes[i] + sizes - shared)

    return similar


def _shingle_numbers(line: str, shingle: int) -> np.ndarray | None:
    """The distinct shingles of Latin-1 text as numbers, sorted; else None."""
    if shingle not in _WORDS:
        return None
    try:
        data = line.encode("latin-1")
    except UnicodeEncodeError:
        return None
    # A word at every character.
    words = np.ndarray(len(data) - shingle + 1, _WORDS[shingle], data, strides=(1,))
    words = np.sort(words)
    new = np.ones(len(words), bool)
    np.not_equal(words[1:], words[:-1], out=new[1:])
    return words[new]


def _in_both(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two arrays of distinct values share."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # merges the two runs
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _codes(lines: list[str], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for every shingle of every line, and its line."""
    lengths = np.array([len(x) for x in lines])
    points = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
    grams = gram_hashes(points.astype(np.uint64), shingle)
    counts = lengths - shingle + 1
    begins = np.cumsum(lengths) - lengths
    place = np.arange(counts.sum()) + np.repeat(
        begins - (np.cumsum(counts) - counts), counts
    )
    _, codes = np.unique(grams[place], return_inverse=True)
    return codes, np.repeat(np.arange(len(lines)), counts)


def _shared(owners: np.ndarray, codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that every two lines share and that each has, by 0-1 matrices."""
    often = np.bincount(codes)
    once = often[codes] == 1  # in one line only
    sizes = np.bincount(owners[once], minlength=size).astype(np.float32)
    owners, codes = owners[~once], codes[~once]
    place = np.cumsum(often > 1) - 1
    columns = place[codes]
    out = np.zeros((size, size), np.float32)  # counts below 2 ** 24 are exact
    for begin in range(0, int(place[-1]) + 1 if len(place) else 0, _COLUMNS):
        inside = (columns >= begin) & (columns < begin + _COLUMNS)
        cells = np.zeros((size, min(_COLUMNS, int(place[-1]) + 1 - begin)), np.float32)
        cells[owners[inside], columns[inside] - begin] = 1
        out += cells @ cells.T
        sizes += cells.sum(axis=1)
    return out, sizes


def _links(batches: Iterator[pa.RecordBatch], shingle: int, threshold: float):
    """Per band and block a forest of links.

    Two lines that share several bands are compared in the first of them only.
    """
    for table, begins in whole_groups(batches, ["band", "lo", "hi"]):
        los, his, parts, ats, names = (
            table.column(c).to_numpy() for c in ("lo", "hi", "part", "at", "line_id")
        )
        bands = unpacked(table.column("bands").to_pylist())
        lines = table.column("words").to_pylist()
        ends = np.append(begins[1:], len(lines))
        found: list[tuple[int, int]] = []
        some = np.flatnonzero(ends - begins > 1)
        head = np.repeat(begins, ends - begins)  # of a row's block
        met = ((bands == bands[head]) & (np.arange(BANDS) < ats[:, None])).any(axis=1)
        new = ~met & ((los == his) | (parts != parts[head]))
        new[begins] = False
        near_head = np.flatnonzero(new)
        near_begins = np.searchsorted(near_head, [begins, ends])
        near_head -= head[near_head]
        near_ends = near_begins[1].tolist()
        near_begins = near_begins[0].tolist()
        for k, begin, end in zip(
            some.tolist(), begins[some].tolist(), ends[some].tolist(), strict=True
        ):
            first = near_head[near_begins[k] : near_ends[k]]
            if end - begin == 2 and not len(first):
                continue
            two = los[begin] != his[begin]
            part, earlier = parts[begin:end], bands[begin:end, : ats[begin]]

            def may_meet(i: int, others: np.ndarray) -> np.ndarray:
                new = ~(earlier[others] == earlier[i]).any(axis=1)
                return new & (part[others] != part[i]) if two else new

            own = similar_links(lines[begin:end], shingle, threshold, may_meet, first)
            found += [(begin + i, begin + j) for i, j in own]
        links = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[links[:, 0]]), pa.array(names[links[:, 1]])], ["a", "b"]
        )


def _band_members(lines: DataFrame) -> DataFrame:
    """``band``, ``at`` (its number) and ``line_id`` of lines that share a band's key.

    Most keys are of one line only. So they are not exploded to rows: a slice's
    keys go to buckets as arrays, where those that stand once are left out.
    """
    buckets = max(1, -(-lines.count() * BANDS // _BUCKET))
    tasks = max(
        -(-buckets // _BUCKETS_PER_TASK),
        min(buckets, lines.sparkSession.sparkContext.defaultParallelism),
    )
    names = ["bucket", "first", "line_ids", "lows", "highs"]
    kind = np.uint16 if buckets <= 1 << 16 else np.int64  # the former is sorted by radix

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("line_id").to_numpy()
            keys = unpacked(batch.column("bands").to_pylist())
            for slice_of in np.unique(ids >> 32).tolist():
                own = np.flatnonzero(ids >> 32 == slice_of)
                flat = keys[own].ravel()
                places = np.repeat((ids[own] & 0xFFFFFFFF).astype("<u4"), BANDS)
                bucket = (flat % buckets).astype(kind)
                order = np.argsort(bucket, kind="stable")
                flat, places, bucket = flat[order], places[order], bucket[order]
                begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                found = bucket[begins]
                ends = np.append(begins[1:], len(flat)).tolist()
                spans = list(zip(begins.tolist(), ends, strict=True))
                lows, highs = flat.astype("<u4"), (flat >> 32).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.astype(np.int64)),
                        pa.array([slice_of << 32] * len(found), pa.int64()),
                        *(
                            pa.array([x[a:b].tobytes() for a, b in spans], pa.binary())
                            for x in (places, lows, highs)
                        ),
                    ],
                    names,
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bucket"]):
            places, lows, highs = (
                np.frombuffer(b"".join(group.column(name).to_pylist()), kind)
                for name, kind in (("line_ids", "<u4"), ("lows", "<u4"), ("highs", "<u2"))
            )
            sizes = [len(x) // 4 for x in group.column("line_ids").to_pylist()]
            ids = np.repeat(group.column("first").to_numpy(), sizes) + places
            keys = highs.astype(np.int64) << 32 | lows
            order = np.argsort(keys)
            keys = keys[order]
            equal = keys[1:] == keys[:-1]
            shared = np.append(equal, False) | np.append(False, equal)
            found = keys[shared]
            yield pa.RecordBatch.from_arrays(
                [found, (found >> 8 * _KEY_BYTES).astype(np.int32), ids[order[shared]]],
                ["band", "at", "line_id"],
            )

    return (
        lines.where("bands is not null")
        .select("line_id", "bands")
        .mapInArrow(
            spread, "bucket long, first long, line_ids binary, lows binary, highs binary"
        )
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(meet, "band long, at int, line_id long")
    )


def line_components(
    rows: DataFrame, shingle: int, threshold: float
) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: ``digest`` and place of every line that is not blank, and
    ``digest`` of each repeated line and the place that stays."""
    scratch = Scratch(rows.sparkSession)
    # Python reads the lines once; what is needed of each at the end is kept apart
    # from the band keys, which go when lines have met.
    read = scratch.store(_line_rows(rows, shingle), "read")
    places = scratch.store(read.select("digest", "key", "row", "line"), "places")
    lines = scratch.store(
        read.where("copies > 0")
        .repartition("digest")  # a slice's copies are one row already: no sum before it
        .groupBy("digest")
        .agg(
            F.min(F.struct("key", "row", "line")).alias("place"),
            F.any_value("bands").alias("bands"),
            F.sum("copies").alias("copies"),
        )
        .withColumn("line_id", F.monotonically_increasing_id()),
        "lines",
    )
    scratch.drop("read")
    met = scratch.store(_band_members(lines), "meeting")
    mixed = F.xxhash64("line_id")
    # Bands with the same members say the same: the first of them is kept, as a
    # pair is compared in the first band that it shares.
    meeting = (
        met.groupBy("band")
        .agg(
            F.count("*").alias("n"),
            F.bit_xor(mixed).alias("x"),
            F.sum(F.shiftright(mixed, 24)).alias("s"),
            F.min("at").alias("at"),
        )
        .groupBy("n", "x", "s")
        .agg(F.min_by("band", "at").alias("band"))
        .select("band")
    )
    members = scratch.store(met.join(meeting, "band", "left_semi"), "band-members")
    scratch.drop("meeting")
    some = members.select("line_id").distinct()
    wanted = scratch.store(
        lines.drop("copies").join(some, "line_id", "left_semi"), "wanted"
    )
    repeated = scratch.store(
        lines.where("copies > 1").select("line_id", "digest", "place"), "repeated"
    )
    scratch.drop("lines")
    texts = _texts_of(rows, wanted.select("line_id", "place.*"))
    texts = scratch.store(
        texts.dropDuplicates(["line_id"]).join(wanted.select("line_id", "bands"), "line_id"),
        "line-texts",
    )
    placed = members.join(texts, "line_id")
    edges = in_chunk_pairs(placed, "band", "line_id", CHUNK).mapInArrow(
        lambda batches: _links(batches, shingle, threshold), "a long, b long"
    )
    components = connected_components(edges)
    scratch.drop("band-members", "line-texts")
    linked = scratch.store(
        wanted.drop("bands").join(components.withColumnRenamed("node", "line_id"), "line_id"),
        "linked",
    )
    scratch.drop("wanted")
    heads = linked.groupBy("component").agg(F.min("place").alias("head"))
    together = lookup_join(linked, heads, ["component"], "inner").select(
        "digest", F.col("head").alias("place")
    )
    # A line that is linked to no other stays in the first place of its copies.
    alone = repeated.join(linked.select("line_id"), "line_id", "left_anti")
    kept = scratch.store(
        alone.select("digest", "place").unionByName(together), "kept-lines"
    )
    scratch.drop("repeated", "linked")
    return places, kept.select("digest", "place.*")


def removed_lines(
    docs: DataFrame,
    shingle: int = SHINGLE,
    threshold: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``key``, ``row`` (see ``_line_rows``) and ``lines``, the numbers of lines to remove."""
    rows = _rows(docs, id_column, text_column)
    places, kept = line_components(rows, shingle, threshold)
    stays = kept.withColumnsRenamed(
        {"key": "stays_key", "row": "stays_row", "line": "stays_line"}
    )
    found = lookup_join(places, stays, ["digest"], "inner")
    return (
        found.where("key <> stays_key or row <> stays_row or line <> stays_line")
        .groupBy("key", "row")
        .agg(F.collect_set("line").alias("lines"))
    )


def _rows(docs: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    text = F.col(text_column)
    return docs.select(
        id_key(id_column).alias("key"), F.xxhash64(text).alias("row"), text.alias("text"), *more
    )


def dedup_lines(
    docs: DataFrame,
    shingle: int = SHINGLE,
    threshold: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Keep one line of each group of near-equal lines over all documents.

    Lines end at ``\\n`` and are compared in lower case with white space runs
    as one space. Lines link when their sets of ``shingle``-character shingles
    have a Jaccard similarity of ``threshold`` or more; of a connected group
    the line with the smallest (id, line number) stays. Every line that is not
    blank takes part; one shorter than a shingle is its own only shingle, so
    only its copies link to it.

    Candidates share one of ``BANDS`` bands of ``ROWS`` MinHash values; each is
    verified on its text. Bands that many lines share are cut into chunk pairs.

    Returns all columns of ``docs`` in the struct ``document``, ``id``,
    ``n_lines`` (lines that are not blank), ``n_removed`` and ``kept_text`` (the
    other lines as they were). A null text has no lines and stays null. Null
    ids are larger than all others, and rows of one id come by a hash of their
    text. Rows that repeat an id and text are treated alike: both keep the line
    that stays. An empty table gives an empty table.
    """
    removed = removed_lines(docs, shingle, threshold, id_column, text_column)
    document = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    keyed = _rows(docs, id_column, text_column, document).drop("text")

    @F.pandas_udf("n_lines long, n_removed long, kept_text string")
    def cut(texts, removed):
        import pandas as pd

        out = []
        for text, some in zip(texts, removed, strict=True):
            if text is None:
                out.append((0, 0, None))
                continue
            lines = text.split("\n")
            full = sum(1 for x in lines if x.strip())
            if some is None:
                out.append((full, 0, text))
                continue
            gone = set(some)
            kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
            out.append((full, len(gone), kept))
        return pd.DataFrame(out, columns=["n_lines", "n_removed", "kept_text"])

    text = F.col(f"document.`{text_column}`")
    return (
        lookup_join(keyed, removed, ["key", "row"])
        .select("document", "key", cut(text, "lines").alias("cut"))
        .select("document", id_value("key").alias("id"), "cut.*")
    )


def deduplicated(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with the lines that stay as text; the other columns unchanged."""
    text = parameters.get("text_column", "text")
    done = dedup_lines(docs, **parameters)
    return done.select(
        *[
            F.col("kept_text" if c == text else f"document.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
