"""Substring dedup: recurring passages, sharded automata, every occurrence removed."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import (
    Scratch,
    WordHashes,
    binary,
    gram_hashes,
    id_key,
    id_value,
    release,
    sliding_min,
    sorted_groups,
)
from tabloom.operators.skew import lookup_join

GRAM = 5  # words of an anchor
SHARD = 4000  # stretches, and patterns, of one automaton task
_BROADCAST_BUCKETS = 100_000
_SENT = 200_000  # digests a task remembers
_BLOCK_BYTES = 8 << 20  # text of one block of documents
_PART_ANCHORS = 2_000_000  # anchors of all blocks that meet in one task


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Anchor, first and last window of each run of windows with one anchor.

    A window's anchor is the smallest hash among its runs of ``GRAM`` words: a
    function of the window's words alone, so equal windows, wherever they
    stand, have equal anchors.
    """
    gram = min(GRAM, window)
    grams = gram_hashes(hashes, gram)
    wide = window - gram + 1
    if len(grams) < wide:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    least = sliding_min(grams, wide)
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    ends = np.append(starts[1:], len(least)) - 1
    return least[starts].view(np.int64), starts, ends


def _rows(docs: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    """Id, text and the text's hash: the two name a row, also where ids repeat."""
    text = F.col(text_column)
    return docs.select(
        id_key(id_column).alias("key"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
        *more,
    )


_BLOCK = (
    "block long, n long, keys binary, text_hashes binary, counts binary, runs binary,"
    " lengths binary, anchors binary, several binary"
)


def _blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Anchors of some documents in packed form.

    ``runs`` has the number of each run's anchor in ``anchors`` (ascending, each
    once), ``lengths`` its windows; ``counts`` the runs of each document.
    ``several`` marks anchors that more than one of the documents has.
    """
    names = [c.split()[0] for c in _BLOCK.split(",")]
    hashes = WordHashes()
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in _slices(batch):
            found, lengths = [], []
            for text in binary(part.column("text")):
                own, first, last = anchors(hashes.of(text.split()), window)
                found.append(own)
                lengths.append((last - first + 1).astype(np.int32))
            counts = np.array([len(x) for x in found], np.int32)
            every = np.concatenate(found).view(np.uint64)
            different, runs = np.unique(every, return_inverse=True)
            owners = np.repeat(np.arange(len(found)), counts)
            order = np.lexsort((owners, runs))
            # An anchor has several documents if two neighbours differ in theirs.
            other = (np.diff(runs[order]) == 0) & (np.diff(owners[order]) != 0)
            several = np.zeros(len(different), np.uint8)
            several[runs[order][1:][other]] = 1
            cells = [
                part.column("key").to_numpy(),
                part.column("text_hash").to_numpy(),
                counts,
                runs.astype(np.int32),
                np.concatenate(lengths),
                different,
                several,
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.array([len(different)], pa.int64()),
                    *(pa.array([c.tobytes()], pa.binary()) for c in cells),
                ],
                names,
            )
            block += 1


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded amount of text, or one long text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    ends, begin = np.cumsum(sizes), 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + _BLOCK_BYTES)))
        yield batch.slice(begin, end - begin)
        begin = end


_SLICE = "part int, block long, anchors binary, several binary"


def _by_part(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Each block's anchors, cut at the top bits."""
    for batch in batches:
        for i in range(batch.num_rows):  # a batch may hold many blocks
            row = batch.slice(i, 1).to_pylist()[0]
            found = np.frombuffer(row["anchors"], np.uint64)
            several = np.frombuffer(row["several"], np.uint8)
            parts = (found >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int32)
            starts = np.flatnonzero(np.diff(parts, prepend=-1))
            ends = np.append(starts[1:], len(parts))[: len(starts)]  # none where no text has words
            spans = list(zip(starts, ends, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parts[starts]),
                    pa.array([row["block"]] * len(spans), pa.int64()),
                    pa.array([found[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([several[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                ["part", "block", "anchors", "several"],
            )


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tells each block which of its anchors another document has."""
    for group in sorted_groups(batches, ["part"]):
        parts = [
            np.frombuffer(x, np.uint64) for x in group.column("anchors").to_pylist()
        ]
        several = np.frombuffer(b"".join(group.column("several").to_pylist()), np.uint8)
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")
        same = every[order][1:] == every[order][:-1]
        again = several.astype(bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        cuts = np.cumsum([len(x) for x in parts])[:-1]
        told = [np.packbits(x).tobytes() for x in np.split(again, cuts)]
        yield pa.RecordBatch.from_arrays(
            [
                group.column("part").combine_chunks(),
                group.column("block").combine_chunks(),
                pa.array([len(x) for x in parts], pa.int64()),
                pa.array(told, pa.binary()),
            ],
            ["part", "block", "n", "told"],
        )


_WANTED = "key long, text_hash long, anchors binary, begins binary, ends binary"


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its runs of windows with a recurring anchor."""
    for group in sorted_groups(batches, ["block"]):
        block, *told = group.to_pylist()
        again = np.concatenate(
            [
                np.unpackbits(np.frombuffer(r["told"], np.uint8), count=r["n"])
                for r in told
            ]
            or [np.empty(0, np.uint8)]
        ).astype(bool)
        found = np.frombuffer(block["anchors"], np.int64)
        runs = np.frombuffer(block["runs"], np.int32)
        lengths = np.frombuffer(block["lengths"], np.int32)
        counts = np.frombuffer(block["counts"], np.int32)
        keys, texts = (
            np.frombuffer(block[c], np.int64) for c in ("keys", "text_hashes")
        )
        ends = np.cumsum(lengths, dtype=np.int64)
        starts = np.cumsum(counts) - counts
        out = []
        for i, (a, n) in enumerate(zip(starts.tolist(), counts.tolist(), strict=True)):
            own = a + np.flatnonzero(again[runs[a : a + n]])
            if len(own):
                base = ends[a - 1] if a else 0
                out.append(
                    (
                        int(keys[i]), int(texts[i]), found[runs[own]].tobytes(),
                        (ends[own] - lengths[own] - base).tobytes(),
                        (ends[own] - base).tobytes(),
                    )
                )
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = [pa.int64()] * 2 + [pa.binary()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["key", "text_hash", "anchors", "begins", "ends"],
        )


def recurring_runs(rows: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """Stored table: every row's runs of windows whose anchor another row has too."""
    blocks = scratch.store(
        rows.mapInArrow(lambda b: _blocks(b, window), _BLOCK), "anchor-blocks"
    )
    every = blocks.agg(F.sum("n")).first()[0] or 0
    cores = rows.sparkSession.sparkContext.defaultParallelism
    bits = (max(cores, -(-every // _PART_ANCHORS)) - 1).bit_length()
    told = (
        blocks.select("block", "anchors", "several")
        .mapInArrow(lambda b: _by_part(b, bits), _SLICE)
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(_recurring, "part int, block long, n long, told binary")
    )
    both = blocks.drop("n", "several").unionByName(told, allowMissingColumns=True)
    wanted = (
        both.repartition("block")
        .sortWithinPartitions("block", "part")  # the block itself comes first
        .mapInArrow(_wanted, _WANTED)
    )
    found = scratch.store(wanted.dropDuplicates(["key", "text_hash"]), "wanted-runs")
    scratch.drop("anchor-blocks")
    return found


def _stretches(rows: DataFrame, window: int) -> DataFrame:
    """Text around each of a document's recurring anchors, with its place.

    A text that the task has just passed on is null: its digest stands for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            keys, hashes = (batch.column(c).to_pylist() for c in ("key", "text_hash"))
            found, begins, ends = (
                [np.frombuffer(x, np.int64).tolist() for x in batch.column(c).to_pylist()]
                for c in ("anchors", "begins", "ends")
            )
            out = []
            for i, text in enumerate(binary(batch.column("text"))):
                words = text.split()
                for anchor, begin, end in zip(found[i], begins[i], ends[i], strict=True):
                    run = b" ".join(words[begin : end - 1 + window])
                    name = xxhash.xxh3_128_digest(run)
                    shown = None if name in sent else run
                    sent.add(name)
                    out.append((anchor, keys[i], hashes[i], begin, name, shown))
            if len(sent) > _SENT:
                sent.clear()
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[i], pa.int64()) for i in range(4)]
                + [
                    pa.array(columns[4], pa.binary()),
                    pa.array(columns[5], pa.binary()).cast(pa.string()),
                ],
                ["anchor", "key", "text_hash", "begin", "digest", "words"],
            )

    return rows.mapInArrow(
        run,
        "anchor long, key long, text_hash long, begin long, digest binary, "
        "words string",
    )


def _different(stretches: DataFrame) -> DataFrame:
    """One row per stretch text, with the smallest and largest document."""
    return stretches.groupBy("digest").agg(
        F.min("anchor").alias("anchor"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
        F.first("words", ignorenulls=True).alias("words"),
    )


def _alone(different: DataFrame) -> DataFrame:
    """Adds ``alone``: no other stretch text has the anchor."""
    counts = different.groupBy("anchor").agg((F.count("*") == 1).alias("alone"))
    return different.join(counts, "anchor")


def _windows(rows: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, words in enumerate(batch.column("words").to_pylist()):
                split = words.split(" ")
                for k in range(len(split) - window + 1):
                    found.append(" ".join(split[k : k + window]))
                    at.append(i)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string())]
                + [batch.column(c).take(rows) for c in ("anchor", "low", "high")],
                ["passage", "anchor", "low", "high"],
            )

    return rows.mapInArrow(run, "passage string, anchor long, low long, high long")


def recurring_passages(different: DataFrame, window: int) -> DataFrame:
    """Word runs that stand in two documents or more, with the smallest id.

    Taken from stretches that share an anchor; they are cut into windows, which
    are confirmed by their texts.
    """
    return (
        _windows(different, window)
        .groupBy("passage")
        .agg(
            F.min("anchor").alias("anchor"),
            F.min("low").alias("owner"),
            F.max("high").alias("high"),
        )
        .where("owner < high")
        .drop("high")
    )


def locate(
    passages: list[str], owners: list[int], texts: list[str]
) -> list[list[tuple[int, int, int]]]:
    """Word spans of each text that are passages, with the passages' owners.

    The automaton reads words: a word that occurs in a passage is one
    character, any other is a character that no passage has. Spans of one
    owner that touch are one.
    """
    codes: dict[str, str] = {}
    shift = 0x10000  # beyond the surrogates
    found = ahocorasick.Automaton()
    for passage, owner in zip(passages, owners, strict=True):
        words = passage.split(" ")
        for word in words:
            if word not in codes:
                codes[word] = chr(shift + len(codes))
        found.add_word("".join(map(codes.__getitem__, words)), (owner, len(words)))
    found.make_automaton()
    out: list[list[tuple[int, int, int]]] = []
    for text in texts:
        coded = "".join([codes.get(w, "\0") for w in text.split(" ")])
        spans: list[tuple[int, int, int]] = []
        for end, (owner, size) in found.iter(coded):
            begin = end + 1 - size
            if spans and spans[-1][2] == owner and begin <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end + 1, owner)
            else:
                spans.append((begin, end + 1, owner))
        out.append(spans)
    return out


def _shards(rows: DataFrame, other: DataFrame, buckets: int, mine: str) -> DataFrame:
    """Rows with their bucket and slice, once for every slice of the other side."""
    bucket = F.pmod(F.col("anchor"), F.lit(buckets)).alias("bucket")

    def slices(side: DataFrame, name: str) -> DataFrame:
        return (
            side.groupBy(bucket)
            .count()
            .select("bucket", F.ceil(F.col("count") / SHARD).cast("int").alias(name))
        )

    both = slices(rows, "own").join(slices(other, "others"), "bucket")
    if buckets <= _BROADCAST_BUCKETS:  # a row of 16 bytes each; beyond, a join
        both = F.broadcast(both)
    theirs = "stream" if mine == "part" else "part"
    return (
        rows.withColumn("bucket", bucket)
        .join(both, "bucket")
        .withColumn(mine, F.pmod(F.xxhash64(*rows.columns), F.col("own")).cast("int"))
        .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
        .drop("own", "others")
    )


def _located(different: DataFrame, passages: DataFrame) -> DataFrame:
    """Spans of every stretch text, with the smallest document that has each.

    Passages and stretches with one anchor share a bucket; a bucket with many
    of either is cut, so that a task compiles and streams bounded shares.
    """
    buckets = max(1, -(-different.count() // SHARD))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        spans = locate(
            right.column("passage").to_pylist(),
            right.column("owner").to_pylist(),
            left.column("words").to_pylist(),
        )
        at = pa.array([i for i, s in enumerate(spans) for _ in s], pa.int64())
        flat = [x for s in spans for x in s]
        return pa.table(
            {
                "digest": left.column("digest").take(at),
                "from": pa.array([b for b, _, _ in flat], pa.int64()),
                "to": pa.array([e for _, e, _ in flat], pa.int64()),
                "owner": pa.array([o for _, _, o in flat], pa.int64()),
            }
        )

    shard = ["bucket", "part", "stream"]
    streamed = _shards(
        different.select("digest", "anchor", "words"), passages, buckets, "stream"
    )
    compiled = _shards(passages, different, buckets, "part")
    return (
        streamed.groupBy(*shard)
        .cogroup(compiled.groupBy(*shard))
        .applyInArrow(run, "digest binary, from long, to long, owner long")
    )


def removed_spans(
    docs: DataFrame,
    window: int = 13,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Stored table: ``key``, ``text_hash`` and ``spans`` of words to remove."""
    scratch = Scratch(docs.sparkSession, "zstd")
    rows = _rows(docs, id_column, text_column)
    wanted = recurring_runs(rows, window, scratch)
    found = lookup_join(rows, wanted, ["key", "text_hash"], "inner")
    stretches = scratch.store(_stretches(found, window), "stretches")
    del found, wanted
    scratch.drop("wanted-runs")
    release(docs.sparkSession)
    merged = scratch.store(_different(stretches), "merged")
    places = scratch.store(
        stretches.select("digest", "key", "text_hash", "begin"), "places"
    )
    scratch.drop("stretches")
    # A text whose anchor has no other text can only recur as a whole.
    marked = _alone(merged)
    whole = marked.where("alone and low < high").select(
        "digest",
        F.lit(0).cast("long").alias("from"),
        F.size(F.split("words", " ")).cast("long").alias("to"),
        F.col("low").alias("owner"),
    )
    whole = scratch.store(whole, "whole")
    different = scratch.store(marked.where("not alone"), "different")
    scratch.drop("merged")
    passages = scratch.store(recurring_passages(different, window), "passages")
    located = scratch.store(_located(different, passages), "located")
    scratch.drop("different", "passages")
    # Every place of a stretch takes over what was found in its text.
    spans = scratch.store(
        places.join(located.unionByName(whole), "digest")
        .where("owner < key")
        .groupBy("key", "text_hash")
        .agg(
            F.collect_set(
                F.struct(
                    (F.col("begin") + F.col("from")).alias("begin"),
                    (F.col("begin") + F.col("to")).alias("end"),
                )
            ).alias("spans")
        ),
        "spans",
    )
    scratch.drop("places", "located", "whole")
    return spans


def remove_repeats(
    docs: DataFrame,
    window: int = 13,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Remove words of passages that an earlier document has too.

    Words stand between ASCII white space. A word goes if it is covered by
    ``window`` consecutive words that also start somewhere in a document with
    a smaller id, judged on the input. Returns all columns of ``docs`` in the
    struct ``document``, and ``n_words``, ``n_removed`` and ``kept_text`` (kept
    words joined by a space).

    A null or empty text has no words. Null ids are larger than all others,
    and none is smaller than another. Rows that repeat an id never remove from
    each other; each row is judged by its own text. An empty table gives an
    empty table.
    """
    spans = removed_spans(docs, window, id_column, text_column)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
        id_key(id_column).alias("key"),
        F.xxhash64(text_column).alias("text_hash"),
    )
    joined = lookup_join(keyed, spans, ["key", "text_hash"])

    @F.pandas_udf("n_words long, n_removed long, kept_text string")
    def cut(texts, spans):
        import pandas as pd

        out = []
        for text, some in zip(texts, spans, strict=True):
            words = (text or "").encode().split()
            keep = np.ones(len(words), bool)
            for s in [] if some is None else some:
                keep[s["begin"] : s["end"]] = False
            kept = [w for w, k in zip(words, keep, strict=True) if k]
            out.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text"])

    text = F.col(f"document.`{text_column}`")
    done = joined.select("document", "key", cut(text, "spans").alias("cut"))
    return done.select("document", id_value("key").alias("id"), "cut.*")


def deduplicated(docs: DataFrame, window: int = 13, **columns: str) -> DataFrame:
    """``docs`` with the kept words as text; texts that lose nothing stay as they are."""
    text = columns.get("text_column", "text")
    done = remove_repeats(docs, window, **columns)
    new = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(
        F.col(f"document.`{text}`")
    )
    return done.select(
        *[
            (new if c == text else F.col(f"document.`{c}`")).alias(c)
            for c in docs.columns
        ]
    )
