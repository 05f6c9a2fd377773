"""Language-model scores by a class-based bigram model.

Exchange clustering gives every word a class: a word moves to the class under
which the likelihood of the class bigrams is largest. A text's probability is
the product of class transitions and word emissions. Classes are found in
rounds over the whole corpus; in each the words of one half may move, against
the class counts of the round, so that two words that depend on each other
rarely trade places at once.

The corpus is cut into blocks with a dictionary of their own, the vocabulary
into partitions by a hash. A round sends the classes from the partitions to
the blocks, and what the blocks count by word and neighbouring class back to
the partitions. Only matrices of classes by classes reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import Scratch, binary, id_key, id_value, sorted_groups

END = b""  # ends a text and stands before it; no word is empty
BLOCK_TOKENS = 1 << 20
_PARTITION_WORDS = 200_000  # dictionary entries of all blocks
_MOST_BITS = 16
_UNKNOWN, _MOVES = 0x7F, 0x80  # in a byte that holds a class
_TABLED = 9  # counts below have their gains looked up
_BLOCKS = (
    "block long, n_words long, keys binary, held binary, sizes binary,"
    " tokens binary, tops binary, words binary, counts binary"
)
#: Rows between blocks and partitions of the vocabulary. ``kind`` orders those of
#: one partition: its words, its classes, the members' numbers, their counts.
_ROWS = "kind int, p int, block long, data binary, more binary, sums array<long>"
_NAMES = ["kind", "p", "block", "data", "more", "sums"]
_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
_VOCABULARY, _CLASSES, _MEMBERS, _COUNTS, _TOTALS, _TOP = range(6)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES
    )


class _Codes(dict):
    """Numbers things in order of appearance."""

    def __missing__(self, item) -> int:
        value = self[item] = len(self)
        return value

    def of(self, items: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, items), np.int32, len(items))


# Blocks


class _Block:
    def __init__(self):
        self.codes = _Codes()
        self.texts: list[np.ndarray] = []
        self.keys: list[int] = []
        self.held: list[bool] = []
        self.tokens = 0

    def add(self, key: int, held: bool, text: bytes) -> None:
        words = text.lower().split()  # of bytes: A-Z and ASCII white space only
        words.append(END)
        self.texts.append(self.codes.of(words))
        self.keys.append(key)
        self.held.append(held)
        self.tokens += len(words)

    def row(self, block: int) -> pa.RecordBatch:
        words = list(self.codes)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        tokens = place[np.concatenate(self.texts)]
        sizes = np.array([len(t) for t in self.texts], np.int32)
        held = np.array(self.held, bool)
        trained = tokens[~np.repeat(held, sizes)]
        counts = np.bincount(trained, minlength=len(words)).astype(np.int64)
        cells = [
            np.array(self.keys, np.int64).tobytes(),
            held.tobytes(),
            sizes.tobytes(),
            tokens.tobytes(),
            (hashes[order] >> np.uint64(64 - _MOST_BITS)).astype(np.uint16).tobytes(),
            b"\n".join(words[i] for i in order),
            counts.tobytes(),
        ]
        names = [c.split()[0] for c in _BLOCKS.split(",")]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.array([len(words)], pa.int64()),
                *(pa.array([c], pa.binary()) for c in cells),
            ],
            names,
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    found, block = 0, _Block()
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            part = batch.slice(begin, 500)
            keys, held = (part.column(c).to_pylist() for c in ("key", "held"))
            for key, out, text in zip(
                keys, held, binary(part.column("text")), strict=True
            ):
                block.add(key, out, text)
                if block.tokens >= BLOCK_TOKENS:
                    yield block.row(first + found)
                    found, block = found + 1, _Block()
    if block.keys:
        yield block.row(first + found)


# Vocabulary


def _entries(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Each block's dictionary, cut by partition of the vocabulary."""
    for batch in batches:
        for i in range(batch.num_rows):  # a batch may hold many blocks
            row = batch.slice(i, 1).to_pylist()[0]
            words = row["words"].split(b"\n")
            counts = np.frombuffer(row["counts"], np.int64)
            parts = np.frombuffer(row["tops"], np.uint16) >> (_MOST_BITS - bits)
            starts = np.flatnonzero(np.diff(parts.astype(np.int32), prepend=-1))
            ends = np.append(starts[1:], len(parts))
            yield _rows(
                [
                    (
                        _MEMBERS, int(parts[a]), row["block"],
                        b"\n".join(words[a:b]), counts[a:b].tobytes(), None,
                    )
                    for a, b in zip(starts, ends, strict=True)
                ]
            )


def _number(batches: Iterator[pa.RecordBatch], classes: int):
    """Number each partition's words that training texts hold.

    A vocabulary row has their counts and 16 bits of their hashes, a member row
    the numbers of a block's words (-1: in no training text); the most frequent
    words come as rows of their own, for the classes to begin with.
    """
    for group in sorted_groups(batches, ["p"]):
        p = group.column("p")[0].as_py()
        codes = _Codes()
        numbers = [
            codes.of(words.split(b"\n")) for words in group.column("data").to_pylist()
        ]
        totals = np.zeros(len(codes), np.int64)
        for at, counts in zip(numbers, group.column("more").to_pylist(), strict=True):
            totals[at] += np.frombuffer(counts, np.int64)  # no word is twice in a block
        known = np.flatnonzero(totals)
        number = np.full(len(codes), -1, np.int32)
        number[known] = np.arange(len(known), dtype=np.int32)
        words = list(codes)
        hashes = [xxhash.xxh64_intdigest(words[i]) & 0xFFFF for i in known]
        yield _rows(
            [
                (
                    _VOCABULARY, p, None, totals[known].tobytes(),
                    np.array(hashes, np.uint16).tobytes(),
                    [len(known), int(totals.sum())],
                )
            ]
        )
        frequent = sorted(known, key=lambda i: (-totals[i], words[i]))[:classes]
        if frequent:
            yield _rows(
                [
                    (_TOP, p, int(number[i]), words[i], None, [int(totals[i])])
                    for i in frequent
                ]
            )
        for block, at in zip(group.column("block").to_pylist(), numbers, strict=True):
            yield _rows([(_MEMBERS, p, block, number[at].tobytes(), None, None)])


# Classes


def weight(x: np.ndarray) -> np.ndarray:
    """x log x, and 0 at 0."""
    return x * np.log(np.maximum(x, 1))


def best_classes(
    word: np.ndarray, slot: np.ndarray, n: np.ndarray, own: np.ndarray, matrix: np.ndarray
) -> np.ndarray:
    """The class under which each word makes the class bigrams most likely.

    The words' counts come sorted by ``word``: ``n`` times class ``slot``
    follows it, or class ``slot - K`` precedes it. ``own`` has the class of
    each word, ``matrix`` the counts of class bigrams. A gain adds up the cells
    that a move changes, one at a time. Ties stay, then go to the lower class.
    """
    k = len(matrix)
    cells = np.concatenate([matrix.T, matrix]).astype(float)  # by slot, then class
    small = np.arange(_TABLED)[:, None, None]
    added = weight(cells + small) - weight(cells)
    gains = np.zeros((len(own), k))
    losses = np.zeros(len(own))
    step = 1 << 16
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    cuts = np.searchsorted(starts, np.arange(0, len(word), step))
    for a, b in zip(np.unique(cuts), np.append(np.unique(cuts)[1:], len(starts))):
        begin = starts[a]
        end = starts[b] if b < len(starts) else len(word)
        at, counts, rows = slot[begin:end], n[begin:end], word[begin:end]
        gain = added[np.minimum(counts, _TABLED - 1), at]
        many = np.flatnonzero(counts >= _TABLED)
        gain[many] = weight(cells[at[many]] + counts[many, None]) - weight(cells[at[many]])
        here = cells[at, own[rows]]
        loss = weight(np.maximum(here - counts, 0)) - weight(here)
        gains[rows[starts[a:b] - begin]] = np.add.reduceat(gain, starts[a:b] - begin)
        losses[rows[starts[a:b] - begin]] = np.add.reduceat(loss, starts[a:b] - begin)
    for side, sums in ((slot < k, matrix.sum(axis=1)), (slot >= k, matrix.sum(axis=0))):
        total = np.bincount(word[side], n[side], len(own))[:, None]
        sums = sums.astype(float)
        gains -= weight(sums + total) - weight(sums)
        here = sums[own]
        losses -= weight(np.maximum(here - total[:, 0], 0)) - weight(here)
    gains += losses[:, None]
    gains[np.arange(len(own)), own] = 1e-9
    return gains.argmax(axis=1).astype(np.uint8)


def _member_rows(p, classes, moves, members, counts=None) -> Iterator[pa.RecordBatch]:
    """What the blocks hear of a partition: the classes of their words."""
    told = np.append(classes | np.where(moves, _MOVES, 0).astype(np.uint8), _UNKNOWN)
    told = told.astype(np.uint8)
    yield _rows([(_CLASSES, p, None, classes.tobytes(), None, None)])
    if counts is not None:
        counts = np.append(counts, 0)
    for block, data in members:
        at = np.frombuffer(data, np.int32)  # -1 is the last
        more = None if counts is None else counts[at].tobytes()
        yield _rows([(_MEMBERS, p, block, told[at].tobytes(), more, None)])


def _partition_step(batches, k: int, turn: int, rounds: int, top: dict, matrix):
    """Move words by what the blocks counted, and tell the blocks the classes."""
    for group in sorted_groups(batches, ["p"]):
        p = group.column("p")[0].as_py()
        kinds = group.column("kind").to_numpy()
        rows = group.select(["block", "data", "more"])
        of = {x: rows.take(np.flatnonzero(kinds == x)).to_pylist() for x in set(kinds)}
        vocabulary = of[_VOCABULARY][0]
        totals = np.frombuffer(vocabulary["data"], np.int64)
        salt = np.frombuffer(vocabulary["more"], np.uint16)
        members = [(r["block"], r["data"]) for r in of[_MEMBERS]]
        if turn == 0:
            classes = (salt % k).astype(np.uint8)
            for number, rank in top.get(p, ()):
                classes[number] = rank
        else:
            classes = np.frombuffer(of[_CLASSES][0]["data"], np.uint8).copy()
            _move(classes, dict(members), of.get(_COUNTS, []), k, matrix)
        moves = (salt >> 15) == turn % 2
        last = turn == rounds
        yield from _member_rows(p, classes, moves, members, totals if last else None)
        if last:
            sums = [
                np.bincount(classes, minlength=k),
                np.bincount(classes, totals, k).astype(np.int64),
            ]
            yield _rows([(_TOTALS, p, None, None, None, np.concatenate(sums).tolist())])


def _move(classes, members, counted, k, matrix) -> None:
    keys, counts = [], []
    for row in counted:
        key = np.frombuffer(row["data"], np.uint32).astype(np.int64)
        number = np.frombuffer(members[row["block"]], np.int32)[key // (2 * k)]
        keys.append(number.astype(np.int64) * (2 * k) + key % (2 * k))
        counts.append(np.frombuffer(row["more"], np.uint32))
    if not keys:
        return
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(at, np.concatenate(counts)).astype(np.int64)
    word, where = np.unique(key // (2 * k), return_inverse=True)
    classes[word] = best_classes(where, key % (2 * k), n, classes[word], matrix)


def _local(group: pa.Table) -> tuple[dict, np.ndarray, np.ndarray, list]:
    """A block, the bytes its words have in order, where partitions begin, the rows."""
    block, *members = group.to_pylist()
    told = [np.frombuffer(r["data"], np.uint8) for r in members]
    starts = np.cumsum([0, *map(len, told)])
    return block, np.concatenate(told), starts, members


def _block_step(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Count class bigrams, and neighbouring classes of the words that may move."""
    matrix = np.zeros(k * k, np.int64)
    for group in sorted_groups(batches, ["block"]):
        block, told, starts, members = _local(group)
        tokens = np.frombuffer(block["tokens"], np.int32)
        sizes = np.frombuffer(block["sizes"], np.int32)
        held = np.frombuffer(block["held"], bool)
        tokens = tokens[~np.repeat(held, sizes)]
        if not len(tokens):
            continue
        tokens = np.concatenate([tokens[-1:], tokens])  # a training text's end
        classes = (told & _UNKNOWN).astype(np.int64)[tokens]
        matrix += np.bincount(classes[:-1] * k + classes[1:], minlength=k * k)
        moving = np.flatnonzero(told >= _MOVES)
        number = np.full(len(told), -1, np.int64)
        number[moving] = np.arange(len(moving))
        number = number[tokens]
        left, right = number[:-1] >= 0, number[1:] >= 0
        slots = np.concatenate(
            [
                number[:-1][left] * (2 * k) + classes[1:][left],
                number[1:][right] * (2 * k) + k + classes[:-1][right],
            ]
        )
        counts = np.bincount(slots)
        found = np.flatnonzero(counts)
        word, slot = moving[found // (2 * k)], found % (2 * k)
        cuts = np.searchsorted(word, starts)
        out = []
        for i, row in enumerate(members):
            a, b = cuts[i], cuts[i + 1]
            if a < b:
                key = ((word[a:b] - starts[i]) * (2 * k) + slot[a:b]).astype(np.uint32)
                n = counts[found[a:b]].astype(np.uint32)
                out.append(
                    (_COUNTS, row["p"], block["block"], key.tobytes(), n.tobytes(), None)
                )
        yield _rows(out)
    yield _rows([(_TOTALS, -1, None, None, None, matrix.tolist())])


_TEXTS = (
    "key long, held_out boolean, n_tokens long, n_known long, base_score double,"
    " emission double, classes binary, sums array<long>"
)


def _read_step(batches, k: int, tokens_seen: int, types: int, discount: float):
    """Per text the sums over its words and its sequence of classes."""
    names = [c.split()[0] for c in _TEXTS.split(",")]
    matrix = np.zeros(k * k, np.int64)
    for group in sorted_groups(batches, ["block"]):
        block, told, _, members = _local(group)
        classes = told & _UNKNOWN
        count = np.concatenate([np.frombuffer(r["more"], np.int64) for r in members])
        base = np.log10((count + 1) / (tokens_seen + types + 1))
        emission = np.log10(np.maximum(count - discount, discount))
        emission[count == 0] = 0
        tokens = np.frombuffer(block["tokens"], np.int32)
        sizes = np.frombuffer(block["sizes"], np.int32)
        held = np.frombuffer(block["held"], bool)
        starts = np.cumsum(sizes) - sizes
        train = classes[tokens[~np.repeat(held, sizes)]].astype(np.int64)
        if len(train):
            before = np.concatenate([train[-1:], train[:-1]])
            matrix += np.bincount(before * k + train, minlength=k * k)
        sequences = classes[tokens]
        for a in range(0, len(sizes), 2000):
            b = min(a + 2000, len(sizes))
            begin, end = starts[a], starts[b - 1] + sizes[b - 1]
            cut, part = starts[a:b] - begin, tokens[begin:end]
            keys = np.frombuffer(block["keys"], np.int64)[a:b]
            parts = np.split(sequences[begin:end], cut[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys),
                    pa.array(held[a:b]),
                    pa.array(sizes[a:b].astype(np.int64)),
                    pa.array(np.add.reduceat((count[part] > 0).astype(np.int64), cut)),
                    pa.array(np.add.reduceat(base[part], cut)),
                    pa.array(np.add.reduceat(emission[part], cut)),
                    pa.array([x.tobytes() for x in parts], pa.binary()),
                    pa.nulls(b - a, pa.list_(pa.int64())),
                ],
                names,
            )
    last = [pa.nulls(1, t) for t in (
        pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
        pa.binary(),
    )]
    yield pa.RecordBatch.from_arrays(
        [*last, pa.array([matrix.tolist()], pa.list_(pa.int64()))], names
    )


@dataclass
class Transitions:
    """log10 of P(class | class before) over the emissions' denominators.

    The last row and column belong to words that no training text holds. A
    class gives them what ``discount`` takes off each of its words' counts.
    """

    log: np.ndarray
    end: int  # class of the end of a text


def transitions(
    matrix: np.ndarray, types: np.ndarray, tokens: np.ndarray, end: int,
    discount: float, prior: float,
) -> Transitions:
    """From counts of class bigrams and each class's word types and tokens."""
    k = len(matrix)
    if not tokens.sum():  # nothing learnt: all words are one unknown word
        return Transitions(np.zeros((k + 1, k + 1)), k)
    share = tokens / tokens.sum()
    rows = matrix.sum(axis=1, keepdims=True)
    p = (matrix + prior * share) / (rows + prior)
    p = np.vstack([p, types / types.sum() @ p])
    unknown = discount * types / np.maximum(tokens, 1)
    with np.errstate(divide="ignore"):
        log = np.log10(np.column_stack([p, p @ unknown]))
    log[:, :k] -= np.log10(np.maximum(tokens, 1))
    return Transitions(log, end)


def _score(batches: Iterator[pa.RecordBatch], model: Transitions):
    for batch in batches:
        if not batch.num_rows:
            continue
        sequences = batch.column("classes").to_pylist()
        sizes = np.array([len(x) for x in sequences])
        starts = np.cumsum(sizes) - sizes
        at = np.frombuffer(b"".join(sequences), np.uint8).astype(np.int64)
        at[at == _UNKNOWN] = len(model.log) - 1
        before = np.concatenate([[0], at[:-1]])
        before[starts] = model.end
        score = np.add.reduceat(model.log[before, at], starts)
        names = ["key", "held_out", "n_tokens", "n_known", "base_score"]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in names),
                pa.array(score + batch.column("emission").to_numpy()),
            ],
            [*names, "score"],
        )


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [x for batch in batches for x in batch.column("sums").to_pylist()]
    if rows:
        total = np.sum(np.array(rows, np.int64), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["sums"])


def _sums(df: DataFrame) -> np.ndarray:
    """The arrays of ``sums`` added up; their length does not grow with the input.

    The rows, one a task, are added up in a few tasks and those on the driver.
    """
    few = df.select("sums").repartition(8).mapInArrow(_add, "sums array<long>")
    rows = [r["sums"] for r in few.collect()]
    return np.sum(np.array(rows, np.int64), axis=0) if rows else np.empty(0, np.int64)


def _held(key):
    """A remainder of 2; a row without an id is a training row."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score(
    docs: DataFrame,
    classes: int = 32,
    rounds: int = 4,
    discount: float = 0.5,
    prior: float = 1.0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """log10 probabilities of whole texts under a class-based bigram model.

    Training texts are those whose crc32 of the id as text leaves no 2 on
    division by 7, and those without an id. Returns ``id_column``,
    ``held_out``, ``n_tokens`` (with the end), ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigrams), ``score`` and ``perplexity``. A null text is an
    empty one, the end alone; rows that repeat an id are scored each, and
    learnt from each; without training texts every word is the one unknown
    word, of score 0; an empty table gives no rows; other columns are left out.

    ``classes`` is at most 126. The words that training texts hold most often
    begin in a class each, the others in one by hash.
    """
    k, spark = classes, docs.sparkSession
    scratch = Scratch(spark)
    texts = docs.select(
        id_key(id_column).alias("key"),
        _held(F.col(id_column)).alias("held"),
        F.col(text_column).alias("text"),
    )
    blocks = scratch.store(texts.mapInArrow(_cut, _BLOCKS), "blocks")
    entries = blocks.agg(F.sum("n_words")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-entries // _PARTITION_WORDS))
    bits = min(_MOST_BITS, (parts - 1).bit_length())

    def by_partition(rows: DataFrame) -> DataFrame:
        return rows.repartition("p").sortWithinPartitions("p", "kind", "block")

    numbered = scratch.store(
        by_partition(
            blocks.select("block", "tops", "words", "counts").mapInArrow(
                lambda b: _entries(b, bits), _ROWS
            )
        ).mapInArrow(lambda b: _number(b, k), _ROWS),
        "vocabulary",
    )
    seen = _sums(numbered.where(F.col("kind") == _VOCABULARY))
    types, tokens = seen.tolist() if len(seen) else (0, 0)
    frequent = (
        numbered.where(F.col("kind") == _TOP)
        .orderBy(F.desc(F.element_at("sums", 1)), "data")
        .limit(k)
        .collect()
    )
    top: dict[int, list[tuple[int, int]]] = {}
    for rank, row in enumerate(frequent):
        top.setdefault(row["p"], []).append((row["block"], rank))
    words = numbered.where(F.col("kind").isin(_VOCABULARY, _MEMBERS))

    def by_block(columns: list[str], told: DataFrame) -> DataFrame:
        empty = F.lit(None)
        own = blocks.select("block", F.lit(-1).alias("p"), *columns).withColumns(
            {"data": empty.cast("binary"), "more": empty.cast("binary")}
        )
        heard = told.where(F.col("kind") == _MEMBERS).select(
            "block", "p", "data", "more"
        )
        rows = own.unionByName(heard, allowMissingColumns=True)
        return rows.repartition("block").sortWithinPartitions("block", "p")

    told, matrix = None, None
    for turn in range(rounds + 1):
        rows = words
        if turn:
            counted = scratch.store(
                by_block(["held", "sizes", "tokens"], told).mapInArrow(
                    lambda b: _block_step(b, k), _ROWS
                ),
                f"counts-{turn}",
            )
            totals = _sums(counted.where(F.col("kind") == _TOTALS))
            matrix = totals.reshape(k, k) if len(totals) else np.zeros((k, k), np.int64)
            rows = rows.unionByName(counted.where(F.col("kind") == _COUNTS)).unionByName(
                told.where(F.col("kind") == _CLASSES)
            )
        now = scratch.store(
            by_partition(rows).mapInArrow(
                lambda b, t=turn, m=matrix: _partition_step(b, k, t, rounds, top, m),
                _ROWS,
            ),
            f"classes-{turn}",
        )
        if turn:
            scratch.drop(f"counts-{turn}", f"classes-{turn - 1}")
        told = now
    read = scratch.store(
        by_block(["keys", "held", "sizes", "tokens"], told).mapInArrow(
            lambda b: _read_step(b, k, tokens, types, discount), _TEXTS
        ),
        "read",
    )
    totals = _sums(read.where("key is null"))
    matrix = totals.reshape(k, k) if len(totals) else np.zeros((k, k), np.int64)
    sizes = _sums(told.where(F.col("kind") == _TOTALS))
    sizes = sizes.reshape(2, k) if len(sizes) else np.zeros((2, k), np.int64)
    # Every text ends alike: the last class is that of the end.
    closing = read.where("key is not null").select(F.substring("classes", -1, 1)).first()
    end = closing[0][0] if closing else 0
    model = transitions(matrix, *sizes, end, discount, prior)
    scored = read.where("key is not null").mapInArrow(
        lambda b: _score(b, model),
        "key long, held_out boolean, n_tokens long, n_known long,"
        " base_score double, score double",
    )
    return scored.select(
        id_value("key").alias(id_column),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
