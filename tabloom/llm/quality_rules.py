"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
_GAP_CHARACTERS = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ARITHMETIC = 8  # what a rule costs beside the text, in characters read


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def occurrences(text: Column, characters: str) -> Column:
    """How many characters of the text are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words in runs of ``width`` words that occur twice or more, the first included.

    Windows are sorted by a hash; only those that share it with a neighbour
    are compared as texts, again by sorting.
    """

    def window(w: Column, i: Column) -> list[Column]:
        return [F.get(w, i + k) for k in range(width)]

    def with_twin(rows: Column, field: str) -> Column:
        def same(row: Column, j: Column) -> Column:
            near = [F.get(rows, j + d)[field] == row[field] for d in (-1, 1)]
            return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

        return F.filter(rows, same)

    def sorted_by(positions: Column, key: Callable[[Column], Column]) -> Column:
        return F.sort_array(
            F.transform(positions, lambda i: F.struct(key(i).alias("k"), i.alias("i")))
        )

    def count(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - width)
        hashed = sorted_by(starts, lambda i: F.xxhash64(*window(w, i)))
        maybe = let(hashed, lambda rows: with_twin(rows, "k"))
        exact = let(
            maybe,
            lambda m: sorted_by(
                F.transform(m, lambda x: x["i"]),
                lambda i: F.concat_ws(" ", *window(w, i)),
            ),
        )
        covered = F.flatten(
            F.transform(
                let(exact, lambda rows: with_twin(rows, "k")),
                lambda x: F.array(*[x["i"] + k for k in range(width)]),
            )
        )
        return F.size(F.array_distinct(covered))

    return let(
        words,
        lambda w: F.when(F.size(w) > width, count(w)).otherwise(F.lit(0)),
    ).cast("long")


@dataclass(frozen=True)
class Rule:
    """Rejects a document when ``rejects`` holds; a null counts as false.

    ``passes`` is how often it reads the text; the measures are read already.
    """

    name: str
    rejects: Column
    passes: int = 0


def ordered_by_gain(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by rejections per cost on a sample, the best first.

    A rule costs the characters that it reads of the sample's texts, and a
    little for its arithmetic: an estimate that does not change from run to
    run, as times of so short passes would. Its rejections are those among the
    documents that the rules before it have left. Ties keep the given order, and
    so do rules that reject nothing more, the cheapest first. The order decides
    how fast a cascade is, never what it keeps.
    """
    mask = F.lit(0)
    for i, rule in enumerate(rules):
        hit = F.coalesce(rule.rejects, F.lit(False)).cast("int")
        mask = mask + F.shiftleft(hit, i)
    rows = (
        sample.groupBy(mask.alias("mask"))
        .agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("size"))
        .collect()
    )  # a row per combination of rules
    documents = sum(r["n"] for r in rows)
    mean = sum(r["size"] or 0 for r in rows) / max(1, documents)
    cost = [_ARITHMETIC + rule.passes * mean for rule in rules]
    order: list[int] = []
    left = list(range(len(rules)))
    while left:
        alive = [r for r in rows if not any(r["mask"] >> i & 1 for i in order)]
        found = {i: sum(r["n"] for r in alive if r["mask"] >> i & 1) for i in left}
        best = min(left, key=lambda i: (-found[i] / cost[i], cost[i], i))
        order.append(best)
        left.remove(best)
    return [rules[i] for i in order]


def first_rejection(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; later ones don't run."""
    chain = F
    for rule in rules:
        chain = chain.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name))
    return F.lit(None).cast("string") if chain is F else chain


def measured(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id_column``, the text and the measures that the preset rules use.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` (lines with a
    word that equal an earlier one), ``n_repeat_words``, and ``n_lines`` (lines
    with a word). A null or empty text has zeros; ids may be null or repeat;
    other columns are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(
        F.split(text, "\n"),
        lambda x: F.length(F.translate(x, _GAP_CHARACTERS, "")) > 0,
    )
    word_chars = F.length(F.translate(text, _GAP_CHARACTERS, ""))
    return (
        docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
        .select(
            "doc_id",
            "text",
            F.size(words_of(text)).cast("long").alias("n_words"),
            word_chars.cast("long").alias("word_chars"),
            occurrences(text, _SYMBOLS).cast("long").alias("n_symbols"),
            let(
                lines,
                lambda x: F.struct(
                    F.size(x).cast("long").alias("all"),
                    F.size(F.array_distinct(x)).cast("long").alias("different"),
                ),
            ).alias("lines"),
            repeated_words(words_of(text)).alias("n_repeat_words"),
        )
        .select(
            "doc_id", "text", "n_words", "word_chars", "n_symbols",
            (F.col("lines.all") - F.col("lines.different")).alias("n_dup_lines"),
            "n_repeat_words", F.col("lines.all").alias("n_lines"),
        )
    )


def preset_rules() -> list[Rule]:
    """Rules over the columns of ``measured``; clean prose passes all of them.

    Symbols are more than 1 in 20 word characters; more than half of the ASCII
    letters are capitals; exclamation marks are more than 1 in 50 word
    characters; more than half of the lines repeat an earlier one; words are
    shorter than 2 or longer than 20 characters on average.
    """
    text = F.col("text")
    upper = occurrences(text, _UPPER)
    letters = upper + occurrences(text, _UPPER.lower())
    return [
        Rule("symbols", F.expr("20 * n_symbols > word_chars")),
        Rule("capitals", 2 * upper > letters, passes=2),
        Rule("exclamations", 50 * occurrences(text, "!") > F.col("word_chars"), passes=1),
        Rule("same_lines", F.expr("2 * n_dup_lines > n_lines")),
        Rule(
            "word_length",
            F.expr("word_chars < 2 * n_words or word_chars > 20 * n_words"),
        ),
    ]


def judge(
    docs: DataFrame,
    sample_rows: int = 2000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Measures of every whole text and the verdict of the cascade.

    Returns the columns of ``measured`` without the text, ``base_failed``,
    ``rejected_by`` (the rule that ended the cascade; which of several depends
    on the measured order) and ``kept``. Texts that the base fails never enter
    the cascade. The order comes from a sample of about ``sample_rows`` rows;
    the verdict does not depend on it. An empty table gives an empty table.
    """
    rows = max(1, docs.count())
    picked = docs.sample(fraction=min(1.0, sample_rows / rows), seed=7)
    base = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
    sample = measured(picked, id_column, text_column).where(~F.expr(base))
    rules = ordered_by_gain(sample, preset_rules())
    return (
        measured(docs, id_column, text_column)
        .withColumn("base_failed", F.expr(base))
        .withColumn(
            "rejected_by",
            F.when(F.col("base_failed"), "base").otherwise(first_rejection(rules)),
        )
        .withColumn("kept", F.col("rejected_by").isNull())
        .drop("text")
        .withColumnRenamed("doc_id", id_column)
    )
