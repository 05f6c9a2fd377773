"""Licence scans: automata for tags and notices, a parser for licence expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import binary, id_key, id_value

# Phrases that count as base places unless others are given, with their labels.
BASE = {
    "the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notices, as words, with their labels.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "isc license": "isc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "do what the fuck you want to public license": "wtfpl",
    "boost software license": "bsl",
    "artistic license 2": "artistic-2",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "academic free license": "afl",
    "open font license": "ofl",
    "zlib license": "zlib",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "open database license": "odbl",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
# How freely a text under a licence may be used, by the start of its label.
FREEDOM = {
    "afl": 0.9,
    "agpl": 0.3,
    "all-rights-reserved": 0.0,
    "apache": 1.0,
    "artistic": 0.7,
    "bsl": 1.0,
    "cddl": 0.5,
    "epl": 0.5,
    "eupl": 0.4,
    "odbl": 0.5,
    "ofl": 0.8,
    "python": 1.0,
    "wtfpl": 1.0,
    "zlib": 1.0,
    "bsd": 1.0,
    "cc-by-nc": 0.2,
    "cc-by-nd": 0.2,
    "cc-by-sa": 0.6,
    "cc-by": 0.9,
    "cc0": 1.0,
    "gpl": 0.4,
    "isc": 1.0,
    "lgpl": 0.5,
    "mit": 1.0,
    "mpl": 0.6,
    "public-domain": 1.0,
    "unlicense": 1.0,
}
UNKNOWN = 0.1

_TAG_LINE = re.compile(r"spdx-license-identifier\s*:?([^\n]*)", re.IGNORECASE)
_SYMBOL = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:_-]*)")
_BINDING = {"or": 1, "and": 2, "with": 3}
# Lower case for A-Z; a space for every other ASCII character that ends a word.
_FOLD = bytes(
    c | 0x20 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


# Identifiers that are written otherwise, deprecated ones among them.
ALIASES = {
    "0bsd": "bsd",
    "apache2": "apache-2",
    "boost": "bsl",
    "bsl-1": "bsl",
    "expat": "mit",
    "gplv2": "gpl-2",
    "gplv3": "gpl-3",
    "lgplv2.1": "lgpl-2.1",
    "lgplv3": "lgpl-3",
    "mit-0": "mit",
    "mit/x11": "mit",
    "psf": "python-2",
    "x11": "mit",
}


def label_of(identifier: str) -> str:
    """An identifier in lower case, without a version that labels leave out."""
    name = _plain_label(identifier)
    return ALIASES.get(name, name)


def _plain_label(identifier: str) -> str:
    name = identifier.lower().rstrip("+")
    for tail in ("-only", "-or-later"):
        name = name.removesuffix(tail)
    name = re.sub(r"(\.0)+$", "", name)
    if name.startswith("cc-by"):
        name = re.sub(r"-\d+(\.\d+)*$", "", name)
    return name


def freedom(label: str) -> float:
    starts = [s for s in FREEDOM if label == s or label.startswith(s + "-")]
    return FREEDOM[max(starts, key=len)] if starts else UNKNOWN


def postfix(expression: str) -> list[str]:
    """Shunting-yard: the expression's longest valid start in postfix order.

    ``with`` binds closer than ``and``, ``and`` closer than ``or``; operators
    may be in any case. The text after a tag may go on with prose: reading
    ends at the first symbol that cannot follow. Nothing valid gives [].

    One pass: the start is valid wherever an operand or a closing bracket
    leaves no bracket open, and what is out then, with the operators that wait,
    is its postfix form.
    """
    out: list[str] = []
    stack: list[str] = []
    valid: tuple[int, list[str]] = (0, [])  # how much of ``out``, and what waited
    depth, at, operand_next = 0, 0, True
    while match := _SYMBOL.match(expression, at):
        symbol, at = match[1], match.end()
        low = symbol.lower()
        if operand_next != (symbol == "(" or (low not in _BINDING and symbol != ")")):
            break
        if low in _BINDING:
            while stack and stack[-1] != "(" and _BINDING[stack[-1]] >= _BINDING[low]:
                out.append(stack.pop())
            stack.append(low)
            operand_next = True
            continue
        if symbol == "(":
            stack.append(symbol)
            depth += 1
            continue
        if symbol == ")":
            if not depth:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        else:
            out.append(symbol)
            operand_next = False
        if not depth:  # at most one operator of each kind waits here
            valid = len(out), stack[::-1]
    return out[: valid[0]] + valid[1]


def evaluate(postfixed: list[str]) -> tuple[float, set[str]]:
    """Freedom and labels: ``or`` lets choose the freer, ``and`` binds to both.

    An exception after ``with`` grants more, never less: the licence counts,
    the exception's name gives no label.
    """
    stack: list[tuple[float, set[str]]] = []
    for symbol in postfixed:
        if symbol not in _BINDING:
            label = label_of(symbol)
            stack.append((freedom(label), {label}))
            continue
        (right, more), (left, labels) = stack.pop(), stack.pop()
        if symbol == "with":
            stack.append((left, labels))
        else:
            pick = max if symbol == "or" else min
            stack.append((pick(left, right), labels | more))
    return stack[0] if stack else (1.0, set())


def automaton(base: Mapping[str, str] = BASE) -> ahocorasick.Automaton:
    """All phrases; those of ``BASE`` that ``base`` leaves out are notices."""
    found = ahocorasick.Automaton()
    kinds = {p: ("notice", x) for p, x in (BASE | NOTICES).items()}
    kinds[TAG] = ("tag", "")
    kinds |= {p: ("base", x) for p, x in base.items()}
    for phrase, (kind, label) in kinds.items():
        found.add_word(f" {phrase} ", (kind, label, len(phrase) + 1))
    found.make_automaton()
    return found


def scan_text(text: bytes, phrases: ahocorasick.Automaton) -> tuple:
    """(words, base starts, base labels, all labels, score, spans) of one text."""
    words = text.translate(_FOLD).split(b" ")
    words = [w for w in words if w]
    folded = f" {b' '.join(words).decode()} "
    starts: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    scores: list[float] = []
    spans: list[tuple[int, str]] = []
    tagged = False
    seen_to = word = 0
    for end, (kind, label, size) in phrases.iter(folded):
        begin = end - size
        if begin >= seen_to:
            word += folded.count(" ", seen_to, begin)
            at, seen_to = word, begin
        else:
            at = word - folded.count(" ", begin, seen_to)
        if kind == "tag":
            tagged = True
            continue
        if kind == "base":
            starts.append(at)
            base.add(label)
        labels.add(label)
        scores.append(freedom(label))
        spans.append((at, label))
    if tagged:
        for line in _TAG_LINE.findall(text.decode()):
            if ordered := postfix(line):
                score, more = evaluate(ordered)
                scores.append(score)
                labels |= more
    return (
        len(words), starts, base, base | labels, min(scores, default=0.0), spans
    )


_RESULT = (
    "key long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, "
    "places array<struct<word: long, label: string>>"
)
_PLACES = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    base: Mapping[str, str] = BASE,
) -> DataFrame:
    """Licence labels of every whole text.

    Words are runs of ASCII letters and digits and of all characters beyond
    ASCII, A-Z in lower case. Returns ``id_column``, ``n_words``, ``n_base``
    (places of the phrases of ``base``), ``first_word`` and ``last_word`` (smallest
    and largest of those places, null without any), ``base_labels`` and ``labels``
    (distinct, sorted, joined by commas; ``labels`` has those of notices and of
    evaluated expressions too), ``score`` (how freely the text may be used by
    its least free statement, 0 to 1; 0 without a statement) and ``places`` of
    all phrases. An expression that cannot be read adds nothing. ``base`` maps
    phrases, in such words with one space between them, to labels; phrases of
    ``BASE`` that it leaves out give labels as notices do.

    A null or empty text has no words and empty labels; ids may be null or
    repeat; an empty table gives an empty table; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton(base)
        for batch in batches:
            out = [scan_text(t, phrases) for t in binary(batch.column("text"))]
            joined = [(",".join(sorted(r[2])), ",".join(sorted(r[3]))) for r in out]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([r[0] for r in out], pa.int64()),
                    pa.array([len(r[1]) for r in out], pa.int64()),
                    pa.array([min(r[1], default=None) for r in out], pa.int64()),
                    pa.array([max(r[1], default=None) for r in out], pa.int64()),
                    pa.array([x for x, _ in joined], pa.string()),
                    pa.array([x for _, x in joined], pa.string()),
                    pa.array([r[4] for r in out], pa.float64()),
                    pa.array(
                        [[{"word": w, "label": x} for w, x in r[5]] for r in out],
                        _PLACES,
                    ),
                ],
                _NAMES,
            )

    rows = docs.select(id_key(id_column).alias("key"), F.col(text_column).alias("text"))
    out = rows.mapInArrow(run, _RESULT)
    return out.select(id_value("key").alias(id_column), *out.columns[1:])


_NAMES = [
    "key", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
    "score", "places",
]
