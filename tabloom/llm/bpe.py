"""Whole texts to token ids with the ``tokenizers`` library, once per distinct piece.

In a byte-level BPE with the usual pre-tokenizer pattern a space that a
character other than white space follows begins a match: the pattern's words
take the space in front of them, and a run of white space leaves its last
character to them. A text can therefore be cut before every such space and the
cuts be encoded one by one; the ids of the pieces, one after the other, are the
ids of the text. Pieces repeat, so a batch is cut and its pieces are numbered
in Arrow, each distinct piece is encoded once, and its ids are put wherever it
stands with numpy.

Most distinct pieces are a word and some marks that other words have as well. Of
a tokenizer with GPT-2's pattern, pieces of Latin letters, digits and ASCII marks
are cut into the pattern's matches, and the library's BPE model is asked for each
distinct match, without its pre-tokenizer. Other pieces go through the library whole.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator
from itertools import repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

_CACHED_BYTES = 64 << 20  # of pieces that a worker keeps
_OVERHEAD = 150  # bytes of a kept piece beside its own and its ids
_LONGEST = 64  # characters (bytes of a plain one) of a piece kept for later steps
_STEP_BYTES = 4 << 20  # of text that is cut at once
_MATCHES = 1 << 13  # new matches whose ids are held as objects at once
_TOKEN_ID = attrgetter("id")
_JOINED = 1 << 16  # characters of new pieces that are encoded as one text
_ENCODERS: dict[tuple, PieceEncoder] = {}  # kept by a Python worker for its next tasks
# White space by its code points: the engines' classes differ.
_WHITE = "\\x{09}-\\x{0D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
_UNCUT_SPACE = f" [{_WHITE}]"
_CUT = re.compile(r"(?= \S)")
# Characters of which all engines say the same: letters, digits, marks.
_LETTERS, _MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "!-/:-@\\[-`{-~"
_PLAIN = f"^[{_LETTERS}0-9{_MARKS}]+(\n[{_LETTERS}0-9{_MARKS}]+)*\n?$"
# GPT-2's pattern over pieces of them, one after the other.
_MATCH = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n"
)


def pieces(text: str) -> list[str]:
    """Cut before every space that a character other than white space follows."""
    found = _CUT.split(text)
    return found if found[0] else found[1:]


class PieceEncoder:
    """Encodes texts to unsigned 32-bit ids.

    ``tokenizer`` must be byte-level BPE with the pattern described above. Texts
    that hold an added token's text are left to the library as a whole.
    """

    def __init__(
        self, tokenizer: Tokenizer, step: int = _STEP_BYTES, cached: int = _CACHED_BYTES
    ):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.tokenizer = tokenizer
        self.step, self.cached = step, cached
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self._added = "|".join(map(re.escape, added))
        space = byte_characters()[0x20]
        vocabulary = tokenizer.get_vocab()
        self._spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self._spaced[[i for t, i in vocabulary.items() if t.startswith(space)]] = True
        self._by_match = _has_gpt2_pattern(tokenizer)
        self._model = tokenizer.model
        # A line end stays, to part the matches.
        self._shown = dict(enumerate(byte_characters())) | {10: "\n"}
        self._forget()

    def _forget(self) -> None:
        self._numbers: dict[str, int] = {}  # of kept pieces
        self._ids = np.empty(0, np.uint32)  # of all pieces learnt, in a row
        self._sizes = np.empty(0, np.int64)
        self._matches: dict[str, int] = {}  # numbers of matches of the pattern
        self._match_ids = np.empty(0, np.uint32)
        self._match_sizes = np.empty(0, np.int64)
        self._match_spaced = np.empty(0, bool)  # whether they begin with a space
        self._held = 0
        if self._by_match:
            ids = self.tokenizer.encode("\n", add_special_tokens=False).ids
            self._matches["\n"] = 0
            self._match_ids = np.array(ids, np.uint32)
            self._match_sizes = np.array([len(ids)])
            self._match_spaced = np.array([False])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian bytes."""
        out: list[bytes] = []
        for ids, ends in self.batches(pa.array(texts, pa.string())):
            starts = np.concatenate([[0], ends[:-1]])
            data = ids.astype("<u4", copy=False).tobytes()
            out += [
                data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())
            ]
        return out

    def batches(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of consecutive texts and where each text's ids end.

        A null is an empty text. A step holds some texts, as many as are cut at
        once, so that memory is bounded by them or one long text.
        """
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(texts):
            before = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, before + self.step)))
            yield self._step(texts.slice(begin, end - begin))
            begin = end

    def _step(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.split_pattern(texts, " ")
        bounds = cut.offsets.to_numpy()
        counted = cut.values.dictionary_encode()
        names = counted.dictionary
        codes = counted.indices.to_numpy().copy()
        first = bounds[:-1]  # these have no space in front
        heads, at = np.unique(codes[first], return_inverse=True)
        codes[first] = len(names) + at
        plain = np.zeros(len(names), bool)
        if self._by_match:
            found = pc.match_substring_regex(names, _PLAIN)
            plain = found.to_numpy(zero_copy_only=False)
            plain = plain & (pc.binary_length(names).to_numpy() <= _LONGEST)
        others = names.filter(pa.array(~plain))
        keys = pc.binary_join_element_wise(pa.scalar(" "), others, "").to_pylist()
        keys += names.take(pa.array(heads)).to_pylist()
        # The plain pieces come first, then the keys in their order.
        order = np.empty(len(names) + len(heads), np.int64)
        order[: len(names)] = np.where(
            plain, np.cumsum(plain) - 1, plain.sum() + np.cumsum(~plain) - 1
        )
        order[len(names) :] = np.arange(len(names), len(order))
        codes = order[codes]
        matched = names.filter(pa.array(plain))
        del cut, counted, names, others
        odd = pc.match_substring_regex(texts, _UNCUT_SPACE).to_numpy(zero_copy_only=False)
        whole = np.zeros(len(texts), bool)
        if self._added:
            found = pc.match_substring_regex(texts, self._added)
            whole = found.to_numpy(zero_copy_only=False)
        ends = bounds[1:]
        if (odd | whole).any():
            codes, ends = self._recut(
                texts, codes, bounds, odd & ~whole, whole, keys, len(matched)
            )
        if self._held > self.cached:
            self._forget()
        ids, sizes = self._matched(matched)
        numbers = np.concatenate([np.arange(len(matched)), len(matched) + self._numbered(keys)])
        ids, sizes = np.concatenate([ids, self._ids]), np.concatenate([sizes, self._sizes])
        if whole.any():  # the ids of such a text are one piece more
            more = [
                np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4")
                for t in texts.filter(pa.array(whole)).to_pylist()
            ]
            numbers = np.concatenate([numbers, len(sizes) + np.arange(len(more))])
            sizes = np.concatenate([sizes, [len(x) for x in more]])
            ids = np.concatenate([ids, *more])
        starts = np.cumsum(sizes) - sizes
        codes = numbers[codes]
        own = sizes[codes]
        total = np.concatenate([[0], np.cumsum(own)])
        kind = np.int32 if max(len(ids), total[-1]) < 1 << 31 else np.int64
        place = np.repeat((starts[codes] - total[:-1]).astype(kind), own)
        place += np.arange(total[-1], dtype=kind)
        return ids[place], total[ends]

    def _recut(self, texts, codes, bounds, odd, whole, keys, before):
        """Codes of the pieces where some texts are cut otherwise than at each space.

        New pieces are added to ``keys``, whose codes begin at ``before``; a text
        that is left whole gets one code behind all keys.
        """
        numbers: dict[str, int] = {}
        parts = np.split(codes, bounds[1:-1])
        for i in np.flatnonzero(odd):
            cut = pieces(texts[int(i)].as_py())
            parts[i] = np.array(
                [numbers.setdefault(x, before + len(keys) + len(numbers)) for x in cut],
                np.int64,
            )
        keys += numbers
        for n, i in enumerate(np.flatnonzero(whole)):
            parts[i] = np.array([before + len(keys) + n])
        return np.concatenate(parts), np.cumsum([len(x) for x in parts])

    def _matched(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain pieces in a row and how many each has.

        ``words`` are the pieces without the space that each begins with.
        """
        if not len(words):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")
        matches = _MATCH.findall(" " + joined[0].as_py())
        found = map(self._matches.get, matches, repeat(-1))
        numbers = np.fromiter(found, np.int64, len(matches))
        missing = np.flatnonzero(numbers < 0).tolist()
        if missing:
            base = len(self._match_sizes)
            new = list(dict.fromkeys(matches[i] for i in missing))
            self._matches.update(zip(new, range(base, base + len(new))))
            numbers[missing] = [self._matches[matches[i]] for i in missing]
            learnt = [
                self._learn_matches(new[i : i + _MATCHES]) for i in range(0, len(new), _MATCHES)
            ]
            ids, sizes = (np.concatenate(x) for x in zip(*learnt))
            spaced = np.fromiter((x[0] == " " for x in new), bool, len(new))
            self._match_ids = np.concatenate([self._match_ids, ids])
            self._match_sizes = np.concatenate([self._match_sizes, sizes])
            self._match_spaced = np.concatenate([self._match_spaced, spaced])
            self._held += sum(map(len, new)) + _OVERHEAD * len(new) + 4 * len(ids)
        sizes = self._match_sizes
        starts = (np.cumsum(sizes) - sizes)[numbers]
        sizes = sizes[numbers]
        total = np.cumsum(sizes)
        place = np.repeat(starts - total + sizes, sizes) + np.arange(total[-1])
        # Only the first match of a piece begins with a space.
        first = np.flatnonzero(self._match_spaced[numbers])
        return self._match_ids[place], np.add.reduceat(sizes, first)

    def _learn_matches(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of matches in a row and how many each has, by the library's model."""
        shown = "\n".join(new).encode().decode("latin-1").translate(self._shown)
        ids: list[int] = []
        sizes: list[int] = []
        for tokens in map(self._model.tokenize, shown.split("\n")):
            # Token objects are dropped match by match: many of them are slow to make.
            sizes.append(len(tokens))
            ids.extend(map(_TOKEN_ID, tokens))
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def _numbered(self, keys: list[str]) -> np.ndarray:
        """The number of each distinct piece among those learnt."""
        found = map(self._numbers.get, keys, repeat(-1))
        numbers = np.fromiter(found, np.int64, len(keys))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            base = len(self._sizes)
            new = [keys[i] for i in missing]
            order, ids, sizes = self._learn(new)
            numbers[missing[order]] = base + np.arange(len(order))
            self._ids = np.concatenate([self._ids, ids])
            self._sizes = np.concatenate([self._sizes, sizes])
            kept = {
                key: n
                for key, n in zip(new, numbers[missing].tolist())
                if len(key) <= _LONGEST
            }
            self._numbers.update(kept)
            self._held += sum(map(len, kept)) + _OVERHEAD * len(kept) + 4 * len(ids)
        return numbers

    def _learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces in some order, their ids in a row, how many each has.

        Pieces that begin with their only space are encoded as one text; in its
        ids every token that begins with a space begins a piece.
        """
        joined, others = [], []
        for i, piece in enumerate(new):
            plain = piece.rfind(" ") == 0 and len(piece) > 1 and not piece[1].isspace()
            (joined if plain else others).append(i)
        encode = self.tokenizer.encode_batch_fast
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for texts in _chunks(new[i] for i in joined):
            found = encode(["".join(texts)], add_special_tokens=False)[0].ids
            found = np.array(found, np.uint32)
            starts = np.flatnonzero(self._spaced[found])
            if len(starts) != len(texts):
                raise ValueError("the tokenizer joins pieces: its pattern is another one")
            ids.append(found)
            sizes.append(np.diff(starts, append=len(found)))
        for texts in _chunks(new[i] for i in others):
            found = [e.ids for e in encode(texts, add_special_tokens=False)]
            ids.append(np.array([x for own in found for x in own], np.uint32))
            sizes.append(np.array([len(own) for own in found], np.int64))
        order = np.array(joined + others, np.int64)
        return order, np.concatenate(ids), np.concatenate(sizes)


def _has_gpt2_pattern(tokenizer: Tokenizer) -> bool:
    """Whether all that comes before the model is a split by GPT-2's pattern."""
    if tokenizer.normalizer is not None or tokenizer.pre_tokenizer is None:
        return False
    state = json.loads(tokenizer.pre_tokenizer.__getstate__())
    return (
        state.get("type") == "ByteLevel"
        and state.get("use_regex", True)
        and not state.get("add_prefix_space")
    )


def _chunks(texts: Iterator[str]) -> Iterator[list[str]]:
    """Lists of texts of bounded length together, or one long text."""
    batch, size = [], 0
    for text in texts:
        batch.append(text)
        size += len(text)
        if size >= _JOINED:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def from_json(
    path: str, step: int = _STEP_BYTES, cached: int = _CACHED_BYTES
) -> PieceEncoder:
    """The encoder of a tokenizer file."""
    name = (path, step, cached)
    if name not in _ENCODERS:
        _ENCODERS[name] = PieceEncoder(Tokenizer.from_file(path), step, cached)
    return _ENCODERS[name]


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in ascending order of the byte.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The last merge that makes ``token``, by merges of lower rank only."""
    parts = [token[i : i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        options = [
            (ranks.get(a + b, limit), i)
            for i, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True))
        ]
        rank, at = min(options)
        if rank >= limit:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def _name(token: bytes, shown: list[str]) -> str:
    return "".join(shown[b] for b in token)


def from_ranks_vocabulary(path: str) -> dict[str, int]:
    """Tokens, written in byte characters, with their ids."""
    shown = byte_characters()
    return {_name(token, shown): rank for token, rank in read_ranks(path).items()}


def from_ranks(path: str, pattern: str) -> PieceEncoder:
    """A tokenizer that yields the ids that the ranks define, match by match."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[(path, pattern)] = _build(path, pattern)
    return _ENCODERS[(path, pattern)]


def _build(path: str, pattern: str) -> PieceEncoder:
    ranks = read_ranks(path)
    shown = byte_characters()
    pairs = [
        halves
        for token in sorted(ranks, key=ranks.get)
        if len(token) > 1 and (halves := _halves(token, ranks))
    ]
    merges = [(_name(a, shown), _name(b, shown)) for a, b in pairs]
    tokenizer = Tokenizer(
        models.BPE(
            vocab=from_ranks_vocabulary(path), merges=merges, ignore_merges=True
        )
    )
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    tokenizer.decoder = decoders.ByteLevel()
    return PieceEncoder(tokenizer)
