"""Every corpus operator against its plain definition, on awkward rows."""

import base64
import re
import zlib
from collections import defaultdict

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm import (
    ball_kmeans,
    bpe,
    byte_bpe,
    class_ngrams,
    cover_tree,
    filter_audit,
    license_scan,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    queries,
    simhash,
    substring_dedup,
    token_files,
)

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = " ".join(f"w{i * i % 977}" for i in range(4000))
PROSE = " ".join(f"word{i}" for i in range(40))
DOCS = [
    (1, PROSE + " one"),
    (2, "start here " + PROSE + " two"),
    (3, None),
    (4, ""),
    (5, "  \t\n "),
    (6, LONG),
    (7, LONG + " end"),
    (8, "A short TEXT\x0bof the MIT License\nso <b> $5 | 5%"),
    (9, "la la la la la la la la la la la la la la"),
    (10, "naïve café 漢字 😀 ß 'll don't  two  spaces nbsp\x85nel"),
    (None, PROSE + " null"),
    (11, "same line that is repeated here\nother words in this line\n" * 3),
    (12, "Same line  that is repeated here\nother words in this line!\nshort"),
    (14, "the end <|endoftext|> of<|endoftext|>a text"),
    (13, "SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND CC-BY-NC-4.0 yes"),
]
SCHEMA = "doc_id long, text string"


def frame(spark, rows=DOCS):
    """With extra columns whose names the operators use themselves."""
    more = {c: F.lit(1) for c in ("key", "n_words", "anchor", "lines", "block", "ids")}
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(more)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(actual, expected):
    assert actual == sorted(map(tuple, expected), key=repr)


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(JSON)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files(spark, encode, tmp_path):
    folder = str(tmp_path / "tokens")
    index = token_files.write_tokens(frame(spark), JSON, folder, 2, length=64)
    rows = token_files.read_tokens(index).collect()
    found = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in rows]
    same(sorted(found, key=repr), brute.token_files(DOCS, encode, 2))
    first = index.orderBy("key").first()
    reader = token_files.ShardReader(first["path"])
    ids = np.array([*encode(DOCS[0][1]), 2])
    assert reader.sequence(0)[:40].tolist() == ids[:40].tolist()
    assert reader.mask(0).all()


def test_quality_rules(spark):
    names = [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed",
    ]
    judged = quality_rules.judge(frame(spark))
    same(got(judged, *names), [(k, *brute.quality(t)) for k, t in DOCS])
    assert judged.where("base_failed and kept").count() == 0


def test_quality_rules_are_ordered_by_what_they_add(spark):
    rows = spark.range(1000).selectExpr("id", "repeat('x', 100) AS text")
    rules = [
        quality_rules.Rule("never", F.lit(False)),
        quality_rules.Rule("costly", F.expr("id % 10 < 5"), passes=3),
        quality_rules.Rule("inside", F.expr("id % 10 < 4"), passes=1),
        quality_rules.Rule("cheap", F.expr("id % 100 = 99")),
        quality_rules.Rule("null", F.lit(None).cast("boolean"), passes=1),
    ]
    for _ in range(10):
        names = [r.name for r in quality_rules.ordered_by_gain(rows.repartition(3), rules)]
        # Alone "costly" rejects most, but what "inside" leaves of it is little.
        assert names == ["inside", "cheap", "costly", "never", "null"]
    empty = quality_rules.ordered_by_gain(rows.limit(0), rules)
    assert {r.name for r in empty} == {r.name for r in rules}


def test_classifier(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_classifier.train(docs, labels)
    scored = quality_classifier.score(docs, model).join(labels, "doc_id")
    out = scored.where(quality_classifier.held_out(F.col("doc_id"))).toPandas()
    assert (out["predicted"] == out["quality"]).mean() > 0.93
    odd = quality_classifier.score(frame(spark), model).toPandas()
    assert len(odd) == len(DOCS) and odd["score"].between(0, 1).all()
    assert quality_classifier.accepted(frame(spark), model).columns == frame(spark).columns


def test_substring_dedup(spark):
    done = substring_dedup.remove_repeats(frame(spark))
    digest = F.sha2("kept_text", 256)
    same(got(done, "id", "n_words", "n_removed", digest), brute.substring(DOCS))


def test_license_scan(spark):
    rows = {r.doc_id: r for r in license_scan.scan(frame(spark)).collect()}
    assert (rows[8].n_base, rows[8].first_word, rows[8].base_labels) == (1, 4, "mit")
    assert rows[13].labels == "cc-by-nc,gpl-2,mit" and rows[13].score == 0.2
    assert (rows[3].n_words, rows[3].first_word, rows[3].labels) == (0, None, "")


@pytest.mark.parametrize(
    ("expression", "expected"),
    [
        ("MIT", "MIT"),
        ("a or b and c", "a b c and or"),
        ("(a OR b) AND c WITH d", "a b or c d with and"),
        ("MIT is the licence", "MIT"),
        ("and", ""),
        ("(a", ""),
        ("a and b or (c", "a b and"),
        ("((a or b)) with c) and d", "a b or c with"),
        ("a or or b", "a"),
        (") a", ""),
        ("a " * 200_000, "a"),
        ("(" * 20_000 + "a", ""),
        ("a and b " * 3, "a b and"),
    ],
)
def test_shunting_yard(expression, expected):
    assert " ".join(license_scan.postfix(expression)) == expected


def plain_licences(text):
    """(n_words, n_base, first_word, last_word, base_labels) by definition."""
    found = re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())
    w = [x.lower() for x in found]
    places = [
        (i, label)
        for phrase, label in license_scan.BASE.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.encode().split()
    ]
    at = [i for i, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(w), len(at), min(at, default=None), max(at, default=None), labels


def test_license_scan_against_its_definition(spark):
    random = np.random.default_rng(3)
    words = [
        "the", "MIT", "license", "License,", "apache", "version", "2", "cc-by-nc", "by", "nc", "cc",
        "(Apache)", "é", "x1", "\n", "--",
    ]
    docs = [(i, " ".join(random.choice(words, random.integers(0, 60)))) for i in range(300)]
    docs += [*DOCS, (900, "the MIT license " * 30_000), (901, "the mit license" * 2)]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    expected = [(k, *plain_licences(t)) for k, t in docs]
    same(got(license_scan.scan(frame(spark, docs)), *names), expected)


def test_license_query_keeps_to_its_contract(spark, tmp_path):
    """The base phrase is longer than the operator's own; that one stays a label."""
    docs = [
        (1, "Free Under the MIT License."),
        (2, "the MIT license"),
        (3, "under, the MIT license; under the mit license CC-BY-NC"),
        (4, "Apache License, Version 2.0 under the mit licensed"),
        (5, None),
    ]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op5_license_scan(spark, str(tmp_path)).drop("score")
    assert sorted(map(tuple, found.collect())) == [
        (1, 5, 1, 1, 1, "mit", "mit"),
        (2, 3, 0, None, None, "", "mit"),
        (3, 11, 3, 0, 8, "cc-by-nc,mit", "cc-by-nc,mit"),
        (4, 9, 1, 0, 0, "apache-2", "apache-2"),
        (5, 0, 0, None, None, "", ""),
    ]


def test_simhash(spark):
    done = simhash.near_duplicates(frame(spark))
    same(got(done, "doc_id", "fingerprint", "component_id"), brute.simhash(DOCS))


def test_simhash_with_null_and_repeated_ids(spark):
    texts = [" ".join(f"{w}{i * 7919 % 101}" for i in range(60)) for w in "abcde"]
    docs = [
        (5, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]),
        (None, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[4]), (4, texts[4]),
    ]
    docs = frame(spark, docs)
    done = simhash.near_duplicates(docs)
    same(got(done, "doc_id", "component_id"), [
        (5, 5), (None, 5), (None, None), (None, None), (None, None),
        (7, 7), (7, 4), (7, 4), (4, 4),
    ])
    one = corpus_pipeline.single_documents(spark, docs, "")
    assert one.columns == docs.columns
    same(got(one, "doc_id", "text"), [
        (5, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (4, texts[4]),
    ])


def test_pivot_pairs_lose_nothing():
    random = np.random.default_rng(0)
    fps = random.integers(0, 1 << 63, 40, np.uint64).repeat(20)
    fps ^= np.uint64(1) << random.integers(0, 6, len(fps)).astype(np.uint64)
    near = np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3, 1)
    a, b = simhash.near_pairs(fps, 3)
    found = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    assert found == {tuple(p) for p in np.argwhere(near).tolist()}


def lines_of(docs):
    return [
        (key, "\n".join((text or "").split("\n")[i] for i in stay) if text is not None else None)
        for (key, text), (_, stay) in zip(docs, brute.every_line(docs), strict=True)
    ]


def test_line_dedup(spark):
    done = line_dedup.dedup_lines(frame(spark))
    same(got(done, "id", "kept_text"), lines_of(DOCS))


def test_line_dedup_of_short_lines(spark):
    docs = [
        (1, "All rights reserved.\nok\nSubscribe now\n\nshares it\n-"),
        (2, "all  rights reserved.\n\n\nOK\nno copy"),
        (3, "Subscribe now\nsubscribe now!\n \nabcdefg\nabcdefgh"),
        (4, "abcdefgh\nbcdefgh\nShares it\nan article of 23 chars."),
        (None, "An article of 23 chars!\n-\nan article of 23 chars\nok"),
    ]
    done = line_dedup.dedup_lines(frame(spark, docs))
    texts = dict(docs)
    expected = [
        (key, "\n".join(texts[key].split("\n")[i] for i in stay))
        for key, stay in brute.every_line(docs)
    ]
    same(got(done, "id", "kept_text"), expected)
    assert dict(expected)[2] == "\n\nno copy"


def test_line_dedup_with_null_and_repeated_ids(spark):
    first = "the very same first line of them all"
    docs = [(None, f"{first}\nnull {i}") for i in range(3)]
    docs += [(7, f"{first}\nseven {i}") for i in range(2)] + [docs[0], (7, "seven 1\n")]
    done = line_dedup.dedup_lines(frame(spark, docs)).select("id", "kept_text").collect()
    texts = [r.kept_text for r in done]
    # One row of the smallest id keeps the line, whichever comes first by its hash.
    assert sum(first in t for t in texts) == 1
    assert all(r.id == 7 for r in done if first in r.kept_text)
    lines = sorted(x for t in texts for x in t.split("\n") if x and x != first)
    # The row that repeats an id and text is treated like its twin.
    assert lines == ["null 0", "null 0", "null 1", "null 2", "seven 0", "seven 1"]


def test_line_dedup_keeps_the_lines_that_share_a_band(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_BUCKET", 64)  # so that there are several
    random = np.random.default_rng(4)
    keys = np.arange(line_dedup.BANDS) << 40 | random.integers(0, 1 << 40, (60, 16))
    keys[10:40:3, 5], keys[50:, 15] = keys[0, 5], keys[7, 15]
    bands = line_dedup.packed(keys)
    assert np.array_equal(line_dedup.unpacked(bands), keys)
    ids = [i << 33 | 7 for i in range(60)]  # as of slices
    rows = [*zip(ids, bands), (1, None)]
    lines = spark.createDataFrame(rows, "line_id long, bands binary").repartition(3)
    found = {(r.band, r.at, r.line_id) for r in line_dedup._band_members(lines).collect()}
    assert found == {
        (int(keys[i, k]), k, ids[i])
        for k, some in ((5, [0, *range(10, 40, 3)]), (15, [7, *range(50, 60)]))
        for i in some
    }


@pytest.mark.parametrize("line", ["a plain line of ascii", "señal de ñu, ñu, ñu", "中文的一行文字在这里 ab"])
def test_links_of_eight_character_shingles(line):
    # As many distinct shingles shared as the threshold asks for, and one fewer.
    lines = [line * 2, line * 2 + "!", line * 2 + "!?xyz", "q" * 50]
    sets = [{x[i : i + 8] for i in range(len(x) - 7)} for x in lines]
    for i in (1, 2, 3):
        close = len(sets[0] & sets[i]) / len(sets[0] | sets[i])
        for threshold, linked in ((close, close > 0), (close + 1e-9, False)):
            links = line_dedup.similar_links(
                [lines[0], lines[i]], 8, threshold, lambda i, o: np.ones(len(o), bool)
            )
            assert bool(links) == linked or not close


@pytest.mark.parametrize("size", [4, 60, 300])
def test_links_connect_what_all_similar_pairs_connect(size):
    random = np.random.default_rng(size)
    base = ["".join(random.choice([*"abcdefgh "], 60)) for _ in range(4)]
    lines = []
    for i in range(size):
        x = list(base[i % 4])
        for _ in range(random.integers(0, 4)):
            x[random.integers(0, 60)] = "z"
        lines.append("".join(x))
    sets = [{x[i : i + 5] for i in range(56)} for x in lines]
    pairs = [
        (i, j) for i in range(size) for j in range(i)
        if len(sets[i] & sets[j]) >= 0.6 * len(sets[i] | sets[j])
    ]
    links = line_dedup.similar_links(lines, 5, 0.6, lambda i, o: np.ones(len(o), bool))
    assert set(map(frozenset, links)) <= set(map(frozenset, pairs))
    names = list(range(size))
    assert brute.components(size, links, names) == brute.components(size, pairs, names)
    assert len(links) == size - len(set(brute.components(size, pairs, names)))


def test_lines_that_have_met_are_not_looked_up(monkeypatch):
    def never(*_):
        raise AssertionError("no pair is left to compare")

    monkeypatch.setattr(line_dedup, "_codes", never)
    lines = [f"{i} a line {i * i} of its own {i}" for i in range(300)]
    none = line_dedup.similar_links(lines, 8, 0.8, lambda i, o: np.zeros(len(o), bool))
    assert none == []
    even = line_dedup.similar_links(
        lines, 8, 0.8, lambda i, o: (o == i + 1) | (o == i - 1) if i % 9 else o < 0
    )
    assert even == []


@pytest.mark.parametrize("size", [200, 400])
def test_links_of_many_small_groups(size):
    random = np.random.default_rng(size)
    base = ["".join(random.choice([*"abcdefgh "], 60)) for _ in range(100)]
    lines = [base[i % 100] + "xyz"[: i // 100] for i in range(size)]
    links = line_dedup.similar_links(lines, 5, 0.9, lambda i, o: np.ones(len(o), bool))
    groups = brute.components(size, links, list(range(size)))
    assert groups == [i % 100 for i in range(size)]


def test_links_leave_out_pairs_of_earlier_bands_and_of_one_chunk():
    line = "the same line but for its end, "
    keys = np.arange(16) << 40 | np.arange(100, 107)[:, None]
    keys[1, 2] = keys[0, 2]  # met in band 2
    keys[4, 5] = keys[3, 5]  # only later than in band 3
    rows = [  # band, lo, hi, part, at, line_id
        (1, 0, 0, 0, 3, 0), (1, 0, 0, 0, 3, 1),
        (2, 0, 0, 0, 3, 3), (2, 0, 0, 0, 3, 4),
        (3, 0, 1, 0, 3, 2), (3, 0, 1, 0, 3, 5), (3, 0, 1, 1, 3, 6),
    ]
    names = ["band", "lo", "hi", "part", "at", "line_id"]
    batch = pa.RecordBatch.from_arrays(
        [
            *(pa.array(c, pa.int64()) for c in zip(*rows)),
            pa.array(line_dedup.packed(keys[[r[5] for r in rows]]), pa.binary()),
            pa.array([line + "abcdefg"[r[5]] for r in rows]),
        ],
        [*names, "bands", "words"],
    )
    found = [
        (x["a"], x["b"])
        for out in line_dedup._links(iter([batch]), 8, 0.8)
        for x in out.to_pylist()
    ]
    assert sorted(map(sorted, found)) == [[2, 6], [3, 4], [5, 6]]


def test_line_dedup_reads_lines_once(spark, monkeypatch):
    reads = []
    rows_of = line_dedup._line_rows

    def counted(*args, **more):
        reads.append(args)
        return rows_of(*args, **more)

    monkeypatch.setattr(line_dedup, "_line_rows", counted)
    docs = [(2, "one\nONE  \ntwo"), (1, "one\nthree\n\nthree"), (None, None)]
    done = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    kept = {r.id: (r.n_lines, r.n_removed, r.kept_text) for r in done.collect()}
    assert kept == {2: (3, 2, "two"), 1: (3, 1, "one\nthree\n"), None: (0, 0, None)}
    assert len(reads) == 1


def test_a_block_without_words_has_no_anchors():
    batch = pa.RecordBatch.from_pylist(
        [
            {"block": 1, "anchors": b"", "several": b""},
            {"block": 2, "anchors": np.array([5, 9], np.uint64).tobytes(), "several": b"ab"},
        ]
    )
    found = [x for out in substring_dedup._by_part(iter([batch]), 2) for x in out.to_pylist()]
    assert [(x["part"], x["block"], x["several"]) for x in found] == [(0, 2, b"ab")]


def test_cover_tree(spark):
    random = np.random.default_rng(4)
    centers = random.normal(size=(12, 8))
    near = centers.repeat(12, 0) + random.normal(scale=0.05, size=(144, 8))
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(near)]
    rows += [
        (200, None, 0), (201, [0.0] * 8, 0), (202, [float("nan")] * 8, 0),
        (203, [None] * 8, 0), (204, near[0].tolist(), None), (205, [1.0], 0),
        (206, near[0].tolist(), 0), (207, near[0].tolist(), 0), (208, [], 0),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    done = cover_tree.near_duplicates(table.withColumn("key", F.lit(0)))
    same(
        got(done, "vec_id", "n_links", "component_id", "kept"), brute.embeddings(rows)
    )


def test_byte_bpe(spark):
    ranks = {
        base64.b64decode(t): int(r) for t, r in map(bytes.split, open(RANKS, "rb"))
    }
    plain = tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    encoded = byte_bpe.encode(frame(spark), RANKS, public_tokenizers.PATTERN, offsets=True)
    texts = dict(DOCS)
    for r in byte_bpe.decode(encoded, RANKS).collect():
        text = texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == plain.encode_ordinary(text)
        assert r.decoded == text.encode()
        assert len(r.begins) == len(r.ids) // 4
        if text:
            assert r.begins[0] == 0 and r.ends[-1] == len(text)


def test_packing(spark, encode):
    docs = DOCS + [(100 + i, f"{PROSE} {i} " * (i % 7)) for i in range(60)]
    pieces = packing.pack(frame(spark, docs), JSON, 0, window=128).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for key, text in docs:
        ids, at = [*encode(text or ""), 0], 0
        for p in sorted(by_doc[key], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == brute.crc(ids[at : at + p.length])
            at += p.length
        assert at == len(ids)
    short = 0
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 128
        short += at < 128
    assert short <= 1  # the only shard's last sequence


def test_pieces_make_up_the_whole_text_s_ids():
    plain = Tokenizer.from_file(JSON)
    random = np.random.default_rng(7)
    alphabet = [
        *" \n\t\x0b\r\x1c\x85\xa0\u2003\u3000abABé漢😀\u0301019'.,!_<|>", "  ", " \n", " word", "word",
        "'ll", "<|endoftext|>", "\n\n",
    ]
    texts = ["".join(random.choice(alphabet, random.integers(0, 25))) for _ in range(4000)]
    texts += ["x" * 300, " " * 50, ""]
    small = bpe.PieceEncoder(Tokenizer.from_file(JSON), cached=20_000)
    for encoder in (bpe.from_json(JSON), small):
        found = encoder.encode(texts)
        for text, ids in zip(texts, found, strict=True):
            expected = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == expected, text


def test_matches_are_learnt_once_whatever_stands_beside_them():
    encoder = bpe.PieceEncoder(Tokenizer.from_file(JSON))
    texts = ["word Wörter word, word.\nWörter word$$$ don't 12word's\n word", "word word12,\nword. it's"]
    plain = Tokenizer.from_file(JSON)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text).ids
    assert sorted(encoder._matches) == sorted(
        ["\n", "$$$", "'s", "'t", ",", ".", " 12", "12", " Wörter", "Wörter",
         " don", " it", " word", "word"]
    )
    assert set(encoder._numbers) == {"word"}  # without a space in front


def test_texts_without_spaces_are_not_kept():
    encoder = bpe.PieceEncoder(Tokenizer.from_file(JSON))
    for i in range(3):
        encoder.encode([chr(0x4E00 + j % 500) * 2000 + str(i) for j in range(50)])
    assert not encoder._numbers and encoder._held < encoder.cached


VECTORS = [
    (i, [float(np.float32(x)) for x in v], None if i % 7 == 0 else i % 3)
    for i, v in enumerate(
        np.random.default_rng(11).normal(size=(90, 12)).repeat(2, axis=0)
        * np.random.default_rng(12).integers(1, 3, (180, 1))
    )
]


def test_ball_kmeans(spark):
    odd = [
        (500, None, 0), (501, [None] * 12, 0), (502, [float("inf")] * 12, 1), (503, [], 1),
        (504, [1.0], 2), (None, [0.5] * 12, 2), (3, [-0.25] * 12, 0), VECTORS[5],
    ]
    rows = VECTORS + odd
    schema = "vec_id long, embedding array<double>, label int"
    table = spark.createDataFrame(rows, schema).repartition(3).withColumn("key", F.lit(0))
    for parts, entries, rounds in ((4, 5, 3), (8, 16, 6), (5, 3, 0)):
        codes, books = ball_kmeans.compress(table, parts, entries, rounds)
        usable = [r for r in rows if r[1] is None or len(r[1]) != 1]
        expected, digest = brute.ball_kmeans(usable, parts, entries, rounds)
        same(got(codes, "vec_id", "code", "error", "label_error"), expected)
        assert books.digest() == digest
    few = spark.createDataFrame(VECTORS[:3], schema)
    codes, books = ball_kmeans.compress(few)
    assert codes.count() == 3 and len(books.entries[0]) == 3


def test_ball_kmeans_skips_only_what_cannot_be_nearer():
    random = np.random.default_rng(2)
    x = random.integers(-9, 9, (4000, 3))
    entries = random.integers(-9, 9, (16, 3))
    entries[7] = entries[2]  # equally near: the lower index
    expected = ball_kmeans.nearest(x, entries)
    for start in (np.zeros(4000, np.uint8), random.integers(0, 16, 4000).astype(np.uint8)):
        assert (ball_kmeans.moved(x, entries, start) == expected).all()


def test_class_ngrams(spark, monkeypatch):
    monkeypatch.setattr(class_ngrams, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(class_ngrams, "_PARTITION_WORDS", 40)
    random = np.random.default_rng(5)
    docs = DOCS + [
        (100 + i, " ".join(f"{'ab'[j % 2]}{random.integers(0, 12)}" for j in range(40)) + f" X{i}")
        for i in range(30)
    ]
    docs += [docs[-1], (100, "other text under the same id")]
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for k, rounds in ((3, 0), (4, 3)):
        found = class_ngrams.score(frame(spark, docs), classes=k, rounds=rounds)
        expected = sorted(brute.class_ngrams(docs, k, rounds), key=repr)
        actual = got(found, *names)
        assert [r[:5] for r in actual] == [r[:5] for r in expected]
        for a, e in zip(actual, expected, strict=True):
            assert a[5:] == pytest.approx(e[5:], rel=1e-9)


def test_class_ngrams_add_up_to_one():
    random = np.random.default_rng(1)
    matrix = random.integers(0, 9, (5, 5))
    matrix[2], matrix[:, 2] = 0, 0  # a class without words
    tokens, types = matrix.sum(axis=0) + 3, np.array([1, 2, 0, 3, 2])
    tokens[2] = 0
    model = class_ngrams.transitions(matrix, types, tokens, 0, 0.5, 1.0)
    # All words of a class together emit its tokens less the discounts.
    emitted = np.append(tokens - 0.5 * types, 1.0)
    assert np.power(10, model.log) @ emitted == pytest.approx(np.ones(6))


def test_class_ngrams_learn_what_follows(spark):
    text = " ".join(["red cat", "blue dog", "red dog", "blue cat"][i % 4] for i in range(200))
    docs = [(i, text + f" z{i}") for i in range(60)]
    scored = class_ngrams.score(frame(spark, docs), classes=6).toPandas()
    held = scored[scored["held_out"]]
    assert len(held) and (held["score"] > 0.6 * held["base_score"]).all()


def test_class_ngrams_without_training_texts(spark):
    key = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = class_ngrams.score(frame(spark, [(key, "a b")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert (row.base_score, row.score) == (0.0, 0.0)


def audit_docs():
    docs = [(k, t, ["en", "fr", None, ""][i % 4]) for i, (k, t) in enumerate(DOCS)]
    long = " ".join(f"w{i}" for i in range(250))
    docs += [
        (50, long, "en"), (51, long, "fr"), (51, long, "fr"), (49, long, "de"), (None, long, "en"),
        (52, long + " $", "en"), (53, "ABC " * 210, "en"), (54, long[:-1], "fr"), (3, "", "en"),
        (55, long.upper(), "de"), (56, "é" * 700 + "A" * 22, "de"),
    ]
    return docs


LABELS = [(50, 1, 0), (51, 1, 1), (51, 0, 0), (3, 1, 1), (None, 1, 1), (52, None, 1), (999, 1, 1)]


def test_filter_audit(spark, monkeypatch):
    names = [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    ]
    docs = audit_docs()
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    table = table.repartition(4).withColumns({c: F.lit(1) for c in ("mask", "n", "kept")})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    expected = brute.filter_audit(docs, LABELS)
    same(got(filter_audit.audit(table, labels), *names), expected)
    # Tries that hold few texts, and ranges so small that long prefixes divide them.
    monkeypatch.setattr(filter_audit, "_TRIE_BYTES", 100)
    monkeypatch.setattr(filter_audit, "_MOST_PREFIXES", 1000)
    small = filter_audit.audit(table, labels, range_bytes=64)
    same(got(small, *names), expected)


def test_prefixes_grow_until_no_range_is_heavy(spark):
    texts = [f"same beginning {i % 10} {i}".encode() for i in range(400)] + [b"", b"same"]
    table = spark.createDataFrame([(bytearray(t),) for t in texts], "text binary")
    key = filter_audit.adaptive_prefix(table, 1000)
    sizes = table.groupBy(key.alias("k")).agg(F.sum(F.octet_length("text")).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 1000
    assert 10 <= sizes.count() <= 20


def test_tries_hold_every_text():
    random = np.random.default_rng(9)
    texts = [bytes(random.choice([97, 98], random.integers(0, 9)).tolist()) for _ in range(500)]
    trie = filter_audit.Trie()
    for i, text in enumerate(texts):
        node = trie.end_of(text)
        node.owner = i if node.owner is None else node.owner
    assert {t: n.owner for t, n in trie.ends()} == {
        t: texts.index(t) for t in set(texts)
    }


def test_packing_scores_neighbours_by_bm25():
    random = np.random.default_rng(8)
    docs = [random.integers(0, 30, random.integers(1, 40)).astype("<u4") for _ in range(50)]
    holders = np.array([sum(t in d for d in docs) for t in range(30)], float)
    mean = sum(map(len, docs)) / 50
    index = packing.InvertedIndex(docs, packing.Statistics(holders, 50, mean))
    for i in (0, 7, 49):
        expected = []
        for d in docs:
            score = 0.0
            for t in set(docs[i].tolist()):
                n = (d == t).sum()
                idf = max(0.0, np.log((50 - holders[t] + 0.5) / (holders[t] + 0.5)))
                score += idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(d) / mean)) if n else 0
            expected.append(score)
        assert index.scores(i) == pytest.approx(expected)
        left = np.ones(50, np.int64)
        left[3] = 0
        order = list(packing._candidates(index, i, left))
        assert order[0] == i and 3 not in order[1:] and len(order) == 50 - (i != 3)
        ranked = [expected[j] for j in order[1:]]
        assert ranked == sorted(ranked, reverse=True)


def test_packing_scores_stay_when_used_documents_leave_the_index():
    random = np.random.default_rng(3)
    docs = [random.integers(0, 40, random.integers(1, 30)).astype("<u4") for _ in range(60)]
    holders = np.array([sum(t in d for d in docs) for t in range(40)], float)
    index = packing.InvertedIndex(docs, packing.Statistics(holders, 60, 15.0))
    before = {i: index.scores(i) for i in range(1, 60, 2)}
    size = len(index.owner)
    used = np.arange(60) % 2 == 1
    for some in (used, used & (np.arange(60) > 30)):
        index.keep(some)
        for i in np.flatnonzero(some).tolist():
            others = some & (np.arange(60) != i)
            assert np.array_equal(index.scores(i)[others], before[i][others])
    assert len(index.owner) < size / 2


def test_packing_fills_a_window_with_the_nearest(spark, encode):
    # Pairs of short texts about one thing each, far apart by id.
    docs = [(i + 100 * k, f"{w} " * 30 + f"note {k}") for i, w in enumerate(
        ["zebra", "quartz", "violin", "harbor", "pepper", "glacier"]) for k in (0, 1)
    ]
    size = max(len(encode(t)) + 1 for _, t in docs)
    pieces = packing.pack(frame(spark, docs), JSON, 0, window=2 * size).collect()
    firsts = defaultdict(list)
    for p in sorted(pieces, key=lambda p: p.offset):
        firsts[p.sequence_id].append(p.doc_id % 100)
    seeds = [x for x in firsts.values() if len(x) > 1]
    assert seeds and sum(x[0] == x[1] for x in seeds) >= len(seeds) - 2


def test_empty_tables(spark):
    docs = frame(spark, [])
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_classifier.train(docs, labels)
    for out in (
        quality_rules.judge(docs),
        quality_classifier.score(docs, model),
        substring_dedup.remove_repeats(docs),
        license_scan.scan(docs),
        simhash.near_duplicates(docs),
        line_dedup.dedup_lines(docs),
        cover_tree.near_duplicates(vectors),
        packing.pack(docs, JSON, 0),
        byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS),
        class_ngrams.score(docs),
        ball_kmeans.compress(vectors)[0],
        filter_audit.audit(docs.withColumn("lang", F.lit("en")), labels.withColumn("toxic", F.lit(0))),
    ):
        assert out.count() == 0


def test_repeated_rows_stay(spark):
    docs = frame(spark, DOCS[:2] * 2)
    assert substring_dedup.deduplicated(docs).count() == 4
    assert line_dedup.deduplicated(docs).count() == 4
    assert simhash.near_duplicates(docs).count() == 4
    assert quality_rules.judge(docs).count() == 4
    assert license_scan.scan(docs).count() == 4
    assert packing.pack(docs, JSON, 0).count() == 4
    assert byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN).count() == 4
