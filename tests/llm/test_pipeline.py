"""The pipeline's stages, each against its plain definition on what came before."""

import hashlib
from collections import Counter

import brute
import corpus_pipeline
from pyspark.sql import functions as F
from test_operators import DOCS

FOLDER = "/root/testdata/sf0.001"


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda d: brute.order(d[0]))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_every_stage_of_a_run(spark, tmp_path, monkeypatch):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 40")
    odd = [(None if k is None else k + 1_000_000, text) for k, text in DOCS]
    docs = given.select("doc_id", "text").union(
        spark.createDataFrame(odd, "doc_id long, text string")
    )
    docs.withColumn("key", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    stored, store = {}, corpus_pipeline.materialize

    def kept(df, name):
        stored[name] = store(df, name)
        return stored[name]

    monkeypatch.setattr(corpus_pipeline, "materialize", kept)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    good, lines, single, passages = (texts(df) for df in stored.values())
    assert not Counter(good) - Counter(texts(docs)) and good

    stay = dict(brute.every_line(good))
    assert lines == [
        (k, t and "\n".join(t.split("\n")[i] for i in stay[k])) for k, t in good
    ]
    heads = [k for k, _, component in brute.simhash(lines) if k == component]
    assert single == [(k, t) for k, t in lines if k in heads]
    found = dict(passages)
    assert list(found) == [k for k, _ in single]
    for (key, _, gone, kept_sha), (_, text) in zip(brute.substring(single), single, strict=True):
        assert (sha(found[key]) == kept_sha) if gone else (found[key] == text)
    placed = Counter()
    for p in pieces:
        placed[p.doc_id] += p.length
    assert placed == Counter({p.doc_id: p.doc_tokens for p in pieces})
    assert set(placed) == set(found)
