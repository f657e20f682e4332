"""The stages against brute force on a small table, and the whole run."""

import random

import corpus_pipeline
from pyspark.sql import types as T

from journeyloom.llm.substring import cut_repeats
from tests.llm.test_jaccard import brute as brute_groups
from tests.llm.test_substring import brute as brute_words

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))])
FOLDER = "/root/testdata/sf0.001"


def test_stages_on_a_small_table(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 80))) for _ in range(40)]
    texts += [t + " tail" for t in texts[:10]] + [f"{' '.join(rng.choice(words) for _ in range(70))}\n{passage}\tend{i}" for i in range(5)] + [None, ""]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    groups = brute_groups(list(enumerate(texts)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)
    cut = {r.doc_id: r for r in cut_repeats(kept).collect()}
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    import hashlib

    for i, n, gone, digest in brute_words(rows):
        text = cut[i].text
        assert hashlib.sha256(b" ".join((text or "").encode().split())).hexdigest() == digest
        assert (text == texts[i]) == (gone == 0) and (text is None or cut[i].n_chars == len(text))
    assert cut[50].text.endswith(f"{passage}\tend0") and passage not in cut[51].text and cut[51].text.endswith("\nend1")


def test_whole_run(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER).cache()
        assert after.columns == documents.columns, name
        assert 0 < after.count() <= docs.count()
        docs = after
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
