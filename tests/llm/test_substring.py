"""Repeated windows by FM-index against a dictionary of all windows."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import types as T

from journeyloom.llm.substring import FmIndex, without_repeats

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("first", T.StringType()), T.StructField("spans", T.LongType())])


def brute(rows, window=13):
    least = {}
    split = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            least[w] = min(least.get(w, i), i)
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if least[tuple(words[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_equals_all_windows(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "long" * 40]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(10, 60))] for _ in range(12)]
    texts = [None, "", "few words", "a " * 400, "a " * 90 + "b", "\x1cx y z " * 9]
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts += rng.choice(passages) if rng.random() < 0.4 else [rng.choice(vocabulary) + str(rng.randrange(10**rng.randint(0, 4))) for _ in range(rng.randint(1, 40))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    texts += [" ".join(passages[0] * 2)] * 60 + texts[10:30]
    rows = list(enumerate(texts))
    rows += rows[40:45] + [(7, texts[50]), (9, texts[60])]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(4)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in without_repeats(docs).collect())
    assert got == brute(rows)


def test_null_ids_and_no_rows(spark):
    assert without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"v{k}" for k in range(20))
    got = {r.doc_id: r.n_removed for r in without_repeats(spark.createDataFrame([(None, text, "x", 1), (5, text, "x", 1)], SCHEMA)).collect()}
    assert got == {None: 20, 5: 0}


def test_backward_search_finds_every_run():
    rng = np.random.default_rng(4)
    for alphabet in (1, 2, 7, 40):
        text = np.concatenate((rng.integers(0, alphabet, 500), rng.integers(0, alphabet, 60).repeat(2), [alphabet - 1]))
        text = np.append(np.unique(text, return_inverse=True)[1] + 1, 0)
        index, starts = FmIndex(text), np.arange(len(text) - 14)
        low, high = index.search(text, starts, 13)
        runs = [tuple(text[i : i + 13]) for i in range(len(text) - 13)]
        for i in starts:
            count = runs.count(runs[i])
            assert (high[i] - low[i] == count) if count > 1 else high[i] - low[i] <= 1
        repeated = [i for i in starts if runs.count(runs[i]) > 1]
        assert len({low[i] for i in repeated}) == len({runs[i] for i in repeated})
