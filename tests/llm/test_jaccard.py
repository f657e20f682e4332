"""The T-occurrence join against all pairs compared in plain Python."""

import random
import re

import numpy as np
from pyspark.sql import types as T

from journeyloom.llm.graph import components
from journeyloom.llm.jaccard import jaccard_components, overlap_counts

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("node", T.StringType())])


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(x), root(i)) for i, x in sets}


def mutated(rng, words, share):
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(10**6)) if rng.random() < share else w for w in words)


def test_join_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"W{k}" for k in range(400)]
    texts = ["", None, "one two", "One  TWO\n", "É five words are here", "é five words are here", "a b c d e", "a b c d e f"]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(8, 90))]
        for _ in range(rng.randint(1, 5)):
            texts.append(mutated(rng, base, rng.choice([0, 0.01, 0.03, 0.06])))
    hot = [rng.choice(vocabulary) for _ in range(60)]
    texts += [mutated(rng, hot, rng.choice([0, 0.02, 0.05])) for _ in range(400)]
    texts += [" ".join([rng.choice(vocabulary) for _ in range(rng.randint(1, 40))] + passage) for _ in range(200)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    assert got == brute(rows)


def test_odd_tables(spark):
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(3, "same text here", None), (3, "same text here", None), (None, "same text here", "x"), (4, None, None)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(-1, 1, 3), (3, 1, 3), (3, 1, 3), (4, 0, 4)]


def test_merge_and_probe_counts():
    rng = np.random.default_rng(2)
    for _ in range(200):
        x = np.unique(rng.integers(0, 60, 40).astype(np.uint64))
        ys = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(3)]
        least = [int(rng.integers(1, 30)) for _ in ys]
        want = [n if n >= t else 0 for n, t in ((len(np.intersect1d(x, y)), t) for y, t in zip(ys, least, strict=True))]
        assert overlap_counts(x, ys, least) == want


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(5)
    want = {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
    assert {r.node: r.component for r in components(table).collect()} == want
    assert {r.node: r.component for r in components(table, part_edges=90).collect()} == want
