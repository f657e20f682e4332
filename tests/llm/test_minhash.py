"""MinHash components against all pairs, and the posterior bound against its definition."""

import random
import re

import numpy as np
from pyspark.sql import types as T

from journeyloom.llm import minhash
from journeyloom.llm.minhash import _overlapping, _spanning, kept_documents, least_agreements, minhash_components, signatures, surviving

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("node", T.StringType()), T.StructField("n", T.LongType())])


def brute(rows, size=2, percent=80):
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(lower))
        sets.append(frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else []))
    distinct = list({s for s in sets if s})
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] is not s:
            parent[s] = s = parent[parent[s]]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= percent * len(a | b):
                parent[find(a)] = find(b)
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[find(s)] = min(least.get(find(s), i), i)
    return sorted(((i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(rows, sets, strict=True)), key=repr)


def check(spark, rows, parts=4):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(parts)
    got = sorted((tuple(r) for r in minhash_components(docs).collect()), key=repr)
    assert got == brute(rows)


def test_random_families(spark):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(80)] + ["É", "Long" * 40]
    texts = [None, "", " \n", "One", "one", "one two", "two one", "one two three", "a " * 500]
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 12, 40, 150]))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, 1 + len(text) // 8)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\t", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in text).replace("LONG", "long"))
    rows = list(enumerate(texts)) + [(None, texts[30]), (None, None), (None, "only here and " * 9), (None, "only here and " * 9 + "there"), (12, texts[12]), (5, texts[40])]
    check(spark, rows)


def test_hot_family_and_unlike_texts_in_one_bucket(spark, monkeypatch):
    """A large group of near copies, and many texts of similarity about 0.7 that share its buckets but no link."""
    monkeypatch.setattr(minhash, "BLOCK_SETS", 50)
    monkeypatch.setattr(minhash, "PART_ROWS", 2_000)
    rng = random.Random(9)
    base = [f"b{k}" for k in range(100)]
    texts = []
    for k in range(300):
        text = list(base)
        text[rng.randrange(100)] = f"x{k}"
        texts.append(" ".join(text))
    for k in range(150):
        text = list(base)
        for at in rng.sample(range(0, 100, 2), rng.choice([9, 10, 11])):
            text[at] = f"y{k}-{at}"
        texts.append(" ".join(text))
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)), 7)


def test_no_rows_and_kept(spark):
    assert kept_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(4, "a b c d", "x", 1), (2, "A b  c d", "x", 1), (3, None, "x", 1), (9, "q r", "x", 1)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in kept_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {4: (3, 2, False), 2: (3, 2, True), 3: (0, 3, True), 9: (1, 9, True)}


def test_posterior_bound():
    """The bound is the least m whose Beta posterior reaches the threshold with the chance MISS, by integration."""
    grid = (np.arange(400_000) + 0.5) / 400_000
    for n, least in zip(range(16, 129, 16), least_agreements(80)[1:], strict=True):
        for m, above in ((least, True), (least - 1, False)):
            if m >= 0:
                log = m * np.log(grid) + (n - m) * np.log(1 - grid)
                density = np.exp(log - log.max())
                assert (density[grid >= 0.8].sum() / density.sum() >= minhash.MISS) == above


def test_agreement_estimates_similarity_and_true_pairs_survive():
    rng = np.random.default_rng(3)
    agree, survived = [], 0
    for _ in range(200):
        both, own = rng.integers(0, 2**63, 160, dtype=np.uint64), rng.integers(0, 2**63, 40, dtype=np.uint64)
        a, b = np.concatenate((both, own[:20])), np.concatenate((both, own[20:]))
        sig = signatures(np.concatenate((a, b)), np.array([0, 180, 360]))
        agree.append((sig[0] == sig[1]).mean())
        survived += len(surviving(sig, sig, np.array([0]), np.array([1]), least_agreements(80)))
    assert abs(np.mean(agree) - 0.8) < 0.01 and survived == 200


def test_links_of_a_block():
    rng = np.random.default_rng(5)
    left, right = ([np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(12)] for _ in range(2))
    every = [(i, j) for i in range(12) for j in range(12)]
    i, j = (np.array(c) for c in zip(*every, strict=True))
    near = [(a, b) for a, b in every if 100 * len(np.intersect1d(left[a], right[b])) >= 40 * len(np.union1d(left[a], right[b]))]
    a, b = _overlapping(left, right, i, j, 40)
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == near and 0 < len(near) < 144
    none = np.zeros(0, np.int64)
    assert all(len(x) == 0 for x in (*_overlapping(left, right, none, none, 40), *_spanning(none, none, none, none)))
    p, q = np.array([5, 5, 7, 8, 5]), np.array([7, 8, 8, 9, 7])
    assert _spanning(p, q, np.arange(5), np.arange(5))[0].tolist() == [0, 1, 3]
