"""Periodic runs against every stretch and period."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import types as T

from journeyloom.llm.runs import find_runs, periodic_runs, run_digests

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("start", T.StringType()), T.StructField("runs", T.LongType())])


def brute_runs(words):
    n, found = len(words), {}
    for p in range(n // 2, 0, -1):
        i = p
        while i < n:
            if words[i] != words[i - p]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - p]:
                j += 1
            if j - i + p >= max(12, 2 * p):
                found[i - p, j] = p
            i = j
    return sorted((s, e - s, p) for (s, e), p in found.items())


def brute(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + m for s, m, p in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def made(rng, vocabulary):
    words = []
    while len(words) < rng.randint(1, 300):
        root = [rng.choice(vocabulary) for _ in range(rng.randint(1, rng.choice([2, 6, 12, 40])))]
        if rng.random() < 0.3:
            root = root * rng.randint(2, 4) + [rng.choice(vocabulary)]
        words += (root * rng.randint(1, 5))[: rng.randint(1, 200)]
    return words


def test_runs_of_arrays_equal_all_stretches():
    rng = random.Random(5)
    for size in (1, 2, 3, 8):
        docs = [[rng.randrange(size) for _ in range(rng.randint(0, 120))] if rng.random() < 0.4 else made(rng, list(range(size))) for _ in range(120)]
        first = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
        words = np.array([w for d in docs for w in d], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        start, end, period = find_runs(words, first)
        got = sorted(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True))
        want = sorted((s + int(f), m, p) for d, f in zip(docs, first, strict=False) for s, m, p in brute_runs(d))
        assert got == want


def test_thue_morse_and_fibonacci_words():
    thue = [bin(i).count("1") % 2 for i in range(1400)]
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    for words in (thue, b):
        start, end, period = find_runs(np.array(words, np.uint64), np.array([0, len(words)]))
        assert sorted(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True)) == brute_runs(words)


def test_one_word_a_million_times():
    start, end, period = find_runs(np.full(1_000_000, 7, np.uint64), np.array([0, 1_000_000]))
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [1_000_000], [1])


def test_rows_equal_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["a", "b", "é", "long" * 30, "x,", "7"]
    texts = [None, "", "   \n", "one", "a " * 11, "a " * 12, "\x1c b " * 20, "a b " * 3000, " ".join(str(k) for k in range(9000))]
    texts += [rng.choice([" ", "\t", "\n "]).join(made(rng, vocabulary[: rng.randint(1, 6)])) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, texts[20]), (None, None), (25, texts[25]), (-4, texts[30]), (2**62, texts[31])]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in run_digests(periodic_runs(docs, planted=True)).collect()), key=repr)
    assert got == sorted((brute(i, t) for i, t in rows), key=repr)


def test_kept_words_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "go " * 12 + "on", "x", 1), (2, "go " * 11 + "on", "x", 1)], SCHEMA)
    got = {r.doc_id: (r.n_words, bytes(r.kept).decode(), len(r.runs)) for r in periodic_runs(docs).collect()}
    assert got == {1: (13, "go on", 1), 2: (12, "go " * 11 + "on", 0)}
    assert run_digests(periodic_runs(spark.createDataFrame([], SCHEMA))).count() == 0
