"""Code lengths against a plain recursive model, held-out accuracy, odd rows."""

import math
import random
import zlib
from collections import Counter

from pyspark.sql import types as T

from journeyloom.llm.language import ORDER, grow_trees, identify_languages

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("score", T.StringType()))])


def spaced(text):
    cleaned = "".join(c.lower() if c.isascii() and c.isalnum() else (c if ord(c) > 127 else " ") for c in text)
    return [b" " + w.encode() + b" " for w in cleaned.split()]


def plain_bits(training, text):
    counts = Counter()
    for t in training:
        for w in spaced(t):
            for i in range(1, len(w)):
                for order in range(min(i, ORDER) + 1):
                    counts[(w[i - order : i], w[i])] += 1
    total = 0.0
    for w in spaced(text):
        for i in range(1, len(w)):
            for order in range(min(i, ORDER), -1, -1):
                context = w[i - order : i]
                own = {b: n for (c, b), n in counts.items() if c == context}
                n, q = sum(own.values()), len(own)
                if w[i] in own:
                    total += math.log2((n + q) / own[w[i]])
                    break
                if n:
                    total += math.log2((n + q) / q)
            else:
                total += 8
    return total


def made(rng, stems, n):
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_scores_are_exact_posteriors(spark):
    rng = random.Random(1)
    stems = {"aa": ["ka", "lo", "é", "mi"], "bb": ["ka", "ru", "ß", "te"]}
    rows = [(i, made(rng, stems[lang], 12), lang, "s", "x") for i, lang in enumerate(["aa", "bb"] * 20)]
    texts = {"aa": [], "bb": []}
    for i, text, lang, *_ in rows:
        if zlib.crc32(str(i).encode()) % 5:
            texts[lang].append(text)
    rows += [(1000, "Kalo RUTE! éß zz", None, None, None), (1001, "ka", None, "", "")]
    got = {r.doc_id: r for r in identify_languages(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, text in ((1000, rows[-2][1]), (1001, "ka"), (3, rows[3][1])):
        bits = {k: plain_bits(v, text) for k, v in texts.items()}
        best = min(sorted(bits), key=bits.get)
        assert got[i].lang_pred == best
        assert math.isclose(got[i].score, 1 / sum(2 ** (bits[best] - b) for b in bits.values()), rel_tol=1e-9)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)


def test_odd_rows(spark):
    assert identify_languages(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, "en", None, None), (2, "", "en", None, None), (3, "12 !?", "en", None, None), (4, "the cat", "en", None, None), (4, "the cat", "en", None, None), (None, "字", None, None, None)]
    got = sorted((r.doc_id or 0, r.lang_pred) for r in identify_languages(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify_languages(docs).alias("p").join(docs.alias("d"), "doc_id").where("held_out and lang is not null").selectExpr("avg(cast(lang_pred = lang as int))").first()[0]
    assert found > 0.97


def test_empty_training(spark):
    assert grow_trees(spark.createDataFrame([], "key long, text string, lang string")).languages == []
