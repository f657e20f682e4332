"""Leaks: copies, re-parameterised questions, inconsistent slots, clean texts, odd rows."""

import random

from pyspark.sql import types as T

from journeyloom.llm.decontaminate import leaks, without_leaks

DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("hash", T.StringType()), ("item_id", T.StringType()), ("place", T.IntegerType()))])
ITEMS = "item_id long, text string, doc_id string"
QUESTION = "A train leaves the station with Maria Lopez at 60 km per hour and after 3 hours Maria Lopez has read 120 pages of her book about the old town near the river"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS)


def test_kinds_of_copies(spark):
    changed = QUESTION.replace("Maria Lopez", "Tom").replace("60 km", "75 miles").replace("120", "98")
    muddled = QUESTION.replace("Maria Lopez at", "Tom at").replace("60 km", "75 miles").replace("Maria Lopez has", "Eve has").replace("120", "98")
    rows = [(1, f"Some words before. {QUESTION} and then some."), (2, f"x y z {changed}. More text follows here"), (3, muddled), (4, "A train leaves the station and nothing else happens in this text at all"), (5, QUESTION.upper()), (6, f"{QUESTION[:90]}"), (1, "a repeated id without it")]
    got = {r.doc_id: r for r in leaks(docs_of(spark, rows), spark.createDataFrame([(7, QUESTION, "c"), (7, QUESTION, "d"), (8, "the short item here", "e"), (9, "tiny", "f"), (10, None, "g")], ITEMS)).collect()}
    assert set(got) - {3, 5, 6} == {1, 2}
    assert got[1].verbatim and got[1].consistency == 1 and not got[2].verbatim and got[2].consistency == 1
    assert got[1].first_word >= 3 and got[1].matched_tokens == got[1].item_tokens
    assert 3 not in got or got[3].consistency < 1


def test_given_benchmark_is_found_and_clean_texts_stay(spark):
    folder = "/root/testdata/sf0.1"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()}
    texts, questions = docs.select("doc_id", "text").collect(), items.collect()
    want = {(d.doc_id, q.item_id) for q in questions for d in texts if q.text in (d.text or "")}
    assert want <= found
    assert len({d for d, _ in found} - {d for d, _ in want}) <= 0.002 * len(texts)
    assert without_leaks(docs, items).count() == len(texts) - len({d for d, _ in found})


def test_odd_tables(spark):
    rng = random.Random(1)
    long_text = " ".join(rng.choice(["12", "Ab", "kg", "word", "x."]) for _ in range(60_000))
    rows = [(1, None), (2, ""), (None, QUESTION), (3, long_text), (4, QUESTION), (4, QUESTION)]
    docs, items = docs_of(spark, rows), spark.createDataFrame([(1, QUESTION, "a"), (2, "12 13 14 15 16 17 18 19 20", "b")], ITEMS)
    assert [(r.doc_id, r.item_id) for r in leaks(docs, items).collect()] == [(4, 1)]
    left = without_leaks(docs, items)
    assert left.columns == docs.columns and left.count() == 4
    assert leaks(docs_of(spark, []), items).count() == 0
    assert leaks(docs, spark.createDataFrame([], ITEMS)).count() == 0


def items_of(spark, *texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts, 1)], ITEMS)


def test_names_and_words_that_open_a_sentence(spark):
    apples = "Tom has 5 apples. Tom buys 3 more apples from Ann. How many apples does Tom have?"
    decide = "Decide whether the given number is odd"
    rows = [
        (1, apples.replace("Tom", "Sam").replace("5", "7").replace("3", "2").replace("Ann", "Eve")),
        (2, f"we were told, {decide}, and so we did"),
        (3, f"we were told, {decide.lower()}, and so we did"),
        (4, f"First. {decide}. Last."),
        (5, "Sam has a dog. Ann buys more bread from a shop. How many days does it last?"),
        (6, f"we ask: {apples}"),
    ]
    got = {(r.doc_id, r.item_id): r for r in leaks(docs_of(spark, rows), items_of(spark, apples, decide)).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 2), (4, 2), (6, 1)}
    assert got[1, 1].matched_tokens == got[1, 1].item_tokens == 17 and not got[1, 1].verbatim
    assert got[6, 1].verbatim and got[4, 2].verbatim and got[3, 2].verbatim


def test_items_that_are_mostly_slots(spark):
    powers, numbers = "Find the next term: 2, 4, 8, 16, 32, 64, 128, 256", "3 1 4 1 5 9 2 6 5 3"
    rows = [(1, f"so {powers}. And"), (2, f"x {numbers}, y"), (3, "7 8 9 1 2 3 4 5 6 7 8 9 1 2"), (4, "Find the next term: 1, 3, 5, 7, 9, 11, 13, 15")]
    got = {(r.doc_id, r.item_id): r for r in leaks(docs_of(spark, rows), items_of(spark, powers, numbers)).collect()}
    assert set(got) == {(1, 1), (2, 2)}
    assert got[1, 1].matched_tokens == got[1, 1].item_tokens == 12 and got[1, 1].verbatim


def test_any_consistent_place_is_a_leak(spark):
    muddled = QUESTION.replace("Maria Lopez at", "Tom at").replace("60 km", "75 miles").replace("Maria Lopez has", "Eve has").replace("120", "75").replace("after 3", "after 75")
    most = QUESTION[: QUESTION.index(" near the river")].replace("Maria Lopez", "Tom").replace("60 km", "75 miles")
    far = " ".join(["filler"] * 200)
    rows = [(1, f"x {muddled} {far} y {most} z"), (2, f"x {most} {far} y {muddled} z"), (3, f"x {muddled} y {most} z")]
    assert {r.doc_id for r in leaks(docs_of(spark, rows), items_of(spark, QUESTION)).collect()} == {1, 2, 3}
