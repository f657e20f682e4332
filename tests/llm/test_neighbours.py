"""Pigeonhole probing against all codes, recall against brute force, odd vectors."""

import numpy as np
from pyspark.sql import types as T

from journeyloom.llm.neighbours import MultiIndex, distances, nearest

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.StringType()), T.StructField("score", T.IntegerType())])


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (700, 4), dtype=np.uint16)
    codes[100:200] = codes[0] ^ (np.uint16(1) << rng.integers(0, 16, (100, 4)).astype(np.uint16)) * rng.integers(0, 2, (100, 4)).astype(np.uint16)
    index = MultiIndex(codes)
    for radius in (0, 1, 3, 4, 9, 22, 30, 64):
        for q in (0, 150, 600):
            assert index.within(codes[q], radius).tolist() == np.flatnonzero(distances(codes[q], codes) <= radius).tolist()


def exact(rows, every=20, k=20):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = np.einsum("ij,j->i", x, x[i])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_recall_and_scores(spark):
    for folder in ("sf0.01", "sf0.1"):
        table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
        rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
        want, got = exact(rows), {}
        for r in nearest(table).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got.keys() == want.keys()
        hits = sum(len({a for a, _ in want[q]} & {a for a, _ in got[q]}) for q in want)
        assert hits >= 0.93 * sum(map(len, want.values()))
        for q in want:
            scores = [s for _, s in got[q]]
            assert scores == sorted(scores, reverse=True)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, None)]
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(docs).orderBy("query_id", "rank").collect()]
    # Both rows of id 20 ask, and each finds the other.
    twice = [x for rank, other in enumerate((0, 1, 2, 20), 1) for x in [(20, rank, other, 0.5)] * 2]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5), (0, 4, 20, 0.5), *twice]
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nearest(docs.where("vec_id = 3")).count() == 0


def test_one_id_with_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr("journeyloom.llm.neighbours.calibrated_radius", lambda *_: 10_000)
    rng = np.random.default_rng(8)
    ids = np.concatenate([np.arange(200), np.full(100, 40)])
    x = rng.integers(-3, 4, (300, 8)).astype(float)
    x[250:] = x[249]
    x[:, 0] += 0.5
    found = nearest(spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>"))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())
    want = []
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:20]
        want += [(int(ids[i]), rank, int(ids[j]), float(scores[j])) for rank, j in enumerate(order, 1)]
    assert got == sorted(want)


def test_every_query_of_a_skewed_table_gets_its_rows(spark, monkeypatch):
    # As the clusters set it.
    monkeypatch.setattr("journeyloom.llm.neighbours.calibrated_radius", lambda *_: 2)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 32))
    x = np.concatenate([centres[rng.integers(0, 40, 3_900)] + 1e-4 * rng.standard_normal((3_900, 32)), rng.standard_normal((40, 32))])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    ids = np.concatenate([np.arange(3_900) * 20 + 1, np.arange(40) * 20])
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)]
    rows += [(20 * i, v) for i, (_, v) in enumerate(rows[:60], 100)]
    want, got = exact(rows), {}
    for r in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert {q: len(v) for q, v in got.items()} == dict.fromkeys(want, 20)
    assert all(len(set(v)) == 20 and q not in v for q, v in got.items())
    assert all(got[q] == [v for v, _ in want[q]] for q in range(0, 800, 20))


def test_the_radius_leaves_out_the_query_only():
    from journeyloom.llm.neighbours import Codes, calibrated_radius

    codes = Codes(np.zeros(2), [np.eye(2)])
    # The longer vector is the best hit of the shorter one, ahead of the query itself.
    assert calibrated_radius(codes, np.array([[1.0, 0.1], [9.0, -0.1], [-1.0, -0.2]]), 1) >= 1
