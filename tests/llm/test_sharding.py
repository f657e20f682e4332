"""Best-fit packing: bins, near equal shards, whole groups, gapless slots, odd rows."""

import random

from pyspark.sql import types as T

from journeyloom.llm.sharding import assign_shards, best_fit_decreasing, pack_into, shard_digests

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("shard", T.StringType())])


def test_best_fit_takes_the_tightest_bin():
    def plain(sizes, capacity):
        rooms, out = [], {}
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fits = [(r, b) for b, r in enumerate(rooms) if r >= sizes[i]]
            b = min(fits)[1] if fits else len(rooms)
            if not fits:
                rooms.append(capacity)
            rooms[b] -= sizes[i]
            out[i] = b
        return [out[i] for i in range(len(sizes))], len(rooms)

    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(1, 60))]
        assert best_fit_decreasing(sizes, 50) == plain(sizes, 50)
    assert len(set(pack_into([5, 5, 5, 5], 2))) == 2 and pack_into([], 3) == []


def test_shards_are_even_and_groups_whole(spark):
    rows = [(i, f"text {i} " * (i % 37), "x") for i in range(3000)] + [(5000 + i, "hot copy " * 40, "x") for i in range(1500)] + [(9000 + i, "small copy", None) for i in range(20)] + [(None, None, None), (7, None, None), (7, "", None)]
    placed = assign_shards(spark.createDataFrame(rows, SCHEMA), shards=8, slot_rows=100).toPandas()
    assert len(placed) == len(rows)
    loads = placed.groupby("shard")["size"].sum()
    assert len(loads) == 8 and loads.max() <= 1.01 * loads.mean()
    spread = placed.groupby("group").shard.nunique()
    assert (spread[spread.index != placed.group.value_counts().idxmax()] == 1).all()
    for _, own in placed.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_few_and_no_rows(spark):
    assert shard_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    one = shard_digests(spark.createDataFrame([(1, None, None)], SCHEMA)).collect()
    assert [(r["size"], r["text_crc32"], r["slot"]) for r in one] == [(8, 0, 0)]
