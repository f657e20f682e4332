"""Sharding by best-fit-decreasing bin packing over groups of equal texts.

Groups that weigh at least one crumb enter the packing by themselves; lighter ones are first gathered by hash
into ``bins * crumbs`` crumbs of about equal weight, so the packed list has a size fixed by parameters however many
documents there are. A group heavier than a bin is cut into bin-sized parts of whole rows. The bin capacity is the
smallest one, found by bisection, for which best fit needs no more than the wanted number of bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window, functions as F

from journeyloom.llm.texts import only

ROW_BYTES = 8


def best_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """Bin of each size and the number of bins; an item enters the bin with the least remaining room that holds it.

    Open bins stay in one ordered structure of (room, bin), searched and updated in logarithmic time.
    """
    rooms: list[tuple[int, int]] = []
    chosen, bins = [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(rooms, (sizes[i], -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room, b, bins = capacity, bins, bins + 1
        chosen[i] = b
        insort(rooms, (room - sizes[i], b))
    return chosen, bins


def pack_into(sizes: list[int], bins: int) -> list[int]:
    """Best-fit-decreasing into at most ``bins`` bins of the smallest capacity that allows it."""
    if not sizes:
        return []
    low = max(max(sizes), -(-sum(sizes) // bins))
    high = low
    while best_fit_decreasing(sizes, high)[1] > bins:
        high += max(1, high // 8)
    while low < high:
        middle = (low + high) // 2
        if best_fit_decreasing(sizes, middle)[1] <= bins:
            high = middle
        else:
            low = middle + 1
    return best_fit_decreasing(sizes, high)[0]


def assign_shards(docs: DataFrame, shards: int = 24, crumbs: int = 256, slot_rows: int = 100_000) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its group, size, shard and slot.

    Equal texts form a group and share a shard; only a group heavier than a shard's fair share is cut, into the fewest
    parts. NULL and empty texts are groups of their own (NULL counts as empty); repeated rows and tied ids
    each get a slot; no rows give no rows. Only group weights above one crumb and the crumb totals reach the driver:
    at most ``2 * shards * crumbs`` rows.
    """
    rows = only(docs, "doc_id", "text").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("group"),
    )
    groups = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size")).withColumn("weight", F.col("n") * F.col("size"))
    total, _ = (groups.agg(F.sum("weight"), F.count(F.lit(1))).first())
    total = int(total or 0)
    fair = max(1, -(-total // shards))
    crumb = max(1, fair // crumbs)
    n_crumbs = shards * crumbs
    # Light groups fall into crumbs by hash; a heavy group is a set of parts of whole rows.
    hashed = F.pmod(F.xxhash64("group"), F.lit(n_crumbs)).cast("int")
    light = groups.where(F.col("weight") < crumb).groupBy(hashed.alias("crumb")).agg(F.sum("weight").alias("weight")).collect()
    heavy = groups.where(F.col("weight") >= crumb).select("group", "n", "size").collect()
    items: list[tuple[tuple, int]] = [((r["crumb"],), int(r["weight"])) for r in light]
    for r in sorted(heavy, key=lambda r: r["group"]):
        parts = -(-r["n"] * r["size"] // fair)
        whole = r["n"] if parts == 1 else max(1, fair // r["size"])
        for part, first in enumerate(range(0, r["n"], whole)):
            items.append(((r["group"], part, whole), min(whole, r["n"] - first) * r["size"]))
    chosen = pack_into([w for _, w in items], shards)
    spark = docs.sparkSession
    crumb_rows = [(k[0], b) for (k, _), b in zip(items, chosen, strict=True) if len(k) == 1]
    heavy_rows = [(k[0], k[1], k[2], b) for (k, _), b in zip(items, chosen, strict=True) if len(k) == 3]
    of_crumb = spark.createDataFrame(crumb_rows, "crumb int, light_shard int")
    of_heavy = spark.createDataFrame(heavy_rows, "group string, part int, whole long, heavy_shard int")
    wholes = of_heavy.groupBy("group").agg(F.first("whole").alias("whole"), F.max("part").alias("parts"))
    # Both lists are bounded by the parameters (see above), so they are broadcast.
    marked = rows.withColumn("crumb", hashed).join(F.broadcast(wholes), "group", "left")
    cut = marked.where(F.col("parts") > 0)
    numbered = _numbered(cut, ["group"], "at", slot_rows)
    parted = numbered.withColumn("part", F.floor(F.col("at") / F.col("whole")).cast("int"))
    plain = marked.where(F.coalesce("parts", F.lit(0)) == 0).withColumn("part", F.when(F.col("whole").isNotNull(), 0))
    every = plain.select("doc_id", "size", "text_crc32", "group", "crumb", "part").unionByName(
        parted.select("doc_id", "size", "text_crc32", "group", "crumb", "part")
    )
    placed = (
        every.join(F.broadcast(of_heavy.drop("whole")), ["group", "part"], "left")
        .join(F.broadcast(of_crumb), "crumb", "left")
        .select("doc_id", "size", "text_crc32", "group", F.coalesce("heavy_shard", "light_shard").alias("shard"))
    )
    return _numbered(placed, ["shard"], "slot", slot_rows)


def _numbered(df: DataFrame, keys: list[str], name: str, per_task: int) -> DataFrame:
    """Rows numbered from 0 within ``keys``; a key's rows are spread over hash blocks, numbered block after block.

    The number of blocks follows the row count, so no task holds much more than ``per_task`` rows of one key.
    """
    blocks = max(1, -(-df.count() // per_task))
    df = df.withColumn("_block", F.pmod(F.xxhash64("doc_id", "group"), F.lit(blocks)).cast("int"))
    inner = Window.partitionBy(*keys, "_block").orderBy("doc_id", "group")
    counts = df.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("_base", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    ranked = df.withColumn("_rank", F.row_number().over(inner) - 1)
    return ranked.join(bases, [*keys, "_block"]).withColumn(name, (F.col("_base") + F.col("_rank")).cast("long")).drop("_base", "_rank", "_block")


def shard_digests(docs: DataFrame, shards: int = 24) -> DataFrame:
    """The registered query's columns: sizes near equal (law ``bytes``)."""
    return assign_shards(docs, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """Writes ``docs`` (unique doc_id) under ``path`` as one folder per shard, in slot order."""
    placed = assign_shards(docs, shards).select(F.col("doc_id").alias("_id"), "shard", "slot")
    joined = docs.join(placed, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    joined.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
