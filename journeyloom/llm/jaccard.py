"""Exact n-gram Jaccard join by T-occurrence search with short lists merged and long lists probed.

A text's shingle set x can only reach similarity t with sets that share T = ceil(t |x|) of its shingles. As in
DivideSkip, the long inverted lists (frequent shingles, estimated on a sample) are kept out of candidate search as far as
T allows: all shingles are put in one order, rare ones first, and the first |x| - T + 1 of each set are its short
lists. Two similar sets share at least one of them, and more when their sizes are close, so the counts over the merged
short lists select the pairs; the remaining lists are then probed by binary search until the required overlap
is reached or out of reach. Equal sets are one node throughout.

Nodes that consist of frequent shingles only (large groups of near copies) have long lists even so. Those lists are
split by salt and only neighbours in a part are compared, in rounds. What then still shares such lists with other
components is compared in full, in blocks: the lists of one block are merged for every node of the other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from journeyloom.llm.graph import components, keep_keys, stored
from journeyloom.llm.texts import mix, only, run_hashes, signed, word_slices

WORDS, PERCENT = 5, 75
#: Texts sampled to find frequent shingles: one in SAMPLE, by hash of the text.
SAMPLE = 16
#: A shingle seen in this many sampled texts has a long list (about 80 texts of the corpus).
LONG_IN_SAMPLE = 5
#: At most so many shingles (the most frequent) are treated as long; a missed one only makes its list slower.
MAX_LONG = 1_000_000
PART_POSTINGS = 800_000
SALTED = 64
PARTNERS, ROUNDS = 3, 2
#: Nodes of a block where nodes that share frequent lists are compared in full.
BLOCK_NODES = 1_024


def required(n, percent: int = PERCENT):
    """Smallest overlap of a set of ``n`` shingles with any similar set."""
    return (percent * n + 99) // 100


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row; fewer words than a shingle are one whole."""
    for row, stop, found in word_slices(texts, lower=True):
        h, first = found.hashes(), found.first
        runs = run_hashes(h, words)
        for i in range(stop - row):
            a, b = first[i], first[i + 1]
            if b - a >= words:
                s = np.sort(runs[a : b - words + 1])
                yield row + i, s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                yield row + i, mix(run_hashes(h[a:b], b - a) + np.uint64(b - a))
            else:
                yield row + i, np.zeros(0, np.uint64)


def _digest(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over a set."""
    with np.errstate(over="ignore"):
        return int(signed(np.array([mix(s).sum()]))[0]), int(signed(np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum()]))[0])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = {_digest(s)[0]: s for _, s in shingle_sets(batch.column(0)) if len(s)}
        nodes = np.repeat(np.array(list(sets), np.int64), [len(s) for s in sets.values()])
        tokens = np.concatenate(list(sets.values())) if sets else np.zeros(0, np.uint64)
        yield pa.record_batch([pa.array(signed(tokens)), pa.array(nodes)], ["token", "node"])


def _ordered(s: np.ndarray, long: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, bool]:
    """The set's short lists, rare shingles first, and whether frequent ones are among them."""
    size = len(s) - required(len(s), percent) + 1
    at = np.searchsorted(long, s)
    at[at == len(long)] = 0
    frequent = long[at] == s if len(long) else np.zeros(len(s), bool)
    if not frequent.any():
        return s[:size], False
    rare, often = s[~frequent], s[frequent]
    often = often[np.lexsort((often, rank[at[frequent]]))]
    return np.concatenate((rare, often))[:size], len(rare) < size


def _described(long: np.ndarray, rank: np.ndarray, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for _, s in shingle_sets(batch.column("text")):
                node, check = _digest(s)
                short, hot = _ordered(s, long, rank, percent) if len(s) else (s, False)
                for column, value in zip(out, (len(s), node, check, hot, short.tobytes()), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(out, types, strict=True)]], ["doc_id", "n", "node", "check", "hot", "short"])

    return run


def _postings(long: np.ndarray, counts: np.ndarray, frequent: bool, salt: int):
    """(list, node, n, hot) of the rare or the frequent short lists; a frequent one is split into salted parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, at = np.unique(batch.column("node").to_numpy(), return_index=True)
            batch = batch.take(pa.array(at))
            blobs = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column("short")]
            lengths = [len(b) for b in blobs]
            tokens = np.concatenate(blobs) if blobs else np.zeros(0, np.uint64)
            if len(long):
                place = np.searchsorted(long, tokens)
                place[place == len(long)] = 0
                often = long[place] == tokens
            else:
                place, often = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
            node = np.repeat(nodes, lengths)
            n, hot = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), lengths) for c in ("n", "hot"))
            keep = often if frequent else ~often
            tokens, node, n, hot = tokens[keep], node[keep], n[keep], hot[keep]
            lists = tokens
            if frequent and salt >= 0:
                parts = 1 + (counts[place[keep]] * SAMPLE // SALTED).astype(np.uint64)
                lists = mix(tokens + mix(mix(node.view(np.uint64) ^ tokens) + np.uint64(salt)) % parts)
            yield pa.record_batch([pa.array(signed(lists)), pa.array(node), pa.array(n), pa.array(hot)], ["list", "node", "n", "hot"])

    return run


def _merged_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of two nodes and more of one partition, equal ones once with their number (``times``)."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
    if not parts:
        return
    token, node, n, hot = (np.concatenate(c) for c in zip(*parts, strict=True))
    del parts
    order = np.lexsort((node, token))
    token, node, n, hot = token[order], node[order], n[order], hot[order]
    if not len(token):
        return
    new = np.concatenate(([True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])))
    token, node, n, hot = token[new], node[new], n[new], hot[new]
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    length = np.diff(np.append(first, len(token)))
    sign = np.add.reduceat(mix(node.view(np.uint64)), first) + mix(length.astype(np.uint64))
    many = np.flatnonzero(length > 1)
    names, at, times = np.unique(sign[many], return_index=True, return_counts=True)
    for low in range(0, len(names), 20_000):
        some = many[at[low : low + 20_000]]
        rows = np.concatenate([np.arange(first[i], first[i] + length[i]) for i in some]) if len(some) else np.zeros(0, np.int64)
        fill = lambda x: np.repeat(x[low : low + 20_000], length[some])
        yield pa.record_batch([pa.array(signed(fill(names))), pa.array(fill(times)), pa.array(node[rows]), pa.array(n[rows]), pa.array(hot[rows])], ["list", "times", "node", "n", "hot"])


def overlap_counts(query: np.ndarray, candidates: list[np.ndarray], least: list[int]) -> list[int]:
    """Exact overlaps of ``query`` with the candidates that reach ``least``, 0 for the others.

    The query's shortest lists (over the candidates) are merged through a heap; a candidate that can still reach its
    threshold has the remaining lists probed in its sorted set by binary search.
    """
    size = len(query)
    skipped = max(0, min(least) - 1)
    # A query shingle's list holds the candidates that contain it; the lists of the first size - skipped are merged.
    merged = query[: size - skipped]
    streams = [zip(c[np.isin(c, merged, assume_unique=True)].tolist(), [k] * len(c), strict=False) for k, c in enumerate(candidates)]
    counts = [0] * len(candidates)
    for _, k in heapq.merge(*streams):
        counts[k] += 1
    rest = query[size - skipped :]
    for k, c in enumerate(candidates):
        if counts[k] and counts[k] + len(rest) >= least[k] and len(c):
            at = np.searchsorted(c, rest)
            at[at == len(c)] = 0
            counts[k] += int((c[at] == rest).sum())
        if counts[k] < least[k]:
            counts[k] = 0
    return counts


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {}
        for _, s in shingle_sets(batch.column("text")):
            found[_digest(s)[0]] = s.tobytes()
        yield pa.record_batch([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["node", "tokens"])


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(c) for c in ("x", "y"))
            for x, y in zip(*columns, strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                total = len(x) + len(y)
                least = -(-percent * total // (100 + percent))
                keep.append(overlap_counts(x, [y], [least])[0] > 0)
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return run


def _token_sets(rows: DataFrame, table: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, tokens) of the wanted nodes, from the text of one document for each."""
    ids = stored(table.join(nodes, "node", "left_semi").groupBy("node", "check").agg(F.min("doc_id").alias("doc_id")).select("doc_id"), "ids")
    sets = keep_keys(rows.where(F.col("doc_id").isNotNull()), ids, "doc_id").select("text").mapInArrow(_blobs, "node long, tokens binary")
    return sets.groupBy("node").agg(F.first("tokens").alias("tokens"))


def similar_pairs(rows: DataFrame, table: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The stored pairs (a, b) of nodes whose sets reach the similarity."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _token_sets(rows, table, nodes)
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return stored(both.select("a", "b", "x", "y").mapInArrow(_verified(percent), "a long, b long"), "links")


def _near(a: str, b: str, percent: int) -> F.Column:
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    A text without words (or NULL) has no shingle and links with nothing. Equal sets link. Repeated rows come out as
    often as they go in; a NULL doc_id keeps its row and gets the smallest id linked with its text.
    No rows give no rows.
    """
    rows = only(docs, "doc_id", "text")
    spark = docs.sparkSession
    sampled = rows.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(_sampled, "token long, node long")
    common = sampled.distinct().groupBy("token").count().where(F.col("count") >= LONG_IN_SAMPLE)
    found = common.orderBy(F.desc("count"), "token").limit(MAX_LONG).toPandas()
    long = found["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(long)
    long, counts = long[order], found["count"].to_numpy(np.int64)[order]
    table = stored(rows.mapInArrow(_described(long, counts, percent), "doc_id long, n long, node long, check long, hot boolean, short binary"), "sets")
    size = table.agg(F.sum("n")).first()[0] or 0
    parts = max(1, int(size * (100 - percent) / 100 / PART_POSTINGS) + 1)
    full = table.where("n > 0").select("node", "n", "hot", "short")
    postings, lists = "list long, node long, n long, hot boolean", "list long, times long, node long, n long, hot boolean"

    rare = full.mapInArrow(_postings(long, counts, False, 0), postings).repartition(parts, "list").mapInArrow(_merged_lists, lists)
    rare = stored(rare.groupBy("list", "node").agg(F.sum("times").alias("times"), F.first("n").alias("n"), F.first("hot").alias("hot")), "lists")
    one, two = (rare.select("list", "times", *[F.col(c).alias(f"{c}_{k}") for c in ("node", "n", "hot")]) for k in ("a", "b"))
    pairs = one.join(two.drop("times"), "list").where("node_a < node_b").where(_near("n_a", "n_b", percent))
    # Sharing c short lists allows an overlap of c + T - 1 at most, T of the larger set; the pair needs its own overlap.
    bound = F.expr(f"({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent} - ({percent} * greatest(n_a, n_b) + 99) div 100 + 1")
    counted = pairs.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(
        F.sum("times").alias("c"), F.first(bound).alias("bound"), F.first(F.expr("hot_a and hot_b")).alias("hot")
    )
    counted = stored(counted.where("hot or c >= bound").select("a", "b", "c"), "pairs")
    best = Window.partitionBy("a").orderBy(F.desc("c"), "b")
    first = counted.withColumn("r", F.row_number().over(best)).where(F.col("r") <= PARTNERS).select("a", "b")
    hot = stored(full.where("hot"), "hot")
    any_hot = hot.limit(1).count() > 0
    if any_hot:
        first = first.unionByName(_neighbours(hot, long, counts, percent, 0, None)).distinct()
    links = similar_pairs(rows, table, stored(first, "first"), percent)
    joined = components(links)
    for salt in range(1, ROUNDS if any_hot else 1):
        more = stored(_neighbours(hot, long, counts, percent, salt, joined), "more")
        links = links.unionByName(similar_pairs(rows, table, more, percent))
        joined = components(links)
    if any_hot:
        links = links.unionByName(stored(_across(rows, table, hot, long, counts, joined, percent), "across"))
        joined = components(links)
    rest = stored(_apart(counted.select("a", "b"), joined), "rest")
    if rest.limit(1).count():
        links = links.unionByName(similar_pairs(rows, table, rest, percent))
        joined = components(links)
    # Back to documents: the smallest id of each set, then of each component.
    sets = table.groupBy("node", "check", "n").agg(F.min("doc_id").alias("least"))
    member = sets.where("n > 0").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = member.join(least, "component").select("node", "check", "component_id")
    out = table.select("doc_id", F.col("n").alias("n_shingles"), "node", "check").join(of_set, ["node", "check"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each group of linked documents: the one with the smallest id.

    Documents without words link with nothing and stay. Repeated rows of one id count as one document. Rows without id
    stay, once for each text, if no row with an id has their shingles.
    """
    found = jaccard_components(docs, percent)
    keep = found.where("doc_id <=> component_id").select(F.col("doc_id").alias("_kept")).distinct()
    kept = docs.join(keep, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")
    text = F.when(F.col("doc_id").isNull(), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return kept.withColumn("_text", text).dropDuplicates(["doc_id", "_text"]).drop("_text")


def _neighbours(hot: DataFrame, long: np.ndarray, counts: np.ndarray, percent: int, salt: int, joined: DataFrame | None) -> DataFrame:
    """Pairs of nodes that follow each other in the salted parts of frequent lists, a few for every node.

    With ``joined``, only pairs of different components count.
    """
    lists = hot.mapInArrow(_postings(long, counts, True, salt), "list long, node long, n long, hot boolean").distinct()
    row = Window.partitionBy("list").orderBy("n", "node")
    pairs = lists.withColumn("b", F.lag("node").over(row)).withColumn("n_b", F.lag("n").over(row)).where("b is not null").where(_near("n", "n_b", percent))
    pairs = pairs.groupBy(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    if joined is not None:
        pairs = _apart(pairs, joined)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "c"))
    best = Window.partitionBy("a").orderBy(F.desc("c"), F.xxhash64("b"))
    few = both.withColumn("r", F.row_number().over(best)).where(F.col("r") <= PARTNERS)
    return few.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    of = lambda end: joined.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.where("coalesce(of_a, a) <> coalesce(of_b, b)").select(*pairs.columns)


def _across(rows: DataFrame, table: DataFrame, hot: DataFrame, long: np.ndarray, counts: np.ndarray, joined: DataFrame, percent: int) -> DataFrame:
    """Links between components whose nodes share frequent short lists, each pair of components once a block and node.

    Nodes that are connected through such lists form a family. All nodes outside a family's largest component meet all
    of its nodes, block against block.
    """
    shared = stored(hot.mapInArrow(_postings(long, counts, True, -1), "list long, node long, n long, hot boolean").select("list", "node").distinct(), "shared")
    family = components(shared.select(F.col("node").alias("a"), F.col("list").alias("b"))).withColumnRenamed("component", "family")
    nodes = shared.select("node").distinct().join(family, "node").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    nodes = stored(nodes, "family")
    parts = nodes.groupBy("family", "component").agg(F.count(F.lit(1)).alias("m"))
    mixed = parts.groupBy("family").agg(F.sum("m").alias("size"), F.max_by("component", F.struct("m", "component")).alias("largest"), F.count(F.lit(1)).alias("k")).where("k > 1")
    nodes = nodes.join(mixed, "family").withColumn("blocks", F.ceil(F.col("size") / BLOCK_NODES).cast("int"))
    nodes = stored(nodes.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "nodes")
    full = stored(nodes.join(_token_sets(rows, table, nodes.select("node").distinct()), "node"), "full")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = full.where("component <> largest").withColumn("other", every).select("family", "block", "other", "node", "component", "tokens")
    right = full.withColumnRenamed("block", "other").withColumn("block", every)
    right = right.select(*[F.col(c).alias(c) for c in ("family", "block", "other", "node", "component", "tokens")])
    keys = ["family", "block", "other"]
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(_compared(percent), "a long, b long")


def _compared(percent: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list] = ([], [])
        if left.num_rows and right.num_rows:
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in right["tokens"]]
            sizes = np.array([len(x) for x in sets])
            tokens = np.concatenate(sets)
            order = np.argsort(tokens, kind="stable")
            owner, tokens = np.repeat(np.arange(len(sets)), sizes)[order], tokens[order]
            nodes, component = right["node"].to_numpy(), right["component"].to_numpy()
            for node, own, blob in zip(left["node"].to_pylist(), left["component"].to_pylist(), left["tokens"], strict=True):
                query = np.frombuffer(blob.as_py(), np.uint64)
                low, high = np.searchsorted(tokens, query, "left"), np.searchsorted(tokens, query, "right")
                found = np.zeros(len(sets), np.int64)
                # A document is in a list once, so every list adds one to each of its documents.
                for a, b in zip(low.tolist(), high.tolist(), strict=True):
                    found[owner[a:b]] += 1
                linked = np.flatnonzero((100 * found >= percent * (len(query) + sizes - found)) & (component != own))
                _, at = np.unique(component[linked], return_index=True)
                out[0].extend([node] * len(at))
                out[1].extend(nodes[linked[at]].tolist())
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["a", "b"])

    return run
