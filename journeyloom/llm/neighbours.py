"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes come from several rotations of the centred vectors, each learnt on a bounded sample by alternating between
signs and the rotation nearest to them. A code is cut into 64-bit substrings and each substring is indexed. By the
pigeonhole principle a code within radius r of a query's has a substring within its share of r, so probing all
substrings to that share finds every code within r. Those are ranked by their exact inner product. Radii that hold the
neighbours of unclustered vectors are far too wide to enumerate all keys near a query's, so a probe runs over the keys
that the block's index has.

The table is indexed in blocks of bounded size; blocks of queries meet blocks of the index, so nothing that grows with the
data is broadcast or gathered. The radius is set on the sample: the smallest that holds RECALL of its true neighbours.
One radius suits no table whose density varies, so queries that it leaves with fewer rows than there are candidates for
are asked again without one: they meet every vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from journeyloom.session import checkpointed

ROTATIONS, SUBSTRING = 4, 64
SAMPLE_VECTORS, SAMPLE_QUERIES = 6_000, 200
RECALL = 0.97
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 2_000
HITS = "query_id long, row long, vec_id long, score double"


class Codes:
    """Rotated sign codes: bits per rotation = dimensions, packed into 64-bit substrings."""

    def __init__(self, centre: np.ndarray, rotations: list[np.ndarray]):
        self.centre, self.rotations = centre, rotations

    @staticmethod
    def learnt(sample: np.ndarray, rounds: int = 20) -> Codes:
        centre = sample.mean(0)
        x = sample - centre
        dims, rng = x.shape[1], np.random.default_rng(7)
        rotations = []
        for _ in range(ROTATIONS):
            turn, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
            for _ in range(rounds):
                u, _, v = np.linalg.svd(x.T @ np.sign(x @ turn))
                turn = u @ v
            rotations.append(turn)
        return Codes(centre, rotations)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        bits = np.concatenate([(vectors - self.centre) @ r > 0 for r in self.rotations], 1)
        if bits.shape[1] % SUBSTRING:
            bits = np.pad(bits, ((0, 0), (0, SUBSTRING - bits.shape[1] % SUBSTRING)))
        return np.packbits(bits, axis=1).view(np.uint64)


def distances(code: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(1, dtype=np.int32)


class MultiIndex:
    """Buckets of every substring over one block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, first = np.unique(column[order], return_index=True)
            self.tables.append((order, values, np.append(first, len(column))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of all codes within the radius: substrings of known values near the query's are probed, then checked."""
        parts = len(self.tables)
        share, more = divmod(radius, parts)
        maybe = np.zeros(len(self.codes), bool)
        for k, (order, values, first) in enumerate(self.tables):
            # Radius r = share * parts + more: the first more + 1 substrings get share, the others one less.
            allowed = share if k <= more else share - 1
            if allowed < 0:
                continue
            near = np.bitwise_count(values ^ code[k]) <= allowed
            maybe[order[near if len(values) == len(order) else np.repeat(near, np.diff(first))]] = True
        rows = np.flatnonzero(maybe)
        return rows[distances(code, self.codes[rows]) <= radius]


def calibrated_radius(codes: Codes, sample: np.ndarray, neighbours: int) -> int:
    """Smallest radius that holds RECALL of the sample's own nearest neighbours."""
    some = sample[:SAMPLE_QUERIES]
    packed = codes.of(sample)
    scores = some @ sample.T
    # Without the query itself, which need not be its own best hit.
    scores[np.arange(len(some)), np.arange(len(some))] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : min(neighbours, len(sample) - 1)]
    found = np.concatenate([distances(packed[i], packed[near[i]]) for i in range(len(some))]) if near.size else np.zeros(1)
    return int(np.quantile(found, RECALL, method="higher"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def best_first(ids: np.ndarray, scores: np.ndarray, neighbours: int) -> np.ndarray:
    """Places of the best scores, ties by id."""
    if len(ids) > 4 * neighbours:
        edge = np.partition(scores, len(scores) - neighbours)[len(scores) - neighbours]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(ids))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:neighbours]


def _searched(codes: Codes, radius: int | None, neighbours: int):
    """Hits of a block of queries in a block of the index, of all its vectors without a radius."""

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if queries.num_rows and block.num_rows:
            ids, own = block["vec_id"].to_numpy(), block["row"].to_numpy()
            vectors = _matrix(block["embedding"].combine_chunks())
            index = None if radius is None else MultiIndex(codes.of(vectors))
            asked = _matrix(queries["embedding"].combine_chunks())
            asked_codes = codes.of(asked)
            for q, self, vector, code in zip(queries["vec_id"].to_numpy(), queries["row"].to_numpy(), asked, asked_codes, strict=True):
                rows = np.arange(len(ids)) if index is None else index.within(code, radius)
                rows = rows[(ids[rows] != q) | (own[rows] != self)]
                # One sum order for all blocks, so that equal vectors get equal scores.
                scores = np.einsum("ij,j->i", vectors[rows], vector)
                best = best_first(ids[rows], scores, neighbours)
                for column, values in zip(out, (np.full(len(best), q), np.full(len(best), self), ids[rows[best]], scores[best]), strict=True):
                    column.append(values)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        arrays = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, types, strict=True)]
        return pa.table(arrays, ["query_id", "row", "vec_id", "score"])

    return search


def nearest(vectors: DataFrame, every: int = 20, neighbours: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``neighbours`` nearest found by inner product of each query.

    ``vectors`` has vec_id and embedding; queries are the rows whose vec_id is divisible by ``every``. Vectors that are
    NULL, zero, of another length than most, or hold NULL or non-finite components take no part, nor do
    NULL ids. Rows that repeat an id are vectors of their own: each of them is found, and each asks if the id does, leaving
    out itself only. Every query gets ``neighbours`` rows, or as many as there are other vectors. No usable rows give no rows.
    """
    usable = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .where("vec_id is not null and embedding is not null and size(embedding) > 0")
        .where(F.expr("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)"))
        .groupBy("vec_id", "embedding")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("vec_id", "embedding", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        # Tells rows of one id apart, whatever partition computes them.
        .select("vec_id", "embedding", F.xxhash64("vec_id", "embedding", "copy").alias("row"))
    )
    length = usable.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    if length is None:
        return spark.createDataFrame([], result)
    usable = usable.where(F.size("embedding") == length["n"])
    count = length["count"]
    share = min(1.0, SAMPLE_VECTORS / count)
    sampled = usable.where(F.pmod(F.xxhash64("vec_id", F.lit("codes")), F.lit(1_000_000)) < share * 1_000_000).limit(2 * SAMPLE_VECTORS)
    sample = sampled.select("embedding").toPandas()["embedding"]
    sample = np.stack([np.asarray(x, np.float64) for x in sample]) if len(sample) else np.zeros((1, length["n"]))
    codes = Codes.learnt(sample)
    # Fewer vectors than neighbours: everything is near enough.
    radius = calibrated_radius(codes, sample, neighbours) if count > 10 * neighbours else None
    queries = usable.where(F.col("vec_id") % every == 0)
    best = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")

    def asked(some: DataFrame, n: int, within: int | None) -> DataFrame:
        """The best hits of ``n`` queries; blocks of queries meet blocks of the index."""
        blocks, askers = -(-count // BLOCK_ROWS), -(-n // BLOCK_QUERIES) or 1
        hashed = F.xxhash64("row")
        index = usable.withColumn("block", F.pmod(hashed, F.lit(blocks)).cast("int"))
        grid_i = index.withColumn("asker", F.explode(F.sequence(F.lit(0), F.lit(askers - 1))))
        grid_q = some.withColumn("asker", F.pmod(hashed, F.lit(askers)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        hits = grid_q.groupBy("asker", "block").cogroup(grid_i.groupBy("asker", "block")).applyInArrow(_searched(codes, within, neighbours), HITS)
        return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= neighbours)

    found = asked(queries, -(-count // every), radius)
    if radius is not None:
        found = checkpointed(found)
        full = found.where(F.col("rank") == min(neighbours, count - 1)).select("query_id", "row")
        short = checkpointed(queries.join(full.withColumnRenamed("query_id", "vec_id"), ["vec_id", "row"], "left_anti"))
        if n := short.count():
            found = found.join(full, ["query_id", "row"], "left_semi").unionByName(asked(short, n, None))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
