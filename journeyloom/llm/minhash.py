"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

Every distinct shingle set has one signature of BANDS x BAND_ROWS minimum hashes. Sets that agree in a whole band share a
bucket; a pair at the threshold misses all buckets with probability (1 - 0.8^4)^32 < 1e-7. The signatures of a candidate
pair are compared BATCH hashes at a time. With a uniform prior, m agreements among n hashes leave a posterior
Beta(m + 1, n - m + 1) of the similarity; the pair is given up as soon as the posterior chance that it reaches the
threshold is below MISS. The survivors are confirmed on their full sets, so every link is exact.

A bucket of m sets gives no m * m pairs. The sets of a bucket of at most NEAR + 1 all meet; in a larger one, ordered by
size, each meets the one before it. The links found merge most of a large bucket into one component; only sets connected through
buckets that still hold several components are then compared in blocks, those outside the largest component against all:
signatures batch by batch, survivors on the spot against inverted lists of their sets. Large buckets are cut at borders of
a range partitioning, so no key is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from journeyloom.llm.graph import components, keep_keys, stored
from journeyloom.llm.texts import mix, only, run_hashes, signed, word_slices

WORDS, PERCENT = 2, 80
BANDS, BAND_ROWS = 32, 4
#: Signature hashes compared at a time.
BATCH = 16
#: Posterior chance of reaching the threshold below which a pair is given up.
MISS = 1e-8
#: Predecessors that a set of a small bucket meets in the first pass.
NEAR = 4
#: Partners of a set that are verified before the components are asked which pairs are left.
PARTNERS = 2
#: Band rows of one task.
PART_ROWS = 400_000
#: Sets of a block where families of open buckets are compared.
BLOCK_SETS, BLOCK_TOKENS = 1_024, 4_000_000
#: Tokens of block comparisons in one task, about.
PART_TOKENS = 2_000_000


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, tokens, first token of each row and the end): sorted distinct shingle hashes of each row.

    A row with fewer words than a shingle has its whole sequence as one; a row without words has none.
    """
    for row, stop, found in word_slices(texts, lower=True):
        h, sizes = found.hashes(), np.diff(found.first)
        whole = np.flatnonzero((sizes > 0) & (sizes < words))
        extra = np.array([mix(run_hashes(h[found.first[i] : found.first[i + 1]], sizes[i]) + np.uint64(sizes[i]))[0] for i in whole], np.uint64)
        starts = np.flatnonzero(np.arange(len(h)) + words <= np.repeat(found.first[1:], sizes))
        token = np.concatenate((run_hashes(h, words)[starts], extra))
        doc = np.concatenate((found.doc[starts], whole))
        order = np.argsort(token, kind="stable")
        order = order[np.argsort(doc[order], kind="stable")]
        token, doc = token[order], doc[order]
        new = np.concatenate((np.full(min(1, len(token)), True), (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])))
        token, doc = token[new], doc[new]
        yield row, stop, token, np.searchsorted(doc, np.arange(stop - row + 1))


def _factors() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * BANDS * BAND_ROWS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return seeds[::2] | np.uint64(1), seeds[1::2]


def signatures(token: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minimum hashes (rows x BANDS * BAND_ROWS, 32 bits) of the rows that have tokens."""
    some = first[:-1][np.diff(first) > 0]
    out = np.empty((len(some), BANDS * BAND_ROWS), np.uint32)
    if len(some):
        for k, (factor, offset) in enumerate(zip(*_factors(), strict=True)):
            out[:, k] = np.minimum.reduceat(((token * factor + offset) >> np.uint64(32)).astype(np.uint32), some)
    return out


def _set_sums(token: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each row's set."""
    sums = []
    for salt in (0, 0x5851F42D4C957F2D):
        total = np.concatenate(([np.uint64(0)], np.cumsum(mix(token ^ np.uint64(salt)))))
        sums.append(signed(mix(total[first[1:]] - total[first[:-1]])))
    return sums[0], sums[1]


def _described(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, token, first in shingle_sets(batch.column("text"), words):
                sizes = np.diff(first)
                node, check = _set_sums(token, first)
                blobs = np.full(stop - row, None, object)
                blobs[sizes > 0] = [s.tobytes() for s in signatures(token, first)]
                columns = [pa.array(sizes, pa.int64()), pa.array(node), pa.array(check), pa.array(blobs, pa.binary())]
                yield pa.record_batch([batch.column("doc_id").slice(row, stop - row), *columns], ["doc_id", "n", "node", "check", "sig"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures of a binary column without NULLs."""
    column = column.cast(pa.large_binary())
    width = BANDS * BAND_ROWS
    raw = column.buffers()[2]
    if not len(column):
        return np.zeros((0, width), np.uint32)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :]
    return np.frombuffer(raw, np.uint32, len(column) * width, int(offsets[0])).reshape(-1, width)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, n, node): one row for each band of each set."""
    for batch in batches:
        sig = _matrix(batch.column("sig")).astype(np.uint64)
        keys = np.zeros((len(sig), BANDS), np.uint64)
        for r in range(BAND_ROWS):
            keys = mix(keys + sig[:, r::BAND_ROWS] + np.uint64(r + 1))
        keys = mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        n, node = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("n", "node"))
        yield pa.record_batch([pa.array(signed(keys.ravel())), pa.array(n), pa.array(node)], ["bucket", "n", "node"])


def _neighbours(percent: int):
    """Pairs (a, b) of neighbours in a bucket, and as (bucket, node) the sets of buckets whose pairs may not be all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy() for c in batch.columns] for batch in batches]
        if not parts:
            return
        bucket, n, node = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        order = np.lexsort((node, n, bucket))
        bucket, n, node = bucket[order], n[order], node[order]
        if not len(bucket):
            return
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        size = np.diff(np.append(first, len(bucket)))
        small = np.repeat(size <= NEAR + 1, size)
        pairs = []
        for k in range(1, min(NEAR, len(bucket) - 1) + 1):
            both = (bucket[k:] == bucket[:-k]) & (100 * n[:-k] >= percent * n[k:])
            # all pairs of a small bucket; in a large one each set meets the one before
            both = np.flatnonzero(both if k == 1 else both & small[k:])
            pairs.append(np.stack((node[both], node[both + k]), 1))
        ends = np.sort(np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64), axis=1)
        a, b = ends[np.lexsort((ends[:, 1], ends[:, 0]))].T
        new = np.concatenate((np.full(min(1, len(a)), True), (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        a, b = a[new], b[new]
        # A range partitioning may have cut the first and the last bucket.
        whole = size <= NEAR + 1
        whole[[0, -1]] = False
        left = np.repeat(~whole, size)
        member = np.repeat([False, True], [len(a), left.sum()])
        yield pa.record_batch(
            [pa.array(member), pa.array(np.concatenate((a, bucket[left]))), pa.array(np.concatenate((b, node[left])))], ["member", "a", "b"]
        )

    return run


def least_agreements(percent: int, hashes: int = BANDS * BAND_ROWS, miss: float = MISS) -> np.ndarray:
    """By number of batches: fewest agreements at which the posterior chance of the threshold is at least ``miss``.

    P(Beta(m + 1, n - m + 1) >= t) is P(Binomial(n + 1, t) <= m).
    """
    t, least = percent / 100, [0]
    for n in range(BATCH, hashes + 1, BATCH):
        chance, m = 0.0, 0
        while (chance := chance + comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)) < miss:
            m += 1
        least.append(m)
    return np.array(least)


def surviving(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Places of the pairs (left[i], right[j]) that no batch of hashes gives up."""
    at, agree = np.arange(len(i)), np.zeros(len(i), np.int64)
    for k in range(1, len(least)):
        hashes = slice((k - 1) * BATCH, k * BATCH)
        agree = agree + (left[i[at], hashes] == right[j[at], hashes]).sum(1)
        keep = agree >= least[k]
        at, agree = at[keep], agree[keep]
    return at


def _unpruned(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_agreements(percent)
        for batch in batches:
            every = np.arange(batch.num_rows)
            at = surviving(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")), every, every, least)
            yield pa.record_batch([batch.column(c).take(pa.array(at)) for c in ("a", "b")], ["a", "b"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                short, long = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(long, short)
                at[at == len(long)] = 0
                both = int((long[at] == short).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

    return run


def _tokens(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, token, first in shingle_sets(batch.column("text"), words):
                node, _ = _set_sums(token, first)
                blobs = [token[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.record_batch([pa.array(node), pa.array(blobs, pa.binary())], ["node", "tokens"])

    return run


class _Sets:
    """The distinct sets of a corpus: signatures, and tokens of those that are asked for."""

    def __init__(self, rows: DataFrame, table: DataFrame, percent: int, words: int):
        self.rows, self.table, self.percent, self.words = rows, table, percent, words

    def nodes(self, wanted: DataFrame | None = None) -> DataFrame:
        """(node, n, sig) of all sets, or of those in ``wanted`` (a stored column of nodes)."""
        found = self.table.where("n > 0").select("node", "n", "sig")
        return (found if wanted is None else keep_keys(found, wanted, "node")).dropDuplicates(["node"])

    def ends(self, pairs: DataFrame, values: DataFrame, value: str, names: tuple[str, str]) -> DataFrame:
        for end, name in zip(("a", "b"), names, strict=True):
            pairs = pairs.join(values.select(F.col("node").alias(end), F.col(value).alias(name)), end)
        return pairs.select("a", "b", *names)

    def unpruned(self, pairs: DataFrame) -> DataFrame:
        """The pairs that sequential comparison of the signatures doesn't give up."""
        ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ids")
        return self.ends(pairs, self.nodes(ids), "sig", ("sig_a", "sig_b")).mapInArrow(_unpruned(self.percent), "a long, b long")

    def tokens(self, ids: DataFrame) -> DataFrame:
        """(node, tokens) of the nodes ``ids``, from the text of one document each."""
        docs = self.table.join(ids, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
        docs = stored(docs.where("doc_id is not null").select("doc_id").distinct(), "ids")
        text = keep_keys(self.rows.where("doc_id is not null"), docs, "doc_id").unionByName(self.rows.where("doc_id is null")).select("text")
        found = text.mapInArrow(_tokens(self.words), "node long, tokens binary").groupBy("node").agg(F.first("tokens").alias("tokens"))
        return found.join(ids, "node", "left_semi")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the stored pairs whose full sets reach the similarity."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return self.ends(pairs, self.tokens(ids), "tokens", ("x", "y")).mapInArrow(_confirmed(self.percent), "a long, b long")

    def links(self, pairs: DataFrame) -> DataFrame:
        survivors = stored(self.unpruned(pairs), "survivors")
        return stored(self.confirmed(survivors), "links")


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    for end in ("a", "b"):
        pairs = pairs.join(joined.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    return pairs.where("coalesce(of_a, a) <> coalesce(of_b, b)").select("a", "b")


def _linked(percent: int):
    """Confirmed links between different components, block of a family against block; enough to join what is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_agreements(percent)
        parts = [p for p in batches if p.num_rows]
        if not parts:
            return
        columns = {c: np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("family", "low", "high", "node", "component", "n")}
        right = np.concatenate([p.column("right").to_numpy(zero_copy_only=False) for p in parts])
        sig = np.concatenate([_matrix(p.column("sig")) for p in parts])
        tokens = [np.frombuffer(t.as_py(), np.uint64) for p in parts for t in p.column("tokens")]
        del parts
        order = np.lexsort((right, columns["high"], columns["low"], columns["family"]))
        key = np.stack([columns[c][order] for c in ("family", "low", "high")])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        for group in np.split(order, cuts):
            x, y = group[~right[group]], group[right[group]]
            if not len(x) or not len(y):
                continue
            n, component = columns["n"], columns["component"]
            i, j = np.nonzero(
                (component[x][:, None] != component[y][None])
                & (100 * n[x][:, None] >= percent * n[y][None])
                & (100 * n[y][None] >= percent * n[x][:, None])
            )
            at = surviving(sig, sig, x[i], y[j], least)
            i, j = _overlapping([tokens[k] for k in x], [tokens[k] for k in y], i[at], j[at], percent)
            i, j = _spanning(component[x[i]], component[y[j]], x[i], y[j])
            yield pa.record_batch([pa.array(columns["node"][i]), pa.array(columns["node"][j])], ["a", "b"])

    return run


def _overlapping(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (left[i], right[j]) that reach the similarity, from the inverted lists of the right sets; sorted by i."""
    if not len(i):
        return i, j
    sizes = np.array([len(t) for t in right])
    every = np.concatenate(right)
    order = np.argsort(every, kind="stable")
    owner, every = np.repeat(np.arange(len(right)), sizes)[order], every[order]
    found: list[tuple[np.ndarray, np.ndarray]] = [(i[:0], j[:0])]
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    first = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
    for a, b in zip(first.tolist(), np.append(first[1:], len(i)).tolist(), strict=True):
        query, some = left[i[a]], j[a:b]
        low, high = np.searchsorted(every, query, "left"), np.searchsorted(every, query, "right")
        length = high - low
        places = np.repeat(low - (np.cumsum(length) - length), length) + np.arange(length.sum())
        both = np.bincount(owner[places], minlength=len(right))[some]
        fine = 100 * both >= percent * (len(query) + sizes[some] - both)
        found.append((i[a:b][fine], some[fine]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _spanning(p: np.ndarray, q: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the links (i, j) between components (p, q) that join what earlier ones have not joined."""
    if not len(i):
        return i, j
    ends = np.stack((np.minimum(p, q), np.maximum(p, q)))
    _, at = np.unique(ends, axis=1, return_index=True)
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = c = parent.get(up, up)
        return c

    keep = []
    for k in at.tolist():
        a, b = root(int(p[k])), root(int(q[k]))
        if a != b:
            parent[a] = b
            keep.append(k)
    return i[keep], j[keep]


def _across(sets: _Sets, members: DataFrame, joined: DataFrame) -> DataFrame | None:
    """Links within the buckets that still hold several components; None if there is no such bucket.

    Sets that are connected through such buckets form a family; those outside its largest component meet all of it, block
    against block. Every set is copied once for each block of its family, however many buckets it is in.
    """
    named = members.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named.distinct(), "members")
    mixed = named.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    shared = stored(named.join(mixed.select("bucket"), "bucket", "left_semi"), "open")
    if not shared.limit(1).count():
        return None
    family = components(shared.select(F.col("node").alias("a"), F.col("bucket").alias("b"))).withColumnRenamed("component", "family")
    nodes = stored(shared.select("node", "component").distinct().join(family, "node"), "families")
    ids = stored(nodes.select("node"), "ids")
    full = stored(nodes.join(sets.nodes(ids), "node").join(sets.tokens(ids), "node"), "full")
    size = full.groupBy("family", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    size = size.groupBy("family").agg(F.sum("m").alias("m"), F.sum("n").alias("tokens_in"), F.max(F.struct("m", "component", "n")).alias("top"))
    blocks = lambda m, n: F.ceil(F.greatest(m / BLOCK_SETS, n / BLOCK_TOKENS)).cast("int")
    size = size.select(
        "family",
        F.col("top.component").alias("largest"),
        blocks(F.col("m") - F.col("top.m"), F.col("tokens_in") - F.col("top.n")).alias("rows"),
        blocks(F.col("m"), F.col("tokens_in")).alias("columns"),
        (F.col("tokens_in") - F.col("top.n")).alias("tokens_out"),
        "tokens_in",
    )
    size = stored(size, "sizes")
    block = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    carried = ["family", "low", "high", "node", "component", "n", "sig", "tokens"]
    full = full.join(size.drop("tokens_in", "tokens_out"), "family")
    left = full.where("component <> largest").withColumn("low", block("rows")).withColumn("high", every("columns")).select(*carried, F.lit(False).alias("right"))
    right = full.withColumn("high", block("columns")).withColumn("low", every("rows")).select(*carried, F.lit(True).alias("right"))
    copied, groups = size.selectExpr("sum(tokens_out * columns + tokens_in * rows)", "sum(rows * columns)").first()
    parts = int(min(groups, copied // PART_TOKENS)) + 8
    dealt = left.unionByName(right).repartition(parts, "family", "low", "high")
    return dealt.mapInArrow(_linked(sets.percent), "a long, b long")


def minhash_components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Documents link when the similarity of their sets of ``words``-word shingles is at least ``percent`` hundredths; equal
    sets link. A text without words (or NULL) has no shingle and links with nothing. Repeated rows come out as often as
    they go in; a NULL doc_id keeps its row and gets the smallest id among the rows with its set or linked with it.
    Texts of any length are read whole. No rows give no rows.
    """
    rows = only(docs, "doc_id", "text")
    table = stored(rows.mapInArrow(_described(words), "doc_id long, n long, node long, check long, sig binary"), "sets")
    sets = _Sets(rows, table, percent, words)
    parts = max(1, -(-table.where("n > 0").count() * BANDS // PART_ROWS))
    banded = sets.nodes().mapInArrow(_buckets, "bucket long, n long, node long").repartitionByRange(parts, "bucket", "n", "node")
    met = stored(banded.mapInArrow(_neighbours(percent), "member boolean, a long, b long"), "met")
    pairs = stored(met.where("not member").groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")), "pairs")
    best = Window.partitionBy("a").orderBy(F.desc("c"), F.xxhash64("b"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "c"))
    few = both.withColumn("r", F.row_number().over(best)).where(F.col("r") <= PARTNERS)
    few = few.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = sets.links(stored(few, "few"))
    joined = components(links)
    rest = stored(_apart(pairs, joined), "rest")
    if rest.limit(1).count():
        links = links.unionByName(sets.links(rest))
        joined = components(links)
    members = met.where("member").select(F.col("a").alias("bucket"), F.col("b").alias("node"))
    across = _across(sets, members, joined)
    if across is not None:
        links = links.unionByName(stored(across, "across"))
        joined = components(links)
    # Back to documents: the smallest id of each set, then of each component.
    named = table.groupBy("node", "check", "n").agg(F.min("doc_id").alias("least")).where("n > 0")
    named = named.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = named.join(least, "component").select("node", "check", "component_id")
    out = table.select("doc_id", F.col("n").alias("n_shingles"), "node", "check").join(of_set, ["node", "check"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def kept_documents(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``minhash_components`` with ``kept``: whether the row is its component's smallest document."""
    return minhash_components(docs, percent, words).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
