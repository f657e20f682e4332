"""Prefix trie of conversations from padded turn-id matrices.

A conversation is cut into segments of WIDTH turns, so that one of any length spreads over many rows. A segment's row
holds a digest of all turns before it and the ids of its turns. The rows are range-partitioned by (segment, digest before,
turn ids, conversation), so the rows below any node of the trie are neighbours. Each partition is a padded matrix of turn
ids: a lexsort orders it, differences between neighbouring rows are OR-accumulated over the columns to mark where nodes
start, and reduceat sums every depth. Nodes that touch a partition's first or last row, or that go on in the next segment,
come out in parts and are recombined by their digest; all others are finished where they are.

Sums over a subtree need no walk. Every node belongs to its smallest member conversation. The nodes below u that belong to
a member c other than u's own are all the nodes that belong to c, so the sum over u's subtree is the members' totals, less
what belongs to u's own conversation above u. Totals come from a first pass over the matrices, sums of them from a second.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from journeyloom.llm.graph import stored
from journeyloom.llm.texts import only

#: Turns of a segment (columns of a matrix).
WIDTH = 16
#: Turns of a partition, about.
PART_TURNS = 20_000
#: Rows of one key that a window numbers or sums in one place.
RUN = 1_024
#: Parents are broadcast up to this many rows; beyond it the join is salted.
BROADCAST_NODES, SALTS = 100_000, 32
_WORD = r"[^\x20\x09-\x0D]+"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, words, digest) of every turn: its place from 0, its words, and a digest of role and text.

    Turns are ordered by turn (NULL first), then role, then text digest, by a range partitioning, so that one conversation
    may spread over many tasks.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.md5(role.cast("binary")), F.md5(text.cast("binary"))).cast("binary"))
    turns = only(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    turns = turns.select("conv_id", "turn", role.alias("role"), F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"), digest.alias("digest"))
    turns = stored(turns.withColumn("row", F.monotonically_increasing_id()), "turns")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "row"]
    parts = max(1, -(-turns.count() // PART_TURNS))
    dealt = turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "words", "digest")
    counted = stored(dealt.mapInArrow(_counted, "part int, conv_id long, at long, words long, digest string"), "numbered")
    # One row for each part: how many turns of its first conversation lie in the parts before.
    ends = counted.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "at")).alias("last")).orderBy("part").collect()
    starts, last, held = [], None, 0
    for row in ends:
        before = held if row["first"] == last else 0
        starts.append((row["part"], row["first"], before))
        held = row["last"]["at"] + 1 + (before if row["last"]["conv_id"] == row["first"] else 0)
        last = row["last"]["conv_id"]
    before = conversations.sparkSession.createDataFrame(starts, "part int, conv_id long, before long")
    placed = counted.join(F.broadcast(before), ["part", "conv_id"], "left").withColumn("at", F.col("at") + F.coalesce("before", F.lit(0)))
    return placed.select("conv_id", "at", "words", "digest")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the sorted turns of each conversation within the partition."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column("conv_id").to_numpy()
        if not len(conv):
            continue
        first = np.concatenate(([True], conv[1:] != conv[:-1]))
        start = np.maximum.accumulate(np.where(first, np.arange(len(conv)), 0))
        at = np.arange(len(conv)) - start + np.where(start == 0, count if conv[0] == last else 0, 0)
        last, count = conv[-1], int(at[-1]) + 1
        yield pa.record_batch(
            [pa.array(np.full(len(conv), part, np.int32)), batch.column("conv_id"), pa.array(at), batch.column("words"), batch.column("digest")],
            ["part", "conv_id", "at", "words", "digest"],
        )


def grafted_turns(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from the first one of their family, as in the evaluated variant of the table.

    Of conversation c, the first h = crc32(c) mod ``most`` turns are those of conversation c - c % ``family`` (as many as
    it has, none if there is none). Returns the conversations (conv_id, size) and their turns (conv_id, size, at, words, digest).
    """
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("at") < most - 1))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "words", "digest"))).alias("head"))
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    convs = convs.join(heads, "base", "left").withColumn("taken", F.least("h", F.greatest(F.size("head"), F.lit(0))).cast("long"))
    convs = convs.withColumn("size", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "own", "h", "taken", "size", "head"), "convs")
    # A conversation's turns are joined in runs, so that one with many is many keys.
    runs = convs.select("conv_id", "h", "taken", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(own - 1) div {RUN}"))).alias("run"))
    rest = turns.withColumn("run", F.expr(f"at div {RUN}")).join(runs, ["conv_id", "run"]).where("at >= h")
    rest = rest.select("conv_id", "size", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "words", "digest")
    head = convs.where("taken > 0").select("conv_id", "size", F.explode(F.slice("head", F.lit(1), F.col("taken").cast("int"))).alias("t"))
    return convs.select("conv_id", "size"), head.select("conv_id", "size", "t.at", "t.words", "t.digest").unionByName(rest)


def running(df: DataFrame, key: str, place: str, names: list[str], total, plus) -> DataFrame:
    """Adds, as name_before, the ``total`` of each named column over the rows of ``key`` with a smaller ``place``.

    Runs of RUN places are summed on their own first, so a key with many rows is never in one task. ``plus`` puts the
    runs before and the rows of the run together.
    """
    df = df.withColumn("_run", F.expr(f"{place} div {RUN}"))
    zero = F.lit(0).cast("long")
    before = lambda name, *by: F.coalesce(total(name).over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), zero)
    runs = df.groupBy(key, "_run").agg(*[total(c).alias(c) for c in names])
    runs = runs.select(key, "_run", *[before(c, key, "_run").alias(f"_{c}") for c in names]).where("_run > 0")
    inside = df.select("*", *[before(c, key, "_run", place).alias(f"{c}_before") for c in names])
    out = inside.join(runs, [key, "_run"], "left")
    sums = [plus(F.col(f"{c}_before"), F.coalesce(F.col(f"_{c}"), zero)).alias(f"{c}_before") for c in names]
    return out.select(*df.drop("_run").columns, *sums)


def segments(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each WIDTH turns of a conversation: (conv_id, segment, size, path, words, one_before, two_before).

    ``path`` has two hashes for each turn (of its place, role and text), the ``before`` columns combine those of all turns
    before the segment. A conversation without turns has one row without any.
    """
    of_turn = [F.xxhash64("at", "digest").alias("one"), F.xxhash64("digest", "at").alias("two")]
    keyed = turns.select("conv_id", "size", "at", F.expr(f"at div {WIDTH}").alias("segment"), "words", *of_turn)
    rows = keyed.groupBy("conv_id", "segment").agg(
        F.first("size").alias("size"),
        F.sort_array(F.collect_list(F.struct("at", "words", "one", "two"))).alias("turns"),
        F.bit_xor("one").alias("one"),
        F.bit_xor("two").alias("two"),
    )
    rows = running(rows, "conv_id", "segment", ["one", "two"], F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    path = F.flatten(F.transform("turns", lambda t: F.array(t["one"], t["two"])))
    rows = rows.select("conv_id", "segment", "size", path.alias("path"), F.col("turns.words").alias("words"), "one_before", "two_before")
    none = F.lit(0).cast("long")
    empty = F.array().cast("array<long>")
    blank = convs.where("size = 0").select("conv_id", none.alias("segment"), "size", empty.alias("path"), empty.alias("words"), none.alias("one_before"), none.alias("two_before"))
    return rows.unionByName(blank)


_NODES = pa.schema(
    [(c, pa.int64()) for c in ("depth", "conv_id", "n_convs", "n_children", "words", "saved", "leaves", "parent_conv_id", "one", "two", "parent_one", "parent_two", "first_end")]
    + [(c, pa.bool_()) for c in ("part", "edge")]
    + [("ends_sha256", pa.string()), ("ends", pa.binary())]
)


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of rows by several columns, the first one leading."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), np.int32)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(new)
    return out


def _list(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], np.diff(offsets)


class _Matrix:
    """A partition's segments as a padded matrix of turn ids, in trie order."""

    def __init__(self, table: pa.Table):
        column = {c: table[c].combine_chunks() for c in table.column_names}
        column = {c: v.chunk(0) if isinstance(v, pa.ChunkedArray) else v for c, v in column.items()}
        path, _ = _list(column["path"])
        words, length = _list(column["words"])
        values = {c: column[c].to_numpy() for c in ("conv_id", "segment", "size", "one_before", "two_before", "saved", "leaves")}
        rows, width = len(length), int(length.max(initial=0))
        row = np.repeat(np.arange(rows), length)
        place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        ids = np.full((rows, width + 1), -1, np.int32)
        ids[:, 0] = _ranks(values["segment"], values["one_before"], values["two_before"])
        ids[row, place + 1] = _ranks(path[::2], path[1::2])
        order = np.lexsort([values["conv_id"], *ids.T[::-1]])
        self.rows, self.width = rows, width
        self.value = {c: v[order] for c, v in values.items()}
        self.length = length[order]
        #: Turns of the segment end the conversation.
        self.final = self.value["segment"] * WIDTH + self.length == self.value["size"]
        ids = ids[order]
        change = np.ones((rows, width + 1), bool)
        change[1:] = ids[1:] != ids[:-1]
        self.starts = np.logical_or.accumulate(change, axis=1)
        self.words = np.zeros((rows, width + 1), np.int64)
        keys = np.zeros((2, rows, width + 1), np.int64)
        at = np.empty(rows, np.int64)
        at[order] = np.arange(rows)
        self.words[at[row], place + 1] = words
        for k, side in enumerate(("one", "two")):
            keys[k, :, 0] = self.value[f"{side}_before"]
            keys[k, at[row], place + 1] = path[k::2]
        #: Digests of all turns of a row's conversation up to each column.
        self.keys = np.bitwise_xor.accumulate(keys, axis=2)

    def depths(self, ends: bool) -> Iterator[pa.RecordBatch]:
        """Every depth's nodes, one batch each."""
        value, end_row = self.value, self.rows - 1
        above = None
        for d in range(self.width + 1):
            rows = np.flatnonzero(self.length >= d)
            begin = np.flatnonzero(self.starts[rows, d])
            first, stop = rows[begin], np.append(begin[1:], len(rows))
            conv = np.minimum.reduceat(value["conv_id"][rows], begin)
            edge = (first == 0) | (rows[stop - 1] == end_row)
            children = np.zeros(self.rows, np.int64)
            if d < self.width:
                children[:] = self.starts[:, d + 1] & (self.length > d)
                if self.length[0] > d:
                    children[0] = 0
                if self.length[end_row] > d:
                    children[np.flatnonzero(self.starts[:, d + 1] & (self.length > d))[-1]] = 0
            goes_on = np.add.reduceat(((self.length == d) & ~self.final)[rows].astype(np.int64), begin) > 0
            pseudo = (value["segment"][first] > 0) if d == 0 else np.zeros(len(first), bool)
            goes_on = goes_on & (d == WIDTH)
            part = edge | goes_on | pseudo
            sums = {c: np.add.reduceat(value[c][rows], begin) for c in ("saved", "leaves")}
            out = {
                "depth": value["segment"][first] * WIDTH + d,
                "conv_id": pa.array(conv, mask=pseudo),
                "n_convs": np.where(pseudo, 0, stop - begin),
                "n_children": np.add.reduceat(children[rows], begin),
                "words": np.where(pseudo, 0, self.words[first, d]),
                "saved": np.where(pseudo, 0, sums["saved"]),
                "leaves": np.where(pseudo, 0, sums["leaves"]),
                "one": pa.array(self.keys[0, first, d], mask=~part),
                "two": pa.array(self.keys[1, first, d], mask=~part),
                "part": part,
                "edge": edge & ~pseudo,
            }
            if d == 0:
                none = pa.nulls(len(first), pa.int64())
                out |= {"parent_conv_id": none, "parent_one": none, "parent_two": none}
            else:
                up = np.searchsorted(above[0], first, "right") - 1
                known = ~above[2][up]
                out["parent_conv_id"] = pa.array(above[1][up], mask=~known)
                out["parent_one"] = pa.array(self.keys[0, first, d - 1], mask=known)
                out["parent_two"] = pa.array(self.keys[1, first, d - 1], mask=known)
            above = (first, conv, part)
            done, blobs, first_end = ([None] * len(first) for _ in range(3))
            if ends:
                last = ((self.length == d) & self.final)[rows]
                count = np.add.reduceat(last.astype(np.int64), begin)
                members, at = value["conv_id"][rows[last]], np.cumsum(count) - count
                for i, (a, m) in enumerate(zip(at.tolist(), count.tolist(), strict=True)):
                    if part[i] and m:
                        blobs[i], first_end[i] = members[a : a + m].tobytes(), int(members[a])
                    elif not part[i]:
                        done[i] = hashlib.sha256(",".join(map(str, members[a : a + m].tolist())).encode()).hexdigest()
            out |= {"ends_sha256": done, "ends": blobs, "first_end": first_end}
            arrays = [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in _NODES]
            yield pa.record_batch([a.cast(f.type) for a, f in zip(arrays, _NODES, strict=True)], schema=_NODES)


def _partition(ends: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if found:
            yield from _Matrix(pa.Table.from_batches(found)).depths(ends)

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each node, from sorted chunks of ids; one node after the other."""
    now, digest = None, None
    for batch in batches:
        done = []
        for depth, one, two, ends in zip(*(batch.column(c).to_pylist() for c in ("depth", "one", "two", "ends")), strict=True):
            ids = ",".join(map(str, np.frombuffer(ends, np.int64).tolist())).encode()
            if (depth, one, two) == now:
                digest.update(b"," + ids)
                continue
            if now is not None:
                done.append((*now, digest.hexdigest()))
            now, digest = (depth, one, two), hashlib.sha256(ids)
        yield _digest_rows(done)
    if now is not None:
        yield _digest_rows([(*now, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 3 + (pa.string(),), strict=True)], ["depth", "one", "two", "sha"])


def _with_parents(nodes: DataFrame, merged: DataFrame) -> DataFrame:
    """Fills in parent_conv_id where the parent came in parts."""
    parents = merged.select(F.col("depth").alias("up"), F.col("one").alias("parent_one"), F.col("two").alias("parent_two"), F.col("conv_id").alias("found"))
    nodes = nodes.withColumn("up", F.when(F.col("parent_one").isNotNull(), F.col("depth") - 1))
    keys = ["up", "parent_one", "parent_two"]
    if merged.count() <= BROADCAST_NODES:
        joined = nodes.join(F.broadcast(parents), keys, "left")
    else:
        parents = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = nodes.withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int")).join(parents, [*keys, "salt"], "left")
    return joined.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "found"))


def trie_nodes(rows: DataFrame, parts: int, ends: bool) -> DataFrame:
    """Nodes of the trie of ``segments`` rows with the columns saved and leaves, which are summed over each node's members.

    (depth, conv_id, parent_conv_id, n_convs, n_children, words, saved, leaves, ends_sha256); words are those of the last
    turn. Without ``ends``, ends_sha256 and parent_conv_id are not made.
    """
    order = ["segment", "one_before", "two_before", "path", "conv_id"]
    schema = ", ".join(f"{f.name} {dict(int64='long', bool='boolean').get(str(f.type), str(f.type))}" for f in _NODES)
    found = stored(rows.repartitionByRange(parts, *order).mapInArrow(_partition(ends), schema), "nodes")
    key = ["depth", "one", "two"]
    split = found.where("part")
    merged = split.groupBy(key).agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "saved", "leaves")],
        *[F.max(c).alias(c) for c in ("words", "edge", "parent_conv_id", "parent_one", "parent_two")],
    )
    merged = stored(merged, "merged")
    # Children at an edge were not counted in any part: they count once, when they are whole.
    more = merged.where("edge and parent_one is not null").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_one").alias("one"), F.col("parent_two").alias("two"))
    merged = merged.join(more.agg(F.count(F.lit(1)).alias("more")), key, "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    whole = found.where("not part")
    columns = ["depth", "conv_id", "n_convs", "n_children", "words", "saved", "leaves"]
    if not ends:
        return whole.select(columns).unionByName(merged.select(columns))
    # Ranges of partitions are disjoint, so a node's chunks follow each other by their first id.
    chunks = split.where("ends is not null").select(*key, "first_end", "ends")
    dealt = chunks.repartition(*key).sortWithinPartitions(*key, "first_end").select(*key, "ends")
    merged = merged.join(dealt.mapInArrow(_digested, "depth long, one long, two long, sha string"), key, "left")
    merged = merged.withColumn("ends_sha256", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)))
    columns += ["ends_sha256", "parent_conv_id", "parent_one", "parent_two"]
    nodes = whole.select(columns).unionByName(merged.select(columns))
    return _with_parents(nodes, stored(merged.select(*key, "conv_id"), "parents")).select(*columns[:-2])


def prefix_trie(conversations: DataFrame, family: int = 20, most: int = 1) -> DataFrame:
    """One row for each distinct sequence of first turns (role, text) of ``conversations`` (conv_id, turn, role, text).

    conv_id (smallest member), depth (turns), parent_conv_id (conv_id of the node one turn shorter; NULL at the root),
    n_convs (conversations that begin so), n_children, n_leaves (childless nodes of its subtree), saved_tokens (over its
    subtree: members but one, times the words of the node's last turn) and ends_sha256 (SHA-256 of the comma-joined ids
    of the members that end there, ascending). (conv_id, depth) is a key. ``family`` and ``most`` as in ``grafted_turns``;
    with the default every conversation is taken as it is.

    Turns are ordered by turn, NULL first; turns of equal number by role, then by digest of the text; repeated rows are
    repeated turns. NULL role or text is empty. Rows without conv_id belong to no conversation and give nothing. Texts are
    read whole. No conversations give no rows, not even a root.
    """
    convs, turns = grafted_turns(numbered_turns(conversations), family, most)
    rows = stored(segments(convs, turns), "segments")
    size = convs.agg(F.sum(F.col("size") + 1)).first()[0] or 0
    parts = max(1, -(-size // PART_TURNS))
    none = F.lit(0).cast("long")
    nodes = trie_nodes(rows.withColumn("saved", none).withColumn("leaves", none), parts, False)
    own = ((F.col("n_convs") - 1) * F.col("words")).alias("own")
    leaf = (F.col("n_children") == 0).cast("long").alias("leaf")
    totals = nodes.select("conv_id", own, leaf).groupBy("conv_id").agg(F.sum("own").alias("saved"), F.sum("leaf").alias("leaves"))
    runs = F.explode(F.sequence(none, F.expr(f"greatest(size - 1, 0) div {WIDTH * RUN}"))).alias("run")
    totals = convs.join(totals, "conv_id").select("conv_id", "saved", "leaves", runs)
    valued = rows.withColumn("run", F.expr(f"segment div {RUN}")).join(totals, ["conv_id", "run"], "left").drop("run")
    nodes = trie_nodes(valued.fillna(0, ["saved", "leaves"]), parts, True)
    nodes = nodes.select("*", own, leaf)
    nodes = running(nodes, "conv_id", "depth", ["own", "leaf"], F.sum, lambda a, b: a + b)
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("leaves") - F.col("leaf_before")).alias("n_leaves"),
        (F.col("saved") - F.col("own_before")).alias("saved_tokens"),
        "ends_sha256",
    )
