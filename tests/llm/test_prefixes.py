"""Prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import types as T

from journeyloom.llm import prefixes
from journeyloom.llm.prefixes import numbered_turns, prefix_trie

SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField("depth", T.StringType()), T.StructField("words", T.LongType())]
)


def ordered(rows):
    def digest(role, text):
        md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
        return md5(md5(role) + md5(text))

    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0, role.encode(), digest(role, text)), (role, text)))
    return {c: [t for _, t in sorted(found)] for c, found in turns.items()}


def brute(rows, family=20, most=4):
    original = ordered(rows)
    convs = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % family if c >= 0 else -(abs(c) % family))
        convs[c] = tuple(original.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, found in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(found) - 1) * words
    out = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in found if convs[c] == node)
        parent = members[node[:-1]][0] if node else None
        out.append((found[0], len(node), parent, len(found), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def check(spark, rows, parts=3, family=20, most=4):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    found = prefix_trie(table, family, most)
    assert found.columns == COLUMNS
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, family, most)


def made(rng, convs, lengths, texts):
    rows = []
    for c in convs:
        for t in range(rng.choice(lengths)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][t % 2], rng.choice(texts)))
    return rows


def test_equals_all_prefixes(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "PART_TURNS", 400)
    rng = random.Random(11)
    texts = ["hi", "hi there", "a  b\nc", "", None, "x " * 50]
    rows = made(rng, [*range(0, 70), *range(200, 260, 9), -3, -20, -45, 2**60], range(1, 9), texts[:3]) + made(rng, range(300, 340), [1, 2, 30, 45], texts)
    rows += [(500, None, "user", "b"), (500, None, "user", "a"), (500, 0, None, None), (500, 0, None, ""), (None, 1, "user", "lost")]
    rows += [(520, 1, "user", "same")] * 4 + [(521, 1, "user", "same")] * 3
    rng.shuffle(rows)
    check(spark, rows)
    check(spark, rows, most=1)


def test_large_equal_groups_and_one_long_conversation(spark, monkeypatch):
    """Nodes that span many partitions: equal conversations, one of 230 turns, and another that leaves it late."""
    monkeypatch.setattr(prefixes, "PART_TURNS", 150)
    monkeypatch.setattr(prefixes, "RUN", 3)
    rng = random.Random(12)
    long = [rng.choice(["go on", "yes", "no no"]) for _ in range(230)]
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 200) for t in range(3)]
    rows += [(1000, t, "user", x) for t, x in enumerate(long)]
    rows += [(1007, t, "user", x) for t, x in enumerate(long[:150] + ["leaves", "now"])]
    rows += [(1013, t, "user", x) for t, x in enumerate(long[:64])]
    check(spark, rows, 4)


def test_turns_of_one_conversation_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "PART_TURNS", 40)
    rows = [(7, t // 2 if t % 5 else None, "user", f"t{t % 11}") for t in range(700)] + [(8, t, "user", "x") for t in range(5)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted((r.conv_id, r["at"], r.digest) for r in numbered_turns(table).collect())
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    want = sorted((c, at, md5(md5(r) + md5(x))) for c, turns in ordered(rows).items() for at, (r, x) in enumerate(turns))
    assert got == want


def test_no_rows(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "user", "x", "x", 1)], SCHEMA)).count() == 0
