"""Hilbert order, token ids and packing: exact round trip on odd texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from journeyloom.llm.catalogue import tokenizer_files
from journeyloom.llm.packing import hilbert_keys, pack_along_curve, piece_digests
from journeyloom.llm.tokens import TokenIds

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("start", T.StringType())])
TEXTS = ["", None, "a", "one  two\n \n three \n", " lead and trail ", "it's 12 we'll\tgo", "é ß 字 🙂 İx", "<|endoftext|> x", "word " * 3000, "\x1c a\x85b", "\n\n\nx   y", "the cat"]


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_touch(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_cached_ids_equal_the_tokenizers():
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast = TokenIds(*tokenizer_files())
    for text in [t for t in TEXTS if t is not None] * 2:
        assert fast.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_pieces_rebuild_every_document(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again"), (None, "no id", "x")], SCHEMA)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = pack_along_curve(docs, *tokenizer_files(), length=64).toPandas()
    want = sorted(sorted(whole.encode(t or "", add_special_tokens=False).ids + [0]) for t in [*TEXTS, TEXTS[3], "no id"])
    got, at = [], pieces.sort_values(["sequence_id", "offset"])
    for _, rows in at.groupby("sequence_id"):
        assert rows.offset.tolist() == np.concatenate(([0], np.cumsum(rows.length)[:-1])).tolist()
        assert rows.length.sum() <= 64
    current = []
    for row in at.itertuples():
        assert row.start == len(current)
        current += list(row.ids)
        if len(current) == row.doc_tokens:
            got.append(sorted(current))
            current = []
    assert not current and sorted(got) == want
    full = at.groupby("sequence_id").length.sum()
    assert (full < 64).sum() <= 1
    digests = piece_digests(docs, *tokenizer_files(), length=64).toPandas().sort_values(["sequence_id", "offset"])
    assert digests.ids_crc32.tolist() == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in at.ids]


def test_every_part_has_its_own_task(spark, monkeypatch):
    monkeypatch.setattr("journeyloom.llm.packing.PART_BYTES", 1_000)
    docs = spark.createDataFrame([(i, f"{i} word " * (i % 40)) for i in range(800)], "doc_id long, text string")
    pieces = pack_along_curve(docs, *tokenizer_files(), length=64)
    assert pieces.rdd.getNumPartitions() > 100
    parts = pieces.selectExpr("shiftright(sequence_id, 32) as part", "spark_partition_id() as task").distinct().toPandas()
    assert len(parts) > 80 and parts.part.is_unique and parts.task.is_unique


def test_no_documents_no_pieces(spark):
    assert pack_along_curve(spark.createDataFrame([], SCHEMA), *tokenizer_files()).count() == 0
