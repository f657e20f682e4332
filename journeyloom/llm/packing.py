"""Packing in the order of a Hilbert curve.

A document's tokens are hashed into a vector, the vector is projected to few dimensions, and its cell's place on a
Hilbert curve sorts the corpus. Parts of the curve are packed on their own: the documents of a part follow each other
without gaps and are cut every ``length`` ids, so only a part's last sequence is not full. The number of parts
follows the bytes of text; part borders are quantiles of a bounded sample and only balance the work.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from journeyloom.llm.texts import _PRIME, mix, only
from journeyloom.llm.tokens import TokenIds

DIMENSIONS, BITS, TIE_BITS = 3, 15, 18
HASHED = 256
PART_BYTES = 32 << 20
MAX_PARTS = 50_000
SAMPLE_DOCS = 4_000


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates (rows x dimensions, ``bits`` bits each).

    Undoes, from the coarsest level down, the reflections and exchanges of axes that the curve applies per level.
    """
    x = cells.astype(np.uint64).T.copy()
    dims, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        below = bit - one
        for i in range(dims):
            high = (x[i] & bit) != 0
            swap = (x[0] ^ x[i]) & below
            swap[high] = 0
            x[0] ^= np.where(high, below, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn ^= np.where((x[-1] & bit) != 0, bit - one, np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(level)) & one)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(9).standard_normal((HASHED, DIMENSIONS))


def curve_positions(doc_ids: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of each document's hashed token vector, with bits of its id's hash below it to break ties."""
    vectors = np.zeros((len(ids), HASHED))
    for row, tokens in zip(vectors, ids, strict=True):
        h = mix(tokens.astype(np.uint64) + np.uint64(1))
        signs = np.where(h >> np.uint64(63), -1.0, 1.0)
        row += np.bincount((h % np.uint64(HASHED)).astype(np.int64), signs, HASHED)
    vectors = np.sign(vectors) * np.log1p(np.abs(vectors))
    place = vectors @ _projection() / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    # The logistic curve spreads the nearly normal coordinates over the cells.
    cells = np.floor((1 << BITS) / (1 + np.exp(-1.702 * np.clip(place, -8, 8)))).clip(0, (1 << BITS) - 1)
    ties = mix(doc_ids.view(np.uint64) * _PRIME) >> np.uint64(64 - TIE_BITS)
    return ((hilbert_keys(cells, BITS) << np.uint64(TIE_BITS)) | ties).astype(np.int64)


def _placed(batches: Iterator[pa.RecordBatch], tokenizer: tuple) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
    """Batches of at most 1,024 documents with their ids (ended by one id 0) and places on the curve."""
    encode = TokenIds(*tokenizer).ids
    for whole in batches:
        for low in range(0, whole.num_rows, 1024):
            batch = whole.slice(low, 1024)
            ids = [np.append(encode(t.as_py() or ""), np.uint32(0)) for t in batch.column("text")]
            yield batch, ids, curve_positions(np.asarray(batch.column("doc_id").fill_null(-1), np.int64), ids)


def _sampled(tokenizer: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, places in _placed(batches, tokenizer):
            yield pa.record_batch([pa.array(places)], ["place"])

    return run


def _tokenised(borders: list[int], tokenizer: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.array(borders, np.int64)
        for batch, ids, places in _placed(batches, tokenizer):
            parts = np.searchsorted(cuts, places, "right").astype(np.int32)
            blobs = pa.array([_blob(x) for x in ids], pa.binary())
            yield pa.record_batch([batch.column("doc_id"), pa.array(parts), pa.array(places), blobs], ["doc_id", "part", "place", "ids"])

    return run


def _blob(ids: np.ndarray) -> bytes:
    """Two bytes an id, or four behind a mark where some id needs them."""
    return ids.astype("<u2").tobytes() if ids.max() < 0xFFFF else b"\xff" * 4 + ids.astype("<u4").tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob[4:], "<u4") if blob[:4] == b"\xff" * 4 else np.frombuffer(blob, "<u2").astype(np.uint32)


def _packed(length: int, values: list[str]):
    names = ["doc_id", "start", "length", *values, "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(c, pa.list_(pa.int32()) if c == "ids" else pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, filled = None, 0
        for whole in batches:
            for low in range(0, whole.num_rows, 512):
                batch = whole.slice(low, 512)
                out: dict[str, list] = {c: [] for c in names}
                for doc, p, blob in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), batch.column("ids"), strict=True):
                    if p != part:
                        part, filled = p, 0
                    ids, start = _unpacked(blob.as_py()), 0
                    while start < len(ids):
                        offset = filled % length
                        take = min(length - offset, len(ids) - start)
                        piece = ids[start : start + take]
                        value = [zlib.crc32(piece.astype("<u4").tobytes()) if c == "ids_crc32" else piece.astype(np.int32) for c in values]
                        for c, v in zip(names, (doc, start, take, *value, len(ids), (p << 32) + filled // length, offset), strict=True):
                            out[c].append(v)
                        start, filled = start + take, filled + take
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def pack_along_curve(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, length: int = 1024, values: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all of ``docs`` (doc_id, text).

    Each document's ids end with one id 0; NULL and empty texts are that id alone. Every id lies in one piece. Ties on
    the curve go by doc_id's hash and doc_id; repeated rows are packed as often as they occur. No rows, no pieces.
    ``values`` may name ids_crc32 (of the little-endian 32-bit ids) beside or in place of ids.
    """
    rows = only(docs, "doc_id", "text")
    size, count = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    parts = int(min(MAX_PARTS, max(1, -(-(size or 0) // PART_BYTES))))
    borders: list[int] = []
    tool = (tokenizer, ranks, pattern)
    if parts > 1:
        share = min(1.0, SAMPLE_DOCS / count)
        some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        places = np.sort([r[0] for r in some.mapInArrow(_sampled(tool), "place long").limit(2 * SAMPLE_DOCS).collect()])
        if len(places):
            borders = [int(places[len(places) * i // parts]) for i in range(1, parts)]
    tokens = rows.mapInArrow(_tokenised(borders, tool), "doc_id long, part int, place long, ids binary")
    # One task a part: hashed part numbers would meet in some tasks and leave others empty.
    ordered = tokens.repartitionById(parts, "part").sortWithinPartitions("part", "place", "doc_id", F.crc32("ids"))
    ids = ", ".join("ids array<int>" if c == "ids" else f"{c} long" for c in values)
    return ordered.mapInArrow(_packed(length, list(values)), f"doc_id long, start long, length long, {ids}, doc_tokens long, sequence_id long, offset long")


def piece_digests(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, length: int = 1024) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return pack_along_curve(docs, tokenizer, ranks, pattern, length, ("ids_crc32",))
