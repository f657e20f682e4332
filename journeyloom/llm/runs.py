"""Periodic runs of words by a sparse diagonal DP, and texts with every run collapsed to its first period.

A run with period p is a stretch of a diagonal: consecutive words that equal the word p places before them. For lags
below SHORT the diagonals are walked word by word. For lags from 2g to 4g (g = 4, 8, 16, ...) the walk goes in steps of g
words: the earlier occurrences of a block of g words, at those lags, add g to the match lengths of the active diagonals;
a diagonal that the next block does not continue has ended, is extended to its exact ends and is emitted at once if it is
long enough. A run of period p matches over at least p >= 2g words, so it holds a whole block, and no run is lost.

Only blocks that occur twice are kept from one g to the next (a block of 2g words is the pair of its halves), so ordinary
text leaves nothing to do after a few steps, and a text of n words that is all one word costs n log n, not n * n.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from journeyloom.llm.texts import mix, only, word_slices

LEAST_LENGTH = 12
#: Lags below this are walked word by word.
SHORT = 8
_RUNS = "array<struct<start:long,length:long,period:long>>"


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Dense ids of the keys that occur more than once, -1 for the others."""
    _, at, times = np.unique(keys, return_inverse=True, return_counts=True)
    names = np.where(times > 1, np.cumsum(times > 1) - 1, -1)
    return names[at].astype(np.int32)


def _doubled(ids: np.ndarray, g: int, until: np.ndarray) -> np.ndarray:
    """Ids of the blocks of 2g words, from those of g words; ``until`` is the end of each place's document."""
    out = np.full(len(ids), -1, np.int32)
    at = np.flatnonzero(ids >= 0)
    at = at[at + 2 * g <= until[at]]
    at = at[ids[at + g] >= 0]
    if len(at):
        out[at] = _repeated(ids[at].astype(np.int64) * (1 << 32) + ids[at + g])
    return out


def _short_lags(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(start, end, lag) of the long enough diagonals of each lag below SHORT."""
    for lag in range(1, min(SHORT, len(ids))):
        same = np.concatenate(([False], (ids[lag:] == ids[:-lag]) & (ids[lag:] >= 0), [False]))
        begin, end = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2).T
        long = end - begin >= max(LEAST_LENGTH - lag, lag)
        yield begin[long], end[long] + lag, lag


def _active(ids: np.ndarray, g: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the blocks at multiples of g and their earlier occurrences at lags from 2g to 4g."""
    n = np.int64(len(ids) + 1)
    at = np.flatnonzero(ids >= 0)
    seen = np.sort(ids[at] * n + at)
    block = at[(at % g == 0) & (at >= 2 * g)]
    base = ids[block] * n
    low = np.searchsorted(seen, base + np.maximum(block - 4 * g + 1, 0))
    count = np.searchsorted(seen, base + block - 2 * g, "right") - low
    first = np.cumsum(count) - count
    places = np.repeat(low - first, count) + np.arange(count.sum())
    block = np.repeat(block, count)
    return block, block - seen[places] % n


def _extended(levels: list[np.ndarray], begin: np.ndarray, end: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact ends of diagonals that reach less than a block beyond ``begin`` and ``end``, by halving steps."""
    n = len(levels[0])
    for t in range(len(levels) - 2, -1, -1):
        ids, step = levels[t], 1 << t
        at = np.maximum(begin - step, 0)
        back = begin - step - lag
        same = (back >= 0) & (ids[at] >= 0) & (ids[at] == ids[np.maximum(back, 0)])
        begin = begin - step * same
        at = np.minimum(end, n - 1)
        same = (end < n) & (ids[at] >= 0) & (ids[at] == ids[np.minimum(end - lag, n - 1)])
        end = end + step * same
    return begin, end


def find_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all runs of consecutive documents, sorted by start, then period.

    ``words`` are word hashes, ``first`` the places where the documents begin and the last one ends.
    """
    sizes = np.diff(first)
    doc = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    until = np.repeat(first[1:], sizes)
    ids = _repeated(mix(words + mix(doc + np.uint64(1))))
    found = [(b, e, np.full(len(b), lag)) for b, e, lag in _short_lags(ids)]
    levels, g = [ids], 1
    while (levels[-1] >= 0).any():
        if 2 * g >= SHORT:
            block, lag = _active(levels[-1], g)
            order = np.lexsort((block, lag))
            block, lag = block[order], lag[order]
            goes_on = (lag[1:] == lag[:-1]) & (block[1:] == block[:-1] + g)
            new = np.flatnonzero(np.concatenate((np.full(min(1, len(lag)), True), ~goes_on)))
            last = np.append(new[1:], len(lag))[: len(new)] - 1
            begin, end = _extended(levels, block[new], block[last] + g, lag[new])
            long = end - begin >= lag[new]
            found.append((begin[long] - lag[new][long], end[long], lag[new][long]))
        levels.append(_doubled(levels[-1], g, until))
        g *= 2
    start, end, period = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
    # A stretch is found with its multiples as well; the smallest one is its period.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        least = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))
        start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def planted_period(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(place, period) from which a document's words repeat in the evaluated variant of the texts, None for most.

    A NULL id counts as the empty text.
    """
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    place = g % n
    return place, 1 + (n - place) // (3 + g % 8)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The words of each document, joined by one space."""
    length = ends - starts + 1
    out = np.cumsum(length) - length
    total = int(length.sum())
    padded = np.append(data, np.uint8(32))
    joined = padded[np.arange(total) + np.repeat(starts - out, length)] if total else np.zeros(0, np.uint8)
    joined[out + length - 1] = 32
    blob, bounds = joined.tobytes(), np.append(out, total)[first]
    return [blob[a : max(a, b - 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _found(planted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for row, stop, words in word_slices(batch.column("text")):
                first, sizes = words.first, np.diff(words.first)
                source = np.arange(first[-1])
                for k in range(stop - row if planted else 0):
                    plan = planted_period(ids[row + k], int(sizes[k]))
                    if plan:
                        place, period = first[k] + plan[0], plan[1]
                        source[place : first[k + 1]] = place + np.arange(first[k + 1] - place) % period
                start, end, period = find_runs(words.hashes()[source], first)
                gone = np.zeros(len(source) + 1, np.int64)
                np.add.at(gone, start + period, 1)
                np.add.at(gone, end, -1)
                kept = np.cumsum(gone[:-1]) == 0
                left = np.concatenate(([0], np.cumsum(kept)))[first]
                texts = _joined(words.data, words.starts[source][kept], words.ends[source][kept], left)
                doc = np.searchsorted(first, start, "right") - 1
                values = [pa.array(x) for x in (start - first[doc], end - start, period)]
                runs = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(doc, np.arange(stop - row + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays(values, ["start", "length", "period"]),
                )
                yield pa.record_batch(
                    [batch.column("doc_id").slice(row, stop - row), pa.array(sizes, pa.int64()), runs, pa.array(texts, pa.binary())],
                    ["doc_id", "n_words", "runs", "kept"],
                )

    return run


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, kept) of every row of ``docs`` (doc_id, text).

    ``runs`` holds (start, length, period) of each run by start, then period: a longest stretch of words whose smallest
    period is ``period`` and which is at least LEAST_LENGTH words and two periods long. ``kept`` (binary UTF-8) is the
    words joined by one space without those that a run covers after its first period. With ``planted``, the words of one
    document in ten repeat from a place on (``planted_period``).

    NULL and empty texts have no words and no runs; repeated rows and NULL ids are rows like others; texts of any length
    are read whole; no rows give no rows.
    """
    rows = only(docs, "doc_id", "text")
    return rows.mapInArrow(_found(planted), f"doc_id long, n_words long, runs {_RUNS}, kept binary")


def _longest(field: str) -> Column:
    """A field of the run of greatest length, then smallest start, then smallest period."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    value = best[field]
    return value if field == "length" else -value


def run_digests(found: DataFrame) -> DataFrame:
    """One row for each of ``periodic_runs``: number of runs, the longest one, and digests of the runs and the kept words."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[_longest(c).alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * _longest("length") / _longest("period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
