"""Benchmark decontamination by template canonicalisation.

A text becomes a template: numbers, names and units turn into typed placeholders (a run of names is one), other words count
in lower case without outer punctuation. Windows of template tokens are hashed and joined with those of the
benchmark. A capital at the start of a sentence may begin a name or not, so each text has two readings, with those words
as they are and as names; items and documents meet in each. Matches of one item that lie together in a document are aligned, and the values in the slots are compared:
the same value of the item must always stand for the same value of the document, as it does when a question is asked
again with other parameters. Windows that are mostly slots are hashed with their values and so meet equal ones only. A
document leaks an item if the aligned matches of any place cover enough of it consistently.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from journeyloom.llm.texts import Words, mix, run_hashes, signed, word_slices

WINDOW, SHORTEST = 8, 4
#: A run of so many tokens is a leak; shorter items must be covered to SHARE.
RUN, SHARE, CONSISTENT = 13, 0.8, 0.8
LEAST_LITERAL = 0.5
#: Benchmarks of up to this many windows also filter the documents' windows before the join.
FILTER_WINDOWS = 2_000_000
NUMBER, NAME, UNIT, WORD = 1, 2, 3, 0
#: Whether a capitalised word at the start of a sentence is a name.
READINGS = (False, True)
# Measures, currencies and times that follow a number.
UNITS = (
    "mm cm m km inch inches in ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds oz ounce ounces ml l liter liters litre litres gallon gallons"
    " s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years ms km/h mph kmh m/s hz khz mhz ghz w kw mw v volt volts a amp amps j kj n pa kpa c f k"
    " celsius fahrenheit kelvin degree degrees percent % dollar dollars euro euros cent cents usd eur gbp yen kb mb gb tb bit bits byte bytes square cubic meter meters metre metres kilometer kilometers kilometre kilometres"
).split()


def _unit_hashes() -> np.ndarray:
    column = pa.array([" ".join(UNITS)])
    return np.unique(next(word_slices(column, lower=True))[2].hashes())


def templates(words: Words, lowered: Words, units: np.ndarray, names_begin: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token, kind, place, value) of the template tokens of a slice: index of the token's word, its hash without outer punctuation.

    ``words`` and ``lowered`` are the slice as written and with A-Z lower-cased. With ``names_begin`` a capitalised word at
    the start of a sentence is a name too.
    """
    data, starts, ends = words.data, words.starts.copy(), words.ends.copy()
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    alnum = np.isin(data, list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")) | (data >= 128)
    # The core runs from the word's first to its last letter, digit or other non-ASCII byte.
    solid = np.flatnonzero(alnum)
    low = np.searchsorted(solid, starts)
    high = np.searchsorted(solid, ends) - 1
    some = low <= high
    core_start, core_end = starts.copy(), ends.copy()
    core_start[some], core_end[some] = solid[low[some]], solid[high[some]] + 1
    digit = (data >= 48) & (data < 58)
    numeric = digit | np.isin(data, list(b".,:/-+%"))
    sums = np.concatenate((np.zeros((2, 1), np.int64), np.cumsum(np.stack((digit, numeric)), axis=1)), axis=1)
    digits, allowed = sums[:, core_end] - sums[:, core_start]
    kind = np.zeros(len(starts), np.int8)
    kind[digits > 0] = NUMBER
    first = data[core_start]
    second = data[np.minimum(core_start + 1, len(data) - 1)]
    capital = (first >= 65) & (first < 91) | (first == 0xC3) & (second >= 0x80) & (second < 0x9F)
    row = words.doc
    begins = np.ones(len(starts), bool)
    same = row[1:] == row[:-1]
    last = data[ends[:-1] - 1]
    begins[1:] = ~same | np.isin(last, list(b".!?:")) | (data[starts[1:] - 1] == 10)
    kind[capital & (names_begin | ~begins) & (digits == 0)] = NAME
    cores = Words(lowered.data, core_start, core_end, words.first, lowered._table).hashes()
    after = np.concatenate(([False], same & (kind[:-1] == NUMBER)))
    kind[after & np.isin(cores, units)] = UNIT
    token = np.where(kind == WORD, cores, mix(kind.astype(np.uint64)))
    keep = np.ones(len(starts), bool)
    keep[1:] = ~((kind[1:] == NAME) & (kind[:-1] == NAME) & same & ~begins[1:])
    at = np.flatnonzero(keep)
    return token[at], kind[at], at, cores[at]


def _windows(column: pa.Array, lengths: dict[int, np.ndarray | None] | None, units: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int, int, np.ndarray, np.ndarray]]:
    """(row, reading, hash, length, token place, first word, end word, slot offsets, slot values) of windows.

    ``lengths`` maps a window length to the sorted hashes to keep (None: all). Without it every row gives its own
    windows: of WINDOW tokens, or one of all its tokens if it has fewer (SHORTEST at least).
    """
    for (row0, stop, words), (_, _, lowered) in zip(word_slices(column), word_slices(column, lower=True), strict=True):
        for reading in range(len(READINGS)):
            token, kind, at, values = templates(words, lowered, units, READINGS[reading])
            bounds = np.searchsorted(at, words.first)
            row = np.repeat(np.arange(stop - row0), np.diff(bounds))
            sizes = np.diff(bounds)
            wanted = {WINDOW: None, **{int(n): None for n in np.unique(sizes) if SHORTEST <= n < WINDOW}} if lengths is None else lengths
            for length, known in wanted.items():
                hashes = run_hashes(token, length)
                if not len(hashes):
                    continue
                start = np.arange(len(hashes))
                good = start + length <= bounds[row[start] + 1]
                if lengths is None and length < WINDOW:
                    good &= sizes[row[start]] == length
                literal = np.concatenate(([0], np.cumsum(kind == WORD)))
                few = literal[start + length] - literal[start] < LEAST_LITERAL * length
                hashes = np.where(few, mix(run_hashes(values, length)), hashes)
                good = np.flatnonzero(good)
                if known is not None:
                    place = np.searchsorted(known, hashes[good])
                    place[place == len(known)] = 0
                    good = good[known[place] == hashes[good]] if len(known) else good[:0]
                for i in good.tolist():
                    r = int(row[i])
                    slots = i + np.flatnonzero(kind[i : i + length])
                    yield row0 + r, reading, int(signed(hashes[i : i + 1])[0]), length, i - int(bounds[r]), int(at[i] - words.first[r]), int(at[i + length - 1] - words.first[r]) + 1, (slots - i).astype(np.int32), signed(values[slots])


SIDE = "reading int, hash long, length int, place int, first int, last int, offsets array<int>, values array<long>"


def _side(key: str, lengths: dict[int, np.ndarray | None] | None, size: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _unit_hashes()
        names = [key, "reading", "hash", "length", "place", "first", "last", "offsets", "values"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for batch in batches:
            ids = batch.column(key).to_pylist()
            rows = [(ids[r], *rest) for r, *rest in _windows(batch.column("text"), lengths, units)]
            for low in range(0, max(1, len(rows)), 20_000):
                columns = list(zip(*rows[low : low + 20_000], strict=True)) or [[] for _ in names]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return run


def _aligned(pairs: list[tuple]) -> Iterator[tuple]:
    """Every place of one document's matches of one item: (tokens, run, slots, agreeing, equal, first, last).

    A place is a cluster of near matches, and also each part of it that goes through the item once or has one shift, so
    that another copy beside it with other values does not count against it.
    """
    pairs.sort()
    cluster = []
    reach = 2 * max(p[2] for p in pairs) + WINDOW

    def judged(rows: list[tuple]) -> tuple:
        covered, by_shift, slots = set(), defaultdict(set), {}
        for doc_place, length, item_place, *_, offsets, doc_values, item_values in rows:
            tokens = range(item_place, item_place + length)
            covered.update(tokens)
            by_shift[doc_place - item_place].update(tokens)
            for o, d, i in zip(offsets, doc_values, item_values, strict=True):
                slots[item_place + o] = (i, d)
        run = 0
        for tokens in by_shift.values():
            length = 0
            for t in sorted(tokens):
                length = length + 1 if t - 1 in tokens else 1
                run = max(run, length)
        meanings = defaultdict(Counter)
        for i, d in slots.values():
            meanings[i][d] += 1
        agreeing = sum(c.most_common(1)[0][1] for c in meanings.values())
        equal = all(i == d for i, d in slots.values())
        return len(covered), run, len(slots), agreeing, equal, min(r[3] for r in rows), max(r[4] for r in rows)

    for p in [*pairs, None]:
        if cluster and (p is None or p[0] - cluster[-1][0] > reach):
            yield judged(cluster)
            passes, shifts = [[]], defaultdict(list)
            for r in cluster:
                if passes[-1] and r[2] < passes[-1][-1][2]:
                    passes.append([])
                passes[-1].append(r)
                shifts[r[0] - r[2]].append(r)
            yield from (judged(rows) for parts in (passes, shifts.values()) if len(parts) > 1 for rows in parts)
            cluster = []
        cluster.append(p)


RESULT = "doc_id long, item_id long, matched_tokens int, item_tokens int, longest_run int, slots int, consistency double, verbatim boolean, first_word int, last_word int"


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaks of (document, item) groups, whose rows follow each other by reading; of two readings that leak the fuller counts."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.bool_(), pa.int32(), pa.int32()]
    group, pairs, tokens, out, passed = None, [], 0, [], []

    def close() -> None:
        if pairs:
            for covered, run, slots, agreeing, equal, first, last in _aligned(pairs):
                consistency = agreeing / slots if slots else 1.0
                enough = run >= RUN or covered >= SHARE * tokens and covered >= SHORTEST
                if enough and consistency >= CONSISTENT:
                    passed.append((covered / tokens, consistency, -group[2], (*group[:2], covered, tokens, run, slots, consistency, equal, first, last)))

    def settle() -> None:
        if passed:
            out.append(max(passed)[-1])
            passed.clear()

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[] for _ in names]
        batch = pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        out.clear()
        return batch

    for batch in batches:
        for r in batch.to_pylist():
            here = (r["doc_id"], r["item_id"], r["reading"])
            if here != group:
                close()
                if group and here[:2] != group[:2]:
                    settle()
                group, pairs, tokens = here, [], r["item_tokens"]
            pairs.append((r["place"], r["length"], r["item_place"], r["first"], r["last"], r["offsets"], r["values"], r["item_values"]))
        yield flushed()
    close()
    settle()
    yield flushed()


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per (doc_id, item_id) of ``docs`` (doc_id, text) that leaks an item of ``benchmark`` (item_id, text).

    NULL ids, NULL and empty texts and items of fewer than SHORTEST template tokens take no part. Repeated rows and
    repeated items count once. Windows that are mostly placeholders are evidence only
    with the item's own values. No rows give no rows.
    """
    items = benchmark.where("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(_side("item_id", None, True), f"item_id long, {SIDE}")
    lengths: dict[int, np.ndarray | None] = {r["length"]: None for r in asked.select("length").distinct().collect()}
    if asked.count() <= FILTER_WINDOWS:
        for length in lengths:
            known = asked.where(F.col("length") == length).select("hash").distinct().toPandas()["hash"].to_numpy(np.int64)
            lengths[length] = np.sort(known.view(np.uint64))
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(_side("doc_id", lengths, False), f"doc_id long, {SIDE}")
    extent = asked.groupBy("item_id", "reading").agg(F.max(F.col("place") + F.col("length")).alias("item_tokens"))
    of_item = asked.join(extent, ["item_id", "reading"]).select("reading", "hash", "length", "item_id", F.col("place").alias("item_place"), "item_tokens", F.col("values").alias("item_values"), F.col("offsets").alias("item_offsets"))
    both = found.join(of_item, ["reading", "hash", "length"]).where("offsets = item_offsets").drop("item_offsets", "hash")
    return both.repartition("doc_id").sortWithinPartitions("doc_id", "item_id", "reading", "place", "item_place").mapInArrow(_judged, RESULT)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document leaks no item."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("_leaking")).distinct()
    return docs.join(found, F.col("doc_id").cast("long") == F.col("_leaking"), "left_anti")
