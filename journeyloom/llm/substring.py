"""Removal of word runs that an earlier document already has, found with an FM-index per shard.

Every window of ``window`` words has an anchor, the least hash among its runs of GRAM words, which equal windows
share. Stretches of windows with one anchor are segments. Segments whose anchor occurs in one document only cannot
repeat and go no further. The others are sharded by anchor, so equal windows meet in one shard. A shard builds
a suffix order to a depth of 16 words, its Burrows-Wheeler transform in a wavelet matrix, and searches all windows of the
streamed segments backwards; windows that end in one interval are equal, and those with a smaller document in it
go. Word ids are 32-bit hashes; a second hash of the whole window confirms a match.

Hot passages: within a batch, only the smallest document of equal segments is searched, the others are known
repeats at once and travel under random keys. A shard so gets a hot segment once a batch at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from journeyloom.llm.texts import Words, column_bytes, mix, only, run_hashes, signed, split_words, white_table, word_slices

WINDOW, GRAM = 13, 5
LONGEST = 64
#: Postings of anchors a byte of text has at most on average, and how many postings and segments a task gets.
DENSITY, PART_POSTINGS, PART_SEGMENTS = 0.04, 1_500_000, 100_000
LAST = (1 << 63) - 1


def segments(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, number of windows, anchor) of the segments of a slice, and its word hashes."""
    h = words.hashes()
    n = len(h) - window + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64), h
    grams = run_hashes(h, gram)
    least, width, span = grams, 1, window - gram + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    row = words.doc[:n]
    at = np.arange(n)
    inside = at + window <= words.first[row + 1]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]
    start = np.maximum.accumulate(np.where(new, at, 0))
    new |= (at - start) % LONGEST == 0
    first = np.flatnonzero(new & inside)
    # A segment ends before the next one, or with its row's last window.
    ends = np.append(np.flatnonzero(new), n)
    stop = ends[np.searchsorted(ends, first, "right")]
    stop = np.minimum(stop, words.first[row[first] + 1] - window + 1)
    return row[first], first, stop - first, least[first], h


def _shared(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether the row's key occurs with more than one document."""
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    length = np.diff(np.append(first, len(k)))
    found = np.zeros(len(key), bool)
    found[order] = np.repeat(d[first] != d[first + length - 1], length)
    return found


def _anchors(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()
            parts = []
            for row, _, words in word_slices(batch.column("text")):
                of, first, _, anchor, _ = segments(words, window, gram)
                parts.append((anchor, of + row, first - words.first[of]))
            anchor, of, first = (np.concatenate(c) for c in zip(*parts, strict=True))
            doc, key = ids[of], keys[of]
            known = _shared(anchor, doc)
            # Known repeats only tell other batches of their anchor once, and travel under random keys themselves.
            _, told = np.unique(anchor[known], return_index=True)
            marks = np.flatnonzero(known)[told]
            away = mix(doc.view(np.uint64) ^ mix(first.astype(np.uint64)))
            send = np.where(known, away, anchor)
            every = lambda x, extra: pa.array(np.concatenate((x, extra)))
            yield pa.record_batch(
                [
                    every(signed(send), signed(anchor[marks])),
                    every(doc, doc[marks]),
                    every(key, key[marks]),
                    every((first << 2) | known, np.full(len(marks), 2)),
                ],
                ["anchor", "doc_id", "text_key", "place"],
            )

    return run


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, start) of segments whose anchor has two documents and more; marks count as many."""
    parts = [[c.to_numpy() for c in b.columns] for b in batches]
    if not parts:
        return
    anchor, doc, key, place = (np.concatenate(c) for c in zip(*parts, strict=True))
    del parts
    known, mark = (place & 1) == 1, (place & 2) == 2
    at = np.flatnonzero(~known)
    stays = known.copy()
    stays[at] = _shared(anchor[at], np.where(mark[at], -1 - at, doc[at]))
    # A mark stands for two documents, so whatever shares its anchor stays; the mark itself is no posting.
    stays &= ~mark
    for low in range(0, len(doc), 1 << 18):
        some = slice(low, low + (1 << 18))
        keep = stays[some]
        yield pa.record_batch([pa.array(doc[some][keep]), pa.array(key[some][keep]), pa.array((place[some][keep] >> 2).astype(np.int32))], ["doc_id", "text_key", "start"])


def _segment_rows(window: int, gram: int):
    names = ["anchor", "doc_id", "text_key", "place", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()
            starts = batch.column("starts")
            for row, _, words in word_slices(batch.column("text")):
                of, first, count, anchor, h = segments(words, window, gram)
                local = first - words.first[of]
                wanted = np.concatenate([(np.int64(i) << 40) + starts[int(row + i)].values.to_numpy().astype(np.int64) for i in range(len(words.first) - 1)])
                keep = np.isin((of << 40) + local, wanted)
                of, first, count, anchor, local = of[keep], first[keep], count[keep], anchor[keep], local[keep]
                if not len(of):
                    continue
                small = (h >> np.uint64(32)).astype(np.uint32)
                full = run_hashes(h, window)
                checks = full.astype(np.uint16)
                doc = ids[row + of]
                # Equal segments of the slice: all but those of the smallest document are repeats.
                total = np.concatenate(([np.uint64(0)], np.cumsum(full)))
                same = total[first + count] - total[first] + mix(count.astype(np.uint64))
                order = np.lexsort((doc, same))
                lead = np.maximum.accumulate(np.where(np.concatenate(([True], same[order][1:] != same[order][:-1])), np.arange(len(order)), 0))
                repeat = np.zeros(len(doc), bool)
                repeat[order] = doc[order] > doc[order][lead]
                away = signed(mix(doc.view(np.uint64) ^ mix(local.astype(np.uint64))))
                send = np.where(repeat, away, signed(anchor))
                blobs = [
                    None if r else small[f : f + n + window - 1].tobytes() + checks[f : f + n].tobytes()
                    for f, n, r in zip(first.tolist(), count.tolist(), repeat.tolist(), strict=True)
                ]
                # place: first window and, in the lowest byte, the number of windows.
                yield pa.record_batch([pa.array(send), pa.array(doc), pa.array(keys[row + of]), pa.array((local << 8) | count), pa.array(blobs, pa.binary())], names)

    return run


class Bits:
    """A bit vector with rank: every number holds 32 bits and, above them, how many ones come before."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 32 + 1) * 32, np.uint8)
        padded[: len(bits)] = bits
        words = np.packbits(padded, bitorder="little").view("<u4").astype(np.uint64)
        ones = np.cumsum(np.bitwise_count(words), dtype=np.uint64)
        self.blocks = words | (np.concatenate(([np.uint64(0)], ones[:-1])) << np.uint64(32))

    def ones(self, at: np.ndarray) -> np.ndarray:
        block = self.blocks[at >> 5]
        inside = np.bitwise_count(block & _BELOW[at & 31])
        return (block >> np.uint64(32)).astype(np.int32) + inside


_BELOW = (np.uint64(1) << np.arange(32, dtype=np.uint64)) - np.uint64(1)
#: Searches advance in blocks of this many patterns, so that their state stays in the processor's cache.
BLOCK = 8_192


class FmIndex:
    """Backward search over a wavelet matrix of the Burrows-Wheeler transform, for patterns of up to 16 symbols."""

    def __init__(self, text: np.ndarray):
        """``text`` holds symbols without gaps and ends with 0, which no pattern contains."""
        n = len(text)
        rank, step = text.astype(np.int64), 1
        while step < 16:
            ahead = np.concatenate((rank[step:] + 1, np.zeros(min(step, n), np.int64)))[:n]
            _, rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)
            step *= 2
        suffixes = np.argsort(rank, kind="stable")
        current = text[suffixes - 1].astype(np.uint32)
        symbols = int(text.max()) + 1
        self.counts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols)))).astype(np.int32)
        self.levels: list[tuple[int, Bits, int]] = []
        for level in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            bits = ((current >> level) & 1).astype(np.uint8)
            zeros = int(n - bits.sum())
            self.levels.append((level, Bits(bits), zeros))
            current = np.concatenate((current[bits == 0], current[bits == 1]))
        # Where each symbol's run begins below the last level.
        self.begins = np.zeros(symbols, np.int32)
        self.begins = self._descended(np.arange(symbols, dtype=np.int32), self.begins)

    def _descended(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbols >> level) & 1, zeros + ones, at - ones)
        return at

    def occurrences(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before each position."""
        return self._descended(symbols, at) - self.begins[symbols]

    def search(self, text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the runs of ``length`` symbols at ``starts``; a run that occurs once may end its search early."""
        text = text.astype(np.int32)
        symbol = text[starts + length - 1]
        low, high = self.counts[symbol], self.counts[symbol + 1]
        for block in range(0, len(starts), BLOCK):
            alive = np.arange(block, min(block + BLOCK, len(starts)))
            for step in range(length - 2, -1, -1):
                alive = alive[high[alive] - low[alive] > 1]
                if not len(alive):
                    break
                symbol = text[starts[alive] + step]
                base = self.counts[symbol]
                found = self.occurrences(np.concatenate((symbol, symbol)), np.concatenate((low[alive], high[alive])))
                low[alive], high[alive] = base + found[: len(alive)], base + found[len(alive) :]
        return low, high


def _searched(window: int):
    """Word spans (doc_id, text_key, first, last) of a shard that documents with smaller ids have as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            known = batch.column("words").is_null()
            repeats = batch.filter(known)
            if repeats.num_rows:
                place = repeats.column("place").to_numpy()
                yield _spans(repeats.column("doc_id"), repeats.column("text_key"), place >> 8, (place >> 8) + (place & 255) + window - 1)
            rows.append(batch.filter(pa.compute.invert(known)))
        if not any(b.num_rows for b in rows):
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        rows.clear()
        doc, place = table["doc_id"].to_numpy(), table["place"].to_numpy()
        start, count = place >> 8, place & 255
        # Equal segments are indexed and searched once, for the smallest of their documents.
        blobs = table["words"].combine_chunks().dictionary_encode()
        which = blobs.indices.to_numpy()
        first_of = np.full(len(blobs.dictionary), len(doc), np.int64)
        np.minimum.at(first_of, which, np.arange(len(doc)))
        least = np.full(len(blobs.dictionary), LAST, np.int64)
        np.minimum.at(least, which, doc)
        distinct = count[first_of]
        lengths = distinct + window - 1
        parts = [x.as_py() for x in blobs.dictionary]
        words = np.frombuffer(b"".join([x[: 4 * n] for x, n in zip(parts, lengths.tolist(), strict=True)]), np.uint32)
        checks = np.frombuffer(b"".join([x[4 * n :] for x, n in zip(parts, lengths.tolist(), strict=True)]), np.uint16)
        # Symbol 0 stands between segments.
        text = np.zeros(len(words) + len(distinct), np.int64)
        within = np.arange(len(words)) + np.repeat(np.arange(len(distinct)), lengths)
        text[within] = np.unique(words, return_inverse=True)[1] + 1
        begin = np.cumsum(lengths + 1) - lengths - 1
        of = np.repeat(np.arange(len(distinct)), distinct)
        offset = np.cumsum(distinct) - distinct
        low, high = FmIndex(text).search(text, begin[of] + np.arange(len(of)) - offset[of], window)
        # The smallest document of each window: of its segment, or of all in its interval with the same check.
        owner = least[of]
        many = np.flatnonzero(high - low > 1)
        keys = (low[many].astype(np.int64) << 16) | checks[many]
        order = np.lexsort((owner[many], keys))
        k, o = keys[order], owner[many][order]
        lead = np.maximum.accumulate(np.where(np.concatenate(([True], k[1:] != k[:-1])), np.arange(len(k)), 0)) if len(k) else order
        owner[many[order]] = o[lead]
        # Back to all segments.
        segment = np.repeat(np.arange(len(doc)), count)
        order_in = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
        gone = doc[segment] > owner[offset[which[segment]] + order_in]
        # Runs of removed windows within a segment become one span.
        runs = gone & ~np.concatenate(([False], gone[:-1] & (segment[1:] == segment[:-1])))
        last = gone & ~np.concatenate((gone[1:] & (segment[1:] == segment[:-1]), [False]))
        first, last = np.flatnonzero(runs), np.flatnonzero(last)
        of = segment[first]
        at = start[of] + order_in[first]
        yield _spans(pa.array(doc[of]), table["text_key"].combine_chunks().take(pa.array(of)), at, at + (last - first) + window)

    return run


def _spans(doc: pa.Array, key: pa.Array, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([doc, key, pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], ["doc_id", "text_key", "first", "last"])


def _keyed(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.hash("text").alias("text_key"), "text")


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Word spans [first, last) of each text (doc_id, text_key) whose windows also start in a smaller document.

    Rows are (doc_id, text_key, first, last); spans may touch or overlap. text_key is a hash of the text. A NULL id
    counts as the largest one; rows with the same id never remove each other's words.
    """
    rows = _keyed(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, int(size * DENSITY / PART_POSTINGS) + 1)
    anchors = rows.where("text is not null").mapInArrow(_anchors(window, gram), "anchor long, doc_id long, text_key int, place long")
    stay = anchors.repartition(parts, "anchor").mapInArrow(_survivors, "doc_id long, text_key int, start int")
    stay = stay.groupBy("doc_id", "text_key").agg(F.collect_list("start").alias("starts"))
    found = rows.join(stay, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "starts").mapInArrow(
        _segment_rows(window, gram), "anchor long, doc_id long, text_key int, place long, words binary"
    )
    shards = max(1, int(size * DENSITY / 4 / PART_SEGMENTS) + 1)
    return found.repartition(shards, "anchor").mapInArrow(_searched(window), "doc_id long, text_key int, first int, last int")


def _removed(words: Words, spans: pa.Scalar) -> np.ndarray:
    """Whether each word lies in a span."""
    change = np.zeros(len(words.starts) + 1, np.int64)
    if spans.is_valid:
        np.add.at(change, spans.values.field("first").to_numpy(), 1)
        np.add.at(change, spans.values.field("last").to_numpy(), -1)
    return np.cumsum(change[:-1]) > 0


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    separators = white_table()
    for batch in batches:
        out: dict[str, list] = {"n_words": [], "n_removed": [], "text": []}
        raw, offsets = column_bytes(batch.column("text"))
        for i, spans in enumerate(batch.column("spans")):
            data = raw[offsets[i] : offsets[i + 1]]
            words = split_words(data, np.array([0, len(data)]), separators)
            n = len(words.starts)
            keep = np.flatnonzero(~_removed(words, spans))
            blob = data.tobytes()
            out["n_words"].append(n)
            out["n_removed"].append(n - len(keep))
            out["text"].append(b" ".join([blob[a:b] for a, b in zip(words.starts[keep].tolist(), words.ends[keep].tolist(), strict=True)]))
        arrays = [pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64())]
        yield pa.record_batch(
            [batch.column("row_doc"), *arrays, pa.array(out["text"], pa.binary()), pa.array([hashlib.sha256(t).hexdigest() for t in out["text"]])],
            ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
        )


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256) of every row of ``docs`` (doc_id, text).

    ``kept`` is the remaining words joined by one space (binary UTF-8). NULL and empty texts have no words; texts
    shorter than a window keep all; of equal texts the one with the smallest id keeps its words; repeated rows are
    treated alike. No rows give no rows.
    """
    rows = _keyed(docs).join(_grouped(docs, window, gram), ["doc_id", "text_key"], "left")
    rows = rows.select(F.when(F.col("doc_id") != LAST, F.col("doc_id")).alias("row_doc"), "text", "spans")
    return rows.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string")


def _grouped(docs: DataFrame, window: int, gram: int) -> DataFrame:
    return repeated_spans(docs, window, gram).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def cut_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated words, and the white space after each, cut from ``text``; all other text stays as it is.

    Columns and rows stay; n_chars, if there is one, is counted anew for the texts that change. NULL texts stay NULL.
    """
    spans = _grouped(docs, window, gram).select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.col("spans").alias("_spans"))
    keys = (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)) == F.col("_doc")) & (F.hash("text") == F.col("_key"))
    rows = docs.join(spans, keys, "left").drop("_doc", "_key")
    at = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    separators = white_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, columns = batch.column(at).to_pylist(), batch.columns[:-1]
            counts = columns[count].to_pylist() if count is not None else None
            for i, marks in enumerate(batch.column(batch.num_columns - 1)):
                if texts[i] is None or not marks.is_valid:
                    continue
                data = texts[i].encode()
                words = split_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), separators)
                gone = _removed(words, marks)
                # Every stretch of kept words goes from its first byte to the start of the next removed word.
                edges = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True])).astype(np.int8)))
                begin = np.append(words.starts, len(data))
                begin[0] = 0 if len(gone) and not gone[0] else begin[0]
                texts[i] = b"".join([data[begin[a] : begin[b]] for a, b in edges.reshape(-1, 2).tolist()]).decode()
                if counts is not None:
                    counts[i] = len(texts[i])
            columns[at] = pa.array(texts, columns[at].type)
            if counts is not None:
                columns[count] = pa.array(counts, columns[count].type)
            yield pa.record_batch(columns, batch.schema.names[:-1])

    return rows.mapInArrow(run, docs.schema)
