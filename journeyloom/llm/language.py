"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of order 0 to ORDER with frozen counts. A byte costs log2((n + q) / c) bits in
the longest context that has seen it (n bytes, q different ones, c times this one), plus log2((n + q) / q) for every
longer known context that it escapes from, and 8 bits below order 0; no symbols are excluded after an escape.
A context begins at the space before the word, so a text's code length is the sum over its words and every different
word of a batch is scored once. ASCII letters count as lower case; other ASCII symbols and white space separate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from journeyloom.llm.texts import Words, crc_remainder, only, symbol_table, word_slices

ORDER = 4
#: Documents that the trees of one language are grown from, at most (chosen by hash, whole texts).
TRAIN_DOCS = 2_000
UNKNOWN = "und"


def context_keys(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the chosen words, each between spaces: (word number, last 8 bytes as one number, bytes of context)."""
    starts, ends = words.starts[chosen], words.ends[chosen]
    lengths = ends - starts
    own = np.repeat(np.arange(len(chosen)), lengths + 2)
    begin = np.cumsum(lengths + 2) - lengths - 2
    place = np.arange(len(own)) - begin[own]
    inner = (place > 0) & (place <= lengths[own])
    text = np.full(len(own), 32, np.uint64)
    text[inner] = words.data[(starts[own] + place - 1)[inner]]
    joined = text.copy()
    for back in range(1, ORDER + 1):
        joined[back:] |= text[: len(text) - back] << np.uint64(8 * back)
    scored = place > 0
    return own[scored], joined[scored], np.minimum(place[scored], ORDER)


def gram_key(joined: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` + 1 bytes under their order: one number for a context and the byte after it."""
    mask = np.uint64((1 << (8 * (order + 1))) - 1)
    return (joined & mask) | np.uint64((order + 1) << 56)


@dataclass
class ContextTrees:
    """Code lengths of all known grams in all languages, and the escape costs of their contexts."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    escapes: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def grown(languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray) -> ContextTrees:
        """From rows (language number, gram key, count)."""
        grams, escapes = [], []
        for order in range(ORDER + 1):
            rows = (gram >> 56) == order + 1
            keys, at = np.unique(gram[rows], return_inverse=True)
            seen = np.zeros((len(keys), len(languages)))
            np.add.at(seen, (at, language[rows]), count[rows])
            context, of = np.unique((keys & ((1 << 56) - 1)) >> 8, return_inverse=True)
            n, q = np.zeros((2, len(context), len(languages)))
            np.add.at(n, of, seen)
            np.add.at(q, of, seen > 0)
            total = n + q
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(n > 0, np.log2(total / q), 0.0)
                own = np.log2(total[of] / seen)
            if order:
                shorter = (keys & ((1 << (8 * order)) - 1)) | (order << 56)
                below = grams[order - 1][1][np.searchsorted(grams[order - 1][0], shorter)]
            else:
                below = np.full(seen.shape, 8.0)
            grams.append((keys, np.where(seen > 0, own, escape[of] + below)))
            escapes.append((context, escape))
        return ContextTrees(languages, grams, escapes)

    def bits(self, joined: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Code length of every byte in every language."""
        cost = np.zeros((len(joined), len(self.languages)))
        open_ = np.arange(len(joined))
        for order in range(ORDER, -1, -1):
            some = open_[depth[open_] >= order]
            keys, values = self.grams[order]
            context, escape = self.escapes[order]
            if not len(some) or not len(keys):
                continue
            key = gram_key(joined[some], order).astype(np.int64)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            cost[some[hit]] += values[at[hit]]
            missed = some[~hit]
            before = ((key[~hit] & ((1 << 56) - 1)) >> 8).astype(np.int64)
            at = np.minimum(np.searchsorted(context, before), len(context) - 1)
            known = context[at] == before
            cost[missed[known]] += escape[at[known]]
            open_ = np.setdiff1d(open_, some[hit], assume_unique=True)
        cost[open_] += 8.0
        return cost


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for row, stop, words in word_slices(batch.column("text"), symbol_table(), lower=True):
            doc = words.doc + row
            for lang in sorted(set(langs[row:stop])):
                own = np.flatnonzero(langs[doc] == lang)
                _, joined, depth = context_keys(words, own)
                keys = np.concatenate([gram_key(joined[depth >= o], o) for o in range(ORDER + 1)])
                keys, counts = np.unique(keys.astype(np.int64), return_counts=True)
                yield pa.record_batch([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], ["lang", "gram", "count"])


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _predicted(trees: ContextTrees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            totals = np.zeros((batch.num_rows, max(1, len(trees.languages))))
            letters = np.zeros(batch.num_rows, bool)
            for row, stop, words in word_slices(column, symbol_table(), lower=True):
                letters[row + np.unique(words.doc[(words.data[words.starts] >= 97) & (words.data[words.starts] < 123)])] = True
                if not len(words.starts) or not trees.languages:
                    continue
                _, first, of = np.unique(words.hashes(), return_index=True, return_inverse=True)
                costs = np.zeros((len(first), len(trees.languages)))
                for low in range(0, len(first), 20_000):
                    own, joined, depth = context_keys(words, first[low : low + 20_000])
                    bits = trees.bits(joined, depth)
                    edges = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                    costs[low : low + 20_000] = np.add.reduceat(bits, edges)
                for k in range(len(trees.languages)):
                    totals[row:stop, k] += np.bincount(words.doc, costs[of, k], stop - row)
            named, scores = [], []
            best = totals.argmin(1)
            for i, text in enumerate(column):
                if not trees.languages or not (letters[i] or _has_letter(text.as_py())):
                    named.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    named.append(trees.languages[best[i]])
                    scores.append(float(1 / np.exp2(np.clip(totals[i, best[i]] - totals[i], -1000, 0)).sum()))
            keep = [batch.column(c) for c in ("doc_id", "held_out")]
            yield pa.record_batch([*keep, pa.array(named, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def grow_trees(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> ContextTrees:
    """Context trees of the labelled texts ``docs`` (key, text, lang); at most about ``train_docs`` a language.

    What reaches the driver is the counts of the grams of those bounded samples.
    """
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return ContextTrees([], [], [])
    shares = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, train_docs / sizes[k]))])
    some = docs.where(F.pmod(F.xxhash64("key", F.lit("trees")), F.lit(1_000_000)) < F.element_at(shares, F.col("lang")) * 1_000_000)
    counts = some.select("text", "lang").mapInArrow(_counted, "lang string, gram long, count long").groupBy("lang", "gram").agg(F.sum("count").alias("count")).toPandas()
    number = {k: i for i, k in enumerate(languages)}
    return ContextTrees.grown(languages, counts["lang"].map(number).to_numpy(np.int64), counts["gram"].to_numpy(np.int64), counts["count"].to_numpy(float))


def identify_languages(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang).

    Trees grow from rows with text and lang that are not held out (crc32(doc_id) mod 5 is 0). score is the posterior of
    the shortest code under equal priors; ties go to the first language by name. NULL texts and texts without a letter
    are ``und`` with score 0, and so is everything if there is nothing to learn from. Repeated rows are scored alike.
    """
    rows = only(docs, "doc_id", "text", "lang").withColumn("held_out", crc_remainder("doc_id", 5) == 0)
    trees = grow_trees(rows.where("not held_out and text is not null and lang is not null").select(F.col("doc_id").alias("key"), "text", "lang"), train_docs)
    return rows.select("doc_id", "held_out", "text").mapInArrow(_predicted(trees), "doc_id long, held_out boolean, lang_pred string, score double")
