"""Toxicity by weak supervision.

Voters are lexicon entries (whole words) and patterns (word beginnings, and either of them coming several times) that
labelled rows show to go with toxic texts, and one voter that calls a text clean when none of the others fires. A generative model with a hidden label gives
every voter its rates under both labels and weakens voters that fire together beyond what the label explains; it is
fitted by expectation maximisation on labelled and unlabelled texts. A linear classifier on words and word
beginnings is then trained on the posterior labels and scores all texts.

The fit sees bounded samples (MAX_LABELLED, MAX_UNLABELLED documents, whole texts); scoring sees everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from journeyloom.llm.texts import Words, crc_remainder, mix, only, signed, symbol_table, word_slices

MAX_LABELLED, MAX_UNLABELLED = 24_000, 8_000
BEGINNINGS = (4, 5, 6, 7, 8)
MAX_VOTERS, MAX_FEATURES = 300, 4_000
LEAST_TEXTS = 4
#: A feature counts once for each of these numbers of occurrences in the text that it reaches.
LEVELS = (1, 2, 4)
LEAST_PRECISION = 0.9
#: Weight of an unlabelled text of certain posterior beside a labelled one.
UNLABELLED_WEIGHT = 0.05
THRESHOLD = 0.7


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) of the words and of their beginnings; rows repeat a feature as often as it occurs."""
    row = words.doc
    yield row, words.hashes()
    length = words.ends - words.starts
    for size in BEGINNINGS:
        longer = length > size
        yield row[longer], mix(words.hashes(size)[longer] + np.uint64(size))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by label that hold each feature."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for first, stop, words in word_slices(batch.column("text"), symbol_table(), lower=True):
            label = toxic[first:stop]
            for row, feature in features(words):
                order = np.lexsort((row, feature))
                r, f = row[order], feature[order]
                new = np.concatenate(([True], (f[1:] != f[:-1]) | (r[1:] != r[:-1]))) if len(f) else np.zeros(0, bool)
                keys, at = np.unique(f[new], return_inverse=True)
                bad = np.bincount(at, label[r[new]], len(keys)).astype(np.int64)
                every = np.bincount(at, minlength=len(keys))
                yield pa.record_batch([pa.array(signed(keys)), pa.array(bad), pa.array(every - bad)], ["feature", "bad", "good"])


class Lookup:
    """Places of wanted features, behind a filter on their lowest bits."""

    def __init__(self, wanted: np.ndarray):
        self.wanted = np.sort(wanted)
        self.low = np.zeros(1 << 18, bool)
        self.low[(self.wanted & np.uint64((1 << 18) - 1)).astype(np.int64)] = True

    def found(self, row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        maybe = np.flatnonzero(self.low[(feature & np.uint64((1 << 18) - 1)).astype(np.int64)])
        at = np.searchsorted(self.wanted, feature[maybe])
        at[at == len(self.wanted)] = 0
        hit = self.wanted[at] == feature[maybe] if len(self.wanted) else np.zeros(0, bool)
        return row[maybe[hit]], at[hit]

    def rows(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, column) of a text column, sorted; column is place * number of levels + level."""
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for first, _, words in word_slices(column, symbol_table(), lower=True):
            for row, feature in features(words):
                r, p = self.found(row, feature)
                parts.append((r + first, p))
        row, place = (np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True))
        both, times = np.unique(row * (len(self.wanted) + 1) + place, return_counts=True)
        row, place = both // (len(self.wanted) + 1), both % (len(self.wanted) + 1)
        reached = [times >= least for least in LEVELS]
        row, place = (np.concatenate(x) for x in ([row[k] for k in reached], [place[k] * len(LEVELS) + i for i, k in enumerate(reached)]))
        order = np.lexsort((place, row))
        return row[order], place[order]


def _present(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(wanted)
        for batch in batches:
            row, place = lookup.rows(batch.column("text"))
            counts = np.bincount(row, minlength=batch.num_rows)
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(place.astype(np.int32)))
            yield pa.record_batch([batch.column("toxic"), lists], ["toxic", "places"])

    return run


def label_model(votes: np.ndarray, known: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of label 1 for each row of 0/1 ``votes`` (the last voter says clean); ``known`` is 1, 0 or -1.

    Rates of firing under each label are smoothed counts. A voter's evidence is divided by one plus its correlations
    with the other firing voters within the labels, so copies of one signal count about once. Silence of the last voter
    says nothing that the others do not.

    Rows with equal votes and equal label are one row with their number, so memory follows the different ones.
    """
    n = len(votes)
    packed = np.concatenate((np.packbits(votes, axis=1), (known + 1).astype(np.uint8)[:, None]), axis=1)
    _, first, of, times = np.unique(packed, axis=0, return_index=True, return_inverse=True, return_counts=True)
    votes, known, times = votes[first].astype(np.float32), known[first], times.astype(np.float64)
    p = np.where(known >= 0, known, votes[:, :-1].any(1).astype(float))
    for _ in range(rounds):
        before = p
        toxic, clean = p * times, (1 - p) * times
        prior = (toxic.sum() + 1) / (n + 2)
        rate1 = (toxic @ votes + 0.5) / (toxic.sum() + 1)
        rate0 = (clean @ votes + 0.5) / (clean.sum() + 1)
        rest = votes - np.outer(p, rate1).astype(np.float32) - np.outer(1 - p, rate0).astype(np.float32)
        covariance = (rest * times[:, None].astype(np.float32)).T @ rest / n
        scale = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
        together = np.clip(covariance / np.outer(scale, scale), 0, 1)
        np.fill_diagonal(together, 0)
        together = np.where(together < 0.1, 0, together).astype(np.float32)
        fires = votes / (1 + votes @ together) * np.log(rate1 / rate0).astype(np.float32)
        silent = (1 - votes) * (np.log((1 - rate1) / (1 - rate0)) / (1 + together.sum(1))).astype(np.float32)
        logit = np.log(prior / (1 - prior)) + fires.sum(1) + silent[:, :-1].sum(1)
        p = np.where(known >= 0, 0.98 * known + 0.01, 1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        if np.abs(p - before).max() < 1e-4:
            break
    return p[of.ravel()]


def fit_linear(rows: np.ndarray, places: np.ndarray, n_features: int, target: np.ndarray, share: np.ndarray | None = None, rounds: int = 400, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model on 0/1 features, by accelerated gradient steps on the mean log loss.

    ``share`` weighs the rows.
    """
    n = len(target)
    weights, bias = np.zeros(n_features), 0.0
    if not n:
        return weights, -5.0
    share = np.ones(n) if share is None else share
    squares = np.bincount(places, minlength=n_features) / n
    step = 1 / (0.25 * (1 + squares.max(initial=0.0) * max(1.0, np.bincount(rows, minlength=n).max(initial=1))) + decay)
    velocity, drift = np.zeros(n_features), 0.0
    for _ in range(rounds):
        ahead, offset = weights + 0.95 * velocity, bias + 0.95 * drift
        z = np.bincount(rows, ahead[places], n) + offset
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * share
        slope = np.bincount(places, error[rows], n_features) / n
        # A diagonal scale keeps rare features moving; the intercept uses the plain step.
        velocity = 0.95 * velocity - step * (slope / np.maximum(squares, 5 / n) * 0.5 + decay * ahead)
        drift = 0.95 * drift - step * error.mean()
        weights, bias = weights + velocity, bias + drift
    return weights, float(bias)


class Classifier:
    def __init__(self, wanted: np.ndarray, weights: np.ndarray, bias: float):
        self.wanted, self.weights, self.bias = wanted, weights, bias

    def scores(self, column: pa.Array, lookup: Lookup) -> np.ndarray:
        row, place = lookup.rows(column)
        z = np.bincount(row, self.weights[place], len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: DataFrame, labels: DataFrame) -> Classifier:
    """A classifier from the texts ``rows`` (doc_id, text) and those labels (doc_id, toxic) that may be learnt from."""
    none = Classifier(np.zeros(0, np.uint64), np.zeros(0), -5.0)
    usable = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    count = usable.count()
    if not count:
        return none
    hashed = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_000))
    chosen = usable.where(hashed < int(1_000_000 * min(1.0, 0.9 * MAX_LABELLED / count))).limit(MAX_LABELLED)
    # At most MAX_LABELLED rows, so the list is broadcast.
    labelled = rows.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    total = max(1, rows.count())
    free = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, 0.9 * MAX_UNLABELLED / total)))
    counts = labelled.mapInArrow(_counted, "feature long, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    sums = labelled.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    bad, good = float(sums[0] or 0), float((sums[1] or 0) - (sums[0] or 0))
    if not bad or not good:
        return none
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    spread = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    ranked = counts.where(F.col("bad") + F.col("good") >= LEAST_TEXTS).withColumn("odds", odds).withColumn("z", odds / spread)
    strong = ranked.where("abs(z) > 2.5").orderBy(F.desc(F.abs("z")), "feature").limit(MAX_FEATURES).toPandas()
    if not len(strong):
        return none
    wanted = strong["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(wanted)
    wanted, strong = wanted[order], strong.iloc[order].reset_index(drop=True)
    sample = labelled.unionByName(free.select("text", F.lit(-1).cast("long").alias("toxic")))
    # Bounded by the two samples: one short list of places a document.
    seen = sample.mapInArrow(_present(wanted), "toxic long, places array<int>").toArrow().combine_chunks()
    known = seen["toxic"].to_numpy()
    lists = pa.concat_arrays(seen["places"].chunks) if seen.num_rows else pa.array([], pa.list_(pa.int32()))
    places = lists.flatten().to_numpy()
    of = np.repeat(np.arange(len(lists), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    width = len(wanted) * len(LEVELS)
    hits = [np.bincount(places[known[of] == k], minlength=width) for k in (0, 1)]
    precise = np.flatnonzero((hits[1] >= LEAST_TEXTS) & (hits[1] >= LEAST_PRECISION * (hits[0] + hits[1] + 1)))
    voters = precise[np.argsort(-hits[1][precise], kind="stable")][:MAX_VOTERS]
    column = np.full(width, -1)
    column[voters] = np.arange(len(voters))
    fired = column[places] >= 0
    votes = np.zeros((len(seen), len(voters) + 1), bool)
    votes[of[fired], column[places[fired]]] = True
    votes[:, -1] = ~votes[:, :-1].any(1)
    posterior = label_model(votes, known)
    share = np.where(known >= 0, 1.0, UNLABELLED_WEIGHT * np.abs(2 * posterior - 1))
    weights, bias = fit_linear(of, places, width, posterior, share)
    return Classifier(wanted, weights, bias)


def _scored(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.wanted)
        for batch in batches:
            scores = model.scores(batch.column("text"), lookup)
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch([*rest, pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], [*names, "score", "predicted"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    Labels are learnt from rows that are not held out (crc32(doc_id) mod 3 is 1); several labels of one document count
    as toxic if one does. NULL and empty texts score as a text without features. With nothing to learn from, all texts
    score low. Repeated rows score alike; no rows give no rows.
    """
    rows = only(docs, "doc_id", "text")
    model = train(rows, only(labels, "doc_id", "toxic").where(crc_remainder("doc_id", 3) != 1))
    keyed = rows.select("doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"), "text")
    return keyed.mapInArrow(_scored(model), "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns doc_id and text among any others) that are not predicted toxic."""
    model = train(only(docs, "doc_id", "text"), only(labels, "doc_id", "toxic").where(crc_remainder("doc_id", 3) != 1))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.wanted)
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column("text"), lookup) < THRESHOLD))

    return docs.mapInArrow(clean, docs.schema)
