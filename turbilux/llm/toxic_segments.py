"""Toxicity by maximum-scoring segments.

Words, and the beginnings of words, get log-odds between toxic and other labelled documents under an informative Dirichlet
prior.  Less a drift that makes ordinary text lose, a linear scan finds every maximal scoring segment of a text.  Segment
scores of ordinary text follow an extreme-value law; its two parameters turn a score into the number of such segments
expected by chance, and what exceeds chance is added up and calibrated to a probability of the label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.llm.storage import staged, without_rows
from turbilux.llm.text_arrays import Words, blocks, byte_table, mix, text_of, utf8

# bounds of what is learnt: labelled documents looked at (in expectation), and features kept
SAMPLE_DOCS = 20_000
MODEL_FEATURES = 100_000
THRESHOLD = 0.3

PREFIXES = (8, 7, 6, 5, 4)  # bytes; a word is judged by itself, else by its longest known beginning
PRIOR = 0.1  # weight of the prior, as a share of all words counted
LEAST_Z = 2.5
LEAST_COUNT = 4
EULER = 0.5772156649015329

# ASCII that is no letter; everything beyond ASCII belongs to a word
_SEPARATORS = byte_table((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the letters À to Þ."""
    out = _LOWER[data]
    upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[1:][upper] += 0x20
    return out


def _words(block: pa.RecordBatch) -> Words:
    data, offsets = utf8(block.column("text"))
    return Words(_lowered(data), offsets, _SEPARATORS)


def _features(words: Words, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which of the chosen words have the feature, its hash), the most specific first."""
    yield np.arange(len(chosen)), words.hashes()[chosen]
    for n in PREFIXES:
        longer = np.flatnonzero(words.size[chosen] > n)
        yield longer, mix(words.hashes(n)[chosen[longer]] ^ np.uint64(n))


def feature_counts(labelled: DataFrame) -> DataFrame:
    """feature, toxic, other: in how many (document, word) pairs of each class a feature occurs."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block in blocks(batch, "text"):
                words = _words(block)
                owner = text_of(words.first)
                pair = mix(words.hashes() ^ mix(owner.astype(np.uint64) + np.uint64(1)))
                chosen = np.sort(np.unique(pair, return_index=True)[1])
                label = np.array(block.column("label").to_pylist(), np.int64)[owner[chosen]] if len(chosen) else chosen
                hashes, labels = [], []
                for which, feature in _features(words, chosen):
                    hashes.append(feature)
                    labels.append(label[which])
                unique, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
                toxic = np.bincount(inverse, np.concatenate(labels), minlength=len(unique)).astype(np.int64)
                total = np.bincount(inverse, minlength=len(unique))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unique.view(np.int64)), pa.array(toxic), pa.array(total - toxic)],
                    ["feature", "toxic", "other"],
                )

    counts = labelled.select("text", "label").mapInArrow(run, "feature long, toxic long, other long")
    return counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def log_odds(counts: DataFrame, toxic_pairs: float, other_pairs: float, keep: int) -> list:
    """The ``keep`` most significant (feature, log_odds): the prior of a feature is its share of both classes together."""
    total = toxic_pairs + other_pairs
    weight = PRIOR * total
    alpha = F.lit(PRIOR) * (F.col("toxic") + F.col("other"))
    t, o = F.col("toxic") + alpha, F.col("other") + alpha
    odds = F.log(t / (toxic_pairs + weight - t)) - F.log(o / (other_pairs + weight - o))
    z = odds / F.sqrt(1 / t + 1 / o)
    return (
        counts.where(F.col("toxic") + F.col("other") >= LEAST_COUNT)
        .select("feature", odds.alias("log_odds"), F.abs(z).alias("z"))
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "feature")
        .limit(keep)
        .collect()
    )


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence, in linear time (Ruzzo and Tompa).

    Each kept segment remembers the nearest one before it that begins lower, so a search jumps over all those that an
    earlier search has passed.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        first, last, low, high = i, i, float(total[i]), float(total[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                # segments that begin no lower can never be extended to the left by a later one that begins lower
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append((first, last, low, high, j))
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, high - low) for a, b, low, high, _ in stack]


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    odds: np.ndarray
    drift: float = 0.0
    decay: float = 1.0  # lambda of the extreme-value law
    log_k: float = 0.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)

    def word_odds(self, words: Words) -> np.ndarray:
        unique, chosen, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        out = np.full(len(unique), np.nan)
        if len(self.features):
            for which, feature in _features(words, chosen):
                at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
                known = (self.features[at] == feature) & np.isnan(out[which])
                out[which[known]] = self.odds[at[known]]
        return np.nan_to_num(out)[inverse]

    def segments(self, words: Words) -> Iterator[list[tuple[int, int, float]]]:
        """Of each text, its maximal segments by word number inside the text."""
        scores = self.word_odds(words) - self.drift
        for a, b in zip(words.first[:-1], words.first[1:]):
            yield maximal_segments(scores[a:b])

    def surplus(self, score: float, n: int) -> float:
        """-ln of the number of such segments expected in ``n`` words of ordinary text."""
        return self.decay * score - self.log_k - math.log(max(n, 1))

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> float:
        """Summed surplus of the significant segments, or the largest surplus if none is; -10 at least."""
        surplus = [self.surplus(s, n) for _, _, s in segments]
        positive = sum(s for s in surplus if s > 0)
        return positive or max([-10.0, *surplus])

    def probability(self, evidence: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(_inputs(evidence, n) @ np.array(self.weights)).clip(-30, 30)))


def _inputs(evidence: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(n)), np.sign(evidence) * np.log1p(np.abs(evidence)), np.log1p(n)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic regression with a slight ridge, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        gradient = x.T @ (p - y) + 0.1 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def _evidence_rows(docs: DataFrame, model: Model, carry: list[tuple[str, str]]) -> DataFrame:
    """The carried columns (name, type), n_words, evidence and the best segment's score of each text."""
    names = [n for n, _ in carry]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block in blocks(batch, "text"):
                words = _words(block)
                counts = np.diff(words.first)
                found = list(model.segments(words))
                evidence = [model.evidence(s, int(n)) for s, n in zip(found, counts)]
                best = [max([0.0, *(x for _, _, x in s)]) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(block.column(n) for n in names),
                        pa.array(counts.astype(np.int64)),
                        pa.array(evidence, pa.float64()),
                        pa.array(best, pa.float64()),
                    ],
                    [*names, "n_words", "evidence", "best"],
                )

    schema = ", ".join(f"{n} {k}" for n, k in carry) + ", n_words long, evidence double, best double"
    return docs.select(*names, "text").mapInArrow(run, schema)


def _odds_histogram(docs: DataFrame, model: Model) -> list:
    """(odds in hundredths, words) over all words of the texts."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block in blocks(batch, "text"):
                value, n = np.unique(np.round(model.word_odds(_words(block)) * 100).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n)], ["odds", "n"])

    return docs.select("text").mapInArrow(run, "odds long, n long").groupBy("odds").agg(F.sum("n").alias("n")).collect()


def _decay(odds: np.ndarray, share: np.ndarray) -> float:
    """The positive lambda with sum(share * exp(lambda * odds)) = 1."""
    if not (odds > 0).any():
        return 1.0
    low, high = 1e-4, 20.0
    for _ in range(80):
        middle = (low + high) / 2
        if float((share * np.exp((middle * odds).clip(None, 700))).sum()) > 1:
            high = middle
        else:
            low = middle
    return low


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, features: int = MODEL_FEATURES) -> Model:
    """Learn from documents (doc_id, text) that ``labels`` (doc_id, label 0 or 1) marks; null labels are left out.

    About ``sample_docs`` of them are used, chosen by a hash of doc_id: one half for the log-odds, the other for drift,
    extreme-value law and calibration.  Without any usable label the model gives every text the same score.
    """
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, sample_docs / max(labels.count(), 1))
    chosen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    marked = staged(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("text", "label", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0).alias("first_half"))
    )
    counts = staged(feature_counts(marked.where("first_half")))
    pairs = counts.agg(F.sum("toxic"), F.sum("other")).first()
    toxic, other = float(pairs[0] or 0), float(pairs[1] or 0)
    found = log_odds(counts, toxic, other, features) if toxic and other else []
    hashes = np.array([r["feature"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    model = Model(hashes[order], np.array([r["log_odds"] for r in found], np.float64)[order])
    rest = marked.where("not first_half")
    histogram = _odds_histogram(rest.where("label = 0"), model)
    if not histogram:
        return model
    odds = np.array([r["odds"] for r in histogram]) / 100
    shares = np.array([r["n"] for r in histogram], np.float64)
    shares /= shares.sum()
    model.drift = float((odds * shares).sum()) + 0.5
    model.decay = _decay(odds - model.drift, shares)
    rows = _evidence_rows(rest, model, [("label", "int")]).collect()
    calm = [model.decay * r["best"] - math.log(max(r["n_words"], 1)) for r in rows if r["label"] == 0 and r["n_words"]]
    model.log_k = float(np.mean(calm)) - EULER if calm else 0.0
    # surplus is linear in log_k, so the segments have to be added up again
    rows = _evidence_rows(rest, model, [("label", "int")]).collect()
    inputs = _inputs(np.array([r["evidence"] for r in rows]), np.array([r["n_words"] for r in rows], np.float64))
    model.weights = _logistic(inputs, np.array([r["label"] for r in rows], np.float64))
    return model


def toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, row_hash (of the text), score (probability of the label) and predicted (1 if score >= threshold) of every whole text.

    ``docs`` needs doc_id and text; other columns are ignored.  A null or empty text has no word and no segment, which gives
    it a low score like any other.  Rows that repeat a doc_id are scored each by its own text.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("row_hash"),
    )
    w0, w1, w2 = model.weights
    e = F.col("evidence")
    linear = w0 + w1 * F.signum(e) * F.log1p(F.abs(e)) + w2 * F.log1p(F.col("n_words"))
    score = 1 / (1 + F.exp(-linear))
    rows = _evidence_rows(docs, model, [("doc_id", "long"), ("row_hash", "long")])
    return rows.select("doc_id", "row_hash", score.alias("score"), (score >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows that score below ``threshold``, with all their columns; a row is known by its doc_id (null-safe) and text."""
    # written first: scoring in Python and a shuffle of the texts would otherwise share the executors' memory
    rejected = staged(toxicity(docs, model, threshold).where("predicted = 1").select("doc_id", "row_hash"))
    return without_rows(docs, rejected)


def toxic_passages(docs: DataFrame, model: Model, most_expected: float = 0.05) -> DataFrame:
    """doc_id, first_word, last_word, score, expected of every segment of which chance would give at most ``most_expected``."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block in blocks(batch, "text"):
                words = _words(block)
                rows = []
                ids, counts = block.column("doc_id").to_pylist(), np.diff(words.first).tolist()
                for doc_id, n, segments in zip(ids, counts, model.segments(words)):
                    for a, b, s in segments:
                        expected = math.exp(min(-model.surplus(s, n), 700))
                        if expected <= most_expected:
                            rows.append((doc_id, a, b, s, expected))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                columns = zip(*rows) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "first_word", "last_word", "score", "expected"],
                )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, first_word long, last_word long, score double, expected double")
