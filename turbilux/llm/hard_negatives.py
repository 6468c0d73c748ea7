"""Hard-negative mining: Strassen products of anchor and candidate tiles, and heaps of the best that merge.

Every anchor meets every candidate, a block of anchors at a time: the block is broadcast (its size is a parameter), the
candidates are scanned in tiles.  A tile's scores are one integer matrix product by Strassen's recursion, padded with zeros;
its sums are exact because int64 arithmetic is a ring.  Each task keeps the best few of each heap over all its tiles; the
tasks' heaps are merged by one more choice of the best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turbilux.llm.sequence import numbered
from turbilux.llm.storage import shared_folder, staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# a negative's score lies between these hundredths of its positive's
LEAST, MOST = 30, 90
ANCHOR_EVERY = 100
# anchors broadcast at once, and the sides of a tile
ANCHOR_BLOCK, ANCHOR_TILE, TILE = 8192, 512, 4096
# sides from which a product is split further
SPLIT = 32
_LIMIT = 2**63


def strassen(a: np.ndarray, b: np.ndarray, split: int = SPLIT) -> np.ndarray:
    """Exact product of int64 matrices whose true entries fit int64: seven half-size products a level.

    Sums inside may wrap around; wrapping is arithmetic modulo 2^64, so the result is right all the same.
    """
    n, m, k = a.shape[0], a.shape[1], b.shape[1]
    if min(n, m, k) <= split:
        return a @ b
    a, b = _even(a), _even(b)
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, split)
    p2 = strassen(a21 + a22, b11, split)
    p3 = strassen(a11, b12 - b22, split)
    p4 = strassen(a22, b21 - b11, split)
    p5 = strassen(a11 + a12, b22, split)
    p6 = strassen(a21 - a11, b11 + b12, split)
    p7 = strassen(a12 - a22, b21 + b22, split)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:n, :k]


def _even(a: np.ndarray) -> np.ndarray:
    """A row and a column of zeros where the number is odd."""
    return np.pad(a, ((0, a.shape[0] & 1), (0, a.shape[1] & 1))) if a.shape[0] & 1 or a.shape[1] & 1 else a


class Heaps:
    """The ``size`` best (score, then least id) of each slot; heaps of two sets of candidates merge by adding one to the other."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        # the score a newcomer must reach
        self.least = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        # ~score turns the order around without overflow
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot))
        heads = np.concatenate([[True], slot[1:] != slot[:-1]])
        rank = place - np.maximum.accumulate(np.where(heads, place, 0))
        kept = rank < self.size
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]
        last = rank == self.size - 1
        self.least[slot[last]] = score[last]


def _integers(column: str):
    """floor(256 x) of each component, as double first."""
    return F.transform(column, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector (long components) of the rows that take part; one row per vec_id."""
    given = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    vectors = whole.select("vec_id", "label", _integers("embedding").alias("vector"))
    return vectors.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*")


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of int64, shorter vectors padded with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(vectors), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _tiles(batches: Iterator[pa.RecordBatch], dim: int):
    """(ids, labels, matrix) of up to TILE candidates in the order of their ids."""
    held, rows = [], 0

    def tile():
        table = pa.Table.from_batches(held).combine_chunks()
        ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        matrix = _matrix(table.column("vector").chunk(0), dim)
        for k in range(0, len(ids), TILE):
            yield ids[k : k + TILE], labels[k : k + TILE], matrix[k : k + TILE]

    for batch in batches:
        if len(batch):
            held.append(batch)
            rows += len(batch)
        if rows >= TILE:
            yield from tile()
            held, rows = [], 0
    if held:
        yield from tile()


_SCORED = "slot long, score long, id long"


def _heap_rows(heaps: Heaps) -> Iterator[pa.RecordBatch]:
    if len(heaps.slot):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (heaps.slot, heaps.score, heaps.id)], ["slot", "score", "id"])


def _best(scored: DataFrame, size: int) -> DataFrame:
    """Heaps of all tasks merged: the best of each slot, with its rank from 1."""
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), "id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _positives(candidates: DataFrame, block, dim: int, size: int) -> DataFrame:
    """slot (number of the anchor), score, id, rank of each anchor's best of the same label."""

    def run(batches: Iterator[pa.RecordBatch]):
        ids, labels, matrix = block.value
        heaps = Heaps(len(ids), size)
        for their_ids, their_labels, theirs in _tiles(batches, dim):
            for label in np.intersect1d(labels, their_labels):
                ours, right = np.flatnonzero(labels == label), np.flatnonzero(their_labels == label)
                for k in range(0, len(ours), ANCHOR_TILE):
                    left = ours[k : k + ANCHOR_TILE]
                    scores = strassen(matrix[left], theirs[right].T)
                    i, j = np.nonzero((scores >= heaps.least[left][:, None]) & (ids[left][:, None] != their_ids[right]))
                    heaps.add(left[i], scores[i, j], their_ids[right][j])
        yield from _heap_rows(heaps)

    return _best(candidates.mapInArrow(run, _SCORED), size)


def _negatives(candidates: DataFrame, block, dim: int, positives: int, size: int, least: int, most: int) -> DataFrame:
    """slot (anchor * positives + rank of the positive), score, id, rank of the best other labels in each positive's window."""

    def run(batches: Iterator[pa.RecordBatch]):
        ids, labels, matrix, low, high = block.value
        heaps = Heaps(len(ids) * positives, size)
        for their_ids, their_labels, theirs in _tiles(batches, dim):
            for k in range(0, len(ids), ANCHOR_TILE):
                left = np.arange(k, min(k + ANCHOR_TILE, len(ids)))
                scores = strassen(matrix[left], theirs.T)
                other = labels[left][:, None] != their_labels
                for p in range(positives):
                    slot = left * positives + p
                    floor = np.maximum(heaps.least[slot], low[left, p])
                    i, j = np.nonzero((scores >= floor[:, None]) & (scores <= high[left, p][:, None]) & other)
                    heaps.add(slot[i], scores[i, j], their_ids[j])
        yield from _heap_rows(heaps)

    return _best(candidates.mapInArrow(run, _SCORED), size)


def mine(
    rows: DataFrame,
    anchor_every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = (LEAST, MOST),
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` needs vec_id, label and embedding; other columns are ignored.  Anchors are the rows whose vec_id is divisible by
    ``anchor_every``.  Scores are integer inner products of floor(256 x).  An anchor's positives are its first ``positives``
    other rows of its label; of the rows of other labels whose score is within ``window`` (percent of the positive's score,
    both ends included) the first ``negatives`` are returned for each positive.  Higher scores come first, then smaller ids.

    Rows with a null vec_id, label, vector or component, or a component that is not finite, take no part.  Rows of one
    vec_id are one row, the least by label and vector.  Vectors of unlike length are compared as if padded with zeros; an
    empty one scores 0.  A positive whose score is not above 0 has an empty window, unless both are 0.  Components so large
    that a score might not fit a long fail the job.  An empty table, or one without anchors, gives no rows.
    """
    spark = rows.sparkSession
    candidates = staged(usable(rows))
    size = candidates.agg(
        F.max(F.size("vector")).alias("dim"), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x)))).alias("most")
    ).first()
    dim, peak = size.dim or 0, size.most or 0
    if 100 * max(dim, 1) * peak * peak >= _LIMIT:
        raise ValueError("components too large for exact 64-bit scores")
    anchors = numbered(candidates.where(F.col("vec_id") % anchor_every == 0), ["vec_id"])
    count = anchors.count()
    folder = shared_folder(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for start in range(0, count, anchor_block):
        some = anchors.where(F.col("position").between(start, start + anchor_block - 1)).toArrow()
        some = some.sort_by("vec_id").combine_chunks()
        ids, labels = (some.column(c).to_numpy() for c in ("vec_id", "label"))
        matrix = _matrix(some.column("vector").chunk(0), dim)
        block = spark.sparkContext.broadcast((ids, labels, matrix))
        # at most ``positives`` rows for each anchor of the block
        best = _positives(candidates, block, dim, positives).toPandas()
        low = np.ones((len(ids), positives), np.int64)
        high, score, chosen = np.zeros_like(low), np.zeros_like(low), np.zeros_like(low)
        at = best["slot"].to_numpy(), best["rank"].to_numpy() - 1
        score[at], chosen[at] = best["score"].to_numpy(), best["id"].to_numpy()
        known = np.zeros(low.shape, bool)
        known[at] = True
        # the least and the largest score with least * p <= 100 * n <= most * p; low > high is an empty window
        low[known] = -(-window[0] * score[known] // 100)
        high[known] = window[1] * score[known] // 100
        scaled = spark.sparkContext.broadcast((ids, labels, matrix, low, high))
        found = _negatives(candidates, scaled, dim, positives, negatives, *window)
        slots = np.flatnonzero(known.ravel())
        names = pa.table(
            {
                "slot": slots, "anchor_id": ids[slots // positives], "positive_id": chosen.ravel()[slots],
                "positive_score": score.ravel()[slots],
            }
        )
        named = found.join(spark.createDataFrame(names), "slot").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
        named.write.mode("append").parquet(folder)
        block.unpersist()
        scaled.unpersist()
    return spark.read.schema(schema).parquet(folder) if count else spark.createDataFrame([], schema)


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Labels of the rows whose vec_id is divisible by ``every`` moved on by one: a planted share of wrong labels."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.withColumn("label", moved)
