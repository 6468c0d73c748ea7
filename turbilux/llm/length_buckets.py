"""Packing into length buckets that waste the least padding.

Texts are cut into pieces of at most ``max_length`` units, so their lengths have a bounded histogram.  Dynamic programming over
that histogram finds the bucket bounds with the least padding in total; inside a bucket, batches are filled up to a
budget of padded units.  Units are tokens in ``pack_tokens`` and whatever ``length`` says, words by default, in ``pack``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turbilux.llm.storage import staged
from turbilux.llm.token_codes import token_counts

PIECES_PER_SHARD = 100_000


def word_count(text: Column) -> Column:
    """Number of runs of anything but space and tab to carriage return."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x09-\x0D\x20]+"), ""))


def best_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding, for ascending distinct lengths."""
    if not lengths:
        return []
    upper = np.array(lengths, np.float64)
    before = np.concatenate([[0], np.cumsum(np.array(counts, np.float64))])
    n = len(upper)
    # best[j]: least padded size of the first j lengths
    best = np.concatenate([[0], np.full(n, np.inf)])
    choice = []
    for _ in range(min(buckets, n)):
        last = np.zeros(n + 1, np.int64)
        now = np.full(n + 1, np.inf)
        now[0] = 0
        for j in range(1, n + 1):
            cost = best[:j] + upper[j - 1] * (before[j] - before[:j])
            last[j] = int(np.argmin(cost))
            now[j] = cost[last[j]]
        choice.append(last)
        best = now
    bounds, j = [], n
    for last in reversed(choice):
        if j == 0:
            break
        bounds.append(int(upper[j - 1]))
        j = int(last[j])
    return bounds[::-1]


def pack(
    docs: DataFrame,
    buckets: int = 16,
    budget: int = 65_536,
    max_length: int = 2_048,
    length: Column | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bucket (its upper bound), batch, slot, padding.

    ``docs`` needs doc_id and text (or the columns of ``length``, by default the number of words).  A longer text is cut every ``max_length``
    units; nothing is dropped.  A text of length 0 or null is one piece of length 0.  (bucket, batch) names a batch of at most
    ``budget`` padded units, or of one piece where the bound is larger; all batches of a bucket but the last are full.
    Pieces lie in a bucket in the order of their hash shard, doc_id and start.  The histogram, at most
    max_length + 1 rows, is all that reaches the driver.
    """
    size = F.coalesce((word_count(F.col("text")) if length is None else length).cast("long"), F.lit(0))
    sized = docs.select("doc_id", size.alias("total"))
    cut = F.greatest(F.ceil(F.col("total") / max_length), F.lit(1)) - 1
    pieces = staged(
        sized.select("doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), cut)).alias("piece")).select(
            "doc_id",
            "piece",
            (F.col("piece") * max_length).alias("start"),
            F.least(F.col("total") - F.col("piece") * max_length, F.lit(max_length)).alias("length"),
        )
    )
    histogram = sorted((r["length"], r["count"]) for r in pieces.groupBy("length").count().collect())
    lengths, counts = [h[0] for h in histogram], [h[1] for h in histogram]
    bounds = best_bounds(lengths, counts, buckets)
    upper = F.element_at(F.filter(F.array(*(F.lit(b).cast("long") for b in bounds)), lambda b: b >= F.col("length")), 1)
    shards = max(1, sum(counts) // PIECES_PER_SHARD)
    dealt = pieces.withColumn("bucket", upper if bounds else F.lit(None).cast("long")).withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards))
    )
    # pieces of a bucket are numbered inside small shards, and the shards' counts give where each begins
    earlier = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.groupBy("bucket", "shard").count()
    begins = begins.select("bucket", "shard", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("bucket", "shard").orderBy("doc_id", "start", "length")
    room = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket", F.lit(1))), F.lit(1))
    number = F.col("begin") + F.col("place") - 1
    return (
        dealt.withColumn("place", F.row_number().over(inside))
        .join(begins, ["bucket", "shard"])
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "bucket",
            F.floor(number / room).alias("batch"),
            (number % room).alias("slot"),
            (F.col("bucket") - F.col("length")).alias("padding"),
        )
    )


def pack_tokens(docs: DataFrame, tokenizer_path: str, **parameters) -> DataFrame:
    """``pack`` with lengths, bounds and budget in tokens of whole texts, under the tokenizer at ``tokenizer_path`` on every executor."""
    return pack(token_counts(docs, tokenizer_path), length=F.col("n_tokens"), **parameters)
