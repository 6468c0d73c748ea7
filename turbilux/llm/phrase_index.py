"""Benchmark decontamination with a distributed positional index; DataFrame operations only.

Only the rarest two terms of each test window are looked up.  Their postings (term, document, position) are stored as a table;
shifted by the terms' places in the window they give the places where the window could start, and places that both terms
agree on are compared with the document's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turbilux.llm.storage import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# ASCII other than digits and a-z
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# rows of a test-side table that may be broadcast (under 100 bytes each); beyond it the join shuffles
BROADCAST_TERMS = 200_000


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` does that by itself, and faster, where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )


def words_of(text: Column) -> Column:
    """Runs of digits, letters a-z and characters beyond ASCII; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a test-side table if it is as small as it should be."""
    return F.broadcast(df) if df.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else df


def test_windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows of the items: ``terms``, the ``items`` that hold it, and a number ``win``.

    A window is ``size`` consecutive words; an item of fewer words, but not none, is one window.
    """
    words = items.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    cut = F.when(
        F.size("w") > size,
        F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.slice(F.col("w"), i, size)),
    ).otherwise(F.array("w"))
    return (
        words.select("item_id", F.explode(cut).alias("terms"))
        .groupBy("terms")
        .agg(F.collect_set("item_id").alias("items"))
        .withColumn("win", F.xxhash64("terms"))
    )


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of ``terms`` (column term) occurs in all documents; terms that never occur are left out."""
    found = docs.select(F.explode(words_of(F.col("text"))).alias("term"))
    return found.join(_small(terms), "term").groupBy("term").count()


def anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """The two rarest places of each window whose terms all occur: win, term, place, mark (1 or 2), all_marks."""
    placed = windows.select("win", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term"))
    rarest = Window.partitionBy("win").orderBy("count", "place")
    return (
        placed.join(counts, "term")
        .withColumn("rank", F.row_number().over(rarest))
        .withColumn("known", F.count(F.lit(1)).over(Window.partitionBy("win")))
        .where("known = size and rank <= 2")
        .select("win", "term", "place", F.col("rank").alias("mark"), F.when(F.col("size") > 1, 3).otherwise(1).alias("all_marks"))
    )


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, row_key, position of every occurrence of ``terms`` in ``docs`` (row_key, text), positions from 0."""
    found = docs.select("row_key", F.posexplode(words_of(F.col("text"))).alias("position", "term"))
    return found.join(_small(terms.select("term").distinct()), "term").select("term", "row_key", "position")


def possible_starts(index: DataFrame, anchor: DataFrame) -> DataFrame:
    """row_key, start, win where the offset-adjusted postings of both anchors meet."""
    return (
        index.join(_small(anchor), "term")
        .select("row_key", (F.col("position") - F.col("place")).alias("start"), "win", "mark", "all_marks")
        .where("start >= 0")
        .groupBy("row_key", "start", "win")
        .agg(F.bit_or("mark").alias("marks"), F.first("all_marks").alias("all_marks"))
        .where("marks = all_marks")
        .select("row_key", "start", "win")
    )


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, row_key.

    A document word inside any occurrence of a test window is hit.  ``docs`` needs doc_id and text, ``items`` item_id and text; other
    columns are ignored.  Null texts have no words; rows that repeat a doc_id are judged each by its own text; an item
    without item_id hits words but is not listed.  Without windows nothing is hit; an empty table gives an empty result.
    """
    docs = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("row_key")
    )
    windows = staged(test_windows(items, size))
    vocabulary = staged(windows.select(F.explode("terms").alias("term")).distinct())
    anchor = staged(anchors(windows, term_counts(docs, vocabulary)))
    index = staged(postings(docs, anchor))
    starts = possible_starts(index, anchor).join(_small(windows), "win")
    by_row = starts.groupBy("row_key").agg(F.collect_list(F.struct("start", "terms", "items")).alias("possible"))
    judged = (
        docs.join(by_row, "row_key", "left")
        .withColumn("w", words_of(F.col("text")))
        .withColumn(
            "found",
            F.filter(
                F.coalesce("possible", F.expr("array()")),
                lambda c: F.slice(F.col("w"), c.start + 1, F.size(c.terms)) == c.terms,
            ),
        )
        .withColumn(
            "hit",
            F.size(
                F.array_distinct(
                    F.flatten(F.transform("found", lambda c: F.sequence(c.start, c.start + F.size(c.terms) - 1)))
                )
            ),
        )
        .withColumn("listed", F.array_compact(F.array_distinct(F.flatten(F.transform("found", lambda c: c["items"])))))
    )
    return judged.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.col("hit").cast("long").alias("n_hit"),
        F.size("listed").cast("long").alias("n_items"),
        F.sha2(
            F.concat_ws(",", F.array_sort(F.transform("listed", lambda i: i.cast("string")))).cast("binary"), 256
        ).alias("items_sha256"),
        (F.col("hit") > 0).alias("contaminated"),
        "row_key",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns."""
    hit = contamination(docs, items, size).where("contaminated").select(F.col("row_key").alias("hit_key")).distinct()
    return docs.join(hit, F.xxhash64(docs["doc_id"], docs["text"]) == hit["hit_key"], "left_anti")


def proximity_matches(docs: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """doc_id, query_id and position of the rarest term wherever all terms of a query lie at most ``within`` words from it.

    ``queries`` has query_id and text.  Terms may come in any order.  Each posting of another term is looked up in the three
    stretches of ``within`` words around it, so the join stays one of equal keys.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    terms = queries.select(
        F.col("query_id").alias("win"), F.explode(F.array_distinct(words_of(F.col("text")))).alias("term")
    )
    terms = staged(terms)
    counts = term_counts(docs, terms.select("term").distinct())
    order = Window.partitionBy("win").orderBy(F.coalesce("count", F.lit(0)), "term")
    ranked = staged(
        terms.join(counts, "term", "left")
        .withColumn("rank", F.row_number().over(order))
        .withColumn("wanted", F.count(F.lit(1)).over(Window.partitionBy("win")))
        .select("win", "term", "rank", "wanted")
    )
    index = staged(postings(docs, ranked))
    hits = index.join(_small(ranked), "term").withColumn("stretch", F.floor(F.col("position") / within))
    pivot = hits.where("rank = 1").select("row_key", "win", "wanted", F.col("position").alias("at"), "stretch")
    other = hits.where("rank > 1").select(
        "row_key", "win", "term", "position", F.explode(F.array(*(F.col("stretch") + d for d in (-1, 0, 1)))).alias("stretch")
    )
    near = (
        pivot.join(other, ["row_key", "win", "stretch"], "left")
        .where(F.col("term").isNull() | (F.abs(F.col("position") - F.col("at")) <= within))
        .groupBy("row_key", "win", "at", "wanted")
        .agg(F.count_distinct("term").alias("found"))
        .where("found + 1 = wanted")
    )
    return near.join(docs.select("doc_id", "row_key"), "row_key").select(
        "doc_id", F.col("win").alias("query_id"), F.col("at").alias("position")
    )
