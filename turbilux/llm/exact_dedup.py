"""Exact duplicates by composable polynomial fingerprints.

A text is read in chunks.  Each chunk has a polynomial hash modulo two primes, and hashes of neighbouring
chunks combine by shifting the left one by the length of the right one, so any cut of a text gives the same
fingerprint.  Texts with equal fingerprints are then compared chunk by chunk; where a fingerprint turns out to
stand for different texts, they are told apart by their SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.llm.storage import staged, without_rows
from turbilux.llm.text_arrays import utf8

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 69069069)
CHUNK_BYTES = 1 << 16
# groups of copies whose fingerprints may be broadcast (about 40 bytes each); beyond it the join shuffles
BROADCAST_GROUPS = 200_000

# a group with more than this share of all rows is hot: at most 1 / HOT_SHARE groups can be
HOT_SHARE = 0.001

PRINT_KEY = ["print_1", "print_2", "n_bytes"]


class Polynomial:
    """Hashes of byte strings as (values, shifts): one of each for every prime."""

    def __init__(self, primes: tuple[int, ...] = PRIMES, bases: tuple[int, ...] = BASES):
        self.primes = primes
        rows = []
        for p, b in zip(primes, bases):
            row = [1]
            for _ in range(CHUNK_BYTES):
                row.append(row[-1] * b % p)
            rows.append(row[::-1])
        self._powers = np.array(rows, np.int64)

    @property
    def empty(self):
        return (0,) * len(self.primes), (1,) * len(self.primes)

    def chunk(self, data: np.ndarray):
        """Hash of at most CHUNK_BYTES bytes."""
        n = len(data)
        # bytes count from 1, so that leading zero bytes matter
        sums = self._powers[:, CHUNK_BYTES + 1 - n :] @ (data.astype(np.int64) + 1) if n else np.zeros(len(self.primes))
        shifts = self._powers[:, CHUNK_BYTES - n]
        return tuple(int(s) % p for s, p in zip(sums, self.primes)), tuple(int(s) % p for s, p in zip(shifts, self.primes))

    def combine(self, left, right):
        """Hash of the concatenation."""
        return (
            tuple((a * s + b) % p for a, b, s, p in zip(left[0], right[0], right[1], self.primes)),
            tuple(s * t % p for s, t, p in zip(left[1], right[1], self.primes)),
        )


def _chunks(data: memoryview) -> Iterator[bytes]:
    """Lower-cased (A-Z only) pieces of a text's bytes."""
    for at in range(0, len(data), CHUNK_BYTES):
        yield bytes(data[at : at + CHUNK_BYTES]).lower()


def _each_text(batches: Iterator[pa.RecordBatch], poly: Polynomial):
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        view = memoryview(data)
        for i in range(len(offsets) - 1):
            value, digest, pieces = poly.empty, hashlib.sha256(), []
            whole = view[offsets[i] : offsets[i + 1]]
            for piece in _chunks(whole):
                digest.update(piece)
                value = poly.combine(value, poly.chunk(np.frombuffer(piece, np.uint8)))
            yield batch, i, whole, value[0], digest.hexdigest()


def fingerprints(docs: DataFrame, poly: Polynomial) -> DataFrame:
    """Fingerprint and text_sha256 of each row's normalised text, with its doc_id and row_hash."""

    def run(batches):
        names = ["doc_id", "row_hash", *PRINT_KEY, "text_sha256"]
        for batch in batches:
            rows = [(p[0], p[1], len(whole), sha) for _, _, whole, p, sha in _each_text([batch], poly)]
            columns = zip(*rows) if rows else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_hash"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
            )

    return docs.mapInArrow(run, "doc_id long, row_hash long, print_1 long, print_2 long, n_bytes long, text_sha256 string")


def fingerprinted_chunks(docs: DataFrame, poly: Polynomial) -> DataFrame:
    """PRINT_KEY, chunk_no and chunk: the normalised text of each row in pieces, under its fingerprint."""

    def run(batches):
        kinds = [pa.int64()] * 4 + [pa.binary()]
        names = [*PRINT_KEY, "chunk_no", "chunk"]
        rows, held = [], 0
        for _, _, whole, value, _ in _each_text(batches, poly):
            for k, piece in enumerate(_chunks(whole)):
                rows.append((value[0], value[1], len(whole), k, piece))
                held += len(piece)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.mapInArrow(run, "print_1 long, print_2 long, n_bytes long, chunk_no long, chunk binary")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("row_hash"),
    )


def exact_groups(docs: DataFrame, poly: Polynomial | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row_hash (of the text as it stands).

    ``docs`` needs doc_id and text; other columns are ignored.  Texts are equal when identical after lower-casing A-Z
    only; a null text counts as empty.  The largest doc_id of a group stays.  Rows that repeat a doc_id with the same text
    count in group_size and share one decision.  A null doc_id is smaller than any other; a group of such rows only
    has keep_id null and keeps them.  An empty table gives an empty result.
    """
    poly = poly or Polynomial()
    docs = _rows(docs)
    prints = staged(fingerprints(docs, poly))
    repeated = prints.groupBy(*PRINT_KEY).count().where("count > 1").select(*PRINT_KEY)
    if repeated.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        repeated = F.broadcast(repeated)
    # copies of a chunk merge before the shuffle, however many rows a group has
    contents = (
        fingerprinted_chunks(docs.select("text"), poly)
        .join(repeated, PRINT_KEY, "left_semi")
        .groupBy(*PRINT_KEY, "chunk_no", "chunk")
        .agg(F.lit(1).alias("one"))
    )
    ambiguous = contents.groupBy(*PRINT_KEY, "chunk_no").count().where("count > 1").select(*PRINT_KEY).distinct()
    keyed = staged(
        prints.join(ambiguous.withColumn("ambiguous", F.lit(True)), PRINT_KEY, "left").select(
            *prints.columns, F.when(F.col("ambiguous"), F.col("text_sha256")).otherwise("").alias("told_apart")
        )
    )
    key = [*PRINT_KEY, "told_apart"]
    groups = keyed.groupBy(*key).agg(F.struct(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).alias("group"))
    return _with_groups(keyed, groups, key).select(
        "doc_id",
        F.col("group.keep_id").alias("keep_id"),
        F.col("group.group_size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("group.keep_id")).alias("kept"),
        "text_sha256",
        "row_hash",
    )


def _with_groups(keyed: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    """Each row with its group.  Rows of hot groups, of which there are few, take theirs from a broadcast and are not shuffled."""
    least = F.lit(max(int(keyed.count() * HOT_SHARE), 1))
    hot = F.broadcast(groups.where(F.col("group.group_size") > least))
    others = groups.where(F.col("group.group_size") <= least)
    return keyed.join(hot, key).unionByName(keyed.join(hot, key, "left_anti").join(others, key))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns; a row is known by its doc_id (null-safe) and text."""
    return without_rows(docs, exact_groups(docs).where("not kept"))
