"""Repeated passages: a count-min prefilter, then exact grouping of the windows it lets through.

Documents are dealt into bundles by a hash, windows into slices by theirs.  A bundle's count-min sketch is kept sparse (the
cells it touched), and each slice of all sketches is merged by one task, so no task and no driver ever holds a whole sketch and
nothing is broadcast.  The task answers every bundle with one bit per cell: seen at least twice.  Counts are never too low,
so a window that fails is unique; the others go once more to their slice, one row per window and bundle with the smallest doc_id,
and are grouped exactly by a 128-bit hash of their words.  The answer is again a bit: some other bundle has a smaller doc_id.
Work and traffic are linear in the text; a window in a third of all documents sends one row per bundle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.llm.text_arrays import Words, blocks, mix, spans_sum, text_of, utf8

# text a bundle holds and words a slice stands for: both fit a task's memory many times
BUNDLE_BYTES = 8 << 20
SLICE_WORDS = 2 << 20
CELL_BITS = 23  # cells of a slice in each of the sketch's two rows

_FACTORS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_SALT = np.uint64(0x2545F4914F6CDD1D)
_LAST = np.int64(2**63 - 1)  # stands for a null doc_id: later than any other


class _Bundle:
    """All windows of a bundle's documents."""

    def __init__(self, table: pa.Table, size: int, slices: int):
        self.size, self.slices = size, slices
        self.parts = []
        hashes, docs = [], []
        for batch in table.combine_chunks().to_batches():
            for block in blocks(batch, "text"):
                words = Words(*utf8(block.column("text")))
                ids = block.column("doc_id").fill_null(int(_LAST)).to_numpy(zero_copy_only=False).astype(np.int64)
                at, pair = self._windows(words)
                owner = text_of(words.first)[at]
                self.parts.append((block, words, at, owner))
                hashes.append(pair)
                docs.append(ids[owner])
        self.doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        self.pair = np.concatenate(hashes, axis=1) if hashes else np.zeros((2, 0), np.uint64)
        self.slice = ((self.pair[0] >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)

    def _windows(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        n = len(words) - self.size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros((2, 0), np.uint64)
        one = words.hashes()
        out = []
        for factor, values in zip(_FACTORS, (one, mix(one ^ _SALT))):
            total = np.zeros(n, np.uint64)
            for k in range(self.size):
                total *= factor
                total += values[k : k + n]
            out.append(mix(total))
        owner = text_of(words.first)
        at = np.flatnonzero(owner[:n] == owner[self.size - 1 :])
        return at, np.stack([out[0][at], out[1][at]])

    def cells(self, row: int) -> np.ndarray:
        """Cell of each window in one row of the sketch, under its slice."""
        mask = np.uint64((1 << CELL_BITS) - 1)
        value = self.pair[0] if row == 0 else self.pair[1]
        return (self.slice << np.uint64(CELL_BITS)) | (value & mask)

    def estimated_repeated(self, answers: dict[int, tuple[bytes, bytes]]) -> np.ndarray:
        keep = np.ones(len(self.doc), bool)
        for row in (0, 1):
            unique, inverse = np.unique(self.cells(row), return_inverse=True)
            seen = np.zeros(len(unique), bool)
            for s, a, b in _by_slice(unique >> np.uint64(CELL_BITS)):
                seen[a:b] = _bits(answers[s][row], b - a)
            keep &= seen[inverse]
        return keep

    def requests(self, chosen: np.ndarray):
        """The chosen windows' distinct hashes with the smallest doc_id of each, and which of them each window is.

        They are ordered by slice, doc_id and hash, so that the shuffle packs the doc_ids.
        """
        a, b, doc = self.pair[0][chosen], self.pair[1][chosen], self.doc[chosen]
        order = np.lexsort((doc, b, a))
        a, b, doc = a[order], b[order], doc[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        head = np.flatnonzero(new)
        which = np.empty(len(a), np.int64)
        which[order] = np.cumsum(new) - 1
        a, b, doc = a[head], b[head], doc[head]
        part = self.slice[chosen][order][head]
        again = np.lexsort((b, a, doc, part))
        place = np.empty(len(again), np.int64)
        place[again] = np.arange(len(again))
        return part[again], np.stack([a[again], b[again]], axis=1), doc[again], place[which]


def _by_slice(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(slice, start, end) of the runs of a sorted array."""
    if len(part):
        heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        yield from zip(part[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(part)])


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _pack_cells(cells: np.ndarray) -> bytes:
    """Sorted cells as differences: two bytes each where that is enough."""
    gaps = np.diff(cells, prepend=np.uint64(0))
    small = not len(gaps) or int(gaps.max()) < 1 << 16
    return (b"\2" if small else b"\4") + gaps.astype("<u2" if small else "<u4").tobytes()


def _unpack_cells(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, "<u2" if packed[0] == 2 else "<u4", offset=1), dtype=np.int64)


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _binary(*names: str) -> pa.Schema:
    return pa.schema([("bundle", pa.int64()), ("slice", pa.int64()), *((n, pa.binary()) for n in names)])


_SKETCH = _binary("cells_0", "twice_0", "cells_1", "twice_1")
_ASKED = _binary("hashes", "docs")
_ANSWER = _binary("bits_0", "bits_1")


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)


def _merge_sketches(table):
    """One slice of all bundles' sketches: counts up to two per cell, answered to each bundle."""
    rows = table.select(_SKETCH.names).to_pylist()
    answers = [[] for _ in rows]
    for row in ("0", "1"):
        counts = np.zeros(1 << CELL_BITS, np.uint8)
        for r in rows:
            cells = _unpack_cells(r[f"cells_{row}"])
            counts[cells] = np.minimum(counts[cells] + 1 + _bits(r[f"twice_{row}"], len(cells)), 2)
        for r, answer in zip(rows, answers):
            answer.append(np.packbits(counts[_unpack_cells(r[f"cells_{row}"])] >= 2).tobytes())
    return _table(_ANSWER, [(r["bundle"], r["slice"], *a) for r, a in zip(rows, answers)])


def _merge_exact(table):
    """One slice of the windows asked for: does another bundle hold the same words under a smaller doc_id?"""
    rows = table.select(_ASKED.names).to_pylist()
    pairs = [np.frombuffer(r["hashes"], "<u8").reshape(-1, 2) for r in rows]
    docs = [np.frombuffer(r["docs"], "<i8") for r in rows]
    pair, doc = np.concatenate(pairs), np.concatenate(docs)
    order = np.lexsort((doc, pair[:, 1], pair[:, 0]))
    ordered = pair[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = np.empty(len(order), bool)
    earlier[order] = least < doc[order]
    out, at = [], 0
    for r, d in zip(rows, docs):
        out.append((r["bundle"], r["slice"], np.packbits(earlier[at : at + len(d)]).tobytes(), b""))
        at += len(d)
    return _table(_ANSWER, out)


def _cleaned(words: Words, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words not covered, each followed by a space, and where each text begins in them."""
    kept = ~covered
    size = words.size[kept].astype(np.int64) + 1
    total = int(size.sum())
    at = np.arange(total) + np.repeat(words.start[kept] - (np.cumsum(size) - size), size)
    at = np.minimum(at, max(len(words.data) - 1, 0))
    out = words.data[at]
    out[np.cumsum(size) - 1] = 0x20
    lengths = spans_sum(np.where(kept, words.size.astype(np.int64) + 1, 0), words.first)
    return out, np.concatenate([[0], np.cumsum(lengths)])


def remove_repeated(
    docs: DataFrame,
    window: int = 13,
    with_text: bool = False,
    bundle_bytes: int = BUNDLE_BYTES,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, ``with_text``, kept_text.

    Words are runs of anything but space and tab to carriage return.  A word goes if a window of ``window`` words that covers it
    also starts in a document with a smaller doc_id; windows are judged on the input.  Kept words are joined by one space.

    ``docs`` needs doc_id and text; other columns are ignored.  A null text has no words.  A null doc_id counts as later than
    any other, and rows of the same doc_id (or of none) do not judge each other.  An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_bundles = max(1, -(-n_bytes // bundle_bytes))
    slices = max(1, -(-n_bytes // (6 * slice_words)))
    placed = docs.withColumn("bundle", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_bundles)))

    def answers_of(table: pa.Table, step: int) -> dict:
        return {
            r["slice"]: (r["bits_0"], r["bits_1"]) for r in table.to_pylist() if r["step"] == step
        }

    def sketch(key, table):
        bundle = _Bundle(table, window, slices)
        found: dict[int, list] = {}
        for row in (0, 1):
            cells, count = np.unique(bundle.cells(row), return_counts=True)
            inside = cells & np.uint64((1 << CELL_BITS) - 1)
            for s, a, b in _by_slice(cells >> np.uint64(CELL_BITS)):
                found.setdefault(s, []).extend([_pack_cells(inside[a:b]), np.packbits(count[a:b] > 1).tobytes()])
        return _table(_SKETCH, [(key[0].as_py(), s, *packed) for s, packed in found.items()])

    def ask(key, table, answers):
        bundle = _Bundle(table, window, slices)
        chosen = np.flatnonzero(bundle.estimated_repeated(answers_of(answers, 1)))
        part, pair, doc, _ = bundle.requests(chosen)
        rows = [
            (key[0].as_py(), s, pair[a:b].astype("<u8").tobytes(), doc[a:b].astype("<i8").tobytes())
            for s, a, b in _by_slice(part)
        ]
        return _table(_ASKED, rows)

    names = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    final = pa.schema(names + [("kept_text", pa.string())] * with_text)

    def clean(key, table, answers):
        bundle = _Bundle(table, window, slices)
        chosen = np.flatnonzero(bundle.estimated_repeated(answers_of(answers, 1)))
        part, _, doc, which = bundle.requests(chosen)
        elsewhere = np.zeros(len(doc), bool)
        exact = answers_of(answers, 2)
        for s, a, b in _by_slice(part):
            elsewhere[a:b] = _bits(exact[s][0], b - a)
        repeated = np.zeros(len(bundle.doc), bool)
        repeated[chosen] = elsewhere[which] | (bundle.doc[chosen] > doc[which])
        rows, done = [], 0
        for block, words, at, _ in bundle.parts:
            hit = at[repeated[done : done + len(at)]]
            done += len(at)
            edges = np.zeros(len(words) + 1, np.int32)
            np.add.at(edges, hit, 1)
            np.add.at(edges, hit + window, -1)
            covered = np.cumsum(edges)[:-1] > 0
            text, start = _cleaned(words, covered)
            whole = text.tobytes()
            counts, removed = np.diff(words.first), spans_sum(covered, words.first)
            for i, doc_id in enumerate(block.column("doc_id").to_pylist()):
                kept = whole[start[i] : max(start[i], start[i + 1] - 1)]
                row = (doc_id, int(counts[i]), int(removed[i]), hashlib.sha256(kept).hexdigest())
                rows.append(row + (kept.decode("utf-8", "replace"),) * with_text)
        return _table(final, rows)

    by_bundle = placed.groupBy("bundle")
    seen = by_bundle.applyInArrow(sketch, _ddl(_SKETCH)).groupBy("slice").applyInArrow(_merge_sketches, _ddl(_ANSWER))
    seen = seen.withColumn("step", F.lit(1))
    asked = by_bundle.cogroup(seen.groupBy("bundle")).applyInArrow(ask, _ddl(_ASKED))
    exact = asked.groupBy("slice").applyInArrow(_merge_exact, _ddl(_ANSWER)).withColumn("step", F.lit(2))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return by_bundle.cogroup(seen.unionByName(exact).groupBy("bundle")).applyInArrow(clean, schema)
