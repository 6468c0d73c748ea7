"""Token ids as directly addressable codes.

An id is cut into bytes, lowest first.  Level 0 holds the lowest byte of every id; a bitmap says which ids go on, and level 1
holds the next byte of those only, and so on.  The place of an id's next byte is the number of set bits before it,
which a rank directory gives per 64 bytes of bitmap.  Any token is found with one look at each level; nothing is unpacked.

A segment is one self-contained binary value, whole documents only:

    magic "DAC1", uint64 tokens, uint64 documents, uint64 levels
    int64 doc_id per document, uint8 1 where it is not null, uint64 end of each document in tokens
    per level: uint64 n, n bytes, (n + 7) // 8 bytes of bitmap (lowest bit first), uint32 rank per 64 bytes of bitmap

all little-endian.  Segments are stored in a Parquet table (part, seq, n_docs, n_tokens, segment), so they live in any file
system Spark writes to and a lost task is simply repeated.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turbilux.llm.text_arrays import blocks, byte_table, span_hashes, spans_sum, utf8

MAGIC = b"DAC1"
RANK_BYTES = 64
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


# --- codes ---------------------------------------------------------------------------


def encode_segment(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> bytes:
    """Pack the ids of whole documents; ``ends`` are the documents' ends in tokens."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(_ONES[bits], dtype=np.uint64)])[::RANK_BYTES].astype("<u4")
        levels += [np.uint64(len(rest)).tobytes(), rest.astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]
        if not more.any():
            break
        rest = rest[more] >> np.uint64(8)
    head = np.array([len(ids), len(doc_ids), len(levels) // 4], "<u8").tobytes()
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join([MAGIC, head, numbers.tobytes(), known.tobytes(), ends.astype("<u8").tobytes(), *levels])


class Segment:
    """Reads a packed segment in place."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a segment of token codes")
        self._blob, self._at = blob, 4
        self.n_tokens, n_docs, n_levels = (int(x) for x in self._take("<u8", 3))
        numbers, known = self._take("<i8", n_docs), self._take(np.uint8, n_docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(numbers, known)]
        self.ends = self._take("<u8", n_docs).astype(np.int64)
        self._levels = []
        for _ in range(n_levels):
            n = int(self._take("<u8", 1)[0])
            size = (n + 7) // 8
            self._levels.append(
                (self._take(np.uint8, n), self._take(np.uint8, size), self._take("<u4", size // RANK_BYTES + 1))
            )

    def _take(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self._blob, kind, n, self._at)
        self._at += out.nbytes
        return out

    def _rank(self, level: int, i: int) -> int:
        """Set bits before position i."""
        _, bits, ranks = self._levels[level]
        block = i // (8 * RANK_BYTES)
        whole = bits[block * RANK_BYTES : i // 8]
        last = int(bits[i // 8]) & ((1 << i % 8) - 1) if i % 8 else 0
        return int(ranks[block]) + int(_ONES[whole].sum()) + last.bit_count()

    def token(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for level, (low, bits, _) in enumerate(self._levels):
            value |= int(low[i]) << 8 * level
            if not bits[i // 8] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Ids of positions start to end (exclusive); reads these positions only."""
        out = np.zeros(max(0, end - start), np.uint32)
        rows = np.arange(len(out))
        for level, (low, bits, _) in enumerate(self._levels):
            if not len(rows):
                break
            out[rows] |= low[start:end].astype(np.uint32) << np.uint32(8 * level)
            more = np.unpackbits(bits[start // 8 : (end + 7) // 8], bitorder="little")[start % 8 :][: end - start]
            rows = rows[more.astype(bool)]
            start = self._rank(level, start)
            end = start + len(rows)
        return out


# --- tokens --------------------------------------------------------------------------

_LETTER = byte_table((0x41, 0x5A), (0x61, 0x7A))
_SPACE = byte_table((0x09, 0x0D), (0x20, 0x20))
# ASCII marks without the apostrophe, which begins the endings 's, 't and the like
_MARK = byte_table((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_ONE_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places at which byte-level BPE over the usual pre-token pattern never joins two bytes.

    They are text starts, ASCII white space after a character that is surely none, and an ASCII mark after a
    Latin letter.  What lies between two cuts is tokenised alike wherever it stands.
    """
    latin = np.zeros(len(data), bool)  # last byte of a letter from À to ÿ
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter = _LETTER[data] | latin
    solid = letter | (~_SPACE[data] & (data < 0x80))
    at = np.zeros(len(data), bool)
    at[1:] = (_SPACE[data[1:]] & solid[:-1]) | (_MARK[data[1:]] & letter[:-1])
    at[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(at)


class Encoder:
    """Whole texts to ids with the tokenizers library, one call for each new piece between two cuts.

    Ids of pieces are kept under a 64-bit hash, at most ``max_pieces`` of them.  The ids' bytes are compared with the
    text they stand for, so a hash collision cannot pass; such a block is encoded text by text.
    A text that contains the string of an added token (special ones too) goes through the library whole.
    """

    def __init__(self, path: str, max_pieces: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.max_pieces = max_pieces
        with open(path) as f:
            vocabulary = json.load(f)["model"]["vocab"]
        to_byte, self._as_text = _byte_letters()
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in to_byte for c in token):
                spelled[i] = bytes(to_byte[c] for c in token)
        self._token_bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self._token_size = np.array([len(s) for s in spelled])
        self._token_start = np.cumsum(self._token_size) - self._token_size
        self._forget()

    def _forget(self):
        self._known: dict[int, int] = {}
        self._ids, self._count, self._begin = array("I"), array("q"), array("q", [0])

    def _pieces(self, pieces: list[str]) -> list[list[int]]:
        model = self.tokenizer.model
        out = [
            [t.id for t in model.tokenize(p.encode().decode("latin1").translate(self._as_text))]
            if _ONE_WORD.fullmatch(p)
            else None
            for p in pieces
        ]
        others = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(others, self.tokenizer.encode_batch_fast([pieces[i] for i in others], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _with_added(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Which texts contain an added token's string."""
        found = np.zeros(len(offsets) - 1, bool)
        for token in self._added:
            at = raw.find(token)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, "right")) - 1
                inside = at + len(token) <= offsets[text + 1]
                found[text] |= inside
                # the rest of a text that has one needs no look
                at = raw.find(token, int(offsets[text + 1]) if inside else at + 1)
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text."""
        raw = data.tobytes()
        whole = self._with_added(raw, offsets)
        if not whole.any():
            return self._by_pieces(data, offsets)
        sizes, counts = np.diff(offsets), np.zeros(len(whole), np.int64)
        parts = []
        for some, way in ((whole, lambda d, o: self._plain(d.tobytes(), o)), (~whole, self._by_pieces)):
            ids, counts[some] = way(data[np.repeat(some, sizes)], np.concatenate([[0], np.cumsum(sizes[some])]))
            parts.append(ids)
        of_whole = np.repeat(whole, counts)
        out = np.empty(len(of_whole), np.uint32)
        out[of_whole], out[~of_whole] = parts
        return out, counts

    def _by_pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = cuts(data, offsets)
        ends = np.append(start[1:], len(data))
        unique, where, inverse = np.unique(span_hashes(data, start), return_index=True, return_inverse=True)
        if len(self._known) > self.max_pieces:
            self._forget()
        keys = unique.tolist()
        new = [i for i, k in enumerate(keys) if k not in self._known]
        raw = data.tobytes()
        spans = [(int(start[where[i]]), int(ends[where[i]])) for i in new]
        for i, ids in zip(new, self._pieces([raw[a:b].decode("utf-8", "replace") for a, b in spans])):
            self._known[keys[i]] = len(self._count)
            self._ids.extend(ids)
            self._count.append(len(ids))
            self._begin.append(self._begin[-1] + len(ids))
        slots = np.array([self._known[k] for k in keys], np.int64)[inverse] if keys else np.zeros(0, np.int64)
        count = np.frombuffer(self._count.tobytes(), np.int64)[slots]
        total = int(count.sum())
        at = np.arange(total) + np.repeat(np.frombuffer(self._begin.tobytes(), np.int64)[slots] - (np.cumsum(count) - count), count)
        ids = np.frombuffer(self._ids.tobytes(), np.uint32)[at]
        counts = spans_sum(count, np.searchsorted(start, offsets))
        return (ids, counts) if self._spells(ids, data) else self._plain(raw, offsets)

    def _spells(self, ids: np.ndarray, data: np.ndarray) -> bool:
        size = self._token_size[ids]
        if int(size.sum()) != len(data):
            return False
        at = np.arange(len(data)) + np.repeat(self._token_start[ids] - (np.cumsum(size) - size), size)
        return bool(np.array_equal(self._token_bytes[at], data))

    def _plain(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)


def _byte_letters() -> tuple[dict[str, int], dict[int, str]]:
    """The letters byte-level vocabularies write bytes with: letter to byte, and byte to letter."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: b for b, c in letters.items()}, letters


# one encoder for each Python worker, kept between its tasks
_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- tables --------------------------------------------------------------------------

SEGMENT_SCHEMA = "part int, seq int, n_docs long, n_tokens long, segment binary"


def write_codes(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> None:
    """Tokenise whole texts and store their ids with ``end_id`` after each, in ascending doc_id order.

    ``docs`` needs doc_id and text; other columns are ignored.  A null text is empty.  A null doc_id comes first; rows that
    repeat a doc_id follow each other in the order of their texts.  ``part`` and ``seq`` give the order of segments.
    ``tokenizer_path`` must exist on every executor.  An empty table gives an empty store.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        encoder, part, seq = _encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for block in blocks(batch, "text"):
                data, offsets = utf8(block.column("text"))
                ids, counts = encoder.encode(data, offsets)
                n = len(counts)
                ends = np.cumsum(counts + 1)
                out = np.full(len(ids) + n, end_id, np.uint32)
                out[np.arange(len(ids)) + np.repeat(np.arange(n), counts)] = ids
                blob = encode_segment(out, block.column("doc_id").to_pylist(), ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([seq], pa.int32()),
                        pa.array([n], pa.int64()),
                        pa.array([len(out)], pa.int64()),
                        pa.array([blob], pa.binary()),
                    ],
                    ["part", "seq", "n_docs", "n_tokens", "segment"],
                )
                seq += 1

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    # segments are looked into, so Parquet leaves them as they are
    ordered.mapInArrow(run, SEGMENT_SCHEMA).write.option("compression", "none").parquet(folder)


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and n_tokens of each row's whole text (no end id); a null text has none.  Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]):
        # not kept between tasks: a Python worker's next task may be another operator's, with all its memory to itself
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            for block in blocks(batch, "text"):
                counts = encoder.encode(*utf8(block.column("text")))[1]
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_tokens long")


def segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).parquet(folder)


def segment_starts(stored: DataFrame) -> DataFrame:
    """part, seq, ``before`` (the tokens before each segment) and n_tokens.  Reads no segment.

    Parts are added up first, so the one ordered task sees a row per part (a task of the writing job), not per segment.
    """
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        stored.select("part", "seq", "n_tokens", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("in_part"))
        .join(parts, "part")
        .select("part", "seq", (F.col("part_start") + F.col("in_part")).alias("before"), "n_tokens")
    )


def read_tokens(stored: DataFrame, positions: DataFrame) -> DataFrame:
    """position and token: the ids at corpus positions, counted from 0 over all documents with their end ids.

    ``positions`` needs position; repeated ones give one row, and a null, a negative one or one past the end has token null.
    Positions meet the segments' starts in bins as wide as the mean segment, so that the segments' rows are at most three
    times the segments; then each segment that is asked for looks its tokens up, and no other is read by Python.
    """
    wanted = positions.select(F.col("position").cast("long").alias("position")).distinct()
    size = stored.agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("segments")).first()
    width = max(1, (size["tokens"] or 0) // max(size["segments"], 1))
    starts = segment_starts(stored).where("n_tokens > 0")
    last = F.col("before") + F.col("n_tokens") - 1
    binned = starts.withColumn("bin", F.explode(F.sequence(F.floor(F.col("before") / width), F.floor(last / width))))
    inside = F.col("position") - F.col("before")
    placed = (
        wanted.withColumn("bin", F.floor(F.col("position") / width))
        .join(binned, "bin")
        .where((inside >= 0) & (inside < F.col("n_tokens")))
    )
    # a segment has a bounded number of tokens, and positions are distinct
    asked = placed.groupBy("part", "seq", "before").agg(F.collect_list(inside).alias("inside"))

    def look_up(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for before, inside, blob in zip(*(batch.column(c) for c in ("before", "inside", "segment"))):
                segment, places = Segment(blob.as_py()), inside.as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([before.as_py() + i for i in places], pa.int64()),
                        pa.array([segment.token(i) for i in places], pa.int64()),
                    ],
                    ["position", "token"],
                )

    found = (
        stored.select("part", "seq", "segment")
        .join(asked, ["part", "seq"])
        .select("before", "inside", "segment")
        .mapInArrow(look_up, "position long, token long")
    )
    return wanted.join(found, "position", "left")


def read_documents(stored: DataFrame) -> DataFrame:
    """Per stored document: doc_id, start (tokens before it), n_tokens, ids_crc32 of its ids as little-endian uint32."""

    def run(batches: Iterator[pa.RecordBatch]):
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"]
        for batch in batches:
            for part, seq, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "segment"))):
                segment = Segment(blob)
                ids = segment.tokens(0, segment.n_tokens).astype("<u4")
                starts = np.concatenate([[0], segment.ends[:-1]]).astype(np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, segment.ends)]
                n = len(crc)
                columns = [[part] * n, [seq] * n, segment.doc_ids, starts, segment.ends - starts, crc]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = stored.select("part", "seq", "segment").mapInArrow(
        run, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return rows.join(segment_starts(stored).drop("n_tokens"), ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
