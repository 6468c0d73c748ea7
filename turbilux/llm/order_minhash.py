"""Near duplicates by Order MinHash, verified by banded alignment.

Shingles of five words, labelled by their occurrence in the text, are hashed by several functions.  Each function samples
its two least shingles and keeps them in text order; a pair in common makes two texts candidates.  A bucket is compared
with its most central text, which joins most of a bucket by work linear in it.  Then every pair of a bucket that is not yet in one component is compared, in tiles of bounded size: bounds on the
distance that cannot reject a similar pair come first.  Candidates are verified by edit distance over words inside a band.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.llm.components import components
from turbilux.llm.storage import staged, without_rows
from turbilux.llm.text_arrays import Words, blocks, mix, text_of, utf8

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 96
# leaders a bucket is compared with, one after the other, before the pairs that are still open
ROUNDS = 1
# members and bytes of words (about) on each side of a tile of open pairs: a tile is what one worker holds
TILE, TILE_BYTES = 65_536, 8 << 20
# classes of words whose counts bound the distance of two texts from below
BINS = 256
# pairs whose bounds are computed at once
PAIRS = 4096

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_MOST = np.uint64(2**64 - 1)


def _lowered_words(block: pa.RecordBatch) -> Words:
    data, offsets = utf8(block.column("text"))
    return Words(_LOWER[data], offsets)


def _shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled shingles of all texts and the text each belongs to; a shorter text is one shingle."""
    h, owner = words.hashes(), text_of(words.first)
    counts = np.diff(words.first)
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    owners = np.concatenate([owner, np.full(size, -1)])
    total = np.zeros(len(h), np.uint64)
    for k in range(size):
        total *= _FACTOR
        total += np.where(owners[k : k + len(h)] == owner, padded[k : k + len(h)], np.uint64(0))
    place = np.arange(len(h)) - words.first[owner]
    starts = (place <= counts[owner] - size) | (place == 0)
    shingle, owner = mix(total[starts]), owner[starts]
    order = np.argsort(mix(shingle ^ mix(owner.astype(np.uint64) + np.uint64(1))), kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = (shingle[order][1:] == shingle[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    run = np.arange(len(order))
    nth = np.empty(len(order), np.int64)
    nth[order] = run - np.maximum.accumulate(np.where(same, 0, run))
    again = nth > 0
    shingle[again] = mix(shingle[again] + nth[again].astype(np.uint64) * _FACTOR)
    return shingle, owner


def order_sketches(words: Words, size: int, sketches: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have words, their sketches): each sketch stands for two least shingles in text order."""
    shingle, owner = _shingles(words, size)
    if not len(shingle):
        return np.zeros(0, np.int64), np.zeros((0, sketches), np.int64)
    head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    lengths = np.diff(np.append(head, len(owner)))
    out = np.empty((len(head), sketches), np.int64)
    for k in range(sketches):
        salt = mix(np.array([k + 1], np.uint64))[0]
        value = (shingle ^ salt) * (salt | np.uint64(1))
        value ^= value >> np.uint64(32)
        places = []
        for _ in range(2):
            least = np.minimum.reduceat(value, head)
            at = np.flatnonzero(value == np.repeat(least, lengths))
            # equal values within a text are possible only by a hash collision: the first counts
            at = at[np.concatenate([[True], owner[at][1:] != owner[at][:-1]])]
            places.append(at)
            value[at] = _MOST
        first, second = np.minimum(*places), np.maximum(*places)
        out[:, k] = mix(shingle[first] * _FACTOR + mix(shingle[second] ^ salt)).view(np.int64)
    return owner[head], out


def edit_distance_within(a: list[int], b: list[int], limit: int) -> int | None:
    """Edit distance of two sequences if it is at most ``limit``: bit-parallel, with matches inside the band only."""
    if abs(len(a) - len(b)) > limit:
        return None
    if not a or not b:
        return max(len(a), len(b))
    n = len(a)
    full, top = (1 << n) - 1, 1 << (n - 1)
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    band = (1 << (2 * limit + 1)) - 1
    up, down, distance = full, 0, n
    for j, x in enumerate(b):
        match = where.get(x, 0)
        if match:
            match &= band << (j - limit) if j >= limit else band >> (limit - j)
        zero = ((((match & up) + up) ^ up) | match | down) & full
        right_up = (down | ~(zero | up)) & full
        right_down = zero & up
        if right_up & top:
            distance += 1
        elif right_down & top:
            distance -= 1
        right_up = (right_up << 1 | 1) & full
        up = ((right_down << 1) | ~(zero | right_up)) & full
        down = right_up & zero
    return distance if distance <= limit else None


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Is 1 - edit distance / longer length at least ``least``?"""
    longer = max(len(a), len(b))
    limit = int((1 - least) * longer + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return False
    if len(a) == len(b) and int((a != b).sum()) <= limit:
        return True
    # every aligned word is in both bags
    x, y = a.tolist(), b.tolist()
    if longer - (Counter(x) & Counter(y)).total() > limit:
        return False
    return edit_distance_within(x, y, limit) is not None


def _sketch_rows(nodes: DataFrame, size: int, sketches: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block in blocks(batch, "text"):
                which, out = order_sketches(_lowered_words(block), size, sketches)
                keys = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, out.size + 1, sketches), pa.int32()), pa.array(out.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays([block.column("node").take(pa.array(which)), keys], ["node", "sketch"])

    return nodes.mapInArrow(run, "node long, sketch array<long>")


def _sequences(nodes: DataFrame) -> DataFrame:
    """node and its words as 32-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block in blocks(batch, "text"):
                words = _lowered_words(block)
                h = (words.hashes() & np.uint64(0xFFFFFFFF)).astype("<u4")
                packed = [h[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:])]
                yield pa.RecordBatch.from_arrays([block.column("node"), pa.array(packed, pa.binary())], ["node", "words"])

    return nodes.mapInArrow(run, "node long, words binary")


def _verified(pairs: DataFrame, sequences: DataFrame, least: float) -> DataFrame:
    """The pairs (leader, node) whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = zip(*(batch.column(c) for c in ("left_words", "right_words")))
            good = [
                similar(np.frombuffer(x.as_buffer(), "<u4"), np.frombuffer(y.as_buffer(), "<u4"), least) for x, y in rows
            ]
            yield batch.select(["leader", "node"]).filter(pa.array(good, pa.bool_()))

    left = sequences.select(F.col("node").alias("leader"), F.col("words").alias("left_words"))
    right = sequences.select("node", F.col("words").alias("right_words"))
    joined = pairs.join(right, "node").join(left, "leader").select("leader", "node", "left_words", "right_words")
    return joined.mapInArrow(run, "leader long, node long")


def _open_rows(members: DataFrame, parts: DataFrame, sequences: DataFrame, tile: int) -> DataFrame:
    """Members of buckets that hold several components, once for each tile: bucket, i, j, role, small, node, component.

    Two members of different components are not both in the largest one of their bucket.  So the others (``small``), in
    chunks i, are compared with all members, in chunks j; role 1 is a member of chunk i, 2 one of chunk j, 3 both.
    """
    tagged = staged(
        members.select("bucket", "node")
        .join(parts, "node", "left")
        .join(sequences.select("node", F.length("words").alias("bytes")), "node")
        .select("bucket", "node", "bytes", F.coalesce("component", "node").alias("component"))
    )
    counts = tagged.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    largest = F.max(F.struct("n", "component", "bytes"))

    def chunks(n, size):
        return F.greatest(F.ceil(n / tile), F.ceil(size / TILE_BYTES)).cast("int")

    shape = counts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("components"),
        largest["component"].alias("largest"),
        chunks(F.sum("n"), F.sum("bytes")).alias("all_chunks"),
        chunks(F.sum("n") - largest["n"], F.sum("bytes") - largest["bytes"]).alias("small_chunks"),
    )
    rows = tagged.drop("bytes").join(shape.where("components > 1"), "bucket").withColumn("small", F.expr("component <> largest"))
    tiles = F.expr(
        """case when all_chunks = 1 then array(struct(0 as i, 0 as j, if(small, 3, 2) as role))
           else concat(
             transform(sequence(0, small_chunks - 1),
                       i -> struct(i as i, cast(pmod(xxhash64(node), all_chunks) as int) as j, 2 as role)),
             if(small, transform(sequence(0, all_chunks - 1),
                                 j -> struct(cast(pmod(xxhash64(node, 1), small_chunks) as int) as i, j as j, 1 as role)),
                array())) end"""
    )
    rows = rows.select("bucket", "node", "component", "small", F.explode(tiles).alias("t"))
    return rows.select("bucket", "t.i", "t.j", "t.role", "small", "node", "component")


def _open_pairs(tile: pa.Table, least: float) -> Iterator[tuple[int, int]]:
    """Pairs of rows of a tile that have to be verified: the others are joined, too far apart or met in an earlier bucket."""
    role, node, component = (tile.column(c).to_numpy() for c in ("role", "node", "component"))
    small = tile.column("small").to_numpy()
    sketch = tile.column("sketch").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
    size = pc.binary_length(tile.column("words")).to_numpy() // 4
    at = int(np.flatnonzero(sketch[0] == tile.column("bucket")[0].as_py())[0])
    left, right = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    bins: dict[int, np.ndarray] = {}

    def counts(i: int) -> np.ndarray:
        if i not in bins:
            words = np.frombuffer(tile.column("words")[i].as_buffer(), "<u4")
            bins[i] = np.bincount(words % BINS, minlength=BINS).astype(np.int32)
        return bins[i]

    for a in left.tolist():
        b = right[(component[right] != component[a]) & (~small[right] | (node[right] > node[a]))]
        limit = ((1 - least) * np.maximum(size[a], size[b]) + 1e-9).astype(np.int64)
        b, limit = (x[np.abs(size[b] - size[a]) <= limit] for x in (b, limit))
        # a pair belongs to the first bucket that it shares
        first = ~(sketch[b, :at] == sketch[a, :at]).any(axis=1)
        b, limit = b[first], limit[first]
        for k in range(0, len(b), PAIRS):
            some = b[k : k + PAIRS]
            # an edit changes two counts at most, and as many words as the lengths differ have no partner
            apart = np.abs(np.stack([counts(i) for i in some.tolist()]) - counts(a)).sum(axis=1)
            near = apart + np.abs(size[some] - size[a]) <= 2 * limit[k : k + PAIRS]
            yield from ((a, i) for i in some[near].tolist())


def _open_links(rows: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (leader, node) among the open pairs of all tiles; a link that earlier ones of the same task imply is left out."""
    key = ["bucket", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]):
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while x in above:
                x = above[x]
            return x

        def links(tile: pa.Table) -> pa.RecordBatch:
            node, component, words = (tile.column(c) for c in ("node", "component", "words"))
            found = []
            for a, b in _open_pairs(tile, least):
                x, y = top(component[a].as_py()), top(component[b].as_py())
                texts = (np.frombuffer(words[i].as_buffer(), "<u4") for i in (a, b))
                if x != y and similar(*texts, least):
                    above[x] = y
                    found.append((node[a].as_py(), node[b].as_py()))
            columns = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["leader", "node"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            if not len(table):
                continue
            change = np.zeros(len(table) - 1, bool)
            for c in key:
                column = table.column(c).to_numpy()
                change |= column[1:] != column[:-1]
            starts = np.concatenate([[0], np.flatnonzero(change) + 1]).tolist()
            for a, b in zip(starts[:-1], starts[1:]):
                yield links(table.slice(a, b - a))
            held = table.slice(starts[-1])
        if held is not None:
            yield links(held)

    joined = rows.join(texts, "node").select(*key, "role", "small", "node", "component", "sketch", "words")
    return joined.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "leader long, node long")


def near_groups(
    docs: DataFrame,
    least: float = SIMILARITY,
    shingle: int = SHINGLE,
    sketches: int = SKETCHES,
    rounds: int = ROUNDS,
    tile: int = TILE,
) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept, row_hash.

    Two texts are linked when they share a sketch and 1 - word edit distance / words of the longer one is at least ``least``;
    no such link is lost, whatever the bucket's size.  Classes are the connected components of links, named by their smallest doc_id, which stays.  Equal texts are one node (a 64-bit hash of the text)
    and copies are never compared.  ``docs`` needs doc_id and text; other columns are ignored.  A text without words, null
    included, is linked to nothing but its equals (null and empty differ).  A null doc_id is larger than any other; a class
    of such rows has class_id null and keeps them; rows that repeat a doc_id follow their own texts.
    Words are split at ASCII white space and compared without regard to the case of A-Z.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("node"),
        F.col("text").cast("string").alias("text"),
    )
    nodes = rows.select("node", "text")
    sketched = staged(_sketch_rows(nodes, shingle, sketches).dropDuplicates(["node"]))
    keys = sketched.select("node", F.explode("sketch").alias("bucket"))
    sizes = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = staged(keys.join(sizes, "bucket"))
    # the most central text of a bucket shares its sketches with most others
    central = members.groupBy("node").agg(F.sum("members").alias("weight"))
    members = staged(members.select("bucket", "node").join(central, "node"))
    sequences = staged(_sequences(nodes.join(central.select("node"), "node", "left_semi")).dropDuplicates(["node"]))
    links, left = None, members
    for _ in range(rounds):
        leaders = left.groupBy("bucket").agg(
            F.max(F.struct("weight", "node"))["node"].alias("leader"), F.count(F.lit(1)).alias("members")
        )
        led = left.join(leaders.where("members > 1"), "bucket").where("node <> leader")
        pairs = led.select("leader", "node").distinct()
        found = staged(_verified(pairs, sequences, least))
        links = found if links is None else links.union(found)
        left = staged(led.join(found, ["leader", "node"], "left_anti").select("bucket", "node", "weight"))
    parts = staged(components(links.select(F.col("leader").alias("a"), F.col("node").alias("b"))))
    still = _open_links(_open_rows(members, parts, sequences, tile), sequences.join(sketched, "node"), least)
    # what was joined is one node now
    labels = [parts.select(F.col("node").alias(end), F.col("component").alias(c)) for end, c in (("leader", "a"), ("node", "b"))]
    still = still.join(labels[0], "leader", "left").join(labels[1], "node", "left")
    wider = components(still.select(F.coalesce("a", "leader").alias("a"), F.coalesce("b", "node").alias("b")))
    wider = wider.select(F.col("node").alias("component"), F.col("component").alias("wider"))
    placed = staged(
        rows.select("doc_id", "node")
        .join(parts, "node", "left")
        .select("doc_id", "node", F.coalesce("component", "node").alias("component"))
        .join(wider, "component", "left")
        .select("doc_id", "node", F.coalesce("wider", "component").alias("component"))
    )
    classes = placed.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return placed.join(classes, "component").select(
        "doc_id",
        "class_id",
        "class_size",
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"),
        F.col("node").alias("row_hash"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns; a row is known by its doc_id (null-safe) and text."""
    return without_rows(docs, near_groups(docs).where("not kept"))
