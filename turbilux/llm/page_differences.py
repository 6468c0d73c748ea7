"""Main text of HTML pages by nearest-URL page differencing.

Within each host, pages stand in the order of their URL paths; each is paired with the page before and the page after it.
The text lines of a pair are aligned by longest common subsequence, and what both pages have is taken for the site's, not
the page's, and deleted.  Two things a difference alone cannot tell: a copy of an article is not a template, so lines inside
the article element stay, and a pair that shares nearly all its text says nothing; and menus, notices and adverts that
differ from page to page are known by their markup.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.llm.page_lines import Line, lines_of, place_of
from turbilux.llm.sequence import numbered, whole_groups
from turbilux.llm.storage import staged

# pages compared in one group of neighbours
CHUNK_PAGES = 64
# share of a page's text that may be its neighbour's too; with more the two are copies, whose difference tells nothing
MOST_SHARED = 0.8
# bits of alignment table held at once; longer pairs are halved first
TABLE_BITS = 1 << 28


def _align(a: list, b: list) -> list[tuple[int, int]]:
    """Places (i, j) of one longest common subsequence, by bit-parallel rows."""
    if len(a) * len(b) > TABLE_BITS and len(a) > 1:
        # the best cut of b for a cut of a in the middle: lengths of both halves, row by row
        middle = len(a) // 2
        ahead, behind = _lengths(a[:middle], b), _lengths(a[middle:][::-1], b[::-1])[::-1]
        cut = int(np.argmax(ahead + behind))
        rest = _align(a[middle:], b[cut:])
        return _align(a[:middle], b[:cut]) + [(i + middle, j + cut) for i, j in rest]
    rows, full = [], (1 << len(b)) - 1
    for v in _row_steps(a, b):
        rows.append(v)
    out = []
    j = len(b) - 1
    for i in range(len(a) - 1, -1, -1):
        if j < 0:
            break
        # zero bits mark the columns at which the length grows
        now, before = ~rows[i] & full, (~rows[i - 1] & full) if i else 0
        upto = (1 << (j + 1)) - 1
        if (now & upto).bit_count() == (before & upto).bit_count():
            continue
        # the last column that ends a sequence of this length and holds this row's value
        while (now & ((1 << j) - 1)).bit_count() == (now & upto).bit_count():
            j -= 1
            upto >>= 1
        out.append((i, j))
        j -= 1
    return out[::-1]


def _row_steps(a: list, b: list) -> Iterator[int]:
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with every beginning of ``b``."""
    v = (1 << len(b)) - 1
    for v in _row_steps(a, b):
        pass
    bits = [0] + [1 - (v >> j & 1) for j in range(len(b))]
    return np.cumsum(bits)


def common_lines(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two line lists; what only one of them has is left out first."""
    only = set(a) & set(b)
    left = [i for i, x in enumerate(a) if x in only]
    right = [j for j, x in enumerate(b) if x in only]
    head = 0
    while head < min(len(left), len(right)) and a[left[head]] == b[right[head]]:
        head += 1
    tail = 0
    while tail < min(len(left), len(right)) - head and a[left[-1 - tail]] == b[right[-1 - tail]]:
        tail += 1
    inner = _align([a[i] for i in left[head : len(left) - tail]], [b[j] for j in right[head : len(right) - tail]])
    pairs = list(zip(left[:head], right[:head])) + [(left[i + head], right[j + head]) for i, j in inner]
    return pairs + (list(zip(left[-tail:], right[-tail:])) if tail else [])


def shared_lines(a: list, b: list, a_sizes: list[int], b_sizes: list[int]) -> tuple[list[int], list[int]]:
    """Lines of each page that both have, by place; none where one page has too little of its own, as copies have."""
    pairs = common_lines(a, b)
    held = sum(a_sizes[i] for i, _ in pairs)
    if held > MOST_SHARED * min(sum(a_sizes), sum(b_sizes)):
        return [], []
    return [i for i, _ in pairs], [j for _, j in pairs]


def _line_hash(line: Line) -> bytes:
    return hashlib.blake2b(line.text.encode("utf-8", "surrogatepass"), digest_size=8).digest()


_READ = "page binary, host string, path string, hashes array<long>, sizes array<int>"
_READ_ARROW = pa.schema([
    ("page", pa.binary()), ("host", pa.string()), ("path", pa.string()), ("hashes", pa.list_(pa.int64())),
    ("sizes", pa.list_(pa.int32())),
])


def _name(host: str, hashes: list[bytes]) -> bytes:
    """A page's name: its host and its lines, so that copies are one page."""
    return hashlib.blake2b(host.encode("utf-8", "surrogatepass") + b"\0" + b"".join(hashes), digest_size=16).digest()


def _read(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                host, path = place_of(url)
                lines = lines_of(page or "")
                hashes = [_line_hash(line) for line in lines]
                out.append({
                    "page": _name(host, hashes), "host": host, "path": path,
                    "hashes": [int.from_bytes(h, "little", signed=True) for h in hashes],
                    "sizes": [len(line.text) for line in lines],
                })
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_READ_ARROW)

    return pages.select("url", "html").mapInArrow(run, _READ)


def site_lines(pages: DataFrame) -> DataFrame:
    """page (the name of a text of a host) and the places of its lines that a neighbour has too."""
    read = _read(pages)
    one = read.groupBy("page").agg(*(F.min_by(c, F.struct("host", "path")).alias(c) for c in ("host", "path", "hashes", "sizes")))
    placed = numbered(one, ["host", "path", "page"])
    chunk = F.col("position").cast("long")
    # the first page of a chunk also stands at the end of the chunk before
    copies = F.array_distinct(F.array(F.floor(chunk / CHUNK_PAGES), F.floor((chunk - 1) / CHUNK_PAGES)))
    spread = placed.withColumn("chunk", F.explode(copies)).where("chunk >= 0")

    def run(batches: Iterator[pa.RecordBatch]):
        for table in whole_groups(batches, ["chunk"]):
            before, out = None, []
            for row in table.to_pylist():
                if before is not None and before["chunk"] == row["chunk"] and before["host"] == row["host"]:
                    found = shared_lines(before["hashes"], row["hashes"], before["sizes"], row["sizes"])
                    out += [(p["page"], places) for p, places in zip((before, row), found) if places]
                before = row
            if out:
                names, places = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(places, pa.list_(pa.int32()))], ["page", "places"]
                )

    pairs = spread.repartition("chunk").sortWithinPartitions("chunk", "position")
    shared = pairs.mapInArrow(run, "page binary, places array<int>")
    # two neighbours at most
    return staged(shared.groupBy("page").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")))


def candidates(lines: list[Line]) -> list[tuple[int, Line]]:
    """Lines that can be of the article, with their places: not aside by markup.

    A page with an article element, or else a main element, has its text only there.
    """
    seen = [(i, line) for i, line in enumerate(lines) if not line.aside]
    depth = max((line.body for _, line in seen), default=0)
    return [(i, line) for i, line in seen if line.body >= min(depth, 1)]


def main_lines(lines: list[Line], shared: list[int]) -> list[str]:
    """The article's lines: candidates that no neighbour shares, or that stand inside the article element."""
    gone = set(shared)
    return [line.text for i, line in candidates(lines) if line.body == 2 or i not in gone]


def _packed(pages: DataFrame) -> DataFrame:
    """page_id, url, page, kept (compressed candidates), free (their numbers and places, where a neighbour can delete them)."""

    def run(batches: Iterator[pa.RecordBatch]):
        squeeze = pa.Codec("zstd")
        for batch in batches:
            names, kept, free = [], [], []
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                lines = lines_of(page or "")
                names.append(_name(place_of(url)[0], [_line_hash(line) for line in lines]))
                held = candidates(lines)
                text = "\n".join(line.text for _, line in held).encode("utf-8", "surrogatepass")
                kept.append(len(text).to_bytes(8, "little") + squeeze.compress(text, asbytes=True))
                free.append([x for k, (i, line) in enumerate(held) if line.body < 2 for x in (k, i)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(names, pa.binary()),
                    pa.array(kept, pa.binary()), pa.array(free, pa.list_(pa.int32())),
                ],
                ["page_id", "url", "page", "kept", "free"],
            )

    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return given.mapInArrow(run, "page_id long, url string, page binary, kept binary, free array<int>")


def _texts(packed: DataFrame) -> DataFrame:
    """page_id, url, text of packed pages with the ``places`` that a neighbour shares."""

    def run(batches: Iterator[pa.RecordBatch]):
        squeeze = pa.Codec("zstd")
        for batch in batches:
            texts = []
            for kept, free, places in zip(*(batch.column(c).to_pylist() for c in ("kept", "free", "places"))):
                data = squeeze.decompress(kept[8:], int.from_bytes(kept[:8], "little"), asbytes=True)
                text = data.decode("utf-8", "replace")
                gone = set(places or ()) & set(free[1::2])
                if gone:
                    out = {k for k, i in zip(free[::2], free[1::2]) if i in gone}
                    text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in out)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return packed.mapInArrow(run, "page_id long, url string, text string")


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    ``pages`` needs page_id, url and html; other columns are ignored.  A null html is an empty page, a null or unreadable url
    has the empty host; such pages are neighbours of each other.  Copies of a page within a host count once when neighbours
    are sought, and all get the same text; repeated rows come back as often as they are given.  An empty table gives no rows.
    """
    # always a shuffle join: the neighbours' table grows with the pages
    joined = _packed(pages).join(site_lines(pages).hint("merge"), "page", "left")
    return _texts(joined).withColumn("n_chars", F.length("text").cast("long"))
