"""Conversation structure repair: a cost DP over turns, then the least cheapest path by prefix doubling.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials.  A path through (turn, state of that pattern)
is a sequence of edits: Keep, Rerole, Delete, Insert.  Costs are computed backwards.  The arcs that lie on cheapest paths
become nodes; they are ranked by the letters of the next 1, 2, 4, ... edits, each rank from two ranks of half the length,
while pointers to the arc that many edits ahead are doubled as well.  The least-ranked arc of the first state opens the
path and the doubled pointers give all of it.

Conversations are cut into pieces of neighbouring turns, so that one of any length is worked on by many tasks: a piece is
known by its 4 x 4 table of costs from state to state; the tables are chained per conversation, a few numbers a piece.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turbilux.llm.sequence import changes, numbered, whole_groups
from turbilux.llm.storage import staged

# turns of a piece (at most), and pieces handled at once
PIECE_TURNS = 256
PIECE_BLOCK = 512

RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# edits in the order of their letters; 0 is the end of the path
LETTERS = " DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
USER, ASSISTANT = "user", "assistant"

# states of the pattern: nothing yet, after s, after u, after a
STATES = 4
# state after the initial s, u or a (numbers 1 to 3; 0 is any other initial); -1 is no such step
STEP = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])
# the only step a rerole or an insert can take
NEXT = np.array([2, 2, 3, 2])
# cost and edits from the state after the last turn to a complete pattern
LAST_COST = (0, 2 * INSERT, INSERT, 0)
LAST_EDITS = ("", "II", "I", "")
_FAR = 1 << 40

# a turn as one byte: initial, whether it must go, whether it is truncated
_GONE, _CUT = 4, 8
_LEGAL = {(1, 2), (2, 3), (3, 2)}


def _costs(codes: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cost from each (turn, state) of each piece to behind its last turn; ``ends`` are the costs there.

    ``codes`` (pieces x turns) are aligned at their ends; the result has one more level than turns.
    """
    pieces, width = codes.shape
    out = np.full((pieces, width + 1, STATES), _FAR, np.int64)
    out[:, width] = ends
    for i in range(width - 1, -1, -1):
        inside = width - i <= lengths
        after, now = out[:, i + 1], out[:, i]
        code = codes[:, i]
        stays = np.where(code & _CUT, TRUNCATED, 0) + np.where(code & _GONE, _FAR, 0)
        for s in range(STATES):
            to = STEP[s, code & 3]
            keep = np.where(to >= 0, after[np.arange(pieces), to], _FAR) + stays
            cost = np.minimum(keep, np.minimum(after[:, NEXT[s]] + stays + RETYPE, after[:, s] + DELETE))
            now[:, s] = np.minimum(cost, _FAR)
        # a second insert only ever follows a first into state 2
        two, three = now[:, 2].copy(), now[:, 3].copy()
        now[:, 2] = np.minimum(two, three + INSERT)
        now[:, 3] = np.minimum(three, two + INSERT)
        for s in (0, 1):
            now[:, s] = np.minimum(now[:, s], now[:, 2] + INSERT)
        out[:, i] = np.where(inside[:, None], now, after)
    return out


def transfer(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """pieces x 4 x 4: least cost from a state before the piece to a state behind it."""
    pieces = len(codes)
    unit = np.where(np.eye(STATES, dtype=bool), 0, _FAR)
    out = np.empty((pieces, STATES, STATES), np.int64)
    for t in range(STATES):
        out[:, :, t] = _costs(codes, lengths, np.broadcast_to(unit[t], (pieces, STATES)))[:, 0]
    return out


def _optimal_arcs(codes: np.ndarray, lengths: np.ndarray, ends: np.ndarray):
    """(node, letter, target node) of every arc on a cheapest path, by node and letter; nodes are (piece, level, state)."""
    pieces, width = codes.shape
    cost = _costs(codes, lengths, ends)
    level = np.arange(width)
    inside = (width - level)[None, :] <= lengths[:, None]
    stays = np.where(codes & _CUT, TRUNCATED, 0) + np.where(codes & _GONE, _FAR, 0)
    base = (np.arange(pieces)[:, None] * (width + 1) + level) * STATES
    found = []
    for s in range(STATES):
        now, after = cost[:, :-1, s], cost[:, 1:]
        known = inside & (now < _FAR)
        ahead = base + STATES
        to = STEP[s, codes & 3]
        kept = np.take_along_axis(after, np.maximum(to, 0)[..., None], 2)[..., 0]
        arcs = (
            (_D, now == after[..., s] + DELETE, ahead + s),
            (_I, now == cost[:, :-1, NEXT[s]] + INSERT, base + NEXT[s]),
            (_K, (to >= 0) & (now == kept + stays), ahead + to),
            (_R, now == after[..., NEXT[s]] + stays + RETYPE, ahead + NEXT[s]),
        )
        for letter, cheapest, target in arcs:
            at = known & cheapest
            found.append((base[at] + s, np.full(int(at.sum()), letter), target[at]))
    node, letter, target = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((letter, node))
    return node[order], letter[order], target[order]


def least_paths(codes: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> list[list[tuple[str, int]]]:
    """For each piece and each state before it: the letters of the least cheapest path, and the state behind the piece.

    From a state, each letter leads to one state only, so the first arc of a node by letter is also the one with the least
    following letters; ranks over doubled lengths then order the arcs of a node by their whole path.
    """
    pieces, width = codes.shape
    node, letter, target = _optimal_arcs(codes, lengths, ends)
    nodes = pieces * (width + 1) * STATES
    # behind the last turn each state ends the path: arcs without a letter that point at themselves
    final = ((np.arange(pieces) * (width + 1) + width)[:, None] * STATES + np.arange(STATES)).ravel()
    arcs = len(node)
    node, letter = np.concatenate([node, final]), np.concatenate([letter, np.zeros(len(final), np.int64)])
    first = np.full(nodes, -1)
    first[node[::-1]] = np.arange(len(node))[::-1]
    pointer = np.concatenate([first[target], np.arange(arcs, len(node))])
    rank, pointers = letter.astype(np.int64), [pointer]
    while (pointers[-1] < arcs).any():
        key = rank * (int(rank.max()) + 1) + rank[pointers[-1]]
        rank = np.unique(key, return_inverse=True)[1].reshape(-1)
        pointers.append(pointers[-1][pointers[-1]])
    # the arc of each first state with the least rank
    by_rank = np.lexsort((rank, node))
    heads = by_rank[np.concatenate([[True], node[by_rank][1:] != node[by_rank][:-1]])]
    best = np.full(nodes, -1)
    best[node[heads]] = heads
    start = width - lengths
    starts = best[((np.arange(pieces) * (width + 1) + start)[:, None] * STATES + np.arange(STATES))]
    path = np.empty((pieces, STATES, 1 << len(pointers)), np.int64)
    path[..., 0] = starts
    for k in range(len(pointers) - 1, -1, -1):
        step = 1 << k
        path[..., step :: 2 * step] = pointers[k][path[..., :: 2 * step]]
    letters = letter[path]
    names = np.frombuffer(LETTERS.encode(), np.uint8)
    out = []
    for p in range(pieces):
        row = []
        for s in range(STATES):
            if starts[p, s] < 0:
                row.append(("", -1))
                continue
            length = int(np.count_nonzero(letters[p, s]))
            state = int(node[path[p, s, length]] % STATES) if length < path.shape[2] else int(node[path[p, s, -1]] % STATES)
            row.append((names[letters[p, s, :length]].tobytes().decode(), state))
        out.append(row)
    return out


def _blocks_of(codes: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(numbers of the pieces, their codes aligned at the end, lengths), pieces of like length together."""
    sizes = np.array([len(c) for c in codes])
    order = np.argsort(sizes, kind="stable")
    classes = np.ceil(np.log2(np.maximum(sizes[order], 1))).astype(int)
    for size in np.unique(classes):
        alike = order[classes == size]
        for k in range(0, len(alike), PIECE_BLOCK):
            which = alike[k : k + PIECE_BLOCK]
            lengths = sizes[which]
            table = np.zeros((len(which), int(lengths.max())), np.int64)
            for i, p in enumerate(which):
                table[i, table.shape[1] - len(codes[p]) :] = np.frombuffer(codes[p], np.uint8)
            yield which, table, lengths


def turns_of(turns: DataFrame) -> DataFrame:
    """conv (a conversation's name, never null), turn, role, text and said (digest of role and text); nulls are one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select(conversation(F.col("conv_id")).alias("conv"), "turn", role.alias("role"), text.alias("text"))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("said", F.unhex(F.sha2(whole, 256)))


def conversation(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _marked(rows: DataFrame) -> DataFrame:
    """position, conv, turn and code of each row in order; ``blank``, ``duplicate``, ``truncated`` are first faults."""
    bare = F.rtrim("text", F.lit(BLANKS))
    first = F.left("role", F.lit(1))
    narrow = rows.select(
        "conv",
        "turn",
        "said",
        F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0).alias("initial"),
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(*ENDS)).alias("cut"),
        # equal rows are interchangeable; this only deals them out
        F.monotonically_increasing_id().alias("salt"),
    )
    placed = numbered(narrow, ["conv", F.col("turn").asc_nulls_first(), "said", "salt"]).drop("salt")
    repeats = placed.groupBy("conv", "said").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n"))
    known = placed.join(repeats.where("n > 1").drop("n"), ["conv", "said"], "left")
    again = F.coalesce(F.col("position") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), 1).when(again, 2).when(F.col("cut"), 3).otherwise(0)
    return known.withColumn("fault", fault).select(
        "conv", "position", "turn", "said", F.struct("initial", "fault").alias("mark")
    )


_PIECE = (
    "conv string, chunk long, codes binary, cost array<long>, first_turn long, first_said binary, last_turn long, "
    "least_turn long, turns long, blank long, duplicate long, truncated long, illegal long, head int, tail int"
)


def pieces_of(rows: DataFrame) -> DataFrame:
    """One row per piece of a conversation: its turns' codes, cost table and counts."""
    marked = _marked(rows).withColumn("chunk", F.floor(F.col("position") / PIECE_TURNS))
    flat = marked.select("conv", "chunk", "position", F.col("turn").cast("long").alias("turn"), "said", "mark.*")

    def run(batches: Iterator[pa.RecordBatch]):
        for table in whole_groups(batches, ["chunk", "conv"]):
            heads = changes(table, ["chunk", "conv"])
            tails = np.append(heads[1:], len(table))
            initial, fault = (table.column(c).to_numpy().astype(np.int64) for c in ("initial", "fault"))
            code = initial | np.where((fault == 1) | (fault == 2), _GONE, 0) | np.where(fault == 3, _CUT, 0)
            bytes_ = code.astype(np.uint8)
            codes = [bytes_[a:b].tobytes() for a, b in zip(heads, tails)]
            cost = np.empty((len(codes), STATES * STATES), np.int64)
            for which, block, lengths in _blocks_of(codes):
                cost[which] = transfer(block, lengths).reshape(len(which), -1)
            turn = table.column("turn").to_pylist()
            conv, chunk, said = (table.column(c) for c in ("conv", "chunk", "said"))
            out = []
            for i, (a, b) in enumerate(zip(heads.tolist(), tails.tolist())):
                known = [t for t in turn[a:b] if t is not None]
                counts = np.bincount(fault[a:b], minlength=4)
                ini = initial[a:b].tolist()
                out.append(
                    {
                        "conv": conv[a].as_py(), "chunk": chunk[a].as_py(), "codes": codes[i], "cost": cost[i].tolist(),
                        "first_turn": turn[a], "first_said": said[a].as_py(), "last_turn": turn[b - 1],
                        "least_turn": known[0] if known else None, "turns": len(set(known)),
                        "blank": int(counts[1]), "duplicate": int(counts[2]), "truncated": int(counts[3]),
                        "illegal": sum(p not in _LEGAL for p in zip(ini, ini[1:])), "head": ini[0], "tail": ini[-1],
                    }
                )
            yield from _rows(out, _PIECE_ARROW)

    return flat.repartition("chunk").sortWithinPartitions("chunk", "position").mapInArrow(run, _PIECE)


_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (field.split(" ") for field in ddl.split(", "))])


_PIECE_ARROW = _arrow(_PIECE)


def _rows(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


_AHEAD = _PIECE.replace(", cost array<long>", ", total long, ends array<long>") + ", joint_illegal long, joint_turn long"


def _chained(pieces: DataFrame) -> DataFrame:
    """Pieces with the costs behind them (``ends``), from each conversation's last piece to its first: one row in memory.

    ``total`` is the least cost from the piece's beginning in the first state; joint_* belong to the border with the next
    piece.
    """
    schema = _arrow(_AHEAD)

    def run(batches: Iterator[pa.RecordBatch]):
        conv, ends, later = None, None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    conv, ends, later = row["conv"], list(LAST_COST), None
                cost = row.pop("cost")
                row["ends"] = ends
                row["joint_illegal"] = int(later is not None and (row["tail"], later[0]) not in _LEGAL)
                row["joint_turn"] = int(later is not None and later[1] is not None and later[1] == row["last_turn"])
                ends = [min(cost[s * STATES + t] + ends[t] for t in range(STATES)) for s in range(STATES)]
                row["total"] = ends[0]
                later = (row["head"], row["first_turn"])
                out.append(row)
            yield from _rows(out, schema)

    ordered = pieces.repartition("conv").sortWithinPartitions("conv", F.col("chunk").desc())
    return ordered.mapInArrow(run, _AHEAD)


_PATHS = "conv string, chunk long, first_turn long, first_said binary, audits array<string>, states array<int>"


def _ranked(chained: DataFrame) -> DataFrame:
    """Each piece's least paths from all four states."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not len(batch):
                continue
            codes = batch.column("codes").to_pylist()
            ends = np.array(batch.column("ends").to_pylist(), np.int64)
            paths: list = [None] * len(codes)
            for which, block, lengths in _blocks_of(codes):
                for p, found in zip(which.tolist(), least_paths(block, lengths, ends[which])):
                    paths[p] = found
            audits = pa.array([[a for a, _ in p] for p in paths], pa.list_(pa.string()))
            states = pa.array([[s for _, s in p] for p in paths], pa.list_(pa.int32()))
            kept = [batch.column(c) for c in ("conv", "chunk", "first_turn", "first_said")]
            yield pa.RecordBatch.from_arrays(
                [*kept, audits, states], ["conv", "chunk", "first_turn", "first_said", "audits", "states"]
            )

    return chained.mapInArrow(run, _PATHS)


_EDITS = "conv string, chunk long, first_turn long, first_said binary, edits string"


def _chosen(paths: DataFrame) -> DataFrame:
    """The edits of each piece, from each conversation's first piece on: the state is all that is carried."""
    schema = _arrow(_EDITS)

    def run(batches: Iterator[pa.RecordBatch]):
        held, state = None, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held is not None and held["conv"] != row["conv"]:
                    held["edits"] += LAST_EDITS[state]
                    state = 0
                if held is not None:
                    out.append(held)
                audits, states = row.pop("audits"), row.pop("states")
                row["edits"], state = audits[state], states[state]
                held = row
            yield from _rows(out, schema)
        if held is not None:
            held["edits"] += LAST_EDITS[state]
            yield from _rows([held], schema)

    return paths.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(run, _EDITS)


_REPAIRED = "conv string, place long, edit string, role string, text string"


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv, place, edit, role, text of every turn that is in a repaired conversation, conversations together and in order.

    The edits of a piece stand before its first turn in the sort, so that a conversation of any length passes through
    with only the letters that are still due in memory.
    """
    turns = rows.select("conv", F.col("turn").cast("long").alias("turn"), "said", F.lit(1).alias("tag"), "role", "text")
    letters = edits.select(
        "conv", F.col("first_turn").alias("turn"), F.col("first_said").alias("said"), F.lit(0).alias("tag"),
        F.lit(None).cast("string").alias("role"), F.col("edits").alias("text"), "chunk",
    )
    both = turns.withColumn("chunk", F.lit(None).cast("long")).unionByName(letters)
    ordered = both.repartition("conv").sortWithinPartitions(
        "conv", F.col("turn").asc_nulls_first(), "said", "tag", "chunk"
    )
    schema = _arrow(_REPAIRED)

    def run(batches: Iterator[pa.RecordBatch]):
        conv, state, place, due = None, 0, 0, deque()
        out: list[dict] = []

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place
            out.append({"conv": conv, "place": place, "edit": edit, "role": role, "text": text})
            place += 1

        def inserts() -> None:
            nonlocal state
            while due and due[0] == "I":
                due.popleft()
                put("I", ASSISTANT if state == 2 else USER, "")
                state = int(NEXT[state])

        for batch in batches:
            for row in batch.select(["conv", "tag", "role", "text"]).to_pylist():
                if row["conv"] != conv:
                    inserts()
                    conv, state, place = row["conv"], 0, 0
                    due.clear()
                if row["tag"] == 0:
                    due.extend(row["text"])
                    continue
                inserts()
                edit = due.popleft()
                if edit == "K":
                    put(edit, row["role"], row["text"])
                    state = int(STEP[state, " sua".index(row["role"][0])])
                elif edit == "R":
                    put(edit, ASSISTANT if state == 2 else USER, row["text"])
                    state = int(NEXT[state])
            yield from _rows(out, schema)
            out.clear()
        inserts()
        yield from _rows(out, schema)

    return ordered.select("conv", "tag", "role", "text").mapInArrow(run, _REPAIRED)


def _digests(repaired: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its ``role:text`` lines; SHA-256 has to see a conversation in order, as a stream."""
    schema = _arrow("conv string, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]):
        conv, state = None, None
        for batch in batches:
            done = []
            names, *columns = (batch.column(c) for c in ("conv", "role", "text"))
            for name, role, text in zip(names.to_pylist(), *(c.to_pylist() for c in columns)):
                if name != conv:
                    if conv is not None:
                        done.append({"conv": conv, "repaired_sha256": state.hexdigest()})
                    conv, state = name, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield from _rows(done, schema)
        if conv is not None:
            yield from _rows([{"conv": conv, "repaired_sha256": state.hexdigest()}], schema)

    return repaired.mapInArrow(run, "conv string, repaired_sha256 string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pieces with their faults and costs, edits of the pieces) of conversations given as conv_id, turn, role, text."""
    rows = turns_of(turns)
    chained = staged(_chained(pieces_of(rows)))
    return chained, staged(_chosen(_ranked(chained)))


def repair_report(turns: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` needs conv_id, turn (a whole number), role and text; other columns are ignored.  Rows stand by turn, null turns
    first, rows of the same turn by the digest of role and text (repeated rows thus stand together).  A null role or text
    is one space; null conv_ids form one conversation.  The first fault of a row counts: blank text, role and text seen
    earlier in the conversation, last character that is no end of a sentence.  Roles go by their first character; an empty
    role has none, and is never legal.  ``all_ids`` (conv_id) adds conversations of which no turn is left: zeros, an empty
    audit and the digest of the empty text.  An empty table gives an empty report.
    """
    chained, edits = repair(turns)
    rows = turns_of(turns)
    known = F.col("least_turn").isNotNull()
    last = F.when(known, F.col("last_turn"))
    sums = chained.groupBy("conv").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        F.sum(F.col("illegal") + F.col("joint_illegal")).alias("illegal"),
        (F.max(last) - F.min("least_turn") + 1 - F.sum(F.col("turns") - F.col("joint_turn"))).alias("gaps"),
        F.min_by("total", "chunk").alias("cost"),
    )
    audits = edits.groupBy("conv").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "edits"))), lambda p: p["edits"]), "").alias("audit")
    )
    ids = turns if all_ids is None else all_ids
    ids = ids.select("conv_id").distinct().withColumn("conv", conversation(F.col("conv_id")))
    found = ids.join(sums, "conv", "left").join(audits, "conv", "left").join(_digests(repaired_turns(rows, edits)), "conv", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults put in by crc32(``conv_id:turn``) % 20: 0 drops a row, 1 empties its text, 2 takes its
    sentence ends away, 3 repeats it, 4 makes it the user's.  Nulls are one space here."""
    space = F.lit(" ")
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), space) if c else F.lit(":") for c in ("conv_id", "", "turn")))
    kind = F.crc32(name) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), space) for c in ("text", "role"))
    return (
        turns.withColumn("_kind", kind)
        .where("_kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, F.lit(USER)).otherwise(role).alias("role"),
            F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate(text, "".join(ENDS), "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
        )
        .drop("_copy")
    )
