"""Conversation repair, page differencing and hard negatives against brute force."""

import hashlib
import itertools
import random
import zlib
from functools import cache

import numpy as np
import pytest

from turbilux.llm import dialogue_repair as R
from turbilux.llm import hard_negatives as H
from turbilux.llm import page_differences as P
from turbilux.llm.page_lines import lines_of, place_of

BLANK = " \t\n\x0b\x0c\r"


# --- conversation repair -------------------------------------------------------------


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANK)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """(cost, audit) by trying every edit at every turn, least audit among the cheapest."""
    faults = faults_of(rows)
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    @cache
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in (0, 3):
            found.append((0, ""))
        if inserted < 2:
            for c in "ua":
                if (state, c) in step:
                    cost, audit = best(i, step[state, c], inserted + 1)
                    found.append((cost + 5, "I" + audit))
        if i < len(rows):
            cost, audit = best(i + 1, state, 0)
            found.append((cost + 2, "D" + audit))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if (state, rows[i][1][:1]) in step:
                    cost, audit = best(i + 1, step[state, rows[i][1][:1]], 0)
                    found.append((cost + more, "K" + audit))
                for c in "ua":
                    if (state, c) in step:
                        cost, audit = best(i + 1, step[state, c], 0)
                        found.append((cost + more + 1, "R" + audit))
        return min(found, default=(10**9, ""))

    return best(0, 0, 0)


def report(rows):
    """What repair_report gives for one conversation's (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    digest = lambda r, x: hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()
    rows.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest(t[1], t[2])))
    faults = faults_of(rows)
    cost, audit = cheapest(tuple(rows))
    initials = [r[:1] for _, r, _ in rows]
    lines, left, after = [], iter(rows), ""
    for edit in audit:
        wanted = "assistant" if after == "u" else "user"
        if edit == "I":
            lines.append(f"{wanted}:")
        else:
            _, role, text = next(left)
            if edit == "D":
                continue
            lines.append(f"{role if edit == 'K' else wanted}:{text}")
        after = lines[-1][0]
    known = [t for t, _, _ in rows if t is not None]
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def found_by(df):
    return {r.conv_id: tuple(r[f] for f in FIELDS) for r in df.collect()}


def by_hand(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        out[conv] = report([r[1:] for r in rows if r[0] == conv])
    return out


def random_turns(rng, conv, n, roles=("user", "assistant", "system", "tool", "", None)):
    texts = ["Yes.", "No", "Why?", "", " \n", None, "a!", "b", "c.", "d. ", "e?\n", "é"]
    return [
        (conv, rng.choice([None, i, i, i, i // 2, i + 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"w{i}.")
        for i in range(n)
    ]


@pytest.mark.parametrize("piece", [3, 256])
def test_repair_matches_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(R, "PIECE_TURNS", piece)
    rng = random.Random(piece)
    rows = [t for conv in range(120) for t in random_turns(rng, conv, rng.randrange(1, 12))]
    rows += random_turns(rng, None, 9)
    # the usual roles, mostly in order
    for conv in range(200, 230):
        rows += random_turns(rng, conv, rng.randrange(1, 40), roles=("user", "assistant", "system"))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found_by(R.repair_report(df)) == by_hand(rows)


def test_paths_of_all_short_dialogues():
    """Every sequence of up to five codes, from and to every state."""
    kinds = (1, 2, 3, 0, 1 | 8, 2 | 8, 3 | 4)
    rows = {1: ("system", "x."), 2: ("user", "x."), 3: ("assistant", "x."), 0: ("tool", "x."), 9: ("system", "x"), 10: ("user", "x"), 7: ("assistant", "")}
    for n in (1, 2, 3):
        codes = list(itertools.product(kinds, repeat=n))
        table, lengths = np.array(codes), np.full(len(codes), n)
        ends = np.tile(np.array(R.LAST_COST), (len(codes), 1))
        paths = R.least_paths(table, lengths, ends)
        costs = R._costs(table, lengths, ends)[:, 0, 0]
        cost4 = (R.transfer(table, lengths) + ends[:, None, :]).min(axis=2)[:, 0]
        assert (costs == cost4).all()
        for code, path, cost in zip(codes, paths, costs):
            said = [(i, rows[c][0], f"{i}{rows[c][1]}" if rows[c][1] else "") for i, c in enumerate(code)]
            audit, state = path[0]
            assert (cost, audit + R.LAST_EDITS[state]) == cheapest(tuple(said))


def test_repair_of_odd_tables(spark):
    long = "word " * 200_000 + "end."
    rows = [(1, None, None, None), (1, None, None, None), (2, 0, "user", long), (2, 0, "user", long), (2, 1, "assistant", long)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "chunk", "position", "said", "text_", "mark", "place", "_copy", "_kind"):
        df = df.withColumn(name, df.role)
    assert found_by(R.repair_report(df)) == by_hand(rows)
    assert R.repair_report(df.where("false")).count() == 0
    ids = spark.createDataFrame([(1,), (9,), (None,)], "conv_id long")
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = found_by(R.repair_report(df, ids))
    assert found[9] == none and found[None] == none and found[1] == by_hand(rows)[1]
    # only equal rows, more than a piece holds
    many = [(5, 1, "user", "Hm.")] * 700
    found = found_by(R.repair_report(spark.createDataFrame(many, SCHEMA)))
    assert found[5][2] == 699 and found[5][6] in ("K" + "D" * 699 + "I", "D" * 700)


def test_damage(spark):
    rows = [(c, t, r, "One. Two? No!") for c in range(40) for t, r in enumerate(("system", "user", "assistant"))]
    rows += [(None, 3, "assistant", "x."), (3, None, None, None)]
    got = sorted(map(repr, map(tuple, R.damaged(spark.createDataFrame(rows, SCHEMA)).collect())))
    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", " " if text is None else text
        row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else "One Two No" if kind == 2 and len(text) > 2 else text)
        want += [repr(row)] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(want)


# --- pages ---------------------------------------------------------------------------


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("bits", [1 << 28, 40])
def test_alignment_is_longest(monkeypatch, bits):
    monkeypatch.setattr(P, "TABLE_BITS", bits)
    rng = random.Random(bits)
    for _ in range(400):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(0, 25))] for _ in range(2))
        pairs = P.common_lines(a, b)
        assert len(pairs) == lcs_length(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></ul></nav><div id="cookie-notice">We use cookies</div><div class="content-with-sidebar"><article>
<header><h2>Title &amp; more</h2></header><p>One <b>bold</b>&nbsp;word<br>and a line<p>Two &lt;3 &#233;&eacute; 1 < 2<script>var t="</p><p>no";</script>
<aside>Aside</aside><ul><li>x<li>y</ul><table><tr><td>a<td>b</table><div class="share">Share</div></article></div>
<section class="comments"><article>Nice!</article></section><form>Search <input></form><footer>&copy; me</footer></body></html>"""


def text_of(page, shared=()):
    return "\n".join(P.main_lines(lines_of(page), list(shared)))


def test_lines_of_markup():
    assert text_of(PAGE) == "Title & more\nOne bold word and a line\nTwo <3 éé 1 < 2\nx\ny\na b"
    assert text_of("") == "" and text_of("plain  text") == "plain text"
    assert text_of("<p>a<!-- <p>b --><p>c<scr") == "a\nc"
    assert text_of("<div>a<span>b</div>c</p>d") == "ab\nc\nd"
    assert text_of('<main><div role="navigation">x</div>y<svg><text>z</text></svg></main>w') == "y"
    assert text_of("<script>a</scr") == "" and text_of("<p hidden>a</p><p style='display: none'>b</p>c") == "c"
    assert text_of("<div class=ad>x<p>y</div><div class='loading head-line'>z</div>") == "z"
    assert place_of("HTTP://A.b:80/c/d/?q#f") == ("a.b", "/c/d") and place_of(None) == ("", "") and place_of("http://[x")[0] == ""


def test_neighbours_share_a_template(spark):
    def page(body, mark="div"):
        return f"<div>Our site</div><{mark}>{body}</{mark}><div>Read more</div><div>All rights kept</div>"

    rows = [
        (1, "http://h/a/1", page("<p>first words of one page here</p>")),
        (2, "http://h/a/2", page("<p>second page has other long words</p>")),
        # a copy of the first, elsewhere on the host: it tells nothing
        (3, "http://h/a/11", page("<p>first words of one page here</p>")),
        (4, "http://other/a/1", page("<p>alone on its host</p>")),
        (5, "http://h/z", page("<p>first words of one page here</p><p>and more</p>", "article")),
        (6, None, None),
        (None, "http://h/b", ""),
        (2, "http://h/a/2", page("<p>second page has other long words</p>")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for name in ("page", "host", "path", "lines", "places", "text", "chunk", "position"):
        pages = pages.withColumn(name, pages.url)
    got = [(r.page_id, r.text, r.n_chars) for r in P.extract_text(pages).collect()]
    one, two = "first words of one page here", "second page has other long words"
    want = [(1, one), (2, two), (2, two), (3, one), (5, one + "\nand more"), (6, ""), (None, "")]
    want.append((4, "Our site\nalone on its host\nRead more\nAll rights kept"))
    assert sorted(got, key=repr) == sorted([(i, t, len(t)) for i, t in want], key=repr)
    assert P.extract_text(pages.where("false")).count() == 0


def test_extraction_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK_PAGES", 4)
    rng = random.Random(3)
    lines = [f"<p>line number {i} {'x' * (i % 7)}</p>" for i in range(30)]
    rows = []
    for i in range(90):
        own = "".join(f"<p>own {i} {k} {'word ' * 9}</p>" for k in range(rng.randrange(0, 5)))
        body = "".join(rng.sample(lines, rng.randrange(0, 6)))
        rows.append((i, f"https://h{rng.randrange(3)}.org/{rng.randrange(9)}/{rng.randrange(50)}", f"{body}{own}{rng.choice(lines)}"))
    got = {r.page_id: r.text for r in P.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}

    def name(url, page):
        return P._name(place_of(url)[0], [P._line_hash(x) for x in lines_of(page)])

    one = {}
    for _, url, page in sorted(rows, key=lambda r: place_of(r[1]), reverse=True):
        one[name(url, page)] = (*place_of(url), name(url, page), [x.text for x in lines_of(page)])
    order = sorted(one.values())
    gone = {n: set() for n in one}
    for a, b in zip(order, order[1:]):
        if a[0] == b[0]:
            pairs = P.common_lines(a[3], b[3])
            held = sum(len(a[3][i]) for i, _ in pairs)
            if held <= P.MOST_SHARED * min(sum(map(len, a[3])), sum(map(len, b[3]))):
                gone[a[2]] |= {i for i, _ in pairs}
                gone[b[2]] |= {j for _, j in pairs}
    for i, url, page in rows:
        kept = [x.text for k, x in enumerate(lines_of(page)) if k not in gone[name(url, page)]]
        assert got[i] == "\n".join(kept)


# --- hard negatives ------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (64, 64, 64), (33, 65, 47), (0, 4, 5), (70, 9, 130)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(1)
    n, m, k = shape
    a, b = rng.integers(-(2**29), 2**29, (n, m)), rng.integers(-(2**29), 2**29, (m, k))
    for split in (1, 2, 8, 32):
        assert (H.strassen(a, b, split) == a @ b).all()


def mined_by_hand(rows, every, positives, negatives):
    ok = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            row = (label, [int(np.floor(256 * x)) for x in v])
            ok[i] = min(ok.get(i, row), row)
    out = set()
    for a, (label, v) in ok.items():
        if a % every:
            continue
        score = {b: sum(x * y for x, y in zip(v, w)) for b, (_, w) in ok.items() if b != a}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if ok[b][0] == label][:positives]:
            fits = [b for b in order if ok[b][0] != label and 30 * score[p] <= 100 * score[b] <= 90 * score[p]]
            out |= {(a, p, r, b, score[p], score[b]) for r, b in enumerate(fits[:negatives], 1)}
    return out


@pytest.mark.parametrize("block,tile", [(8192, 4096), (3, 16)])
def test_mining_matches_brute_force(spark, monkeypatch, block, tile):
    monkeypatch.setattr(H, "TILE", tile)
    monkeypatch.setattr(H, "ANCHOR_TILE", 2)
    rng = random.Random(tile)
    rows = [(i, rng.randrange(3), [rng.choice([-0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(rng.choice([4, 4, 6]))]) for i in range(300)]
    rows += [(400, 1, None), (401, None, [1.0]), (None, 1, [1.0]), (402, 1, [float("nan")]), (403, 1, [None, 1.0]), (404, 1, [float("inf")])]
    rows += [(405, 2, []), (7, 2, [9.0]), rows[10], rows[20], (500, 77, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    for name in ("slot", "score", "id", "vector", "position", "row"):
        df = df.withColumn(name, df.label)
    got = [tuple(r) for r in H.mine(df, anchor_every=20, anchor_block=block).collect()]
    assert len(got) == len(set(got)) and set(got) == mined_by_hand(rows, 20, 5, 10)
    assert H.mine(df.where("false")).count() == 0 and H.mine(df.where("vec_id % 20 = 1"), 20).count() == 0


def test_too_large_components_fail(spark):
    with pytest.raises(ValueError):
        H.mine(spark.createDataFrame([(0, 1, [1e9])], "vec_id long, label int, embedding array<double>"))
