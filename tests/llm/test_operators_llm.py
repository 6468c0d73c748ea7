"""Each operator against a brute-force version, and over odd rows."""

import hashlib
import random
import re
import textwrap
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from turbilux.llm import (
    components,
    cross_parsing,
    exact_dedup,
    length_buckets,
    license_digests,
    order_minhash,
    perspectives,
    phrase_index,
    substring_dedup,
    token_codes,
    toxic_segments,
)

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# --- 8 -------------------------------------------------------------------------------


def test_any_cut_gives_the_same_fingerprint():
    poly = exact_dedup.Polynomial()
    data = np.frombuffer(bytes(random.Random(1).randbytes(5000)), np.uint8)
    whole = poly.chunk(data)
    for cut in (0, 1, 17, 4999, 5000):
        assert poly.combine(poly.chunk(data[:cut]), poly.chunk(data[cut:])) == whole
    a, b, c = (poly.chunk(data[i : i + 700]) for i in (0, 700, 1400))
    assert poly.combine(poly.combine(a, b), c) == poly.combine(a, poly.combine(b, c))
    assert poly.chunk(np.zeros(3, np.uint8))[0] != poly.chunk(np.zeros(4, np.uint8))[0]


def _exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        groups[hashlib.sha256(low.encode()).hexdigest()].append(doc_id)
    out = []
    for sha, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return Counter(out)


@pytest.mark.parametrize("poly", [None, exact_dedup.Polynomial((5, 3), (2, 2))])
def test_exact_groups(odd_docs, no_docs, poly):
    got = exact_dedup.exact_groups(odd_docs, poly).drop("row_hash").collect()
    assert Counter(map(tuple, got)) == _exact([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert exact_dedup.exact_groups(no_docs).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.2, 1.0])
def test_exact_groups_with_hot_ones(spark, monkeypatch, share):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
    rows = [(None if i % 50 == 0 else i // 2, "Copied" if i % 3 else f"text {i % 40}") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = exact_dedup.exact_groups(table).drop("row_hash").collect()
    assert Counter(map(tuple, got)) == _exact(rows)


def test_drop_copies_keeps_columns(odd_docs):
    kept = exact_dedup.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    # the repeated rows of document 3 stay together
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 3, 5, 6, 8, 9, 10]


# --- 4 -------------------------------------------------------------------------------

PATH = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_codes_round_trip():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 2**b, 3000) for b in (1, 8, 9, 16, 17, 31)]).astype(np.uint32)
    rng.shuffle(ids)
    segment = token_codes.Segment(token_codes.encode_segment(ids, [4, None, 4], np.array([10, 10, len(ids)])))
    assert segment.doc_ids == [4, None, 4]
    for i in rng.integers(0, len(ids), 300).tolist():
        assert segment.token(i) == ids[i]
    for a, b in rng.integers(0, len(ids), (50, 2)).tolist():
        assert segment.tokens(min(a, b), max(a, b)).tolist() == ids[min(a, b) : max(a, b)].tolist()
    with pytest.raises(IndexError):
        segment.token(len(ids))
    empty = token_codes.Segment(token_codes.encode_segment(np.zeros(0, np.uint32), [], np.zeros(0)))
    assert empty.tokens(0, 0).tolist() == []


def test_encoder_equals_the_library():
    encoder = token_codes.Encoder(PATH, max_pieces=50)
    rng = random.Random(5)
    marks = ["a", "É", "ñ", "ß", "×", "1", " ", "  ", "\n", "\t", " ", " ", "\x1c", ".", ",", "'s", "'", "日", "!"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(0, 40))) for _ in range(400)] + ["it's<|endoftext|> x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    ids, counts = encoder.encode(data, offsets)
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_added_tokens_equal_a_fresh_tokenizer():
    from tokenizers import Tokenizer

    fresh, encoder, rng = Tokenizer.from_file(PATH), token_codes.Encoder(PATH), random.Random(6)
    marks = ["<|endoftext|>", "<|endof", "text|>", "<|", "a", "É", " ", "\n", "'s", "日", "|"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(0, 12))) for _ in range(300)] + ["end <|endoftext|>", "x<|endof", "text|> y"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    ids, counts = encoder.encode(data, offsets)
    want = [e.ids for e in fresh.encode_batch(texts, add_special_tokens=False)]
    assert any(50256 in w for w in want)
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("name", ["odd_docs", "docs", "no_docs"])
def test_written_codes(request, spark, tmp_path, name):
    table = request.getfixturevalue(name)
    token_codes.write_codes(table, f"{tmp_path}/codes", PATH, 2)
    got = token_codes.read_documents(token_codes.segments(spark, f"{tmp_path}/codes")).orderBy("start").collect()
    rows = sorted(table.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    tokenizer, start = token_codes.Encoder(PATH).tokenizer, 0
    assert len(got) == len(rows)
    for r, row in zip(got, rows):
        ids = np.array([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 2], "<u4")
        assert tuple(r) == (row[0], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("name", ["odd_docs", "docs", "no_docs"])
def test_tokens_by_corpus_position(request, spark, tmp_path, monkeypatch, name):
    table = request.getfixturevalue(name)
    token_codes.write_codes(table, f"{tmp_path}/codes", PATH, 2)
    stored = token_codes.segments(spark, f"{tmp_path}/codes")
    texts = sorted(table.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    tokenizer, ids = token_codes.Encoder(PATH).tokenizer, []
    for r in texts:
        ids += [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]
    rng = random.Random(11)
    asked = [rng.randrange(len(ids)) for _ in range(300)] + [0, len(ids) - 1] if ids else []
    asked += [None, -1, len(ids), len(ids) + 10**9]
    positions = spark.createDataFrame([(i, "c") for i in asked + asked[:3]], "position long, token string")
    got = {r.position: r.token for r in token_codes.read_tokens(stored, positions).collect()}
    assert got == {i: ids[i] if i is not None and 0 <= i < len(ids) else None for i in asked}


def test_token_counts_and_packing(odd_docs, no_docs):
    tokenizer = token_codes.Encoder(PATH).tokenizer
    want = Counter((r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in odd_docs.collect())
    assert Counter(map(tuple, token_codes.token_counts(odd_docs, PATH).collect())) == want
    pieces = length_buckets.pack_tokens(odd_docs, PATH, buckets=3, budget=2_000, max_length=700).collect()
    cut = Counter((i, s, min(700, n - s)) for i, n in want.elements() for s in range(0, max(n, 1), 700))
    assert Counter((r.doc_id, r.start, r.length) for r in pieces) == cut
    assert length_buckets.pack_tokens(no_docs, PATH).count() == 0


# --- 10 ------------------------------------------------------------------------------


def _repeated(rows, size):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first: dict = {}
    for i, w in words:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, 2**63 - 1), 2**63 - 1 if i is None else i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < (2**63 - 1 if i is None else i):
                gone[k : k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return Counter(out)


@pytest.mark.parametrize("name", ["odd_docs", "docs", "no_docs"])
@pytest.mark.parametrize("size", [13, 3])
def test_repeated_passages(request, name, size):
    table = request.getfixturevalue(name)
    got = substring_dedup.remove_repeated(table, size, True, bundle_bytes=20_000, slice_words=5_000).collect()
    assert Counter(map(tuple, got)) == _repeated([(r.doc_id, r.text) for r in table.collect()], size)


# --- 6 -------------------------------------------------------------------------------


def _hits(rows, items, size):
    def words(t):
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k : k + size])].add(i)
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])] - {None}
        listed = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return Counter(out)


def test_contamination(spark, odd_docs, no_docs):
    items = [(1, "quick brown FOX"), (2, "watch"), (2, "watch"), (3, None), (4, ""), (None, "lazy"), (5, "Übung 12"), (6, "the old fence gate")]
    table = spark.createDataFrame([(*i, "c") for i in items], "item_id long, text string, win string")
    got = phrase_index.contamination(odd_docs, table, 3).drop("row_key").collect()
    assert Counter(map(tuple, got)) == _hits([(r.doc_id, r.text) for r in odd_docs.collect()], items, 3)
    assert phrase_index.contamination(no_docs, table).count() == 0
    assert {r.n_hit for r in phrase_index.contamination(odd_docs, table.where("false")).collect()} == {0}
    kept = phrase_index.drop_contaminated(odd_docs, table, 3)
    assert kept.columns == odd_docs.columns and 1 not in {r.doc_id for r in kept.collect()}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a x x x x x b"), (3, "b a"), (4, None)], "doc_id long, text string")
    queries = spark.createDataFrame([(7, "a b"), (8, "e")], "query_id long, text string")
    got = phrase_index.proximity_matches(docs, queries, 2).collect()
    assert {(r.doc_id, r.query_id) for r in got} == {(1, 7), (3, 7), (1, 8)}


# --- 9 -------------------------------------------------------------------------------


def _least_padding(lengths, counts, buckets):
    best = None

    def walk(at, left, cost):
        nonlocal best
        if at == len(lengths):
            best = cost if best is None else min(best, cost)
            return
        for end in range(at, len(lengths)) if left else ():
            walk(end + 1, left - 1, cost + sum(c * (lengths[end] - n) for n, c in zip(lengths[at : end + 1], counts[at : end + 1])))

    walk(0, buckets, 0)
    return best


def test_best_bounds():
    rng = random.Random(7)
    for _ in range(40):
        lengths = sorted(rng.sample(range(60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 20) for _ in lengths]
        bounds = length_buckets.best_bounds(lengths, counts, 3)
        assert len(bounds) <= 3 and bounds[-1] == lengths[-1]
        cost = sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))
        assert cost == _least_padding(lengths, counts, 3)
    assert length_buckets.best_bounds([], [], 3) == []


def test_pack(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(length_buckets, "PIECES_PER_SHARD", 5)
    got = length_buckets.pack(odd_docs, buckets=3, budget=2_000, max_length=700).collect()
    want = Counter()
    for r in odd_docs.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        want.update((r.doc_id, s, min(700, n - s)) for s in range(0, max(n, 1), 700))
    assert Counter((r.doc_id, r.start, r.length) for r in got) == want
    batches = defaultdict(list)
    for r in got:
        assert r.length + r.padding == r.bucket
        batches[r.bucket, r.batch].append(r.slot)
    last = {b: max(k for c, k in batches if c == b) for b, _ in batches}
    for (bucket, batch), slots in batches.items():
        room = max(1, 2_000 // max(bucket, 1))
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= room
        assert len(slots) == room or batch == last[bucket]
    assert length_buckets.pack(no_docs).count() == 0


# --- 7 -------------------------------------------------------------------------------


def test_maximal_segments():
    """Against the definition: split at the best segment, go on left and right of it."""

    def define(scores, at):
        best = None
        for i in range(len(scores)):
            for j in range(i, len(scores)):
                s = sum(scores[i : j + 1])
                if s > 0 and (best is None or (s, i - j) > best[0]):
                    best = ((s, i - j), i, j)
        if best is None:
            return []
        (s, _), i, j = best
        return [*define(scores[:i], at), (at + i, at + j, s), *define(scores[j + 1 :], at + j + 1)]

    rng = random.Random(11)
    for _ in range(300):
        scores = [rng.randrange(-50, 40) + rng.random() for _ in range(rng.randrange(0, 14))]
        got = toxic_segments.maximal_segments(np.array(scores))
        want = define(scores, 0)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_maximal_segments_take_linear_time():
    # each search passes all segments before it: they begin higher and higher, and none can be joined
    n = 500_000
    falling = np.tile([1.0, -2.0], n)
    began = time.perf_counter()
    assert len(toxic_segments.maximal_segments(falling)) == n
    rising = np.tile([-1.0, 2.0], n)
    assert len(toxic_segments.maximal_segments(rising)) == 1
    assert time.perf_counter() - began < 30


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    marks = labels.where("crc32(cast(doc_id as string)) % 4 <> 2").selectExpr("doc_id", "toxic as label")
    model = toxic_segments.fit(docs, marks)
    rows = toxic_segments.toxicity(docs, model).join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 4 = 2").collect()
    bad = [r.score for r in rows if r.toxic == 1]
    good = [r.score for r in rows if r.toxic == 0]
    assert np.mean([b > g for b in bad for g in good]) > 0.8
    passages = toxic_segments.toxic_passages(docs, model).collect()
    assert passages and all(p.first_word <= p.last_word and p.expected <= 0.05 for p in passages)


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    marks = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (5, None), (None, 1)], "doc_id long, label int")
    model = toxic_segments.fit(odd_docs, marks)
    rows = toxic_segments.toxicity(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    unlabelled = toxic_segments.fit(no_docs, marks.where("false"))
    assert {r.score for r in toxic_segments.toxicity(odd_docs, unlabelled).collect()} == {0.5}
    assert toxic_segments.toxicity(no_docs, model).count() == 0
    assert toxic_segments.drop_toxic(odd_docs, model, 2.0).columns == odd_docs.columns


# --- 3 -------------------------------------------------------------------------------


def test_cross_parsing_equals_longest_matches():
    rng = random.Random(2)
    training = "".join(rng.choices("ab ", k=300))
    parser = cross_parsing.Parser((("x", training), ("y", "zz")))
    known = " " + training
    text = re.sub(" +", " ", "".join(rng.choices("abz ", k=200)))
    source, phrases, at = re.sub(" +", " ", known), 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in source:
            end += 1
        phrases, at = phrases + 1, end
    bits, letters = parser.entropies([text])
    assert letters.all()
    assert bits[0, 0] == pytest.approx(phrases * np.log2(len(source)) / len(text))


def test_long_texts_are_parsed_without_cuts():
    rng = random.Random(6)
    training = "".join(rng.choices("abcdefgh ", k=4000)).strip()
    parser = cross_parsing.Parser((("x", training), ("y", "zz")))
    source = re.sub(" +", " ", " " + training)
    copied = source[100:3900].strip()
    texts = [copied, "".join(rng.choices("abcdefghz", k=5000)), copied + "z" + copied, "ab", ""]
    bits, _ = parser.entropies(texts)
    for text, found in zip(texts, bits[:, 0]):
        phrases, at = 0, 0
        while at < len(text):
            end = at + 1
            while end < len(text) and text[at : end + 1] in source:
                end += 1
            phrases, at = phrases + 1, end
        assert found * max(len(text), 1) == pytest.approx(phrases * np.log2(len(source)))


def test_sample_of_copies_and_headings(spark):
    heading = "the same long heading of every page " * 20
    rows = [("en", "one text that has many copies")] * 50
    rows += [("en", heading + f"own words of page number {i} " * 40) for i in range(30)]
    sample = cross_parsing.training_sample(spark.createDataFrame(rows, "lang string, text string"), docs=31, chars=200)
    assert len(sample) == len(set(sample)) == 31
    assert any("own words" in t for _, t in sample)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sample = cross_parsing.training_sample(docs.where("crc32(cast(doc_id as string)) % 5 <> 0"))
    found = cross_parsing.predict_language(docs, sample).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.where("crc32(cast(doc_id as string)) % 5 = 0").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    sample = cross_parsing.training_sample(spark.createDataFrame([("en", "the dog"), ("fr", "le chien"), ("de", None), (None, "x")], "lang string, text string"))
    rows = {r.doc_id: r for r in cross_parsing.predict_language(odd_docs, sample).collect()}
    assert {rows[i].lang_pred for i in (4, 5, 6)} == {"und"} and rows[4].score == 0
    assert {r.lang_pred for r in cross_parsing.predict_language(odd_docs, []).collect()} == {"und"}
    assert cross_parsing.predict_language(no_docs, sample).count() == 0


# --- 1 -------------------------------------------------------------------------------


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def test_banded_distance():
    rng = random.Random(1)
    for _ in range(400):
        a = [rng.randrange(5) for _ in range(rng.randrange(0, 25))]
        b = [x if rng.random() < 0.8 else rng.randrange(5) for x in a if rng.random() < 0.9]
        d = _distance(a, b)
        for limit in range(8):
            assert order_minhash.edit_distance_within(a, b, limit) == (d if d <= limit else None)


def _classes(rows):
    words = [(t or "").lower().split() for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = words[i], words[j]
            close = a and b and abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b)) and (
                a == b or len(a) < 3000 and _distance(a, b) <= 0.2 * max(len(a), len(b))
            )
            if rows[i][1] == rows[j][1] or close:
                parent[find(i)] = find(j)
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        known = [x for x in ids if x is not None]
        out[doc_id, min(known) if known else None, len(ids)] += 1
    return out


def test_near_groups_of_odd_rows(odd_docs, no_docs):
    got = order_minhash.near_groups(odd_docs).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == _classes([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert order_minhash.near_groups(no_docs).count() == 0
    assert order_minhash.drop_near_copies(odd_docs).columns == odd_docs.columns


def test_near_copies_with_few_edits(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    base = rng.choices(vocabulary, k=200)
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        edited = [w if rng.random() > 0.06 else rng.choice(vocabulary) for w in base]
        rows.append((i, " ".join(edited)))
    rows += [(i, " ".join(rng.choices(vocabulary, k=150))) for i in range(60, 80)]
    got = order_minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got if r.doc_id < 60} == {0}
    assert all(r.kept and r.class_size == 1 for r in got if r.doc_id >= 60)


def _one_bucket(texts):
    """Do all texts share their only sketch?"""
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    return len(set(order_minhash.order_sketches(order_minhash._lowered_words(batch), 5, 1)[1][:, 0].tolist())) == 1


def _edited(words, places, mark):
    return [f"{mark}{i}" if i in places else w for i, w in enumerate(words)]


@pytest.mark.parametrize("tile", [order_minhash.TILE, 3])
def test_five_clusters_in_one_bucket(spark, tile):
    for seed in range(1000):
        passage = [f"p{seed}x{i}" for i in range(60)]
        clusters = [[f"c{seed}x{k}x{i}" for i in range(40)] for k in range(5)]
        texts = [" ".join(passage + _edited(c, {n}, "e")) for c in clusters for n in (3, 20, 37)]
        if _one_bucket(texts):
            break
    else:
        raise AssertionError("no seed puts the texts into one bucket")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = order_minhash.near_groups(docs, sketches=1, tile=tile).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == {i: (i - i % 3, 3) for i in range(15)}


def test_chains_in_one_bucket(spark):
    rows, seed = [], 0
    while len(rows) < 36:
        base = [f"b{seed}x{i}" for i in range(100)]
        # ends 30 edits apart, both 15 from the middle
        chain = [base, _edited(base, set(range(15)), "e"), _edited(base, set(range(30)), "e")]
        texts = [" ".join(c) for c in chain]
        if _one_bucket(texts):
            rows += [(len(rows) + i, t) for i, t in enumerate(texts)]
        seed += 1
    got = order_minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), sketches=1).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == {i: (i - i % 3, 3) for i in range(36)}


@pytest.mark.parametrize("tile", [order_minhash.TILE, 4])
def test_all_pairs_of_buckets_count(spark, tile):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(25)]
    rows = []
    for k in range(12):
        text = passage + [f"c{k}x{i}" for i in range(25)]
        for _ in range(6):
            text = [w if rng.random() > 0.1 else f"n{rng.randrange(10**6)}" for w in text]
            rows.append((len(rows), " ".join(text)))
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows])], ["text"])
    sketches = order_minhash.order_sketches(order_minhash._lowered_words(batch), 5, 4)[1]
    parent = list(range(len(rows)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1].split(), rows[j][1].split()
            if (sketches[i] == sketches[j]).any() and _distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = order_minhash.near_groups(docs, sketches=4, tile=tile).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: find(i) for i in range(len(rows))}


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (None, 3)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert Counter((r.node, r.component) for r in got) == Counter([(i, 0) for i in range(41)] + [(i, 100) for i in (100, 101, 102)])


# --- 5 -------------------------------------------------------------------------------


def test_licenses(spark, odd_docs, no_docs):
    mit = next(t for i, t in license_digests.KNOWN_TEXTS if i == "MIT")
    docs = spark.createDataFrame(
        [
            (1, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ;")),
            (2, "Some words.\nreleased under the MIT licence\nLicensed under the Apache License, v2.0\nReleased under the MIT License."),
            (3, mit + " and more"),
        ],
        "doc_id long, text string",
    )
    rows = {r.doc_id: r for r in license_digests.scan_licenses(docs).collect()}
    assert rows[1].license_id == "MIT"
    assert (rows[2].license_id, rows[2].line_licenses, rows[2].n_license_lines) == (None, "Apache-2.0,MIT", 3)
    assert (rows[3].license_id, rows[3].n_license_lines) == (None, 0)
    assert license_digests.scan_licenses(odd_docs).count() == odd_docs.count()
    assert license_digests.scan_licenses(no_docs).count() == 0


def test_wrapped_licenses(spark):
    """Every short text at usual widths, with a holder line before it, and a text whose terms begin lines with "copyright"."""
    known = dict(reversed(license_digests.full_texts()))
    bodies = {i: known[i] for i in ("MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0")}
    rows = []
    for name, body in bodies.items():
        for width in range(60, 101, 4):
            paragraphs = re.split(r"\n\s*\n", body)
            holder = re.compile(r"(?mi)^\s*(copyright\b.*[12][0-9]{3}|all rights reserved)")
            wrapped = "\n\n".join(p if holder.search(p) else textwrap.fill(" ".join(p.split()), width, break_on_hyphens=False) for p in paragraphs)
            rows.append((name, "Copyright (c) 2019 A. Holder\n\n" + wrapped))
    rows.append(("ISC", "ISC License\n\nCopyright 2004 Somebody\n\n" + textwrap.fill(bodies["ISC"].split("\n\n")[0], 76).replace(
        "above copyright", "above\ncopyright") + "\n\n" + bodies["ISC"].split("\n\n")[1]))
    got = license_digests.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert [(r.doc_id, r.license_id) for r in got if r.doc_id != r.license_id] == []


def test_whole_license_files(spark):
    known = dict(reversed(license_digests.full_texts()))
    body = {i: t for i, t in license_digests.KNOWN_TEXTS if "\n" in t}
    holder = "Copyright (c) 2020 Somebody\n\n"
    bsd = (license_digests.FOLDER / "BSD-3-Clause.txt").read_text()
    apache = (license_digests.FOLDER / "Apache-2.0.txt").read_text()
    rows = [(p.stem, p.read_text()) for p in license_digests.FOLDER.glob("*.txt")]
    rows += [
        ("MIT", "MIT License\n\n" + holder + body["MIT"]),
        ("MIT", "The MIT License (MIT)\n\n# Copyright 2019 Somebody\n" + body["MIT"]),
        ("ISC", "ISC License\n\n * Copyright 2019 Somebody\n" + body["ISC"]),
        ("BSD-3-Clause", "BSD 3-Clause License\n\n" + holder + "All rights reserved.\n\n" + bsd),
        ("Apache-2.0", apache[: apache.index("   APPENDIX")]),
        (None, "MIT License\n\n" + body["MIT"] + "\nand more"),
    ]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in license_digests.scan_licenses(docs).collect()}
    assert [got[i] for i in range(len(rows))] == [i for i, _ in rows]
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"} <= set(known)


# --- 2 -------------------------------------------------------------------------------


def test_perspectives(spark):
    said = [(1, 0, "ann", "hi"), (1, 1, "bob", "yo"), (1, 2, "ann", None), (1, 300, None, "late"), (2, None, "ann", ""), (None, 1, "x", "y")]
    turns = spark.createDataFrame([(*s, "c") for s in said], "conv_id long, turn long, role string, text string, piece string")
    got = perspectives.rotate(turns).orderBy("conv_id", "speaker", "piece").collect()
    assert {(r.conv_id, r.speaker) for r in got} == {(1, "ann"), (1, "bob"), (1, "unknown"), (2, "ann")}
    for speaker in ("ann", "bob", "unknown"):
        pieces = [r for r in got if (r.conv_id, r.speaker) == (1, speaker)]
        whole = "".join(p.text for p in pieces)
        spans = [tuple(map(int, s.split("-"))) for p in pieces for s in p.mask.split(",") if s]
        own = [(x or "") + "<|end|>" for c, _, r, x in said if c == 1 and (r or "unknown") == speaker]
        assert [whole[a:b] for a, b in spans] == own
        assert sum(p.n_trained for p in pieces) == sum(map(len, own))
        assert whole.count("<|assistant|>") == len(own)
    assert perspectives.rotate(turns.where("false")).count() == 0
