"""Registered queries of the operators in this package, with SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turbilux.llm import (
    cross_parsing,
    dialogue_repair,
    exact_dedup,
    hard_negatives,
    length_buckets,
    license_digests,
    order_minhash,
    page_differences,
    perspectives,
    phrase_index,
    substring_dedup,
    token_codes,
    toxic_segments,
)
from turbilux.llm.shipping import ship_package
from turbilux.llm.storage import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- 4: token ids as directly addressable codes --------------------------------------


@query("op4_addressable_codes")
def _op4(spark, sf):
    import public_tokenizers

    folder = shared_folder(spark)
    token_codes.write_codes(
        _table(spark, sf, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2
    )
    return token_codes.read_documents(token_codes.segments(spark, folder))


# --- 8: exact duplicates -------------------------------------------------------------


@query(
    "op8_polynomial_dedup",
    """with n as (
         select doc_id,
                sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) h
         from documents)
       select doc_id, max(doc_id) over (partition by h) keep_id, count(*) over (partition by h) group_size,
              doc_id = max(doc_id) over (partition by h) kept, h text_sha256
       from n""",
)
def _op8(spark, sf):
    return exact_dedup.exact_groups(_table(spark, sf, "documents")).drop("row_hash")


# --- 10: repeated passages -----------------------------------------------------------


@query(
    "op10_count_min_passages",
    r"""with d as (select row_number() over () i, doc_id,
                      list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
       p as (select i, doc_id, unnest(generate_series(1, len(w) - 12)) s, w from d where len(w) > 12),
       n as (select i, doc_id, s, md5_number(array_to_string(w[s:s + 12], ' ')) h from p),
       f as (select h, min(doc_id) least from n group by h),
       hit as (select distinct i, s + unnest(range(13)) k from n join f using (h)
               where least < doc_id or (doc_id is null and least is not null)),
       t as (select i, unnest(w) x, generate_subscripts(w, 1) k from d),
       k as (select t.i, string_agg(x, ' ' order by k) filter (where hit.i is null) kept, count(hit.i) n_removed
             from t left join hit using (i, k) group by 1)
       select doc_id, cast(len(w) as bigint) n_words, coalesce(n_removed, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256
       from d left join k using (i)""",
)
def _op10(spark, sf):
    return substring_dedup.remove_repeated(_table(spark, sf, "documents"))


# --- 6: benchmark decontamination ----------------------------------------------------

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SQL_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op6_positional_index",
    f"""with d as (select doc_id, {_SQL_WORDS} w from documents),
       b as (select item_id, {_SQL_WORDS} w from benchmark),
       iw as (select distinct item_id, len(win) n, win from (
                select item_id, unnest(case when len(w) > 10 then list_transform(range(len(w) - 9), lambda i: w[i + 1:i + 10])
                                            else [w] end) win from b where len(w) > 0)),
       dw as (select doc_id, n, s, w[s + 1:s + n] win from (
                select doc_id, n, w, unnest(range(len(w) - n + 1)) s from d, (select distinct n from iw) where len(w) >= n)),
       hits as (select doc_id, item_id, s, dw.n from dw join iw on dw.n = iw.n and dw.win = iw.win),
       words as (select doc_id, count(*) n_hit from (select distinct doc_id, s + unnest(range(n)) p from hits) group by 1),
       found as (select doc_id, count(*) n_items, string_agg(i, ',' order by i) l
                 from (select distinct doc_id, cast(item_id as varchar) i from hits) group by 1)
       select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
              sha256(coalesce(l, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
       from d left join words using (doc_id) left join found using (doc_id)""",
)
def _op6(spark, sf):
    return phrase_index.contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark")).drop("row_key")


# --- 9: packing ----------------------------------------------------------------------


@query("op9_length_buckets")
def _op9(spark, sf):
    import public_tokenizers

    return length_buckets.pack_tokens(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


# --- 3: language ---------------------------------------------------------------------


def _fold(doc_id, parts: int):
    return F.crc32(doc_id.cast("string")) % parts


@query("op3_cross_parsing")
def _op3(spark, sf):
    docs = _table(spark, sf, "documents")
    sample = cross_parsing.training_sample(docs.where(_fold(F.col("doc_id"), 5) != 0))
    found = cross_parsing.predict_language(docs, sample)
    return found.select("doc_id", (_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


# --- 7: toxicity ---------------------------------------------------------------------


@query("op7_segment_toxicity")
def _op7(spark, sf):
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    marks = labels.where(_fold(F.col("doc_id"), 4) != 2).select("doc_id", F.col("toxic").alias("label"))
    found = toxic_segments.toxicity(docs, toxic_segments.fit(docs, marks))
    return found.select("doc_id", (_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


# --- 1: near duplicates --------------------------------------------------------------


@query("op1_order_minhash")
def _op1(spark, sf):
    return order_minhash.near_groups(_table(spark, sf, "documents")).drop("row_hash")


# --- 2: chat formatting --------------------------------------------------------------


@query(
    "op2_perspective_rotation",
    """with t as (select conv_id, turn, coalesce(role, 'unknown') r, coalesce(text, '') x,
                      coalesce(cast(floor(turn / 256) as bigint), -1) piece
               from conversations where conv_id is not null),
       s as (select distinct conv_id, r speaker from t),
       u as (select t.conv_id, speaker, piece, turn, r, x,
                    case when r = speaker then '<|assistant|>' || chr(10) else '<|user name=' || r || '|>' || chr(10) end head
             from t join s using (conv_id)),
       p as (select *, length(head) + length(x) + 8 n,
                    coalesce(sum(length(head) + length(x) + 8) over (partition by conv_id, speaker order by piece, turn, r, x
                             rows between unbounded preceding and 1 preceding), 0) a from u)
       select conv_id, speaker, piece, cast(min(a) as bigint) "start",
              string_agg(head || x || '<|end|>' || chr(10), '' order by turn nulls first, r, x) "text",
              coalesce(string_agg(case when r = speaker then cast(a + length(head) as bigint) || '-' || cast(a + n - 1 as bigint) end,
                                  ',' order by turn nulls first, r, x), '') mask,
              cast(coalesce(sum(case when r = speaker then n - 1 - length(head) end), 0) as bigint) n_trained
       from p group by conv_id, speaker, piece""",
)
def _op2(spark, sf):
    return perspectives.rotate(_table(spark, sf, "conversations"))


# --- 5: licences ---------------------------------------------------------------------


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), {_sql_text(license_digests.COPYRIGHT_LINE)}, '', 'g')"
    for old, new in license_digests.SPELLINGS:
        out = f"replace({out}, {_sql_text(old)}, {_sql_text(new)})"
    out = f"regexp_replace({out}, {_sql_text(license_digests.VERSION_MARK)}, 'version \\2', 'g')"
    out = f"regexp_replace({out}, {_sql_text(license_digests.NO_WORD)}, ' ', 'g')"
    return f"regexp_replace({out}, {_sql_text(license_digests.LINE_EDGE)}, '', 'g')"


def _digest(text: str) -> str:
    """The digest of a known text, worked out apart from Spark."""
    text = regex.sub(license_digests.COPYRIGHT_LINE, "", text.lower())
    for old, new in license_digests.SPELLINGS:
        text = text.replace(old, new)
    text = regex.sub(license_digests.VERSION_MARK, r"version \2", text)
    return hashlib.sha256(" ".join(regex.sub(license_digests.NO_WORD, " ", text).split()).encode()).hexdigest()


_SQL_KNOWN = ", ".join(
    f"({_sql_text(i)}, '{d}')" for i, d in sorted({(i, _digest(t)) for i, t in license_digests.KNOWN_TEXTS + license_digests.full_texts()})
)
_SQL_PLAIN = f"regexp_replace(coalesce(text, ''), {_sql_text(license_digests.COMMENTED_COPYRIGHT_LINE)}, '', 'g')"


@query(
    "op5_license_digests",
    f"""with k as (select i, h from (values {_SQL_KNOWN}) v(i, h)),
       d as (select doc_id, {_sql_canonical("coalesce(text, '')")} c, {_sql_canonical(_SQL_PLAIN)} p from documents),
       w as (select doc_id, sha256(trim(regexp_replace(c, '[ \n]+', ' ', 'g'))) h,
                    sha256(trim(regexp_replace(p, '[ \n]+', ' ', 'g'))) u from d),
       l as (select doc_id, sha256(unnest(string_split(c, chr(10)))) h from d),
       m as (select doc_id, string_agg(distinct i, ',' order by i) ls, count(*) n from l join k using (h) group by 1)
       select w.doc_id, w.h text_digest, coalesce(k.i, o.i) license_id, coalesce(ls, '') line_licenses, coalesce(n, 0) n_license_lines
       from w left join k using (h) left join k o on o.h = w.u left join m using (doc_id)""",
)
def _op5(spark, sf):
    return license_digests.scan_licenses(_table(spark, sf, "documents"))


# --- 11: conversation structure ------------------------------------------------------


@query("op11_dialogue_repair")
def _op11(spark, sf):
    turns = _table(spark, sf, "conversations")
    return dialogue_repair.repair_report(dialogue_repair.damaged(turns), turns)


# --- 12: pages -----------------------------------------------------------------------

# every page of the tables has one article element, without markup of asides in it
@query(
    "op12_page_differences",
    r"""with a as (select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) x from pages),
       b as (select page_id, url, i, regexp_replace(block, '<[^>]*>', ' ', 'g') y
             from (select page_id, url, generate_subscripts(l, 1) i, unnest(l) block
                   from (select page_id, url, regexp_split_to_array(x, '</?(?:p|h1)>') l from a)) s),
       c as (select page_id, i, trim(regexp_replace(
               regexp_replace(regexp_replace(y, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) z from b),
       d as (select page_id, string_agg(z, chr(10) order by i) t from c where z <> '' group by 1)
       select page_id, url, coalesce(t, '') "text", length(coalesce(t, '')) n_chars from pages left join d using (page_id)""",
)
def _op12(spark, sf):
    return page_differences.extract_text(_table(spark, sf, "pages"))


# --- 13: hard negatives --------------------------------------------------------------


@query(
    "op13_hard_negatives",
    """with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
                      list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v
               from embeddings
               where label is not null and embedding is not null
                 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
       s as (select a.vec_id a, b.vec_id b, a.l = b.l same,
                    cast(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) as bigint) s
             from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
       p as (select * from (select a, b, s, row_number() over (partition by a order by s desc, b) r from s where same) x where r <= 5),
       n as (select p.a, p.b p, p.s ps, s.b n, s.s ns, row_number() over (partition by p.a, p.b order by s.s desc, s.b) r
             from p join s on s.a = p.a and not s.same and 30 * p.s <= 100 * s.s and 100 * s.s <= 90 * p.s)
       select a anchor_id, p positive_id, cast(r as integer) "rank", n negative_id, ps positive_score, ns negative_score
       from n where r <= 10""",
)
def _op13(spark, sf):
    return hard_negatives.mine(hard_negatives.relabelled(_table(spark, sf, "embeddings")))
