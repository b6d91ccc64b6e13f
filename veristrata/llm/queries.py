"""The operators over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ctph, lm_score, mixing, repeats, simhash, tokens, toxicity, url_filter, vectors, wfst
from .common import give_back, prepare, table

#: (host, path, verdict) of the rules that op6 applies.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(prepare(spark), sf_dir, "embeddings"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.simhash_groups(table(prepare(spark), sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.materialise_order(table(prepare(spark), sf_dir, "documents"))


def sentencepiece_ids(docs: DataFrame, machine: wfst.Transducer | None = None) -> DataFrame:
    """doc_id, ids, n_tokens, decoded_sha256, round_trip of every row; null texts are empty.
    round_trip: decoding gives the text again (not so only if it holds the blank sign)."""
    shared = docs.sparkSession.sparkContext.broadcast(machine or wfst.load())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids = m.encode_arrays(texts)
            back = [m.decode(i) for i in ids]
            sizes = np.array([len(i) for i in ids], np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, sizes.cumsum()].astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
            cols = [lists, pa.array(sizes), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]), pa.array([x == y for x, y in zip(texts, back, strict=True)], pa.bool_())]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "ids", "n_tokens", "decoded_sha256", "round_trip"])
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, decoded_sha256 string, round_trip boolean")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_ids(table(prepare(spark), sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as of quality 1 that are not held out; background: all."""
    docs = table(prepare(spark), sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").where(~toxicity.held_out(F.col("doc_id")))
    return lm_score.score(docs, good)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = prepare(spark).createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.compare_with_next(table(prepare(spark), sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    got = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(prepare(spark), sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = repeats.remove_repeats(table(prepare(spark), sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def queries() -> dict:
    ops = (op1_embedding_near_dedup, op2_simhash_near_dedup, op3_token_shards, op4_sentencepiece, op5_lm_score, op6_url_filter, op7_document_fingerprints, op8_toxicity, op9_source_mixing, op10_suffix_array_dedup)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return {
        "op1_embedding_near_dedup": """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from r join l on r.b = l.a),
c as (select a, min(b) as component_id from r group by a),
n as (select a, count(*) as n from l group by a)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e left join c on c.a = e.vec_id left join n on n.a = e.vec_id""",
        # windows of 100 bytes as hexadecimal digits, taken from pieces so that no long text is scanned for each
        "op10_suffix_array_dedup": """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, '')))::bigint as n from documents),
b as (select doc_id, n, h, unnest(range(0, greatest(n - 99, 0), 256)) as base from d),
p as (select doc_id, base, least(256, n - 99 - base) as k, substr(h, 2 * base + 1, 710) as s from b),
i as (select doc_id, base, s, unnest(range(k)) as i from p),
w as (select doc_id, base + i as pos, md5(substr(s, 2 * i + 1, 200)) as m from i),
f as (select doc_id, pos, row_number() over (partition by m order by doc_id, pos) as r from w),
g as (select doc_id, pos, coalesce(pos > lag(pos) over (partition by doc_id order by pos) + 100, true) as new from f where r > 1),
s as (select doc_id, pos, sum(new::int) over (partition by doc_id order by pos rows unbounded preceding) as k from g),
x as (select doc_id, min(pos) as a, max(pos) + 100 as b from s group by doc_id, k),
gaps as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as a, a as b from x union all select doc_id, max(b), null from x group by doc_id),
kept as (select g.doc_id, string_agg(substr(d.h, 2 * g.a + 1, 2 * (coalesce(g.b, d.n) - g.a)), '' order by g.a) as h from gaps g join d on d.doc_id = g.doc_id group by g.doc_id),
t as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans from x group by doc_id)
select d.doc_id, d.n as n_bytes, coalesce(t.n_removed, 0)::bigint as n_removed, coalesce(t.n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256
from d left join t on t.doc_id = d.doc_id left join kept on kept.doc_id = d.doc_id""",
        "op6_url_filter": rf"""
with p as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
q as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from p),
u as (select page_id, translate(raw, '{url_filter.UPPER}', '{url_filter.LOWER}') as host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from q),
rules(h, p, v) as (values {rules}),
m as (select u.page_id, u.host, u.path, r.h || r.p as rule, r.v, row_number() over (partition by u.page_id order by length(r.h || r.p) desc nulls last, length(r.h) desc, r.v desc) as k
  from u left join rules r on (u.host = r.h or ends_with(u.host, '.' || r.h)) and starts_with(u.path, r.p))
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from m where k = 1""",
    }
