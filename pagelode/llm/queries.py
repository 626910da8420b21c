"""The registered training-data queries: thin forms of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm import (
    bpe,
    edits,
    infill,
    interplay,
    language,
    minhash,
    mixing,
    outliers,
    planes,
    quality,
    sharding,
    vectors,
    warc,
)
from pagelode.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    REGISTERED[function.__name__] = function
    return function


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return REGISTERED | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op1_edits(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and how alike they are."""
    return edits.edit_fingerprints(_documents(spark, sf))


@query
def op2_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of the embeddings of each label."""
    return vectors.near_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"), 0.93)


SQL["op2_vectors"] = """
    with recursive good as (
      select vec_id, label, cast(embedding as double[]) as v from embeddings
      where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    link as (
      select a.vec_id as a, b.vec_id as b from good a join good b
        on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
      where list_cosine_similarity(a.v, b.v) >= 0.93),
    walk as (
      select vec_id, vec_id as other from embeddings
      union select w.vec_id, l.b from walk w join link l on l.a = w.other)
    select e.vec_id, (select count(*) from link where a = e.vec_id) as n_links,
      min(w.other) as component_id, min(w.other) = e.vec_id as kept
    from embeddings e join walk w on w.vec_id = e.vec_id group by e.vec_id"""


@query
def op3_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The mixed order of all documents, every source with the same weight."""
    return mixing.mix_sources(_documents(spark, sf)).select("doc_id", "source", "mix_slot", "mix_place")


@query
def op4_shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assign_shards(_documents(spark, sf), sharding.Ring(shards=40))


@query
def op5_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf), minhash.Settings(words=3, percent=85))


SQL["op5_minhash"] = r"""
    with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
    s as (select distinct doc_id, case when len(words) < 3 then array_to_string(words, ' ')
          else array_to_string(words[i:i + 2], ' ') end as shingle
      from (select *, unnest(generate_series(1, greatest(1, len(words) - 2))) as i from w where len(words) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    met as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b
      on a.shingle = b.shingle and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
    link as (select a, b from met join n x on x.doc_id = a join n y on y.doc_id = b
      where 100 * common >= 85 * (x.n + y.n - common)),
    walk as (select doc_id, doc_id as other from documents
      union select v.doc_id, l.b from walk v join link l on l.a = v.other)
    select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(v.other) as component_id,
      min(v.other) = d.doc_id as kept
    from documents d join walk v using (doc_id) left join n using (doc_id) group by d.doc_id"""


@query
def op6_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Archive all pages and tell what the archives hold, read back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{sf}/pages.parquet"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL["op6_warc"] = """
    select page_id, cast(octet_length(encode(payload)) as bigint) as payload_bytes,
      sha1(payload) as payload_digest,
      case when first <> page_id then 'revisit' else 'response' end as record_type,
      case when first <> page_id then first end as refers_to
    from (select page_id, payload,
        case when octet_length(encode(payload)) >= 1000
          then max(page_id) over (partition by payload) else page_id end as first
      from (select page_id, coalesce(html, '') as payload from pages))"""


@query
def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document, learnt from those not held out."""
    return language.identify_languages(_documents(spark, sf))


@query
def op8_token_planes(spark: SparkSession, sf: str) -> DataFrame:
    """Positions and digests of the ids, read back from the written planes."""
    path = scratch_path(spark, "token-planes")
    planes.write_ids(_documents(spark, sf), path, VOCABULARY)
    return planes.read_documents(spark, path)


@query
def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Score and verdict of every document, from weak labels alone."""
    docs = _documents(spark, sf)
    return quality.score_quality(docs, quality.fit_quality(docs))


@query
def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return bpe.encode_documents(_documents(spark, sf), VOCABULARY, summary=True)


@query
def op11_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and verdict of every document, by fixed rules and its language and source."""
    return outliers.reject_outliers(_documents(spark, sf))


@query
def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What each of five filters does at each step of each order, per language."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return interplay.audit_filters(_documents(spark, sf), labels).drop("filter")


SQL["op12_filter_audit"] = r"""
    with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
    w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) as capitals,
        min(doc_id) over (partition by text) as first from d),
    f as (select w.doc_id, w.part, unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([
          len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
          100 * capitals > 3 * length(text), regexp_matches(text, '[#$%&*|]'),
          coalesce(doc_id > first, false)]) as fails,
        coalesce(l.quality = 1, false) as good, coalesce(l.toxic = 1, false) as toxic, w.rowid as r
      from (select *, row_number() over () as rowid from w) w left join labels l using (doc_id)),
    o as (select a.x || b.x || c.x || d.x || e.x as filter_order
      from (select unnest(['A', 'B', 'C', 'D', 'E']) as x) a,
        (select unnest(['A', 'B', 'C', 'D', 'E']) as x) b, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) c,
        (select unnest(['A', 'B', 'C', 'D', 'E']) as x) d, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) e
      where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    m as (select r, any_value(part) as part, any_value(good) as good, any_value(toxic) as toxic,
        coalesce(string_agg(letter, '' order by letter) filter (fails), '') as failed from f group by r),
    c as (select part, failed, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
      from m group by part, failed),
    s as (select part, filter_order, step, substr(filter_order, step, 1) as letter, failed, n, good, toxic,
        contains(failed, substr(filter_order, step, 1)) as fails,
        length(translate(failed, left(filter_order, step - 1), '')) < length(failed) as before
      from c, o, (select unnest([1, 2, 3, 4, 5]) as step)),
    t as (select part, filter_order, step, any_value(letter) as letter,
        coalesce(sum(n) filter (not fails and not before), 0) as kept,
        coalesce(sum(n) filter (fails and not before), 0) as removed,
        coalesce(sum(n) filter (fails and before), 0) as redundant,
        coalesce(sum(n) filter (failed = letter), 0) as unique_fails,
        coalesce(sum(good) filter (fails and not before), 0) as good_lost,
        coalesce(sum(toxic) filter (fails and not before), 0) as toxic_lost
      from s group by part, filter_order, step)
    select part, filter_order, cast(step as int) as step, cast(kept as bigint) as kept,
      cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
      cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
      cast(toxic_lost as bigint) as toxic_lost,
      cast(sum(removed) over (partition by part, letter) as bigint) as shapley from t"""


@query
def op13_infill(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every document's fill-in-the-middle form and of the text rebuilt from it."""
    made = infill.fill_in_middle(_documents(spark, sf))
    back = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


SQL["op13_infill"] = r"""
    with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as t
      from documents),
    c as (select *, len(t) as n, ('0x' || substr(h, 1, 8))::bigint % (len(t) + 1) as x,
        ('0x' || substr(h, 9, 8))::bigint % (len(t) + 1) as y,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
            or ('0x' || substr(h, 17, 8))::bigint % 100 >= 50 then 'plain'
          when ('0x' || substr(h, 25, 8))::bigint % 100 < 80 then 'spm' else 'psm' end as form from d),
    p as (select *, array_to_string(t[1:least(x, y)], '') as prefix,
        array_to_string(t[least(x, y) + 1:greatest(x, y)], '') as middle,
        array_to_string(t[greatest(x, y) + 1:], '') as suffix from c)
    select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
      case when form <> 'plain' then length(middle) end as middle_chars,
      sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
      sha256(text) as restored_sha256 from p"""
