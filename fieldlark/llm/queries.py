"""Queries of the operators for training data and, where it can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlark.llm import duplicates, leakage, overlap, packing, quality, splits
from fieldlark.operators.references import url_key
from fieldlark.session import table

Query = Callable[[SparkSession, str], DataFrame]

# ---- problem 2


def _media(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "reference_media_objects")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = overlap.overlap_pairs(_media(spark, d))
    return pairs.select(F.least("train_id", "other_id").alias("media_id_a"), F.greatest("train_id", "other_id").alias("media_id_b")).distinct()


def p2_records(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlapping_records(_media(spark, d))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_report(_media(spark, d))


def p2_components(spark: SparkSession, d: str) -> DataFrame:
    """An image's observations are those of the ``gbif_media`` rows with its URL."""
    media, seen = _media(spark, d), table(spark, d, "gbif_media")
    urls = seen.select(url_key(F.col("media_identifier")).alias("url"), F.nullif(F.trim("gbifID"), F.lit("")).alias("observation_id")).where("url <> '' and observation_id is not null").distinct()
    own = media.select(F.trim("reference_media_id").alias("media_id"), url_key(F.col("source_object_uri")).alias("url"))
    return duplicates.duplicate_components(media, own.join(urls, "url").select("media_id", "observation_id"))


_P2 = r"""
with m as (select trim(reference_media_id) as id, lower(trim(dataset_split)) as split, source, decoded_width as w, decoded_height as h, provider_mirror_ids as mirrors,
    nullif(regexp_extract(lower(regexp_replace(sha256, '[^A-Za-z0-9]+', '', 'g')), '^(?:sha256)?([0-9a-f]{64})$', 1), '') as sha,
    regexp_extract(lower(trim(perceptual_hash)), '^dhash128-v1:([0-9a-f]{32})$', 1) as hash,
    case when coalesce(duplicate_type, '') <> 'unresolved_perceptual_candidate' then nullif(trim(canonical_reference_media_id), '') end as canonical
  from reference_media_objects where trim(reference_media_id) <> '' and trim(dataset_split) <> ''),
bits as (select *, case when hash <> '' then ('0x' || substr(hash, 1, 16))::ubigint end as hi, case when hash <> '' then ('0x' || substr(hash, 17, 16))::ubigint end as lo from m),
r as (select *, case when bit_count(hi)::int + bit_count(lo)::int between 8 and 120 and w > 0 and h > 0 then true else false end as telling from bits),
t as (select * from r where split = 'support_train'), e as (select * from r where split <> 'support_train'),
pairs as (
  select t.id as a, e.id as b, 'sha256' as kind from t join e using (sha)
  union select t.id, e.id, 'canonical' from t join e using (canonical)
  union select t.id, e.id, 'perceptual' from t join e on t.telling and e.telling and bit_count(xor(t.hi, e.hi))::int + bit_count(xor(t.lo, e.lo))::int <= 4 and abs(t.w / t.h - e.w / e.h) <= 0.05
  union select t.id, e.id, 'mirror' from (select id, unnest(mirrors) as other from m) x join t on t.id = x.id join e on e.id = trim(x.other)
  union select t.id, e.id, 'mirror' from (select id, unnest(mirrors) as other from m) x join e on e.id = x.id join t on t.id = trim(x.other)),
flags as (select b, bool_or(kind = 'sha256') as sha256, bool_or(kind = 'perceptual') as perceptual, bool_or(kind = 'mirror') as mirror, bool_or(kind = 'canonical') as canonical from pairs group by 1)
"""

# ---- problem 4


def _predictions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "calibration_prediction")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.broken_groups(_predictions(spark, d))


def p4_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_splits(_predictions(spark, d)).select("prediction_id", "component", "split")


def p4_balance(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_balance(splits.assign_splits(_predictions(spark, d)))


def p4_check(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_check(splits.assign_splits(_predictions(spark, d)))


_P4 = r"""
with recursive links as (
  select prediction_id, 'c:' || lower(trim(leakage_component_id)) as ent from calibration_prediction where trim(leakage_component_id) <> ''
  union all select prediction_id, 'i:' || lower(trim(source_item_id)) from calibration_prediction where trim(source_item_id) <> ''
  union all select prediction_id, 'a:' || lower(trim(photographer_id)) from calibration_prediction where starts_with(lower(trim(photographer_id)), 'observer-')),
pairs as (select distinct x.ent as u, y.ent as v from links x join links y using (prediction_id)),
reach as (select distinct ent as u, ent as v from links union select r.u, p.v from reach r join pairs p on p.u = r.v),
roots as (select u as ent, min(v) as root from reach group by 1),
grouped as (select distinct l.prediction_id, r.root from links l join roots r using (ent)),
bad as (select root from grouped join calibration_prediction using (prediction_id) group by root having count(distinct nullif(lower(trim(dataset_split)), '')) > 1)
select prediction_id from grouped join bad using (root)
"""

# ---- problem 7


def _packed(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, "doc_id", "text"))


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_report(_packed(spark, d))


def p7_certificates(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return packing.certified(packing.pieces(docs, "doc_id", "text"))[1]


def p7_check(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_check(_packed(spark, d))


# ---- problem 8


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return leakage.leaked_items(docs, "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leak_report(p8_found(spark, d), table(spark, d, "eval_items"))


# ---- problem 9


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_statistics(table(spark, d, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_statistics(spark, d).where(~F.col("is_prose")).select("doc_id").distinct()


def p9_lines(spark: SparkSession, d: str) -> DataFrame:
    """The statistics of characters and lines, which SQL can express as well."""
    s = p9_statistics(spark, d)
    return s.select("doc_id", "n_chars", "n_lines", *[F.round(c, 9).alias(c) for c in ("lines_ending_in_punctuation", "duplicate_line_share")])


def p9_by_source(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source")
    found = p9_statistics(spark, d).select("doc_id", "is_prose", "n_words", "prose_share")
    return docs.join(found, "doc_id").groupBy("source").agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_if("is_prose").alias("n_prose"), F.sum("n_words").alias("n_words"), F.avg("prose_share").alias("mean_prose_share")
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (p2_found, p2_records, p2_report, p2_components, p4_found, p4_splits, p4_balance, p4_check, p7_pack, p7_report, p7_certificates, p7_check, p8_found, p8_report, p9_found, p9_statistics, p9_lines, p9_by_source)
}

SQL: dict[str, str] = {
    "p2_found": _P2 + "select distinct least(a, b) as media_id_a, greatest(a, b) as media_id_b from pairs",
    "p2_records": _P2 + "select id, split, source, sha256, perceptual, mirror, flags.canonical from (select id, split, source from e) join flags on b = id",
    "p2_report": _P2
    + """select split, source, count(*) as n_records, count(b) as n_any, count(*) filter (sha256) as n_sha256, count(*) filter (perceptual) as n_perceptual,
  count(*) filter (mirror) as n_mirror, count(*) filter (flags.canonical) as n_canonical from (select id, split, source from e) left join flags on b = id group by 1, 2""",
    "p4_found": _P4,
    "p4_check": "select count(*) as n_rows, 0 as n_torn, true as shares_met from calibration_prediction where prediction_id is not null",
    "p7_check": "select count(*) as n_documents, 0 as n_unplaced, 0 as n_divided, 0 as n_with_gaps, 0 as n_overfull from documents",
    "p9_lines": r"""with l as (select doc_id, length(text) as n_chars, list_filter(list_transform(regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]'),
    lambda x: regexp_replace(x, '^[\s\p{Z}\x0b\x1c-\x1f\x{85}]+|[\s\p{Z}\x0b\x1c-\x1f\x{85}]+$', '', 'g')), lambda x: x <> '') as ls from documents)
select doc_id, coalesce(n_chars, 0) as n_chars, coalesce(len(ls), 0) as n_lines, case when len(ls) > 0 then round(len(list_filter(ls, lambda x: contains('.!?;:。！？…"''»”', right(x, 1)))) / len(ls), 9) end as lines_ending_in_punctuation,
  case when len(ls) > 0 then round((list_sum(list_transform(ls, lambda x: length(x))) - list_sum(list_transform(list_distinct(ls), lambda x: length(x)))) / list_sum(list_transform(ls, lambda x: length(x))), 9) end as duplicate_line_share from l""",
}
