"""Queries of duplicate and leakage evidence, neighbours and prototypes, repairs, queues, parts and audits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldlark.functions import scalars
from fieldlark.functions.scalars import nonblank
from fieldlark.operators import aggregates, evaluation, joins, registry, similarity
from fieldlark.operators.references import whole_number
from fieldlark.plans.composites import _COS, _PRED, _pred
from fieldlark.plans.register import Register
from fieldlark.plans.relational import _URLS, _WHOLE
from fieldlark.session import cut, shared_dir, table
from fieldlark.sources import sinks

query = Register()
QUERIES, SQL = query.queries, query.sql

# ---------------------------------------------------------------- duplicates


@query(
    f"""with base as (select source_media_row_number as id, sha256(trim(media_identifier)) as uh, sha256(canonical) as ch, media_license as lic, {_WHOLE.format('"gbifID"')} as taxon from {_URLS}),
u as (select uh, count(distinct taxon) as t, count(distinct lic) as l from base where uh is not null group by 1 having count(*) > 1),
c as (select ch, count(distinct taxon) as t, count(distinct lic) as l from base where ch is not null group by 1 having count(*) > 1)
select id as source_media_row_number, case when greatest(coalesce(u.t, 0), coalesce(c.t, 0)) > 1 then 'CONFLICT' when uh is null then 'NOT_APPLICABLE' else 'PASS' end as across_taxa,
  case when greatest(coalesce(u.l, 0), coalesce(c.l, 0)) > 1 then 'CONFLICT' when uh is null then 'NOT_APPLICABLE' else 'PASS' end as across_licences from base left join u using (uh) left join c using (ch)"""
)
def c_duplicate_statuses(spark, d):
    m = table(spark, d, "gbif_media")
    out = aggregates.duplicate_membership(m, "source_media_row_number", "media_identifier", ["gbifID", "media_identifier", "media_creator"], whole_number(F.col("gbifID")), F.col("media_license"))
    return out.select("source_media_row_number", "across_taxa", "across_licences")


@query("""select source_ordinal, 'sha256:' || sha256('gbifID|' || trim("gbifID")) as occurrence_group, 'sha256:' || sha256('dataset-occurrence|' || "datasetKey" || '|' || "occurrenceID") as dataset_group,
  'sha256:' || sha256('creator|' || nullif(lower(trim(publisher)), '')) as creator_group from occurrence_source""")
def c_leakage_groups(spark, d):
    # The kinds that go into the ids.
    kinds = {"gbifID": [F.trim("gbifID")], "dataset-occurrence": [F.col("datasetKey"), F.col("occurrenceID")], "creator": [F.nullif(F.lower(F.trim("publisher")), F.lit(""))]}
    ids = aggregates.leakage_groups(kinds)
    names = dict(zip(("occurrence_group", "dataset_group", "creator_group"), kinds, strict=True))
    return table(spark, d, "occurrence_source").select("source_ordinal", *[ids[k].alias(n) for n, k in names.items()])


# ---------------------------------------------------------------- neighbours, prototypes


@query(f"""with s as (select q.vec_id as query_id, c.vec_id as neighbour_id, {_COS.format('q.embedding', 'c.embedding')} as similarity from embeddings q join embeddings c on q.label = c.label where q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
select query_id, neighbour_id, round(similarity, 6) as similarity, cast(rn as int) as rank from (select *, row_number() over (partition by query_id order by round(similarity, 12) desc, neighbour_id) as rn from s) where rn <= 3""")
def v_group_neighbours(spark, d):
    e = table(spark, d, "embeddings")
    return similarity.nearest(e, e.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding", 3, group="label").withColumn("similarity", F.round("similarity", 6))


@query("""select 5 * count(*) as n_exact, true as recalled from embeddings where vec_id % 20 = 0""")
def v_index_recall(spark, d):
    """Whether the index finds at least nine tenths of the exact neighbours of every 20th row."""
    e = table(spark, d, "embeddings")
    asked = e.where(F.col("vec_id") % 20 == 0)
    measured = similarity.recall(similarity.nearest_indexed(e, asked, "vec_id", "embedding", 5), similarity.nearest(e, asked, "vec_id", "embedding", 5))
    return measured.select("n_exact", (F.col("recall") >= 0.9).alias("recalled"))


@query(f"""with s as (select q.vec_id as query_id, c.label, {_COS.format('q.embedding', 'c.embedding')} as similarity, c.vec_id as n from embeddings q, embeddings c where q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
near as (select * from (select *, row_number() over (partition by query_id order by round(similarity, 12) desc, n) as rn from s) where rn <= 7),
v as (select query_id, label, sum(greatest(similarity, 0)) as s, count(*) as n from near where label is not null group by 1, 2),
r as (select *, row_number() over (partition by query_id order by round(s, 9) desc, label) as rn, sum(s) over (partition by query_id) as total, sum(n) over (partition by query_id) as k from v)
select query_id, label as predicted, round(s / nullif(total, 0), 6) as share, cast(k as bigint) as n_neighbours from r where rn = 1""")
def v_neighbour_vote(spark, d):
    e = table(spark, d, "embeddings")
    near = similarity.nearest(e, e.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding", 7)
    return similarity.neighbour_vote(near, e, "vec_id", "label").withColumn("share", F.round("share", 6))


_LENGTH = "sqrt(list_sum(list_transform({0}, lambda x: x * x)))"


@query(f"""with e as (select label, vec_id % 7 as o, list_transform(embedding, lambda x: x::double / {_LENGTH.format('embedding::double[]')}) as v from embeddings where label is not null),
o as (select label, o, list(m order by i) as v from (select label, o, i, avg(v[i]) as m from e, range(1, 65) as t(i) where i <= len(v) group by 1, 2, 3) group by 1, 2),
c as (select label, list(m order by i) as v from (select label, i, avg(v[i] / {_LENGTH.format('v')}) as m from o, range(1, 65) as t(i) where i <= len(v) group by 1, 2) group by 1)
select label, cast(i - 1 as bigint) as i, round(v[i] / {_LENGTH.format('v')}, 6) as mean from c, range(1, 65) as t(i) where i <= len(v)""")
def v_prototypes(spark, d):
    """Vectors with one remainder of their id stand for one observation."""
    e = table(spark, d, "embeddings").withColumn("o", F.col("vec_id") % 7)
    m = similarity.prototypes(e, "label", "o", "embedding").select("label", F.posexplode("mean").alias("i", "m"))
    return m.select("label", F.col("i").cast("bigint").alias("i"), F.round("m", 6).alias("mean"))


# ---------------------------------------------------------------- repairs, labels, queues


@query(r"""with t as (select source_ordinal, trim("scientificName") as name, regexp_extract_all(trim("scientificName"), '\S+') as w, "taxonKey" as k, "acceptedTaxonKey" as a from occurrence_source where "taxonRank" = 'SPECIES' and coalesce(trim(species), '') = ''),
n as (select *, case when regexp_full_match(w[1], '[A-Z][\p{L}.''-]+') and regexp_full_match(w[2], '\p{Ll}[\p{L}.''-]*') and lower(w[2]) not in ('sp', 'sp.', 'spp', 'spp.', 'indet', 'indet.') then w[1] || ' ' || w[2] end as found from t)
select source_ordinal, found as derived_species, case when found is not null and trim(k) <> '' and trim(a) <> '' then 'PASS' else 'UNKNOWN' end as status from n""")
def c_rank_repair(spark, d):
    o = table(spark, d, "occurrence_source")
    gaps = o.where((F.col("taxonRank") == "SPECIES") & (F.coalesce(F.trim("species"), F.lit("")) == ""))
    return gaps.select("source_ordinal", *registry.species_repair(F.col("scientificName"), [F.col("taxonKey"), F.col("acceptedTaxonKey")]))


@query("""with r as (select trim(source_item_id) as item, true_class_label as label, count(*) as n from calibration_prediction where trim(source_item_id) <> '' and true_class_label is not null group by 1, 2)
select item, case when count(*) = 1 then min(label) end as label, case when count(*) > 1 then 'CONFLICT' when sum(n) > 1 then 'REPEATED' else 'SINGLE' end as label_status, cast(sum(n) as bigint) as n_rows from r group by 1""")
def c_reviewed_labels(spark, d):
    c = table(spark, d, "calibration_prediction").select(nonblank(F.col("source_item_id")).alias("item"), F.col("true_class_label").alias("label"))
    return registry.resolved_labels(c, "item", "label")


@query("""with k as (select source_media_row_number as id, sha256(concat_ws('|', coalesce(media_license, ''), coalesce(media_creator, ''))) as d, ingested_at as t from gbif_media),
cur as (select * from k), prev as (select id, case when id % 10 = 3 then 'old' else d end as d from k where id % 10 <> 7)
select cur.id as source_media_row_number, case when prev.id is null then 'NEW' when cur.d <> prev.d then 'CHANGED' else 'SAME' end as change_status, datediff('day', t::date, date '2026-03-18') > 30 as probe_due, datediff('day', t::date, date '2026-03-18') > 90 as metadata_due
from cur left join prev using (id) where prev.id is null or cur.d <> prev.d or datediff('day', t::date, date '2026-03-18') > 30""")
def w_refresh_queue(spark, d):
    """What to look at again: rows that are new or changed since a snapshot, and rows whose last
    look is older than its term allows. The snapshot is the table without some rows and with some changed."""
    m = table(spark, d, "gbif_media")
    digest = F.sha2(F.concat_ws("|", F.coalesce("media_license", F.lit("")), F.coalesce("media_creator", F.lit(""))), 256)
    now = m.select("source_media_row_number", digest.alias("digest"), "ingested_at")
    key = F.col("source_media_row_number")
    before = now.where(key % 10 != 7).select("source_media_row_number", F.when(key % 10 == 3, F.lit("old")).otherwise(F.col("digest")).alias("digest"))
    queue = joins.refresh_queue(now, before, "source_media_row_number", "digest", "ingested_at", "2026-03-18", {"probe_due": 30, "metadata_due": 90})
    return queue.select("source_media_row_number", "change_status", "probe_due", "metadata_due")


# ---------------------------------------------------------------- parts, rows as JSON, audits, weighted shares


@query(f"""with o as (select {_WHOLE.format('"gbifID"')} as k, max(ingested_at) as last_seen, count(*) as n from occurrence_source where trim("gbifID") <> '' group by 1)
select source_media_row_number, k, last_seen, n from (select source_media_row_number, nullif({_WHOLE.format('"gbifID"')}, '') as k from gbif_media) m left join o using (k)""")
def c_sealed_join(spark, d):
    """A join that is written in eight sealed parts, first only the even ones, as if it had been
    interrupted, then the rest, and put together from the seals."""
    key = lambda c: F.nullif(whole_number(F.col(c)), F.lit(""))
    o = table(spark, d, "occurrence_source").select(key("gbifID").alias("k"), "ingested_at").where(F.col("k").isNotNull()).groupBy("k").agg(F.max("ingested_at").alias("last_seen"), F.count(F.lit(1)).alias("n"))
    m = table(spark, d, "gbif_media").select("source_media_row_number", key("gbifID").alias("k"))
    wide = joins.with_ordinal(m, ["source_media_row_number"]).join(o, "k", "left")
    at = f"{shared_dir(spark)}/parts-{uuid.uuid4().hex}"
    rows = m.count()
    width = max(1, -(-rows // 8))
    sinks.seal_parts(wide, at, "ordinal", width, only=(0, 2, 4, 6))
    sinks.seal_parts(wide, at, "ordinal", width)
    out = cut(sinks.assemble_parts(spark, at, rows).drop("ordinal"))
    sinks.remove(spark, at)
    return out


@query("""select vec_id, cast(json_object('id', vec_id, 'label', label, 'parts', embedding[1:2] is not null) as varchar) as document from embeddings where label is not null""")
def q_json_rows(spark, d):
    e = table(spark, d, "embeddings").where(F.col("label").isNotNull())
    return e.select("vec_id", F.to_json(F.struct(F.col("vec_id").alias("id"), "label", F.slice("embedding", 1, 2).isNotNull().alias("parts"))).alias("document"))


@query("""select field, status, n_rows, n_missing from (values ('gbifID', 'MATCH', 'gbifID'), ('decimalLatitude', 'TYPE_DIFFERS', 'decimalLatitude'), ('is_deleted', 'MATCH', 'is_deleted'), ('recordedBy', 'MISSING', null), ('publisher', 'EXTRA', 'publisher')) as v(field, status, c),
  (select count(*) as n_rows from occurrence_source) join (select 'gbifID' as f, count(*) - count("gbifID") as n_missing from occurrence_source union all select 'decimalLatitude', count(*) - count("decimalLatitude") from occurrence_source
  union all select 'is_deleted', count(*) - count(is_deleted) from occurrence_source union all select 'publisher', count(*) - count(publisher) from occurrence_source union all select 'recordedBy', count(*) from occurrence_source) on f = field""")
def w_schema_differences(spark, d):
    """Some columns of a table against a contract with a type that differs, a column that is not there
    and one that is not expected, with how many rows lack a value."""
    o = table(spark, d, "occurrence_source").select("gbifID", "decimalLatitude", "is_deleted", "publisher")
    return aggregates.schema_audit(o, {"gbifID": "string", "decimalLatitude": "double", "is_deleted": "boolean", "recordedBy": "string"}).select("field", "status", "n_rows", "n_missing")


@query(_PRED + """, c as (select source, count(*) as n, sum(w) as weight, coalesce(sum(w) filter (truth), 0) as hit_weight, sum(w) * sum(w) / sum(w * w) as en from x where w > 0 group by 1), z as (select *, hit_weight / weight as p, 1.959963984540054 as z from c)
select source, n, round(p, 9) as share, round(greatest(0, (p + z * z / 2 / en) / (1 + z * z / en) - z * sqrt(p * (1 - p) / en + z * z / 4 / (en * en)) / (1 + z * z / en)), 9) as low, round(least(1, (p + z * z / 2 / en) / (1 + z * z / en) + z * sqrt(p * (1 - p) / en + z * z / 4 / (en * en)) / (1 + z * z / en)), 9) as high from z""")
def e_weighted_wilson(spark, d):
    p = evaluation.weighted_proportions(_pred(spark, d), ["source"], F.col("truth"), F.col("w"))
    return p.select("source", "n", *[F.round(c, 9).alias(c) for c in ("share", "low", "high")])
