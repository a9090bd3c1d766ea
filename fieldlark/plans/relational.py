"""Queries of the relational core: scans, predicates, joins, aggregates, windows, set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlark.functions import names, scalars
from fieldlark.functions.scalars import canonical_url, first_known, nonblank
from fieldlark.operators import aggregates, hot_keys, joins, sampling
from fieldlark.operators.parse_rows import Contract, Field
from fieldlark.operators.references import whole_number
from fieldlark.plans.register import Register
from fieldlark.session import shared_dir, table
from fieldlark.sources import readers

query = Register()
QUERIES, SQL = query.queries, query.sql

_WHOLE = r"case when regexp_full_match(trim({0}), '\+?[0-9]+') then regexp_replace(trim({0}), '^\+?0*([0-9])', '\1') else trim({0}) end"
# gbif_media with the canonical form, the host and the authority of its address, step by step.
_URLS = """(select *, case when scheme in ('http', 'https') and authority <> '' then scheme || '://' || case when scheme || right(authority, 3) = 'http:80' then left(authority, -3)
      when scheme || right(authority, 4) = 'https:443' then left(authority, -4) else authority end || case when more = '' then '/' else more end end as canonical
  from (select *, lower(split_part(split_part(after, '/', 1), '?', 1)) as authority, substr(after, length(split_part(split_part(after, '/', 1), '?', 1)) + 1) as more
    from (select *, lower(split_part(bare, '://', 1)) as scheme, case when contains(bare, '://') then substr(bare, strpos(bare, '://') + 3) else '' end as after
      from (select *, split_part(trim(media_identifier), '#', 1) as bare from gbif_media))))"""


def _occ(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "occurrence_source")


def _media(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gbif_media")


# ---------------------------------------------------------------- scans, projections, predicates


@query("select source_ordinal, trim(\"gbifID\") as id_text, try_cast(\"taxonKey\" as bigint) as taxon_number, upper(\"basisOfRecord\") as basis, cast(length(\"scientificName\") as int) as name_length from occurrence_source")
def q_projection_rename_cast(spark, d):
    return _occ(spark, d).select("source_ordinal", F.trim("gbifID").alias("id_text"), F.col("taxonKey").try_cast("bigint").alias("taxon_number"), F.upper("basisOfRecord").alias("basis"), F.length("scientificName").alias("name_length"))


@query("select source_ordinal, nullif(trim(\"countryCode\"), '') as country, coalesce(nullif(trim(\"datasetName\"), ''), nullif(trim(publisher), ''), '<MISSING>') as provider from occurrence_source")
def q_blank_to_null_and_coalesce(spark, d):
    return _occ(spark, d).select("source_ordinal", nonblank(F.col("countryCode")).alias("country"), first_known(F.col("datasetName"), F.col("publisher")).alias("provider"))


@query("""select source_ordinal, coalesce(trim("lifeStage") <> '' and lower(trim("lifeStage")) not in ('unknown', 'n/a', 'not recorded'), false) as meaningful,
  lower(trim("basisOfRecord")) in ('human_observation', 'machine_observation', 'preserved_specimen') as in_vocabulary from occurrence_source""")
def q_meaningful_and_vocabulary(spark, d):
    return _occ(spark, d).select(
        "source_ordinal",
        scalars.meaningful(F.col("lifeStage"), ["unknown", "n/a", "not recorded"]).alias("meaningful"),
        scalars.in_vocabulary(F.col("basisOfRecord"), ["HUMAN_OBSERVATION", "MACHINE_OBSERVATION", "PRESERVED_SPECIMEN"]).alias("in_vocabulary"),
    )


@query("""select source_ordinal from occurrence_source where try_cast(trim("decimalLatitude") as double) between -23.5 and 23.5 and try_cast(trim("decimalLongitude") as double) between -180 and 0""")
def q_between_bounds(spark, d):
    return _occ(spark, d).where(F.trim("decimalLatitude").try_cast("double").between(-23.5, 23.5) & F.trim("decimalLongitude").try_cast("double").between(-180, 0)).select("source_ordinal")


@query("""select source_ordinal from occurrence_source where coalesce(try_cast(substr("eventDate", 1, 4) as double) >= 1960, true)""")
def q_retention_predicate(spark, d):
    return _occ(spark, d).where(F.coalesce(F.substring("eventDate", 1, 4).try_cast("double") >= 1960, F.lit(True))).select("source_ordinal")


@query("select source_ordinal from occurrence_source where \"taxonKey\" is distinct from \"acceptedTaxonKey\"")
def q_null_safe_inequality(spark, d):
    return _occ(spark, d).where(scalars.distinct_from(F.col("taxonKey"), F.col("acceptedTaxonKey"))).select("source_ordinal")


# ---------------------------------------------------------------- joins


@query("""select l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_orderdate, o.o_orderpriority from lineitem l left join orders o on o.o_orderkey = l.l_orderkey""")
def q_left_join_preserving(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    return joins.dimension(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), orders, ["l_orderkey"])


@query("""select o_orderkey, c_name as name, c_mktsegment as segment, n_name as nation, r_name as region from orders
  left join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey""")
def q_wide_dimension_struct(spark, d):
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    people = table(spark, d, "customer").join(places, "c_nationkey", "left").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), "nation", "region")
    return joins.dimension(table(spark, d, "orders").select("o_orderkey", "o_custkey"), people, ["o_custkey"], pack="customer").select("o_orderkey", "customer.*")


@query("""with dim as (select coalesce(countryCode, '') as k, count(*) as n from occurrence_source group by 1)
select source_ordinal, n as rows_of_country from occurrence_source o join dim on dim.k = coalesce(o."countryCode", '')""")
def q_blank_safe_dimension(spark, d):
    occ = _occ(spark, d).select("source_ordinal", "countryCode")
    dim = occ.groupBy(F.coalesce("countryCode", F.lit("")).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return joins.blank_safe(occ, dim, [("countryCode", "code")], "c").select("source_ordinal", F.col("c.n").alias("rows_of_country"))


@query("""with dim as (select "lifeStage" as s, "taxonRank" as r, count(*) as n from occurrence_source group by 1, 2)
select source_ordinal, n from occurrence_source o left join dim on o."lifeStage" is not distinct from s and o."taxonRank" is not distinct from r""")
def q_null_safe_join(spark, d):
    occ = _occ(spark, d).select("source_ordinal", "lifeStage", "taxonRank")
    dim = occ.groupBy(F.col("lifeStage").alias("s"), F.col("taxonRank").alias("r")).agg(F.count(F.lit(1)).alias("n"))
    return joins.null_safe(occ, dim, [("lifeStage", "s"), ("taxonRank", "r")]).select("source_ordinal", "n")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def q_anti_join(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("select p_partkey, p_brand from part where p_partkey in (select l_partkey from lineitem where l_quantity > 49)")
def q_semi_join(spark, d):
    used = table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return table(spark, d, "part").join(used, "p_partkey", "left_semi").select("p_partkey", "p_brand")


_SNAP = """with cur as (select o_orderkey as k, md5(o_orderstatus) as a, md5(cast(o_custkey % 7 as varchar)) as b from orders where o_orderkey % 11 <> 0),
prev as (select o_orderkey as k, md5(case when o_orderkey % 5 = 0 then 'X' else o_orderstatus end) as a, md5(cast(case when o_orderkey % 3 = 0 then 0 else o_custkey % 7 end as varchar)) as b from orders where o_orderkey % 13 <> 0)
"""


@query(
    _SNAP
    + """select coalesce(c.k, p.k) as k, case when p.k is null then 'NEW' when c.k is null then 'DELETED' else 'CHANGED' end as change_status,
  list_filter([case when p.k is null then 'NEW' end, case when c.k is null then 'DELETED' end, case when c.k is not null and p.k is not null and c.a is distinct from p.a then 'STATUS_CHANGED' end,
    case when c.k is not null and p.k is not null and c.b is distinct from p.b then 'OWNER_CHANGED' end], lambda x: x is not null) as change_reasons
from cur c full outer join prev p on c.k = p.k where c.k is null or p.k is null or c.a is distinct from p.a or c.b is distinct from p.b""", lists=('change_reasons',))
def q_snapshot_changes(spark, d):
    """Two derived snapshots of all orders: rows that leave, arrive and change by rule."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    cur = o.where(k % 11 != 0).select(k.alias("k"), F.md5("o_orderstatus").alias("a"), F.md5((F.col("o_custkey") % 7).cast("string")).alias("b"))
    prev = o.where(k % 13 != 0).select(k.alias("k"), F.md5(F.when(k % 5 == 0, "X").otherwise(F.col("o_orderstatus"))).alias("a"), F.md5(F.when(k % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey") % 7).cast("string")).alias("b"))
    return joins.snapshot_changes(cur, prev, "k", {"a": "STATUS_CHANGED", "b": "OWNER_CHANGED"})


@query("""with e as (select distinct o_orderkey as k from orders), r as (select l_orderkey as k, count(*) as n from lineitem group by 1)
select count(e.k) as n_expected, count(*) filter (e.k is not null and n = 1) as n_once, count(*) filter (e.k is not null and n is null) as n_missing,
  count(*) filter (e.k is not null and n > 1) as n_repeated, count(*) filter (e.k is null) as n_unexpected from e full join r on e.k = r.k""")
def q_coverage_proof(spark, d):
    return joins.coverage(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query("""select event_id, row_number() over (order by ts, event_id) - 1 as ordinal from events""")
def q_ordinal(spark, d):
    return joins.with_ordinal(table(spark, d, "events").select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "ordinal")


@query("""with a as (select event_id, row_number() over (order by ts, event_id) - 1 as o from events), b as (select event_id as other_id, row_number() over (order by value, event_id) - 1 as o from events)
select event_id, other_id from a join b using (o)""")
def q_positional_join(spark, d):
    """Two tables joined by position: both get an explicit dense ordinal first."""
    e = table(spark, d, "events")
    a = joins.with_ordinal(e.select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "ordinal")
    b = joins.with_ordinal(e.select(F.col("event_id").alias("other_id"), "value"), ["value", "other_id"]).select("other_id", "ordinal")
    return joins.ordinal_join(a, b).select("event_id", "other_id")


@query("""with rows as (select m.reference_media_id as id, unnest(m.provider_mirror_ids) as other from reference_media_objects m)
select id, count(*) as n_named, count(r.reference_media_id) as n_found, list_sort(list(r.source) filter (r.source is not null)) as sources from rows left join reference_media_objects r on r.reference_media_id = rows.other group by 1""", lists=('sources',))
def q_explode_join_regroup(spark, d):
    m = table(spark, d, "reference_media_objects")
    rows = m.select(F.col("reference_media_id").alias("id"), F.explode("provider_mirror_ids").alias("other"))
    known = m.select(F.col("reference_media_id").alias("other"), "source")
    return rows.join(known, "other", "left").groupBy("id").agg(F.count(F.lit(1)).alias("n_named"), F.count("source").alias("n_found"), F.sort_array(F.collect_list("source")).alias("sources"))


@query("""select source_ordinal, f.field, f.value from occurrence_source, unnest([{'field': 'family', 'value': family}, {'field': 'genus', 'value': genus}, {'field': 'species', 'value': species}]) as t(f) where f.value is not null""")
def q_fields_to_rows(spark, d):
    pairs = F.array(*[F.struct(F.lit(x).alias("field"), F.col(x).alias("value")) for x in ("family", "genus", "species")])
    return _occ(spark, d).select("source_ordinal", F.inline(pairs)).where(F.col("value").isNotNull())


@query("""select c_custkey, (select count(*) from orders o where o.o_custkey = c.c_custkey) as n_orders, (select count(*) from orders o where o.o_custkey = c.c_custkey and o_orderstatus = 'F') as n_final from customer c""")
def q_correlated_counts(spark, d):
    per = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    return table(spark, d, "customer").join(per, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("f", F.lit(0)).alias("n_final"))


@query(f"""with facts as (select source_ordinal, nullif(trim(species), '') as species, nullif(trim(genus), '') as genus, nullif(trim(family), '') as family from occurrence_source),
s as (select distinct nullif(trim(species), '') as species, 'scope' as scope_id from occurrence_source where "taxonRank" = 'SUBSPECIES' and trim(species) <> ''),
g as (select distinct nullif(trim(genus), '') as genus, 'scope' as scope_id from occurrence_source where "taxonomicStatus" = 'SYNONYM' and trim(genus) <> ''),
f as (select distinct nullif(trim(family), '') as family, 'scope' as scope_id from occurrence_source where trim(family) <> ''),
al as (select source_ordinal, scope_id, 0 as tier, 'species' as matched_by from facts join s using (species) union all select source_ordinal, scope_id, 1, 'genus' from facts join g using (genus) union all select source_ordinal, scope_id, 2, 'family' from facts join f using (family))
select source_ordinal, scope_id, min(tier) as tier, arg_min(matched_by, tier) as matched_by from al group by 1, 2""")
def q_strongest_scope_match(spark, d):
    occ = _occ(spark, d)
    facts = occ.select("source_ordinal", *[nonblank(F.col(c)).alias(c) for c in ("species", "genus", "family")])

    def scope(c, cond):
        return occ.where(cond & (F.trim(c) != "")).select(F.trim(c).alias(c), F.lit("scope").alias("scope_id")).distinct()

    return joins.strongest_match(facts, [("species", scope("species", F.col("taxonRank") == "SUBSPECIES")), ("genus", scope("genus", F.col("taxonomicStatus") == "SYNONYM")), ("family", scope("family", F.lit(True)))], "source_ordinal")


# ---------------------------------------------------------------- aggregates


@query(
    f"""with base as (select source_media_row_number as id, sha256(concat_ws(chr(31), coalesce("gbifID", '<NULL>'), coalesce(media_identifier, '<NULL>'), coalesce(media_creator, '<NULL>'))) as rh,
    sha256(trim(media_identifier)) as uh, sha256(canonical) as ch, media_license as lic, {_WHOLE.format('"gbifID"')} as taxon from {_URLS}),
r as (select rh, count(*) as n from base group by 1 having n > 1),
u as (select uh, count(*) as n, count(distinct taxon) as t, count(distinct lic) as l from base where uh is not null group by 1 having n > 1),
c as (select ch, count(*) as n, count(distinct taxon) as t, count(distinct lic) as l from base where ch is not null group by 1 having n > 1)
select id as source_media_row_number, coalesce(r.n, 1) as row_group_size, coalesce(u.n, 1) as url_group_size, coalesce(c.n, 1) as canonical_group_size,
  case when c.n is not null then 'sha256:' || sha256('canonical-url|' || ch) end as canonical_group_id,
  case when coalesce(greatest(u.t, c.t, u.l, c.l) > 1, false) then 'CONFLICT' when coalesce(r.n, u.n, c.n) is not null then 'DUPLICATE' else 'UNIQUE' end as duplicate_status
from base left join r using (rh) left join u using (uh) left join c using (ch)"""
)
def q_duplicate_membership(spark, d):
    return aggregates.duplicate_membership(_media(spark, d), "source_media_row_number", "media_identifier", ["gbifID", "media_identifier", "media_creator"], whole_number(F.col("gbifID")), F.col("media_license")).drop("across_taxa", "across_licences")


@query("""select "datasetKey", "occurrenceID", count(*) as n from occurrence_source where "datasetKey" is not null and "occurrenceID" is not null group by 1, 2 having count(*) > 1""")
def q_duplicate_keys_having(spark, d):
    keyed = _occ(spark, d).where(F.col("datasetKey").isNotNull() & F.col("occurrenceID").isNotNull())
    return keyed.groupBy("datasetKey", "occurrenceID").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


_GATES = {
    "addressable": "media_identifier is not null",
    "image": "coalesce(media_format, '') like 'image/%'",
    "licensed": "media_license is not null and media_license <> 'All rights reserved'",
    "credited": "trim(coalesce(media_creator, '')) <> ''",
}


@query(
    "with b as (select *, coalesce(nullif(trim(media_publisher), ''), '<MISSING>') as publisher, coalesce(nullif(lower(trim(media_type)), ''), '<MISSING>') as kind from gbif_media), "
    "k as (select *, trim(\"gbifID\") as gid from b) "
    + " union all ".join(
        f"""select '{dim}' as dimension, {col} as value, '{g}' as gate, count(*) as n_rows, count(distinct gid) as n_keys, count(*) filter ({cond}) as passed_rows,
        count(distinct gid) filter ({cond}) as passed_keys, round(100.0 * count(*) filter ({cond}) / count(*), 6) as pass_percentage from k group by 2"""
        for g, cond in _GATES.items()
        for dim, col in (("publisher", "publisher"), ("kind", "kind"))
    )
)
def q_gate_breakdown(spark, d):
    m = _media(spark, d).withColumn("gid", F.trim("gbifID"))
    gates = {g: F.expr(c) for g, c in _GATES.items()}
    dims = {"publisher": first_known(F.col("media_publisher")), "kind": F.coalesce(F.lower(nonblank(F.col("media_type"))), F.lit("<MISSING>"))}
    return aggregates.gate_breakdown(m, gates, dims, "gid").withColumn("pass_percentage", F.round("pass_percentage", 6))


_HHI_DIMS = (("publisher", "coalesce(nullif(trim(publisher), ''), '<MISSING>')"), ("country", "coalesce(nullif(trim(\"countryCode\"), ''), '<MISSING>')"), ("dataset", "coalesce(nullif(trim(\"datasetKey\"), ''), '<MISSING>')"))


@query(
    "with b as (select *, coalesce(nullif(trim(species), ''), '<MISSING>') as sp, trim(\"gbifID\") as gid from occurrence_source) "
    + " union all ".join(
        f"""select sp as species, '{n}' as dimension, cast(sum(n) as bigint) as n_rows, cast(sum(k) as bigint) as n_keys, count(*) as n_values, max(n) as largest,
    round(max(n) / sum(n), 9) as max_share, round(sum(pow(n / t, 2)), 9) as hhi, round(1 / sum(pow(n / t, 2)), 6) as effective_values
    from (select *, sum(n) over (partition by sp) as t from (select sp, {c} as v, count(*) as n, count(distinct gid) as k from b group by 1, 2)) group by 1"""
        for n, c in _HHI_DIMS
    )
)
def q_concentration(spark, d):
    occ = _occ(spark, d).withColumns({"species": first_known(F.col("species")), "gid": F.trim("gbifID")})
    dims = {"publisher": first_known(F.col("publisher")), "country": first_known(F.col("countryCode")), "dataset": first_known(F.col("datasetKey"))}
    out = aggregates.concentration(occ, "species", dims, "gid")
    return out.withColumns({"max_share": F.round("max_share", 9), "hhi": F.round("hhi", 9), "effective_values": F.round("effective_values", 6)})


@query("""select publisher, count(distinct "gbifID") as n_ids, count(distinct species) as n_species, count(distinct "datasetKey") as n_datasets, count(distinct "countryCode") as n_countries, count(distinct family) as n_families from occurrence_source group by 1""")
def q_multi_distinct_profile(spark, d):
    return _occ(spark, d).groupBy("publisher").agg(*[F.count_distinct(c).alias(n) for c, n in (("gbifID", "n_ids"), ("species", "n_species"), ("datasetKey", "n_datasets"), ("countryCode", "n_countries"), ("family", "n_families"))])


@query("""select "basisOfRecord", count(*) as n, count(*) filter ("countryCode" is null) as n_no_country, count(distinct species) filter ("taxonRank" = 'SPECIES') as species_at_rank from occurrence_source group by 1""")
def q_conditional_aggregates(spark, d):
    return _occ(spark, d).groupBy("basisOfRecord").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("countryCode").isNull()).alias("n_no_country"), F.count_distinct(F.when(F.col("taxonRank") == "SPECIES", F.col("species"))).alias("species_at_rank"))


@query("""with counts as (select genus, family as mode, count(*) as n from occurrence_source where family is not null group by 1, 2),
r as (select *, sum(n) over (partition by genus) as observed, row_number() over (partition by genus order by n desc, mode) as rn from counts)
select genus, mode, n as support, cast(observed as bigint) as observed from r where rn = 1""")
def q_mode_with_support(spark, d):
    return aggregates.mode_with_support(_occ(spark, d), ["genus"], "family")


_COMPLETE = ("countryCode", "decimalLatitude", "eventDate", "lifeStage", "publisher", "species", "coordinateUncertaintyInMeters")


@query(
    " union all ".join(
        f"""select '{c}' as field, count(nullif(trim("{c}"), '')) as known_rows, count(distinct "gbifID") filter (trim("{c}") <> '') as known_keys, count(*) as n_rows, count(distinct "gbifID") as n_keys from occurrence_source"""
        for c in _COMPLETE
    )
)
def q_completeness(spark, d):
    return aggregates.completeness(_occ(spark, d), _COMPLETE, "gbifID")


@query("""select gid, case when min(s) is null then 'UNKNOWN' when min(s) <> max(s) or count(*) filter (s is null) > 0 then 'CONFLICT' else 'PASS' end as species_status,
  case when min(c) is null then 'UNKNOWN' when min(c) <> max(c) or count(*) filter (c is null) > 0 then 'CONFLICT' else 'PASS' end as country_status
from (select trim("gbifID") as gid, nullif(trim(species), '') as s, nullif(trim("countryCode"), '') as c from occurrence_source) group by 1""")
def q_group_consistency(spark, d):
    return _occ(spark, d).groupBy(F.trim("gbifID").alias("gid")).agg(aggregates.consistency(F.col("species")).alias("species_status"), aggregates.consistency(F.col("countryCode")).alias("country_status"))


@query("""with c as (select "scientificName" as value, count(*) as n from occurrence_source group by 1), t as (select sum(n) as t from c),
r as (select value, n, row_number() over (order by n desc, value) as rn from c where value is not null)
select value, n, cast(rn as int) as rank, round(n / t, 6) as share from r, t where rn <= 25 union all select value, n, null, round(n / t, 6) from c, t where value is null""")
def q_frequency_top(spark, d):
    return aggregates.frequency(_occ(spark, d), F.col("scientificName"), 25)


@query("""select token, count(*) as n from (select unnest(case when length(p_type) > 0 then string_split(p_type, ' ') else [null] end) as token from part) group by 1""")
def q_token_frequency(spark, d):
    return aggregates.token_frequency(table(spark, d, "part"), F.col("p_type"), " ")


@query("""select l_orderkey, string_agg(l_partkey || 'x' || cast(l_quantity as bigint), ',' order by l_linenumber, l_partkey, l_quantity) as lines from lineitem group by 1""")
def q_ordered_struct_list(spark, d):
    lists = table(spark, d, "lineitem").groupBy("l_orderkey").agg(aggregates.ordered_list(["l_linenumber"], [F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity")], "lines"))
    return lists.select("l_orderkey", F.concat_ws(",", F.transform("lines", lambda x: F.concat_ws("x", x["part"], x["quantity"].cast("bigint")))).alias("lines"))


@query("""select o_custkey, list_sort(list(distinct o_orderpriority) filter (o_orderstatus = 'O')) as open_priorities, list_sort(list_distinct(list(o_orderstatus))) as statuses from orders group by 1""", lists=('open_priorities', 'statuses'))
def q_distinct_sorted_list(spark, d):
    open_ = F.sort_array(F.collect_set(F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))))
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.when(F.size(open_) > 0, open_).alias("open_priorities"), F.sort_array(F.collect_set("o_orderstatus")).alias("statuses"))


@query("""select p_brand, quantile_disc(p_retailprice, 0.5) as p50, quantile_disc(p_retailprice, 0.95) as p95 from part group by 1""")
def q_nearest_rank_quantiles(spark, d):
    return hot_keys.nearest_rank(table(spark, d, "part"), "p_brand", "p_retailprice", {"p50": 0.5, "p95": 0.95})


@query("""select family, count(*) as n_records, min(day) as first_day, max(day) as last_day, count(distinct "datasetKey") as n_sources, quantile_disc(u, 0.5) as uncertainty_p50, quantile_disc(u, 0.95) as uncertainty_p95,
  count(*) filter ("basisOfRecord" = 'PRESERVED_SPECIMEN') as n_specimen, count(*) filter (is_deleted) as n_deleted
from (select *, try_cast("coordinateUncertaintyInMeters" as double) as u, case when regexp_full_match("eventDate", '[0-9]{4}-[0-9]{2}-[0-9]{2}') then try_cast("eventDate" as date) end as day from occurrence_source) group by 1""")
def q_spread(spark, d):
    occ = _occ(spark, d).withColumns({"u": F.col("coordinateUncertaintyInMeters").try_cast("double"), "day": F.when(F.col("eventDate").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.col("eventDate").try_cast("date"))})
    return aggregates.spread(occ, "family", "day", "datasetKey", "u", {"specimen": F.col("basisOfRecord") == "PRESERVED_SPECIMEN", "deleted": F.col("is_deleted")})


@query("""select country, decade, rank_known, count(*) as n from (select coalesce("countryCode", '?') as country, cast(floor(try_cast(substr("eventDate", 1, 4) as double) / 10) * 10 as bigint) as decade, "taxonRank" is not null as rank_known from occurrence_source) group by all""")
def q_group_by_all(spark, d):
    rows = _occ(spark, d).select(F.coalesce("countryCode", F.lit("?")).alias("country"), scalars.decade(F.substring("eventDate", 1, 4)).alias("decade"), F.col("taxonRank").isNotNull().alias("rank_known"))
    return spark.sql("select *, count(*) as n from {rows} group by all", rows=rows)



@query("""select count(*) as n_rows, cast(count(*) filter (k1 is null or k2 is null) as bigint) as n_null, count(distinct (k1, k2)) filter (k1 is not null and k2 is not null) as n_distinct,
  count(*) filter (k1 is not null and k2 is not null) - count(distinct (k1, k2)) filter (k1 is not null and k2 is not null) as n_repeated from (select "datasetKey" as k1, "occurrenceID" as k2 from occurrence_source)""")
def q_key_check(spark, d):
    return aggregates.key_check(_occ(spark, d), ["datasetKey", "occurrenceID"])


@query("""select cast(sum(cast(any_photo as int)) as bigint) as n_with_png, count(*) as n_ids from (select "gbifID", bool_or(media_format = 'image/png') as any_photo from gbif_media where "gbifID" is not null group by 1)""")
def q_two_level_boolean(spark, d):
    per = _media(spark, d).where(F.col("gbifID").isNotNull()).groupBy("gbifID").agg(F.bool_or(F.col("media_format") == "image/png").alias("any_photo"))
    return per.agg(F.sum(F.col("any_photo").cast("int")).alias("n_with_png"), F.count(F.lit(1)).alias("n_ids"))


@query("""select band, count(*) as n, round(avg(lat), 6) as mean_latitude from (select lat, cast(floor(lat / 10) as bigint) as band from (select try_cast(trim("decimalLatitude") as double) as lat from occurrence_source) where lat between -90 and 90) group by 1""")
def q_binned_grouping(spark, d):
    lat = _occ(spark, d).select(F.trim("decimalLatitude").try_cast("double").alias("lat")).where(F.col("lat").between(-90, 90))
    return lat.groupBy(scalars.band(F.col("lat"), 10).alias("band")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("lat"), 6).alias("mean_latitude"))


# ---------------------------------------------------------------- windows, top-k, samples, sets


@query("""select doc_id, lang, source, cast(rn as int) as sample_rank from (select doc_id, lang, source, row_number() over (partition by lang, source order by sha256('seed-1:' || cast(doc_id as varchar)), doc_id) as rn from documents) where rn <= 3""")
def q_stratified_sample(spark, d):
    return sampling.stratified_sample(table(spark, d, "documents").select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", 3, "seed-1")


@query("""with s as (select o_orderpriority, count(*) as n from orders group by 1), t as (select count(*) as t from orders),
r as (select o_orderkey, o.o_orderpriority, row_number() over (partition by o.o_orderpriority order by sha256('audit:' || cast(o_orderkey as varchar)), o_orderkey) as rn, n, least(n, greatest(1, cast(round(n * (200 / t)) as bigint))) as take from orders o join s using (o_orderpriority), t)
select o_orderkey, o_orderpriority, n as stratum_size, take as stratum_take, round(take / n, 9) as inclusion_probability, round(n / take, 6) as weight from r where rn <= take""")
def q_probability_sample(spark, d):
    out = sampling.probability_sample(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority"], "o_orderkey", 200, "audit")
    return out.withColumns({"inclusion_probability": F.round("inclusion_probability", 9), "weight": F.round("weight", 6)})


@query("""select event_id, cast(rn as int) as rank, cast((rn - 1) % 4 as int) as shard from (select event_id, row_number() over (order by sha256('shards:' || cast(event_id as varchar)), event_id) as rn from events) where rn <= 100""")
def q_seeded_shards(spark, d):
    return sampling.seeded_shards(table(spark, d, "events").select("event_id"), "event_id", 100, 4, "shards")


@query("""select event_id, event_type, cast(rn as int) as place_in_group, cast(floor((rn - 1) / 5) as bigint) as turn from (select event_id, event_type, row_number() over (partition by event_type order by ts, event_id) as rn from events) where rn <= 40""")
def q_round_robin(spark, d):
    return sampling.in_turns(table(spark, d, "events").select("event_id", "event_type", "ts"), "event_type", ["ts", "event_id"], 5, 40).drop("ts")


@query("""with r as (select event_id, event_type, row_number() over (partition by event_type order by ts, event_id) as place_in_group, count(*) over (partition by event_type) as n from events), t as (select *, case when place_in_group <= n - n % 5 then (place_in_group - 1) // 5 end as turn from r)
select event_id, event_type, place_in_group, turn, row_number() over (order by turn nulls last, event_type nulls first, place_in_group) - 1 as position from t""")
def q_fair_schedule(spark, d):
    return sampling.fair_schedule(table(spark, d, "events").select("event_id", "event_type", "ts"), "event_type", ["ts", "event_id"], 5).drop("ts")


@query("""with m as (select source_media_row_number as id, coalesce(lower(nullif(regexp_extract(trim(media_identifier), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '')), '?') as host, coalesce(nullif(trim(media_publisher), ''), '?') as publisher, coalesce(nullif(trim(media_license), ''), '?') as licence from gbif_media),
s as (select *, count(*) over (partition by host) as n, row_number() over (partition by host, publisher, licence order by sha256('pilot:' || cast(id as varchar)), id) as turn from m), c as (select *, case when n >= 1000 then 100 when n >= 25 then 25 else n end as cap, row_number() over (partition by host order by turn, publisher, licence) as place from s)
select host, id, publisher, licence, cast(place as int) as place from c where place <= cap""")
def q_cycled_pick(spark, d):
    host = F.lower(F.nullif(F.regexp_extract(F.trim("media_identifier"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    m = _media(spark, d).select(F.col("source_media_row_number").alias("id"), F.coalesce(host, F.lit("?")).alias("host"), first_known(F.col("media_publisher"), missing="?").alias("publisher"), first_known(F.col("media_license"), missing="?").alias("licence"))
    # Hosts of 1,000 rows give 100, of 25 rows 25.
    picked = sampling.cycled_pick(m.withColumn("h", scalars.hash_order("pilot", F.col("id"))), "host", ["publisher", "licence"], ["h", "id"], [(1000, 100), (25, 25)])
    return picked.select("host", "id", "publisher", "licence", "place")


@query(f"""select source_media_row_number, canonical from (select source_media_row_number, canonical, row_number() over (partition by canonical order by ingested_at, source_media_row_number) as rn from {_URLS}) where rn = 1 and canonical is not null""")
def q_representative_per_url(spark, d):
    m = _media(spark, d).select("source_media_row_number", "ingested_at", canonical_url(F.col("media_identifier")).alias("canonical")).where(F.col("canonical").isNotNull())
    return joins.latest(m, ["canonical"], [F.col("ingested_at").asc(), F.col("source_media_row_number").asc()]).select("source_media_row_number", "canonical")


@query("""select source_ordinal, gid from (select source_ordinal, trim("gbifID") as gid, row_number() over (partition by trim("gbifID") order by ingested_at desc, source_ordinal desc) as rn from occurrence_source) where rn = 1""")
def q_latest_version(spark, d):
    o = _occ(spark, d).select("source_ordinal", F.trim("gbifID").alias("gid"), "ingested_at")
    return joins.latest(o, ["gid"], [F.col("ingested_at").desc(), F.col("source_ordinal").desc()]).select("source_ordinal", "gid")


@query("""select p_partkey, p_brand, round(rank() over (partition by p_brand order by p_size desc) + (count(*) over (partition by p_brand, p_size) - 1) / 2, 6) as average_rank from part""")
def q_average_rank(spark, d):
    return sampling.average_rank(table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), "p_brand", "p_size").select("p_partkey", "p_brand", F.round("average_rank", 6).alias("average_rank"))


@query("""select o_orderkey, o_custkey, cast(row_number() over w as int) as rank, round(o_totalprice - lead(o_totalprice) over w, 4) as margin, coalesce(o_totalprice = lag(o_totalprice) over w, false) as tied from orders window w as (partition by o_custkey order by o_totalprice desc, o_orderkey)""")
def q_margin_to_next(spark, d):
    out = sampling.margin_to_next(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"], "o_totalprice", "o_orderkey")
    return out.select("o_orderkey", "o_custkey", "rank", F.round("margin", 4).alias("margin"), "tied")


@query("""with per as (select l_returnflag, l_extendedprice as v, sum(l_quantity) as w from lineitem where l_quantity > 0 group by 1, 2), c as (select *, sum(w) over (partition by l_returnflag order by v rows unbounded preceding) as c, sum(w) over (partition by l_returnflag) as t from per)
select l_returnflag, min(v) as quantile from c where c >= t * 0.9 group by 1""")
def q_weighted_quantile(spark, d):
    return sampling.weighted_quantile(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", "l_quantity", 0.9)


@query("""with q as (select quantile_disc(s_acctbal, 0.25) as a, quantile_disc(s_acctbal, 0.75) as b from supplier) select s_suppkey, case when s_acctbal <= a then 'low' when s_acctbal >= b then 'high' else 'middle' end as stratum from supplier, q""")
def q_tail_strata(spark, d):
    return sampling.tail_strata(table(spark, d, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal").select("s_suppkey", "stratum")


@query("""select user_id, event_id from (select user_id, event_id, value, lag(value) over (partition by user_id order by ts, event_id) as b from events) where value <= b""")
def q_rising_check(spark, d):
    e = table(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.withColumn("b", F.lag("value").over(w)).where("value <= b").select("user_id", "event_id")


@query("""select event_id, event_type, count(*) over (partition by event_type) as n_of_type, round(value / sum(value) over (partition by event_type), 9) as share from events""")
def q_totals_over_partition(spark, d):
    """Group totals come from a map-side combined aggregate joined back, not from a window over a hot type."""
    e = table(spark, d, "events")
    totals = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_of_type"), F.sum("value").alias("t"))
    return e.join(totals, "event_type").select("event_id", "event_type", "n_of_type", F.round(F.col("value") / F.col("t"), 9).alias("share"))


@query("""select p_partkey, p_retailprice from part order by p_retailprice desc, p_partkey limit 10""")
def q_top_n(spark, d):
    return table(spark, d, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(10).select("p_partkey", "p_retailprice")


@query("""select s_name as name, 'supplier' as kind, s_acctbal as balance, null as segment from supplier union all select c_name, 'customer', c_acctbal, c_mktsegment from customer""")
def q_union_by_name(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))
    b = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""select distinct "taxonKey" as k from occurrence_source where "taxonKey" is not null except select distinct "acceptedTaxonKey" from occurrence_source""")
def q_set_difference(spark, d):
    o = _occ(spark, d)
    used = o.select(F.col("acceptedTaxonKey").alias("k")).where(F.col("k").isNotNull()).distinct()
    return o.select(F.col("taxonKey").alias("k")).where(F.col("k").isNotNull()).distinct().join(used, "k", "left_anti")


@query("""select user_id, event_type from (select user_id, event_type, row_number() over (partition by user_id order by ts, event_id) as rn from events) where rn = 1""")
def q_keep_first(spark, d):
    return sampling.keep_first(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_type")


# ---------------------------------------------------------------- scalar functions


@query(f"""select source_media_row_number, canonical, nullif(lower(split_part(split_part(split_part(split_part(coalesce(media_identifier, media_references, ''), '#', 1), '://', 2), '/', 1), '?', 1)), '') as platform,
  case when nullif(trim(media_identifier), '') is null then 'UNKNOWN' when canonical is not null and not contains(authority, '@') then 'PASS' else 'FAIL' end as url_status from {_URLS}""")
def q_urls(spark, d):
    u = F.col("media_identifier")
    return _media(spark, d).select("source_media_row_number", canonical_url(u).alias("canonical"), scalars.platform(F.coalesce(u, F.col("media_references"))).alias("platform"), scalars.url_status(u).alias("url_status"))


@query("""select source_media_row_number, case when m is null or p is null then 'UNKNOWN' when starts_with(m, p) then 'PASS' else 'CONFLICT' end as format_status from (select source_media_row_number, lower(nullif(trim(media_format), '')) as m,
  case lower(trim(media_type)) when 'stillimage' then 'image/' when 'movingimage' then 'video/' when 'sound' then 'audio/' end as p from gbif_media)""")
def q_format_status(spark, d):
    return _media(spark, d).select("source_media_row_number", scalars.format_status(F.col("media_type"), F.col("media_format")).alias("format_status"))


@query("""select source_ordinal, 'sha256:' || sha256(concat_ws(chr(31), coalesce("gbifID", '<NULL>'), coalesce("eventDate", '<NULL>'), coalesce(species, '<NULL>'))) as row_hash, hex(unhex(sha256('gbifID|' || trim("gbifID")))) as id_digest from occurrence_source""")
def q_hashes(spark, d):
    return _occ(spark, d).select("source_ordinal", scalars.tagged_hash(None, scalars.row_text(F.col("gbifID"), F.col("eventDate"), F.col("species"))).alias("row_hash"), F.hex(F.unhex(F.sha2(F.concat(F.lit("gbifID|"), F.trim("gbifID")), 256))).alias("id_digest"))


@query(r"""with t as (select source_ordinal, nullif(trim("eventDate"), '') as e, string_split(trim("eventDate"), '/') as p from occurrence_source),
g as (select *, list_transform(p, lambda x: regexp_full_match(x, '[0-9]{4}') or regexp_full_match(x, '[0-9]{4}-(0[1-9]|1[0-2])') or (regexp_full_match(x, '[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9]{2}:[0-9]{2}(:[0-9]{2})?Z?)?') and try_cast(substr(x, 1, 10) as date) is not null)) as ok from t)
select source_ordinal, case when e is null then 'UNKNOWN' when len(p) <= 2 and list_bool_and(ok) and not coalesce(len(p) = 2 and try_cast(substr(p[1], 1, 10) as date) > try_cast(substr(p[2], 1, 10) as date), false) then 'PASS' else 'FAIL' end as event_date_status from g""")
def q_event_date_status(spark, d):
    return _occ(spark, d).select("source_ordinal", scalars.event_date_status(F.col("eventDate")).alias("event_date_status"))


@query(r"""with t as (select source_ordinal, nullif(trim("eventDate"), '') as e, string_split(trim("eventDate"), '/') as p, trim(string_split(trim("eventDate"), '/')[1]) as a, trim(string_split(trim("eventDate"), '/')[2]) as b from occurrence_source),
g as (select *, regexp_full_match(a, '[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9]{2}:[0-9]{2}(:[0-9]{2})?)?') as sa, regexp_full_match(b, '[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9]{2}:[0-9]{2}(:[0-9]{2})?)?') as sb, try_cast(substr(a, 1, 10) as date) as fa, try_cast(substr(b, 1, 10) as date) as fb from t),
s as (select *, case when e is null then 'missing_event_date' when regexp_full_match(e, '[0-9]{4}(-[0-9]{2})?') then 'insufficient_precision' when len(p) > 2 or not sa then 'unsupported_format' when fa is null then 'invalid_calendar_date'
  when len(p) = 2 and not sb then 'unsupported_format' when len(p) = 2 and fb is null then 'invalid_calendar_date' when len(p) = 2 and fa > fb then 'reversed_interval' when year(fa) < 1960 then 'excluded_pre_1960' else 'derived' end as status from g)
select source_ordinal, status, case when status in ('derived', 'excluded_pre_1960') then cast(year(fa) as int) end as derived_year, case when status in ('derived', 'excluded_pre_1960') then cast(month(fa) as int) end as derived_month, case when status in ('derived', 'excluded_pre_1960') then cast(day(fa) as int) end as derived_day,
  case when status in ('derived', 'excluded_pre_1960') then 'event_date_' || case when len(p) = 2 then 'interval_start_' else 'single_' end || case when contains(a, 'T') then 'timestamp' else 'date' end end as method from s""")
def q_temporal_components(spark, d):
    none = F.lit(None).cast("string")
    out = _occ(spark, d).select("source_ordinal", scalars.derived_components(F.col("eventDate"), none, none, none).alias("t"))
    return out.select("source_ordinal", "t.status", "t.derived_year", "t.derived_month", "t.derived_day", "t.method")


@query("""select source_ordinal, case when regexp_matches(string_split(regexp_replace(trim("scientificName"), '\\s+', ' ', 'g'), ' ')[1], '^[A-Z][a-z-]+$') and regexp_matches(string_split(regexp_replace(trim("scientificName"), '\\s+', ' ', 'g'), ' ')[2], '^[a-z][a-z-]+$')
  then string_split(regexp_replace(trim("scientificName"), '\\s+', ' ', 'g'), ' ')[1] || ' ' || string_split(regexp_replace(trim("scientificName"), '\\s+', ' ', 'g'), ' ')[2] end as binomial from occurrence_source""".replace("\\\\", "\\"))
def q_binomial(spark, d):
    return _occ(spark, d).select("source_ordinal", scalars.binomial(F.col("scientificName")).alias("binomial"))


@query("""select media_license, case when lower(media_license) like 'cc by-nc%' or lower(media_license) like 'cc-by-nc%' then 'cc-by-nc' when lower(media_license) like 'cc by%' then 'cc-by' when lower(media_license) like 'cc0%' then 'cc0' when lower(media_license) like 'all rights%' then 'copyright' end as family,
  nullif(regexp_extract(media_license, '([0-9]\\.[0-9])', 1), '') as version, case when media_license is null then 'QUARANTINED' when lower(media_license) like 'all rights%' then 'DENIED' when lower(media_license) like '%nc%' then 'RESEARCH_ONLY' else 'ALLOWED' end as policy, count(*) as n
from gbif_media group by all""".replace("\\\\", "\\"))
def q_licences(spark, d):
    m = _media(spark, d).groupBy("media_license").agg(F.count(F.lit(1)).alias("n")).withColumn("l", names.licence(F.col("media_license")))
    return m.select("media_license", "l.family", "l.version", "l.policy", "n")


@query("""select distinct name_key, n from (select regexp_replace(lower(trim("scientificName")), '\\s*([,;:/()-])\\s*', '\\1', 'g') as name_key, count(*) as n from occurrence_source where "scientificName" is not null group by 1)""")
def q_name_key(spark, d):
    per = _occ(spark, d).where(F.col("scientificName").isNotNull()).groupBy("scientificName").agg(F.count(F.lit(1)).alias("n"))
    return per.select(names.name_key(F.col("scientificName")).alias("name_key"), "n").groupBy("name_key").agg(F.sum("n").alias("n")).distinct()


@query("""select lang, case when len = 2 then low when low in ('eng', 'deu', 'ger', 'fra', 'fre', 'spa', 'por', 'jpn') then case low when 'ger' then 'de' when 'deu' then 'de' when 'spa' then 'es' when 'por' then 'pt' when 'jpn' then 'ja' else left(low, 2) end when len = 3 then low end as language,
  cast(null as varchar) as script, cast(null as varchar) as region, case when len in (2, 3) then case low when 'ger' then 'de' else low end end as tag, n
from (select lang, lower(trim(lang)) as low, length(trim(lang)) as len, count(*) as n from documents group by all)""")
def q_language_tags(spark, d):
    per = table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return per.select("lang", names.language_tag(F.col("lang")).alias("t"), "n").select("lang", "t.*", "n")


@query(lists=('stated', 'denied'))
def q_controlled_terms(spark, d):
    extract = names.term_extractor({"larva": r"\blarva[e]?\b|\braupen?\b|\borugas?\b|\blagartas?\b|\bchenilles?\b", "pupa": r"\bpupa\b|\bcris[aá]lida\b|\bchrysalide\b", "coordinates": r"\bcoordinates?\b|\bkoordinaten\b"})
    docs = table(spark, d, "documents").select("doc_id", extract(F.col("text")).alias("t"))
    return docs.select("doc_id", "t.stated", "t.denied").where((F.size("stated") > 0) | (F.size("denied") > 0))


@query("""select event_id, 'sha256:' || sha256(cast(json(props) as varchar)) as fingerprint from events""")
def q_json_fingerprint(spark, d):
    return table(spark, d, "events").select("event_id", names.json_fingerprint(F.col("props")).alias("fingerprint"))


@query("""select event_id, cast(json_extract(props, '$.k') as bigint) as k, ts::date as day, cast(datediff('day', ts::date, date '2024-02-01') as int) as age_days, case when datediff('day', ts::date, date '2024-02-01') > 14 then 'FAIL' when ts > timestamp '2024-02-01' then 'CONFLICT' else 'PASS' end as freshness from events""")
def q_json_and_freshness(spark, d):
    now = F.lit("2024-02-01").cast("date")
    age = F.datediff(now, F.to_date("ts"))
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"), F.to_date("ts").alias("day"), age.alias("age_days"), scalars.ladder((age > 14, "FAIL"), (age < 0, "CONFLICT"), otherwise="PASS").alias("freshness"))


@query("""select source_ordinal, list_filter([case when trim("decimalLatitude") is null then 'no_latitude' end, case when nullif(trim("countryCode"), '') is null then 'no_country' end, case when "eventDate" is null then 'no_date' end, case when is_deleted then 'deleted' end], lambda x: x is not null) as reasons from occurrence_source""", lists=('reasons',))
def q_reason_codes(spark, d):
    return _occ(spark, d).select("source_ordinal", scalars.reasons({"no_latitude": F.trim("decimalLatitude").isNull(), "no_country": nonblank(F.col("countryCode")).isNull(), "no_date": F.col("eventDate").isNull(), "deleted": F.col("is_deleted")}).alias("reasons"))


@query("""select doc_id, list_filter([case when regexp_matches(lower(text), '\\b(larva|larvae|caterpillar)\\b') then 'early' end, case when regexp_matches(lower(text), '\\b(museum|specimen|specimens|drawer)\\b') then 'collection' end, case when regexp_matches(lower(text), '\\b(photograph|photographs|camera|image)\\b') then 'picture' end], lambda x: x is not null) as hints from documents where text is not null""".replace("\\\\", "\\"), lists=('hints',))
def q_keyword_flags(spark, d):
    groups = {"early": ["larva", "larvae", "caterpillar"], "collection": ["museum", "specimen", "specimens", "drawer"], "picture": ["photograph", "photographs", "camera", "image"]}
    return table(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", scalars.keyword_flags(F.col("text"), groups).alias("hints"))


@query("""select c_custkey, case when regexp_matches(v, '^[=+@-]') then '''' || v else v end as safe from (select c_custkey, cast(c_acctbal as decimal(12, 2))::varchar as v from customer)""")
def q_csv_safe(spark, d):
    return table(spark, d, "customer").select("c_custkey", scalars.csv_safe(F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("safe"))


# ---------------------------------------------------------------- further joins, orders and mappings


@query("""select l_orderkey, l_linenumber from lineitem join orders on l_orderkey = o_orderkey and l_shipdate > o_orderdate + interval 60 day where l_quantity * 1000 < o_totalprice""")
def q_residual_join(spark, d):
    """An equi-join with inequalities left over: the key shuffles, the rest filters."""
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    met = li.join(o, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 60 days")))
    return met.where(F.col("l_quantity") * 1000 < F.col("o_totalprice")).select("l_orderkey", "l_linenumber")


@query("""select source_ordinal, cast(row_number() over (partition by "datasetKey" order by try_cast("coordinateUncertaintyInMeters" as double) asc nulls last, "eventDate" desc nulls last, source_ordinal) as int) as place from occurrence_source""")
def q_queue_order(spark, d):
    rows = _occ(spark, d).select("source_ordinal", "datasetKey", "eventDate", F.col("coordinateUncertaintyInMeters").try_cast("double").alias("u"))
    placed = sampling.places(rows, "datasetKey", [F.col("u").asc_nulls_last(), F.col("eventDate").desc_nulls_last(), F.col("source_ordinal").asc()])
    return placed.select("source_ordinal", F.col("place_in_group").cast("int").alias("place"))


@query("""select source_ordinal, case "basisOfRecord" when 'HUMAN_OBSERVATION' then 'T1' when 'PRESERVED_SPECIMEN' then 'T2' when 'MACHINE_OBSERVATION' then 'T3' else 'T5' end as tier,
  coalesce(case "basisOfRecord" when 'HUMAN_OBSERVATION' then 'T1' when 'PRESERVED_SPECIMEN' then 'T2' end, 'T5') || ':' || coalesce("taxonRank", '') as label from occurrence_source""")
def q_mapping_and_tiers(spark, d):
    """Replacement by a map and a label from parts; what the map does not know falls to the last tier."""
    tiers = F.create_map(*[F.lit(x) for x in ("HUMAN_OBSERVATION", "T1", "PRESERVED_SPECIMEN", "T2", "MACHINE_OBSERVATION", "T3")])
    high = F.create_map(*[F.lit(x) for x in ("HUMAN_OBSERVATION", "T1", "PRESERVED_SPECIMEN", "T2")])
    b = F.col("basisOfRecord")
    return _occ(spark, d).select("source_ordinal", F.coalesce(F.try_element_at(tiers, b), F.lit("T5")).alias("tier"), F.concat_ws(":", F.coalesce(F.try_element_at(high, b), F.lit("T5")), F.coalesce("taxonRank", F.lit(""))).alias("label"))


@query("""with f as (select field, status, count(*) as n from (
  select unnest(['identity', 'taxon', 'place']) as field, unnest([case when "gbifID" is null then 'FAIL' else 'PASS' end, case when species is null then 'UNKNOWN' else 'PASS' end, case when nullif(trim("decimalLatitude"), '') is null then 'UNKNOWN' when try_cast(trim("decimalLatitude") as double) is null then 'FAIL' else 'PASS' end]) as status from occurrence_source) where status <> 'PASS' group by 1, 2)
select * from f""")
def q_failure_breakdown(spark, d):
    """Rows per check and failing status, from one pass that unpivots the statuses."""
    lat = F.trim("decimalLatitude")
    o = _occ(spark, d).select(
        scalars.ladder((F.col("gbifID").isNull(), "FAIL"), otherwise="PASS").alias("identity"),
        scalars.ladder((F.col("species").isNull(), "UNKNOWN"), otherwise="PASS").alias("taxon"),
        scalars.ladder((nonblank(lat).isNull(), "UNKNOWN"), (lat.try_cast("double").isNull(), "FAIL"), otherwise="PASS").alias("place"),
    )
    return aggregates.status_summary(o, ["identity", "taxon", "place"]).where("status <> 'PASS'")


@query("""select metric, n, status from (select 'rows' as metric, count(*) as n, 'PASS' as status from gbif_media union all select 'records', count(distinct trim("gbifID")), 'PASS' from gbif_media
  union all select 'urls', count(distinct trim(media_identifier)), 'PASS' from gbif_media union all select 'contents', null, 'NOT_TESTED')""")
def q_coverage_metrics(spark, d):
    """Counts of a table as rows, with the measures that are not made named as such."""
    one = _media(spark, d).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.trim("gbifID")).alias("records"), F.count_distinct(F.trim("media_identifier")).alias("urls"))
    stack = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("n"), F.lit("PASS").alias("status")) for m in ("rows", "records", "urls")], F.struct(F.lit("contents").alias("metric"), F.lit(None).cast("bigint").alias("n"), F.lit("NOT_TESTED").alias("status")))
    return one.select(F.inline(stack))


# ---------------------------------------------------------------- loading with rejects


@query("""select c_custkey, case when c_custkey % 7 = 0 or c_custkey % 11 = 0 then 'line:field_count' when c_custkey % 13 = 0 then 'line:quoting' when c_custkey % 5 = 0 then 'balance:not_a_number' end as problem,
  case when not (c_custkey % 7 = 0 or c_custkey % 11 = 0 or c_custkey % 13 = 0 or c_custkey % 5 = 0) then c_name end as name,
  case when not (c_custkey % 7 = 0 or c_custkey % 11 = 0 or c_custkey % 13 = 0 or c_custkey % 5 = 0) then c_acctbal end as balance from customer""")
def q_load_with_rejects(spark, d):
    """The customers as a delimited file with a header, some lines short, long, badly quoted or with
    a broken number, loaded again: each line comes out as a row or as a reject."""
    c, key = table(spark, d, "customer"), F.col("c_custkey")
    name = F.when(key % 13 == 0, F.concat(F.lit('"'), F.col("c_name"))).when(key % 3 == 0, F.concat(F.lit('"'), F.col("c_name"), F.lit('"'))).otherwise(F.col("c_name"))
    balance = F.when(key % 5 == 0, F.lit("much")).otherwise(F.col("c_acctbal").cast("string"))
    # A wrong number of fields is seen before wrong values, broken quoting before both.
    name = F.when((key % 7 == 0) | (key % 11 == 0), F.col("c_name")).otherwise(name)
    line = F.concat_ws("|", key, name, F.when(key % 7 != 0, balance), F.when((key % 7 != 0) & (key % 11 == 0), F.lit("more")))
    at = f"{shared_dir(spark)}/delimited-{uuid.uuid4().hex}"
    c.select(line.alias("value")).write.text(at)
    contract = Contract((Field("key", "digits", required=True), Field("name"), Field("balance", "decimal", low=-1e12, high=1e12)), "|")
    rows, bad = readers.load_delimited(spark, at, contract)
    whole = rows.select(F.col("key").alias("c_custkey"), F.lit(None).cast("string").alias("problem"), "name", "balance")
    rejected = bad.select(F.split_part("line", F.lit("|"), F.lit(1)).cast("bigint").alias("c_custkey"), F.col("errors")[0].alias("problem"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("double").alias("balance"))
    return whole.unionByName(rejected)
