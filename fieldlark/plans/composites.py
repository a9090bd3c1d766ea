"""Composite queries: quality statuses, readiness, wide joins, hierarchies, components, vectors, evaluation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlark.functions import geo, names, scalars, vectors
from fieldlark.functions.scalars import first_known, ladder, nonblank, worst_status
from fieldlark.operators import aggregates, evaluation, graph, registry, similarity
from fieldlark.plans.register import Register
from fieldlark.session import table

query = Register()
QUERIES, SQL = query.queries, query.sql

# ---------------------------------------------------------------- quality statuses

# The names of statuses and of kinds of record basis.
_STATUS_SQL = r"""
with base as (select trim("gbifID") as gid, count(*) as n,
    min(nullif(trim("datasetKey"), '')) as ds, max(nullif(trim("datasetKey"), '')) as ds2, count(*) filter (nullif(trim("datasetKey"), '') is null) as ds0,
    min(nullif(trim("basisOfRecord"), '')) as bs, max(nullif(trim("basisOfRecord"), '')) as bs2, count(*) filter (nullif(trim("basisOfRecord"), '') is null) as bs0,
    min(nullif(trim("eventDate"), '')) as ev, max(nullif(trim("eventDate"), '')) as ev2, count(*) filter (nullif(trim("eventDate"), '') is null) as ev0,
    min(nullif(trim("decimalLatitude"), '')) as la, max(nullif(trim("decimalLatitude"), '')) as la2, count(*) filter (nullif(trim("decimalLatitude"), '') is null) as la0,
    min(nullif(trim("decimalLongitude"), '')) as lo, max(nullif(trim("decimalLongitude"), '')) as lo2, count(*) filter (nullif(trim("decimalLongitude"), '') is null) as lo0,
    min(nullif(trim("taxonKey"), '')) as tk, min(nullif(trim("acceptedTaxonKey"), '')) as ak, min(nullif(trim(species), '')) as sp, min(nullif(trim(genus), '')) as ge
  from occurrence_source group by 1),
s as (select gid, n,
  case when regexp_full_match(gid, '[0-9]+') then 'PASS' else 'FAIL' end as id_status,
  case when ds is null then 'UNKNOWN' when ds <> ds2 or ds0 > 0 then 'CONFLICT' when regexp_full_match(ds, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}') then 'PASS' else 'FAIL' end as dataset_status,
  case when bs is null then 'UNKNOWN' when bs <> bs2 or bs0 > 0 then 'CONFLICT' when upper(bs) in ('HUMAN_OBSERVATION', 'MACHINE_OBSERVATION', 'PRESERVED_SPECIMEN', 'MATERIAL_SAMPLE', 'LIVING_SPECIMEN', 'FOSSIL_SPECIMEN', 'MATERIAL_CITATION', 'OBSERVATION', 'OCCURRENCE') then 'PASS' else 'FAIL' end as basis_status,
  case when coalesce(la <> la2, false) or (la is not null and la0 > 0) or coalesce(lo <> lo2, false) or (lo is not null and lo0 > 0) then 'CONFLICT' when la is null and lo is null then 'UNKNOWN' when la is null or lo is null then 'FAIL'
    when coalesce(try_cast(la as double) between -90 and 90 and try_cast(lo as double) between -180 and 180, false) then 'PASS' else 'FAIL' end as coordinate_status,
  case when tk is null then 'NOT_APPLICABLE' when ak is null then 'UNKNOWN' when try_cast(tk as bigint) is null or try_cast(ak as bigint) is null then 'FAIL' else 'PASS' end as taxon_key_status,
  case when sp is null and ge is null then 'UNKNOWN' when sp is not null and ge is not null and not starts_with(lower(sp), lower(ge) || ' ') then 'CONFLICT' else 'PASS' end as hierarchy_status from base)
"""
_STATUSES = ("id_status", "dataset_status", "basis_status", "coordinate_status", "taxon_key_status", "hierarchy_status")


def occurrence_quality(occ: DataFrame) -> DataFrame:
    """One row per record id with a status per check and the worst of them."""
    fields = {"ds": "datasetKey", "bs": "basisOfRecord", "la": "decimalLatitude", "lo": "decimalLongitude"}
    aggs = [a for k, c in fields.items() for a in (F.min(nonblank(F.col(c))).alias(k), F.max(nonblank(F.col(c))).alias(f"{k}2"), F.count_if(nonblank(F.col(c)).isNull()).alias(f"{k}0"))]
    base = occ.groupBy(F.trim("gbifID").alias("gid")).agg(F.count(F.lit(1)).alias("n"), *aggs, *[F.min(nonblank(F.col(c))).alias(k) for k, c in (("tk", "taxonKey"), ("ak", "acceptedTaxonKey"), ("sp", "species"), ("ge", "genus"))])

    def clash(k: str):
        return F.coalesce(F.col(k) != F.col(f"{k}2"), F.lit(False)) | (F.col(k).isNotNull() & (F.col(f"{k}0") > 0))

    c = {k: F.col(k) for k in ("ds", "bs", "la", "lo", "tk", "ak", "sp", "ge")}
    # Kinds of record basis.
    kinds = ["HUMAN_OBSERVATION", "MACHINE_OBSERVATION", "PRESERVED_SPECIMEN", "MATERIAL_SAMPLE", "LIVING_SPECIMEN", "FOSSIL_SPECIMEN", "MATERIAL_CITATION", "OBSERVATION", "OCCURRENCE"]
    inside = F.coalesce(c["la"].try_cast("double").between(-90, 90) & c["lo"].try_cast("double").between(-180, 180), F.lit(False))
    return base.withColumns(
        {
            "id_status": ladder((F.col("gid").rlike("^[0-9]+$"), "PASS"), otherwise="FAIL"),
            "dataset_status": ladder((c["ds"].isNull(), "UNKNOWN"), (clash("ds"), "CONFLICT"), (c["ds"].rlike("^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), "PASS"), otherwise="FAIL"),
            "basis_status": ladder((c["bs"].isNull(), "UNKNOWN"), (clash("bs"), "CONFLICT"), (F.upper(c["bs"]).isin(*kinds), "PASS"), otherwise="FAIL"),
            "coordinate_status": ladder((clash("la") | clash("lo"), "CONFLICT"), (c["la"].isNull() & c["lo"].isNull(), "UNKNOWN"), (c["la"].isNull() | c["lo"].isNull(), "FAIL"), (inside, "PASS"), otherwise="FAIL"),
            "taxon_key_status": ladder((c["tk"].isNull(), "NOT_APPLICABLE"), (c["ak"].isNull(), "UNKNOWN"), (c["tk"].try_cast("bigint").isNull() | c["ak"].try_cast("bigint").isNull(), "FAIL"), otherwise="PASS"),
            "hierarchy_status": ladder((c["sp"].isNull() & c["ge"].isNull(), "UNKNOWN"), (F.coalesce(~F.lower(c["sp"]).startswith(F.concat(F.lower(c["ge"]), F.lit(" "))), F.lit(False)), "CONFLICT"), otherwise="PASS"),
        }
    ).select("gid", "n", *_STATUSES, worst_status([F.col(s) for s in _STATUSES]).alias("overall_status"))


@query(
    _STATUS_SQL
    + f"""select gid, n, {', '.join(_STATUSES)}, case when list_contains([{', '.join(_STATUSES)}], 'CONFLICT') then 'CONFLICT' when list_contains([{', '.join(_STATUSES)}], 'FAIL') then 'FAIL'
  when list_contains([{', '.join(_STATUSES)}], 'UNKNOWN') then 'UNKNOWN' else 'PASS' end as overall_status from s"""
)
def c_occurrence_quality(spark, d):
    return occurrence_quality(table(spark, d, "occurrence_source"))


@query(_STATUS_SQL + " union all ".join(f"select '{s}' as field, {s} as status, count(*) as n from s group by 2" for s in _STATUSES))
def c_status_summary(spark, d):
    return aggregates.status_summary(occurrence_quality(table(spark, d, "occurrence_source")), _STATUSES)


@query(
    _STATUS_SQL
    + """, m as (select source_media_row_number as id, trim("gbifID") as gid, case when nullif(trim(media_identifier), '') is null then 'UNKNOWN' when regexp_matches(trim(media_identifier), '^(?i:https?)://[^/?#@]+') then 'PASS' else 'FAIL' end as url_ok,
  case when media_license is null then 'UNKNOWN' when lower(media_license) like 'all rights%' then 'FAIL' else 'PASS' end as rights_ok from gbif_media)
select id, url_ok, rights_ok, coalesce(coordinate_status, 'UNKNOWN') as place_ok,
  case when 'FAIL' in (url_ok, rights_ok, coalesce(coordinate_status, 'UNKNOWN')) then 'FAIL' when 'CONFLICT' = coalesce(coordinate_status, 'UNKNOWN') then 'CONFLICT' when 'UNKNOWN' in (url_ok, rights_ok, coalesce(coordinate_status, 'UNKNOWN')) then 'UNKNOWN' else 'PASS' end as readiness,
  list_filter([case when url_ok <> 'PASS' then 'url' end, case when rights_ok <> 'PASS' then 'rights' end, case when coalesce(coordinate_status, 'UNKNOWN') <> 'PASS' then 'place' end], lambda x: x is not null) as reasons
from m left join s using (gid)""", lists=('reasons',))
def c_readiness_ladder(spark, d):
    """Media rows with a status per gate, derived from theirs and from their record's checks."""
    url = F.col("media_identifier")
    media = table(spark, d, "gbif_media").select(
        F.col("source_media_row_number").alias("id"), F.trim("gbifID").alias("gid"), scalars.url_status(url).alias("url_ok"),
        ladder((F.col("media_license").isNull(), "UNKNOWN"), (names.licence(F.col("media_license"))["family"] == "copyright", "FAIL"), otherwise="PASS").alias("rights_ok"),
    )
    place = occurrence_quality(table(spark, d, "occurrence_source")).select("gid", "coordinate_status")
    out = media.join(place, "gid", "left").withColumn("place_ok", F.coalesce("coordinate_status", F.lit("UNKNOWN")))
    all_ = F.array("url_ok", "rights_ok", "place_ok")
    ready = ladder((F.array_contains(all_, "FAIL"), "FAIL"), (F.array_contains(all_, "CONFLICT"), "CONFLICT"), (F.array_contains(all_, "UNKNOWN"), "UNKNOWN"), otherwise="PASS")
    return out.select("id", "url_ok", "rights_ok", "place_ok", ready.alias("readiness"), scalars.reasons({"url": F.col("url_ok") != "PASS", "rights": F.col("rights_ok") != "PASS", "place": F.col("place_ok") != "PASS"}).alias("reasons"))


@query("""with p as (select coalesce(nullif(trim(publisher), ''), '<MISSING>') as provider, count(*) as n, min(ingested_at) as first_seen, max(ingested_at) as last_seen from occurrence_source group by 1)
select provider, n, first_seen, last_seen, cast(datediff('day', last_seen::date, date '2026-03-18') as int) as age_days, case when datediff('day', last_seen::date, date '2026-03-18') > 30 then 'FAIL' else 'PASS' end as freshness from p""")
def c_freshness(spark, d):
    per = table(spark, d, "occurrence_source").groupBy(first_known(F.col("publisher")).alias("provider")).agg(F.count(F.lit(1)).alias("n"), F.min("ingested_at").alias("first_seen"), F.max("ingested_at").alias("last_seen"))
    age = F.datediff(F.lit("2026-03-18").cast("date"), F.to_date("last_seen"))
    return per.withColumns({"age_days": age, "freshness": ladder((age > 30, "FAIL"), otherwise="PASS")})


@query("""with m as (select lower(trim(media_identifier)) as u, source_media_row_number as id, media_license, media_creator from gbif_media where trim(media_identifier) <> '')
select u as url, count(*) as n_rows, min(id) as first_row, count(distinct media_license) as n_licences, count(distinct media_creator) as n_creators, case when count(distinct media_license) > 1 then 'CONFLICT' when count(*) > 1 then 'SHARED' else 'SINGLE' end as resource_status from m group by 1""")
def c_media_resources(spark, d):
    m = table(spark, d, "gbif_media").where(F.trim("media_identifier") != "").withColumn("url", F.lower(F.trim("media_identifier")))
    per = m.groupBy("url").agg(F.count(F.lit(1)).alias("n_rows"), F.min("source_media_row_number").alias("first_row"), F.count_distinct("media_license").alias("n_licences"), F.count_distinct("media_creator").alias("n_creators"))
    return per.withColumn("resource_status", ladder((F.col("n_licences") > 1, "CONFLICT"), (F.col("n_rows") > 1, "SHARED"), otherwise="SINGLE"))


@query("""with last as (select trim("gbifID") as gid, arg_max({'species': species, 'country': "countryCode", 'dataset': "datasetKey"}, (ingested_at, source_ordinal)) as occurrence from occurrence_source group by 1),
img as (select lower(trim(source_object_uri)) as u, count(*) as n_images from reference_media_objects where source_object_uri is not null group by 1)
select source_media_row_number, occurrence.species as species, occurrence.country as country, occurrence.dataset as dataset, coalesce(n_images, 0) as n_images from gbif_media m left join last on last.gid = trim(m."gbifID") left join img on img.u = lower(trim(m.media_identifier))""")
def c_final_wide_join(spark, d):
    """Every media row once, with its record's newest version as a struct and its images."""
    occ = table(spark, d, "occurrence_source")
    newest = occ.groupBy(F.trim("gbifID").alias("gid")).agg(F.max_by(F.struct("species", F.col("countryCode").alias("country"), F.col("datasetKey").alias("dataset")), F.struct("ingested_at", "source_ordinal")).alias("occurrence"))
    images = table(spark, d, "reference_media_objects").where(F.col("source_object_uri").isNotNull()).groupBy(F.lower(F.trim("source_object_uri")).alias("u")).agg(F.count(F.lit(1)).alias("n"))
    media = table(spark, d, "gbif_media").select("source_media_row_number", F.trim("gbifID").alias("gid"), F.lower(F.trim("media_identifier")).alias("u"))
    return media.join(newest, "gid", "left").join(images, "u", "left").select("source_media_row_number", "occurrence.*", F.coalesce("n", F.lit(0)).alias("n_images"))


@query("""with d as (select distinct species, "acceptedTaxonKey" as k from occurrence_source where species is not null), r as (select species, min("acceptedTaxonKey") as only_key, count(distinct "acceptedTaxonKey") as n from occurrence_source where species is not null and "acceptedTaxonKey" is not null group by 1)
select source_ordinal, case when o."acceptedTaxonKey" is not null then 'KEY' when r.n = 1 then 'NAME' else 'UNMATCHED' end as matched_by, coalesce(o."acceptedTaxonKey", case when r.n = 1 then only_key end) as resolved_key from occurrence_source o left join r using (species)""")
def c_match_key_then_unique_name(spark, d):
    """A key decides; without one a name does, if it names one taxon only."""
    occ = table(spark, d, "occurrence_source").select("source_ordinal", "species", "acceptedTaxonKey")
    by_name = occ.where(F.col("species").isNotNull() & F.col("acceptedTaxonKey").isNotNull()).groupBy("species").agg(F.min("acceptedTaxonKey").alias("only_key"), F.count_distinct("acceptedTaxonKey").alias("n"))
    out = occ.join(by_name, "species", "left")
    unique = F.coalesce(F.col("n") == 1, F.lit(False))
    return out.select("source_ordinal", ladder((F.col("acceptedTaxonKey").isNotNull(), "KEY"), (unique, "NAME"), otherwise="UNMATCHED").alias("matched_by"), F.coalesce("acceptedTaxonKey", F.when(unique, F.col("only_key"))).alias("resolved_key"))


@query("""select reason, count(*) as n from (select case when is_deleted then 'deleted' when nullif(trim("decimalLatitude"), '') is null then 'no_coordinates' when try_cast(trim("decimalLatitude") as double) is null then 'unreadable_coordinates' when nullif(trim("countryCode"), '') is null then 'no_country' else 'kept' end as reason from occurrence_source) group by 1""")
def c_funnel(spark, d):
    lat = F.trim("decimalLatitude")
    reason = ladder((F.col("is_deleted"), "deleted"), (nonblank(lat).isNull(), "no_coordinates"), (lat.try_cast("double").isNull(), "unreadable_coordinates"), (nonblank(F.col("countryCode")).isNull(), "no_country"), otherwise="kept")
    return table(spark, d, "occurrence_source").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("""select source_ordinal, 'countryCode' as target_field, "countryCode" as original_value, m.mode as derived_value, 'dataset_mode' as method from occurrence_source o join (
  select "datasetKey", mode from (select "datasetKey", "countryCode" as mode, row_number() over (partition by "datasetKey" order by count(*) desc, "countryCode") as rn from occurrence_source where "countryCode" is not null group by 1, 2) where rn = 1) m using ("datasetKey") where o."countryCode" is null""")
def c_derived_assertions(spark, d):
    """Sparse assertions: a missing country takes the commonest one of its dataset."""
    occ = table(spark, d, "occurrence_source").select("source_ordinal", "datasetKey", "countryCode")
    mode = aggregates.mode_with_support(occ, ["datasetKey"], "countryCode").select("datasetKey", "mode")
    return occ.where(F.col("countryCode").isNull()).join(mode, "datasetKey").select("source_ordinal", F.lit("countryCode").alias("target_field"), F.col("countryCode").alias("original_value"), F.col("mode").alias("derived_value"), F.lit("dataset_mode").alias("method"))


# ---------------------------------------------------------------- geography


@query("""with p as (select source_ordinal, try_cast(trim("decimalLatitude") as double) as lat, try_cast(trim("decimalLongitude") as double) as lon from occurrence_source), ok as (select * from p where lat between -90 and 90 and lon between -180 and 180),
h as (select *, pow(sin(radians(lat - 10) / 2), 2) + cos(radians(10)) * cos(radians(lat)) * pow(sin(radians(lon - 20) / 2), 2) as h from ok)
select source_ordinal, round(2 * 6371.007180918475 * atan2(sqrt(h), sqrt(greatest(0, 1 - h))), 6) as km, cast(floor((lon + 180) - 360 * floor((lon + 180) / 360)) as bigint) as east_degree,
  '4/' || least(cast(floor((lat + 90) / 5.625) as bigint), 31) || '/' || cast(floor(((lon + 180) - 360 * floor((lon + 180) / 360)) / 5.625) as bigint) as cell,
  '3/' || (least(cast(floor((lat + 90) / 5.625) as bigint), 31) // 2) || '/' || (cast(floor(((lon + 180) - 360 * floor((lon + 180) / 360)) / 5.625) as bigint) // 2) as parent from h""")
def c_geography(spark, d):
    p = table(spark, d, "occurrence_source").select("source_ordinal", F.trim("decimalLatitude").try_cast("double").alias("lat"), F.trim("decimalLongitude").try_cast("double").alias("lon")).where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    lat, lon = F.col("lat"), F.col("lon")
    cell = geo.cell(lat, lon, 4)
    return p.select("source_ordinal", F.round(geo.haversine_km(F.lit(10.0), F.lit(20.0), lat, lon), 6).alias("km"), F.floor(geo.wrapped_longitude(lon) + 180).alias("east_degree"), cell.alias("cell"), geo.parent(cell).alias("parent"))


def occupied_clusters(occ: DataFrame, resolution: int, least: int) -> DataFrame:
    """``cell, n, component``: cells with at least ``least`` points, joined over shared borders and corners."""
    p = occ.select(F.trim("decimalLatitude").try_cast("double").alias("lat"), F.trim("decimalLongitude").try_cast("double").alias("lon")).where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    cells = p.groupBy(geo.cell(F.col("lat"), F.col("lon"), resolution).alias("cell")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    edges = cells.select("cell", F.explode(geo.neighbours(F.col("cell"))).alias("other")).join(cells.select(F.col("cell").alias("other")), "other", "left_semi")
    return cells.join(graph.same_component(edges, "cell", "other").withColumnRenamed("node", "cell"), "cell")


@query(r"""with recursive p as (select try_cast(trim("decimalLatitude") as double) as lat, try_cast(trim("decimalLongitude") as double) as lon from occurrence_source), ok as (select * from p where lat between -90 and 90 and lon between -180 and 180),
c as (select least(cast(floor((lat + 90) / 5.625) as bigint), 31) as r, cast(floor(((lon + 180) - 360 * floor((lon + 180) / 360)) / 5.625) as bigint) as k, count(*) as n from ok group by 1, 2 having count(*) >= 3),
e as (select a.r as r1, a.k as k1, b.r as r2, b.k as k2 from c a join c b on abs(a.r - b.r) <= 1 and ((a.k - b.k + 64) % 64) in (0, 1, 63)),
reach as (select r, k, r as r2, k as k2 from c union select reach.r, reach.k, e.r2, e.k2 from reach join e on e.r1 = reach.r2 and e.k1 = reach.k2)
select '4/' || r || '/' || k as cell, min(n) as n, min('4/' || r2 || '/' || k2) as component from reach join c using (r, k) group by r, k""")
def c_geo_clusters(spark, d):
    return occupied_clusters(table(spark, d, "occurrence_source"), 4, 3)


@query(r"""with p as (select trim(species) as species, (try_cast(trim("decimalLongitude") as double) + 180) - 360 * floor((try_cast(trim("decimalLongitude") as double) + 180) / 360) - 180 as lon from occurrence_source where trim(species) <> ''),
v as (select distinct species, round(lon, 5) as lon from p where lon is not null), g as (select species, lon, lead(lon) over (partition by species order by lon) as nxt, min(lon) over (partition by species) as lo from v),
gaps as (select species, lon, coalesce(nxt, lo) as nxt, case when nxt is null then lo + 360 - lon else nxt - lon end as gap from g),
best as (select species, arg_max({'west': nxt, 'east': lon}, (gap, -lon)) as b, max(gap) as gap from gaps group by 1)
select species, b.west as west, b.east as east, cast(round((360 - gap) * 100000) as bigint) as width_e5, b.west > b.east as over_date_line from best""")
def c_longitude_envelope(spark, d):
    """The smallest arc of longitude that holds a species: what is left of the circle without its widest gap."""
    p = table(spark, d, "occurrence_source").where(F.trim("species") != "").select(F.trim("species").alias("species"), F.round(geo.wrapped_longitude(F.trim("decimalLongitude").try_cast("double")), 5).alias("lon"))
    v = p.where(F.col("lon").isNotNull()).distinct()
    w = Window.partitionBy("species").orderBy("lon")
    lows = v.groupBy("species").agg(F.min("lon").alias("lo"))
    g = v.withColumn("nxt", F.lead("lon").over(w)).join(lows, "species")
    g = g.select("species", "lon", F.coalesce("nxt", "lo").alias("nxt"), F.when(F.col("nxt").isNull(), F.col("lo") + 360 - F.col("lon")).otherwise(F.col("nxt") - F.col("lon")).alias("gap"))
    best = g.groupBy("species").agg(F.max_by(F.struct(F.col("nxt").alias("west"), F.col("lon").alias("east")), F.struct("gap", -F.col("lon"))).alias("b"), F.max("gap").alias("gap"))
    return best.select("species", "b.west", "b.east", F.round((360 - F.col("gap")) * 100000).cast("bigint").alias("width_e5"), (F.col("b.west") > F.col("b.east")).alias("over_date_line"))


def taxon_geography(occ: DataFrame, taxon: str, resolution: int) -> DataFrame:
    """Per taxon: points, occupied cells, groups of adjoining cells, and cells that stand alone
    with a single point (outliers)."""
    p = occ.where(F.trim(taxon) != "").select(F.trim(taxon).alias("taxon"), F.trim("decimalLatitude").try_cast("double").alias("lat"), F.trim("decimalLongitude").try_cast("double").alias("lon")).where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    cells = p.groupBy("taxon", geo.cell(F.col("lat"), F.col("lon"), resolution).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    node = lambda c: F.concat_ws("|", "taxon", c)
    edges = cells.select("taxon", "cell", F.explode(geo.neighbours(F.col("cell"))).alias("other")).join(cells.select("taxon", F.col("cell").alias("other")), ["taxon", "other"], "left_semi").select(node("cell").alias("a"), node("other").alias("b"))
    grouped = cells.withColumn("node", node("cell")).join(graph.same_component(edges, "a", "b"), "node")
    per = grouped.groupBy("taxon", "component").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_cells"))
    return per.groupBy("taxon").agg(F.sum("n").alias("n_points"), F.sum("n_cells").alias("n_cells"), F.count(F.lit(1)).alias("n_components"), F.count_if((F.col("n_cells") == 1) & (F.col("n") == 1)).alias("n_outliers"))


@query(r"""with recursive p as (select trim(species) as taxon, try_cast(trim("decimalLatitude") as double) as lat, try_cast(trim("decimalLongitude") as double) as lon from occurrence_source where trim(species) <> ''), ok as (select * from p where lat between -90 and 90 and lon between -180 and 180),
c as (select taxon, least(cast(floor((lat + 90) / 5.625) as bigint), 31) as r, cast(floor(((lon + 180) - 360 * floor((lon + 180) / 360)) / 5.625) as bigint) as k, count(*) as n from ok group by 1, 2, 3),
e as (select a.taxon, a.r as r1, a.k as k1, b.r as r2, b.k as k2 from c a join c b on a.taxon = b.taxon and abs(a.r - b.r) <= 1 and ((a.k - b.k + 64) % 64) in (0, 1, 63)),
reach as (select taxon, r, k, r as r2, k as k2 from c union select reach.taxon, reach.r, reach.k, e.r2, e.k2 from reach join e on e.taxon = reach.taxon and e.r1 = reach.r2 and e.k1 = reach.k2),
root as (select taxon, r, k, min(r2 * 1000 + k2) as root from reach group by 1, 2, 3), g as (select taxon, root, cast(sum(n) as bigint) as n, count(*) as cells from root join c using (taxon, r, k) group by 1, 2)
select taxon, cast(sum(n) as bigint) as n_points, cast(sum(cells) as bigint) as n_cells, count(*) as n_components, count(*) filter (cells = 1 and n = 1) as n_outliers from g group by 1""")
def c_taxon_geography(spark, d):
    return taxon_geography(table(spark, d, "occurrence_source"), "species", 4)


@query("""with p as (select trim(species) as taxon, try_cast(trim("decimalLatitude") as double) as lat, try_cast(trim("decimalLongitude") as double) as lon from occurrence_source where trim(species) <> ''), ok as (select * from p where lat between -90 and 90 and lon between -180 and 180),
c as (select '2/' || least(cast(floor((lat + 90) / 22.5) as bigint), 7) || '/' || cast(floor(((lon + 180) - 360 * floor((lon + 180) / 360)) / 22.5) as bigint) as cell, taxon from ok)
select cell, taxon, count(*) as n, cast(row_number() over (partition by cell order by count(*) desc, taxon) as int) as place from c group by 1, 2""")
def c_geo_taxon_partitions(spark, d):
    p = table(spark, d, "occurrence_source").where(F.trim("species") != "").select(F.trim("species").alias("taxon"), F.trim("decimalLatitude").try_cast("double").alias("lat"), F.trim("decimalLongitude").try_cast("double").alias("lon")).where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    per = p.groupBy(geo.cell(F.col("lat"), F.col("lon"), 2).alias("cell"), "taxon").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("place", F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("n"), "taxon")))


# ---------------------------------------------------------------- names, hierarchies, graphs


@query("""select lower(trim(species)) as name_key, coalesce("countryCode", '') as language, count(*) as n_rows, count(distinct "acceptedTaxonKey") as n_taxa, list_sort(list(distinct "acceptedTaxonKey")) as taxa from occurrence_source where trim(species) <> '' and "acceptedTaxonKey" is not null group by 1, 2 having count(distinct "acceptedTaxonKey") > 1""", lists=('taxa',))
def c_name_collisions(spark, d):
    occ = table(spark, d, "occurrence_source")
    return registry.name_collisions(occ, F.lower(nonblank(F.col("species"))), F.coalesce("countryCode", F.lit("")), "acceptedTaxonKey")


_EDGES = """select distinct 'species:' || trim(species) as child, coalesce('genus:' || nullif(trim(genus), ''), 'family:' || nullif(trim(family), '')) as parent from occurrence_source where trim(species) <> '' and coalesce(nullif(trim(genus), ''), nullif(trim(family), '')) is not null
  union select distinct 'genus:' || trim(genus), 'family:' || trim(family) from occurrence_source where trim(genus) <> '' and trim(family) <> ''"""


@query(_EDGES)
def c_parent_edges(spark, d):
    return registry.parent_edges(table(spark, d, "occurrence_source"), ["species", "genus", "family"])


@query(f"""with recursive e as ({_EDGES}), a as (select child as node, parent as ancestor, 1 as distance from e union select a.node, e.parent, a.distance + 1 from a join e on e.child = a.ancestor where a.distance < 8)
select node, ancestor, min(distance) as distance from a where node <> ancestor group by 1, 2""")
def c_ancestors(spark, d):
    return registry.ancestors(registry.parent_edges(table(spark, d, "occurrence_source"), ["species", "genus", "family"]), "child", "parent")


@query(f"""with recursive e as ({_EDGES}), paths as (select child as node, parent as ancestor from e union select p.node, e.parent from paths p join e on e.child = p.ancestor),
mem as (select distinct family, 'species:' || trim(species) as node from occurrence_source where trim(species) <> '' and trim(family) <> ''), n as (select family, count(*) as n from mem group by 1),
above as (select m.family, m.node, p.ancestor from mem m join paths p using (node) where p.ancestor <> m.node union select family, node, node from mem),
shared as (select family, ancestor from above join n using (family) group by family, ancestor, n having count(distinct node) = n),
depth as (select node as ancestor, count(distinct ancestor) as depth from paths where node <> ancestor group by 1)
select family, ancestor as common from (select family, ancestor, row_number() over (partition by family order by coalesce(depth, 0) desc, ancestor) as rn from shared left join depth using (ancestor)) where rn = 1""")
def c_lowest_common_ancestor(spark, d):
    """For each family the lowest taxon above (or equal to) all of its species."""
    occ = table(spark, d, "occurrence_source")
    paths = registry.ancestors(registry.parent_edges(occ, ["species", "genus", "family"]), "child", "parent")
    members = occ.where((F.trim("species") != "") & (F.trim("family") != "")).select("family", F.concat(F.lit("species:"), F.trim("species")).alias("node"))
    return registry.lowest_common(members, "family", "node", paths)


@query("""select species, field, sha256(field || '|' || lower(species)) as query_id from (select distinct trim(species) as species from occurrence_source where trim(species) <> ''), (values ('tags'), ('text')) as v(field)""")
def c_query_rows(spark, d):
    s = table(spark, d, "occurrence_source").where(F.trim("species") != "").select(F.trim("species").alias("species")).distinct()
    return registry.query_rows(s, "species", [])


@query(f"""with recursive e as ({_EDGES}), ch as (select 'species:' || trim(species) as node from occurrence_source where "taxonomicStatus" = 'SYNONYM' and trim(species) <> ''), a as (select distinct node, 0 as distance from ch union select e.parent, a.distance + 1 from a join e on e.child = a.node where a.distance < 8)
select node, min(distance) as distance from a group by 1""")
def c_invalidation(spark, d):
    """What depends on changed artifacts: here everything above species that are synonyms."""
    occ = table(spark, d, "occurrence_source")
    edges = registry.parent_edges(occ, ["species", "genus", "family"]).select(F.col("child").alias("source"), F.col("parent").alias("target"))
    changed = occ.where((F.col("taxonomicStatus") == "SYNONYM") & (F.trim("species") != "")).select(F.concat(F.lit("species:"), F.trim("species")).alias("node"))
    return registry.invalidated(edges, changed)


@query(r"""with recursive l as (select source_media_row_number as id, 'g:' || trim("gbifID") as ent from gbif_media where trim("gbifID") <> '' union all select source_media_row_number, 'u:' || lower(trim(media_identifier)) from gbif_media where trim(media_identifier) <> ''),
p as (select distinct x.ent as u, y.ent as v from l x join l y using (id)), reach as (select distinct ent as u, ent as v from l union select r.u, p.v from reach r join p on p.u = r.v),
r as (select u as ent, min(v) as root from reach group by 1), g as (select distinct id, root from l join r using (ent))
select id, min(id) over (partition by root) as component from g""")
def c_identity_components(spark, d):
    """Media rows that share a record or a URL, directly or through others."""
    m = table(spark, d, "gbif_media")
    tokens = F.array_compact(F.array(F.concat(F.lit("g:"), nonblank(F.col("gbifID"))), F.concat(F.lit("u:"), F.lower(nonblank(F.col("media_identifier"))))))
    return graph.components(m.select(F.col("source_media_row_number").alias("id"), F.explode(tokens).alias("ent")), "id", "ent")


@query("""select token, list_sort(list(distinct part)) as parts, count(*) as n_rows from (select lower(trim(leakage_component_id)) as token, lower(trim(dataset_split)) as part from calibration_prediction where trim(leakage_component_id) <> '' and trim(dataset_split) <> '') group by 1 having count(distinct part) > 1""", lists=('parts',))
def c_leakage_findings(spark, d):
    c = table(spark, d, "calibration_prediction")
    return evaluation.crossing_tokens(c, F.lower(nonblank(F.col("leakage_component_id"))), F.lower(nonblank(F.col("dataset_split"))))


# ---------------------------------------------------------------- vectors


def _emb(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings")


_COS = "list_sum(list_transform(list_zip({0}, {1}), lambda z: z[1]::double * z[2]::double)) / (sqrt(list_sum(list_transform({0}, lambda x: x::double * x::double))) * sqrt(list_sum(list_transform({1}, lambda x: x::double * x::double))))"


@query(f"""with s as (select q.vec_id as query_id, c.vec_id as neighbour_id, {_COS.format('q.embedding', 'c.embedding')} as similarity from embeddings q, embeddings c where q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
select query_id, neighbour_id, round(similarity, 6) as similarity, cast(rn as int) as rank from (select *, row_number() over (partition by query_id order by round(similarity, 12) desc, neighbour_id) as rn from s) where rn <= 5""")
def v_nearest(spark, d):
    """Queries are the rows whose id is divisible by 20, against all rows."""
    e = _emb(spark, d)
    return similarity.nearest(e, e.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding", 5).withColumn("similarity", F.round("similarity", 6))


@query("""select label, i, round(m, 6) as mean from (select label, i, avg(x::double) as m from (select label, unnest(embedding) as x, unnest(range(len(embedding))) as i from embeddings) group by 1, 2)""")
def v_class_means(spark, d):
    m = similarity.class_means(_emb(spark, d), "label", "embedding")
    return m.select("label", F.posexplode("mean").alias("i", "m")).select("label", F.col("i").cast("bigint").alias("i"), F.round("m", 6).alias("mean"))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    e = _emb(spark, d)
    return similarity.class_scores(e, similarity.class_means(e, "label", "embedding"), "vec_id", "embedding", "label")


_SCORES = f"""with mean as (select label as class, list(m order by i) as mean from (select label, i, avg(x::double) as m from (select label, unnest(embedding) as x, unnest(range(len(embedding))) as i from embeddings) group by 1, 2) group by 1),
s as (select vec_id, label as own, class, {_COS.format('embedding', 'mean')} as score from embeddings, mean)
"""


@query(_SCORES + """, r as (select *, row_number() over (partition by vec_id order by score desc, class) as rn, lead(score) over (partition by vec_id order by score desc, class) as nxt from s) select vec_id, own, class as predicted, round(score, 6) as score, round(score - nxt, 6) as margin from r where rn = 1""")
def v_nearest_centroid(spark, d):
    return _scores(spark, d).select("vec_id", "own", "predicted", F.round("score", 6).alias("score"), F.round(F.col("score") - F.col("next"), 6).alias("margin"))


@query(_SCORES + """select vec_id, round(max(score) filter (class <> own), 6) as best_other, round(max(score) filter (class = own), 6) as own_score, coalesce(max(score) filter (class = own) > max(score) filter (class <> own), false) as accepted from s group by 1""")
def v_explicit_non_match(spark, d):
    own, other = F.col("own_score"), F.col("best_other")
    return _scores(spark, d).select("vec_id", F.round(other, 6).alias("best_other"), F.round(own, 6).alias("own_score"), F.coalesce(own > other, F.lit(False)).alias("accepted"))


@query(_SCORES.replace("s as", "_s as") + f""", pairs as (select a.class as label, b.class as neighbour, {_COS.format('a.mean', 'b.mean')} as c from mean a, mean b where a.class <> b.class)
select label, neighbour, round(c, 6) as similarity, cast(rn as int) as rank from (select *, row_number() over (partition by label order by c desc, neighbour) as rn from pairs) where rn <= 3""")
def v_class_neighbours(spark, d):
    m = similarity.class_means(_emb(spark, d), "label", "embedding").withColumn("id", F.col("label").cast("bigint"))
    n = similarity.nearest(m, m, "id", "mean", 3)
    return n.select(F.col("query_id").cast("int").alias("label"), F.col("neighbour_id").cast("int").alias("neighbour"), F.round("similarity", 6).alias("similarity"), "rank")


@query("""select prediction_id, round(list_aggregate(s, 'avg'), 9) as mean_score, list_max(s) as max_score, round(0.4 * s[1] + 0.3 * s[2] + 0.2 * s[3] + 0.1 * s[4], 9) as linear_score, round((list_sort(s)[2] + list_sort(s)[3]) / 2, 9) as median_score,
  round((list_reverse_sort(s)[1] + list_reverse_sort(s)[2]) / 2, 9) as best_two, round(list_reverse_sort(s)[1] - list_reverse_sort(s)[2], 9) as margin from (select prediction_id, decision_scores as s from calibration_prediction)""")
def v_fusion_and_pooling(spark, d):
    s = F.col("decision_scores")
    f = similarity.fused([F.get(s, F.lit(i)) for i in range(4)], [0.4, 0.3, 0.2, 0.1])
    return table(spark, d, "calibration_prediction").select("prediction_id", F.round(f["mean"], 9).alias("mean_score"), f["max"].alias("max_score"), F.round(f["linear"], 9).alias("linear_score"), F.round(f["median"], 9).alias("median_score"), F.round(similarity.pooled(s)["best_two"], 9).alias("best_two"), F.round(vectors.margin(s), 9).alias("margin"))


@query("""select prediction_id, round(-list_sum(list_transform(s, lambda x: case when x > 0 then x / list_sum(s) * ln(x / list_sum(s)) else 0 end)), 9) as entropy, cast(list_position(s, list_max(s)) - 1 as bigint) as best, round(exp(s[1] - list_max(s)) / list_sum(list_transform(s, lambda x: exp(x - list_max(s)))), 9) as softmax_first from (select prediction_id, decision_scores as s from calibration_prediction)""")
def v_entropy_softmax(spark, d):
    s = F.col("decision_scores")
    return table(spark, d, "calibration_prediction").select("prediction_id", F.round(vectors.entropy(s), 9).alias("entropy"), vectors.argmax(s).alias("best"), F.round(F.get(vectors.softmax(s), F.lit(0)), 9).alias("softmax_first"))


@query(_SCORES + """, g as (select vec_id, avg(score) as all_mean, max(score) filter (class = own) as own_score from s group by 1) select vec_id, round(own_score - all_mean, 6) as above_all, own_score > all_mean as supported from g""")
def v_disagreement(spark, d):
    """How far the score of a row's own class stands out from its mean over all classes."""
    own, mean = F.col("own_score"), F.try_divide("total", "n")
    return _scores(spark, d).select("vec_id", F.round(own - mean, 6).alias("above_all"), (own > mean).alias("supported"))


@query()
def v_class_clusters(spark, d):
    """Classes joined by average linkage of their mean vectors; the means of all rows are one
    row per class, and only those reach one task."""
    means = similarity.class_means(_emb(spark, d), "label", "embedding").withColumn("all", F.lit(1))

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("label")
        v = similarity._unit(np.array(pdf["mean"].tolist(), float))
        return pd.DataFrame({"label": pdf["label"].to_numpy(), "cluster": similarity.average_linkage(v, 0.2)})

    return means.groupBy("all").applyInPandas(cluster, "label int, cluster int")


# ---------------------------------------------------------------- evaluation


def _pred(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "calibration_prediction")
    return c.select("prediction_id", F.lower(nonblank(F.col("dataset_split"))).alias("split"), "source", "decision_scores", (F.col("true_class_label") == "target").alias("truth"), F.get("decision_scores", F.lit(0)).alias("p"), F.col("sample_weight").alias("w"), "true_class_label", "source_item_id").where(F.col("p").isNotNull() & F.col("truth").isNotNull() & F.col("w").isNotNull())


_PRED = """with x as (select prediction_id, lower(nullif(trim(dataset_split), '')) as split, source, decision_scores as s, true_class_label = 'target' as truth, decision_scores[1] as p, sample_weight as w, true_class_label, source_item_id from calibration_prediction where decision_scores[1] is not null and true_class_label is not null and sample_weight is not null)
"""


@query(_PRED + """, c as (select split, coalesce(sum(w) filter (truth and p >= 0.5), 0) as tp, coalesce(sum(w) filter (not truth and p >= 0.5), 0) as fp, coalesce(sum(w) filter (truth and p < 0.5), 0) as fn, coalesce(sum(w) filter (not truth and p < 0.5), 0) as tn, sum(w) * sum(w) / sum(w * w) as en from x group by 1)
select split, round(tp, 6) as tp, round(fp, 6) as fp, round(fn, 6) as fn, round(tn, 6) as tn, round(en, 4) as effective_n, round(tp / nullif(tp + fp, 0), 9) as "precision", round(tp / nullif(tp + fn, 0), 9) as recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 9) as f1, round(tn / nullif(tn + fp, 0), 9) as specificity from c""")
def e_confusion(spark, d):
    c = evaluation.confusion(_pred(spark, d), ["split"], F.col("truth"), F.col("p") >= 0.5, F.col("w"))
    return c.select("split", *[F.round(x, 6).alias(x) for x in ("tp", "fp", "fn", "tn")], F.round("effective_n", 4).alias("effective_n"), *[F.round(x, 9).alias(x) for x in ("precision", "recall", "f1", "specificity")])


@query(_PRED + """select source, round(sum(w * pow(p - truth::int, 2)) / sum(w), 9) as brier, round(sum(-w * case when truth then ln(least(greatest(p, 1e-15), 1 - 1e-15)) else ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)) end) / sum(w), 9) as log_loss from x group by 1""")
def e_proper_scores(spark, d):
    s = evaluation.proper_scores(_pred(spark, d), ["source"], F.col("truth"), F.col("p"), F.col("w"))
    return s.select("source", F.round("brier", 9).alias("brier"), F.round("log_loss", 9).alias("log_loss"))


@query(_PRED + """select split, cast(least(floor(p * 10), 9) as int) as bin, round(sum(w), 6) as weight, round(sum(w * p) / sum(w), 9) as mean_score, round(sum(w * truth::int) / sum(w), 9) as observed from x group by 1, 2""")
def e_reliability(spark, d):
    r = evaluation.reliability(_pred(spark, d), ["split"], F.col("truth"), F.col("p"), F.col("w"))
    return r.select("split", "bin", F.round("weight", 6).alias("weight"), F.round("mean_score", 9).alias("mean_score"), F.round("observed", 9).alias("observed"))


@query(_PRED + """, b as (select split, least(floor(p * 10), 9) as bin, sum(w) as sw, sum(w * p) / sum(w) as mp, sum(w * truth::int) / sum(w) as o from x group by 1, 2) select split, round(sum(sw * abs(mp - o)) / sum(sw), 9) as ece from b group by 1""")
def e_calibration_error(spark, d):
    return evaluation.calibration_error(_pred(spark, d), ["split"], F.col("truth"), F.col("p"), F.col("w")).select("split", F.round("ece", 9).alias("ece"))


@query(_PRED + """, s as (select source, p, sum(case when truth then w else 0 end) as pos, sum(case when truth then 0 else w end) as neg from x group by 1, 2), c as (select *, coalesce(sum(neg) over (partition by source order by p rows between unbounded preceding and 1 preceding), 0) as below from s)
select source, round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) as roc_auc from c group by 1""")
def e_roc_auc(spark, d):
    return evaluation.roc_auc(_pred(spark, d), ["source"], F.col("truth"), F.col("p"), F.col("w")).select("source", F.round("roc_auc", 9).alias("roc_auc"))


@query(_PRED + """, s as (select source, p, sum(case when truth then w else 0 end) as pos, sum(case when truth then 0 else w end) as neg from x group by 1, 2), c as (select *, sum(pos) over down as tp, sum(neg) over down as fp from s window down as (partition by source order by p desc))
select source, case when sum(pos) > 0 and sum(neg) > 0 then round(sum(pos * tp / nullif(tp + fp, 0)) / sum(pos), 9) end as pr_auc from c group by 1""")
def e_pr_auc(spark, d):
    return evaluation.pr_auc(_pred(spark, d), ["source"], F.col("truth"), F.col("p"), F.col("w")).select("source", F.round("pr_auc", 9).alias("pr_auc"))


@query(_PRED + """, b as (select source, floor(p * 20) as band, sum(w) as w, sum(case when truth then w else 0 end) as pos from x group by 1, 2), c as (select *, sum(w) over (partition by source order by band desc) as kept, sum(pos) over (partition by source order by band desc) as hits, sum(w) over (partition by source) as aw, sum(pos) over (partition by source) as ap from b)
select source, band / 20 as threshold, round(hits / kept, 9) as "precision", round(hits / ap, 9) as recall, round(kept / aw, 9) as kept_share from c""")
def e_threshold_grid(spark, d):
    g = evaluation.threshold_grid(_pred(spark, d), ["source"], F.col("truth"), F.col("p"), F.col("w"), 20)
    return g.select("source", "threshold", *[F.round(x, 9).alias(x) for x in ("precision", "recall", "kept_share")])


@query(_PRED + """, b as (select split, cast(floor(p * 100) as int) as band, sum(w) as w, coalesce(sum(w) filter (truth), 0) as pos from x group by 1, 2),
c as (select split, band / 100 as threshold, sum(w) over down as kept, sum(pos) over down as hits, sum(pos) over (partition by split) as all_pos from b window down as (partition by split order by band desc rows unbounded preceding)),
g as (select split, threshold, hits / nullif(kept, 0) as "precision", hits / nullif(all_pos, 0) as recall from c)
select split, threshold, "precision", recall from (select *, row_number() over (partition by split order by recall desc nulls last, threshold desc) as rn from g where "precision" >= 0.5) where rn = 1""")
def e_selective_policy(spark, d):
    grid = evaluation.threshold_grid(_pred(spark, d), ["split"], F.col("truth"), F.col("p"), F.col("w"), 100)
    return evaluation.best_threshold(grid, ["split"], 0.5)


@query(_PRED + """, c as (select source, count(*) filter (truth) as hits, count(*) as n from x group by 1), z as (select *, hits / n as p, 1.959963984540054 as z from c)
select source, hits, n, round(greatest(0, (p + z * z / 2 / n) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / 4 / (n * n)) / (1 + z * z / n)), 9) as low, round(least(1, (p + z * z / 2 / n) / (1 + z * z / n) + z * sqrt(p * (1 - p) / n + z * z / 4 / (n * n)) / (1 + z * z / n)), 9) as high from z""")
def e_wilson(spark, d):
    p = evaluation.proportions(_pred(spark, d), ["source"], F.col("truth"))
    return p.select("source", "hits", "n", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"))


# The binomial tail, halved to its 95 % point 50 times.
@query(_PRED.replace("with ", "with recursive ", 1) + """, c as (select split, source, count(*) filter (truth) as hits, count(*) as n from x group by 1, 2),
b as (select split, source, hits, n, 0::double as lo, 1 - 1e-15::double as hi, 0 as step from c union all
  select split, source, hits, n, case when tail < 0.05 then mid else lo end, case when tail < 0.05 then hi else mid end, step + 1 from (
    select *, (lo + hi) / 2 as mid, list_sum(list_transform(range(hits, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln((lo + hi) / 2) + (n - i) * ln(1 - (lo + hi) / 2)))) as tail from b where step < 50))
select split, source, hits, n, case when hits = 0 then 0.0 else round((lo + hi) / 2, 9) end as low from b where step = 50""")
def e_clopper_pearson(spark, d):
    p = evaluation.proportions(_pred(spark, d), ["split", "source"], F.col("truth"))
    return p.select("split", "source", "hits", "n", F.round(evaluation.exact_low(F.col("hits").cast("double"), F.col("n").cast("double")), 9).alias("low"))


@query(_PRED + """, per as (select source_item_id as c, count(*) filter (truth) as h, count(*) as n from x group by 1),
u as (select h, n, r, ('0x' || substr(sha256(concat_ws(':', '7', r, c)), 1, 8))::ubigint / 4294967296.0 as u from per, range(1, 201) as t(r)),
k as (select r, h, n, list_sum(list_transform(range(1, 8), lambda i: (u >= list_sum(list_transform(range(0, i), lambda j: exp(-1) / gamma(j + 1))))::int)) as k from u),
s as (select sum(k * h) / nullif(sum(k * n), 0) as share from k group by r)
select round(quantile_cont(share, 0.025), 9) as low, round(avg(share), 9) as mean, round(quantile_cont(share, 0.975), 9) as high from s""")
def e_bootstrap(spark, d):
    out = evaluation.bootstrap_interval(_pred(spark, d), "source_item_id", F.col("truth"))
    return out.select(*[F.round(c, 9).alias(c) for c in ("low", "mean", "high")])


_CLASS_AT = "case true_class_label when 'target' then 1 when 'competitor_a' then 2 when 'competitor_b' then 3 when 'other' then 4 end"


def _with_class(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("true_class_label")
    return _pred(spark, d).withColumn("t", F.when(t == "target", 0).when(t == "competitor_a", 1).when(t == "competitor_b", 2).when(t == "other", 3))


@query(_PRED + f"""select split, round(sum(w * list_sum(list_transform(range(1, 5), lambda i: pow(s[i] - (i = {_CLASS_AT})::int, 2)))) / sum(w), 9) as multiclass_brier from x where {_CLASS_AT} is not null group by 1""")
def e_multiclass_brier(spark, d):
    return evaluation.multiclass_brier(_with_class(spark, d), ["split"], "decision_scores", F.col("t"), F.col("w")).select("split", F.round("multiclass_brier", 9).alias("multiclass_brier"))


@query(_PRED + f""", f as (select split, w, {_CLASS_AT} as t, unnest(s) as p, unnest(range(1, 5)) as k from x), b as (select split, k, least(floor(p * 10), 9) as bin, sum(w) as sw, sum(w * p) / sum(w) as mp, sum(w * (t = k)::int) / sum(w) as o from f where t is not null group by 1, 2, 3),
e as (select split, k, sum(sw * abs(mp - o)) / sum(sw) as ece from b group by 1, 2) select split, round(avg(ece), 9) as macro_ece from e group by 1""")
def e_macro_calibration_error(spark, d):
    return evaluation.macro_calibration_error(_with_class(spark, d), ["split"], "decision_scores", F.col("t"), "w").select("split", F.round("macro_ece", 9).alias("macro_ece"))


# The greatest over all starts up to a score of the least mean over all ends from it on.
@query(_PRED + """, per as (select p as score, sum(w) as w, sum(w * truth::int) as h from x group by 1 having sum(w) > 0),
pre as (select *, row_number() over o as i, sum(w) over o as ws, sum(h) over o as hs from per window o as (order by score rows unbounded preceding)),
span as (select a.i as j, b.i as k, (b.hs - a.hs + a.h) / (b.ws - a.ws + a.w) as m from pre a join pre b on a.i <= b.i),
low as (select j, k, min(m) over (partition by j order by k desc rows unbounded preceding) as m from span), iso as (select k as i, max(m) as calibrated from low group by 1)
select score, round(w, 6) as weight, round(calibrated, 6) as calibrated from pre join iso using (i)""")
def e_isotonic(spark, d):
    out = evaluation.isotonic_calibration(_pred(spark, d), F.col("truth"), F.col("p"), F.col("w"))
    return out.select("score", F.round("weight", 6).alias("weight"), F.round("calibrated", 6).alias("calibrated"))


@query(_PRED + """select split, source, round(sum(w * truth::int) / sum(w), 9) as share, grouping(split) + 2 * grouping(source) as level from x group by grouping sets ((split, source), (split), (source), ())""")
def e_grouping_sets(spark, d):
    levels = F.grouping("split").cast("bigint") + 2 * F.grouping("source").cast("bigint")
    sets = _pred(spark, d).groupingSets([["split", "source"], ["split"], ["source"], []], "split", "source")
    return sets.agg(F.round(F.sum(F.col("w") * F.col("truth").cast("int")) / F.sum("w"), 9).alias("share"), levels.alias("level"))
