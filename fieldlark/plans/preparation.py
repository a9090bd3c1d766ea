"""Queries of the general data-preparation operators (problems 1, 3, 5 and 6) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlark.operators import hot_keys, parse_rows, references, spatial
from fieldlark.session import table

Query = Callable[[SparkSession, str], DataFrame]


# ---- problem 1


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "occurrence_raw").select("raw_id", "raw_line")
    return parse_rows.broken_rows(raw, "raw_line").select("raw_id")


def p1_loaded(spark: SparkSession, d: str) -> DataFrame:
    return parse_rows.valid_rows(table(spark, d, "occurrence_raw"), "raw_line")


def p1_rejected(spark: SparkSession, d: str) -> DataFrame:
    return parse_rows.broken_rows(table(spark, d, "occurrence_raw"), "raw_line").select("raw_id", "member_name", "received_at", "raw_line", F.concat_ws(",", "errors").alias("errors"))


def p1_reasons(spark: SparkSession, d: str) -> DataFrame:
    bad = parse_rows.broken_rows(table(spark, d, "occurrence_raw").select("raw_id", "member_name", "raw_line"), "raw_line")
    return bad.select("member_name", F.explode("errors").alias("reason")).groupBy("member_name", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


_P1 = r"""
with lines as (
  select raw_id, member_name, received_at, raw_line,
    case when raw_line is null then null
         when not contains(raw_line, '"') then string_split(raw_line, chr(9))
         when regexp_full_match(raw_line, '(?s)(?:"(?:[^"]|"")*"|[^"\t]*)(?:\t(?:"(?:[^"]|"")*"|[^"\t]*))*')
           then regexp_extract_all(chr(9) || raw_line, '(?s)\t("(?:[^"]|"")*"|[^"\t]*)', 1) end as cells
  from occurrence_raw),
vals as (
  select *, case when len(cells) = 12 then list_transform(cells, lambda c: nullif_missing(c)) end as v from lines)
"""


def _p1_sql(select: str) -> str:
    cell = "trim(case when starts_with(c, '\"') then replace(substr(c, 2, length(c) - 2), '\"\"', '\"') else c end)"
    clean = f"case when {cell} in ('', 'NULL', 'null', 'NA', 'na', 'N/A', 'n/a') then null else {cell} end"
    number = r"'[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?'"
    moment = r"'[0-9]{4}-[0-9]{2}-[0-9]{2}(T([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?)?Z?'"

    def day(x: str) -> str:
        return f"case when regexp_full_match({x}, {moment}) and substr({x}, 1, 4) <> '0000' then try_cast(substr({x}, 1, 10) as date) end"

    first, last = day("string_split(v[11], '/')[1]"), day("string_split(v[11], '/')[2]")
    digits = "'[0-9]{1,18}'"
    rules = [
        ("gbifID:missing", "v[1] is null"),
        ("gbifID:not_digits", f"not regexp_full_match(v[1], {digits})"),
        ("gbifID:not_positive", f"regexp_full_match(v[1], {digits}) and try_cast(v[1] as bigint) <= 0"),
        ("acceptedTaxonKey:not_digits", f"not regexp_full_match(v[5], {digits})"),
        ("countryCode:pattern", "not regexp_full_match(v[8], '[A-Z]{2}')"),
        ("decimalLatitude:not_a_number", f"not regexp_full_match(v[9], {number})"),
        ("decimalLatitude:out_of_range", f"regexp_full_match(v[9], {number}) and abs(try_cast(v[9] as double)) > 90"),
        ("decimalLongitude:not_a_number", f"not regexp_full_match(v[10], {number})"),
        ("decimalLongitude:out_of_range", f"regexp_full_match(v[10], {number}) and abs(try_cast(v[10] as double)) > 180"),
        ("eventDate:not_a_date", f"v[11] is not null and (len(string_split(v[11], '/')) > 2 or ({first}) is null or (len(string_split(v[11], '/')) = 2 and ({last}) is null))"),
        ("eventDate:reversed", f"len(string_split(v[11], '/')) = 2 and ({first}) > ({last})"),
    ]
    errors = ", ".join(f"case when {cond} then '{name}' end" for name, cond in rules)
    head = _P1.replace("nullif_missing(c)", clean)
    return f"""{head},
judged as (select *, case when raw_line is null then ['line:null'] when cells is null then ['line:quoting']
  when len(cells) <> 12 then ['line:field_count'] else list_filter([{errors}], lambda e: e is not null) end as errors from vals)
{select.replace("FIRST", first).replace("LAST", f"coalesce(({last}), ({first}))")}"""


# ---- problem 3


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    occ = table(spark, d, "occurrence_source").where(F.coalesce(F.trim("countryCode"), F.lit("")) == "")
    occ = occ.select("source_ordinal", spatial.coordinate(F.col("decimalLatitude"), 90).alias("lat"), spatial.coordinate(F.col("decimalLongitude"), 180).alias("lon"))
    occ = occ.where(~((F.col("lat") == 0) & (F.col("lon") == 0)))
    hits = spatial.points_in_regions(occ, "source_ordinal", F.col("lon"), F.col("lat"), table(spark, d, "boundary_countries"), "country_code", "geom")
    return hits.select(F.col("ident").alias("source_ordinal"), F.col("code").alias("country_code"))


def p3_by_country(spark: SparkSession, d: str) -> DataFrame:
    return p3_found(spark, d).groupBy("country_code").agg(F.count(F.lit(1)).alias("n_points"))


def p3_regions(spark: SparkSession, d: str) -> DataFrame:
    return spatial.region_report(table(spark, d, "boundary_countries"), "country_code", "geom")


# Crossing parity over every edge of a region row: a plain check of the triangles.
_P3 = r"""
with rings as (select row_number() over () as region, country_code, unnest(regexp_extract_all(geom, '\(([^()]+)\)', 1)) as ring
  from boundary_countries where trim(country_code) <> ''),
corners as (select region, country_code, row_number() over () as ring_no, string_split(ring, ',') as pts from rings),
verts as (select region, country_code, ring_no, unnest(range(1, len(pts) + 1)) as k, pts from corners),
xy as (select region, country_code, ring_no, k, regexp_extract_all(pts[k], '[^ ]+') as p from verts),
edges as (select region, country_code, p[1]::double as x1, p[2]::double as y1,
    lead(p[1]::double) over w as x2, lead(p[2]::double) over w as y2
  from xy window w as (partition by ring_no order by k)),
pts as (select source_ordinal, try_cast(trim(decimalLatitude) as double) as lat, try_cast(trim(decimalLongitude) as double) as lon
  from occurrence_source where coalesce(trim(countryCode), '') = ''
    and regexp_full_match(trim(decimalLatitude), '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?')
    and regexp_full_match(trim(decimalLongitude), '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?')),
ok as (select * from pts where abs(lat) <= 90 and abs(lon) <= 180 and not (lat = 0 and lon = 0)),
hits as (select o.source_ordinal, e.region, e.country_code from ok o join edges e
    on e.x2 is not null and (e.y1 > o.lat) <> (e.y2 > o.lat) and o.lon < (e.x2 - e.x1) * (o.lat - e.y1) / (e.y2 - e.y1) + e.x1
  group by all having count(*) % 2 = 1),
found as (select distinct source_ordinal, country_code from hits)
"""


# ---- problem 5


def _media_orphans(spark: SparkSession, d: str, reasons: bool) -> DataFrame:
    media = table(spark, d, "gbif_media").select("source_media_row_number", "gbifID", "ingested_at")
    occ = table(spark, d, "occurrence_source").select("gbifID", "is_deleted", "ingested_at", "source_ordinal")
    key = references.whole_number(F.col("gbifID"))
    return references.orphan_references(
        media,
        [F.when(key != "", key)],
        occ,
        [F.when(key != "", key)],
        semantics="simple",
        ref_time=F.col("ingested_at"),
        target_time=F.col("ingested_at"),
        target_deleted=F.col("is_deleted"),
        target_tie=F.col("source_ordinal"),
        reasons=reasons,
    )


def _image_orphans(spark: SparkSession, d: str, reasons: bool) -> DataFrame:
    images = table(spark, d, "reference_media_objects").where(F.col("source") == "GBIF").select("reference_media_id", "source_object_uri", "downloaded_at")
    media = table(spark, d, "gbif_media").select("media_identifier", "ingested_at")
    return references.orphan_references(
        images,
        [references.url_key(F.col("source_object_uri"))],
        media,
        [references.url_key(F.col("media_identifier"))],
        semantics="simple",
        ref_time=F.col("downloaded_at"),
        target_time=F.col("ingested_at"),
        reasons=reasons,
    )


def _p5(spark: SparkSession, d: str, reasons: bool) -> DataFrame:
    why = ["orphan_reason"] * reasons
    a = _media_orphans(spark, d, reasons).select(F.lit("gbif_media").alias("ref_table"), F.col("source_media_row_number").cast("string").alias("ref_id"), F.col("ingested_at").alias("arrived_at"), *why)
    b = _image_orphans(spark, d, reasons).select(F.lit("reference_media_objects").alias("ref_table"), F.col("reference_media_id").alias("ref_id"), F.col("downloaded_at").alias("arrived_at"), *why)
    return a.unionByName(b)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _p5(spark, d, False).select("ref_table", "ref_id")


def p5_by_month(spark: SparkSession, d: str) -> DataFrame:
    month = F.date_format(F.col("arrived_at").cast("timestamp"), "yyyy-MM")
    return _p5(spark, d, True).groupBy("ref_table", month.alias("month"), "orphan_reason").agg(F.count(F.lit(1)).alias("n_orphans"))


def p5_partial_keys(spark: SparkSession, d: str) -> DataFrame:
    """Composite reference with partial NULLs: (gbifID, publisher) under MATCH PARTIAL."""
    media = table(spark, d, "gbif_media").select("source_media_row_number", "gbifID", "media_publisher")
    occ = table(spark, d, "occurrence_source").select("gbifID", "publisher")
    key = references.whole_number(F.col("gbifID"))

    def blank(c: str):
        return F.when(F.trim(c) != "", F.lower(F.trim(c)))

    lost = references.orphan_references(media, [F.when(key != "", key), blank("media_publisher")], occ, [F.when(key != "", key), blank("publisher")], semantics="partial")
    return lost.select("source_media_row_number", "orphan_reason")


_P5 = r"""
with occ as (select case when regexp_full_match(trim(gbifID), '\+?[0-9]+') then regexp_replace(trim(gbifID), '^\+?0*([0-9])', '\1') else trim(gbifID) end as k,
    coalesce(is_deleted, false) as gone, ingested_at as t, source_ordinal from occurrence_source),
med as (select source_media_row_number, case when regexp_full_match(trim(gbifID), '\+?[0-9]+') then regexp_replace(trim(gbifID), '^\+?0*([0-9])', '\1') else trim(gbifID) end as k,
    ingested_at as t from gbif_media where trim(gbifID) <> ''),
newest as (select m.source_media_row_number, m.t, arg_max(o.gone, (o.t, o.source_ordinal)) as gone
  from med m left join occ o on o.k = m.k and o.t <= m.t group by all),
urls as (select lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) || substr(u, length(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) + 1) as url, min(ingested_at) as t
  from (select regexp_replace(trim(media_identifier), '#.*$', '', 's') as u, ingested_at from gbif_media where media_identifier is not null) group by 1),
img as (select reference_media_id, downloaded_at as t, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) || substr(u, length(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) + 1) as url
  from (select reference_media_id, downloaded_at, regexp_replace(trim(source_object_uri), '#.*$', '', 's') as u from reference_media_objects where source = 'GBIF' and source_object_uri is not null)),
lost as (
  select 'gbif_media' as ref_table, cast(source_media_row_number as varchar) as ref_id, t, case when gone is null then 'absent' else 'deleted' end as orphan_reason
  from newest where coalesce(gone, true)
  union all
  select 'reference_media_objects', reference_media_id, i.t, case when u.t is null then 'absent' else 'late' end
  from img i left join urls u using (url) where u.t is null or u.t > i.t)
"""

_P5_PARTIAL = r"""
with occ as (select distinct case when regexp_full_match(trim(gbifID), '\+?[0-9]+') then regexp_replace(trim(gbifID), '^\+?0*([0-9])', '\1') else nullif(trim(gbifID), '') end as k,
    nullif(lower(trim(publisher)), '') as p from occurrence_source),
med as (select source_media_row_number, case when regexp_full_match(trim(gbifID), '\+?[0-9]+') then regexp_replace(trim(gbifID), '^\+?0*([0-9])', '\1') else nullif(trim(gbifID), '') end as k,
    nullif(lower(trim(media_publisher)), '') as p from gbif_media)
select source_media_row_number, 'absent' as orphan_reason from med m where (k is not null and p is not null and not exists (select 1 from occ where occ.k = m.k and occ.p = m.p))
  or (k is not null and p is null and not exists (select 1 from occ where occ.k = m.k))
  or (k is null and p is not null and not exists (select 1 from occ where occ.p = m.p))
"""


# ---- problem 6


def _taxon_key():
    digits = F.regexp_replace("accepted_taxon_key", "[^0-9]", "")
    return F.when(digits != "", digits)


def _complete(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "gbif_australia_presence").select("presence_id", "accepted_taxon_key", "occurrence_count", "status", "retrieved_at")
    return rows.where((F.col("status") == "complete") & F.col("occurrence_count").isNotNull())


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    out = hot_keys.value_changes(_complete(spark, d), _taxon_key(), "retrieved_at", "presence_id", "occurrence_count")
    return out.select(F.col("ident").alias("presence_id"))


def p6_history(spark: SparkSession, d: str) -> DataFrame:
    out = hot_keys.value_changes(_complete(spark, d), _taxon_key(), "retrieved_at", "presence_id", "occurrence_count")
    return out.select(F.col("key").alias("taxon_key"), F.col("at").alias("retrieved_at"), F.col("ident").alias("presence_id"), F.col("value").alias("occurrence_count"), F.col("previous").alias("previous_count"))


def p6_key_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "gbif_australia_presence").select("accepted_taxon_key", "occurrence_count")
    return hot_keys.key_totals(rows, _taxon_key(), "occurrence_count").withColumnRenamed("key", "taxon_key")


_P6 = r"""
with rows as (select nullif(regexp_replace(accepted_taxon_key, '[^0-9]', '', 'g'), '') as taxon_key, retrieved_at, presence_id, occurrence_count
  from gbif_australia_presence where status = 'complete' and occurrence_count is not null),
deliveries as (select taxon_key, retrieved_at, min(presence_id) as presence_id, arg_min(occurrence_count, presence_id) as occurrence_count
  from rows where taxon_key is not null and retrieved_at is not null group by all),
seen as (select *, lag(occurrence_count) over (partition by taxon_key order by retrieved_at) as previous_count from deliveries)
"""


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        p1_found,
        p1_loaded,
        p1_rejected,
        p1_reasons,
        p3_found,
        p3_by_country,
        p3_regions,
        p5_found,
        p5_by_month,
        p5_partial_keys,
        p6_found,
        p6_history,
        p6_key_totals,
    )
}

SQL: dict[str, str] = {
    "p1_found": _p1_sql("select raw_id from judged where len(errors) > 0"),
    "p1_rejected": _p1_sql("select raw_id, member_name, received_at, raw_line, array_to_string(errors, ',') as errors from judged where len(errors) > 0"),
    "p1_reasons": _p1_sql("select member_name, reason, count(*) as n_rows from (select member_name, unnest(errors) as reason from judged) group by all"),
    "p1_loaded": _p1_sql(
        """select raw_id, member_name, received_at, cast(v[1] as bigint) as "gbifID", v[2] as "occurrenceID", v[3] as "datasetKey", v[4] as "basisOfRecord",
  cast(v[5] as bigint) as "acceptedTaxonKey", v[6] as "scientificName", v[7] as "taxonRank", v[8] as "countryCode", cast(v[9] as double) as "decimalLatitude",
  cast(v[10] as double) as "decimalLongitude", v[11] as "eventDate", FIRST as "eventDate_first", LAST as "eventDate_last", v[12] as locality
from judged where len(errors) = 0"""
    ),
    "p3_found": _P3 + "select source_ordinal, country_code from found",
    "p3_by_country": _P3 + "select country_code, count(*) as n_points from found group by 1",
    "p5_found": _P5 + "select ref_table, ref_id from lost",
    "p5_by_month": _P5 + "select ref_table, strftime(t, '%Y-%m') as month, orphan_reason, count(*) as n_orphans from lost group by all",
    "p5_partial_keys": _P5_PARTIAL,
    "p6_found": _P6 + "select presence_id from seen where previous_count <> occurrence_count",
    "p6_history": _P6 + "select taxon_key, retrieved_at, presence_id, occurrence_count, previous_count from seen where previous_count <> occurrence_count",
    "p6_key_totals": """select nullif(regexp_replace(accepted_taxon_key, '[^0-9]', '', 'g'), '') as taxon_key, count(*) as n_rows, count(occurrence_count) as n_values,
  cast(sum(occurrence_count) as bigint) as sum_value, min(occurrence_count) as min_value, max(occurrence_count) as max_value from gbif_australia_presence group by 1""",
}
