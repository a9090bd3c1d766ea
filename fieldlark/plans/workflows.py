"""Queries of selection, planning, profiling and model fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlark.functions import scalars, vectors
from fieldlark.functions.scalars import first_known, nonblank
from fieldlark.operators import evaluation, sampling, selection
from fieldlark.plans.register import Register
from fieldlark.session import table

query = Register()
QUERIES, SQL = query.queries, query.sql


# ---------------------------------------------------------------- profiles and reports


@query("""with b as (select coalesce(nullif(trim(species), ''), '<MISSING>') as species, "gbifID", publisher, "countryCode", "datasetKey" from occurrence_source),
p as (select species, count(*) as n_rows, count(distinct "gbifID") as n_ids, count(distinct publisher) as n_publishers, count(distinct "countryCode") as n_countries, count(distinct "datasetKey") as n_datasets from b group by 1)
select *, list_filter([case when n_publishers <= 1 then 'one_publisher' end, case when n_countries <= 1 then 'one_country' end, case when n_rows < 5 then 'few_rows' end], lambda x: x is not null) as flags from p""", lists=("flags",))
def w_species_bias(spark, d):
    b = table(spark, d, "occurrence_source").withColumn("species", first_known(F.col("species")))
    p = b.groupBy("species").agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_distinct(c).alias(n) for c, n in (("gbifID", "n_ids"), ("publisher", "n_publishers"), ("countryCode", "n_countries"), ("datasetKey", "n_datasets"))])
    return p.withColumn("flags", scalars.reasons({"one_publisher": F.col("n_publishers") <= 1, "one_country": F.col("n_countries") <= 1, "few_rows": F.col("n_rows") < 5}))


@query("""select coalesce(nullif(trim(media_publisher), ''), '<MISSING>') as provider, count(*) as n_rows, count(*) filter (media_license is null) as n_no_licence, count(*) filter (nullif(trim(media_creator), '') is null) as n_no_creator,
  count(*) filter (nullif(trim("media_rightsHolder"), '') is null) as n_no_holder, count(*) filter (media_license is not null and (trim(media_creator) <> '' or trim("media_rightsHolder") <> '') and trim(media_identifier) <> '') as n_attributable from gbif_media group by 1""")
def w_provider_rights(spark, d):
    m = table(spark, d, "gbif_media")
    blank = lambda c: nonblank(F.col(c)).isNull()
    ready = F.col("media_license").isNotNull() & (~blank("media_creator") | ~blank("media_rightsHolder")) & ~blank("media_identifier")
    return m.groupBy(first_known(F.col("media_publisher")).alias("provider")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("media_license").isNull()).alias("n_no_licence"), F.count_if(blank("media_creator")).alias("n_no_creator"), F.count_if(blank("media_rightsHolder")).alias("n_no_holder"), F.count_if(ready).alias("n_attributable")
    )


@query("""select coalesce("countryCode", '<NULL>') as country, count(*) as n_rows, count(distinct "gbifID") as n_ids, round(avg((nullif(trim("decimalLatitude"), '') is not null)::int), 9) as located, round(avg(("eventDate" is not null)::int), 9) as dated,
  round(avg((species is not null)::int), 9) as named, cast(sum(case when is_deleted then 1 else 0 end) as bigint) as n_deleted, min(ingested_at) as first_seen, max(ingested_at) as last_seen from occurrence_source group by 1""")
def w_scorecard(spark, d):
    share = lambda c, n: F.round(F.avg(c.cast("int")), 9).alias(n)
    return table(spark, d, "occurrence_source").groupBy(F.coalesce("countryCode", F.lit("<NULL>")).alias("country")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("gbifID").alias("n_ids"), share(nonblank(F.col("decimalLatitude")).isNotNull(), "located"), share(F.col("eventDate").isNotNull(), "dated"),
        share(F.col("species").isNotNull(), "named"), F.count_if("is_deleted").alias("n_deleted"), F.min("ingested_at").alias("first_seen"), F.max("ingested_at").alias("last_seen"),
    )


@query("""select 'occurrence_source' as name, count(*) as n_rows, count(distinct source_ordinal) as n_keys, min(source_ordinal) as low, max(source_ordinal) as high, cast(sum(source_ordinal) as bigint) as total from occurrence_source
  union all select 'gbif_media', count(*), count(distinct source_media_row_number), min(source_media_row_number), max(source_media_row_number), cast(sum(source_media_row_number) as bigint) from gbif_media""")
def w_reconciliation(spark, d):
    def one(t, k):
        return table(spark, d, t).agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(k).alias("n_keys"), F.min(k).alias("low"), F.max(k).alias("high"), F.sum(k).alias("total")).select("name", "n_rows", "n_keys", "low", "high", "total")

    return one("occurrence_source", "source_ordinal").unionByName(one("gbif_media", "source_media_row_number"))


# ---------------------------------------------------------------- work lists


@query("""with h as (select user_id, event_type, max(ts) as seen, count(*) as n from events group by 1, 2), l as (select user_id, arg_max(event_type, (ts, event_id)) as newest from events group by 1)
select l.user_id, newest, (select string_agg(event_type || ':' || n, ',' order by event_type) from h where h.user_id = l.user_id) as hits from l""")
def w_workload_canonical(spark, d):
    """One row per item with its newest hit, and every kind of hit kept as a sorted list."""
    e = table(spark, d, "events")
    newest = e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("newest"))
    hits = e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    lists = hits.groupBy("user_id").agg(F.array_sort(F.collect_list(F.concat_ws(":", "event_type", "n"))).alias("h"))
    return newest.join(lists, "user_id").select("user_id", "newest", F.concat_ws(",", "h").alias("hits"))


@query("""select species, cast(page as int) as page, least(n - (page - 1) * 10, 10) as page_rows from (select species, count(*) as n from occurrence_source where species is not null group by 1), unnest(range(1, cast(ceil(n / 10) as bigint) + 1)) as t(page)""")
def w_page_plan(spark, d):
    totals = table(spark, d, "occurrence_source").where(F.col("species").isNotNull()).groupBy("species").agg(F.count(F.lit(1)).alias("n"))
    pages = totals.select("species", "n", F.explode(F.sequence(F.lit(1), F.ceil(F.col("n") / 10).cast("int"))).alias("page"))
    return pages.select("species", "page", F.least(F.col("n") - (F.col("page") - 1) * 10, F.lit(10)).alias("page_rows"))


@query("""with c as (select trim("gbifID") as k, count(*) as v from occurrence_source group by 1), r as (select source_media_row_number as id, trim("gbifID") as k from gbif_media)
select id, case when c.k is null then 'COMPUTE' when v = 1 then 'REUSE' else 'REFRESH' end as action from r left join c using (k)""")
def w_reuse_plan(spark, d):
    cache = table(spark, d, "occurrence_source").groupBy(F.trim("gbifID").alias("k")).agg(F.count(F.lit(1)).alias("v"))
    asked = table(spark, d, "gbif_media").select(F.col("source_media_row_number").alias("id"), F.trim("gbifID").alias("k"))
    return selection.reuse_plan(asked, cache, "k", F.lit(1).cast("bigint"), "v").select("id", "action")


@query("""with u as (select distinct "countryCode" as country, species, 'recorded' as reason from occurrence_source where "countryCode" is not null and species is not null
  union select distinct "countryCode", species, 'specimen' from occurrence_source where "basisOfRecord" = 'PRESERVED_SPECIMEN' and "countryCode" is not null and species is not null
  union select distinct "countryCode", species, 'larval' from occurrence_source where lower("lifeStage") = 'larva' and "countryCode" is not null and species is not null)
select country, species, list_sort(list(reason)) as reasons from u group by 1, 2""", lists=("reasons",))
def w_candidate_union(spark, d):
    o = table(spark, d, "occurrence_source").where(F.col("countryCode").isNotNull() & F.col("species").isNotNull()).withColumn("country", F.col("countryCode"))
    return selection.reason_union({"recorded": o, "specimen": o.where("basisOfRecord = 'PRESERVED_SPECIMEN'"), "larval": o.where(F.lower("lifeStage") == "larva")}, ["country", "species"])


@query("""select country, species, count(*) as n, count(distinct "datasetKey") as n_datasets, min(d) as first_day, max(d) as last_day, case when count(*) = count(u) then round(avg(1 / (1 + u / 1000)), 9) end as confidence
from (select "countryCode" as country, species, "datasetKey", case when regexp_full_match("eventDate", '[0-9]{4}-[0-9]{2}-[0-9]{2}') then try_cast("eventDate" as date) end as d, try_cast("coordinateUncertaintyInMeters" as double) as u from occurrence_source where species is not null) group by 1, 2""")
def w_regional_occurrence(spark, d):
    """Per country and species: counts, days, and a confidence only where every uncertainty is known."""
    day = F.when(F.col("eventDate").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.col("eventDate").try_cast("date"))
    o = table(spark, d, "occurrence_source").where(F.col("species").isNotNull()).select(F.col("countryCode").alias("country"), "species", "datasetKey", day.alias("d"), F.col("coordinateUncertaintyInMeters").try_cast("double").alias("u"))
    full = F.count(F.lit(1)) == F.count("u")
    return o.groupBy("country", "species").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("datasetKey").alias("n_datasets"), F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.when(full, F.round(F.avg(1 / (1 + F.col("u") / 1000)), 9)).alias("confidence"))


@query("""with a as (select source_media_row_number as id, coalesce(nullif(trim(media_publisher), ''), '?') as host, coalesce(nullif(trim(media_creator), ''), '?') as creator from gbif_media), b as (select *, row_number() over (partition by host, creator order by id) as k from a), c as (select *, row_number() over (partition by host order by id) as place from b where k <= 2)
select host, id, cast(place as int) as place from c where place <= 10""")
def w_quota_pick(spark, d):
    m = table(spark, d, "gbif_media").select(F.col("source_media_row_number").alias("id"), first_known(F.col("media_publisher"), missing="?").alias("host"), first_known(F.col("media_creator"), missing="?").alias("creator"))
    return selection.quota_pick(m, ["host"], ["id"], 10, "creator", 2).select("host", "id", "place")


@query("""with last as (select o_orderkey % 500 as request, o_custkey % 7 as reviewer, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as d from orders group by 1, 2)
select request, count(*) as n_reviewers, list_sort(list(distinct d)) as decisions, case when count(distinct d) > 1 then 'CONFLICT' else min(d) end as outcome from last group by 1""", lists=("decisions",))
def w_review_outcome(spark, d):
    o = table(spark, d, "orders").withColumns({"request": F.col("o_orderkey") % 500, "reviewer": F.col("o_custkey") % 7})
    return selection.review_outcome(o, "request", "reviewer", ["o_orderdate", "o_orderkey"], "o_orderstatus")


@query("""with recursive o as (select l_orderkey, l_linenumber, cast(l_quantity as int) as units, row_number() over (partition by l_orderkey order by l_linenumber, l_quantity) as k from lineitem),
f as (select l_orderkey, l_linenumber, k, 0 as batch, units as used from o where k = 1 union all
  select o.l_orderkey, o.l_linenumber, o.k, f.batch + (f.used > 0 and f.used + o.units > 60)::int, case when f.used > 0 and f.used + o.units > 60 then o.units else f.used + o.units end from f join o on o.l_orderkey = f.l_orderkey and o.k = f.k + 1)
select l_orderkey, l_linenumber, batch from f""")
def w_greedy_batches(spark, d):
    """Work items of an order in line order, packed up to a capacity."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("units"))
    return selection.greedy_batches(li, "l_orderkey", "l_linenumber", "units", 60)


@query("""with s as (select prediction_id, photographer_id, leakage_component_id as c, list_reverse_sort(decision_scores)[1] - list_reverse_sort(decision_scores)[2] as margin from calibration_prediction),
ch as (select distinct leakage_component_id as c from calibration_prediction where fold_index = 0 and leakage_component_id is not null)
select prediction_id, list_filter([case when ch.c is not null then 'CANDIDATE_CHANGED' end, case when margin <= 0.05 then 'NARROW_MARGIN' end], lambda x: x is not null) as rescore_reasons from s left join ch using (c)""", lists=("rescore_reasons",))
def w_selective_rescore(spark, d):
    c = table(spark, d, "calibration_prediction")
    s = c.select("prediction_id", F.array_compact(F.array("leakage_component_id")).alias("candidates"), vectors.margin(F.col("decision_scores")).alias("margin"))
    changed = c.where("fold_index = 0 and leakage_component_id is not null").select(F.col("leakage_component_id").alias("item"))
    return selection.rescore_plan(s, changed, "item", "prediction_id", "candidates", "margin", 0.05).select("prediction_id", "rescore_reasons")


@query("""with used as (select doc_id from doc_labels), pool as (select d.doc_id, d.lang from documents d where doc_id not in (select doc_id from used)), t as (select count(*) as t from pool), s as (select lang, count(*) as n from pool group by 1),
r as (select p.doc_id, p.lang, n, least(n, greatest(1, cast(round(n * (100 / t)) as bigint))) as take, row_number() over (partition by p.lang order by sha256('stream:' || cast(p.doc_id as varchar)), p.doc_id) as rn from pool p join s on p.lang = s.lang, t)
select doc_id, lang, round(take / n, 9) as inclusion_probability, round(n / take, 6) as weight from r where rn <= take""")
def w_natural_stream(spark, d):
    """A proportional sample of what has not been used yet, with inclusion probability and weight."""
    pool = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "doc_labels").select("doc_id"), "doc_id", "left_anti")
    out = sampling.probability_sample(pool, ["lang"], "doc_id", 100, "stream")
    return out.select("doc_id", "lang", F.round("inclusion_probability", 9).alias("inclusion_probability"), F.round("weight", 6).alias("weight"))


@query("""select split_a, split_b, n from (select split_a, split_b, count(distinct source_item_id) as n from (select a.source_item_id, lower(trim(a.dataset_split)) as split_a, lower(trim(b.dataset_split)) as split_b from calibration_prediction a join calibration_prediction b using (source_item_id)
  where lower(trim(a.dataset_split)) < lower(trim(b.dataset_split)) and trim(a.dataset_split) <> '' and trim(b.dataset_split) <> '') group by 1, 2)""")
def w_split_contact(spark, d):
    """How many items stand in each pair of splits: splits per item first, so no item is squared by its rows."""
    c = table(spark, d, "calibration_prediction").where(F.col("source_item_id").isNotNull() & (F.trim("dataset_split") != ""))
    per = c.groupBy("source_item_id").agg(F.sort_array(F.collect_set(F.lower(F.trim("dataset_split")))).alias("s")).where(F.size("s") > 1)
    pairs = per.select(F.explode(F.filter(F.flatten(F.transform("s", lambda a: F.transform("s", lambda b: F.struct(a.alias("split_a"), b.alias("split_b"))))), lambda p: p["split_a"] < p["split_b"])).alias("p"))
    return pairs.groupBy("p.split_a", "p.split_b").agg(F.count(F.lit(1)).alias("n"))


@query("""with recursive x as (select decision_scores[1] as s, true_class_label = 'target' as t, sample_weight as w, coalesce('c:' || leakage_component_id, 'p:' || prediction_id) as c from calibration_prediction
    where lower(trim(dataset_split)) = 'model_selection' and decision_scores[1] is not null and true_class_label is not null and sample_weight is not null),
th as (select distinct s as threshold from x),
r as (select threshold, count(*) filter (t) as hits, count(*) as n, sum(w) as weight, coalesce(sum(w) filter (t), 0) as hit_w, sum(w * w) as ww from th join x on s >= threshold group by 1),
k as (select c, max(s) as top, max(s) filter (not t) as miss from x group by 1),
cc as (select threshold, count(*) as trials, count(*) filter (miss is null or miss < threshold) as succ from th join k on top >= threshold group by 1),
b as (select distinct succ, trials, 0::double as lo, 1 - 1e-15::double as hi, 0 as step from cc union all
  select succ, trials, case when tail < 0.05 then mid else lo end, case when tail < 0.05 then hi else mid end, step + 1 from (
    select *, (lo + hi) / 2 as mid, list_sum(list_transform(range(succ, trials + 1), lambda i: exp(lgamma(trials + 1) - lgamma(i + 1) - lgamma(trials - i + 1) + i * ln((lo + hi) / 2) + (trials - i) * ln(1 - (lo + hi) / 2)))) as tail from b where step < 45)),
m as (select threshold, hits, n, weight, least(hit_w / weight, 1) as p, weight * weight / ww as en, succ, trials, round(case when succ = 0 then 0.0 else (lo + hi) / 2 end, 9) as component_low, weight / (select sum(w) from x) as coverage, 1.6448536269514722 as z
  from r join cc using (threshold) join b using (succ, trials) where step = 45),
g as (select *, round(greatest(0, (p + z * z / 2 / en) / (1 + z * z / en) - z * sqrt(p * (1 - p) / en + z * z / 4 / (en * en)) / (1 + z * z / en)), 9) as weighted_low from m),
a as (select *, least(weighted_low, component_low) as low, n >= 30 and trials >= 30 and least(weighted_low, component_low) >= 0.3 as accepted from g)
select threshold, hits, n, round(weight, 6) as weight, round(p, 9) as "precision", round(en, 4) as effective_n, weighted_low, succ as component_hits, trials as components, component_low, low, round(coverage, 9) as coverage, accepted,
  accepted and row_number() over (order by accepted desc, coverage desc, low desc, threshold) = 1 as selected from a""")
def w_audited_threshold(spark, d):
    """Every distinct score of the validation rows as a cut-off with its bounds; the gate is a bound
    of at least 0.3. Model selection is the split for validation; a row without a leakage
    component is a component of its own."""
    c = table(spark, d, "calibration_prediction").where(F.lower(F.trim("dataset_split")) == "model_selection")
    component = F.coalesce(F.concat(F.lit("c:"), "leakage_component_id"), F.concat(F.lit("p:"), "prediction_id"))
    return evaluation.audited_thresholds(c, F.col("true_class_label") == "target", F.get("decision_scores", F.lit(0)), F.col("sample_weight"), component, 0.3)


@query("""with p as (select lower(nullif(trim(dataset_split), '')) as split, true_class_label = 'target' as truth, decision_scores[1] >= 0.5 as said, sample_weight as w from calibration_prediction where decision_scores[1] is not null and true_class_label is not null and sample_weight is not null),
m as (select split, sum(w) filter (truth and said) / nullif(sum(w) filter (said), 0) as "precision", sum(w) filter (truth and said) / nullif(sum(w) filter (truth), 0) as recall, sum(w) as weight from p group by 1)
select split, round("precision", 9) as "precision", round(recall, 9) as recall, list_filter([case when "precision" < 0.8 then 'LOW_PRECISION' end, case when recall < 0.6 then 'LOW_RECALL' end, case when weight < 500 then 'FEW_ITEMS' end], lambda x: x is not null) as rules from m""", lists=("rules",))
def w_escalation_rules(spark, d):
    c = table(spark, d, "calibration_prediction")
    p = c.select(F.lower(nonblank(F.col("dataset_split"))).alias("split"), (F.col("true_class_label") == "target").alias("truth"), (F.get("decision_scores", F.lit(0)) >= 0.5).alias("said"), F.col("sample_weight").alias("w")).where("truth is not null and said is not null and w is not null")
    m = p.groupBy("split").agg(
        F.try_divide(F.sum(F.when(F.col("truth") & F.col("said"), F.col("w"))), F.sum(F.when(F.col("said"), F.col("w")))).alias("precision"),
        F.try_divide(F.sum(F.when(F.col("truth") & F.col("said"), F.col("w"))), F.sum(F.when(F.col("truth"), F.col("w")))).alias("recall"),
        F.sum("w").alias("weight"),
    )
    rules = scalars.reasons({"LOW_PRECISION": F.col("precision") < 0.8, "LOW_RECALL": F.col("recall") < 0.6, "FEW_ITEMS": F.col("weight") < 500})
    return m.select("split", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"), rules.alias("rules"))


# ---------------------------------------------------------------- detection and prompts


@query("""with t as (select vec_id, {'x1': abs(embedding[1]), 'y1': abs(embedding[2]), 'x2': abs(embedding[1]) + 1, 'y2': abs(embedding[2]) + 1} as a, {'x1': abs(embedding[3]), 'y1': abs(embedding[4]), 'x2': abs(embedding[3]) + 1, 'y2': abs(embedding[4]) + 1} as b from embeddings),
i as (select vec_id, greatest(0, least(a.x2, b.x2)::double - greatest(a.x1, b.x1)::double) * greatest(0, least(a.y2, b.y2)::double - greatest(a.y1, b.y1)::double) as inter, (a.x2::double - a.x1::double) * (a.y2::double - a.y1::double) + (b.x2::double - b.x1::double) * (b.y2::double - b.y1::double) as total from t)
select vec_id, round(inter / (total - inter), 4) as iou from i""")
def w_box_overlap(spark, d):
    """Overlap of two unit boxes per row, placed by the first components of a vector."""
    at = lambda i: F.abs(F.get("embedding", F.lit(i))).cast("double")
    box = lambda i: [at(i), at(i + 1), (F.abs(F.get("embedding", F.lit(i))) + 1).cast("double"), (F.abs(F.get("embedding", F.lit(i + 1))) + 1).cast("double")]
    return table(spark, d, "embeddings").select("vec_id", F.round(vectors.iou(box(0), box(2)), 4).alias("iou"))


@query("""select species, t.template, replace(t.template, '{name}', species) as prompt, sha256(replace(t.template, '{name}', species)) as prompt_id from (select distinct trim(species) as species from occurrence_source where trim(species) <> '') s, (values ('a photo of {name}'), ('a drawing of {name}'), ('{name} on a plant')) as t(template)""")
def w_prompt_variants(spark, d):
    s = table(spark, d, "occurrence_source").where(F.trim("species") != "").select(F.trim("species").alias("species")).distinct()
    # Wordings of a prompt.
    wordings = F.array(F.lit("a photo of {name}"), F.lit("a drawing of {name}"), F.lit("{name} on a plant"))
    rows = s.select("species", F.explode(wordings).alias("template"))
    prompt = F.replace(F.col("template"), F.lit("{name}"), F.col("species"))
    return rows.select("species", "template", prompt.alias("prompt"), F.sha2(prompt, 256).alias("prompt_id"))


# ---------------------------------------------------------------- model fitting


def _training(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "calibration_prediction")
    return c.select("prediction_id", "decision_scores", (F.col("true_class_label") == "target").cast("double").alias("y"), F.col("sample_weight").alias("w"), F.lower(nonblank(F.col("dataset_split"))).alias("split")).where("y is not null and w is not null and decision_scores is not null")


@query()
def w_classifier(spark, d):
    """A logistic model of the target on the scores, fitted on the training split by
    distributed optimisation, and its measures on every split."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = _training(spark, d).withColumn("features", array_to_vector("decision_scores"))
    model = LogisticRegression(featuresCol="features", labelCol="y", weightCol="w", maxIter=25, regParam=0.01).fit(rows.where("split = 'support_train'"))
    scored = model.transform(rows).withColumn("p", vector_to_array("probability")[1])
    auc = evaluation.roc_auc(scored, ["split"], F.col("y") == 1, F.col("p"), F.col("w"))
    brier = evaluation.proper_scores(scored, ["split"], F.col("y") == 1, F.col("p"), F.col("w")).withColumnRenamed("split", "s")
    return auc.join(brier, F.col("split").eqNullSafe(F.col("s"))).drop("s")


@query()
def w_platt_and_temperature(spark, d):
    """Platt and temperature scaling fitted on the logit of every distinct score."""
    rows = _training(spark, d).withColumn("p", F.least(F.greatest(F.get("decision_scores", F.lit(0)), F.lit(1e-6)), F.lit(1 - 1e-6)))
    a, b, t = evaluation.logit_scaling(rows, F.col("y") == 1, F.ln(F.col("p") / (1 - F.col("p"))), F.col("w"))
    return spark.createDataFrame([(a, b, 1 / t if t else None)], "platt_slope double, platt_offset double, temperature double")
