"""Names, hierarchies and invalidation over parent and dependency edges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlark.session import cut


def name_collisions(names: DataFrame, key: Column, language: Column, taxon: str) -> DataFrame:
    """Keys that name more than one taxon in a language."""
    keyed = names.select(key.alias("name_key"), language.alias("language"), F.col(taxon).alias("taxon")).where(F.col("name_key").isNotNull() & F.col("taxon").isNotNull())
    return keyed.groupBy("name_key", "language").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("taxon").alias("n_taxa"), F.sort_array(F.collect_set("taxon")).alias("taxa")).where("n_taxa > 1")


def parent_edges(taxa: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Distinct child-parent edges between neighbouring known levels, lowest level first."""
    pairs = []
    for i, low in enumerate(levels[:-1]):
        up = F.coalesce(*[F.when(F.trim(h) != "", F.concat(F.lit(f"{h}:"), F.trim(h))) for h in levels[i + 1 :]])
        pairs.append(taxa.where(F.trim(low) != "").select(F.concat(F.lit(f"{low}:"), F.trim(low)).alias("child"), up.alias("parent")).where(F.col("parent").isNotNull()))
    return reduce(DataFrame.unionByName, pairs).distinct()


def ancestors(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """``node, ancestor, distance`` (the shortest); grows one level a round, until nothing is new."""
    step = edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).where("node is not null and ancestor is not null and node <> ancestor").distinct()
    known = cut(step.withColumn("distance", F.lit(1)))
    front, d = known, 1
    while True:
        d += 1
        nxt = front.select("node", F.col("ancestor").alias("via")).join(step.select(F.col("node").alias("via"), "ancestor"), "via").select("node", "ancestor").distinct()
        front = cut(nxt.where("node <> ancestor").join(known, ["node", "ancestor"], "left_anti").withColumn("distance", F.lit(d)))
        if front.isEmpty():
            return known
        known = cut(known.unionByName(front))


def lowest_common(members: DataFrame, group: str, node: str, paths: DataFrame) -> DataFrame:
    """The lowest node above (or equal to) all members of a group: ancestors shared by all,
    of which the one with the most ancestors of its own is lowest."""
    selves = members.select(group, node).where(F.col(node).isNotNull()).distinct()
    above = selves.join(paths.select(F.col("node").alias(node), "ancestor"), node).select(group, node, "ancestor").unionByName(selves.withColumn("ancestor", F.col(node)))
    n = selves.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    shared = above.groupBy(group, "ancestor").agg(F.count_distinct(node).alias("k")).join(n, group).where("k = n")
    depth = paths.groupBy("node").agg(F.count(F.lit(1)).alias("depth")).select(F.col("node").alias("ancestor"), "depth")
    ranked = shared.join(depth, "ancestor", "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    best = F.min(F.struct((-F.col("depth")).alias("minus"), F.col("ancestor").alias("a")))
    return ranked.groupBy(group).agg(best.alias("b")).select(group, F.col("b.a").alias("common"))


def query_rows(names: DataFrame, term: str, order: Sequence[Column]) -> DataFrame:
    """Two queries per term, one on tags and one on text, with a digest as identity."""
    rows = names.select("*", F.explode(F.array(F.lit("tags"), F.lit("text"))).alias("field"))
    return rows.withColumn("query_id", F.sha2(F.concat_ws("|", "field", F.lower(term)), 256))


def invalidated(edges: DataFrame, changed: DataFrame, node: str = "node") -> DataFrame:
    """Everything downstream of changed artifacts, with the shortest distance."""
    seen = cut(changed.select(F.col(node).alias("node"), F.lit(0).alias("distance")).distinct())
    front, d = seen, 0
    while True:
        d += 1
        nxt = front.join(edges.select(F.col("source").alias("node"), "target"), "node").select(F.col("target").alias("node")).distinct()
        front = cut(nxt.join(seen, "node", "left_anti").withColumn("distance", F.lit(d)))
        if front.isEmpty():
            return seen
        seen = cut(seen.unionByName(front))


# Words that stand where no epithet is known.
NO_EPITHET = ("sp", "sp.", "spp", "spp.", "indet", "indet.")


def species_repair(name: Column, evidence: Sequence[Column]) -> list[Column]:
    """``derived_species``, the genus and epithet that a name of species rank begins with, and the
    ``status`` of the repair: PASS where the name and all evidence of the same record are there."""
    words = F.split(F.trim(name), r"\s+")
    genus, epithet = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    sound = genus.rlike(r"\A[A-Z][\p{L}.'-]+\z") & epithet.rlike(r"\A\p{Ll}[\p{L}.'-]*\z") & ~F.lower(epithet).isin(*NO_EPITHET)
    found = F.when(sound, F.concat_ws(" ", genus, epithet))
    there = reduce(lambda a, b: a & b, [F.coalesce(F.trim(c) != "", F.lit(False)) for c in evidence])
    return [found.alias("derived_species"), F.when(found.isNotNull() & there, "PASS").otherwise("UNKNOWN").alias("status")]


def resolved_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One row per key: its label where all its rows agree, else CONFLICT and no label. Rows without
    key or label say nothing."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    per = known.groupBy(key).agg(F.min(label).alias("low"), F.max(label).alias("high"), F.count(F.lit(1)).alias("n_rows"))
    same = F.col("low") == F.col("high")
    return per.select(key, F.when(same, F.col("low")).alias(label), F.when(~same, "CONFLICT").when(F.col("n_rows") > 1, "REPEATED").otherwise("SINGLE").alias("label_status"), "n_rows")
