"""Copies within one table of reference images: components over all splits.

Edges are those of the reference deduplication. Valid images (``decode_status``) with one
digest, or with one hash, link to the smallest id among them; hashes at most ``RADIUS`` bits
apart link the smallest ids of both; hashes at most ``SAME_RADIUS`` bits apart link where both
occur in one observation; a mirror links where one of the two images is valid. Every edge
joins, as there, also one that needs a review; ``resolved`` tells components without any.

An edge is resolved if the digests are equal; else if it is a mirror, unless both images are
valid and their hashes do not confirm it; else if it stays in one observation and both hashes
are informative and the shapes agree. The images of the black or white hash are therefore one
component, but not a resolved one.

Defined results: NULL, blank or malformed digests, hashes and links are no evidence; images
that are not valid are not given out, but may bridge mirrors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlark.llm import overlap
from fieldlark.operators.graph import same_component
from fieldlark.session import cut

SAME_RADIUS = 8


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(f"hi{a}").bitwiseXOR(F.col(f"hi{b}"))) + F.bit_count(F.col(f"lo{a}").bitwiseXOR(F.col(f"lo{b}")))


def _images(media: DataFrame, observations: DataFrame) -> DataFrame:
    """``id, valid, sha, hi, lo, w, h, mirrors, obs``; only valid images have digest and hash."""
    valid = F.coalesce(F.lower(F.trim("decode_status")) == "valid", F.lit(False))
    text = F.nullif(F.regexp_extract(F.lower(F.trim("perceptual_hash")), r"\Adhash128-v1:([0-9a-f]{32})\z", 1), F.lit(""))
    rows = media.select(
        F.nullif(F.trim("reference_media_id"), F.lit("")).alias("id"), valid.alias("valid"), F.when(valid, overlap.digest(F.col("sha256"))).alias("sha"), F.when(valid, text).alias("hash"),
        F.col("decoded_width").cast("double").alias("w"), F.col("decoded_height").cast("double").alias("h"), F.col("provider_mirror_ids").alias("mirrors"),
    ).where("id is not null").dropDuplicates(["id"])
    seen = observations.select(F.col("media_id").alias("id"), "observation_id").where("id is not null and observation_id is not null").groupBy("id").agg(F.collect_set("observation_id").alias("obs"))
    return rows.withColumns({"hi": overlap._half("hash", 1), "lo": overlap._half("hash", 17)}).drop("hash").join(seen, "id", "left")


def _edges(rows: DataFrame) -> DataFrame:
    """Distinct ``a, b, mirror, near`` with ``a < b``."""
    ends = lambda df, x, y, mirror, near: df.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), F.lit(mirror).alias("mirror"), F.lit(near).alias("near"))
    hashed = rows.where("hi is not null").select("id", "hi", "lo", "obs")
    out = []
    for keys, near in ((["sha"], False), (["hi", "lo"], True)):
        known = rows.where(F.col(keys[0]).isNotNull()).select("id", *keys)
        first = known.groupBy(*keys).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        out.append(ends(known.join(first, keys), "id", "first", False, near))
    # Each hash stands on both sides, so that the band join compares all with all.
    firsts = hashed.groupBy("hi", "lo").agg(F.min("id").alias("first"))
    sides = F.explode(F.array(F.lit(True), F.lit(False))).alias("train")
    met = overlap.near_hashes(firsts.select("hi", "lo", sides)).where("(hi_a, lo_a) < (hi_b, lo_b)")
    side = lambda x: firsts.select(F.col("hi").alias(f"hi_{x}"), F.col("lo").alias(f"lo_{x}"), F.col("first").alias(x))
    out.append(ends(met.join(side("a"), ["hi_a", "lo_a"]).join(side("b"), ["hi_b", "lo_b"]), "a", "b", False, True))
    # Within one observation the larger radius holds; the smallest shared observation gives the pair.
    held = hashed.select("id", "hi", "lo", F.explode("obs").alias("o")).groupBy("o", "hi", "lo").agg(F.max("id").alias("last"))
    one = lambda x: held.select("o", F.col("hi").alias(f"hi_{x}"), F.col("lo").alias(f"lo_{x}"), F.col("last").alias(x))
    shared = one("a").join(one("b"), "o").where("(hi_a, lo_a) < (hi_b, lo_b)").where(_apart("_a", "_b").between(overlap.RADIUS + 1, SAME_RADIUS))
    shared = shared.groupBy("hi_a", "lo_a", "hi_b", "lo_b").agg(F.min(F.struct("o", "a", "b")).alias("m")).select("m.a", "m.b")
    out.append(ends(shared, "a", "b", False, True))
    named = rows.where(F.size("mirrors") > 0).select("id", "valid", F.explode("mirrors").alias("m")).select("id", "valid", F.nullif(F.trim("m"), F.lit("")).alias("m"))
    there = rows.select(F.col("id").alias("m"), F.col("valid").alias("m_valid"))
    out.append(ends(named.join(there, "m").where("valid or m_valid"), "id", "m", True, False))
    return reduce(DataFrame.unionByName, out).groupBy("a", "b").agg(F.max("mirror").alias("mirror"), F.max("near").alias("near"))


def _judged(edges: DataFrame, rows: DataFrame) -> DataFrame:
    """``a, b, sha256, mirror, perceptual, resolved``."""
    side = lambda x: rows.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("valid", "sha", "hi", "lo", "w", "h", "obs")])
    e = edges.join(side("a"), "a").join(side("b"), "b")
    yes = lambda c: F.coalesce(c, F.lit(False))
    long, short = (lambda x: F.greatest(f"w_{x}", f"h_{x}")), (lambda x: F.least(f"w_{x}", f"h_{x}"))
    one, two = long("a") * short("b"), long("b") * short("a")
    shaped = (F.col("w_a") > 0) & (F.col("h_a") > 0) & (F.col("w_b") > 0) & (F.col("h_b") > 0) & (F.try_divide(F.abs(one - two), F.greatest(one, two)) <= overlap.ASPECT)
    ones = [F.bit_count(f"hi_{x}") + F.bit_count(f"lo_{x}") for x in "ab"]
    telling = yes(shaped & ones[0].between(overlap.LEAST_BITS, overlap.BITS - overlap.LEAST_BITS) & ones[1].between(overlap.LEAST_BITS, overlap.BITS - overlap.LEAST_BITS))
    same = yes(F.arrays_overlap("obs_a", "obs_b"))
    close = yes(_apart("_a", "_b") <= F.when(same, SAME_RADIUS).otherwise(overlap.RADIUS))
    sha = yes(F.col("sha_a") == F.col("sha_b"))
    confirmed = ~(F.col("valid_a") & F.col("valid_b")) | (close & telling)
    resolved = F.when(sha, F.lit(True)).when(F.col("mirror"), confirmed).otherwise(same & telling)
    return e.select("a", "b", sha.alias("sha256"), "mirror", F.col("near").alias("perceptual"), resolved.alias("resolved"))


def duplicate_components(media: DataFrame, observations: DataFrame) -> DataFrame:
    """``id, component, n_members, sha256, mirror, perceptual, resolved`` for every valid image;
    the smallest id names the component, ``n_members`` counts its valid images and the flags say
    which evidence it has. ``observations`` has ``media_id, observation_id``."""
    rows = cut(_images(media, observations))
    edges = cut(_judged(_edges(rows), rows))
    groups = same_component(edges, "a", "b")
    kinds = edges.join(groups, F.col("a") == F.col("node")).groupBy("component").agg(*[F.max(k).alias(k) for k in ("sha256", "mirror", "perceptual")], F.min("resolved").alias("resolved"))
    valid = rows.where("valid").select("id").join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = valid.groupBy("component").agg(F.count(F.lit(1)).alias("n_members"))
    out = valid.join(sizes, "component").join(kinds, "component", "left")
    flags = [F.coalesce(k, F.lit(k == "resolved")).alias(k) for k in ("sha256", "mirror", "perceptual", "resolved")]
    return out.select("id", "component", "n_members", *flags)
