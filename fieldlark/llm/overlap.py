"""Same or near-same records across splits.

Four kinds of evidence link a training record with a record of another split:
``sha256`` (equal digests once case, prefix, punctuation and blanks are normalised away),
``perceptual`` (128-bit difference hashes at most ``RADIUS`` bits apart and of about the
same aspect ratio), ``mirror`` (one names the other) and ``canonical`` (both name one
canonical record and neither is an unresolved candidate).

The table is read once and written as canonical columns. Each record then gives one hash of
kind and canonical text for every piece of evidence that is an equality, mirrors included
(the record that names and the one that is named give the same hash), and one join of the
evaluation hashes with the training hashes finds all three kinds. The hash is 128 bits wide,
two 64-bit hashes with the parts in either order.

Near hashes are found by the pigeonhole principle: 128 bits fall into ``RADIUS + 1`` bands,
one of which must agree. Only distinct hashes enter the band join, so copies of one image
cost one row; a band value under which too many of both sides meet is split by ``RADIUS + 1``
bands of the bits that are left, and again as long as that at least halves the pairs that
meet, without losing one.
The aspect ratio is compared where pairs are given out, or, where records are, through the
least and largest ratio of a hash per ``ASPECT`` of width. Skewed join keys are left to
adaptive skew splitting.

Defined results
- NULL or blank splits, ids, digests, hashes and links are no evidence; a width or height
  that is NULL or not positive gives no aspect ratio and so no perceptual link.
- Digests must have 64 hex digits, hashes the prefix ``dhash128-v1`` and 32 hex digits;
  hashes with fewer than ``LEAST_BITS`` ones or zeros say nothing.
- Repeated rows give one pair; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlark.session import cut

TRAIN = "support_train"
RADIUS, LEAST_BITS, ASPECT = 4, 8, 0.05
BITS = 128
HOT = 5_000
KINDS = ("sha256", "perceptual", "mirror", "canonical")


def canonical_text(c: Column) -> Column:
    """Lower case, without punctuation and blanks."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))


def digest(c: Column) -> Column:
    t = canonical_text(c)
    return F.nullif(F.regexp_extract(t, r"\A(?:sha256)?([0-9a-f]{64})\z", 1), F.lit(""))


def _tidy(c: str) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def prepared(media: DataFrame) -> DataFrame:
    """The records that can be evidence, in canonical columns: ``id, split, train, source, sha,
    canonical, mirrors`` and, for those that can be near others, the halves of the hash ``hi, lo``
    and the aspect ``ratio``. Read once and written to the shared folder."""
    split = F.lower(_tidy("dataset_split"))
    unresolved = F.coalesce(F.lower(_tidy("duplicate_type")) == "unresolved_perceptual_candidate", F.lit(False))
    rows = media.select(
        _tidy("reference_media_id").alias("id"),
        split.alias("split"),
        (split == TRAIN).alias("train"),
        _tidy("source").alias("source"),
        digest(F.col("sha256")).alias("sha"),
        F.nullif(F.regexp_extract(F.lower(F.trim("perceptual_hash")), r"\Adhash128-v1:([0-9a-f]{32})\z", 1), F.lit("")).alias("hash"),
        F.when((F.col("decoded_width") > 0) & (F.col("decoded_height") > 0), F.col("decoded_width") / F.col("decoded_height")).alias("ratio"),
        F.filter(F.transform("provider_mirror_ids", lambda m: F.trim(m)), lambda m: m != "").alias("mirrors"),
        F.when(~unresolved, _tidy("canonical_reference_media_id")).alias("canonical"),
    ).where(F.col("id").isNotNull() & F.col("split").isNotNull())
    halves = rows.withColumns({"hi": _half("hash", 1), "lo": _half("hash", 17)}).drop("hash")
    telling = (F.bit_count("hi") + F.bit_count("lo")).between(LEAST_BITS, BITS - LEAST_BITS) & F.col("ratio").isNotNull()
    return cut(halves.withColumns({c: F.when(telling, F.col(c)) for c in ("hi", "lo", "ratio")}))


def record_hash(kind: Column, text: Column) -> tuple[Column, Column]:
    """128 bits for a kind of evidence and its canonical text."""
    return F.xxhash64(kind, text).alias("k1"), F.xxhash64(text, kind).alias("k2")


def _hashes(rows: DataFrame) -> DataFrame:
    """``id, train, kind, k1, k2``: one row for each piece of evidence that is an equality. Who
    names a mirror and who is named differ by side, so that two records which name the same
    third one don't meet."""
    entry = lambda kind, text: F.struct(kind.alias("kind"), text.alias("text"))
    naming, named = (F.when(F.col("train") == t, "mirror:by_train").otherwise("mirror:by_other") for t in (True, False))
    pieces = F.concat(
        F.array(entry(F.lit("sha256"), F.col("sha")), entry(F.lit("canonical"), F.col("canonical")), entry(named, F.col("id"))),
        F.coalesce(F.transform("mirrors", lambda m: entry(naming, m)), F.array().cast("array<struct<kind:string,text:string>>")),
    )
    flat = rows.select("id", "train", F.inline(F.filter(pieces, lambda p: p["text"].isNotNull())))
    return flat.select("id", "train", F.split_part("kind", F.lit(":"), F.lit(1)).alias("kind"), *record_hash(F.col("kind"), F.col("text")))


def _half(name: str, first: int) -> Column:
    """16 hex digits as one signed bigint: two 32-bit parts joined bitwise."""
    high = F.conv(F.substring(name, first, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(name, first + 8, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def _bands() -> list[Column]:
    """Five bands of 26, 26, 26, 25 and 25 bits of the 128, as numbers."""
    hi, lo = F.col("hi"), F.col("lo")
    mask = lambda n: F.lit((1 << n) - 1)
    return [
        F.shiftrightunsigned(hi, 38),
        F.shiftrightunsigned(hi, 12).bitwiseAND(mask(26)),
        F.shiftleft(hi.bitwiseAND(mask(12)), 14).bitwiseOR(F.shiftrightunsigned(lo, 50)),
        F.shiftrightunsigned(lo, 25).bitwiseAND(mask(25)),
        lo.bitwiseAND(mask(25)),
    ]


def _sub_bands(rest: Column) -> Column:
    """The bands of a text of bits that is left, each with its number and what remains beside it."""

    def piece(i: int) -> Column:
        step = F.floor(F.length(rest) / (RADIUS + 1)).cast("int")
        first = 1 + i * step
        size = step if i < RADIUS else F.length(rest)
        return F.struct(F.lit(i).alias("i"), F.substring(rest, first, size).alias("value"), F.concat(F.substring(rest, F.lit(1), F.lit(i) * step), F.substring(rest, first + size, F.length(rest))).alias("left"))

    return F.array(*[piece(i) for i in range(RADIUS + 1)])


# First character and length of each band in the text of bits.
_PLACES = ((1, 26), (27, 26), (53, 26), (79, 25), (104, 25))


def near_hashes(hashes: DataFrame, hot: int = HOT) -> DataFrame:
    """``hi_a, lo_a, hi_b, lo_b``: training and other hashes at most ``RADIUS`` bits apart, from
    distinct ``hi, lo, train``. Rows meet by a hash of the path of bands they agree in, which
    only proposes pairs: their distance is always counted."""
    keys = F.array(*[F.struct(F.xxhash64(F.lit(i), v).alias("key"), F.lit(i).alias("band")) for i, v in enumerate(_bands())])
    level = hashes.select("hi", "lo", "train", F.inline(keys)).withColumn("rest", F.lit(None).cast("string"))
    settled, bits = [], F.concat(F.lpad(F.bin("hi"), 64, "0"), F.lpad(F.bin("lo"), 64, "0"))
    first, size = (F.get(F.array(*[F.lit(x[k]) for x in _PLACES]), F.col("band")) for k in (0, 1))

    def met(rows: DataFrame) -> tuple[DataFrame, float]:
        """The crowded keys with the pairs that meet under them, and how many pairs meet at all."""
        sides = rows.groupBy("key").agg((F.count_if("train").cast("double") * F.count_if(~F.col("train")).cast("double")).alias("pairs"))
        sides = cut(sides.groupBy(F.when(F.col("pairs") > hot * hot, F.col("key")).alias("key")).agg(F.sum("pairs").alias("pairs")))
        return sides.where(F.col("key").isNotNull()), sides.agg(F.sum("pairs")).first()[0] or 0.0

    crowded, _ = met(level)
    while before := crowded.agg(F.sum("pairs")).first()[0]:
        full = level.join(crowded.select("key"), "key", "left_semi")
        left = F.coalesce("rest", F.concat(F.substring(bits, F.lit(1), first - 1), F.substring(bits, first + size, F.lit(BITS))))
        split = full.withColumn("rest", left).select("hi", "lo", "train", "key", "band", F.inline(_sub_bands(F.col("rest"))))
        below = cut(split.select("hi", "lo", "train", F.xxhash64("key", "i", "value").alias("key"), "band", F.col("left").alias("rest")))
        deeper, after = met(below)
        # Where most of those that meet are alike all over, bands tell nothing more.
        if after > before / 2:
            break
        settled.append(level.join(crowded.select("key"), "key", "left_anti").select("hi", "lo", "train", "key"))
        level, crowded = below, deeper
    settled.append(level.select("hi", "lo", "train", "key"))
    all_ = reduce(DataFrame.unionByName, settled)
    a = all_.where("train").select("key", F.col("hi").alias("hi_a"), F.col("lo").alias("lo_a"))
    b = all_.where("not train").select("key", F.col("hi").alias("hi_b"), F.col("lo").alias("lo_b"))
    apart = F.bit_count(F.col("hi_a").bitwiseXOR(F.col("hi_b"))) + F.bit_count(F.col("lo_a").bitwiseXOR(F.col("lo_b")))
    return a.join(b, "key").where(apart <= RADIUS).drop("key").distinct()


def _near(rows: DataFrame) -> DataFrame:
    return near_hashes(rows.where(F.col("hi").isNotNull()).select("hi", "lo", "train").distinct())


def overlap_pairs(media: DataFrame) -> DataFrame:
    """``train_id, other_id, kind``: every linked pair for each kind of evidence."""
    rows = prepared(media)
    keyed = _hashes(rows)
    a, b = (keyed.where(c).select(F.col("id").alias(x), "kind", "k1", "k2") for c, x in (("train", "a"), ("not train", "b")))
    same = a.join(b.drop("kind"), ["k1", "k2"]).select("a", "b", "kind")
    side = lambda c, x: rows.where(c).where(F.col("hi").isNotNull()).select(F.col("id").alias(x), *[F.col(k).alias(f"{k}_{x}") for k in ("hi", "lo", "ratio")])
    near = _near(rows).join(side("train", "a"), ["hi_a", "lo_a"]).join(side("not train", "b"), ["hi_b", "lo_b"])
    near = near.where(F.abs(F.col("ratio_a") - F.col("ratio_b")) <= ASPECT).select("a", "b", F.lit("perceptual").alias("kind"))
    pairs = same.unionByName(near).distinct()
    return pairs.select(F.col("a").alias("train_id"), F.col("b").alias("other_id"), "kind")


def _near_records(rows: DataFrame) -> DataFrame:
    """``b``: records outside training that are near some training record. The ratios of a
    training hash are held as the least and largest in each cell of width ``ASPECT``; a record
    looks in its own cell and the two beside it, so no pair of copies is made."""
    known = rows.where(F.col("hi").isNotNull())
    cell = F.floor(F.col("ratio") / ASPECT)
    spans = known.where("train").groupBy(F.col("hi").alias("hi_a"), F.col("lo").alias("lo_a"), cell.alias("cell")).agg(F.min("ratio").alias("low"), F.max("ratio").alias("high"))
    reach = _near(rows).join(spans, ["hi_a", "lo_a"]).groupBy(F.col("hi_b").alias("hi"), F.col("lo_b").alias("lo"), "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    others = known.where("not train").select(F.col("id").alias("b"), "hi", "lo", "ratio", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    close = F.least(F.abs(F.col("ratio") - F.col("low")), F.abs(F.col("ratio") - F.col("high"))) <= ASPECT
    return others.join(reach, ["hi", "lo", "cell"]).where(close).select("b").distinct()


def overlapping_records(media: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row per record outside the training split that some training record equals:
    ``id, split, source`` and one flag per kind. Semi-joins only, so a group of copies
    costs its members, not its pairs. ``rows`` are those of ``prepared``, if they are there."""
    rows = prepared(media) if rows is None else rows
    keyed = _hashes(rows)
    same = keyed.where("not train").join(keyed.where("train").select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").select(F.col("id").alias("b"), "kind")
    kinds = same.unionByName(_near_records(rows).withColumn("kind", F.lit("perceptual")))
    flags = kinds.groupBy("b").agg(*[F.max(F.col("kind") == k).alias(k) for k in KINDS])
    return rows.where("not train").select("id", "split", "source").join(flags, F.col("id") == F.col("b")).drop("b")


def overlap_report(media: DataFrame) -> DataFrame:
    """Per split and source: records, and those that training data equal, by kind and at all."""
    rows = prepared(media)
    total = rows.where("not train").groupBy("split", "source").agg(F.count(F.lit(1)).alias("n_records"))
    found = overlapping_records(media, rows).groupBy("split", "source").agg(
        F.count(F.lit(1)).alias("n_any"), *[F.count_if(F.col(k)).alias(f"n_{k}") for k in KINDS]
    )
    joined = total.withColumnRenamed("split", "s").withColumnRenamed("source", "o").join(found, F.col("s").eqNullSafe(F.col("split")) & F.col("o").eqNullSafe(F.col("source")), "left")
    return joined.select(F.col("s").alias("split"), F.col("o").alias("source"), "n_records", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_any", *[f"n_{k}" for k in KINDS])])
