"""Connected components of a bipartite graph of records and the entities they name.

Minimum labels travel from entities to records and back: a record takes the smallest
label of its entities, an entity the smallest label of its records. After each round the
entities that took one label become one node, links that join nothing any more are
dropped and repeated links collapse, so the graph shrinks by a factor each round and a
hot entity is one aggregated row, not a bucket. Labels are re-mixed each round by a
bijection of the 64-bit numbers (``xxhash64`` of one bigint), which keeps the number of
rounds logarithmic even on long chains. Once at most ``LAST`` links are left (some 50 MB), one
task joins them by a disjoint-set forest, which spares the last rounds their jobs. All
aggregates combine on the map side; nothing but counts reaches the driver. Each round is
checkpointed to the shared folder.

An entity's label is its 64-bit hash. A second, independent hash shows whether two
entities share a label; if any do, dense numbers of the 128-bit pairs are used instead.

Defined results: NULL records or entities link nothing; repeated links change nothing;
no links: empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlark.session import cut

Hash = Callable[[Column], Column]
LAST = 250_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``u, root`` for the labels of all links: the smallest label that is connected."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            up.setdefault(a, a)
            up.setdefault(b, b)
            low, high = sorted((find(a), find(b)))
            up[high] = low
    yield pa.RecordBatch.from_arrays([pa.array(list(up), pa.int64()), pa.array([find(x) for x in up], pa.int64())], ["u", "v"])


def _roots(pairs: DataFrame, last: int = LAST) -> DataFrame | None:
    """``u, root, round`` for every label in ``pairs`` (``a, b`` are linked); None if there is no pair.
    Labels of different rounds live in different spaces, so the round is part of a root."""
    # The steps are plans over the checkpointed pairs of each round, made again where needed.
    steps = []
    while n := pairs.count():
        if n <= last:
            steps.append(cut(pairs.select("a", "b").coalesce(1).mapInArrow(_forest, "u bigint, v bigint")))
            break
        # Each label takes the smallest (mixed) label next to it or its own.
        both = pairs.select(F.col("a").alias("u"), F.xxhash64("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.xxhash64("a").alias("v")))
        taken = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("v", F.xxhash64("u")).alias("v"))
        steps.append(taken)
        to_a, to_b = taken.select(F.col("u").alias("a"), F.col("v").alias("x")), taken.select(F.col("u").alias("b"), F.col("v").alias("y"))
        moved = pairs.join(to_a, "a").join(to_b, "b").where(F.col("x") != F.col("y"))
        pairs = cut(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    # From the last and smallest step back to the first.
    roots = None
    for k, step in reversed(list(enumerate(steps))):
        if roots is None:
            step = step.select("u", F.col("v").alias("root"), F.lit(k).alias("round"))
        else:
            later = roots.select(F.col("u").alias("v"), F.col("root").alias("r"), F.col("round").alias("n"))
            step = step.join(later, "v", "left").select("u", F.coalesce("r", "v").alias("root"), F.coalesce("n", F.lit(k)).alias("round"))
        roots = cut(step) if k % 4 == 0 else step
    return roots


def grouped_sets(rows: DataFrame, record: str, entities: Column, label: Hash = F.xxhash64, last: int = LAST) -> DataFrame:
    """``record, root, round`` for each row that names an entity; rows with one (root, round)
    belong together. ``entities`` is an array of texts; each row is one record."""
    known = F.filter(entities, lambda e: e.isNotNull())
    base = rows.select(F.col(record).alias("rec"), known.alias("e")).where(F.col("rec").isNotNull() & (F.size("e") > 0))
    hashed = cut(base.select("rec", F.transform("e", lambda e: F.struct(label(e).alias("lab"), F.xxhash64(e).alias("h"), F.xxhash64(F.lit("#"), e).alias("chk"))).alias("e")))
    ends = [f(c).alias(f"{c}_{n}") for c in ("h", "chk") for n, f in (("low", F.min), ("high", F.max))]
    shared = hashed.select(F.inline("e")).groupBy("lab").agg(*ends).where("h_low <> h_high or chk_low <> chk_high")
    if shared.isEmpty():
        sets = hashed.select("rec", F.transform("e", lambda e: e["lab"]).alias("labs"))
    else:
        named = cut(hashed.withColumn("row", F.monotonically_increasing_id()).select("rec", "row", F.inline("e")).drop("lab"))
        numbers = cut(named.select("h", "chk").distinct().withColumn("id", F.monotonically_increasing_id()))
        sets = cut(named.join(numbers, ["h", "chk"]).groupBy("row").agg(F.first("rec").alias("rec"), F.collect_set(F.xxhash64("id")).alias("labs")).select("rec", "labs"))
    # entity -> record: a record takes its smallest label; its other entities link to that one.
    low = F.array_min("labs")
    pairs = sets.select(low.alias("a"), F.explode("labs").alias("b")).where(F.col("a") != F.col("b"))
    roots = _roots(cut(pairs.distinct()), last)
    mine = sets.select(F.col("rec").alias(record), low.alias("u"))
    if roots is None:
        return mine.select(record, F.col("u").alias("root"), F.lit(-1).alias("round"))
    return mine.join(roots, "u", "left").select(record, F.coalesce("root", "u").alias("root"), F.coalesce("round", F.lit(-1)).alias("round"))


def components(links: DataFrame, record: str, entity: str, label: Hash = F.xxhash64, last: int = LAST) -> DataFrame:
    """``record, component`` for every record with an entity; the component is the smallest
    ``record`` value it holds. A record may have any number of link rows: each link names the
    record itself and the entity, so nothing is collected per record."""
    kind = links.schema[record].dataType
    typed = links.select(F.col(record).alias("rec"), F.col(entity).cast("string").alias("ent")).where(F.col("rec").isNotNull() & F.col("ent").isNotNull())
    both = F.array(F.concat(F.lit("r:"), F.col("rec").cast("string")), F.concat(F.lit("e:"), F.col("ent")))
    grouped = grouped_sets(typed, "rec", both, label, last).distinct()
    grouped = cut(grouped)
    first = grouped.groupBy("root", "round").agg(F.min("rec").alias("component"))
    return grouped.join(first, ["root", "round"]).select(F.col("rec").cast(kind).alias(record), "component")


def same_component(edges: DataFrame, left: str, right: str, last: int = LAST) -> DataFrame:
    """``node, component`` for the nodes of an undirected edge table; the smallest node names it."""
    kind = edges.schema[left].dataType
    whole = edges.select(F.col(left).alias("a"), F.col(right).cast(kind).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    ends = F.array(F.col("a").cast("string"), F.col("b").cast("string"))
    grouped = grouped_sets(whole.withColumn("both", F.array("a", "b")), "both", ends, last=last)
    nodes = cut(grouped.select(F.explode("both").alias("node"), "root", "round").distinct())
    first = nodes.groupBy("root", "round").agg(F.min("node").alias("component"))
    return nodes.join(first, ["root", "round"]).select("node", "component")
