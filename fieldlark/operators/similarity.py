"""Nearest vectors, class means and score combination.

Exact searches take the query set in blocks of bounded size: a block is broadcast, every
partition keeps its own top k per query by one matrix product per Arrow batch, and the
partial lists are merged. The corpus is scanned, never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fieldlark.functions.vectors import norm, normalised
from fieldlark.session import cut

BLOCK = 2_000


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def nearest(corpus: DataFrame, queries: DataFrame, ident: str, vector: str, k: int, block: int = BLOCK, group: str | None = None) -> DataFrame:
    """``query_id, neighbour_id, similarity, rank``: for each query the k rows of highest
    cosine but itself; ties go to the smaller id. NULL vectors and ids take no part. With
    ``group`` only rows of the query's own group are its neighbours, and a query without a group
    has none; the corpus is still scanned and not shuffled, so a hot group is no task of its own."""
    spark = corpus.sparkSession
    kind = corpus.schema[ident].dataType.simpleString()
    of = F.col(group).cast("string") if group else F.lit("")
    rows = corpus.select(F.col(ident).alias("id"), F.col(vector).alias("v"), of.alias("g")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.col("g").isNotNull())
    parts, held = [], []

    def search(batch: list) -> DataFrame:
        ids, matrix = [r[0] for r in batch], _unit(np.array([r[1] for r in batch], np.float64))
        shared = spark.sparkContext.broadcast((ids, matrix, np.array([r[2] for r in batch], object)))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qids, q, q_group = shared.value
            best: list[list[tuple[float, object]]] = [[] for _ in qids]
            for b in batches:
                if not b.num_rows:
                    continue
                own = b.column("id").to_pylist()
                v = np.array(b.column("v").to_pylist(), np.float64)
                score = q @ _unit(v).T
                if group:
                    score = np.where(q_group[:, None] == np.array(b.column("g").to_pylist(), object)[None, :], score, -np.inf)
                take = min(len(own), k + 1)
                top = np.argpartition(-score, take - 1, axis=1)[:, :take]
                for i, qid in enumerate(qids):
                    # All that tie with the last one taken compete by id.
                    last = score[i, top[i]].min()
                    cand = np.flatnonzero(score[i] >= last)
                    best[i] = sorted(best[i] + [(-score[i, j], own[j]) for j in cand if own[j] != qid and score[i, j] > -np.inf])[:k]
            flat = [(qid, n, -s) for qid, found in zip(qids, best, strict=True) for s, n in found]
            a, n, s = zip(*flat, strict=True) if flat else ((), (), ())
            id_type = pa.int64() if kind == "bigint" else pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(a, id_type), pa.array(n, id_type), pa.array(s, pa.float64())], ["query_id", "neighbour_id", "similarity"])

        return rows.mapInArrow(look, f"query_id {kind}, neighbour_id {kind}, similarity double")

    asked = queries.select(F.col(ident), F.col(vector), of.alias("g")).where(F.col(ident).isNotNull() & F.col(vector).isNotNull() & F.col("g").isNotNull())
    for row in asked.toLocalIterator():
        held.append(row)
        if len(held) == block:
            parts.append(search(held))
            held = []
    if held:
        parts.append(search(held))
    if not parts:
        return spark.createDataFrame([], f"query_id {kind}, neighbour_id {kind}, similarity double, rank int")
    found = reduce(DataFrame.unionByName, parts)
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("similarity", 12)), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def fit_cells(vectors: DataFrame, vector: str, k: int, cells: int, aim: float, sample: int = 20_000, rounds: int = 10) -> tuple[np.ndarray, int]:
    """Unit centres of ``cells`` groups of directions (spherical k-means), and in how many of the
    nearest cells a query must look so that ``aim`` of its k neighbours lie there. Both are
    fitted on at most ``sample`` rows that are spread over the table, the second by comparing up to
    500 of them with all by brute force. Only where a row is looked for depends on them."""
    rows = vectors.select(F.col(vector).alias("v")).where(F.col("v").isNotNull())
    n = rows.count()
    if not n:
        return np.empty((0, 0)), 0
    taken = rows.where(F.rand(11) < min(1.0, 1.2 * sample / n)).limit(sample).collect() or rows.limit(sample).collect()
    v = _unit(np.array([r["v"] for r in taken], np.float64))
    rng = np.random.default_rng(11)
    centres = v[rng.choice(len(v), min(cells, len(v)), replace=False)]
    for _ in range(rounds):
        own = (v @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, v)
        empty = ~sums.any(1)
        sums[empty] = v[rng.choice(len(v), int(empty.sum()))]
        centres = _unit(sums)
    asked = rng.choice(len(v), min(500, len(v)), replace=False)
    score = v[asked] @ v.T
    score[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-score, axis=1)[:, :k]
    order = np.argsort(-(v[asked] @ centres.T), axis=1, kind="stable")
    # The place, among the cells of a query, of the cell that each of its neighbours lies in.
    place = np.argsort(order, axis=1)[np.arange(len(asked))[:, None], (v @ centres.T).argmax(1)[near]]
    reached = np.cumsum(np.bincount(place.ravel(), minlength=len(centres))) / place.size
    return centres, int(np.searchsorted(reached, aim)) + 1


def nearest_indexed(corpus: DataFrame, queries: DataFrame, ident: str, vector: str, k: int, *, cells: int = 64, aim: float = 0.95, probes: int | None = None, sample: int = 20_000, together: int = 100_000, asked_together: int = 2_000) -> DataFrame:
    """As ``nearest``, by an index: every row lies in the cell of its nearest centre, a query looks
    in its nearest cells, and similarities there are exact. How many cells follows from the recall
    that is aimed at (see ``fit_cells``), unless ``probes`` says it. Rows and queries meet by
    cell; a cell with more rows than ``together`` or more queries than ``asked_together`` is dealt
    over several tasks, so no task grows with the data, and nothing but the centres (``cells``
    rows) is broadcast. Neighbours in cells that are not looked at are missed: the recall is
    measured by ``recall`` against ``nearest``, which is the exact way."""
    spark = corpus.sparkSession
    kind = corpus.schema[ident].dataType.simpleString()
    id_type = to_arrow_type(corpus.schema[ident].dataType)
    schema = f"query_id {kind}, neighbour_id {kind}, similarity double"
    centres, enough = fit_cells(corpus, vector, k, cells, aim, sample)
    shared, probes = spark.sparkContext.broadcast(centres), min(probes or enough, max(1, len(centres)))
    if not len(centres):
        return spark.createDataFrame([], schema + ", rank int")

    def placed(df: DataFrame, n: int, most: int, part: str) -> DataFrame:
        """``id, v, cell, part, parts``: rows in their n nearest cells, and their part of the cell."""

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres = shared.value
            for b in batches:
                if b.num_rows:
                    score = _unit(np.array(b.column("v").to_pylist(), np.float64)) @ centres.T
                    best = np.argsort(-score, axis=1, kind="stable")[:, :n]
                    at = pa.array(np.repeat(np.arange(b.num_rows), best.shape[1]))
                    yield pa.RecordBatch.from_arrays([b.column("id").take(at), b.column("v").take(at), pa.array(best.ravel().astype(np.int32))], ["id", "v", "cell"])

        rows = df.select(F.col(ident).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
        rows = cut(rows.mapInArrow(look, f"id {kind}, v array<double>, cell int"))
        sizes = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(f"{part}s"))
        return rows.join(F.broadcast(sizes), "cell").withColumn(part, F.pmod(F.xxhash64("id"), F.col(f"{part}s")).cast("int"))

    there, asked = placed(corpus, 1, together, "part"), placed(queries, probes, asked_together, "lot")
    sides = there.select("cell", "parts").distinct().join(asked.select("cell", "lots").distinct(), "cell")
    deal = lambda n, name: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name)
    left = asked.drop("lots").join(F.broadcast(sides), "cell").select("id", "v", "cell", "lot", deal("parts", "part"))
    right = there.drop("parts").join(F.broadcast(sides), "cell").select("id", "v", "cell", "part", deal("lots", "lot"))
    keys = ["cell", "lot", "part"]

    def best(q: pa.Table, c: pa.Table) -> pa.Table:
        flat: list[tuple] = []
        if q.num_rows and c.num_rows:
            qids, own = q.column("id").to_pylist(), c.column("id").to_pylist()
            score = _unit(np.array(q.column("v").to_pylist(), np.float64)) @ _unit(np.array(c.column("v").to_pylist(), np.float64)).T
            take = min(len(own), k + 1)
            least = np.partition(score, len(own) - take, axis=1)[:, len(own) - take]
            for i, qid in enumerate(qids):
                near = sorted((-round(score[i, j], 12), own[j]) for j in np.flatnonzero(score[i] >= least[i]) if own[j] != qid)[:k]
                flat += [(qid, n, -s) for s, n in near]
        a, n, s = zip(*flat, strict=True) if flat else ((), (), ())
        return pa.Table.from_arrays([pa.array(a, id_type), pa.array(n, id_type), pa.array(s, pa.float64())], ["query_id", "neighbour_id", "similarity"])

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, schema)
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("similarity", 12)), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: pairs of the exact search, how many of them were found, and the share."""
    f = found.select("query_id", "neighbour_id").distinct().withColumn("hit", F.lit(1))
    met = exact.select("query_id", "neighbour_id").distinct().join(f, ["query_id", "neighbour_id"], "left")
    return met.agg(F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n_found"), F.try_divide(F.count("hit").cast("double"), F.count(F.lit(1))).alias("recall"))


def neighbour_vote(neighbours: DataFrame, labels: DataFrame, ident: str, label: str) -> DataFrame:
    """``query_id, predicted, share, n_neighbours``: the label with the largest sum of similarities
    (none below zero) among the neighbours of a query; ties go to the smaller label."""
    named = neighbours.join(labels.select(F.col(ident).alias("neighbour_id"), F.col(label).alias("l")).where(F.col("l").isNotNull()), "neighbour_id")
    votes = named.groupBy("query_id", "l").agg(F.sum(F.greatest(F.col("similarity"), F.lit(0.0))).alias("s"), F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.round("s", 9)).alias("minus"), F.col("l").alias("l")))
    out = votes.groupBy("query_id").agg(best.alias("b"), F.sum("s").alias("all"), F.sum("n").alias("n_neighbours"))
    return out.select("query_id", F.col("b.l").alias("predicted"), F.try_divide(-F.col("b.minus"), F.col("all")).alias("share"), "n_neighbours")


def prototypes(df: DataFrame, label: str, observation: str, vector: str) -> DataFrame:
    """``label, mean``: the direction of each class, in which every observation counts once: vectors
    of an observation are averaged and brought to length 1, then those of a class. Vectors
    without a length say nothing."""
    pair = F.struct(F.col(label).alias("l"), F.col(observation).alias("o"))
    known = df.where(F.col(label).isNotNull() & F.col(observation).isNotNull() & (norm(F.col(vector)) > 0))
    seen = class_means(known.select(pair.alias("k"), normalised(F.col(vector)).alias("v")), "k", "v").where(norm(F.col("mean")) > 0)
    classes = class_means(seen.select(F.col("k.l").alias(label), normalised(F.col("mean")).alias("v")), label, "v")
    return classes.where(norm(F.col("mean")) > 0).select(label, normalised(F.col("mean")).alias("mean"))


def class_means(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``label, mean``: the mean vector of each class; components are averaged on the map side."""
    parts = df.where(F.col(label).isNotNull() & F.col(vector).isNotNull()).select(label, F.posexplode(vector).alias("i", "x"))
    means = parts.groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean"))


def class_scores(df: DataFrame, means: DataFrame, ident: str, vector: str, label: str, block: int = BLOCK) -> DataFrame:
    """One row per row of ``df`` with a vector: ``own`` class, its ``own_score``, the best class as
    ``predicted`` (ties: the smallest) with ``score``, the ``next`` best score, the ``best_other``
    score among classes that are not its own, and the sum and number of all. Cosines with the
    class means are one matrix product per Arrow batch and block of means, and are reduced
    inside it; rows meet again only where the means take more than one block."""
    spark = df.sparkSession
    kinds = [df.schema[c].dataType.simpleString() for c in (ident, label)]
    schema = f"row bigint, {ident} {kinds[0]}, own {kinds[1]}, own_score double, predicted {kinds[1]}, score double, next double, best_other double, total double, n bigint"
    rows = df.select(F.monotonically_increasing_id().alias("row"), ident, F.col(label).alias("own"), F.col(vector).alias("v")).where(F.col("v").isNotNull())
    kind = to_arrow_type(df.schema[label].dataType)

    def against(batch: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(([r[0] for r in batch], _unit(np.array([r[1] for r in batch], np.float64))))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, matrix = shared.value
            place = {c: i for i, c in enumerate(names)}
            for b in batches:
                if not b.num_rows:
                    continue
                score = np.clip(_unit(np.array(b.column("v").to_pylist(), np.float64)) @ matrix.T, -1, 1)
                n, at = b.num_rows, np.arange(b.num_rows)
                best = np.round(score, 12).argmax(1)
                own = np.array([place.get(c, -1) for c in b.column("own").to_pylist()])
                rest = score.copy()
                rest[at, best] = -np.inf
                other = score.copy()
                other[at[own >= 0], own[own >= 0]] = -np.inf
                known = lambda x: pa.array(x, pa.float64(), mask=~np.isfinite(x))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3], known(np.where(own >= 0, score[at, own], np.nan)), pa.array([names[i] for i in best], kind), pa.array(score[at, best]), known(rest.max(1)), known(other.max(1)), pa.array(score.sum(1)), pa.array(np.full(n, len(names)), pa.int64())],
                    [f.split()[0] for f in schema.split(", ")],
                )

        return rows.mapInArrow(look, schema)

    parts, held = [], []
    # In the order of the labels, so that the first best of a batch is the smallest.
    for row in means.select(label, "mean").where(F.col(label).isNotNull()).orderBy(label).toLocalIterator():
        held.append(row)
        if len(held) == block:
            parts.append(against(held))
            held = []
    if held:
        parts.append(against(held))
    if not parts:
        return spark.createDataFrame([], schema).drop("row")
    if len(parts) == 1:
        return parts[0].drop("row")
    both = cut(reduce(DataFrame.unionByName, parts))
    best = F.min(F.struct((-F.round("score", 12)).alias("m"), F.col("predicted").alias("c"), F.col("score").alias("s")))
    merged = both.groupBy("row").agg(
        F.first(ident).alias(ident), F.first("own").alias("own"), F.max("own_score").alias("own_score"), best.alias("b"), F.max("best_other").alias("best_other"), F.sum("total").alias("total"), F.sum("n").alias("n"),
        # The best of each block and the next best of each: the second of them all is among these.
        F.get(F.sort_array(F.flatten(F.collect_list(F.array("score", "next"))), asc=False), F.lit(1)).alias("next"),
    )
    return merged.select(ident, "own", "own_score", F.col("b.c").alias("predicted"), F.col("b.s").alias("score"), "next", "best_other", "total", "n")


def fused(scores: Sequence[Column], weights: Sequence[float]) -> dict[str, Column]:
    """Four ways to bring scores of one candidate together."""
    known = F.array_compact(F.array(*scores))
    total = F.aggregate(known, F.lit(0.0), lambda s, x: s + x)
    ordered = F.array_sort(known)
    n = F.size(known)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    weighted = sum([s * w for s, w in zip(scores, weights, strict=True)], F.lit(0.0))
    return {"mean": F.try_divide(total, n), "linear": weighted, "max": F.array_max(known), "median": (low + high) / 2}


def pooled(scores: Column) -> dict[str, Column]:
    """Ways to pool the scores of several prompts: mean, best, mean of the best two."""
    s = F.sort_array(scores, asc=False)
    n = F.size(s)
    return {
        "mean": F.try_divide(F.aggregate(s, F.lit(0.0), lambda a, x: a + x), n),
        "best": F.get(s, F.lit(0)),
        "best_two": F.when(n >= 2, (F.get(s, F.lit(0)) + F.get(s, F.lit(1))) / 2),
    }


def average_linkage(vectors: np.ndarray, least: float) -> np.ndarray:
    """Clusters of unit vectors merged while the mean cosine of two clusters is at least ``least``."""
    n = len(vectors)
    sim = vectors @ vectors.T
    groups = {i: [i] for i in range(n)}
    link = {(i, j): sim[i, j] for i in range(n) for j in range(i + 1, n)}
    while link:
        (a, b), s = max(link.items(), key=lambda kv: (kv[1], -kv[0][0], -kv[0][1]))
        if s < least:
            break
        groups[a] = sorted(groups[a] + groups.pop(b))
        link = {k: v for k, v in link.items() if a not in k and b not in k}
        for c in groups:
            if c != a:
                link[min(a, c), max(a, c)] = float(sim[np.ix_(groups[a], groups[c])].mean())
    out = np.empty(n, int)
    for k, g in enumerate(sorted(groups.values())):
        out[g] = k
    return out
