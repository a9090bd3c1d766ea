"""Filling containers of fixed token capacity.

Texts are counted once by a public tokenizer (its file is a parameter) and checkpointed
as sizes. Items are dealt by a hash into parts of about ``PART`` items, each packed by
best-fit decreasing in its own task. Lower bounds from dual feasible functions certify
each part: a part whose container count exceeds its unrounded bound has a gap, gives up
its emptiest containers, and the items of all such parts are dealt anew and packed again.
Rounds end when the count meets the bound of all items, or no longer falls. The bound of
all items comes from the histogram of sizes (at most ``capacity`` rows).

Defined results
- One row per piece: an item up to the capacity is one piece; a longer one is cut into
  full pieces and a rest, as spans of its tokens.
- NULL and empty texts have 0 tokens and no container (NULL), as they need no room.
- Ties are settled by id and part, so the result does not depend on the order of rows;
  repeated rows of one id are pieces of their own and may share a container.
- Rows with a NULL id are packed like others. Empty table: empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlark.session import cut, spread

CAPACITY = 2048
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PART = 50_000
# Fixed value: the pre-tokenisation pattern that belongs to the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(documents: DataFrame, ident: str, text: str, path: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, part, token_start, n_tokens``: the spans of tokens that are packed whole."""
    kind = documents.schema[ident].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
            rows = [(i, k, k * capacity, min(capacity, n - k * capacity)) for i, n in enumerate(sizes) for k in range(max(1, -(-n // capacity)))]
            at, part, start, size = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(part, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int32())],
                ["doc_id", "part", "token_start", "n_tokens"],
            )

    asked = documents.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    return spread(asked, "doc_id").mapInArrow(count, f"doc_id {kind}, part int, token_start bigint, n_tokens int")


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The container of each size, taken in the given (falling) order: the fullest that has room."""
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made, out = 0, 0, []
    for s in sizes:
        fits = rooms >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            k = open_[r].pop()
            if not open_[r]:
                rooms ^= 1 << r
        else:
            r, k = capacity, made
            made += 1
        out.append(k)
        if r > s:
            open_[r - s].append(k)
            rooms |= 1 << (r - s)
    return out


def lower_bound(counts: np.ndarray, capacity: int) -> float:
    """The least number of containers, unrounded, for ``counts[s]`` items of size s:
    the best of three families of dual feasible functions."""
    counts = counts.astype(float)
    s = np.arange(capacity + 1)
    best = float((counts * s).sum() / capacity)
    # Sizes above capacity - e count as whole, those below e as nothing.
    n_from = counts[::-1].cumsum()[::-1]
    sum_to = (counts * s).cumsum()
    for e in range(1, capacity // 2 + 1):
        whole = n_from[capacity - e + 1]
        middle = sum_to[capacity - e] - sum_to[e - 1]
        best = max(best, float(whole + middle / capacity))
    # Rounding to multiples of 1/k, kept where (k + 1) * size is whole.
    for k in range(1, 33):
        scaled = (k + 1) * s
        f = np.where(scaled % capacity == 0, s / capacity, (scaled // capacity) / k)
        best = max(best, float((counts * f).sum()))
    # Sizes above one half by what fits beside them in units of e.
    for e in range(1, capacity // 2 + 1, max(1, capacity // 128)):
        units = capacity // e
        f = np.where(2 * s > capacity, units - (capacity - s) // e, np.where(2 * s == capacity, units / 2, s // e)) / max(1, units)
        f[2 * s == capacity] = 0.5
        best = max(best, float((counts * f).sum()))
    return best


def _pack(lot: pa.Table, capacity: int) -> pa.Table:
    """One part packed, with its certified ``bound``; ``release`` marks what the part gives up
    because it has more containers than that."""
    lot = lot.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("part", "ascending")])
    sizes = lot.column("n_tokens").to_numpy()
    box = np.array(best_fit(sizes.tolist(), capacity))
    used = np.bincount(box, weights=sizes)
    bound = lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)
    gap = len(used) - bound
    give = min(len(used), 2 * int(np.ceil(gap - 1e-9)) + 2) if gap > 1e-9 else 0
    emptiest = np.argsort(used, kind="stable")[:give]
    released = np.isin(box, emptiest[used[emptiest] < capacity])
    return lot.append_column("box", pa.array(box, pa.int32())).append_column("release", pa.array(released)).append_column("bound", pa.array(np.full(len(box), bound)))


def _after(total: int, before: int | None, bound: int, n_given: int) -> str:
    """What follows a round: ``back`` to the round before if it is not better, ``end`` if the bound
    is met or nothing is given up, else ``on``."""
    if before is not None and total >= before:
        return "back"
    return "end" if total <= bound or not n_given else "on"


def pack(items: DataFrame, capacity: int = CAPACITY, part: int = PART) -> DataFrame:
    """``doc_id, part, token_start, n_tokens, container_id`` for the pieces of ``pieces()``."""
    return certified(items, capacity, part)[0]


def certified(items: DataFrame, capacity: int = CAPACITY, part: int = PART) -> tuple[DataFrame, DataFrame]:
    """The packing, and one certificate for each part of each round: ``round, lot, n_pieces,
    n_containers``, the least number ``bound`` its pieces need, ``gap`` between the two and how
    many containers it ``released`` for another round."""
    items = cut(items)
    histogram = items.where(F.col("n_tokens") > 0).groupBy("n_tokens").count().collect()
    counts = np.zeros(capacity + 1, int)
    for size, n in histogram:
        counts[size] = n
    bound = int(np.ceil(lower_bound(counts, capacity) - 1e-9))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema) + ", lot bigint, box int, release boolean, bound double"
    kept = [items.where(F.col("n_tokens") == 0).withColumn("container_id", F.lit(None).cast("string"))]
    left, n_left, fixed, before = items.where(F.col("n_tokens") > 0), int(counts.sum()), 0, None
    turn, given_up, certificates = 0, None, []
    while n_left:
        lots = max(1, round(n_left / part))
        lot = F.pmod(F.xxhash64("doc_id", "part", "token_start", F.lit(turn)), F.lit(lots))

        def one(table: pa.Table) -> pa.Table:
            return _pack(table, capacity)

        packed = cut(left.withColumn("lot", lot).groupBy("lot").applyInArrow(one, schema))
        named = packed.withColumn("container_id", F.concat_ws("-", F.lit(turn), "lot", "box"))
        made, given, n_given = named.agg(
            F.count_distinct("lot", "box"), F.count_distinct(F.when(F.col("release"), F.struct("lot", "box"))), F.count_if("release")
        ).first()
        total = fixed + made
        parts = named.groupBy("lot").agg(F.count(F.lit(1)).alias("n_pieces"), F.count_distinct("box").alias("n_containers"), F.ceil(F.max("bound") - 1e-9).cast("bigint").alias("bound"), F.count_distinct(F.when(F.col("release"), F.col("box"))).alias("released"))
        certificates.append(parts.select(F.lit(turn).alias("round"), "lot", "n_pieces", "n_containers", "bound", (F.col("n_containers") - F.col("bound")).alias("gap"), "released"))
        step = _after(total, before, bound, n_given)
        if step != "on":
            kept.append(given_up if step == "back" else named.select(*items.columns, "container_id"))
            break
        kept.append(named.where(~F.col("release")).select(*items.columns, "container_id"))
        given_up = named.where("release").select(*items.columns, "container_id")
        fixed, before = fixed + made - given, total
        left, n_left, turn = packed.where("release").select(*items.columns), n_given, turn + 1
    none = items.sparkSession.createDataFrame([], "round int, lot bigint, n_pieces bigint, n_containers bigint, bound bigint, gap bigint, released bigint")
    return reduce(DataFrame.unionByName, kept), reduce(DataFrame.unionByName, certificates, none)


def pack_check(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: documents, containers above the capacity, pieces with tokens but no container,
    documents divided although they would have fitted, and documents whose pieces leave out tokens."""
    boxes = packed.where(F.col("container_id").isNotNull()).groupBy("container_id").agg(F.sum("n_tokens").alias("t")).agg(F.count_if(F.col("t") > capacity).alias("n_overfull"))
    per = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("k"), F.max(F.col("token_start") + F.col("n_tokens")).alias("end"), F.count_if(F.col("container_id").isNull() & (F.col("n_tokens") > 0)).alias("lost"))
    docs = per.agg(F.count(F.lit(1)).alias("n_documents"), F.coalesce(F.sum("lost"), F.lit(0)).alias("n_unplaced"), F.count_if((F.col("k") > 1) & (F.col("t") <= capacity)).alias("n_divided"), F.count_if(F.col("t") != F.col("end")).alias("n_with_gaps"))
    return docs.withColumn("one", F.lit(1)).join(boxes.withColumn("one", F.lit(1)), "one").drop("one")


def pack_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: pieces, tokens, containers, the volume bound and the share of unused space."""
    total = packed.agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"), F.count_distinct("container_id").alias("n_containers"))
    return total.withColumn("volume_bound", F.ceil(F.col("n_tokens") / capacity)).withColumn("unused_share", 1 - F.try_divide("n_tokens", F.col("n_containers") * capacity))
