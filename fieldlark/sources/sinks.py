"""Sinks: schema conformance, checked publication with the manifest last, partitioned writes."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fieldlark.functions.scalars import csv_safe
from fieldlark.session import cut


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; missing ones come as typed NULL,
    values that don't fit their type as NULL."""
    have = {c.lower(): c for c in df.columns}
    cols = [F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType).alias(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*cols)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def remove(spark: SparkSession, path: str) -> None:
    fs, at, _ = _fs(spark, path)
    fs.delete(at, True)


def publish(df: DataFrame, path: str, checks: Mapping[str, Column] | None = None, expected_rows: int | None = None, order: Sequence[str] = (), details: Mapping[str, object] | None = None) -> dict:
    """Writes beside the target, reads back, checks, writes the manifest last and renames.
    An existing target, a failed check or a wrong row count raises and leaves nothing."""
    spark = df.sparkSession
    fs, target, jvm = _fs(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    staging = jvm.org.apache.hadoop.fs.Path(f"{path}.staging")
    fs.delete(staging, True)
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    out.write.option("compression", "zstd").parquet(f"{path}.staging/data")
    back = spark.read.parquet(f"{path}.staging/data")
    named = dict(checks or {})
    row = back.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in named.items()]).first()
    failed = [k for k in named if row[k]]
    if expected_rows is not None and row["n"] != expected_rows:
        failed.append("row_count")
    if back.schema.simpleString() != df.schema.simpleString():
        failed.append("schema")
    if failed:
        fs.delete(staging, True)
        raise ValueError(f"checks failed: {failed}")
    manifest = {"rows": row["n"], "schema": json.loads(df.schema.json()), "checks": sorted(named), **(details or {})}
    stream = fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}.staging/manifest.json"), True)
    stream.write(bytearray(json.dumps(manifest, sort_keys=True, indent=1).encode()))
    stream.close()
    if not fs.rename(staging, target):
        fs.delete(staging, True)
        raise OSError(f"cannot move to {path}")
    return manifest


def write_by_hash(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Partition folders by a hash of the key; rows meet in their bucket before the write,
    so that each bucket is a few files. Files split at a row limit, so a hot bucket spreads."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    df.withColumn("partition_bucket", bucket).repartition("partition_bucket", F.pmod(F.xxhash64(F.struct(*df.columns)), F.lit(8))).write.partitionBy("partition_bucket").option("maxRecordsPerFile", 5_000_000).parquet(path)


def write_by_range(df: DataFrame, path: str, ordinal: str, width: int) -> None:
    """Partition folders by floor(ordinal / width)."""
    part = F.floor(F.col(ordinal) / width).cast("bigint")
    df.withColumn("source_partition", part).repartitionByRange("source_partition", ordinal).sortWithinPartitions(ordinal).write.partitionBy("source_partition").parquet(path)


def seal_parts(df: DataFrame, path: str, ordinal: str, width: int, only: Sequence[int] | None = None) -> DataFrame:
    """Writes ``df`` as parts of ``width`` ordinals and seals each: a row of ``path``/seals with the
    rows, first and last ordinal and digest that were read back. Parts that are sealed already are
    not made again, so a run that was interrupted goes on where it stopped; parts that differ
    from what was to be written are not sealed and raise. ``only`` limits a run to some parts."""
    spark = df.sparkSession
    part = F.floor(F.col(ordinal) / width).cast("bigint").alias("part")
    measures = lambda cols: [F.count(F.lit(1)).alias("n_rows"), F.min(ordinal).alias("first"), F.max(ordinal).alias("last"), F.bit_xor(F.xxhash64(*cols)).alias("digest")]
    todo = df.select("*", part)
    if only is not None:
        todo = todo.where(F.col("part").isin(*only))
    fs, at, _ = _fs(spark, f"{path}/seals")
    if fs.exists(at):
        todo = todo.join(spark.read.parquet(f"{path}/seals").select("part"), "part", "left_anti")
    todo = cut(todo)
    if todo.isEmpty():
        return spark.read.parquet(f"{path}/seals")
    ranged = todo.repartitionByRange("part", ordinal).sortWithinPartitions("part", ordinal)
    ranged.write.partitionBy("part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/parts")
    want = todo.groupBy("part").agg(*measures(df.columns))
    back = spark.read.schema(StructType([*df.schema, StructField("part", LongType())])).parquet(f"{path}/parts")
    got = back.join(want.select("part"), "part", "left_semi").groupBy("part").agg(*measures(df.columns))
    both = cut(want.join(got.select("part", *[F.col(c).alias(f"{c}_read") for c in ("n_rows", "first", "last", "digest")]), "part", "left"))
    same = F.col("n_rows").eqNullSafe(F.col("n_rows_read")) & F.col("digest").eqNullSafe(F.col("digest_read"))
    both.where(same).select("part", "n_rows", "first", "last", "digest").write.mode("append").parquet(f"{path}/seals")
    torn = both.where(~same).select("part").limit(5).collect()
    if torn:
        raise ValueError(f"parts {[r['part'] for r in torn]} are not what was written")
    return spark.read.parquet(f"{path}/seals")


def assemble_parts(spark: SparkSession, path: str, expected_rows: int) -> DataFrame:
    """The rows of all sealed parts, if each is sealed once, no two overlap and they have the expected rows."""
    seals = spark.read.parquet(f"{path}/seals")
    w = Window.orderBy("first")
    total = seals.agg(F.sum("n_rows"), F.count(F.lit(1)), F.count_distinct("part")).first()
    overlap = seals.withColumn("before", F.lag("last").over(w)).where("first <= before").count()
    if (total[0] or 0) != expected_rows or total[1] != total[2] or overlap:
        raise ValueError(f"{total[0]} rows in {total[1]} seals of {total[2]} parts, {overlap} of them overlapping")
    return spark.read.parquet(f"{path}/parts").join(seals.select("part"), "part", "left_semi").drop("part")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV whose texts no spreadsheet runs as formulas."""
    text = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    df.select(*[csv_safe(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns]).write.option("header", True).csv(path)


def write_table(df: DataFrame, name: str, key: str, buckets: int = 16) -> None:
    """A bucketed, sorted table with statistics: what a lookup index is on a cluster."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    df.sparkSession.sql(f"analyze table {name} compute statistics for columns {key}")


def bundle(folder: str, target: str) -> dict:
    """A tar of a published folder with the digest of every file, written on the driver: meant
    for reports and manifests, not for tables. The bundle's own list comes first in it."""
    import hashlib
    import io
    import os
    import tarfile

    names = sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if not f.startswith("."))
    files = {}
    for n in names:
        digest = hashlib.sha256()
        with open(os.path.join(folder, n), "rb") as src:
            while chunk := src.read(1 << 20):
                digest.update(chunk)
        files[n] = {"bytes": os.path.getsize(os.path.join(folder, n)), "sha256": digest.hexdigest()}
    listing = json.dumps(files, sort_keys=True, indent=1).encode()
    with tarfile.open(target, "w:gz") as tar:
        head = tarfile.TarInfo("files.json")
        head.size = len(listing)
        tar.addfile(head, io.BytesIO(listing))
        for n in names:
            tar.add(os.path.join(folder, n), n)
    return files


def unbundle(archive: str, folder: str) -> dict:
    """Unpacks a bundle after checking every digest against its list."""
    import hashlib
    import tarfile

    with tarfile.open(archive) as tar:
        files = json.loads(tar.extractfile("files.json").read())
        for n, about in files.items():
            if hashlib.sha256(tar.extractfile(n).read()).hexdigest() != about["sha256"]:
                raise ValueError(f"{n} is not what the list says")
        tar.extractall(folder, members=[tar.getmember(n) for n in files], filter="data")
    return files
