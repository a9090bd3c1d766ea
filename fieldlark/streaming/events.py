"""Structured Streaming forms: windowed counts, duplicates within a bound, upserts of snapshots.

Every stream runs with ``availableNow``: it takes what is there, in as many micro-batches as
the source's limit asks for, and ends; the checkpoint makes a rerun take only what is new.
A micro-batch writes only what it changed, to a folder of its own number in a log that the
caller names, so that one which is run again overwrites itself; readers take the newest row
of each key over the log. ``compact`` merges the finished batches into a base and removes
what the base holds. State in the stream is bounded by the watermark, the table by its keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """The files of a folder as a stream; a single file is the only one of its folder that is read."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    files = spark.read.schema(schema).parquet(path).inputFiles()
    if len(files) == 1 and files[0].rstrip("/").endswith("/" + path.rstrip("/").rpartition("/")[2]):
        folder, _, name = path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def _run(df: DataFrame, mode: str, each, checkpoint: str) -> None:
    q = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
    q.awaitTermination()


# ---------------------------------------------------------------- logs of micro-batches


def _folders(spark: SparkSession, out: str) -> dict[str, dict[int, str]]:
    """The finished folders of a log by kind (``base``, ``batch``) and number."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[str, dict[int, str]] = {"base": {}, "batch": {}}
    for f in fs.listStatus(path) if fs.exists(path) else []:
        kind, _, n = f.getPath().getName().partition("-")
        if kind in found and n.isdigit() and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")):
            found[kind][int(n)] = f.getPath().toString()
    return found


def _live(spark: SparkSession, out: str) -> tuple[list[str], int]:
    """The folders that make up the log: the newest base and the batches after it; the last number."""
    found = _folders(spark, out)
    base = max(found["base"], default=-1)
    batches = {n: p for n, p in found["batch"].items() if n > base}
    return [*([found["base"][base]] if base >= 0 else []), *batches.values()], max([base, *batches])


def _append(df: DataFrame, out: str, n: int) -> None:
    df.withColumn("__batch", F.lit(n).cast("bigint")).write.mode("overwrite").parquet(f"{out}/batch-{n}")


def read_log(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """All rows of a log, with ``__batch``; empty if nothing was written."""
    whole = StructType([*schema, StructField("__batch", LongType())])
    paths, _ = _live(spark, out)
    return spark.read.schema(whole).parquet(*paths) if paths else spark.createDataFrame([], whole)


def newest(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order`` and then by batch; combined on the map side."""
    top = log.groupBy(*keys).agg(F.max_by(F.struct(*log.columns), F.struct(*order, "__batch")).alias("r"))
    return top.select("r.*")


def compact(spark: SparkSession, out: str, schema: StructType, keys: Sequence[str], order: Sequence[str] = ()) -> int:
    """Merges the log into one base of its last batch and removes what lies below it. Readers that
    began before go on with the old folders until these are removed."""
    paths, last = _live(spark, out)
    if len(paths) > 1:
        newest(read_log(spark, out, schema), keys, order).write.mode("overwrite").parquet(f"{out}/base-{last}")
        fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for p in paths:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p), True)
    return last


# ---------------------------------------------------------------- streams


def windowed_counts(events: DataFrame, ts: str, keys: Sequence[str], value: str, width: str, late: str) -> DataFrame:
    """Rows and sums per time window and key. Rows whose window had ended more than ``late``
    before the newest event are dropped, where Spark goes by the events up to the micro-batch
    before the last; rows without a time are dropped as well."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).where(F.col("__ts").isNotNull()).withWatermark("__ts", late)
    out = timed.groupBy(F.window("__ts", width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("window_start"), *keys, "n", "total")


def run_windowed_counts(events: DataFrame, out: str, checkpoint: str, ts: str = "ts", keys: Sequence[str] = ("event_type",), value: str = "value", width: str = "1 day", late: str = "40 days") -> DataFrame:
    """Runs the stream to its end: each micro-batch logs the windows it changed, and state is
    kept only for windows that may still change. The result is the newest count of each window."""
    counts = windowed_counts(events, ts, keys, value, width, late)
    _run(counts, "update", lambda batch, n: _append(batch, out, n), checkpoint)
    return newest(read_log(events.sparkSession, out, counts.schema), ["window_start", *keys], []).drop("__batch")


def run_deduplicated(events: DataFrame, ident: str, out: str, checkpoint: str, ts: str = "ts", late: str = "40 days") -> DataFrame:
    """Appends each id once, as long as its copies lie within ``late``."""
    once = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late).dropDuplicatesWithinWatermark([ident]).drop("__ts")
    _run(once, "append", lambda batch, n: _append(batch, out, n), checkpoint)
    return read_log(events.sparkSession, out, events.schema).drop("__batch")


def run_upserts(changes: DataFrame, key: str, order: Sequence[str], out: str, checkpoint: str) -> DataFrame:
    """Keeps the newest row of each key: a micro-batch logs its own newest rows and touches no
    others; the table is the newest row of each key over the log. A rerun without new input
    gives the same table."""
    _run(changes, "append", lambda batch, n: _append(newest(batch.withColumn("__batch", F.lit(n)), [key], order).drop("__batch"), out, n), checkpoint)
    return newest(read_log(changes.sparkSession, out, changes.schema), [key], order).drop("__batch")


def call_budget(events: DataFrame, ts: str, soft: int, hard: int) -> DataFrame:
    """Calls per hour against a soft and a hard limit."""
    per = events.groupBy(F.window(F.col(ts).cast("timestamp"), "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return per.select(F.col("w.start").alias("hour"), "n", F.when(F.col("n") > hard, "OVER").when(F.col("n") > soft, "NEAR").otherwise("WITHIN").alias("budget"))
