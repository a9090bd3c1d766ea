"""Session set-up and the few places where a plan is cut and written."""

from __future__ import annotations

import os
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


# Inputs of more partitions are never dealt anew before work in Python.
FEW = 64


def local_session(cores: str = "8", app: str = "fieldlark", **extra: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the session comes from outside."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8" if cores in ("*", "8") else cores)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in extra.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. It is read from ``spark.checkpoint.dir``; only
    where that is unset (tests, local mode) a temporary folder of this machine is used."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    if not at:
        if not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = os.path.join(tempfile.gettempdir(), "fieldlark-checkpoints")
    sc.setCheckpointDir(at)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that its lineage ends here.

    Reliable checkpoints survive the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_table(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few rows of the driver as a table. They go to the JVM as Arrow batches, so that no
    Python worker is started to read them."""
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), schema)


def spread(df: DataFrame, ident: str) -> DataFrame:
    """``df`` dealt over all cores by an id, if it is a scan of at most ``FEW`` partitions that would
    leave half of the cores idle.

    Work in Python that follows a scan of a few small files would otherwise run on a few
    cores. Larger inputs, and plans that shuffle anyway, are left as they are."""
    plan = df._jdf.queryExecution()
    if "Exchange" in plan.sparkPlan().toString() or "Join" in plan.sparkPlan().toString() or "Aggregate" in plan.sparkPlan().toString():
        return df
    have = plan.toRdd().getNumPartitions()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, ident) if have <= FEW and 2 * have <= cores else df
