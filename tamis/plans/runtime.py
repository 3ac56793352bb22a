"""Where intermediate tables go, and how many partitions Python stages get."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only where neither the setting nor the
    context has one (tests on one machine) a folder of our own is set."""
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    d = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = os.path.join(tempfile.gettempdir(), f"tamis-checkpoint-{os.getuid()}")
    sc.setCheckpointDir(d)
    return d


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut.

    The result is rebuilt from the checkpointed rows alone: what checkpoint() keeps of the old
    plan (constraints on every alias) makes planning exponential in iterative jobs.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    jdf = df.checkpoint(eager=True)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(jdf.queryExecution().toRdd(), jdf.schema(), False), spark)


_TABLES: list[tuple[SparkSession, str]] = []


def _drop_tables() -> None:
    """Removes the tables of :func:`written` when the program ends."""
    for spark, path in _TABLES:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session may be gone; then only local files can be removed
            shutil.rmtree(path.removeprefix("file:"), ignore_errors=True)


def scratch(spark: SparkSession, ending: str = "") -> str:
    """A path of its own in the shared checkpoint folder, removed when the program ends."""
    if not _TABLES:
        atexit.register(_drop_tables)
    path = f"{checkpoint_dir(spark)}/tamis-{uuid.uuid4().hex}{ending}"
    _TABLES.append((spark, path))
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared checkpoint folder: smaller than a checkpoint, and
    later reads take only the columns they need. Order and partitioning aren't kept. The table is
    removed when the program ends."""
    spark = df.sparkSession
    path = scratch(spark, ".parquet")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, per_task: int = 2) -> DataFrame:
    """Rows dealt round over the cores when the scan gives fewer partitions than cores, as it
    does for one small file. A large scan has many splits and isn't shuffled, nor is what comes from a shuffle."""
    if df.isStreaming:
        return df
    # Under adaptive execution the partitions of a shuffle are known only by running it.
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want * per_task)


#: Keys with more than one row in so many are joined by a broadcast; there are fewer than GIANTS of them.
GIANTS = 1000


def prefix_sums(laid: DataFrame, part: str, amount: Column) -> tuple[DataFrame, list]:
    """``part, base``: what the partitions before each hold together, as a table of one row a partition, and its rows."""
    rows = sorted(laid.groupBy(part).agg(F.coalesce(F.sum(amount), F.lit(0)).alias("n")).collect())
    out, acc = [], 0
    for r in rows:
        out.append((r[0], acc))
        acc += r[1]
    kind = "double" if any(isinstance(x, float) for _, x in out) else "bigint"
    return laid.sparkSession.createDataFrame([(k, float(v) if kind == "double" else int(v)) for k, v in out], f"{part} int, base {kind}"), out


def positions(df: DataFrame, order: list, name: str = "pos") -> DataFrame:
    """``df`` with ``name``, the place of each row from 0 under ``order`` (unique, else ties are arbitrary), by one range
    sort and the counts of its partitions: one row a partition reaches the driver."""
    laid = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()))
    laid = laid.withColumn("__p", F.shiftright("__m", 33).cast("int"))
    base, _ = prefix_sums(laid, "__p", F.lit(1))
    return laid.join(F.broadcast(base), "__p", "left").withColumn(name, F.coalesce("base", F.lit(0)) + F.col("__m").bitwiseAND((1 << 33) - 1)).drop("__m", "__p", "base")


def places(df: DataFrame, key: str, order: list, name: str = "place") -> DataFrame:
    """``df`` with ``name``, the place of each row from 0 among those of its ``key``: positions of one range sort less the
    first of the key, so that a key with a third of all rows stays spread. Null keys are a key of their own."""
    laid = cut(positions(df.withColumn("__k", F.coalesce(F.xxhash64(F.col(key)), F.lit(0))), ["__k", *order], "__at"))
    first = cut(laid.groupBy("__k").agg(F.min("__at").alias("__first"), F.count("*").alias("__n")))
    giant = F.col("__n") * GIANTS > laid.count()
    few, rest = (first.where(c).select("__k", "__first") for c in (giant, ~giant))
    told = laid.join(F.broadcast(few.withColumnRenamed("__first", "__big")), "__k", "left")
    big = told.where("__big is not null").withColumnRenamed("__big", "__first")
    out = big.unionByName(told.where("__big is null").drop("__big").join(rest, "__k"))
    return out.withColumn(name, F.col("__at") - F.col("__first")).drop("__k", "__at", "__first")
