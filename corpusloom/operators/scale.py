"""Global order without a global task: numbering, the k-th row, durable intermediate tables, small inputs over all cores."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a part that one task numbers, about.
PART_ROWS = 1 << 18


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Takes the shared folder of spark.checkpoint.dir; a temporary one on a local master only, where none is set."""
    sc = spark.sparkContext
    if not (sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()):
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="loom-"))


def settled(df: DataFrame) -> DataFrame:
    """*df* computed once and kept in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def numbered(df: DataFrame, order: list[str], out: str, weight: str | None = None) -> DataFrame:
    """Adds *out*, the place from 0 on by *order* (or the sum of *weight* before it): rows are range-partitioned, and the counts of the parts before, one row each, are
    added to the place within a part.  *df* is computed once."""
    df = settled(df)
    parts = max(1, -(-df.count() // PART_ROWS))
    ranged = settled(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    each = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = ranged.groupBy("__part").agg(F.sum(each).alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    place = F.coalesce(F.sum(each).over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranged.join(base, "__part").withColumn(out, F.col("__base") + place).drop("__part", "__base")


def first_rows(df: DataFrame, key: Column, tie: str, sizes: list[int]) -> Column:
    """Which slice each row falls into when rows go by (*key*, *tie*): 0 for the first sizes[0], 1 for the next sizes[1] ..., null beyond.

    *key* is an md5 text.  The rows at the ends of the slices are found by counting rows by the first four digits and sorting within one count only;
    the rows themselves don't move.
    """
    ends, total = [], 0
    keys = df.select(key.alias("k"), F.col(tie).alias("t"))
    counts = sorted((r["p"], r["n"]) for r in keys.groupBy(F.substring("k", 1, 4).alias("p")).agg(F.count("*").alias("n")).collect()) if any(sizes) else []  # 65,536 at most
    for size in sizes:
        total += size
        left, end = total, None
        for p, n in counts:
            if 0 < left <= n:
                end = keys.where(F.substring("k", 1, 4) == p).orderBy("k", "t").offset(left - 1).limit(1).collect()[0]
                break
            left -= n
        ends.append(end)
    out = F.lit(None).cast("int")
    for k in reversed(range(len(sizes))):
        if total and ends[k] is not None and sizes[k]:
            upto = (key < ends[k]["k"]) | (key == ends[k]["k"]) & (F.col(tie) <= F.lit(ends[k]["t"]))
            out = F.when(upto, k).otherwise(out)
        elif total and ends[k] is None and sizes[k] and counts:
            out = F.lit(k)
    return out


def spread(df: DataFrame) -> DataFrame:
    """*df* over all cores if it comes in fewer parts (a small table in one row group); a large one as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Bytes of an Arrow batch that goes to a Python worker, where the session has Spark's default.
BATCH = "8m"


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of Python workers by bytes, so that their memory follows neither the rows of a table nor the length of its texts; a session's own value stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) in ("64MB", "64m", "67108864", "67108864b"):
        spark.conf.set(name, BATCH)
