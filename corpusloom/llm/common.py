"""Shared plumbing: reliable lineage cuts, size-checked joins, two-level prefix sums."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.scale import spread

#: A join side is broadcast only when its measured size is at most this many bytes.
BROADCAST_BYTES = 8 << 20
#: Bytes that a row takes in a broadcast hash table beside its values (measured: 60 to 130).
ROW_OVERHEAD = 100
#: Rows of a group that one task of a prefix sum holds, about.
PREFIX_ROWS = 1 << 16
#: Bits of the map of a key set by which ``apart`` splits a table, for each key.
KEY_BITS = 16


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only a local master gets a temporary folder where the setting is absent; on a
    cluster an unset folder is an error, since a machine-local one loses data.
    """
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="loom-")
        sc.setCheckpointDir(at)
    return at.rstrip("/")


#: Folders that ``cut`` wrote, in the order of writing.
written: list[str] = []


def cut(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write *df* to the shared folder and read it again: short lineage that outlives executors.  The folder goes with the application, or by ``discard``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loom-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of ``cut`` that nothing reads any more."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        written.remove(path)


def fits(small: DataFrame, row_bytes: int, lists: tuple[str, ...] = ()) -> bool:
    """Whether the rows of *small* (a cut table), of *row_bytes*, the elements (8 bytes) of *lists* and what a hash table adds, measure little enough for a broadcast."""
    row_bytes += ROW_OVERHEAD
    each = F.lit(row_bytes)
    for c in lists:
        each = each + 8 * F.coalesce(F.size(c), F.lit(0))
    size = small.agg(F.sum(each).alias("b")).head()["b"] if lists else small.count() * row_bytes
    return (size or 0) <= BROADCAST_BYTES


def fitted(small: DataFrame, row_bytes: int, lists: tuple[str, ...] = ()) -> DataFrame:
    """*small* (a cut table) with a broadcast hint if it ``fits``; otherwise as it is, for a join that sorts and spills."""
    return F.broadcast(small) if fits(small, row_bytes, lists) else small


def apart(rows: DataFrame, keys: list[str], small: DataFrame, small_keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose *keys* may be in *small*, a cut table; the rest, whose keys are not), without a move of rows.

    Keys have equal types on both sides. They are marked in a map of bits by one hash, ``KEY_BITS`` for each (a rest of 94 %) and 8 MB in all at most; a key beyond that only makes the rest smaller.
    """
    h = lambda names: F.xxhash64(*names)
    words = max(1, min(-(-small.count() * KEY_BITS // 64), (8 << 20) // 8))
    spot = lambda x: F.pmod(F.shiftrightunsigned(x, 6), F.lit(words)).cast("int")
    bit = lambda x: x.bitwiseAND(63).cast("int")
    marks = small.select(h(small_keys).alias("h")).select(spot(F.col("h")).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col("h"))).alias("b"))
    marks = marks.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bits = np.zeros(words, np.int64)
    bits[marks["w"].to_numpy()] = marks["b"].to_numpy()
    one = F.broadcast(rows.sparkSession.createDataFrame(pa.table({"__bits": pa.array([bits])})))
    marked = F.getbit(F.get("__bits", spot(h(keys))), bit(h(keys)))
    both = rows.crossJoin(one)
    return tuple(both.where(marked == k).drop("__bits") for k in (1, 0))


def running_sum(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds *out*: the sum of *value* over the earlier rows of the group, by (*bucket*, *order*).

    Two levels, so that no task holds a whole group: totals by bucket are summed over the
    few buckets, and each bucket is scanned on its own.  Group keys and bucket are not null.
    """
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("__t"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = cut(totals.select(*group, bucket, F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__base")), "base")
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(fitted(base, 64), [*group, bucket])
        .withColumn(out, F.col("__base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("__base")
    )


def global_sum(df: DataFrame, order: list[str], value: str, out: str, ties: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(*df* with *out*: the sum of *value* over all rows before by *order*, then *ties*; the total).

    Rows are range-partitioned by their order; the partitions' totals, one row each, give each the sum before it.
    One part's rows are summed as they are.
    """
    parts = max(1, -(-df.count() // PREFIX_ROWS))
    if parts == 1:
        before = Window.orderBy(*order, *ties).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)).cast("long")), int(df.agg(F.sum(value).alias("t")).head()["t"] or 0)
    ranged = cut(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    totals = ranged.groupBy("__part").agg(F.sum(value).alias("__t"))
    base = cut(totals.select("__part", F.coalesce(F.sum("__t").over(ahead), F.lit(0)).alias("__base"), "__t"), "base")
    before = Window.partitionBy("__part").orderBy(*order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(fitted(base.drop("__t"), 24), "__part").withColumn(out, F.col("__base") + F.coalesce(F.sum(value).over(before), F.lit(0)))
    return placed.drop("__part", "__base"), int(base.agg(F.sum("__t").alias("t")).head()["t"] or 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, over all cores if it's a small one in fewer parts (one row group can't be read by several tasks)."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
