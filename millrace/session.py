"""Session helpers: table reading, staging in the cluster's shared folder, exact distributed ranks."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def local_session(app: str = "millrace", cores: str = "*", shuffle: int = 8) -> SparkSession:
    """A session for tests and single machines; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`. Where that is unset, a session on one machine gets a folder of
    its own; a cluster's session is refused, as other executors couldn't read what is written there."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = getattr(spark, "_millrace_dir", None)
        if not at:
            at = tempfile.mkdtemp(prefix="millrace-")
            atexit.register(shutil.rmtree, at, ignore_errors=True)
            spark._millrace_dir = at
    return at


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives the loss of executors, and lets
    several consumers read a costly result that is computed once. The files go when the application ends, or by `release`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _remove_at_end(spark, path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._millrace_path = path
    return staged


def release(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        spark = df.sparkSession
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._millrace_path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Rows of a narrow table (keys, marks) up to which it is sent to all executors
SMALL_ROWS = 500_000


def join_by_size(df: DataFrame, narrow: DataFrame, on: Column | list[str], how: str, most: int = SMALL_ROWS) -> DataFrame:
    """`df` joined with a staged narrow table: sent whole to the executors if it has at most `most` rows (counted from the
    staged files), else joined by shuffle. `df` is then not shuffled for a handful of rows, and nothing unbounded is sent."""
    return df.join(F.broadcast(narrow) if narrow.limit(most + 1).count() <= most else narrow, on, how)


def _remove_at_end(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).deleteOnExit(p)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def exact_rank(df: DataFrame, group: list[str], key: Column, width: Column, name: str = "rank") -> DataFrame:
    """Rank (from 0) of each row within `group` by the hash `key` (a LONG that is unique or nearly so), without ever
    sorting a whole group in one task: rows fall into `width` ranges of the hash, the small table of counts per range
    gives each range its offset, and only a range is sorted. Ties in `key` take an arbitrary but total order when the
    caller's key is unique."""
    span = F.lit(2.0**64)
    sliced = df.withColumn("_k", key).withColumn(
        "_slice", F.least(F.floor((F.col("_k").cast("double") + F.lit(2.0**63)) / span * width), width - 1).cast("long")
    )
    counts = sliced.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    on = [sliced[c].eqNullSafe(offsets[c]) for c in [*group, "_slice"]]
    joined = sliced.join(offsets, on[0] if len(on) == 1 else _all(on), "inner")
    for c in [*group, "_slice"]:
        joined = joined.drop(offsets[c])
    inner = Window.partitionBy(*group, "_slice").orderBy("_k")
    return joined.withColumn(name, F.col("_off") + F.row_number().over(inner) - 1).drop("_k", "_slice", "_off")


def running_sum(df: DataFrame, value: Column, group: list[str], order: str, name: str, block: int = 100_000) -> DataFrame:
    """`df` with the sum of `value` up to and with each row of its group in `order` (whole numbers), without one task for
    a whole group: sums per block of the order, a window over blocks, a window within a block."""
    return _running(df, value, group, order, name, block, F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + b)


def running_max(df: DataFrame, value: Column, group: list[str], order: str, name: str, block: int = 100_000) -> DataFrame:
    """As running_sum, the greatest `value` so far (nulls don't count; null where there is none)."""
    return _running(df, value, group, order, name, block, F.max, F.greatest)


def _running(df: DataFrame, value: Column, group: list[str], order: str, name: str, block: int, over: Callable[[str], Column], both: Callable[[Column, Column], Column]) -> DataFrame:
    blocked = df.withColumn("_v\u0001", value).withColumn("_blk\u0001", F.floor(F.col(order) / block))
    parts = blocked.groupBy(*group, "_blk\u0001").agg(over("_v\u0001").alias("_s\u0001"))
    before = Window.partitionBy(*group).orderBy("_blk\u0001").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*[F.col(c).alias(f"{c}\u0002") for c in group], F.col("_blk\u0001").alias("_blk\u0001\u0002"), over("_s\u0001").over(before).alias("_before\u0001"))
    on = _all([blocked[c].eqNullSafe(parts[f"{c}\u0002"]) for c in [*group, "_blk\u0001"]])
    within = Window.partitionBy(*group, "_blk\u0001").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    told = blocked.join(parts, on).withColumn(name, both(F.col("_before\u0001"), over("_v\u0001").over(within)))
    return told.drop("_v\u0001", "_blk\u0001", "_before\u0001", "_blk\u0001\u0002", *[f"{c}\u0002" for c in group])


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def hash_sample(df: DataFrame, key: str, most: int) -> list:
    """At most `most` rows, those with the smallest hash of their key, for fitting a model. A bound on the hash that about
    twice as many rows keep is applied first, so the driver is sent a few thousand rows from any number of partitions."""
    n, h = df.count(), F.xxhash64(F.col(key))
    if n > 4 * most:
        df = df.filter(h < F.lit(int(-(2**63) + 2.0**64 * 2 * most / n)))
    return df.orderBy(h, key).limit(most).collect()
