"""What several of the text operators share."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# White space and words of the text contracts, for Java's and DuckDB's regular expressions.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Most rows of a narrow table (a few numbers a row) that is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, as ``--py-files`` would.

    Batches that go to Python hold whole texts, so they get fewer rows than Spark's default,
    unless the session has another value.
    """
    context = spark.sparkContext
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "2000")
    if not getattr(context, "_tabwright_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        # The driver's own folder will do: executors fetch the file from the driver.
        staged = os.path.join(tempfile.mkdtemp(prefix="tabwright-"), "src")
        shutil.copytree(package, os.path.join(staged, os.path.basename(package)), ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(os.path.join(os.path.dirname(staged), "tabwright_package"), "zip", staged))
        context._tabwright_shipped = True
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized(df: DataFrame, lists: str | None = None) -> DataFrame:
    """``df`` with a broadcast hint if a count shows that it is small, else as it is, for a shuffled join.

    Pass a stored table: the count then reads its footers, or the column ``lists``, whose
    elements count as rows.
    """
    n = df.count() if lists is None else df.agg(F.sum(F.size(lists) + 1)).first()[0] or 0
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, after the given ones."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def running_total(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a group, as column ``out``.

    ``bucket`` splits a group into stretches that follow each other in ``order``. Only the
    sums of the stretches meet per group, so a hot group is shared by many tasks.
    """
    ahead = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    stretches = (
        df.groupBy(*group, bucket)
        .agg(F.sum(value).alias("_stretch"))
        .withColumn("_ahead", F.coalesce(F.sum("_stretch").over(ahead), F.lit(0)))
        .drop("_stretch")
    )
    within = W.partitionBy(*group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return (
        rows.join(stretches, [*group, bucket])
        .withColumn(out, F.col("_ahead") + F.col("_within"))
        .drop("_ahead", "_within")
    )


# Most bytes of a table that is broadcast whatever its rows hold.
BROADCAST_BYTES = 32 << 20
# A key with this share of the rows or more counts as hot: at most 10,000 keys are.
HOT_SHARE = 10_000


def bounded(df: DataFrame, size: Column) -> DataFrame:
    """``df`` with a broadcast hint if the sum of ``size``, a row's bytes, shows that it is small."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def join_spread(rows: DataFrame, table: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Inner join of stored ``rows`` with a stored ``table`` that has one row per key.

    ``n`` is the number of rows of a key. Rows of a hot key, at most one per ``HOT_SHARE`` of
    all and so at most ``HOT_SHARE`` keys, meet their narrow table row by a broadcast; the others are shuffled.
    """
    least = max(1, rows.count() // HOT_SHARE)
    hot = table.filter(F.col(n) > least)
    cold = table.filter(F.col(n) <= least)
    named = hot.select(*keys)
    return rows.join(F.broadcast(hot), keys).unionByName(rows.join(F.broadcast(named), keys, "left_anti").join(cold, keys))
