"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Least number of files of a stored table. Only for one machine, whose small inputs are
# single files and would keep a single core busy; unset, a table is written as it comes.
SPREAD = "spark.tabwright.spread"


def build_session(app: str = "tabwright", master: str | None = None) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster leave ``master`` unset: the submitter decides it, together
    with memory, shuffle partitions and ``spark.checkpoint.dir``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites cost a stack walk per column operation; wide tables have thousands.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.sql.shuffle.partitions", os.environ.get("TABWRIGHT_SHUFFLE", "8"))
            .config("spark.driver.memory", os.environ.get("TABWRIGHT_MEMORY", "12g"))
            .config("spark.ui.enabled", "false")
            .config(SPREAD, os.environ.get("TABWRIGHT_SHUFFLE", "8"))
            # Small local data would otherwise be coalesced to a single task.
            .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        )
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tabwright-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def distribute(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would.

    Only what runs Python code in tasks needs it. Executors fetch the file from the driver.
    """
    context = spark.sparkContext
    if not getattr(context, "_tabwright_shipped", False):
        package = os.path.dirname(os.path.abspath(__file__))
        staged = os.path.join(tempfile.mkdtemp(prefix="tabwright-"), "src")
        shutil.copytree(package, os.path.join(staged, os.path.basename(package)), ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(os.path.join(os.path.dirname(staged), "tabwright_package"), "zip", staged))
        context._tabwright_shipped = True


# Paths of this process's intermediate tables, for ``clear_scratch``.
_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark).rstrip('/')}/tabwright/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables that this process has written; returns how many there were.

    Results that still read them must have been stored before.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths, _WRITTEN[:] = list(_WRITTEN), []
    return sum(bool(p.getFileSystem(conf).delete(p, True)) for p in map(jvm.org.apache.hadoop.fs.Path, paths))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lineage is cut, the table survives lost executors, and Catalyst knows the
    size of what it reads, so it can pick join strategies by that size.
    """
    return materialize_at(df, scratch_path(df.sparkSession, name))


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    """``materialize`` to a path of ``scratch_path``, which ``discard`` can delete again."""
    spark = df.sparkSession
    schema = df.schema
    spread = spark.conf.get(SPREAD, None)
    (df.repartition(int(spread)) if spread else df).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


@contextmanager
def configured(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs inside; afterwards the former ones hold again."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
