"""Session helpers: reading tables, sizing shuffles, and cutting lineage.

Lineage is cut by writing a table into the folder the cluster names in
``spark.checkpoint.dir`` (shared by all executors). Only in local mode, where
that setting may be absent as in tests, a folder of this process is used; on a
cluster without it, staging is an error. What a session staged is deleted by
:func:`release`, at the latest when the process ends.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_own_dir: str | None = None
_shipped: set[str] = set()
_staging: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder for tables that cut lineage: the cluster's, else in local mode one of this process."""
    global _own_dir
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, _own_dir, True)
    return _own_dir


def _stages(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stages/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame into the shared folder and read it back: computed once, no lineage."""
    spark = df.sparkSession
    sc = spark.sparkContext
    path = f"{_stages(spark)}/{name}-{uuid.uuid4().hex}"
    if sc.applicationId not in _staging:
        _staging.add(sc.applicationId)
        atexit.register(_release_at_exit, spark)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    schema: StructType = df.schema
    writer.parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table this application staged; frames that read them are of no use afterwards."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(_stages(spark))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def _release_at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by then
        release(spark)


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, wherever they run and the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            if "__pycache__" in folder:
                continue
            for f in files:
                full = os.path.join(folder, f)
                z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def splits(df: DataFrame) -> int:
    """Number of input splits of a frame that was just read."""
    return df._jdf.queryExecution().toRdd().getNumPartitions()


def spread(df: DataFrame, key: str) -> DataFrame:
    """A frame with work for every core before a step that is dear per row.

    An input of fewer splits than cores (a file that cannot be split) is hashed
    over them by an id; any other input stays where it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if splits(df) < cores else df
