"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def tune(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the library is measured with; none of them changes a result."""
    return (
        builder
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Sizes guessed before a run are far off after an explode. A side is broadcast once
        # its shuffled size is known, or where the code has checked the size itself.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, set on the context when it is not yet.

    The cluster names it in ``spark.checkpoint.dir``. A session that names none gets a
    folder below its warehouse. On a cluster that must not be a folder of one machine, so a
    warehouse in the local file system is refused there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        place = sc._jvm.org.apache.hadoop.fs.Path(folder)
        scheme = place.getFileSystem(sc._jsc.hadoopConfiguration()).getUri().getScheme()
        if scheme == "file" and sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach: the warehouse is a local one")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for a written table.

    A returned plan may still read it, so the folder goes when the session's JVM ends.
    """
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same, and the path, for ``drop_stored`` once nothing reads it any more."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a written table ahead of the session's end."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: Spark hands them a copy, once in each session."""
    sc = spark.sparkContext
    if getattr(sc, "_hubcat_shipped", False):
        return
    root, place = os.path.dirname(os.path.abspath(__file__)), f"{scratch_path(spark, 'package')}/hubcat.zip"
    with tempfile.TemporaryDirectory() as folder:
        os.mkdir(f"{folder}/src")
        shutil.copytree(root, f"{folder}/src/hubcat", ignore=shutil.ignore_patterns("__pycache__"))
        made = shutil.make_archive(f"{folder}/hubcat", "zip", f"{folder}/src")
        path = sc._jvm.org.apache.hadoop.fs.Path
        path(place).getFileSystem(sc._jsc.hadoopConfiguration()).copyFromLocalFile(path(made), path(place))
    sc.addPyFile(place)
    sc._hubcat_shipped = True
