"""Publication in one switch: rows are staged and checked, then a numbered manifest names what readers see."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from hubcat.functions.text import quoted

_MANIFESTS, _RUN = "_published", "published_run"


class Conflict(RuntimeError):
    """Another run published first, over and over."""


def _files(spark: SparkSession, path: str):
    """A path of the shared file system, and the two interfaces to it."""
    sc = spark.sparkContext
    place, conf = sc._jvm.org.apache.hadoop.fs.Path(path), sc._jsc.hadoopConfiguration()
    return place, place.getFileSystem(conf), sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf)


def _manifest_numbers(spark: SparkSession, path: str) -> list[int]:
    place, fs, _ = _files(spark, f"{path}/{_MANIFESTS}")
    names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, number: int | None = None) -> dict:
    """The newest manifest, or one of an earlier number: {"number", "folders": {partition: run folder}, "rows", "schema"}.

    Rows and schema are those of its own run.
    """
    numbers = _manifest_numbers(spark, path)
    if number is None and numbers:
        number = numbers[-1]
    if number not in numbers:
        raise ValueError(f"{path}: nothing is published")
    return json.loads(spark.read.text(f"{path}/{_MANIFESTS}/{number:012d}.json", wholetext=True).first()[0])


def _switch(spark: SparkSession, path: str, made: dict) -> bool:
    """Put a manifest in its place by one rename, which fails where another run has been faster."""
    temporary, fs, context = _files(spark, f"{path}/{_MANIFESTS}/_{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(bytearray(json.dumps(made).encode()))
    out.close()
    final = _files(spark, f"{path}/{_MANIFESTS}/{made['number']:012d}.json")[0]
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(temporary, final, none)
    except Py4JJavaError as error:
        fs.delete(temporary, False)
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True


def publish(df: DataFrame, path: str, partitions: tuple[str, ...] = (), check: Callable[[DataFrame, int], None] | None = None,
            attempts: int = 5) -> int:
    """Make the rows of ``df`` the table at ``path``, or its folders for the values of ``partitions``; the manifest's number.

    The rows go to a folder of their own, counted while they are written. They are read back, the counts must agree, and
    ``check(rows read back, count)`` may raise. Only then one rename puts a new manifest in place, which readers
    follow: whatever stops a run before, the old table stays. Partitions that the run holds replace those of
    earlier runs, all others stay; so a run that is repeated leaves no repeats. Two runs at once: the
    slower one takes the other's manifest as its base. The driver holds one name for each partition.
    """
    spark, run = df.sparkSession, f"{_RUN}={uuid.uuid4().hex}"
    counted = Observation(run)
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partitions).parquet(f"{path}/{run}")
    wrote = counted.get["rows"]
    back = spark.read.schema(df.schema).parquet(f"{path}/{run}")
    found = back.count()
    if found != wrote:
        raise ValueError(f"{path}: {found} rows read back of {wrote}")
    if check is not None:
        check(back, wrote)
    root, fs, _ = _files(spark, f"{path}/{run}")
    held = fs.globStatus(_files(spark, "/".join([f"{path}/{run}", *("*=*" for _ in partitions)]))[0]) if partitions else [fs.getFileStatus(root)]
    own = {s.getPath().toString().split(run, 1)[1].strip("/"): run for s in held}
    for _ in range(attempts):
        numbers = _manifest_numbers(spark, path)
        before = manifest(spark, path, numbers[-1])["folders"] if numbers and partitions else {}
        number = numbers[-1] + 1 if numbers else 1
        if _switch(spark, path, {"number": number, "folders": {**before, **own}, "rows": wrote, "schema": df.schema.jsonValue()}):
            return number
    raise Conflict(path)


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as the newest manifest (or an earlier one) has it, with its columns: what an older run lacks is null."""
    now = manifest(spark, path, number)
    folders = now["folders"]
    if not folders:
        raise ValueError(f"{path}: no partition is published")
    places = [f"{path}/{run}/{partition}".rstrip("/") for partition, run in sorted(folders.items())]
    schema = StructType.fromJson(now["schema"])
    return spark.read.schema(schema).option("basePath", path).parquet(*places).select(*(quoted(c) for c in schema.names))


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the folders that earlier manifests name and the newest does not, and these manifests; how many folders went.

    Folders of runs that no manifest names yet are left alone. Call it when nobody reads an earlier state any more.
    """
    *earlier, last = _manifest_numbers(spark, path)
    kept = set(manifest(spark, path, last)["folders"].items())
    gone = {item for n in earlier for item in manifest(spark, path, n)["folders"].items()} - kept
    for partition, run in gone:
        place, fs, _ = _files(spark, f"{path}/{run}/{partition}".rstrip("/"))
        fs.delete(place, True)
    for n in earlier:
        place, fs, _ = _files(spark, f"{path}/{_MANIFESTS}/{n:012d}.json")
        fs.delete(place, False)
    return len(gone)
