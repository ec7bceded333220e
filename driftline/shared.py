"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_WRITTEN: dict[int, list[str]] = {}
_HERE = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of our own on a local master, and an error on a cluster, whose machines wouldn't see it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = "file://" + tempfile.mkdtemp(prefix="driftline-")
    return _LOCAL["dir"]


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder; ``release`` deletes it."""
    path = f"{shared_dir(spark)}/driftline-{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(id(spark), []).append(path)
    for own in getattr(_HERE, "scopes", ()):
        own.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._folder = path
    return back


@contextmanager
def settings(spark: SparkSession, held: dict[str, str]):
    """Settings of the session for what is planned and run within; they are put back."""
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def measured_broadcasts(spark: SparkSession):
    """Within, joins that Spark plans broadcast a table by the size of its rows, as a shuffle has measured it, and not by that of its files, whose packed columns take many times as much in the driver."""
    adaptive, planned = "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"
    most = spark.conf.get(adaptive, None) or spark.conf.get(planned)
    with settings(spark, {adaptive: most, planned: "-1"}):
        yield


@contextmanager
def passing_folders(spark: SparkSession):
    """Folders that this thread's calls make within are deleted at the end; other threads' stay."""
    own: list[str] = []
    _HERE.scopes = [*getattr(_HERE, "scopes", ()), own]
    try:
        yield
    finally:
        _HERE.scopes = _HERE.scopes[:-1]
        held = _WRITTEN.get(id(spark), [])
        for path in own:
            if path in held:
                held.remove(path)
                delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of tables from ``written`` that no result reads any more."""
    for table in tables:
        spark, path = table.sparkSession, table._folder
        delete(spark, path)
        own = _WRITTEN.get(id(spark), [])
        if path in own:
            own.remove(path)


def made(spark: SparkSession) -> int:
    """How many folders this session's calls have made: where ``release`` may begin."""
    return len(_WRITTEN.get(id(spark), []))


def release(spark: SparkSession, first: int = 0, keep: DataFrame | None = None) -> int:
    """Delete the folders that this session's calls made (from the first-th on) and that are still there, but for a table's; results read from them are gone. Their number."""
    paths, kept = _WRITTEN.get(id(spark), []), getattr(keep, "_folder", None)
    gone = [p for p in paths[first:] if p != kept]
    for path in gone:
        delete(spark, path)
        paths.remove(path)
    return len(gone)
