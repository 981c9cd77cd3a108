"""Where jobs put tables that later steps read again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as `spark.checkpoint.dir` names it.

    A local session without the setting gets a new temporary folder. On a cluster
    the setting is required: a folder of one machine would be lost with it.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidewell-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/tidewell/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; nothing happens where there is none."""
    place, files = _place(spark, path)
    files.delete(place, True)


def folders(spark: SparkSession, path: str, prefix: str, complete: bool = False) -> list[str]:
    """Names of the folders below a path that begin with a prefix; none where there is no such path.

    With `complete`, only those that Spark has written to the end.
    """
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    found = [s.getPath() for s in files.listStatus(place) if s.isDirectory() and s.getPath().getName().startswith(prefix)]
    ended = lambda p: files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return sorted(p.getName() for p in found if not complete or ended(p))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is put below the shared folder meanwhile.

    Results are lazy: what is to stay has to be written elsewhere before the end.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


def write_once(df: DataFrame, name: str, spread: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    For results that several later branches use: it is computed once, and a lost
    executor costs a re-read instead of the whole lineage. `spread` divides the rows
    evenly over all shuffle partitions: for few rows that each cause much work.
    """
    path = new_path(df.sparkSession, name)
    if spread:
        df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
