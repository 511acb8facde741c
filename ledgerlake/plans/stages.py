"""Tables between the steps of a long plan: each later step reads files, not the whole plan before it."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where that is unset and all runs in this process (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (named or _own_folder()).rstrip("/")


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-stages-")


# Shuffle files of a query go when it ends, not when the driver's next garbage collection finds them; and tables that are dealt by some of a join's keys
# already meet as they lie.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """What is run inside holds little disk; the session's own settings hold again afterwards."""
    before = {k: spark.conf.get(k, None) for k in LEAN}
    for k, v in LEAN.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def write_step(df: DataFrame, path: str) -> DataFrame:
    """Write df below path and read it back; its shuffle files are gone then."""
    with lean(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df and read it back."""
    return write_step(df, f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}")


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def discard(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        files, path = _file_system(df.sparkSession, folder)
        files.delete(path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it isn't there."""
    files, where = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(where)) if files.exists(where) else []


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole; raises where one of that name is there already, which makes it a commit."""
    files, where = _file_system(spark, path)
    jvm = spark.sparkContext._jvm
    draft = jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if files.exists(where) or not files.rename(draft, where):
        files.delete(draft, False)
        raise FileExistsError(f"{path} is there already: another writer was first")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    files, where = _file_system(spark, path)
    stream = files.open(where)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def state_of(spark: SparkSession, *paths: str) -> str:
    """A digest of the files below paths: their names, lengths and times. It changes when they do."""
    found = []
    for path in paths:
        files, where = _file_system(spark, path)
        if not files.exists(where):
            found.append((path, -1, -1))
            continue
        each = files.listFiles(where, True)
        while each.hasNext():
            f = each.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()


_kept: dict[tuple, tuple[str, DataFrame]] = {}
_stale: list[tuple[str, DataFrame]] = []


def stage_once(spark: SparkSession, name: str, build: Callable[[], DataFrame], *key: str, inputs: tuple[str, ...] = ()) -> DataFrame:
    """The staged table of this name and key, built at its first use in a Spark application, as a refresh writes its views once.

    inputs: the paths that it is made of; when a file there was added, removed or written again, the table is built anew."""
    at, state = (spark.sparkContext.applicationId, name, *key), state_of(spark, *inputs) if inputs else ""
    if at in _kept and _kept[at][0] != state:
        _stale.append((at[0], _kept.pop(at)[1]))  # a frame that was handed out may still read it
    if at not in _kept:
        _kept[at] = state, stage(build(), name)
    return _kept[at][1]


def discard_kept(spark: SparkSession) -> None:
    """Remove what stage_once has written in this application; the next use builds it anew."""
    mine = spark.sparkContext.applicationId
    for at in [k for k in _kept if k[0] == mine]:
        discard(_kept.pop(at)[1])
    for at in [x for x in _stale if x[0] == mine]:
        discard(at[1])
        _stale.remove(at)
