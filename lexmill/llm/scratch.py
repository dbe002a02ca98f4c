"""Shared scratch tables: lineage is cut by writing Parquet where every executor can read it."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.components import shared_folder


def widened(schema: T.StructType, *more: tuple[str, str]) -> T.StructType:
    """A copy of ``schema`` with columns added."""
    out = T.StructType(list(schema.fields))
    for name, kind in more:
        out = out.add(T.StructField(name, T.DataType.fromDDL(kind)))
    return out


def shielded(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but ``used`` renamed so that they clash with nothing, and how to get back the names and order."""
    names = [n if n in used else f"__{i}" for i, n in enumerate(df.columns)]
    renamed = df.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, names)])
    return renamed, lambda out: out.select(*[F.col(new).alias(old) for old, new in zip(df.columns, names)])


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, codec: str = "zstd", up: int = 0) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: a cut that survives lost executors.

    The table belongs to the innermost ``scope``, or to the one ``up`` levels further out.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if len(_scopes) > up:
        _scopes[-1 - up].append(path)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lexmill_path = path  # for discard()
    return out


_scopes: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables materialised within are deleted at the end: for steps whose result is written elsewhere by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def sweep(spark: SparkSession) -> int:
    """Delete every scratch table of this application, once no result of it is read any more; gives their number."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in (system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{spark.sparkContext.applicationId}-*")) or [])]
    for path in found:
        system.delete(path, True)
    return len(found)


SHUFFLED_BYTES = 32 << 20  # of a partition, while there are fewer than MOST_PARTITIONS
MOST_PARTITIONS = 8192


def partitions(want: int) -> int:
    """So many partitions, at most ``MOST_PARTITIONS``: with more, map tasks write ever more and smaller pieces."""
    return max(1, min(want, MOST_PARTITIONS))


@contextmanager
def sized(spark: SparkSession, size: int) -> Iterator[None]:
    """Shuffles within have partitions for ``size`` bytes, where the session's number gives larger ones.

    Adaptive execution joins small partitions but doesn't make more of them, so the number has to follow the input, up to
    ``MOST_PARTITIONS``; beyond that partitions grow, and sorts spill.
    """
    key = "spark.sql.shuffle.partitions"
    now, want = int(spark.conf.get(key)), partitions(-(-size // SHUFFLED_BYTES))
    if want <= now:
        yield
        return
    spark.conf.set(key, str(want))
    try:
        yield
    finally:
        spark.conf.set(key, str(now))


def discard(df: DataFrame) -> None:
    """Delete a materialised table that no later step reads."""
    path = getattr(df, "_lexmill_path", None)
    if path:
        _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now, not when the driver next collects its garbage.

    Events that end a query hold its plan, so those still on their way are waited for, some seconds at most: a busy
    cluster may have ever more of them, and then the files go with a later call.
    """
    gc.collect()
    context = spark.sparkContext
    try:
        context._jsc.sc().listenerBus().waitUntilEmpty(5000)
    except Py4JJavaError as e:
        if "TimeoutException" not in str(e.java_exception):
            raise
    context._jvm.System.gc()
