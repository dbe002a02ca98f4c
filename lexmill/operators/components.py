"""Connected components by alternating large-star and small-star contraction.

Each round is two joins of the edge table with per-node minima, so no component is ever gathered in one task.  The
minima are written before they are joined: a join with an aggregate of the same exchange is one that adaptive execution
doesn't split, a join of two scans is.  Lineage is cut by writing each round into the shared folder that
``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset a temporary folder, in local mode alone.

    On a cluster a folder of one machine would lose rows, so there it must be set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    global _own_dir
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="lexmill-")
    return _own_dir


def cut(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to and read back from the shared folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _drop(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


class Written:
    """Named tables of an algorithm in rounds, each written; a table that takes another's name replaces it on disk."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        out, path = cut(df, name)
        old, self.paths[name] = self.paths.get(name), path
        if old:
            _drop(self.spark, old)
        return out

    def close(self, *kept: str) -> None:
        """Drop all tables but those that a result still reads."""
        for name in set(self.paths) - set(kept):
            _drop(self.spark, self.paths.pop(name))


def _large_star(edges: DataFrame) -> tuple[DataFrame, str]:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low, path = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), path


def _small_star(edges: DataFrame) -> tuple[DataFrame, str]:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low, path = cut(down.groupBy("u").agg(F.min("v").alias("m")), "low")
    kept = down.join(low, "u")
    return kept.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct(), path


def drop_table(spark: SparkSession, path: str) -> None:
    _drop(spark, path)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """``node, component`` for every node with an edge to another; component is the smallest node reachable.

    Any orderable type does.  Edges with a null end and self-loops join nothing; repeated and reversed edges count
    once.  An empty edge table gives an empty result.
    """
    spark = edges.sparkSession
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    now, path = cut(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        wide, wide_low = _large_star(now)
        wide, wide_path = cut(wide, "edges")
        new, new_low = _small_star(wide)
        new, new_path = cut(new, "edges")
        for done in (wide_low, wide_path, new_low):
            _drop(spark, done)
        row = new.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        _drop(spark, path)
        now, path = new, new_path
        if mark == tuple(row):
            break
        mark = tuple(row)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    out._lexmill_path = path  # the table that it reads, for callers that write it elsewhere
    return out
