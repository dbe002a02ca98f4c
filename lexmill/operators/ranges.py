"""Ranks and weighted medians over range partitions: sorted tables whose parts are counted and then offset.

A table is dealt by ranges of its order and written with each row's partition and place in it; the counts of the
partitions, one row for each, give where a partition starts.  So no task ranks or sums more than its own range, however
alike the keys are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.components import cut

_PLACE_BITS = 33  # of monotonically_increasing_id: the place within a partition


def _ranged(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` written in sorted range partitions, with ``part`` and ``place`` (from 0) of each row."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    rows = rows.withColumn("part", F.shiftright(at, _PLACE_BITS)).withColumn("place", at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
    return cut(rows, name)[0]


def numbered_in_order(df: DataFrame, order: list[str], column: str = "number") -> DataFrame:
    """``df`` with the row number in ``order`` (from 1).  Rows must differ in it for the result to be defined."""
    rows = _ranged(df, order, "ranged")
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return rows.join(F.broadcast(before), "part").withColumn(column, F.col("before") + F.col("place") + 1).drop("part", "place", "before")


def weighted_medians(hist: DataFrame, keys: list[str], value: str = "x", weight: str = "n") -> DataFrame:
    """(keys, size, median) of (keys, value, weight) with distinct values: the mean of the two middle ones.

    Each range sums its own weights for each key; a key whose values fill several ranges starts in each where the ones
    before end.  Rows of a null value count for nothing; of a null key they are a group.
    """
    if not keys:
        return weighted_medians(hist.withColumn("__all", F.lit(0)), ["__all"], value, weight).drop("__all")
    rows = _ranged(hist.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__x"), F.col(weight).cast("long").alias("__n")), [*keys, "__x"], "histogram")
    named = [F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]
    sums = rows.groupBy(*keys, "part").agg(F.sum("__n").alias("s"))
    run = F.sum("s").over(Window.partitionBy(*keys).orderBy("part"))  # as many rows as ranges that hold the key
    starts = sums.withColumn("before", run - F.col("s")).withColumn("size", F.sum("s").over(Window.partitionBy(*keys))).select(*named, F.col("part").alias("__part"), "before", "size")
    same = F.col("part") == F.col("__part")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__{i}"))
    upto = F.col("before") + F.sum("__n").over(Window.partitionBy(*keys, "part").orderBy("place"))
    placed = rows.join(starts, same).withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("__n"))
    at = lambda k: F.max(F.when((F.col("from") <= k) & (k < F.col("upto")), F.col("__x")))
    low, high = F.floor((F.col("size") - 1) / 2), F.floor(F.col("size") / 2)
    out = placed.groupBy(*keys).agg(F.max("size").alias("size"), at(low).alias("low"), at(high).alias("high"))
    return out.select(*keys, "size", ((F.col("low") + F.col("high")) / 2).alias("median"))
