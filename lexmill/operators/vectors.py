"""Exact search and joins of vectors by angle, over partitions around pivots.

Vectors go to the nearest of some pivots.  Angles between unit vectors obey the triangle inequality, so a partition whose
pivot is further from a query than the partition's radius and the query's reach holds nothing within that reach, and the
query isn't sent there.  For nearest neighbours the reach is the angle of the best one in the query's own partition, for a
join that of the threshold.  Partitions of many vectors are cut into chunks, and so are the queries that meet in one, so
that a task holds a bounded part of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.components import cut

PIVOT_BYTES = 64 << 20  # of all pivots, which every task gets
PART_ROWS = 16_384  # vectors of a chunk, and queries that meet it in one task
SLACK = 1e-6  # of angles, for rounding


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) > 0, n, np.inf)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of vectors of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivots.T, -1.0, 1.0))


def best_places(q_id: np.ndarray, q: np.ndarray, t_id: np.ndarray, t: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(place, score) of the best other target of each unit query; targets (those at the places ``at``) are sorted by id.

    Ties go to the smaller id; the score is -inf without a target.  Blocks of both sides meet, so memory is bounded.
    """
    place, score = np.zeros(len(q), dtype=np.int64), np.full(len(q), -np.inf)
    n = len(t) if at is None else len(at)
    for b in range(0, n, 4096):
        here = np.arange(b, min(b + 4096, n)) if at is None else at[b : b + 4096]
        ids, block = t_id[here], t[here].T
        for a in range(0, len(q), 512):
            s = q[a : a + 512] @ block
            own = q_id[a : a + 512]
            lo = np.searchsorted(ids, own, side="left")
            hi = np.searchsorted(ids, own, side="right")
            for i in np.flatnonzero(hi > lo):
                s[i, lo[i] : hi[i]] = -np.inf
            top = np.nan_to_num(s, copy=False, nan=-np.inf, posinf=np.inf, neginf=-np.inf).argmax(axis=1)
            best = s[np.arange(len(s)), top]
            better = np.flatnonzero(best > score[a : a + 512])
            place[a + better], score[a + better] = here[top[better]], best[better]
    return place, score


def vector_bytes(rows: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of the vectors of a table."""
    got = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("vec")).alias("s")).first()
    return got["n"], 8 * (got["s"] or 0)


def choose_pivots(rows: DataFrame, key: str, part_rows: int) -> np.ndarray:
    """Unit vectors of rows of least hash: one for each ``part_rows`` rows, as many as ``PIVOT_BYTES`` hold at most."""
    n, size = vector_bytes(rows)
    most = max(1, PIVOT_BYTES // max(8, size // max(n, 1)))
    got = rows.filter(F.exists("vec", lambda x: x != 0)).orderBy(F.xxhash64(key), key).select("vec").limit(max(1, min(most, -(-n // part_rows)))).toArrow()
    return unit(matrix(got.column("vec")))


def placed(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with the nearest pivot and the angle to it, written."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = angles(unit(matrix(batch.column("vec"))), shared.value) if len(batch) else np.zeros((0, 1))
            best = a.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.int32()), pa.array(a[np.arange(len(a)), best])], names=[*batch.schema.names, "pivot", "angle"])

    kind = ", ".join(f"{n} {k}" for n, k in rows.dtypes)
    return cut(rows.mapInArrow(run, f"{kind}, pivot int, angle double"), "placed")[0]


def partitions_of(home: DataFrame, part_rows: int) -> DataFrame:
    """(scope, pivot, radius, chunks) of the partitions of placed rows, written."""
    size = home.groupBy("scope", "pivot").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n"))
    return cut(size.select("scope", "pivot", "radius", F.ceil(F.col("n") / part_rows).cast("int").alias("chunks")), "partitions")[0]


def visits(queries: DataFrame, partitions: DataFrame, pivots: np.ndarray, nearest: bool = False) -> DataFrame:
    """``queries`` (scope, vec, reach, ...) once for each partition of their scope and chunk that may hold what is in reach.

    With ``nearest`` each goes to the first chunk of the nearest partition alone.
    """
    shared = queries.sparkSession.sparkContext.broadcast(pivots)
    listed = partitions.groupBy("scope").agg(F.sort_array(F.collect_list(F.struct("pivot", "radius", "chunks"))).alias("of"))  # one for each pivot at most
    names = queries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = unit(matrix(batch.column("vec"))) if len(batch) else np.zeros((0, 0))
            reach = batch.column("reach").to_numpy(zero_copy_only=False)
            for lo in range(0, len(batch), 256):
                a = angles(vec[lo : lo + 256], shared.value)
                row, pivot, chunk = [], [], []
                for i in range(len(a)):
                    of = batch.column("of")[lo + i].values
                    here, radius, chunks = (of.field(f).to_numpy(zero_copy_only=False) for f in ("pivot", "radius", "chunks"))
                    if nearest:
                        row.append([lo + i])
                        pivot.append(here[[a[i, here].argmin()]])
                        chunk.append([0])
                        continue
                    go = a[i, here] - radius <= reach[lo + i] + SLACK
                    n = chunks[go]
                    row.append(np.full(n.sum(), lo + i))
                    pivot.append(np.repeat(here[go], n))
                    chunk.append(np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                taken = batch.select(names).take(pa.array(np.concatenate(row).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.concatenate(pivot), pa.int32()), pa.array(np.concatenate(chunk), pa.int32())], names=[*names, "pivot", "chunk"])

    kind = ", ".join(f"{n} {k}" for n, k in queries.dtypes)
    return queries.join(listed, "scope").mapInArrow(run, f"{kind}, pivot int, chunk int")


def met(asked: DataFrame, home: DataFrame, partitions: DataFrame, key: str, meet: Callable[[pa.Table, pa.Table], pa.Table], out: str, part_rows: int) -> DataFrame:
    """``meet`` of the queries and the rows of each chunk; ``key`` deals both within it."""
    asked, _ = cut(asked, "asked")
    at = ["scope", "pivot", "chunk"]
    parts = asked.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts"))
    asked = asked.join(parts, at).withColumn("part", F.pmod(F.xxhash64(key), F.col("parts")).cast("int"))
    rows = home.join(partitions.select("scope", "pivot", "chunks"), ["scope", "pivot"]).withColumn("chunk", F.pmod(F.xxhash64(key), F.col("chunks")).cast("int"))
    rows = rows.join(parts, at).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = [*at, "part"]
    asked, rows = asked.drop("parts"), rows.drop("parts", "chunks").toDF(*[c for c in rows.columns if c not in ("parts", "chunks")])  # columns of its own
    return asked.groupBy(*both).cogroup(rows.groupBy(*both)).applyInArrow(lambda _, a, b: meet(a, b), out)


def nearest(queries: DataFrame, targets: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(id, scope, best_id, best_score): the target of largest cosine in a query's scope, itself left out (ties: smaller id).

    Tables (id, scope, vec) with vectors of one length; a query without a target in its scope has no row.
    """
    pivots = choose_pivots(targets, "id", part_rows)
    if not len(pivots):
        pivots = np.zeros((1, 1))
    home = placed(targets, pivots)
    partitions = partitions_of(home, part_rows)
    kind = dict(targets.dtypes)["scope"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, scopes, best, scores = [], [], [], []
        if len(left) and len(right):
            right = right.sort_by("id")
            own, t_id, t = left.column("id").to_numpy(), right.column("id").to_numpy(), unit(matrix(right.column("vec")))
            q = unit(matrix(left.column("vec")))
            at, top = best_places(own, q, t_id, t)
            ok = np.flatnonzero(np.isfinite(top))
            ids, best, scores = own[ok], t_id[at[ok]], top[ok]
            scopes = left.column("scope").take(pa.array(ok)).to_pylist()
        scope = left.schema.field("scope").type if len(left) else right.schema.field("scope").type
        return pa.table({"id": pa.array(ids, pa.int64()), "scope": pa.array(scopes, scope), "best_id": pa.array(best, pa.int64()), "best_score": pa.array(scores, pa.float64())})

    out = f"id long, scope {kind}, best_id long, best_score double"
    wide = queries.select("id", "scope", "vec").withColumn("reach", F.lit(float(np.pi)))
    first, _ = cut(met(visits(wide, partitions, pivots, nearest=True), home, partitions, "id", meet, out, part_rows), "first")
    floor = first.select("id", "scope", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("best_score")))).alias("angle"))
    near = wide.drop("reach").join(floor, ["id", "scope"], "left").select("id", "scope", "vec", F.coalesce("angle", F.lit(float(np.pi))).alias("reach"))
    every = first.unionByName(met(visits(near, partitions, pivots), home, partitions, "id", meet, out, part_rows))
    best = F.max(F.struct("best_score", (-F.col("best_id")).alias("neg"))).alias("b")
    return every.groupBy("id", "scope").agg(best).select("id", "scope", (-F.col("b.neg")).alias("best_id"), F.col("b.best_score").alias("best_score"))


def similar(rows: DataFrame, threshold: float, part_rows: int = PART_ROWS) -> DataFrame:
    """(left, right, score) with left < right of the terms (term, vec) whose cosine reaches ``threshold``."""
    pivots = choose_pivots(rows, "term", part_rows)
    if not len(pivots):
        return rows.select(F.col("term").alias("left"), F.col("term").alias("right"), F.lit(0.0).alias("score")).limit(0)
    home = placed(rows.select("term", "vec").withColumn("scope", F.lit(0)), pivots)
    partitions = partitions_of(home, part_rows)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[str, str, float]] = []
        if len(left) and len(right):
            a, b = (np.array(t.column("term").to_pylist(), dtype=object) for t in (left, right))
            x, y = unit(matrix(left.column("vec"))), unit(matrix(right.column("vec")))
            for lo in range(0, len(a), 256):
                s = x[lo : lo + 256] @ y.T
                i, j = np.nonzero(s >= threshold - 1e-9)
                keep = a[lo + i] < b[j]
                found += zip(a[lo + i][keep], b[j][keep], s[i, j][keep].tolist())
        return pa.table({n: pa.array([f[k] for f in found], t) for k, (n, t) in enumerate((("left", pa.string()), ("right", pa.string()), ("score", pa.float64())))})

    asked = visits(home.select("term", "scope", "vec", F.lit(float(np.arccos(min(1.0, max(-1.0, threshold - 1e-9))))).alias("reach")), partitions, pivots)
    return met(asked, home, partitions, "term", meet, "left string, right string, score double", part_rows)
