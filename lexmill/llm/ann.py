"""Nearest neighbours by inner product: inverted lists scanned by adaptive dimension blocks.

Vectors are dealt into lists by k-means centroids of a bounded sample; every vector is indexed, and long lists are
split into parts of bounded size.  A query probes the lists whose centroids have the largest inner product with it, so
many that the neighbours of sampled vectors within the sample are covered to ``target``.

A first pass scans the lists nearest to each query and gives its floor, the worst of its best ``k`` scores so far.  The
second pass starts every other part with that floor.  Vectors and queries are rotated by one random orthogonal matrix, so
the partial product over the first a of d dimensions of a pair with product s has the mean ``a / d * s`` and the variance

    a * (d - a) / (d * (d - 1) * (d + 2)) * (|q|^2 |x|^2 + (1 - 2 / d) * s^2).

After each block of dimensions the hypothesis that a candidate reaches the floor is tested, and the candidate is abandoned
where its partial product is more than ``confidence`` deviations below what a pair at the floor would have.  Survivors
are scored exactly on the original vectors.

A task reads the vectors of one part, which are bounded, and then streams the queries of one block of queries past them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.scratch import discard, materialise

BLOCK = 16
ROWS = 512
QUERIES = 128


def kmeans(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].astype(np.float64)
    for _ in range(rounds):
        own = nearest_centre(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return np.unique(centres, axis=0)


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres * centres).sum(axis=1)
    return np.concatenate([np.argmax(rows[i : i + 4096] @ centres.T - half, axis=1) for i in range(0, len(rows), 4096)]) if len(rows) else np.zeros(0, dtype=np.int64)


def rotation(dims: int, seed: int = 9) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int, target: float, queries: int = 256) -> int:
    """Number of lists whose vectors hold ``target`` of the ``k`` best of sampled queries within the sample."""
    if len(sample) <= k + 1 or len(centres) <= 1:
        return len(centres)
    own = nearest_centre(sample, centres)
    at = np.linspace(0, len(sample) - 1, min(queries, len(sample))).astype(np.int64)
    score = sample[at] @ sample.T
    score[np.arange(len(at)), at] = -np.inf
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    order = np.argsort(-(sample[at] @ centres.T), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centres))[None, :], axis=1)
    found = np.sort(np.take_along_axis(place, own[best], axis=1).ravel())
    return int(found[min(len(found) - 1, int(np.ceil(target * len(found))) - 1)]) + 1


class Part:
    """Vectors of one part, rotated.  ``pairs`` counts pairs, ``dims`` dimensions summed, ``early`` pairs abandoned before the last block."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, k: int, turn: np.ndarray, confidence: float):
        self.rows, self.ids, self.k, self.turn, self.confidence = rows, ids, k, turn, confidence
        self.x = (rows @ turn).astype(np.float32)
        self.norm = np.sqrt((rows * rows).sum(axis=1))
        self.pairs = self.dims = self.early = 0

    def scan(self, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries, ids and exact scores of the best ``k`` of each query that reach its floor."""
        turned = (queries @ self.turn).astype(np.float32)
        norm = np.sqrt((queries * queries).sum(axis=1))
        floor = floor.copy()
        best = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        for lo in range(0, len(self.rows), ROWS):
            qi, xi, score = self._reaching(queries, query_ids, turned, norm, floor, lo)
            best = tuple(np.concatenate(pair) for pair in zip(best, (qi, self.ids[xi], score)))
            order = np.lexsort((best[1], -best[2], best[0]))
            best = tuple(b[order] for b in best)
            first = np.searchsorted(best[0], best[0])
            rank = np.arange(len(first)) - first
            best = tuple(b[rank < self.k] for b in best)
            last = np.flatnonzero(rank[rank < self.k] == self.k - 1)
            floor[best[0][last]] = np.maximum(floor[best[0][last]], best[2][last])
        return best

    def _reaching(self, queries, query_ids, turned, norm, floor, lo):
        d = queries.shape[1]
        x, size = self.x[lo : lo + ROWS], self.norm[lo : lo + ROWS]
        alive = query_ids[:, None] != self.ids[None, lo : lo + ROWS]
        self.pairs += int(alive.sum())
        cuts = [*range(BLOCK, d, BLOCK), d]
        tested = np.isfinite(floor)
        if tested.any() and len(cuts) > 1:
            partial = turned[:, : cuts[0]] @ x[:, : cuts[0]].T
            scale = norm[:, None] ** 2 * size[None, :] ** 2 + (1 - 2 / d) * np.where(tested, floor, 0)[:, None] ** 2
            deviation = np.sqrt(scale, out=scale).astype(np.float32)
            self.dims += int(alive.sum()) * cuts[0]
            for a, b in zip(cuts, cuts[1:]):
                spread = self.confidence * np.sqrt(a * (d - a) / (d * (d - 1) * (d + 2)))
                alive &= ~(partial < (a / d * floor)[:, None] - spread * deviation)
                if b == d:
                    break
                qi, xi = np.nonzero(alive)
                self.dims += len(qi) * (b - a)
                if 2 * len(qi) > alive.size:
                    partial += turned[:, a:b] @ x[:, a:b].T
                else:
                    partial[qi, xi] += np.einsum("ij,ij->i", turned[qi, a:b], x[xi, a:b])
        self.dims += int(alive.sum()) * (d - cuts[-2] if len(cuts) > 1 else d)
        qi, xi = np.nonzero(alive)
        self.early += int((query_ids[:, None] != self.ids[None, lo : lo + ROWS]).sum()) - len(qi)
        if 4 * len(qi) > alive.size:  # too many for single products: only those near the best k of this step
            rough = np.where(alive, queries @ self.rows[lo : lo + ROWS].T, -np.inf)
            least = floor if rough.shape[1] <= self.k else np.maximum(floor, -np.partition(-rough, self.k - 1, axis=1)[:, self.k - 1])
            qi, xi = np.nonzero(alive & (rough >= (least - 1e-9 * norm * size.max())[:, None]))
        score = (queries[qi] * self.rows[lo + xi]).sum(axis=1)  # the same sum for equal pairs, whatever the step
        reach = score >= floor[qi]
        return qi[reach], lo + xi[reach], score[reach]


def search(
    embeddings: DataFrame,
    every: int = 20,
    k: int = 20,
    sample_rows: int = 20_000,
    most_lists: int = 4096,
    target: float = 0.96,
    part_rows: int = 4096,
    block_queries: int = 1 << 18,
    confidence: float = 2.0,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` largest inner products found for each query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows with another vec_id.  Rows
    whose vector is null, zero, of another length than most, or holds null or non-finite components, and rows with a null
    vec_id, take no part.  Ties go to the smaller vec_id; repeated rows are candidates of their own; of several vectors
    under one query id the least is the query.  Columns other than vec_id and embedding play no part.  An empty table
    gives an empty table.  Centroids and the number of lists to probe come from at most ``sample_rows`` rows, those of
    least hashed vec_id; a query probes always so many lists that ``k`` candidates are at hand if the table has them.
    """
    spark = embeddings.sparkSession
    v = F.col("embedding")
    sound = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    common = sound.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, total = int(common["n"]), int(common["count"])
    sound = sound.filter(F.size("v") == dims)
    picked = sound.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample_rows).toPandas()  # at most sample_rows rows
    sample = np.array(picked["v"].tolist(), dtype=np.float64)
    centres = kmeans(sample, int(max(1, min(most_lists, round(total**0.5)))))
    needed = probes_needed(sample, centres, max(1, round(k * len(sample) / total)), target)
    turn = rotation(dims)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = nearest_centre(_matrix(batch.column(1), dims), centres)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=["vec_id", "v", "list"])

    dealt = materialise(sound.mapInArrow(deal, "vec_id long, v array<double>, list int"), "lists")
    sizes = np.zeros(len(centres), dtype=np.int64)
    for r in dealt.groupBy("list").count().collect():  # at most most_lists rows
        sizes[r["list"]] = r["count"]
    parts = np.maximum(1, -(-sizes // part_rows))
    asked = dealt.filter(F.pmod(F.col("vec_id"), F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // block_queries))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                block = batch.slice(lo, 256)
                order = np.argsort(-(_matrix(block.column(1), dims) @ centres.T), axis=1, kind="stable")
                held = np.cumsum(sizes[order], axis=1)
                enough = (held < k + 2).sum(axis=1) + 1
                take = np.minimum(np.maximum(enough, needed), len(centres))
                near = np.minimum(np.maximum((held < 4 * k).sum(axis=1) + 1, -(-needed // 16)), take)
                lists = lambda first, last: pa.array([o[a:b][sizes[o[a:b]] > 0].astype(np.int32) for o, a, b in zip(order, first, last)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), lists(0 * near, near), lists(near, take)], names=["id", "v", "near", "far"])

    asked = materialise(asked.mapInArrow(probe, "id long, v array<double>, near array<int>, far array<int>"), "queries")
    part_of = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("list") + 1) if parts.max() > 1 else F.lit(1)
    block_of = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    row_part = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), part_of).cast("int")
    rows = materialise(dealt.select("list", row_part.alias("part"), F.lit(False).alias("asks"), F.col("vec_id").alias("id"), "v", F.lit(None).cast("double").alias("floor")), "parts")
    discard(dealt)
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, held = None, None, []
        for batch in batches:
            names = batch.schema.names
            col = {n: batch.column(names.index(n)) for n in names}
            at = np.stack([col[n].to_numpy(zero_copy_only=False) for n in ("list", "part", "block", "asks")], axis=1)
            ids = col["id"].to_numpy()
            edges = np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1, [len(at)]]) if len(at) else np.zeros(1, dtype=np.int64)
            for a, b in zip(edges[:-1], edges[1:]):
                if tuple(at[a, :3]) != key:
                    key, part, held = tuple(at[a, :3]), None, []
                if not at[a, 3]:
                    held.append((_matrix(col["v"].slice(a, b - a), dims), ids[a:b]))
                    continue
                if part is None and held:
                    part = Part(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), k, turn, confidence)
                for lo in range(a, b, QUERIES) if part is not None else ():
                    hi = min(b, lo + QUERIES)
                    floor = col["floor"].slice(lo, hi - lo).fill_null(float("-inf")).to_numpy()
                    qi, found, score = part.scan(_matrix(col["v"].slice(lo, hi - lo), dims), ids[lo:hi], floor)
                    if len(qi):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi][qi]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])

    def scanned(queries: DataFrame, lists: str) -> DataFrame:
        each = queries.select("id", "v", "floor", F.explode(lists).alias("list"))
        each = each.select("list", F.explode(F.sequence(F.lit(0), part_of - 1)).alias("part"), F.lit(True).alias("asks"), "id", "v", "floor", block_of.alias("block"))
        both = rows.unionByName(each).repartition("list", "part", "block").sortWithinPartitions("list", "part", "block", "asks", "id")
        return both.mapInArrow(scan, "query_id long, vec_id long, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    near = materialise(ranked(scanned(asked.withColumn("floor", F.lit(None).cast("double")), "near")), "near")
    floors = near.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    far = scanned(asked.join(floors, "id", "left"), "far")
    return ranked(near.drop("rank").unionByName(far)).select("query_id", "rank", "vec_id", "score")
