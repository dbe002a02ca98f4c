"""Set-similarity self-join on character grams, and dense nearest neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import scores as S
from lexmill.functions import text as T
from lexmill.operators import vectors
from lexmill.operators.components import cut


def gram_rows(terms: DataFrame, n: int = 3) -> DataFrame:
    """[CJ-05] (term, size, gram) of the distinct terms, with how many terms hold the gram (df)."""
    base = terms.select("term").filter("term is not null").distinct().withColumn("grams", T.char_ngrams(T.normalize(F.col("term")), n))
    rows = base.select("term", F.size("grams").alias("size"), F.explode("grams").alias("gram"))
    return rows.join(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("df")), "gram")


def _prefixes(rows: DataFrame, threshold: float) -> DataFrame:
    """Rarest grams of each term: those beyond need not be indexed, since pairs over the threshold share one of these."""
    need = F.ceil(F.lit(threshold * threshold) * F.col("size") - 1e-9)
    ordered = rows.groupBy("term", "size").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("g"))
    return ordered.select("term", "size", F.explode(F.slice("g", 1, (F.col("size") - need + 1).cast("int"))).alias("s")).select("term", "size", "s.gram")


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float, n: int = 3) -> DataFrame:
    """[SM-01, SM-04, SM-05] (a, b, score) of terms of two tables whose gram cosine is at least ``threshold``.

    Cosine t needs an overlap of t * sqrt(a * b) >= t * t * a and sizes within t * t of each other, so candidates come
    from the rarest grams alone and the exact overlap is counted on the gram sets of candidates.
    """
    both = gram_rows(left.select("term").unionByName(right.select("term")), n)
    prefix = _prefixes(both, threshold)
    l = prefix.join(left.select("term").distinct(), "term", "left_semi").select(F.col("term").alias("a"), F.col("size").alias("na"), "gram")
    r = prefix.join(right.select("term").distinct(), "term", "left_semi").select(F.col("term").alias("b"), F.col("size").alias("nb"), "gram")
    t2 = threshold * threshold
    pairs = l.join(r, "gram").filter((F.col("na") >= t2 * F.col("nb") - 1e-9) & (F.col("nb") >= t2 * F.col("na") - 1e-9)).select("a", "b", "na", "nb").distinct()
    grams = lambda name, out: F.array_distinct(T.char_ngrams(T.normalize(F.col(name)), n)).alias(out)
    overlap = pairs.select("a", "b", "na", "nb", F.size(F.array_intersect(grams("a", "x"), grams("b", "y"))).alias("shared"))
    score = F.col("shared") / (F.sqrt("na") * F.sqrt("nb"))
    return overlap.withColumn("score", score).filter(F.col("score") >= threshold).select("a", "b", "score")


def trigram_edges(terms: DataFrame, threshold: float = 0.85, high: float = 0.93) -> DataFrame:
    """[JN-08, FN-26, PD-12] (left, right, score rounded to 6, band) with left < right; threshold and band use the exact score."""
    pairs = similar_pairs(terms, terms, threshold).filter("a < b")
    return pairs.select(F.col("a").alias("left"), F.col("b").alias("right"), F.round("score", 6).alias("score"), S.band(F.col("score"), high).alias("band"))


def alias_advisories(terms: DataFrame, threshold: float = 0.85, high: float = 0.93) -> DataFrame:
    """[JN-09] (grp, source_canonical, alias, target_canonical, score, band): aliases like a canonical other than their own."""
    names = terms.select(F.col("canonical").alias("term")).distinct()
    al = terms.filter("alias is not null").select("grp", F.col("canonical").alias("source_canonical"), "alias").distinct()
    pairs = similar_pairs(al.select(F.col("alias").alias("term")), names, threshold)
    rows = al.join(pairs, al["alias"] == pairs["a"]).filter(F.col("b") != F.col("source_canonical"))
    return rows.select("grp", "source_canonical", "alias", F.col("b").alias("target_canonical"), F.round("score", 6).alias("score"), S.band(F.col("score"), high).alias("band"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def cosine(a: Column, b: Column) -> Column:
    """[SM-02, SM-03] 0 for empty, zero or unequally long vectors."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) != F.size(b)) | (F.size(a) == 0) | (norms == 0), 0.0).otherwise(dot(a, b) / norms)


def _nearest_rows(q_id, q, q_grp, t_id, t, t_grp) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(best place, best score, best place in the group, score in the group) of unit queries against unit targets sorted by id.

    Groups are numbers; a query whose group is negative has none.  Scores without a target are -inf.  Targets come in
    blocks, so what is held is bounded whatever their number.
    """

    best, score = vectors.best_places(q_id, q, t_id, t)
    own, own_score = np.zeros(len(q_id), dtype=np.int64), np.full(len(q_id), -np.inf)
    for g in np.unique(q_grp[q_grp >= 0]):
        rows = np.flatnonzero(q_grp == g)
        at = np.flatnonzero(t_grp == g)
        if len(at):
            own[rows], own_score[rows] = vectors.best_places(q_id[rows], q[rows], t_id, t, at)
    return best, score, own, own_score


def _columns(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    grp = table.column("grp")
    return table.column("id").to_numpy(), vectors.unit(vectors.matrix(table.column("vec"))), grp.combine_chunks() if isinstance(grp, pa.ChunkedArray) else grp


BROADCAST_BYTES = 64 << 20  # of vectors that every task gets


def dense_nearest(queries: DataFrame, targets: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, part_rows: int = vectors.PART_ROWS) -> DataFrame:
    """[JN-11, SM-09, SM-10] Best target of each query, in all and within its group (ties: smaller id).

    Tables (id, vec, grp) with vectors of one length.  Similarities are matrix products: the taxonomy side is broadcast
    up to ``broadcast_bytes``; a larger one is searched in partitions around pivots (``vectors.nearest``), once over all
    and once over the groups.
    """
    kind = queries.schema["grp"].dataType.simpleString()
    out = f"id long, grp {kind}, best_id long, best_score double, best_in_group long, in_group_score double"
    names = [c.split()[0] for c in out.split(", ")]
    q, t = (d.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"), "grp") for d in (queries, targets))
    if vectors.vector_bytes(t)[1] > broadcast_bytes:
        top = vectors.nearest(*(d.select("id", F.lit(0).alias("scope"), "vec") for d in (q, t)), part_rows).drop("scope")
        own = vectors.nearest(*(d.filter("grp is not null").select("id", F.col("grp").alias("scope"), "vec") for d in (q, t)), part_rows)
        own = own.select("id", F.col("scope").alias("grp"), F.col("best_id").alias("best_in_group"), F.col("best_score").alias("in_group_score"))
        return q.select("id", "grp").distinct().join(top, "id", "left").join(own, ["id", "grp"], "left").select(*names)

    t_id, t_vec, t_grp = _columns(t.orderBy("id").toArrow())
    groups = pc.unique(t_grp.drop_null())
    known = queries.sparkSession.sparkContext.broadcast((t_id, t_vec, pc.index_in(t_grp, groups).fill_null(-1).to_numpy(), groups))  # at most broadcast_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t_id, t_vec, t_grp, groups = known.value
        for batch in batches:
            if not len(batch) or not len(t_id):
                continue
            q_id, q_vec, q_grp = _columns(batch)
            best, score, own, own_score = _nearest_rows(q_id, q_vec, pc.index_in(q_grp, groups).fill_null(-1).to_numpy(), t_id, t_vec, t_grp)
            none, alone = score == -np.inf, own_score == -np.inf
            yield pa.RecordBatch.from_arrays([batch.column(0), q_grp, pa.array(t_id[best], mask=none), pa.array(score, mask=none), pa.array(t_id[own], mask=alone), pa.array(own_score, mask=alone)], names=names)

    return q.mapInArrow(run, out)


def dense_edges(terms: DataFrame, embedded: DataFrame, threshold: float = 0.85, high: float = 0.93, broadcast_bytes: int = BROADCAST_BYTES, part_rows: int = vectors.PART_ROWS) -> DataFrame:
    """[SM-04, JN-08] (left, right, score, band): pairs of terms that share a trigram, by the cosine of their vectors (term, vec).

    Pairs over the threshold come from matrix products, and only those are looked at for a common trigram, so that no
    frequent trigram pairs its terms.  Up to ``broadcast_bytes`` of vectors are broadcast; beyond that terms meet in
    partitions around pivots (``vectors.similar``).
    """
    names = terms.select("term").filter("term is not null").distinct().join(embedded.select("term", F.col("vec").cast("array<double>").alias("vec")), "term").dropDuplicates(["term"])
    names, _ = cut(names.select("term", "vec"), "embedded")
    if vectors.vector_bytes(names)[1] > broadcast_bytes:
        found = vectors.similar(names, threshold, part_rows)
    else:
        known = terms.sparkSession.sparkContext.broadcast(_named(names.orderBy("term").toArrow()))  # at most broadcast_bytes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            b, y = known.value
            for batch in batches:
                a, x = _named(batch)
                got: list[tuple] = []
                for lo in range(0, len(a), 256):
                    score = x[lo : lo + 256] @ y.T if len(b) else np.zeros((len(a[lo : lo + 256]), 0))
                    i, j = np.nonzero(score >= threshold - 1e-9)
                    keep = a[lo + i] < b[j]
                    got += zip(a[lo + i][keep], b[j][keep], score[i, j][keep].tolist())
                cols = list(zip(*got)) if got else [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64())], names=["left", "right", "score"])

        found = names.mapInArrow(run, "left string, right string, score double")
    grams = lambda c: T.char_ngrams(T.normalize(F.col(c)))
    found = found.filter(F.arrays_overlap(grams("left"), grams("right")))
    return found.select("left", "right", F.round("score", 6).alias("score"), S.band(F.col("score"), high).alias("band"))


def _named(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.array(table.column("term").to_pylist(), dtype=object), vectors.unit(vectors.matrix(table.column("vec")))


def alias_verdicts(nearest: DataFrame, threshold: float = 0.85) -> DataFrame:
    """[SM-10] (id, is_alias, alias_of) of ``dense_nearest``: the best target of all at the threshold, else the best of the group."""
    best = F.when(F.col("best_score") >= threshold, F.col("best_id")).when(F.col("in_group_score") >= threshold, F.col("best_in_group"))
    return nearest.select("id", best.isNotNull().alias("is_alias"), best.alias("alias_of"))
