"""Language identification with blended-spectrum presence kernels.

A text is the set of byte n-grams (n = 2, 3, 4, A-Z lower-cased) that occur in it, each hashed to one of ``DIMS`` bits.
The kernel of two texts is the number of shared bits over the root of the product of their bit counts.  Nystrom features
come from ``landmarks`` texts, and one-versus-rest kernel ridge regression is fitted on those of all labelled texts: its
normal equations are sums over texts, which tasks add up, so that no text is left out and none is collected.  The kernel is linear in the bits, so landmarks, whitening and ridge weights collapse into one DIMS x languages
matrix, and a batch is scored with one matrix product.  Longer texts fill the bits and sink under the root of their count,
so a text is cut into even segments of at most ``SEGMENT`` bytes, and its scores are the means over all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm import text as tx
from lexmill.llm.scratch import widened

DIMS = 1 << 13
LETTER = regex.compile(r"\p{L}")
SEGMENT = 1 << 13
ROWS = 256
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mark(raw: np.ndarray, bits: np.ndarray) -> None:
    """Set the bits of the n-grams of ``raw``, the bytes of one segment."""
    part = LOWER[raw].astype(np.uint32)
    for n in (2, 3, 4):
        if len(part) < n:
            break
        gram = part[:-1] | (part[1:] << np.uint32(8)) if n == 2 else gram[: len(part) - n + 1] | (part[n - 1 :] << np.uint32(8 * (n - 1)))
        with np.errstate(over="ignore"):
            bits[(gram * np.uint32(2654435761) + np.uint32(n * 0x51ED27)) * np.uint32(2246822519) >> np.uint32(32 - 13)] = 1


def segments(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, edges) of the segments of all rows, in order; an empty row is one empty segment."""
    size = np.diff(offsets)
    number = np.maximum(1, -(-size // SEGMENT))
    row = np.repeat(np.arange(len(size)), number)
    k = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    at = offsets[:-1][row] + size[row] * k // number[row]
    return row, np.append(at, offsets[-1])


def presence(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, 0/1 matrix) of blocks of segments; long rows go on in the next block."""
    raw, offsets = tx.string_buffer(column)
    row, edges = segments(offsets)
    bits = np.zeros((min(ROWS, len(row)), DIMS), dtype=np.float32)
    for lo in range(0, len(row), ROWS):
        hi = min(lo + ROWS, len(row))
        bits[:] = 0
        for i in range(lo, hi):
            mark(raw[edges[i] : edges[i + 1]], bits[i - lo])
        yield row[lo:hi], bits[: hi - lo]


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # DIMS x languages
    bias: np.ndarray

    def scores(self, bits: np.ndarray) -> np.ndarray:
        root = np.sqrt(np.maximum(bits.sum(axis=1, keepdims=True), 1))
        return (bits @ self.weights) / root + self.bias


def unit(bits: np.ndarray) -> np.ndarray:
    return bits / np.sqrt(np.maximum(bits.sum(axis=1, keepdims=True), 1), dtype=np.float32)


@dataclass
class Basis:
    """Nystrom features: kernels with the landmarks, whitened."""

    near: np.ndarray  # landmarks x DIMS
    white: np.ndarray  # landmarks x features

    def features(self, bits: np.ndarray) -> np.ndarray:
        return (unit(bits) @ self.near.T).astype(np.float64) @ self.white


def basis(packed: np.ndarray) -> Basis:
    """``packed``: the bits of the landmarks, eight a byte."""
    near = unit(np.unpackbits(packed, axis=1).astype(np.float32))
    value, vector = np.linalg.eigh((near @ near.T).astype(np.float64))
    keep = value > 1e-6 * max(value.max(), 1e-12)
    return Basis(near, vector[:, keep] / np.sqrt(value[keep]))


class Sums:
    """Sums over texts of their features' products (gram), and of their number and features by language."""

    def __init__(self, width: int):
        self.gram = np.zeros((width, width))
        self.of: dict[str, tuple[int, np.ndarray]] = {}

    def add(self, features: np.ndarray, labels: list[str]) -> None:
        self.gram += features.T @ features
        names, place = np.unique(np.array(labels, dtype=object), return_inverse=True)
        for k, name in enumerate(names):
            own = features[place == k]
            n, total = self.of.get(name, (0, 0.0))
            self.of[name] = (n + len(own), total + own.sum(axis=0))


def solved(base: Basis, sums: Sums, ridge: float) -> LanguageModel:
    """One-versus-rest ridge regression of +1 and -1 on the centred features."""
    languages = sorted(sums.of)
    count = np.array([sums.of[k][0] for k in languages], dtype=np.float64)
    by_language = np.array([sums.of[k][1] for k in languages])
    n = count.sum()
    mean_x, mean_y = by_language.sum(axis=0) / n, 2 * count / n - 1
    left = sums.gram - n * np.outer(mean_x, mean_x) + ridge * n * np.eye(len(mean_x))
    beta = np.linalg.solve(left, 2 * (by_language - count[:, None] * mean_x).T)
    return LanguageModel(languages, (base.near.T @ (base.white @ beta).astype(np.float32)), (mean_y - mean_x @ beta).astype(np.float32))


def fit(packed: np.ndarray, labels: list[str], landmarks: int = 256, ridge: float = 1e-3) -> LanguageModel:
    """One-versus-rest kernel ridge regression on Nystrom features.  ``packed``: the bits of each text, eight a byte."""
    base = basis(packed[:landmarks])
    sums = Sums(base.white.shape[1])
    for lo in range(0, len(packed), ROWS):
        sums.add(base.features(np.unpackbits(packed[lo : lo + ROWS], axis=1).astype(np.float32)), labels[lo : lo + ROWS])
    return solved(base, sums, ridge)


def _fold(key: Column, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(folds))


def _labelled(documents: DataFrame, part: Column) -> DataFrame:
    """The labelled rows of ``part`` that have a text."""
    return documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & part)


def _sample(usable: DataFrame, sample_rows: int) -> DataFrame:
    """text and lang of the rows with the ``sample_rows`` doc_ids of least hash."""
    picked = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    return usable.join(F.broadcast(picked), usable["doc_id"].eqNullSafe(picked["doc_id"]), "left_semi").select("text", "lang")  # at most sample_rows ids


def train(documents: DataFrame, folds: int = 4, held: int = 2, sample_rows: int = 2500, landmarks: int = 256) -> LanguageModel | None:
    """Fit on all labelled documents outside the held-out fold, by their segments.

    Landmarks alone come from few rows: the segments of least hash among the ``sample_rows`` least hashed doc_ids.  Only
    text and lang are used; doc_id picks landmarks alone.  None if no document has a label and text.
    """
    usable = _labelled(documents, _fold(F.col("doc_id"), folds) != held)

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, bits in presence(batch.column(0)):
                packed = [p.tobytes() for p in np.packbits(bits.astype(bool), axis=1)]
                yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(row)), pa.array(packed, pa.binary())], names=["lang", "bits"])

    got = _sample(usable, sample_rows).mapInArrow(bits_of, "lang string, bits binary").orderBy(F.xxhash64("bits", "lang"), "bits", "lang").limit(landmarks).toPandas()
    if not len(got):
        return None
    base = basis(np.frombuffer(b"".join(got["bits"]), dtype=np.uint8).reshape(len(got), -1))
    width = base.white.shape[1]
    shared = documents.sparkSession.sparkContext.broadcast(base)  # landmarks x DIMS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(width)
        for batch in batches:
            if len(batch):
                names = batch.column(1).to_pylist()
                for row, bits in presence(batch.column(0)):
                    sums.add(shared.value.features(bits), [names[i] for i in row])
        rows = [(None, i, 0, x.tobytes()) for i, x in enumerate(sums.gram)] if sums.of else []
        rows += [(name, -1, n, x.tobytes()) for name, (n, x) in sums.of.items()]
        cols = zip(*rows) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.binary()))], names=["lang", "i", "n", "sums"])

    def total(table: pa.Table) -> pa.Table:
        both = np.zeros(width)
        for x in table.column("sums"):
            both += np.frombuffer(x.as_buffer())
        return pa.table({"lang": table.column("lang")[:1], "i": table.column("i")[:1], "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()), "sums": pa.array([both.tobytes()], pa.binary())})

    kind = "lang string, i int, n long, sums binary"
    sums = Sums(width)
    for r in usable.select("text", "lang").mapInArrow(tx.returning(add), kind).groupBy("lang", "i").applyInArrow(total, kind).toLocalIterator():  # a row a feature and language
        if r["lang"] is None:
            sums.gram[r["i"]] = np.frombuffer(r["sums"])
        else:
            sums.of[r["lang"]] = (r["n"], np.frombuffer(r["sums"]))
    return solved(base, sums, 1e-3)


def predict(documents: DataFrame, model: LanguageModel | None, carry: bool = False) -> DataFrame:
    """doc_id (or, with ``carry``, all columns), lang_pred and score of every row.

    ``und`` with score 0 where text is null, has no letter, or no model could be fitted.  Predictions read the text
    alone.  Ties go to the language first in order.  Existing columns of these names are replaced.
    """
    base = documents.drop("lang_pred", "score") if carry else documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index("text"))
            filled = column.fill_null("")
            if not len(batch):
                continue
            letters = np.array([model is not None and LETTER.search(t.as_py()) is not None for t in filled])
            if model is not None:
                total = np.zeros((len(batch), len(model.languages)))
                number = np.zeros(len(batch))
                for row, bits in presence(filled):
                    np.add.at(total, row, model.scores(bits))
                    np.add.at(number, row, 1)
                s = total / number[:, None]
                names = [model.languages[b] if ok else "und" for b, ok in zip(s.argmax(axis=1), letters)]
                score = np.where(letters, np.clip((s.max(axis=1) + 1) / 2, 0, 1), 0.0)
            else:
                names, score = ["und"] * len(batch), np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score.astype(np.float64))], names=[*batch.schema.names, "lang_pred", "score"])

    out = base.mapInArrow(tx.returning(run), widened(base.schema, ("lang_pred", "string"), ("score", "double")))
    return out if carry else out.select("doc_id", "lang_pred", "score")


def least_score(documents: DataFrame, model: LanguageModel | None, folds: int = 4, held: int = 2, share: float = 0.005) -> float:
    """The score that all but ``share`` of the labelled rows of the held-out fold reach, of those whose language is found.

    All such rows count; the quantile is right to 1 in 100,000 of their ranks.

    The one-versus-rest scores of a text sum to 2 - L over L languages, so its ``score`` is 1/L at least and a fixed
    limit may reject nothing.  Texts in no learned language stay near 1/L.  0 where no labelled row is held out.
    """
    judged = predict(_labelled(documents, _fold(F.col("doc_id"), folds) == held).select("text", "lang"), model, carry=True).filter("lang_pred = lang")
    found = judged.agg(F.percentile_approx("score", share, 100_000).alias("least")).first()["least"]
    return 0.0 if found is None else float(found)


def identify(documents: DataFrame, folds: int = 4, held: int = 2, sample_rows: int = 2500, landmarks: int = 256) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row (columns doc_id, text, lang; others play no part)."""
    documents = documents.select("doc_id", "text", "lang")
    out = predict(documents.select("doc_id", "text"), train(documents, folds, held, sample_rows, landmarks))
    return out.select("doc_id", (_fold(F.col("doc_id"), folds) == held).alias("held_out"), "lang_pred", "score")
