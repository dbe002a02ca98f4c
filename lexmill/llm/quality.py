"""Quality rules: base counts, and logistic regression on hashed word and character n-grams.

Features of a text are the relative frequencies of its hashed words, word pairs, and byte 3- and 4-grams.  The model is
trained on a bounded sample of labelled rows, its probabilities are calibrated on a part of the sample that training
didn't see, and texts are scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import text as tx
from lexmill.llm.scratch import discard, materialise, widened

_U = np.uint64
BITS = 16
TRAIN_FEATURES = 1 << 25  # of all training texts, 8 bytes each on the driver
FAMILIES = 4  # words, word pairs, byte 3-grams, byte 4-grams
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
LEAD = np.array([(b & 0xC0) != 0x80 for b in range(256)])
WORD_CHAR = LEAD & ~tx.SPACE


def _sums(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, kind=np.int64) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=kind)
    np.cumsum(values, out=total[1:], dtype=kind)
    return total[np.maximum(hi, lo)] - total[lo]


def base_counts(raw: np.ndarray, offsets: np.ndarray, words: tx.Words) -> dict[str, np.ndarray]:
    """The five counts of each row of a block."""
    n = len(offsets) - 1
    n_words = np.diff(words.ptr)
    starts, hashes = tx.window_hashes(words.hashes, words.ptr, 5)
    cover = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    if len(starts):
        row = np.searchsorted(words.ptr, starts, side="right") - 1
        own = tx.mix(hashes + tx.mix(row.astype(_U) + _U(1)))
        ordered = np.sort(own)
        twice = tx.distinct(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
            again = starts[twice[at] == own]
            np.add.at(cover, again, 1)
            np.add.at(cover, again + 5, -1)
    data = raw.tobytes()
    dup = np.zeros(n, dtype=np.int64)
    for i in range(n):
        seen: set[bytes] = set()
        lines = data[offsets[i] : offsets[i + 1]].split(b"\n")
        if len(lines) > 1:
            for line in lines:
                if line in seen:
                    dup[i] += 1
                elif line.strip():
                    seen.add(line)
    return {
        "n_words": n_words,
        "word_chars": _sums(WORD_CHAR[raw], offsets[:-1], offsets[1:]),
        "n_symbols": _sums(SYMBOL[raw], offsets[:-1], offsets[1:]),
        "n_dup_lines": dup,
        "n_repeat_words": _sums(np.cumsum(cover)[:-1] > 0, words.ptr[:-1], words.ptr[1:]),
    }


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def grams(raw: np.ndarray, offsets: np.ndarray, words: tx.Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each family the hashed features of a block and the span of each row in them."""
    shift = _U(64 - BITS)
    h = words.hashes
    yield (h >> shift).astype(np.int64), words.ptr[:-1], words.ptr[1:]
    with np.errstate(over="ignore"):
        pair = tx.mix(h[:-1] * _U(3) + h[1:]) if len(h) > 1 else h[:0]
    yield (pair >> shift).astype(np.int64), words.ptr[:-1], np.maximum(words.ptr[:-1], words.ptr[1:] - 1)
    byte = raw.astype(np.uint32)
    for n in (3, 4):
        if len(byte) < n:
            yield np.zeros(0, dtype=np.int64), offsets[:-1] * 0, offsets[:-1] * 0
            continue
        gram = byte[: len(byte) - n + 1].copy()
        for k in range(1, n):
            gram |= byte[k : len(byte) - n + 1 + k] << np.uint32(8 * k)
        with np.errstate(over="ignore"):
            gram *= np.uint32(2654435761)
            gram ^= gram >> np.uint32(15)
            gram *= np.uint32(2246822519)
        yield (gram >> np.uint32(32 - BITS)).astype(np.int64), offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - n + 1)


@dataclass
class QualityModel:
    weights: np.ndarray  # FAMILIES x 2**BITS
    bias: float
    slope: float
    shift: float

    def margins(self, raw: np.ndarray, offsets: np.ndarray, words: tx.Words) -> np.ndarray:
        out = np.full(len(offsets) - 1, self.bias)
        for f, (index, lo, hi) in enumerate(grams(raw, offsets, words)):
            lo, hi = np.minimum(lo, len(index)), np.minimum(hi, len(index))
            out += _sums(self.weights[f][index], lo, hi, np.float64) / np.maximum(hi - lo, 1)
        return out

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * margins + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _minimise(fun, x: np.ndarray, rounds: int) -> np.ndarray:
    """L-BFGS with backtracking."""
    value, slope = fun(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        d = -slope
        alphas = []
        for s, y, r in reversed(past):
            a = r * (s @ d)
            alphas.append(a)
            d = d - a * y
        if past:
            s, y, _ = past[-1]
            d *= (s @ y) / (y @ y)
        for (s, y, r), a in zip(past, reversed(alphas)):
            d = d + s * (a - r * (y @ d))
        step, down = 1.0, slope @ d
        if down >= 0:
            break
        while True:
            new, new_slope = fun(x + step * d)
            if new <= value + 1e-4 * step * down or step < 1e-6:
                break
            step *= 0.5
        s, y = step * d, new_slope - slope
        done = abs(value - new) < 1e-7 * max(1.0, abs(value))
        x, value, slope = x + s, new, new_slope
        if s @ y > 1e-12:
            past = [*past[-7:], (s, y, 1 / (s @ y))]
        if done:
            break
    return x


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, penalty: float = 1e-4, rounds: int = 60) -> QualityModel:
    """``rows``: feature indices (family * 2**BITS + hash, 32-bit) and relative frequencies (32-bit) of each text."""
    order = np.random.default_rng(11).permutation(len(rows))
    cut = max(1, len(rows) // 4)
    held, used = order[:cut], order[cut:]
    if len(set(labels[used])) < 2 or len(set(labels[held])) < 2:
        held = used = order

    def stack(which):
        index = np.concatenate([rows[i][0] for i in which])
        value = np.concatenate([rows[i][1] for i in which])
        return index, value, np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in which])])

    index, value, ptr = stack(used)
    columns = np.flatnonzero(np.bincount(index, minlength=FAMILIES << BITS))
    place = np.zeros(FAMILIES << BITS, dtype=np.int32)
    place[columns] = np.arange(len(columns), dtype=np.int32)
    index = place[index]
    scale = 1 / np.sqrt(np.bincount(index, weights=value**2, minlength=len(columns)) / len(used) + 1e-8)
    scaled = value * scale[index].astype(np.float32)
    del value
    y = labels[used].astype(np.float64)
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    row = np.repeat(np.arange(len(used), dtype=np.int32), np.diff(ptr))

    def loss(x):
        margin = np.bincount(row, weights=scaled * x[index], minlength=len(used)) + x[-1]
        p = _sigmoid(margin)
        cost = balance * (np.logaddexp(0, margin) - y * margin)
        pull = balance * (p - y) / len(used)
        slope = np.append(np.bincount(index, weights=scaled * pull[row], minlength=len(columns)) + penalty * x[:-1], pull.sum())
        return cost.mean() + penalty / 2 * (x[:-1] @ x[:-1]), slope

    x = _minimise(loss, np.zeros(len(columns) + 1), rounds)
    weights = np.zeros(FAMILIES << BITS)
    weights[columns] = x[:-1] * scale
    h_index, h_value, h_ptr = stack(held)
    margin = np.bincount(np.repeat(np.arange(len(held)), np.diff(h_ptr)), weights=h_value * weights[h_index], minlength=len(held)) + x[-1]
    t = labels[held].astype(np.float64)
    t = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))  # Platt's targets

    def calibration(z):
        m = z[0] * margin + z[1]
        r = (_sigmoid(m) - t) / len(t)
        return (np.logaddexp(0, m) - t * m).mean(), np.array([r @ margin, r.sum()])

    slope, shift = _minimise(calibration, np.array([1.0, 0.0]), 100)
    return QualityModel(weights.reshape(FAMILIES, -1).astype(np.float32), float(x[-1]), float(slope), float(shift))


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = 1000, most_features: int = TRAIN_FEATURES) -> QualityModel | None:
    """Fit on labelled documents, those of the ``sample_rows`` least hashed doc_ids; of more than twice as many rows,
    those of least hash.

    A doc_id with several labels takes the least.  Whole texts train; a text has at most 2**BITS features of each family,
    however long it is, and rows of least hash are taken while they have at most ``most_features`` in all, which bounds what
    the driver holds.  None where the labels of documents at hand are all equal or absent.
    """
    rated = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rated = rated.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets, words in tx.word_blocks(batch.column(0)):
                parts: list[list] = [[] for _ in range(hi - lo)]
                for f, (index, a, b) in enumerate(grams(raw, offsets, words)):
                    for i in range(hi - lo):
                        n = np.bincount(index[a[i] : b[i]], minlength=1 << BITS)
                        own = np.flatnonzero(n)
                        parts[i].append((own + (f << BITS), n[own] / max(n.sum(), 1)))
                index = [np.concatenate([p[0] for p in x]).astype("<i4").tobytes() for x in parts]
                value = [np.concatenate([p[1] for p in x]).astype("<f4").tobytes() for x in parts]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), pa.array(index, pa.binary()), pa.array(value, pa.binary())], names=["quality", "index", "value"])

    sample = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", F.col("quality").cast("int").alias("quality"))  # at most sample_rows ids
    made = materialise(sample.mapInArrow(tx.returning(run), "quality int, index binary, value binary").withColumn("h", F.xxhash64("index", "value", "quality")), "features")
    sizes = made.select("h", (F.octet_length("index") / 4).alias("n")).orderBy("h").limit(2 * sample_rows).toPandas()
    upto = sizes["n"].cumsum() <= most_features
    last = sizes["h"][upto].max() if upto.any() else None
    # Rows of equal hash are equal rows: as many of them as fit are taken with the limit.
    got = made.filter(F.col("h") <= F.lit(int(last))).orderBy("h").limit(int(upto.sum())).drop("h").toPandas() if last is not None else made.limit(0).drop("h").toPandas()
    discard(made)
    if got["quality"].nunique() < 2:
        return None
    rows = [(np.frombuffer(a, "<i4"), np.frombuffer(b, "<f4")) for a, b in zip(got["index"], got["value"])]
    return fit(rows, got["quality"].to_numpy())


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(documents: DataFrame, model: QualityModel | None, threshold: float = 0.5, carry: bool = False) -> DataFrame:
    """Base counts, base_failed, probability and kept of every row.

    Returns doc_id with them, or all columns with ``carry`` (columns of these names are replaced).  Null and empty texts
    have no words and fail.  Without a model a text that passes the base rules is kept, with a null probability.
    """
    names = [*COUNTS, "base_failed", "probability", "kept"]
    base = documents.drop(*names) if carry else documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets, words in tx.word_blocks(batch.column(batch.schema.names.index("text"))):
                counts = base_counts(raw, offsets, words)
                failed = base_failed(counts["n_words"], counts["n_repeat_words"])
                p = model.probabilities(model.margins(raw, offsets, words)) if model else None
                kept = ~failed & (p >= threshold) if model else ~failed
                part = batch.slice(lo, hi - lo)
                cols = [*part.columns, *(pa.array(counts[c], pa.int64()) for c in COUNTS), pa.array(failed), pa.array(p, pa.float64()) if model else pa.nulls(hi - lo, pa.float64()), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(cols, names=[*part.schema.names, *names])

    schema = widened(base.schema, *((c, "long") for c in COUNTS), ("base_failed", "boolean"), ("probability", "double"), ("kept", "boolean"))
    out = base.mapInArrow(tx.returning(run), schema)
    return out if carry else out.drop("text")
