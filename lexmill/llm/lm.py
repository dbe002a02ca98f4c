"""Language-model scoring with a log-frequency Bloom filter.

Unigram counts are exact.  The counts of *all* bigrams are quantised to levels, level q standing for 2**(q-1) .. 2**q - 1,
and a bigram of level q is entered q times, under (bigram, 1) .. (bigram, q).  A probe asks for level 1, 2, ... until one
is missing.  The filter is a row of blocks by the leading bits of the key, each as large as its entries need, so it grows
with the corpus and no count is left out.  With q(v, w) the middle of the level of a bigram, S(v) the sum of q(v, w) over
the followers of v and T(v) their number, probabilities are interpolated, and sum to 1 over all followers:

    P(w | v) = q(v, w) / (T(v) + S(v)) + T(v) / (T(v) + S(v)) * (c(w) + 0.5) / (N + 0.5 * (V + 1))

Every text starts after, and ends with, the end token.  After a token that was never followed P is the unigram part.

The ``hot`` most frequent tokens and their c, T and S are broadcast; the filter is, as long as it has at most
``filter_bits`` bits.  Beyond that, and for tokens that aren't hot, each block of texts asks for its distinct keys: the
requests of a bucket are streamed past its filter block and token table, and the answers go back to the block.  The
scores are the same whether the filter is broadcast or asked.

The keys of a bigram (v, w) lie in the bucket of v, so that T(v) and S(v) come from one bucket; the bigrams of the
``spread`` most frequent v are dealt over all buckets, and their sums are added up.  A key is its bucket and 32 more bits
of the bigram's hash: of the million keys of a bucket, a chance of 1 in 4,000 for an absent one to meet another, well below
that of the filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm import text as tx
from lexmill.llm.counting import PACKED, bucket_bits, packed, split_rows, summed, text_bytes
from lexmill.llm.scratch import discard, materialise, partitions, release, sized

_U = np.uint64
END = _U(0x0123456789ABCDEF)
HASHES = 4
LEVELS = 40
BLOCK_BYTES = 1 << 21
HELD_TOKENS = 1 << 20


def is_held_out(key: Column, folds: int = 5, held: int = 1) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(folds)) == held


class HotTokens:
    """Open-addressed table of the hot tokens: hash -> place by falling count."""

    def __init__(self, hashes: np.ndarray):
        self.bits = max(4, int(2 * len(hashes)).bit_length() + 1)
        size = 1 << self.bits
        self.key, self.place = np.zeros(size, dtype=_U), np.full(size, -1, dtype=np.int32)
        left, at = np.arange(len(hashes)), (hashes >> _U(64 - self.bits)).astype(np.int64)
        self.probes = 0
        while len(left):
            free = np.flatnonzero(self.place[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            win = free[first]
            self.key[at[win]], self.place[at[win]] = hashes[left[win]], left[win]
            lost = np.ones(len(left), dtype=bool)
            lost[win] = False
            left, at = left[lost], (at[lost] + 1) % size
            self.probes += 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 for other tokens."""
        size = 1 << self.bits
        at = (hashes >> _U(64 - self.bits)).astype(np.int64)
        out = self.place[at]
        wrong = np.flatnonzero((out >= 0) & (self.key[at] != hashes))
        at = at[wrong]
        while len(wrong):
            at = (at + 1) % size
            got = self.place[at]
            out[wrong] = got
            go = (got >= 0) & (self.key[at] != hashes[wrong])
            wrong, at = wrong[go], at[go]
        return out


def _places(keys: np.ndarray, level: int, k: int, size: np.ndarray | int) -> np.ndarray:
    """Places in a block of ``size`` < 2**32 bits."""
    with np.errstate(over="ignore"):
        return ((tx.mix(keys + _U(level * HASHES + k) * _U(0x9E3779B97F4A7C15)) >> _U(32)) * np.asarray(size, dtype=_U)) >> _U(32)


def filter_block(keys: np.ndarray, levels: np.ndarray, bits_per_entry: int) -> tuple[np.ndarray, int]:
    """Bytes of the block that holds ``keys`` at ``levels``, and its size in bits."""
    size = max(64, int(levels.sum()) * bits_per_entry)
    if size >= 1 << 32:
        raise ValueError("a bucket has too many bigrams")
    bits = np.zeros(size, dtype=bool)
    for q in range(1, int(levels.max(initial=0)) + 1):
        own = keys[levels >= q]
        for k in range(HASHES):
            bits[_places(own, q, k, size).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little"), size


def probed(keys: np.ndarray, data: np.ndarray, size: np.ndarray | int, base: np.ndarray | int = 0) -> np.ndarray:
    """Level of each key by repeated probes; 0 if absent (an absent one may pass by chance)."""
    out = np.zeros(len(keys), dtype=np.uint8)
    live = np.arange(len(keys))
    size, base = np.broadcast_to(np.asarray(size, dtype=_U), len(keys)), np.broadcast_to(np.asarray(base, dtype=_U), len(keys))
    for q in range(1, LEVELS + 1):
        for k in range(HASHES):
            at = _places(keys[live], q, k, size[live]) + base[live]
            live = live[(data[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 > 0]
        out[live] = q
        if not len(live):
            break
    return out


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1) + 0.5 * (counts < 1))).astype(np.int64) + 1


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that a level stands for."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1) - 0.5, 0.0)


def _grade(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of 16 steps for each power of two."""
    power = np.floor(np.log2(np.maximum(counts, 1) + 0.25)).astype(np.int64)
    return power * 16 + (np.maximum(counts, 1) * 16 >> power) - 16


def _least(grade: int) -> int:
    """The least count of a grade."""
    return -(-((16 + grade % 16) << (grade // 16)) // 16)


def _tokens(words: tx.Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block with the end token after each row, and the rows' spans."""
    n = len(words.ptr) - 1
    ptr = words.ptr + np.arange(n + 1)
    out = np.full(int(ptr[-1]), END, dtype=_U)
    keep = np.ones(len(out), dtype=bool)
    keep[ptr[1:] - 1] = False
    out[keep] = words.hashes
    return out, ptr


def unigram_counts(texts: DataFrame, bits: int) -> DataFrame:
    """bucket, tokens, counts, n and v: exact counts of all tokens, the end token included, packed by bucket."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, _, _, _, words in tx.word_blocks(batch.column(0), lower=True):
                held.append(_tokens(words)[0])
                n += len(held[-1])
                if n >= HELD_TOKENS:
                    yield packed(*np.unique(np.concatenate(held), return_counts=True), bits)
                    held, n = [], 0
        if n:
            yield packed(*np.unique(np.concatenate(held), return_counts=True), bits)

    def reduce(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = summed(table)
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "tokens": [keys.tobytes()], "counts": [counts.astype("<i8").tobytes()], "n": [int(counts.sum())], "v": [len(keys)]})

    return texts.select("text").mapInArrow(emit, PACKED).groupBy("bucket").applyInArrow(reduce, "bucket long, tokens binary, counts binary, n long, v long")


@dataclass
class Model:
    """What every worker holds: the hot tokens with their facts, totals and, up to a bound, the filter."""

    hot: np.ndarray
    c: np.ndarray
    total: int
    distinct: int
    spread: int
    bits: int
    followers: np.ndarray = field(default_factory=lambda: np.zeros(0))  # T of the hot tokens
    stored: np.ndarray = field(default_factory=lambda: np.zeros(0))  # S of the hot tokens
    data: np.ndarray | None = None  # the whole filter, or None where its blocks are asked
    sizes: np.ndarray | None = None
    bases: np.ndarray | None = None
    _table: HotTokens | None = None

    def __getstate__(self):
        return {**self.__dict__, "_table": None}

    @property
    def denominator(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def places(self, tokens: np.ndarray) -> np.ndarray:
        if self._table is None:
            self._table = HotTokens(self.hot)
        return self._table.find(tokens)

    def before(self, values: np.ndarray, ptr: np.ndarray, first) -> np.ndarray:
        """The value before each, ``first`` at the start of each row."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[ptr[:-1]] = first
        return out

    def keys(self, before: np.ndarray, tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Keys of bigrams; ``place`` is that of the first token.  The leading bits are the bucket, the last 32 the rest."""
        with np.errstate(over="ignore"):
            pair = tx.mix(before + tokens * _U(0xD6E8FEB86659FD93))
        lead = np.where((place >= 0) & (place < self.spread), pair, before)
        high = _U(64 - self.bits)
        return ((lead >> high) << high) | (pair & _U(0xFFFFFFFF))

    def probe(self, keys: np.ndarray) -> np.ndarray:
        at = (keys >> _U(64 - self.bits)).astype(np.int64)
        return probed(keys, self.data, self.sizes[at], self.bases[at])


def bigram_blocks(training: DataFrame, shared, bits: int, bits_per_entry: int) -> DataFrame:
    """Per bucket: the filter block, its size, T and S of the tokens at home there, and sums of those that are hot."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            """Per bucket: the tokens v, how many entries each has, and their keys and counts (up to 255, more in more entries)."""
            keys, before = (np.concatenate(h) for h in zip(*held))
            held.clear()
            order = np.argsort(keys)
            keys, before = keys[order], before[order]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (before[1:] != before[:-1])]))
            counts = np.diff(np.append(first, len(keys)))
            keys, before = keys[first], before[first]
            order = np.argsort(((keys >> _U(64 - bits)) << _U(64 - bits)) | (before >> _U(bits)))  # by bucket and v
            keys, before, counts = keys[order], before[order], counts[order]
            more = (counts + 254) // 255
            if len(counts) and more.max() > 1:
                keys, before = np.repeat(keys, more), np.repeat(before, more)
                last = np.cumsum(more) - 1
                split = np.full(len(keys), 255)
                split[last] = counts - (more - 1) * 255
                counts = split
            bucket = keys >> _U(64 - bits)
            run = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (bucket[1:] != bucket[:-1])]))
            entries = split_rows(keys, bits, keys=keys.astype("<u4"), counts=counts.astype(np.uint8))
            runs = split_rows(keys[run], bits, v=before[run], runs=np.diff(np.append(run, len(keys))).astype("<u4"))
            return pa.RecordBatch.from_arrays([*entries.columns, *runs.columns[1:]], names=["bucket", "keys", "counts", "v", "runs"])

        for batch in batches:
            for _, _, _, _, words in tx.word_blocks(batch.column(0), lower=True):
                tokens, ptr = _tokens(words)
                before = m.before(tokens, ptr, END)
                held.append((m.keys(before, tokens, m.places(before)), before))
                n += len(tokens)
                if n >= HELD_TOKENS:
                    yield flush()
                    n = 0
        if n:
            yield flush()

    def reduce(key: tuple, table: pa.Table) -> pa.Table:
        m = shared.value
        read = lambda n, t: np.concatenate([np.frombuffer(b.as_buffer(), dtype=t) for b in table.column(n).combine_chunks()])
        keys, counts, before = read("keys", "<u4"), read("counts", np.uint8), np.repeat(read("v", "<u8"), read("runs", "<u4"))
        with np.errstate(over="ignore"):
            order = np.argsort(tx.mix(before + keys.astype(_U) * _U(0x9E3779B97F4A7C15)))
        keys, before, counts = keys[order], before[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (before[1:] != before[:-1])]))
        before, levels = before[first], level_of(np.add.reduceat(counts, first))
        keys = keys[first].astype(_U) | (_U(key[0].as_py()) << _U(64 - bits))
        data, size = filter_block(keys, levels, bits_per_entry)
        v, at = np.unique(before, return_inverse=True)
        t, s = np.bincount(at), np.bincount(at, weights=count_of(levels))
        place = m.places(v)
        hot, home = place >= 0, (place < 0) | (place >= m.spread)
        sums = pa.array([[{"place": p, "t": a, "s": b} for p, a, b in zip(place[hot].tolist(), t[hot].tolist(), s[hot].tolist())]], pa.list_(pa.struct([("place", pa.int64()), ("t", pa.int64()), ("s", pa.float64())])))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "block": [data.tobytes()], "size": [size], "v": [v[home].tobytes()], "t": [t[home].astype("<i8").tobytes()], "s": [s[home].astype("<f8").tobytes()], "hot": sums})

    rows = training.select("text").mapInArrow(emit, "bucket long, keys binary, counts binary, v binary, runs binary")
    return rows.groupBy("bucket").applyInArrow(reduce, "bucket long, block binary, size long, v binary, t binary, s binary, hot array<struct<place:long,t:long,s:double>>")


def fit(training: DataFrame, hot: int = 1 << 18, filter_bits: int = 1 << 26, bits_per_entry: int = 12, spread: int = 1 << 12) -> tuple[Model, DataFrame]:
    """(model, store).  What is broadcast is bounded by ``hot`` and ``filter_bits``; the store holds everything by bucket."""
    spark = training.sparkSession
    size = text_bytes(training)
    bits = bucket_bits(size)
    with sized(spark, size):
        unigrams = materialise(unigram_counts(training, bits), "unigrams")
    sums = unigrams.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()

    def graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch.column(0):
                c, n = np.unique(_grade(np.frombuffer(counts.as_buffer(), dtype="<i8")), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(n)], names=["grade", "n"])

    grades = unigrams.select("counts").mapInArrow(graded, "grade long, n long").groupBy("grade").agg(F.sum("n").alias("n")).orderBy(F.desc("grade")).toPandas()  # 16 grades for each power of two
    within = grades["n"].cumsum() < hot
    cutoff = _least(int(grades["grade"][within].min())) if within.any() else 1 << 62

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, counts in zip(batch.column(0), batch.column(1)):
                tokens, counts = np.frombuffer(tokens.as_buffer(), dtype="<i8"), np.frombuffer(counts.as_buffer(), dtype="<i8")
                top = np.flatnonzero((counts >= cutoff) | (tokens == END.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(tokens[top]), pa.array(counts[top])], names=["token", "c"])

    end = F.col("token") == int(END.astype(np.int64))
    rows = unigrams.select("tokens", "counts").mapInArrow(opened, "token long, c long").orderBy(end.desc(), F.desc("c"), "token").toPandas()  # at most `hot` rows, the end token first
    model = Model(rows["token"].to_numpy(dtype=np.int64).astype(_U), rows["c"].to_numpy(dtype=np.int64), int(sums["n"] or 0), int(sums["v"] or 0), spread, bits)
    release(spark)
    shared = spark.sparkContext.broadcast(model)  # at most `hot` tokens
    with sized(spark, 2 * size):
        blocks = materialise(bigram_blocks(training, shared, bits, bits_per_entry), "bigrams")
    release(spark)
    model.followers, model.stored = np.zeros(len(rows)), np.zeros(len(rows))
    sums = blocks.select(F.explode("hot").alias("h")).groupBy("h.place").agg(F.sum("h.t").alias("t"), F.sum("h.s").alias("s")).toPandas()  # at most `hot` rows
    model.followers[sums["place"]], model.stored[sums["place"]] = sums["t"], sums["s"]
    whole = blocks.agg(F.sum((F.col("size") + 7).bitwiseAND(F.lit(~7)))).first()[0] or 0
    if whole <= filter_bits:
        model.sizes, model.bases = np.full(1 << bits, 64, dtype=_U), np.zeros(1 << bits, dtype=_U)
        model.data, at = np.zeros(whole // 8 + 8, dtype=np.uint8), 8  # the first eight bytes serve empty buckets
        for r in blocks.select("bucket", "block", "size").toLocalIterator():  # filter_bits in all
            model.sizes[r["bucket"]], model.bases[r["bucket"]] = r["size"], at * 8
            model.data[at : at + len(r["block"])] = np.frombuffer(r["block"], dtype=np.uint8)
            at += len(r["block"])
    store = unigrams.select("bucket", "tokens", "counts").join(blocks.drop("hot"), "bucket", "left" if model.data is not None else "full")
    if model.data is not None:
        store = store.withColumn("block", F.lit(None).cast("binary"))
    store = materialise(store, "store")
    discard(unigrams)
    discard(blocks)
    release(spark)
    return model, store


class _Facts:
    """c, T and S of the tokens of a block and the levels of its bigrams, in part from answers."""

    def __init__(self, model: Model, parts: list[tuple[np.ndarray, np.ndarray]], place_answers: bool = True):
        self.model = model
        self.parts = []
        for tokens, ptr in parts:
            place = model.places(tokens)
            before = model.before(tokens, ptr, END)
            at = model.before(place, ptr, model.places(np.array([END], dtype=_U))[0])
            self.parts.append((tokens, ptr, place, before, at, model.keys(before, tokens, at)))
        held = lambda arrays: np.concatenate(arrays) if arrays else np.zeros(0, dtype=_U)
        rare = held([tokens[place < 0] for tokens, _, place, _, _, _ in self.parts])
        asked = held([keys for *_, keys in self.parts]) if model.data is None else np.zeros(0, dtype=_U)
        if place_answers:
            self.rare = tx.distinct(rare)
            self.asked, self.at = np.unique(asked, return_inverse=True)
        else:
            self.rare, self.asked = tx.distinct(rare), tx.distinct(asked)

    def scores(self, rare: np.ndarray, levels: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Per part and row: number of tokens, of known ones, base score and score."""
        m = self.model

        def of(facts: np.ndarray, tokens: np.ndarray, place: np.ndarray, column: int) -> np.ndarray:
            out = facts[np.maximum(place, 0)].astype(np.float64) if len(facts) else np.zeros(len(place))
            other = place < 0
            out[other] = rare[np.searchsorted(self.rare, tokens[other]), column]
            return out

        done = 0
        for tokens, ptr, place, before, at, keys in self.parts:
            c = of(m.c, tokens, place, 0)
            t, s = of(m.followers, before, at, 1), of(m.stored, before, at, 2)
            level = m.probe(keys) if m.data is not None else levels[self.at[done : done + len(keys)]]
            done += len(keys)
            one = (c + 0.5) / m.denominator
            rest = t + s
            known = rest > 0
            p = np.where(known, (count_of(level.astype(np.int64)) + t * one) / np.where(known, rest, 1), one)
            p = np.where(p > 0, p, one)
            first = ptr[:-1]
            yield np.diff(ptr), np.add.reduceat((c > 0).astype(np.int64), first), np.add.reduceat(np.log10(one), first), np.add.reduceat(np.log10(p), first)


def _scored(facts: _Facts, doc_ids: pa.Array, rare: np.ndarray, levels: np.ndarray) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*facts.scores(rare, levels))]
    return pa.RecordBatch.from_arrays([doc_ids, *(pa.array(c) for c in columns)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def _parts(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    return [_tokens(words) for _, _, _, _, words in tx.word_blocks(texts, lower=True)]


NO_FACTS, NO_LEVELS = np.zeros((0, 3)), np.zeros(0, dtype=np.uint8)


def score(documents: DataFrame, model: Model, store: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row (null text: empty)."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by hot and filter_bits
    key = documents.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {key}, n_tokens long, n_known long, base_score double, score double"
    if model.data is not None and model.distinct <= len(model.hot):  # nothing to ask for but tokens that nobody knows
        def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi in tx.row_blocks(tx.string_buffer(batch.column(1))[1], BLOCK_BYTES):
                    facts = _Facts(shared.value, _parts(batch.column(1).slice(lo, hi - lo)))
                    yield _scored(facts, batch.column(0).slice(lo, hi - lo), np.zeros((len(facts.rare), 3)), NO_LEVELS)

        rows = documents.select("doc_id", "text").mapInArrow(direct, out)
    else:
        rows = _asked(documents, shared, store, key, out)
    return rows.withColumn("train_tokens", F.lit(model.total).cast("long")).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _asked(documents: DataFrame, shared, store: DataFrame, key: str, out: str) -> DataFrame:
    """Scores by requests of blocks of texts to the buckets of the store."""

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tx.string_buffer(batch.column(1))
            for lo, hi in tx.row_blocks(offsets, BLOCK_BYTES):
                ids = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(0).slice(lo, hi - lo))
                sizes = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), pa.array(np.diff(offsets[lo : hi + 1])))
                data = raw[offsets[lo] : offsets[hi]]
                yield pa.RecordBatch.from_arrays([ids, sizes, pa.array([len(data)]), pa.array([pa.compress(pa.py_buffer(data), codec="zstd", asbytes=True)], pa.binary())], names=["ids", "sizes", "raw", "texts"])

    def opened(row: dict, i: int) -> pa.Array:
        """The texts of a block, as bytes."""
        data = pa.decompress(row["texts"][i].as_buffer(), row["raw"][i].as_py(), codec="zstd")
        offsets = np.concatenate([[0], np.cumsum(row["sizes"][i].values.to_numpy())])
        return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), data])

    blocks = documents.select("doc_id", "text").mapInArrow(block, f"ids array<{key}>, sizes array<long>, raw long, texts binary")
    blocks = materialise(blocks.withColumn("at", F.monotonically_increasing_id()), "blocks")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            row = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(len(batch)):
                facts = _Facts(m, _parts(opened(row, i)), place_answers=False)
                for kind, keys, sent in ((0, facts.rare, facts.rare), (1, facts.asked, facts.asked.astype("<u4"))):
                    if len(keys):
                        rows = split_rows(keys, m.bits, keys=sent)
                        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(len(rows), kind, dtype=np.int8)), pa.array(np.full(len(rows), row["at"][i].as_py()))], names=["bucket", "keys", "kind", "at"])

    asks = blocks.select("sizes", "raw", "texts", "at").mapInArrow(ask, "bucket long, keys binary, kind tinyint, at long")
    held = store.select("bucket", "tokens", "counts", "v", "t", "s", "block", "size", F.lit(False).alias("asks"))
    both = held.unionByName(asks.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    # A task answers for one bucket after the other, however many it gets.
    both = both.repartition(partitions(max(64, 1 << shared.value.bits)), "bucket").sortWithinPartitions("bucket", "asks", "kind")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bucket = _Bucket(), None
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            at = {n: col[n].to_numpy(zero_copy_only=False) for n in ("bucket", "asks", "kind", "at")}
            kind = np.where(at["asks"], np.nan_to_num(at["kind"].astype(np.float64), nan=-1), -1).astype(np.int8)
            change = (at["bucket"][1:] != at["bucket"][:-1]) | (kind[1:] != kind[:-1])
            edges = np.concatenate([[0], np.flatnonzero(change) + 1, [len(batch)]]) if len(batch) else np.zeros(1, dtype=np.int64)
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if bucket != at["bucket"][lo]:
                    bucket, now = int(at["bucket"][lo]), _Bucket()
                if kind[lo] < 0:
                    now = _Bucket({n: col[n][lo] for n in ("tokens", "counts", "v", "t", "s", "block", "size")})
                    continue
                # All requests of a kind that follow each other are answered at once.
                keys = [np.frombuffer(k.as_buffer(), dtype="<u4" if kind[lo] else "<u8") for k in col["keys"].slice(lo, hi - lo)]
                whole = np.concatenate(keys)
                values = now.levels(whole.astype(_U) | (_U(bucket) << _U(64 - shared.value.bits))) if kind[lo] else now.facts(whole)
                cuts = np.cumsum([len(k) for k in keys])[:-1]
                yield pa.RecordBatch.from_arrays([pa.array(at["at"][lo:hi].astype(np.int64)), pa.array(kind[lo:hi]), pa.array(at["bucket"][lo:hi]), pa.array([v.tobytes() for v in np.split(values, cuts)], pa.binary())], names=["at", "kind", "bucket", "values"])

    answers = materialise(both.mapInArrow(answer, "at long, kind tinyint, bucket long, values binary"), "answers")
    release(documents.sparkSession)
    whole = blocks.withColumn("kind", F.lit(-1).cast("tinyint")).unionByName(answers, allowMissingColumns=True)
    whole = whole.repartition(partitions(max(64, -(-blocks.count() // 16))), "at").sortWithinPartitions("at", "kind", "bucket")  # values in the order of the keys

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = texts = None
        held: tuple[list, list] = ([], [])

        def done() -> pa.RecordBatch:
            facts = _Facts(shared.value, _parts(texts))
            rare = np.concatenate(held[0]).reshape(-1, 3) * (1, 1, 0.5) if held[0] else NO_FACTS
            return _scored(facts, ids, rare, np.concatenate(held[1]) if held[1] else NO_LEVELS)

        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i, kind in enumerate(col["kind"].to_pylist()):
                if kind < 0:
                    if ids is not None:
                        yield done()
                    ids, texts, held = col["ids"][i].values, opened(col, i), ([], [])
                elif kind == 0:
                    held[0].append(np.frombuffer(col["values"][i].as_buffer(), dtype="<u4"))
                else:
                    held[1].append(np.frombuffer(col["values"][i].as_buffer(), dtype=np.uint8))
        if ids is not None:
            yield done()

    return whole.select("at", "kind", "bucket", "ids", "sizes", "raw", "texts", "values").mapInArrow(finish, out)


class _Bucket:
    """Token table and filter block of one bucket; without a row nothing is known."""

    def __init__(self, row: dict | None = None):
        row = row or {}
        read = lambda n, t: np.frombuffer(row[n].as_buffer(), dtype=t) if n in row and row[n].is_valid else np.zeros(0, dtype=t)
        self.tokens, self.counts = read("tokens", "<u8"), read("counts", "<i8")
        self.v, self.t, self.s = read("v", "<u8"), read("t", "<i8"), read("s", "<f8")
        self.block, self.size = read("block", np.uint8), row["size"].as_py() if "size" in row else None

    def facts(self, keys: np.ndarray) -> np.ndarray:
        """c, T and twice S of each token; those asked for aren't hot, so 32 bits hold them."""
        out = np.zeros((len(keys), 3), dtype="<u4")
        for column, (names, values) in enumerate(((self.tokens, self.counts), (self.v, self.t), (self.v, 2 * self.s))):
            if len(names):
                at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
                out[:, column] = np.where(names[at] == keys, values[at], 0)
        return out

    def levels(self, keys: np.ndarray) -> np.ndarray:
        return probed(keys, self.block, self.size) if len(self.block) else np.zeros(len(keys), dtype=np.uint8)


def score_documents(documents: DataFrame, folds: int = 5, held: int = 1, **limits: int) -> DataFrame:
    """Score all rows with a model learnt from the rows outside the held-out fold.

    Fields of documents other than doc_id and text play no part.  A null doc_id counts as empty text for the fold; null
    and empty texts are the end token alone.  Repeated rows are rows of their own, in training too; texts are read whole,
    however long.  With nothing to learn from, every token has the probability of the unseen one; an empty table gives
    an empty table.
    """
    keyed = documents.select("doc_id", "text").withColumn("held_out", is_held_out(F.col("doc_id"), folds, held))
    model, store = fit(keyed.filter("not held_out"), **limits)
    out = score(keyed, model, store)
    return out.select("doc_id", is_held_out(F.col("doc_id"), folds, held).alias("held_out"), *out.columns[1:])
