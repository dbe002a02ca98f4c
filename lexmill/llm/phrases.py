"""Phrase collocations: counts of all frequent phrases by sorted suffixes, scored by their weakest cut.

Suffix-sigma.  Every word starts a suffix of at most ``most`` words; a pair of words that is too rare for any candidate ends
the suffixes that reach it, since no candidate holds it.  Which pairs those are is counted before, by their hashes: a
bitmap marks the cells of frequent ones, so that chance hits lengthen a suffix but nothing is lost.  Suffixes are dealt by language and first word, in ranges of the sorted
suffixes, so that the suffixes of a frequent first word (or of a frequent beginning of several words) take several tasks.
Each task reads its suffixes in reverse order and counts all their prefixes with one stack: a prefix that the next suffix
doesn't share is complete and leaves the stack.  Only prefixes on the stack at the two ends of a range may go on in
another one; they are sent on whatever their count, and added up.

Phrases carry a space after each word until they are counted, so that all that begin with the same words stand together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.llm import text as tx
from lexmill.llm.counting import bucket_bits, split_rows
from lexmill.llm.scratch import discard, materialise, release, scope, sized

_U = np.uint64
BLOCK = 1 << 20  # bytes of text whose suffixes are made at once
CELL_BITS = (16, 28)  # least and most bits of the number of cells of frequent pairs
HELD = 2 << 20  # pairs counted in a task before they are sent
SALTS = 256

CUT = np.zeros(256, dtype=bool)
CUT[[ord(c) for c in ".,;:!?"]] = True
CUT[0x0A : 0x0D + 1] = True
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[ord("A") : ord("Z") + 1] += 32
PLAIN[CUT] = 0x20
PLAIN[0x09] = 0x20


class Stretch:
    """Words of some texts: their bytes with a space after each, and where a phrase can't go on.

    ``own`` is the number of words whose suffixes belong to this stretch; those after it are read again by the next one.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, rows: np.ndarray):
        mapped = PLAIN[raw]
        words = tx.words_of(mapped, offsets)
        self.starts, self.hashes, self.own = words.starts, words.hashes, len(words.starts)
        row = np.searchsorted(words.ptr, np.arange(self.own), side="right") - 1
        self.row = rows[row]
        cuts = np.cumsum(CUT[raw], dtype=np.int64)[self.starts] if self.own else np.zeros(0, dtype=np.int64)
        self.breaks = np.ones(self.own, dtype=bool)  # whether a word begins a piece
        if self.own:
            self.breaks[1:] = (row[1:] != row[:-1]) | (cuts[1:] != cuts[:-1])
        lengths = words.ends - words.starts
        self.at = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.bytes = np.full(self.at[-1], 0x20, dtype=np.uint8)
        inside = np.arange(int(lengths.sum()), dtype=np.int64)
        before = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if self.own else np.zeros(0, dtype=np.int64)
        own_word = np.repeat(np.arange(self.own), lengths)
        self.bytes[inside + own_word] = mapped[inside - before[own_word] + self.starts[own_word]]


def stretches(column: pa.Array, most: int, block: int = BLOCK) -> Iterator[Stretch]:
    """All texts of a column in stretches of about ``block`` bytes; a longer text takes several, by ``most - 1`` words overlapping."""
    raw, offsets = tx.string_buffer(column)
    for lo, hi in tx.row_blocks(offsets, block):
        if offsets[hi] - offsets[lo] <= 2 * block:
            yield Stretch(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], np.arange(lo, hi))
            continue
        at, end, size = int(offsets[lo]), int(offsets[hi]), block  # one long text
        while at < end:
            stop = min(end, at + size)
            while stop < end and PLAIN[raw[stop]] != 0x20:
                ahead = raw[stop : min(end, stop + block)]
                gap = np.flatnonzero(PLAIN[ahead] == 0x20)
                stop += int(gap[0]) if len(gap) else len(ahead)
            part = Stretch(raw[at:stop], np.array([0, stop - at]), np.arange(lo, hi))
            if stop < end and 0 < part.own < 2 * most:  # words as long as a stretch
                size *= 2
                continue
            size = block
            if stop == end or most == 1 or not part.own:
                at = stop
            else:
                part.own -= most - 1
                at += int(part.starts[part.own])
            yield part


def _strings(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    lengths = hi - lo
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    index = np.arange(offsets[-1]) + np.repeat(lo - offsets[:-1], lengths)
    return pa.Array.from_buffers(pa.large_string(), len(lo), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[index])])


def _tallied(langs: pa.Array, phrases: pa.Array, names: pa.Array) -> pa.RecordBatch:
    """(lang, phrase, n) of the distinct ones of a stretch."""
    table = pa.table({"code": langs, "phrase": phrases}).group_by(["code", "phrase"]).aggregate([([], "count_all")])
    out = pa.table({"lang": names.take(table.column("code")), "phrase": table.column("phrase").cast(pa.string()), "n": table.column("count_all").cast(pa.int64())})
    return out.combine_chunks().to_batches()[0] if out.num_rows else None


def _coded(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    encoded = batch.column("lang").dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


COUNTED = "lang string, phrase string, n long"


def word_counts(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, phrase, n) of all words; the row with a null phrase has the number of all occurrences of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, names = _coded(batch)
            total = np.zeros(len(names), dtype=np.int64)
            for s in stretches(batch.column("text"), 1, 4 * block):
                own = code[s.row[: s.own]]
                total += np.bincount(own, minlength=len(names))
                words = pa.Array.from_buffers(pa.large_string(), s.own, [None, pa.py_buffer(s.at[: s.own + 1].astype(np.int64)), pa.py_buffer(s.bytes)])
                if (made := _tallied(pa.array(own), words, names)) is not None:
                    yield made
            yield pa.RecordBatch.from_arrays([names, pa.nulls(len(names), pa.string()), pa.array(total)], names=["lang", "phrase", "n"])

    return rows.mapInArrow(run, COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _lang_hashes(names: pa.Array) -> np.ndarray:
    raw, offsets = tx.string_buffer(names)
    return tx.mix(tx.run_hashes(tx.BYTE[raw], offsets[:-1], offsets[1:]))


def _pairs(s: Stretch, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word but the last the hash of its language, itself and the next word, and whether both are of one piece."""
    with np.errstate(over="ignore"):
        return tx.mix(s.hashes[:-1] * _U(3) + s.hashes[1:] + lang[s.row[:-1]]), ~s.breaks[1:]


def frequent_pairs(rows: DataFrame, size: int, least: int, block: int = BLOCK) -> np.ndarray:
    """Bitmap of the cells (leading bits of the hash) that hold a pair of words with a count of at least ``least``.

    Tasks send pairs by buckets of leading bits, those of a task counted; each bucket is summed with one sort, and one task
    joins the marks of 4 KB of the bitmap.  The driver gets the bitmap: four cells for each pair that can be frequent, 32 MB at most.
    """
    bits = bucket_bits(size, keys=1 << 19, least=8)
    cell_bits = min(max((4 * size // (6 * least)).bit_length(), CELL_BITS[0]), CELL_BITS[1])
    slot_bits = max(0, cell_bits - 15)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        found = np.sort(np.concatenate(held))
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        return split_rows(found[first], bits, keys=((found[first] << _U(bits)) >> _U(32)).astype("<u4"), counts=np.diff(np.append(first, len(found))).astype("<u4"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            code, names = _coded(batch)
            lang = _lang_hashes(names)[code] if len(names) else np.zeros(0, dtype=_U)
            for s in stretches(batch.column("text"), 2, block):
                pair, inside = _pairs(s, lang)
                held.append(pair[: s.own][inside[: s.own]])
                n += len(held[-1])
                if n >= HELD:
                    yield packed(held)
                    held, n = [], 0
        if n:
            yield packed(held)

    def count(key: tuple, table: pa.Table) -> pa.Table:
        pair, n = (np.concatenate([np.frombuffer(b.as_buffer(), dtype="<u4") for b in table.column(c).combine_chunks()]) for c in ("keys", "counts"))
        order = np.argsort(pair)
        pair, n = pair[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        often = pair[first[np.add.reduceat(n, first) >= least]].astype(_U)
        cells = tx.distinct(((_U(key[0].as_py()) << _U(64 - bits)) | (often << _U(32 - bits))) >> _U(64 - cell_bits)).astype(np.int64)
        return pa.table({"slot": cells >> (cell_bits - slot_bits), "cell": cells})

    def join(key: tuple, table: pa.Table) -> pa.Table:
        marks = np.zeros(1 << (cell_bits - slot_bits), dtype=bool)
        marks[table.column("cell").to_numpy() & (len(marks) - 1)] = True
        return pa.table({"slot": [key[0].as_py()], "bits": [np.packbits(marks, bitorder="little").tobytes()]})

    counted = rows.mapInArrow(emit, "bucket long, keys binary, counts binary").groupBy("bucket").applyInArrow(count, "slot long, cell long")
    out = np.zeros(1 << (cell_bits - 3), dtype=np.uint8)
    each = len(out) >> slot_bits
    for r in counted.groupBy("slot").applyInArrow(join, "slot long, bits binary").toLocalIterator():  # 2**cell_bits bits in all
        out[r["slot"] * each : (r["slot"] + 1) * each] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def suffixes(rows: DataFrame, bitmap: np.ndarray, most: int, block: int = BLOCK) -> DataFrame:
    """(lang, phrase, n): suffixes of 2 to ``most`` words whose pairs are all marked in ``bitmap``, counted within a stretch."""
    shift = _U(64 - (int(len(bitmap) * 8).bit_length() - 1))
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)  # 32 MB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for batch in batches:
            code, names = _coded(batch)
            lang = _lang_hashes(names)[code] if len(names) else np.zeros(0, dtype=_U)
            for s in stretches(batch.column("text"), most, block):
                if len(s.starts) < 2:
                    continue
                pair, goes_on = _pairs(s, lang)
                cells = (pair >> shift).astype(np.int64)
                goes_on &= (marks[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
                kept = np.flatnonzero(goes_on[: s.own])
                stops = np.append(np.flatnonzero(~goes_on), len(goes_on))  # words that no next one follows
                end = np.minimum(stops[np.searchsorted(stops, kept)] + 1, kept + most)
                phrases = _strings(s.bytes, s.at[kept], s.at[end])
                if (made := _tallied(pa.array(code[s.row[kept]]), phrases, names)) is not None:
                    yield made

    return rows.mapInArrow(run, COUNTED)


class Stack:
    """The prefixes of the last suffix read, with their counts so far; ``edge`` marks those begun by the first suffix."""

    def __init__(self, most: int, least: int):
        self.most, self.least = most, least
        self.lang: str | None = None
        self.words: list[str] = []
        self.counts = np.zeros(most + 1, dtype=np.int64)
        self.edge = np.zeros(most + 1, dtype=bool)

    def read(self, langs: pa.Array, phrases: pa.Array, counts: np.ndarray) -> list[tuple[str, str, int]]:
        """Sorted suffixes pushed; what leaves the stack and is frequent, or may have begun in the range before."""
        fresh = self.lang is None
        if not fresh:  # the last suffix again, without count, to compare the first one with
            langs = pa.concat_arrays([pa.array([self.lang], langs.type), langs])
            phrases = pa.concat_arrays([pa.array(["".join(w + " " for w in self.words)], phrases.type), phrases])
            counts = np.concatenate([[0], counts])
        split = pc.split_pattern(phrases, " ")
        codes = split.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        at = split.offsets.to_numpy()
        size = np.diff(at) - 1  # the last is the empty string after the last space
        lang = langs.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        common = np.zeros(len(size), dtype=np.int64)  # words shared with the suffix before
        alike = np.concatenate([[False], lang[1:] == lang[:-1]])
        for d in range(self.most):
            here = np.minimum(at[:-1] + d, len(codes) - 1)
            alike[1:] &= (size[1:] > d) & (size[:-1] > d) & (codes[here[1:]] == codes[here[:-1]])
            common[alike] = d + 1
        total = np.concatenate([[0], np.cumsum(counts)])
        out: list[tuple[str, str, int]] = []
        for d in range(1, self.most + 1):
            turns = np.flatnonzero(common < d)
            if not fresh:
                turns = turns[turns > 0]
                until = turns[0] if len(turns) else len(size)
                self.counts[d] += total[until]
                if len(turns) and len(self.words) >= d and (self.edge[d] or self.counts[d] >= self.least):
                    out.append((self.lang, "".join(w + " " for w in self.words[:d]), int(self.counts[d])))
            if not len(turns):
                continue
            sums = total[np.append(turns[1:], len(size))] - total[turns]
            done = (size[turns] >= d) & (sums >= self.least)
            done[-1] = False  # stays on the stack
            if fresh and len(turns) > 1 and size[0] >= d:
                done[0] = True
            for k in np.flatnonzero(done):
                i = int(turns[k])
                out.append((langs[i].as_py(), "".join(w + " " for w in phrases[i].as_py().split(" ")[:d]), int(sums[k])))
            self.counts[d], self.edge[d] = sums[-1], fresh and len(turns) == 1
        self.lang, self.words = langs[len(size) - 1].as_py(), phrases[len(size) - 1].as_py().split(" ")[:-1]
        return out

    def rest(self) -> list[tuple[str, str, int]]:
        """All that is on the stack at the end of a range: it may go on in the next one."""
        return [(self.lang, "".join(w + " " for w in self.words[:d]), int(self.counts[d])) for d in range(1, len(self.words) + 1)]


def prefix_counts(ordered: DataFrame, most: int, least: int) -> DataFrame:
    """(lang, phrase, n) of the prefixes of two words or more of partitions of sorted suffixes: whole counts of at least ``least``, and
    parts of those at the ends of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack = Stack(most, least)

        def batch_of(found: list[tuple[str, str, int]]) -> pa.RecordBatch:
            found = [x for x in found if x[1].count(" ") > 1]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "phrase", "n"])

        for batch in batches:
            if len(batch):
                yield batch_of(stack.read(batch.column("lang"), batch.column("phrase"), batch.column("n").to_numpy()))
        if stack.lang is not None:
            yield batch_of(stack.rest())

    return ordered.mapInArrow(run, COUNTED)


def frequent_phrases(documents: DataFrame, most: int = 5, least: int = 100, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``most`` words with a count of at least ``least`` as (lang, phrase, n), and (lang, total) of all words.

    A null language is "und", a null text empty.  Both results are written tables.
    """
    spark = documents.sparkSession
    rows = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    with sized(spark, 4 * size):
        words = materialise(word_counts(rows, block).filter(F.col("phrase").isNull() | (F.col("n") >= least)), "words")
        often = words.filter("phrase is not null")
        dealt = suffixes(rows, frequent_pairs(rows, size, least, block), most, block)
        release(spark)
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = [F.desc("lang"), F.desc("phrase")]
        counted = prefix_counts(dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order), most, least)
        longer = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        bare = lambda df: df.select("lang", F.expr("left(phrase, length(phrase) - 1)").alias("phrase"), "n")
        phrases = materialise(bare(often).unionByName(bare(longer)), "phrases")
    release(spark)
    return phrases, words.filter("phrase is null").select("lang", F.col("n").alias("total"))


def _words(phrase: str = "phrase"):
    return F.split(phrase, " ", -1)


def scored(phrases: DataFrame, totals: DataFrame, share: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of candidates by their weakest cut, but those that a longer one contains nearly as often.

    Decimals of 38 digits hold 1000 a n and l r exactly for corpora of up to 10^17 words.
    """
    cuts = phrases.filter(F.size(_words()) > 1).select("lang", "phrase", F.col("n").alias("a"), F.posexplode(F.slice(_words(), 1, F.size(_words()) - 1)).alias("k", "w"))
    part = lambda start, n: F.array_join(F.slice(_words(), start, n), " ")
    cuts = cuts.select("lang", "phrase", "a", (F.col("k") + 1).alias("k"))
    cuts = cuts.withColumn("first", part(F.lit(1), F.col("k"))).withColumn("rest", part(F.col("k") + 1, F.size(_words())))
    of = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    both = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    above = (F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("total")).cast("decimal(38,0)")
    both = both.withColumn("above", above).withColumn("below", (wide("l") * wide("r")).cast("decimal(38,0)"))
    both = both.withColumn("score", F.expr("above div below"))
    best = both.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
    size = F.size(_words())
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice(_words(), i, m), " "))))
    inner = phrases.filter(size > 2).select("lang", F.col("n").alias("held"), F.explode(F.array_distinct(spans)).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    out = best.join(inner, ["lang", "phrase"], "left").filter(F.col("held").isNull() | (100 * F.col("held") < share * F.col("a")))
    return out.select("lang", "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), F.col("total").alias("n"), F.col("s.score").alias("score"))


def first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their rank; first within salts, so that no task ranks a whole language."""
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    within = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    few = salted.withColumn("nth", within).filter(F.col("nth") <= top).drop("nth", "salt")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))  # of at most SALTS * top rows
    return few.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)


def collocations(documents: DataFrame, most: int = 5, least: int = 100, share: int = 100, top: int = 2000, block: int = BLOCK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``most`` words by their weakest cut.

    Null texts are empty, a null language is "und", repeated rows count each, other columns aren't read, ties go by count
    and then by phrase.  Without words there are no rows.
    """
    spark: SparkSession = documents.sparkSession
    with scope(spark):
        phrases, totals = frequent_phrases(documents, most, least, block)
        ranked = materialise(first_of_each(scored(phrases, totals, share), top), "ranked", up=1)
    discard(phrases)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
