"""Removal of repeated passages by level-wise doubling.

A window is ``window`` consecutive words of one document.  It is represented at length 13, then 25, then 50 (a quarter,
a half and the whole, rounded up) by the least hash of the word runs of that length inside it.  Equal windows have
equal representatives, so only windows whose representative also occurs in another document go on to twice the length,
until none are left or the whole window is compared:

1. length 13: about one representative in twenty words is written, over all documents;
2. length 25: windows that survive and share a representative travel as one *run*, with the hash of all its words;
3. length 50: a run that also occurs whole in a smaller document is settled.  Where unsettled runs of several documents
   share a representative, their windows are compared one by one.  A settled run need not be compared: the smallest
   document with that run has it unsettled and writes its windows.

Hot representatives are pre-aggregated to their least and greatest doc_id, never gathered.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import text as tx
from lexmill.llm.scratch import discard, materialise, release, scope, shielded, sized

_U = np.uint64


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` consecutive values."""
    done, low = 1, values
    while 2 * done <= size:
        low = np.minimum(low[: len(low) - done], low[done:])
        done *= 2
    if done < size and len(low):
        step = size - done
        low = np.minimum(low[: len(low) - step], low[step:]) if len(low) > step else low[:0]
    return low


def _representatives(values: np.ndarray, length: int, window: int) -> np.ndarray:
    """Least hash of the runs of ``length`` words in each window of a sequence of word hashes."""
    if len(values) < window:
        return np.zeros(0, dtype=_U)
    at = np.arange(len(values) - length + 1)
    return sliding_min(tx.run_hashes(values, at, at + length), window - length + 1)


def _scan(documents: DataFrame, window: int, length: int) -> DataFrame:
    """key, tk, n_words, the digest of all words, and the distinct representatives of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, digests, reps = [], [], []
            for lo, hi, raw, offsets, words in tx.word_blocks(batch.column(1)):
                found = _representatives(words.hashes, length, window)  # those across two rows are left out below
                data = raw.tobytes()
                for i in range(hi - lo):
                    a, b = int(words.ptr[i]), int(words.ptr[i + 1])
                    n_words.append(b - a)
                    digests.append(hashlib.sha256(b" ".join(data[offsets[i] : offsets[i + 1]].split())).hexdigest())
                    reps.append(tx.distinct(found[a : b - window + 1]) if b - a >= window else found[:0])
            ptr = np.concatenate([[0], np.cumsum([len(r) for r in reps])]).astype(np.int32)
            flat = np.concatenate(reps).astype(np.int64) if reps else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n_words, pa.int64()), pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(ptr), pa.array(flat))], names=["doc_id", "tk", "n_words", "digest", "reps"])

    key = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", "tk").mapInArrow(tx.returning(run), f"doc_id {key}, tk long, n_words long, digest string, reps array<long>")


def _runs(rows: DataFrame, window: int, first: int, second: int) -> DataFrame:
    """Runs of windows that survive the first length and share a representative of the second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            at: list[int] = []
            out: dict[str, list] = {k: [] for k in ("rep", "lo", "hi", "whole")}
            for b_lo, b_hi, _, _, words in tx.word_blocks(batch.column(1)):
                for i in range(b_hi - b_lo):
                    own = words.hashes[words.ptr[i] : words.ptr[i + 1]]
                    if len(own) < window:
                        continue
                    live = np.isin(_representatives(own, first, window), lists[b_lo + i].values.to_numpy().astype(_U))
                    if not live.any():
                        continue
                    rep = _representatives(own, second, window)
                    differs = rep[1:] != rep[:-1]
                    lo = np.flatnonzero(live & np.concatenate([[True], ~live[:-1] | differs]))
                    hi = np.flatnonzero(live & np.concatenate([~live[1:] | differs, [True]])) + 1
                    at += [b_lo + i] * len(lo)
                    for k, v in (("rep", rep[lo]), ("lo", lo), ("hi", hi), ("whole", tx.run_hashes(own, lo, hi + window - 1))):
                        out[k].append(v.astype(np.int64))
            if at:
                index = pa.array(at)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(2).take(index), *(pa.array(np.concatenate(v)) for v in out.values())], names=["doc_id", "tk", *out])

    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "tk", "hits").mapInArrow(tx.returning(run), f"doc_id {key}, tk long, rep long, lo long, hi long, whole long")


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """Start and hash of each window of the runs listed in ``open``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            for b_lo, b_hi, _, _, words in tx.word_blocks(batch.column(1)):
                at, start, hashes = [], [], []
                for i in range(b_hi - b_lo):
                    own = words.hashes[words.ptr[i] : words.ptr[i + 1]]
                    spans = lists[b_lo + i].values
                    p = np.concatenate([np.arange(a, b) for a, b in zip(spans.field("lo").to_numpy(), spans.field("hi").to_numpy())])
                    at += [b_lo + i] * len(p)
                    start.append(p)
                    hashes.append(tx.run_hashes(own, p, p + window).astype(np.int64))
                index = pa.array(at)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(2).take(index), pa.array(np.concatenate(start)), pa.array(np.concatenate(hashes))], names=["doc_id", "tk", "p", "w"])

    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "tk", "open").mapInArrow(tx.returning(run), f"doc_id {key}, tk long, p long, w long")


def _in_several(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` occurs under more than one doc_id."""
    several = rows.groupBy(key).agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select(key)
    return rows.join(materialise(several, "several"), key)  # written, so that a hot key of the join can be split


def _spans(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("doc_id", "tk").agg(F.collect_list(F.struct("lo", "hi")).alias(name))


def repeated_windows(documents: DataFrame, window: int = 50) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scan of all rows, rows with candidates, intervals of window starts to remove by doc_id and tk)."""
    first, second = math.ceil(window / 4), math.ceil(window / 2)
    spark = documents.sparkSession
    scan = materialise(_scan(documents, window, first), "scan")
    words = scan.agg(F.sum("n_words")).first()[0] or 0
    with scope(spark), sized(spark, 8 * words):
        entry = scan.filter("doc_id is not null").select("doc_id", "tk", F.explode("reps").alias("rep"))
        hits = _in_several(entry, "rep").groupBy("doc_id", "tk").agg(F.collect_set("rep").alias("hits"))  # of one text
        hits = materialise(hits, "hits")
        release(spark)
        rows = materialise(documents.join(hits.hint("shuffle_hash"), ["doc_id", "tk"]), "candidates", up=1)
        discard(hits)
        release(spark)
        runs = materialise(_runs(rows, window, first, second), "runs")
        kept = materialise(_in_several(runs, "rep"), "runs")
        discard(runs)
        release(spark)
        earliest = materialise(kept.groupBy("whole").agg(F.min("doc_id").alias("first_doc")), "earliest")
        judged = materialise(kept.join(earliest, "whole"), "judged")
        discard(earliest)
        discard(kept)
        # Equal windows have equal representatives: only where unsettled runs of several documents share one is there more to compare.
        unsettled = _in_several(judged.filter("first_doc = doc_id").select("doc_id", "tk", "rep", "lo", "hi"), "rep")
        release(spark)
        single = materialise(_windows(rows.join(_spans(unsettled, "open").hint("shuffle_hash"), ["doc_id", "tk"]), window), "windows")
        release(spark)
        owner = materialise(single.groupBy("w").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("w", "a"), "owners")
        ones = single.join(owner, "w").filter("a < doc_id").select("doc_id", "tk", F.col("p").alias("lo"), (F.col("p") + 1).alias("hi"))
        settled = judged.filter("first_doc < doc_id").select("doc_id", "tk", "lo", "hi")
        gone = materialise(_spans(settled.unionByName(ones), "gone"), "intervals", up=1)
        for table in (judged, single, owner):
            discard(table)
        release(spark)
    return scan, rows, gone


def _cut_batches(window: int, want_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            lists = batch.column(names.index("gone"))
            n_words, n_gone, digests, texts = [], [], [], []
            text = batch.column(names.index("text")).fill_null("")
            for i in range(len(batch)):
                words = text[i].as_py().encode().split()
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                own = lists[i].values
                np.add.at(cover, own.field("lo").to_numpy(), 1)
                np.add.at(cover, own.field("hi").to_numpy() + window - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                n_words.append(len(words))
                n_gone.append(int(gone.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode())
            if want_text:
                cols = [(n, batch.column(k) if n != "text" else pa.array(texts, pa.string())) for k, n in enumerate(names) if n != "gone"]
            else:
                cols = [("doc_id", batch.column(names.index("doc_id"))), ("n_words", pa.array(n_words, pa.int64())), ("n_removed", pa.array(n_gone, pa.int64())), ("kept_sha256", pa.array(digests))]
            yield pa.RecordBatch.from_arrays([c for _, c in cols], names=[n for n, _ in cols])

    return run


def repeated_passages(documents: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row (columns doc_id and text; others play no part).

    A word is removed if a window that covers it also starts in a row with a smaller doc_id; windows are judged on the
    input.  Null, empty and short texts lose nothing.  A null doc_id is no document's smaller one, and its row loses
    nothing.  Rows with the same doc_id remove nothing from each other, and each is returned.
    """
    documents = documents.select("doc_id", "text").withColumn("tk", F.xxhash64("text"))
    scan, rows, gone = repeated_windows(documents, window)
    key = documents.schema["doc_id"].dataType.simpleString()
    cut = rows.select("doc_id", "text", "tk").join(gone, ["doc_id", "tk"]).select("doc_id", "text", "gone").mapInArrow(tx.returning(_cut_batches(window, False)), f"doc_id {key}, n_words long, n_removed long, kept_sha256 string")
    rest = scan.join(gone.select("doc_id", "tk"), ["doc_id", "tk"], "left_anti").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("digest").alias("kept_sha256"))
    return rest.unionByName(cut)


def without_repeated_passages(documents: DataFrame, window: int = 50) -> DataFrame:
    """``documents`` with repeated passages cut out of the text; texts that lose words have the others joined by one space.

    All columns and rows are kept, whatever their names, also rows left without words.
    """
    documents, restore = shielded(documents, "doc_id", "text")
    names = documents.columns
    keyed = documents.withColumn("tk", F.xxhash64("text"))
    _, rows, gone = repeated_windows(keyed, window)
    schema = documents.schema
    cut = rows.select(*names, "tk").join(gone, ["doc_id", "tk"]).select(*names, "gone").mapInArrow(tx.returning(_cut_batches(window, True)), schema)
    rest = keyed.join(gone.select("doc_id", "tk").hint("shuffle_hash"), ["doc_id", "tk"], "left_anti").select(*names)
    return restore(rest.unionByName(cut))
