"""Exact n-gram Jaccard join and its components, by token-combination prefixes.

Tokens are distinct word shingles of a document; documents with equal sets are one *node*.  Document frequencies of all
shingles are counted over all documents, and those above ``rare_max`` form the frequent class.  The class is held as a
bitmap of hash cells of fixed size: a rare token in the cell of a frequent one counts as frequent everywhere, which
changes no result, for the argument below holds for any two classes.  In the order "rare before frequent" a pair over the threshold either

* shares a rare token within both prefixes -- rare tokens are indexed singly -- or
* shares no rare token at all.  Then all rare tokens of both are mismatches, and of the mismatches a pair may have,
  ``(n_x + n_y) * (1 - t) / (1 + t)``, only ``g_x + g_y`` are left for the frequent tokens, with
  ``g = n * (1 - t) / (1 + t) - rare``.  The prefix is extended over the frequent tokens, dealt into ``m`` hash classes
  with ``m > g_x + g_y``; one class at least must agree wholly, so the *combination* of all its tokens is indexed.  m is
  the power of two that fits a pair, and a document writes every power that may fit a partner.  The class that agrees
  may be empty in both, so a document whose tokens fill no more classes than a pair may have mismatches also writes
  deals into twice as many classes, and so on until they fill more: the deal at which the first of a pair stops is
  written by both, and there a class that is not empty agrees.

Candidates are never all pairs of a group: each index entry first proposes its most central member (largest g) to the
others, links join components, and only members that are still in different components, and that reach a partner at the
entry's level, are paired.  An entry of a rare token has at most ``rare_max`` members; one of a combination needs unlike
members whose whole class agrees to have many such pairs.  Every candidate is verified on the texts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import text as tx
from lexmill.llm.counting import bucket_bits, split_rows, text_bytes
from lexmill.llm.scratch import discard, materialise, release, scope, sized
from lexmill.operators.components import connected_components

_U = np.uint64
RARE_MAX = 8
CELL_BITS = 26  # of the bitmap of frequent tokens: 8 MB
SLOT_BITS = 10
HOT_NODES = 1024
TOKENS_PER_BUCKET = 1 << 20


def shingle_hashes(words: tx.Words, row: int, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of one row; with fewer words the whole sequence is one."""
    own = words.hashes[words.ptr[row] : words.ptr[row + 1]]
    n = len(own)
    if n == 0:
        return np.zeros(0, dtype=_U)
    k = min(size, n)
    at = np.arange(n - k + 1)
    return tx.distinct(tx.run_hashes(own, at, at + k))


def _rows(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    for lo, hi, _, _, words in tx.word_blocks(column, lower=True):
        counts = np.diff(words.ptr)
        if (counts >= size).all():  # all windows of the block at once
            starts, hashes = tx.window_hashes(words.hashes, words.ptr, size)
            ptr = np.searchsorted(starts, words.ptr)
            for i in range(hi - lo):
                yield tx.distinct(hashes[ptr[i] : ptr[i + 1]])
        else:
            for i in range(hi - lo):
                yield shingle_hashes(words, i, size)


def _node(tokens: np.ndarray) -> int | None:
    if not len(tokens):
        return None
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def document_nodes(documents: DataFrame, size: int) -> DataFrame:
    """key (the row's doc_id), n_shingles and node (a 64-bit digest of the set; null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(t), _node(t)) for t in _rows(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in sets], pa.int64()), pa.array([k for _, k in sets], pa.int64())], names=["doc_id", "n_shingles", "node"])

    key = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(tx.returning(run), f"doc_id {key}, n_shingles long, node long")


def frequent_cells(documents: DataFrame, size: int, rare_max: int = RARE_MAX, cell_bits: int = CELL_BITS, text_size: int | None = None) -> np.ndarray:
    """Bitmap of the cells (leading bits of the hash) that hold a token of more than ``rare_max`` documents.

    Frequencies are over all documents.  Each batch sends its tokens as packed arrays, one for each bucket of leading
    bits, and every bucket is counted with one sort.  The bitmap has 2**cell_bits bits, whatever the corpus.
    """
    bits = bucket_bits(text_bytes(documents) if text_size is None else text_size, keys=TOKENS_PER_BUCKET, least=8)
    shift, low = _U(64 - bits), _U(32 - min(bits, 32))
    slot_bits = min(SLOT_BITS, cell_bits - 3)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            for tokens in _rows(batch.column(0), size):
                held.append(tokens)
                n += len(tokens)
                if n >= 4 << 20:
                    yield _packed(held)
                    held, n = [], 0
            if n:
                yield _packed(held)

    def _packed(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.sort(np.concatenate(held))
        return split_rows(tokens, bits, blob=((tokens << _U(bits)) >> _U(32)).astype("<u4"))

    def count(key: tuple, table: pa.Table) -> pa.Table:
        rest = np.sort(np.concatenate([np.frombuffer(b.as_buffer(), dtype="<u4") for b in table.column("blob").combine_chunks()]))
        first = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
        often = rest[first[np.diff(np.append(first, len(rest))) > rare_max]]
        token = (_U(key[0].as_py()) << shift) | (often.astype(_U) << low)
        cells = tx.distinct(token >> _U(64 - cell_bits))
        rows = split_rows(cells << _U(64 - cell_bits), slot_bits, cells=cells.astype("<u4"))
        return pa.Table.from_batches([rows]).rename_columns(["slot", "cells"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        cells = np.concatenate([np.frombuffer(b.as_buffer(), dtype="<u4") for b in table.column("cells").combine_chunks()])
        marks = np.zeros(1 << (cell_bits - slot_bits), dtype=bool)
        marks[cells & np.uint32(len(marks) - 1)] = True
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int64()), "bits": [np.packbits(marks, bitorder="little").tobytes()]})

    blobs = documents.select("text").mapInArrow(tx.returning(emit), "bucket long, blob binary")
    counted = blobs.groupBy("bucket").applyInArrow(count, "slot long, cells binary")
    out = np.zeros(1 << (cell_bits - 3), dtype=np.uint8)
    each = len(out) >> slot_bits
    for r in counted.groupBy("slot").applyInArrow(merge, "slot long, bits binary").toLocalIterator():  # 2**cell_bits bits in all
        out[r["slot"] * each : (r["slot"] + 1) * each] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


class _Prefix:
    """Index entries of a set: tokens and combinations, each with its level in the low bits."""

    def __init__(self, threshold: Fraction, frequent: np.ndarray):
        self.t, self.frequent = threshold, frequent
        self.shift = _U(65 - len(frequent).bit_length() - 3)
        self.c = float((1 - threshold) / (1 + threshold))

    def level(self, room: float) -> int:
        return max(0, math.ceil(math.log2(math.floor(room + 1e-9) + 1)))

    def entries(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Entries, their places among the single tokens (-1 for combinations), and g."""
        n = len(tokens)
        cell = (tokens >> self.shift).astype(np.int64)
        common = (self.frequent[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
        rare, often = tokens[~common], tokens[common]
        miss = n - math.ceil(self.t * n)
        g = n * self.c - len(rare)
        singles = (tx.mix(rare[: miss + 1]) << _U(6)) | _U(63)
        place = np.arange(len(singles), dtype=np.int32)
        most = g + self.c * n / float(self.t)
        if len(rare) > miss or most < 0 or not len(often):
            return singles, place, g
        out = [singles]
        spread = tx.mix(often)
        with np.errstate(over="ignore"):
            for j in range(self.level(most) + 1):
                bound = min((1 << j) - 1, math.floor(most + 1e-6))  # mismatches that a pair of this level may have
                for fine in range(j, 33):
                    cell = (spread >> _U(32)) & _U((1 << fine) - 1)
                    order = np.argsort(cell, kind="stable")
                    cells, value = cell[order], spread[order]
                    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
                    total = np.add.reduceat(tx.mix(value ^ _U(0x5851F42D4C957F2D)), first)
                    name = tx.mix(total ^ tx.mix(cells[first] + _U((fine - j << 48) + (j << 40))))
                    out.append((name << _U(6)) | _U(j))
                    if len(first) > bound:
                        break
        whole = np.concatenate(out)
        return whole, np.concatenate([place, np.full(len(whole) - len(place), -1, dtype=np.int32)]), g


def index_entries(documents: DataFrame, size: int, threshold: Fraction, frequent: np.ndarray) -> DataFrame:
    """(entry, node, n, place, g) of each distinct set; the level of an entry is in its six low bits, 63 for single tokens.

    A task writes a set once, however many copies it meets; copies in other tasks repeat the same rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(frequent)  # 2**CELL_BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _Prefix(threshold, shared.value)
        seen: set[int] = set()
        for batch in batches:
            held: list[tuple] = []
            n = 0
            for tokens in _rows(batch.column(0), size):
                node = _node(tokens)
                if node is None or node in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(node)
                own, place, g = make.entries(tokens)
                held.append((own.astype(np.int64), np.full(len(own), node), np.full(len(own), len(tokens), dtype=np.int32), place, np.full(len(own), g, dtype=np.float32)))
                n += len(own)
                if n >= 200_000:
                    yield _batch(held)
                    held, n = [], 0
            if held:
                yield _batch(held)

    def _batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["entry", "node", "n", "place", "g"])

    return documents.select("text").mapInArrow(tx.returning(run), "entry long, node long, n int, place int, g float")


def _texts_of(documents: DataFrame, heads: DataFrame, size: int) -> DataFrame:
    """(node, text): one text for each node of ``heads``, that of a row with the head's doc_id and this very set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([_node(t) for t in _rows(batch.column(1), size)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["node", "text"]).filter(pc.equal(own, batch.column(0)))

    wanted = heads.select(F.col("head"), F.col("node")).hint("shuffle_hash")
    joined = documents.join(wanted, F.col("doc_id").eqNullSafe(F.col("head"))).select("node", "text")
    return joined.mapInArrow(tx.returning(run), "node long, text string").dropDuplicates(["node"])


def _candidates(shared: DataFrame, threshold: Fraction) -> DataFrame:
    """Distinct pairs (a, b) of a table of shared entries, without those that can't meet the threshold.

    Single tokens are the rare tokens of least hash, so up to the last one that a pair shares, at places pa and pb, all
    rare tokens of both are known: of pa + 1 and pb + 1 tokens ``s`` are shared and the others are mismatches.
    """
    p, q = threshold.numerator, threshold.denominator
    sized = shared.filter((F.col("na") * q >= F.col("nb") * p) & (F.col("nb") * q >= F.col("na") * p))
    pairs = sized.groupBy("a", "b", "na", "nb").agg(F.min("pa").alias("combined"), F.count_if(F.col("pa") >= 0).alias("s"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    missed = F.col("pa") + F.col("pb") + 2 - 2 * F.col("s")
    may = (F.col("combined") < 0) | (missed * (p + q) <= (F.col("na") + F.col("nb")) * (q - p))
    return pairs.filter(may).select("a", "b")


def _verified(pairs: DataFrame, documents: DataFrame, heads: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """Those pairs (a, b) whose sets meet the threshold.  Only texts of nodes in a pair are moved."""
    p, q = threshold.numerator, threshold.denominator
    pairs = materialise(pairs, "pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = materialise(_texts_of(documents, heads.join(nodes, "node", "left_semi"), size), "texts")
    release(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.zeros(0, dtype=_U))
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            right = _rows(batch.column(3), size)
            for i, y in enumerate(right):
                if last[0] != a[i]:
                    last = (a[i], next(_rows(batch.column(2).slice(i, 1), size)))
                x = last[1]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if q * both >= p * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    right = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    left = right.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    links = materialise(left.select("a", "b", "text_a", "text_b").mapInArrow(tx.returning(run), "a long, b long"), "links")
    discard(texts)
    discard(pairs)
    release(documents.sparkSession)
    return links


def _components(links: DataFrame) -> DataFrame:
    found = connected_components(links)
    out = materialise(found, "components")
    discard(found)
    return out


def near_duplicate_components(documents: DataFrame, size: int = 5, threshold: Fraction | str = "4/5", rare_max: int = RARE_MAX, cell_bits: int = CELL_BITS) -> DataFrame:
    """doc_id, n_shingles, node, component_id of every row of ``documents`` (columns doc_id and text; others play no part).

    Words are split at ASCII white space with A-Z lower-cased.  Two rows link if the Jaccard similarity of their shingle
    sets is at least ``threshold``, decided in exact integers.  component_id is the smallest doc_id reachable by links.
    Rows without words (null, empty or blank text) have n_shingles 0 and link with nothing; their component_id is their
    own doc_id.  Rows with a null doc_id take part, but a null is never the smallest unless it is alone.  Repeated rows
    are rows of their own in one component.  An empty table gives an empty table.
    """
    threshold = Fraction(threshold)
    documents = documents.select("doc_id", "text")
    text_size = text_bytes(documents)
    with scope(documents.sparkSession), sized(documents.sparkSession, 2 * text_size):
        rows = materialise(document_nodes(documents, size), "nodes", up=1)
        heads = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("copies"))
        heads = materialise(heads, "heads")  # written: a semi-join would be pushed below the aggregate, and deal all copies by node
        frequent = frequent_cells(documents, size, rare_max, cell_bits, text_size)
        release(documents.sparkSession)
        entries = materialise(index_entries(documents, size, threshold, frequent), "entries")
        shared = entries.groupBy("entry").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("entry")
        index = materialise(entries.join(shared, "entry").distinct(), "index")
        discard(entries)
        release(documents.sparkSession)
        lead = index.groupBy("entry").agg(F.max(F.struct("g", "node", "n", "place")).alias("s")).select("entry", F.col("s.node").alias("a"), F.col("s.n").alias("na"), F.col("s.place").alias("pa"))
        star = _candidates(index.join(lead, "entry").filter("node <> a").select("a", "na", "pa", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb")), threshold)
        links = _verified(star, documents, heads, size, threshold)
        release(documents.sparkSession)
        comp = _components(links)
        placed = index.join(comp, "node", "left").select("entry", "node", "n", "place", "g", F.coalesce("component", "node").alias("comp"))
        level = F.col("entry").bitwiseAND(F.lit(63))
        cells = F.pow(F.lit(2.0), level)
        # Members that reach no partner of the entry at its level go before any are paired.  At level 0 none stay: there all
        # frequent tokens are equal, so a pair links if and only if gx + gy >= 0, and then both link with the entry's lead.
        split = placed.groupBy("entry").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("g").alias("most")).filter("lo < hi").select("entry", "most")
        reach = F.col("g").cast("double") + F.col("most").cast("double") > cells / 2 - F.lit(1e-3) - (F.abs("g") + F.abs("most")) * 1e-6
        placed = materialise(placed.join(split, "entry").filter((level == 63) | ((level > 0) & reach)).drop("most"), "placed")
        size_of = placed.groupBy("entry", "comp").count()
        main = size_of.groupBy("entry").agg(F.max(F.struct("count", "comp")).alias("s")).select("entry", F.col("s.comp").alias("main"))
        marked = placed.join(main, "entry")
        left = marked.filter("comp <> main").select("entry", F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("g").alias("gx"), F.col("n").alias("nx"), F.col("place").alias("px"), "main")
        right = placed.select("entry", F.col("node").alias("y"), F.col("comp").alias("cy"), F.col("g").alias("gy"), F.col("n").alias("ny"), F.col("place").alias("py"))
        room = F.col("gx").cast("double") + F.col("gy").cast("double")
        # Level j serves pairs with 2**(j-1) <= room < 2**j (level 0: 0 <= room < 1); the margin covers float rounding.
        slack = F.lit(1e-3) + (F.abs("gx") + F.abs("gy")) * 1e-6
        fits = (level == 63) | ((room > -slack) & (room < cells + slack) & ((level == 0) | (room > cells / 2 - slack)))
        cross = left.join(right, "entry").filter((F.col("cx") != F.col("cy")) & ((F.col("cy") == F.col("main")) | (F.col("x") < F.col("y"))) & fits)
        turn = F.col("x") < F.col("y")
        side = lambda first, second: F.when(turn, F.col(first)).otherwise(F.col(second))
        cross = _candidates(cross.select(side("x", "y").alias("a"), side("nx", "ny").alias("na"), side("px", "py").alias("pa"), side("y", "x").alias("b"), side("ny", "nx").alias("nb"), side("py", "px").alias("pb")), threshold)
        more = _verified(cross, documents, heads, size, threshold)
        discard(index)
        discard(placed)
        final = comp if more.isEmpty() else _components(links.unionByName(more))
        named = heads.join(final, "node", "left").select("node", "head", "copies", F.coalesce("component", "node").alias("component"))
        low = named.groupBy("component").agg(F.min("head").alias("component_id"))
        ids = materialise(named.join(low, "component").select("node", "copies", "component_id"), "ids", up=1)
    return _with_ids(rows, ids).select("doc_id", "n_shingles", "node", F.coalesce("component_id", "doc_id").alias("component_id"))


def _with_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with the component_id of their node.  Nodes of very many rows are looked up by broadcast, not dealt by key."""
    total = rows.count()
    hot = ids.filter(F.col("copies") * HOT_NODES > total).select(F.col("node").alias("hot"), F.col("component_id").alias("hot_id"))  # under HOT_NODES rows
    looked = rows.join(F.broadcast(hot), F.col("node") == F.col("hot"), "left")
    many = looked.filter("hot is not null").select("doc_id", "n_shingles", "node", F.col("hot_id").alias("component_id"))
    rest = looked.filter("hot is null").select("doc_id", "n_shingles", "node").join(ids.select("node", "component_id"), "node", "left")
    return many.unionByName(rest)
