"""Best-fit packing by exact-complement hashing.

Only the *histogram* of lengths decides a packing, and it has at most ``capacity`` entries however many pieces there
are.  The plan is made on that histogram.  Lengths are taken longest first.  The sums of the lengths at hand are indexed:
single lengths, pairs (by sum, with the number of pairs still available), and triples as the length in hand and a pair.
An opened sequence whose gap equals a single, pair or triple that holds the length in hand is closed with it, singles
before pairs before triples, under the availability counts; only a length that completes no gap goes by best fit, into
the fullest sequence with room or a new one.  Equal sequences are handled as one group, so the steps depend on the
lengths and not on the pieces.  The plan comes out as runs "pieces of length L with ranks lo..hi go to sequences base..,
one each, at this offset"; pieces get their rank within their length by a salted row number, so one very common length
is dealt over many tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.llm import text as tx
from lexmill.llm.scratch import materialise, widened

PLAN_COLUMNS = ("length", "lo", "hi", "base", "offset")


class Sums:
    """Which pair sums the pieces at hand can make: ``number[s]`` pairs of available lengths, the pairs by sum."""

    def __init__(self, left: np.ndarray, capacity: int):
        self.left, self.capacity = left, capacity
        have = np.flatnonzero(left)
        a, b = np.meshgrid(have, have, indexing="ij")
        ok = (a >= b) & (a + b <= capacity)
        a, b = a[ok], b[ok]
        order = np.lexsort((a, a + b))  # most even pairs first: short pieces stay for later gaps
        self.longer = a[order]
        self.start = np.searchsorted((a + b)[order], np.arange(capacity + 2))
        ok = (a != b) | (left[a] >= 2)
        self.number = np.bincount((a + b)[ok], minlength=capacity + 1)

    def take(self, length: int, n: int) -> None:
        """``n`` pieces of ``length`` are used up."""
        before, now = int(self.left[length]), int(self.left[length]) - n
        self.left[length] = now
        if before >= 2 > now and 2 * length <= self.capacity:
            self.number[2 * length] -= 1
        if before >= 1 > now:
            sums = np.flatnonzero(self.left) + length
            self.number[sums[sums <= self.capacity]] -= 1

    def pair(self, total: int) -> tuple[int, int] | None:
        a = self.longer[self.start[total] : self.start[total + 1]]
        b = total - a
        good = np.flatnonzero((self.left[a] >= 1 + (a == b)) & (self.left[b] >= 1))
        return (int(a[good[0]]), int(b[good[0]])) if len(good) else None


class Plan:
    """Runs that place every piece, and how many sequences were closed by a single, a pair and a triple."""

    def __init__(self, counts: dict[int, int], capacity: int):
        if any(not 1 <= length <= capacity for length in counts):
            raise ValueError(f"lengths must lie in 1..{capacity}")
        self.capacity, self.sequences = capacity, 0
        self.closed = {1: 0, 2: 0, 3: 0}
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.used: dict[int, int] = defaultdict(int)
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> groups (first sequence, number)
        self.bins = np.zeros(capacity + 1, dtype=np.int64)  # room -> sequences
        left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            left[length] = n
        self.sums = Sums(left, capacity)
        for length in range(capacity, 0, -1):
            while left[length]:
                if not self._complete(length):
                    self._best_fit(length)

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame(self.rows, columns=list(PLAN_COLUMNS)).astype("int64")

    def _complete(self, length: int) -> bool:
        """Close sequences whose gap is ``length``, or it and one or two other lengths."""
        left = self.sums.left
        if self.bins[length]:
            return self._close(length, (length,))
        rooms = np.flatnonzero(self.bins[length + 1 :]) + length + 1
        for rest in rooms[left[rooms - length] >= 1 + (rooms == 2 * length)] - length:
            return self._close(int(rest) + length, (length, int(rest)))
        for room in rooms[self.sums.number[rooms - length] > 0]:
            left[length] -= 1  # in hand
            two = self.sums.pair(int(room) - length)
            left[length] += 1
            if two:
                return self._close(int(room), (length, *two))
        return False

    def _close(self, room: int, parts: tuple[int, ...]) -> bool:
        n = int(min(self.bins[room], *(self.sums.left[x] // parts.count(x) for x in parts)))
        offset = self.capacity - room
        for i, part in enumerate(parts, 1):
            self._put(part, room, n, offset, leave=i == len(parts))
            offset += part
        self.closed[len(parts)] += n
        return True

    def _best_fit(self, length: int) -> None:
        rooms = np.flatnonzero(self.bins[length:])
        if len(rooms):
            room = int(rooms[0]) + length
        else:
            room, each = self.capacity, self.capacity // length
            n = int(self.sums.left[length])
            fresh = n if each == 1 else max(1, n // (2 * each))
            self._add(room, self.sequences, fresh)
            self.sequences += fresh
            if room == length:
                self.closed[1] += fresh
        n = int(min(self.bins[room], self.sums.left[length]))
        for base, bins in self._put(length, room, n, self.capacity - room):
            self._add(room - length, base, bins)

    def _add(self, room: int, base: int, bins: int) -> None:
        if room:
            self.open[room].append((base, bins))
            self.bins[room] += bins

    def _put(self, length: int, room: int, n: int, offset: int, leave: bool = True) -> list[tuple[int, int]]:
        """One piece of ``length`` into each of the last ``n`` sequences of a room; with ``leave`` they leave it."""
        groups, taken, at = self.open[room], [], len(self.open[room]) - 1
        while n:
            base, bins = groups[at]
            m = min(n, bins)
            taken.append((base + bins - m, m))
            lo = self.used[length]
            self.rows.append((length, lo, lo + m, base + bins - m, offset))
            self.used[length] += m
            self.sums.take(length, m)
            if leave:
                self.bins[room] -= m
                if m == bins:
                    groups.pop()
                else:
                    groups[at] = (base, bins - m)
            n, at = n - m, at - 1
        return taken


def packing_plan(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Runs that place every piece.  Lengths must lie in 1..capacity."""
    return Plan({k: v for k, v in counts.items() if v}, capacity).frame()


def _placer(plan: pd.DataFrame, capacity: int):
    plan = plan.sort_values(["length", "lo"], kind="stable")
    cols = {c: plan[c].to_numpy() for c in PLAN_COLUMNS}
    span = int(cols["hi"].max(initial=0)) + 1
    keys = cols["length"].astype(object) * span + cols["lo"] if span * (capacity + 1) >= 2**62 else cols["length"] * span + cols["lo"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            at = np.searchsorted(keys, length * span + rank, side="right") - 1
            bin_id = cols["base"][at] + rank - cols["lo"][at]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bin_id, pa.int64()), pa.array(cols["offset"][at], pa.int64())], names=["kept", "sequence_id", "offset"])

    return place


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = 2048, rows_per_salt: int = 250_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` (long) to ``pieces``.

    Every row gets a place; repeated rows are places of their own; columns already called ``sequence_id`` or ``offset``
    are replaced, others are kept whatever their names.  Lengths outside 1..capacity (or null) raise.  An empty table
    gives an empty table.  ``pieces`` must be a table that gives the same rows each time it is read (materialise it
    first).
    """
    pieces = pieces.drop("sequence_id", "offset")
    columns = [F.col(f"`{c}`") for c in pieces.columns]
    length = F.col(f"`{length_col}`").cast("long")
    counts = pieces.groupBy(length.alias("n")).count().collect()  # at most `capacity` rows, else raises below
    plan = packing_plan({int(r["n"]) if r["n"] is not None else -1: r["count"] for r in counts}, capacity)
    salts = max(64, -(-sum(r["count"] for r in counts) // rows_per_salt))
    salted = pieces.select(F.struct(*columns).alias("kept"), length.alias("len"), F.pmod(F.xxhash64(*columns), F.lit(salts)).alias("salt"))
    per = salted.groupBy("len", "salt").count()
    before = per.select("len", "salt", (F.sum("count").over(Window.partitionBy("len").orderBy("salt")) - F.col("count")).alias("before"))
    within = F.row_number().over(Window.partitionBy("len", "salt").orderBy("kept")) - 1
    ranked = salted.withColumn("row", within).join(before, ["len", "salt"]).select("kept", "len", (F.col("before") + F.col("row")).cast("long").alias("rank"))
    schema = widened(ranked.select("kept").schema, ("sequence_id", "long"), ("offset", "long"))
    return ranked.mapInArrow(_placer(plan, capacity), schema).select("kept.*", "sequence_id", "offset")


def token_pieces(documents: DataFrame, encoder, capacity: int = 2048, end_id: int = 0, forget: bool = False) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32.

    A document is its ids followed by ``end_id``; only those longer than ``capacity`` are cut, and then all pieces but
    the first are full.  Null and empty texts are the single ``end_id``.  With ``forget`` a task leaves no pieces in the
    encoder of its worker.
    """
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            keys = batch.column(0)
            for lo, hi, ids, ptr in encode.blocks(batch.column(1)):
                size = np.diff(ptr) + 1
                ends = np.cumsum(size)
                whole = np.full(int(ends[-1]), end_id, dtype="<u4")
                inner = np.ones(len(whole), dtype=bool)
                inner[ends - 1] = False
                whole[inner] = ids[ptr[0] : ptr[-1]]
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(hi - lo), pieces)
                k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = (size - 1) % capacity + 1
                stop = first[row] + k * capacity
                start = np.where(k > 0, stop - capacity, 0)
                at = (ends - size)[row]
                data = memoryview(whole.view(np.uint8))
                crc = [zlib.crc32(data[a:b]) for a, b in zip(((at + start) * 4).tolist(), ((at + stop) * 4).tolist())]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(lo + row)), pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(stop - start, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        if forget:
            encode.forget()

    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return documents.select("doc_id", "text").mapInArrow(tx.returning(run), schema)


def pack_documents(spark: SparkSession, documents: DataFrame, encoder, capacity: int = 2048, forget: bool = False) -> DataFrame:
    """Tokenise, cut and pack all documents."""
    return pack(materialise(token_pieces(documents, encoder, capacity, forget=forget), "pieces"), "length", capacity)
