"""Exact counts of 64-bit keys over a whole corpus, shuffled as packed arrays.

A batch sends its distinct keys and their counts as one binary row for each bucket of leading bits, so a frequent key
costs one entry a batch, and every bucket is summed with one sort.  The number of buckets grows with the input.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_U = np.uint64
PACKED = "bucket long, keys binary, counts binary"


def text_bytes(documents: DataFrame) -> int:
    return documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def bucket_bits(size: int, bytes_per_key: float = 6, keys: int = 1 << 20, least: int = 6) -> int:
    """Leading bits that give buckets of about ``keys`` keys for ``size`` bytes of text."""
    return max(least, math.ceil(math.log2(size / bytes_per_key / keys + 1)))


def split_rows(sorted_keys: np.ndarray, bits: int, **arrays: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket of leading bits: the bucket, and the bytes of its stretch of each array."""
    bucket = (sorted_keys >> _U(64 - bits)).astype(np.int64)
    if not len(bucket):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), *(pa.array([], pa.binary()) for _ in arrays)], names=["bucket", *arrays])
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    blob = lambda a: pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * a.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(a))])
    return pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]), *map(blob, arrays.values())], names=["bucket", *arrays])


def packed(keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows of PACKED for sorted distinct ``keys``."""
    return split_rows(keys, bits, keys=keys.astype("<u8"), counts=counts.astype("<u4"))


def summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of one bucket, sorted, and their total counts."""
    keys = np.concatenate([np.frombuffer(b.as_buffer(), dtype="<u8") for b in table.column("keys").combine_chunks()])
    counts = np.concatenate([np.frombuffer(b.as_buffer(), dtype="<u4") for b in table.column("counts").combine_chunks()]).astype(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)
