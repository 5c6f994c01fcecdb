"""Counts of hashed keys as packed arrays.

Tasks sort and sum the keys of a block, cut them into buckets (ranges of the
keys' first bits) and send one row for each bucket. Keys are 64-bit hashes, so
buckets are even whatever the data, and a frequent key is one entry of a block.
A set of keys can be sent to tasks as marks: a fixed number of bits, which may
hold more than the set but never less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, most significant first: sorted keys and
    small counts then compress well."""
    values = np.asarray(values, np.uint64)
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width:]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 8 - data[0]:] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def unpacked(column: pa.ChunkedArray) -> np.ndarray:
    """All packed numbers of a column, one after the other."""
    return np.concatenate([np.zeros(0, np.uint64), *map(unpack, column.to_pylist())])


def merged(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of their values."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.nonzero(np.append(True, keys[1:] != keys[:-1]))[0]
    return (keys[first], *(np.add.reduceat(v[order], first) for v in values))


def bucket_bits(rows: DataFrame, column: str, bucket_bytes: int) -> int:
    """Buckets as a power of two, for about ``bucket_bytes`` of text each."""
    size = rows.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(4, (-(-size // bucket_bytes)).bit_length())


def cut_by_bucket(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, edges) of sorted keys."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    first = np.nonzero(np.append(True, bucket[1:] != bucket[:-1]))[0] if len(keys) else np.zeros(0, np.int64)
    return bucket[first], np.append(first, len(keys))


def bucket_rows(keys: np.ndarray, bits: int, **values: np.ndarray) -> pa.RecordBatch:
    """(bucket, keys, values...) of sorted keys, one row for each bucket."""
    bucket, edge = cut_by_bucket(keys, bits)
    parts = list(zip(edge[:-1], edge[1:]))
    columns = {name: pa.array([pack(x[a:b]) for a, b in parts], pa.binary())
               for name, x in {"keys": keys, **values}.items()}
    return pa.RecordBatch.from_pydict({"bucket": pa.array(bucket), **columns})


def mark_range(keys: np.ndarray, mark_bits: int) -> tuple[int, bytes]:
    """(first byte, bytes) of the marks of sorted keys."""
    bit = (keys >> np.uint64(64 - mark_bits)).astype(np.int64)
    if not len(bit):
        return 0, b""
    begin = int(bit[0] >> 3)
    marks = np.zeros((int(bit[-1] >> 3) - begin + 1) * 8, np.uint8)
    marks[bit - begin * 8] = 1
    return begin, np.packbits(marks, bitorder="little").tobytes()


def joined_marks(ranges: list[tuple[int, bytes]], mark_bits: int) -> np.ndarray:
    marks = np.zeros(1 << mark_bits - 3, np.uint8)
    for begin, some in ranges:
        marks[begin:begin + len(some)] |= np.frombuffer(some, np.uint8)
    return marks


def marked(keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Which keys are marked."""
    bit = keys >> np.uint64(64 - (len(marks) * 8).bit_length() + 1)
    return marks[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1
