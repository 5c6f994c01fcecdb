"""Best-fit packing by bin completion.

Documents are tokenized whole; longer ones are cut into full pieces, the first
of which may be shorter. Pieces of equal length are interchangeable, so the
packing problem is a table of at most ``SIZE`` (length, count) rows, which is
all that the driver sees. It is solved there by branch and bound: the largest
remaining length is completed by undominated fillings of any number of pieces,
least waste first, each applied to as many sequences as the counts allow; a branch is cut once its
waste cannot beat the incumbent. The incumbent starts as best-fit decreasing.
The search ends at the lower bound or after ``NODES`` fillings with the best
packing found, always a whole one.

The solution, a table of fillings, goes back to the pieces: the r-th piece of a
length finds its sequence and offset by its rank, which is numbered by hash
bucket, so no task holds all pieces of a length.

Defined results: a null text is the empty text and holds the end id alone.
Repeated rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from practica.llm.common import buckets_for, gapless_slots, map_batches, texts_of
from practica.llm.tokens import END_ID, added_tokens, encoder, vocabulary_path
from practica.session import materialize

SIZE = 1024
NODES = 3_000

Filling = tuple[int, ...]


def cut(length: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = length % size if length > size else length
    starts = ([(0, first)] if first else [])
    return starts + [(s, size) for s in range(first, length, size)]


def token_pieces(docs: DataFrame, path: str | None = None, size: int = SIZE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    path = path or vocabulary_path()
    end = END_ID.to_bytes(4, "little")
    added = added_tokens()

    def run(batch: pa.RecordBatch) -> dict:
        row, piece, start, length, crc = [], [], [], [], []
        encode = encoder(path, added)
        for i, text in enumerate(texts_of(batch)):
            ids = memoryview(encode(text) + end)
            for k, (s, n) in enumerate(cut(len(ids) // 4, size)):
                row.append(i)
                piece.append(k)
                start.append(s)
                length.append(n)
                crc.append(zlib.crc32(ids[4 * s:4 * (s + n)]))
        return {"doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run,
                       "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(counts: np.ndarray, size: int) -> int:
    """Sequences that no packing can do without: for each a, lengths above
    size - a stand alone, lengths above size / 2 need one each, and lengths from
    a on must fit beside them."""
    total = counts * np.arange(size + 1)
    many, words = np.cumsum(counts[::-1])[::-1], np.cumsum(total[::-1])[::-1]
    half = size // 2
    a = np.arange(1, half + 1)
    alone = many[size - a + 1]
    big = many[half + 1] - alone
    free = big * size - (words[half + 1] - words[size - a + 1])
    small = words[a] - words[half + 1]
    each = alone + big + np.maximum(0, -(-(small - free) // size))
    return max(-(-int(total.sum()) // size), int(each.max()))


def best_fit_decreasing(counts: np.ndarray, size: int) -> list[tuple[Filling, int]]:
    """Longest first, each into the fullest sequence that has room; equal
    sequences are kept as one entry with a count."""
    room: dict[int, dict[Filling, int]] = {}
    for s in range(size, 0, -1):
        left = int(counts[s])
        while left:
            fits = [r for r in room if r >= s]
            r = min(fits) if fits else size
            filling, n = next(iter(room[r].items())) if fits else ((), -(-left // (size // s)))
            per = min(r // s, left)
            bins = min(n, left // per)
            if fits:
                room[r][filling] -= bins
                if not room[r][filling]:
                    del room[r][filling]
                if not room[r]:
                    del room[r]
            new = filling + (s,) * per
            into = room.setdefault(r - s * per, {})
            into[new] = into.get(new, 0) + bins
            left -= bins * per
    return [(f, n) for group in room.values() for f, n in group.items()]


def fillings(counts: np.ndarray, largest: int, size: int) -> Iterator[tuple[int, Filling | None]]:
    """(waste, filling) of the room beside ``largest``, fillings of any number of
    pieces, least waste first and then longer pieces first; None in the place of
    a dominated one.

    A filling is dominated if one remaining piece fits in the place of some of
    its pieces (or of none) and is longer than they are together, or as long as
    two or more of them. The first filling never is."""
    room = size - largest
    have = [int(i) for i in np.nonzero(counts[:min(room, largest) + 1])[0]]
    most = {i: min(int(counts[i]), room // i) for i in have}
    # sums[k]: bits of the sums that the k shortest lengths can make.
    sums, every = [1], (1 << room + 1) - 1
    for i in have:
        made, left, step = sums[-1], most[i], 1
        while left:
            step = min(step, left)
            made |= made << i * step & every
            left, step = left - step, 2 * step
        sums.append(made)

    def exactly(k: int, total: int) -> Iterator[Filling]:
        if not total:
            yield ()
            return
        for j in range(bisect_right(have, total, 0, k) - 1, -1, -1):
            i = have[j]
            if not sums[j + 1] >> total & 1:
                return
            for n in range(min(most[i], total // i), 0, -1):
                if sums[j] >> total - n * i & 1:
                    for rest in exactly(j, total - n * i):
                        yield (i,) * n + rest

    def dominated(filling: Filling, waste: int) -> bool:
        free = 0
        for i in have:
            if counts[i] > filling.count(i):
                free |= 1 << i
        one, more = 0, 0
        for i in filling:
            more |= more << i | one << i
            one |= 1 << i
        some = 1 | one | more
        return bool(more & free) or any(some << w & free for w in range(1, waste + 1))

    for waste in range(room + 1):
        if sums[-1] >> room - waste & 1:
            for filling in exactly(len(have), room - waste):
                yield waste, None if dominated(filling, waste) else filling


def _apply(counts: np.ndarray, filling: Filling) -> tuple[np.ndarray, int]:
    """Counts after using the filling as often as they allow."""
    need = {i: filling.count(i) for i in set(filling)}
    times = min(int(counts[i]) // n for i, n in need.items())
    left = counts.copy()
    for i, n in need.items():
        left[i] -= n * times
    return left, times


def pack_counts(counts: np.ndarray, size: int = SIZE, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Fillings and how many sequences use each, for ``counts[length]``."""
    counts = np.asarray(counts, np.int64)
    best = best_fit_decreasing(counts, size)
    used = sum(n for _, n in best)
    bound = lower_bound(counts, size)
    total = int((counts * np.arange(size + 1)).sum())
    # A branch: its fillings to come, counts left, waste and sequences so far, fillings as a chain.
    stack: list = []

    def enter(left: np.ndarray, waste: int, bins: int, chain) -> None:
        nonlocal used, best
        some = np.nonzero(left)[0]
        if len(some):
            largest = int(some[-1])
            rest = left.copy()
            rest[largest] -= 1
            stack.append((fillings(rest, largest, size), largest, left, waste, bins, chain))
        elif bins < used:
            used, best = bins, []
            while chain:
                best.append(chain[0])
                chain = chain[1]

    if used > bound:
        enter(counts, 0, 0, None)
    while stack and used > bound and nodes > 0:
        coming, largest, left, waste, bins, chain = stack[-1]
        more, filling = next(coming, (None, None))
        # Beating the incumbent leaves at most this much waste in all.
        most = (used - 1) * size - total
        if more is None or waste + more > most:
            stack.pop()
            continue
        nodes -= 1
        if filling is None:
            continue
        whole = (largest, *filling)
        after, times = _apply(left, whole)
        waste, bins = waste + times * more, bins + times
        if waste <= most and bins + lower_bound(after, size) < used:
            enter(after, waste, bins, ((whole, times), chain))
    return best


def place_table(packed: list[tuple[Filling, int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, pieces of the length
    in a sequence, offset of the first)."""
    rank: dict[int, int] = {}
    table: dict[int, list] = {}
    sequence = 0
    for filling, n in packed:
        offset = 0
        for length in sorted(set(filling), reverse=True):
            per = filling.count(length)
            table.setdefault(length, []).append((rank.get(length, 0), sequence, per, offset))
            rank[length] = rank.get(length, 0) + per * n
            offset += per * length
        sequence += n
    return {k: np.array(v, np.int64) for k, v in table.items()}


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SIZE, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and offset."""
    pieces = materialize(token_pieces(docs, path, size, id_col, text_col), "token_pieces")
    counts, rows = np.zeros(size + 1, np.int64), 0
    for length, n in pieces.groupBy("length").count().collect():
        counts[length] = n
        rows += n
    table = place_table(pack_counts(counts, size))
    ranked = gapless_slots(pieces, "length", ["doc_id", "piece", "start", "ids_crc32"], buckets_for(rows))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batch: pa.RecordBatch) -> dict:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "slot"))
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for n in np.unique(length):
            at = np.nonzero(length == n)[0]
            rows = table[int(n)]
            row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
            nth = rank[at] - row[:, 0]
            sequence[at] = row[:, 1] + nth // row[:, 2]
            offset[at] = row[:, 3] + nth % row[:, 2] * n
        return {**{c: batch.column(c) for c in columns},
                "sequence_id": pa.array(sequence), "offset": pa.array(offset)}

    return map_batches(ranked.select(*columns, "slot"), run, "doc_id long, piece int, start long, length long, "
                       "ids_crc32 long, sequence_id long, offset long")
