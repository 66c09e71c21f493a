"""Token-ID / binary output: best-fit-decreasing packing with segment-tree capacity search, written as packed matrices.

A document's ids end with the separator; overlong ones are split into whole rows and a rest, losslessly. Rests of a block
are taken in falling order; a segment tree over remaining capacities gives the open row with the least room that still
fits, in O(log capacity). Every input partition is packed by itself, block by block: nothing is shuffled, memory is bounded
by the block. A row of the matrix: ids as little-endian integers padded to the width, cumulative segment lengths, the
positions at which position ids restart, and where each segment lies in its document.

Edge cases: null text counts as empty (only the separator); repeated rows are written as often as they occur; null ids
stay null; an empty table gives no rows; other columns are ignored, whatever their names; of rests of one size the first
comes first, and of open rows with the same room the last opened is taken; a very long text is cut into whole rows as it
comes, its ids (two bytes a token) in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, shared_encoder, slices, text_of

BLOCK_TOKENS = 4_000_000


class CapacityTree:
    """Open rows by remaining room: finds the least room of at least a size. Leaves are rooms 0..capacity."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = room + self.width
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) with the least room of at least size, removed; None if there is none."""
        i = size + self.width
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.width:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.width
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Rows of item numbers; every size must be within 1..capacity."""
    tree, rows = CapacityTree(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        tree.add(room - sizes[i], row)
    return rows


SCHEMA = "sequence_id long, n_tokens int, n_segments int, ids binary, cumulative_lengths array<int>, position_resets array<int>, doc_ids array<long>, doc_starts array<long>"


def packed_matrix(docs: DataFrame, path: str, width: int = 2048, separator: int = 50256, pad: int = 0, lossless: bool = True, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id") -> DataFrame:
    """Rows of the id matrix in 16-bit integers (vocabularies up to 65,536). lossless: the tokenizer is byte-level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path, lossless)
        end = np.array([separator], "<u2").tobytes()
        fill = np.array([pad], "<u2").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple[int, int, bytes]] = []
        held = 0

        def rows_of(groups: list[list[tuple[int, int, bytes]]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            for at in range(0, len(groups), 256):
                own = groups[at : at + 256]
                sums = [np.concatenate([[0], np.cumsum([len(p[2]) // 2 for p in g])]).astype(np.int32) for g in own]
                n = [int(s[-1]) for s in sums]
                cols = [
                    pa.array(range(sequence, sequence + len(own)), pa.int64()),
                    pa.array(n, pa.int32()),
                    pa.array([len(g) for g in own], pa.int32()),
                    pa.array([b"".join([p[2] for p in g]) + fill * (width - k) for g, k in zip(own, n, strict=True)], pa.binary()),
                    pa.array(sums, pa.list_(pa.int32())),
                    pa.array([s[:-1] for s in sums], pa.list_(pa.int32())),
                    pa.array([[p[0] for p in g] for g in own], pa.list_(pa.int64())),
                    pa.array([[p[1] for p in g] for g in own], pa.list_(pa.int64())),
                ]
                sequence += len(own)
                yield pa.RecordBatch.from_arrays(cols, names)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal waiting, held
            packed = best_fit_decreasing([len(p[2]) // 2 for p in waiting], width)
            yield from rows_of([[waiting[i] for i in row] for row in packed])
            waiting, held = [], 0

        for batch in slices(batches):
            whole = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist(), "H"), strict=True):
                ids += end
                n = len(ids) // 2
                for start in range(0, n, width):
                    piece = (doc, start, ids[2 * start : 2 * (start + width)])
                    if n - start >= width:
                        whole.append([piece])
                    else:
                        waiting.append(piece)
                        held += n - start
            yield from rows_of(whole)
            if held >= block_tokens:
                yield from flush()
        if waiting:
            yield from flush()

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), text_of()), run, SCHEMA)


def position_ids(cumulative_lengths: list[int]) -> np.ndarray:
    """0, 1, ... restarting at each segment."""
    ends = np.asarray(cumulative_lengths)
    return np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))


def write(matrix: DataFrame, to: str) -> None:
    """The matrix as Parquet under `to`, a path that all executors share."""
    matrix.write.mode("overwrite").parquet(to)


def documents_again(matrix: DataFrame) -> DataFrame:
    """(doc_id, doc_start, ids): every segment cut out of its row again; by doc_start they make up the documents."""
    seg = matrix.select("ids", "cumulative_lengths", F.posexplode(F.arrays_zip("doc_ids", "doc_starts")).alias("i", "seg"))
    begin, stop = F.get("cumulative_lengths", F.col("i")), F.get("cumulative_lengths", F.col("i") + 1)
    return seg.select(F.col("seg.doc_ids").alias("doc_id"), F.col("seg.doc_starts").alias("doc_start"), F.substring("ids", 2 * begin + 1, 2 * (stop - begin)).alias("ids"))
