"""Packing: Karmarkar-Karp multiway differencing of token pieces into near-equal windows.

Every input partition is packed by itself, in blocks of bounded size, so nothing is shuffled. A document's ids are cut
into whole windows and a rest of pieces of at most `max_piece` ids. Pieces of a block start as partial partitions with
one filled window; the two with the largest imbalance are merged, the fullest windows of one with the emptiest of the
other, until one partition is left. If its fullest window exceeds the capacity, the window count rises and the block is
differenced anew.

Edge cases: null text counts as empty (its ids are the separator alone); repeated rows are packed as often as they
occur; null ids stay null; an empty table gives no rows; other columns are ignored, whatever their names; equal imbalances
are taken in the pieces' order; a very long text is cut into whole windows as it comes, its ids (four bytes a token) in
memory. A partition's last block may be short of whole windows: about one window of padding a partition.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, shared_encoder, slices, text_of

#: Ids that a block gathers before it is packed; bounds memory and the differencing of one block.
BLOCK_WINDOWS = 256


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """The Karmarkar-Karp partition of the items into k windows, as lists of item numbers."""
    if k == 1:
        return [list(range(len(sizes)))]
    # A partition: window sums in falling order, and for each window a node of the merge forest (-1: empty).
    left, right = [], []
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i in parts:
            return parts.pop(i)
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], nodes[0] = sizes[i], i
        return sums, nodes

    n = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        (sa, na), (sb, nb) = of(a), of(b)
        sums, nb = sa + sb[::-1], nb[::-1]
        both = np.flatnonzero((na >= 0) & (nb >= 0))
        nodes = np.where(na >= 0, na, nb)
        if len(both):
            nodes[both] = n + len(left) + np.arange(len(both))
            left.extend(na[both].tolist())
            right.extend(nb[both].tolist())
        order = np.argsort(-sums, kind="stable")
        parts[a] = sums[order], nodes[order]
        heapq.heappush(heap, (int(sums[order[-1]] - sums[order[0]]), a))
    out = []
    for root in of(heap[0][1])[1].tolist() if heap else []:
        found, todo = [], [root] if root >= 0 else []
        while todo:
            x = todo.pop()
            if x < n:
                found.append(x)
            else:
                todo += [left[x - n], right[x - n]]
        out.append(found)
    return [x for x in out if x]


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows within the capacity; the window count rises while one exceeds it."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = difference(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return windows
        k += max(1, k // 256)


def cut(n: int, capacity: int, max_piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, then near-equal pieces of at most max_piece."""
    whole = n // capacity
    out = [(i * capacity, capacity) for i in range(whole)]
    at, rest = whole * capacity, n - whole * capacity
    pieces = -(-rest // max_piece)
    for j in range(pieces):
        length = rest // pieces + (j < rest % pieces)
        out.append((at, length))
        at += length
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, separator: int = 1, max_piece: int = 512, block_windows: int = BLOCK_WINDOWS, with_ids: bool = False, id_col: str = "doc_id") -> DataFrame:
    """One row a piece: where it lies in its document and in its sequence, its checksum and, if asked for, its ids.

    sequence_id: the input partition's number times 2**40, plus a running number. Deterministic for a given input split.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path)
        end = np.array([separator], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        waiting: list[tuple] = []
        held = 0

        def flush() -> None:
            nonlocal sequence, waiting, held
            for window in pack_sizes([x[2] for x in waiting], capacity):
                offset = 0
                for i in sorted(window):
                    rows.append((*waiting[i], sequence, offset))
                    offset += waiting[i][2]
                sequence += 1
            waiting, held = [], 0

        def out() -> pa.RecordBatch:
            cols = list(zip(*[(*x[:5], *x[6:]) for x in rows], strict=True))
            arrays = [pa.array(c, pa.int64()) for c in cols]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x[5], "<u4").astype(np.int32) for x in rows], pa.list_(pa.int32())))
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                ids += end
                n = len(ids) // 4
                for start, length in cut(n, capacity, max_piece):
                    own = ids[4 * start : 4 * (start + length)]
                    piece = (doc, start, length, zlib.crc32(own), n, own if with_ids else None)
                    if length == capacity:
                        rows.append((*piece, sequence, 0))
                        sequence += 1
                    else:
                        waiting.append(piece)
                        held += length
                        if held >= block_windows * capacity:
                            flush()
            if len(rows) >= 2000:
                yield out()
        if waiting:
            flush()
        if rows:
            yield out()

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of()), run, schema)
