"""Count-min sketches merged from partitions, as bits that say "at least so often".

Items are 64-bit hashes. A task lists the cells it hits, once or more often, per
row of the sketch and block of cells; blocks are merged by a shuffle, and only a
bit per cell, whether its count reaches the wanted one, is collected and
broadcast. Its size is fixed: ``DEPTH`` x 2**``cells`` / 8 bytes. Counts are never
too low, so no item that occurs often enough is missed; an item that shares its
cells with others may pass too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

DEPTH = 2
BLOCK_BITS = 16
_HELD = 1_000_000  # items a task gathers before it packs them
_ROWS = "at long, once binary, more binary"


def _cells(items: np.ndarray, row: int, cells: int) -> np.ndarray:
    shift = np.uint64(64 - cells if row == 0 else max(0, 32 - cells))
    return (items >> shift) & np.uint64((1 << cells) - 1)


def _packed(items: np.ndarray, cells: int) -> Iterator[pa.RecordBatch]:
    """Cells hit by the items, per row and block."""
    for row in range(DEPTH):
        hit, times = np.unique(_cells(items, row, cells), return_counts=True)
        block = (hit >> np.uint64(BLOCK_BITS)).astype(np.int64)
        edges = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(hit) else np.zeros(0, int)
        low = hit.astype(np.uint16)
        once, more = [], []
        for a, b in zip(edges, [*edges[1:], len(hit)], strict=True):
            part, single = low[a:b], times[a:b] == 1
            once.append(part[single].tobytes())
            more.append(part[~single].tobytes())
        at = (row << 32) + block[edges]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["at", "once", "more"])


class Bits:
    """Which cells reach the wanted count."""

    def __init__(self, cells: int, blocks: dict[int, bytes]):
        self.cells = cells
        size = 1 << max(0, cells - 3)
        self.rows = [np.zeros(size, np.uint8) for _ in range(DEPTH)]
        step = 1 << (BLOCK_BITS - 3)
        for at, packed in blocks.items():
            start = (at & 0xFFFFFFFF) * step
            self.rows[at >> 32][start : start + step] = np.frombuffer(packed, np.uint8)

    def has(self, items: np.ndarray) -> np.ndarray:
        """Whether each item may have occurred often enough."""
        found = np.ones(len(items), bool)
        for row, bits in enumerate(self.rows):
            at = _cells(items, row, self.cells)
            found &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1) > 0
        return found


def counted(
    rows: DataFrame, items: Callable[[pa.RecordBatch], Iterable[np.ndarray]], cells: int, least: int = 2
) -> Bits:
    """Cells that items of ``rows`` hit at least ``least`` (1 or 2) times.

    ``items`` gives arrays of hashes for a batch.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for some in items(batch):
                held.append(some)
                count += len(held[-1])
                if count > _HELD:
                    yield from _packed(np.concatenate(held), cells)
                    held, count = [], 0
        if held:
            yield from _packed(np.concatenate(held), cells)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, once, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = counts.setdefault(at, np.zeros(1 << BLOCK_BITS, np.uint8))
                for packed, times in ((once, 1), (more, 2)):
                    cell = np.frombuffer(packed, np.uint16)
                    block[cell] = np.minimum(block[cell] + times, 2)
        if counts:
            bits = [np.packbits(b >= least, bitorder="little").tobytes() for b in counts.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(bits, pa.binary())], ["at", "bits"])

    merged = rows.mapInArrow(gather, _ROWS).repartition("at").mapInArrow(merge, "at long, bits binary")
    return Bits(cells, {r["at"]: bytes(r["bits"]) for r in merged.collect()})
