"""Blocks of rows of a sparse matrix, multiplied with dense vectors of its columns that are read from the shared folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from meterwise.operators.passes import batches_of, ranges

#: entries of a block, column vectors read at once, and entries multiplied at once
ENTRIES_PER_BLOCK, VECTORS_AT_ONCE, PRODUCTS_AT_ONCE = 4_000_000, 16_384, 500_000


class Block:
    """The rows of one block: entries by column, and the rows' sums."""

    def __init__(self, path: str, block: int):
        found = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches_of(f"{path}/b={block}", ["r", "c", "v"])]
        r, c, v = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        del found
        self.ids, row = np.unique(r, return_inverse=True)
        order = np.argsort(c, kind="stable")
        c, self.row, self.v = c[order], row[order].astype(np.int32), v[order]
        self.starts = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]])) if len(c) else np.zeros(0, np.int64)
        self.columns, self.bounds = c[self.starts], np.append(self.starts, len(c))

    def pushed(self, vectors: str, names: Sequence[str], matrix: np.ndarray) -> np.ndarray:
        """Sums of value times (vector times matrix) over the entries of each row, a column per row."""
        out = np.zeros((matrix.shape[1], len(self.ids)))
        if not len(self.ids):
            return out
        counts = np.diff(self.bounds)
        for batch in batches_of(vectors, ["c", *names], VECTORS_AT_ONCE):
            c, *x = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            at = np.minimum(np.searchsorted(self.columns, c), len(self.columns) - 1)
            mine = np.flatnonzero(self.columns[at] == c)
            at = at[mine]
            turned = matrix.T @ np.array([column[mine] for column in x])
            run = np.cumsum(counts[at]) // PRODUCTS_AT_ONCE
            cuts = np.flatnonzero(np.diff(run)) + 1
            for some in np.split(np.arange(len(at)), cuts):
                entries = ranges(self.starts[at[some]], counts[at[some]])
                which, row, v = np.repeat(some, counts[at[some]]), self.row[entries], self.v[entries]
                for j in range(len(out)):
                    out[j] += np.bincount(row, v * turned[j][which], len(self.ids))
        return out

    def back(self, sums: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Columns and their sums of value times row sum over the entries of the block, some at a time."""
        run = self.bounds[:-1] // PRODUCTS_AT_ONCE
        cuts = np.flatnonzero(np.diff(run)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(self.columns)], strict=True):
            if a < b:
                part = slice(self.bounds[a], self.bounds[b])
                row, v, starts = self.row[part], self.v[part], self.bounds[a:b] - self.bounds[a]
                yield self.columns[a:b], np.array([np.add.reduceat(v * s[row], starts) for s in sums])


def back_task(path: str, vectors: str, names: Sequence[str], matrix: np.ndarray):
    """A task: sums of products of the rows of a block (kind 1), and the rows pushed back to the columns (kind 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, c: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(np.full(len(c), kind, np.int32)), pa.array(c.astype(np.int64)), *(pa.array(column) for column in x)]
            return pa.RecordBatch.from_arrays(columns, names=["kind", "c", *names])

        for batch in batches:
            for block in batch.column(0).to_pylist():
                rows = Block(path, block)
                sums = rows.pushed(vectors, names, matrix)
                yield out(1, np.arange(len(names)), sums @ sums.T)
                for c, x in rows.back(sums):
                    yield out(0, c, x)

    return run


def rows_task(path: str, vectors: str, names: Sequence[str], matrix: np.ndarray, only_gram: bool = False):
    """A task: the rows of a block, or the sums of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                rows = Block(path, block)
                sums = rows.pushed(vectors, names, matrix)
                ids, flat = (np.arange(len(sums)), sums @ sums.T) if only_gram else (rows.ids, sums.T)
                for a in range(0, len(ids), 10_000):
                    part = np.ascontiguousarray(flat[a : a + 10_000])
                    bounds = np.arange(0, part.size + 1, part.shape[1], dtype=np.int32)
                    columns = [pa.array(ids[a : a + 10_000].astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds), pa.array(part.ravel()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["r", "factors"])

    return run
