"""Harmonic packing of token ids into fixed-size sequences, by each worker on its own."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import byte_slices, byte_texts, worker_state
from meterwise.llm.vocab import ByteIds


def class_sizes(capacity: int) -> list[int]:
    """Piece sizes of the classes whose j pieces fill a bin of `capacity` exactly: its divisors, large to small."""
    return [n for n in range(capacity, 0, -1) if capacity % n == 0]


def cut_lengths(n: int, capacity: int, sizes: list[int]) -> list[int]:
    """Cut n tokens into pieces of class sizes: whole bins first, then the rest from large to small."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    for size in sizes:
        while rest >= size:
            out.append(size)
            rest -= size
    return out


class HarmonicBins:
    """One open bin per class. A bin of class j takes exactly j pieces of capacity / j tokens.

    `place` gives a bin number and a slot. Bins still open at the end hold fewer than j pieces;
    `split` cuts such a bin into sequences of a power of two pieces, which need no padding when
    the piece size is a power of two as well."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: dict[int, tuple[int, int]] = {}
        self.bins = 0

    def place(self, size: int) -> tuple[int, int]:
        number, used = self.open.get(size, (-1, 0))
        if used == 0:
            number = self.bins
            self.bins += 1
        used += 1
        self.open[size] = (number, 0 if used * size == self.capacity else used)
        return number, used - 1

    def unfinished(self) -> dict[int, tuple[int, int]]:
        """Per class with an open bin: its number and the pieces in it."""
        return {size: at for size, at in self.open.items() if at[1]}


def power_runs(pieces: int) -> list[int]:
    """A count as descending powers of two."""
    return [1 << b for b in range(pieces.bit_length() - 1, -1, -1) if pieces >> b & 1]


def pack(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Pieces of all documents placed in sequences of at most `capacity` tokens.

    Each text is encoded by the byte-level file at `path` (no added special tokens) and closed by `end_id`.
    Piece lengths are partitioned into reciprocal-capacity classes: a class-j piece has capacity / j tokens
    (j over the divisors), so j of them fill a sequence without padding. Tails are cut into such lengths from
    large to small: a tail below `capacity` = 1024 gives at most 10 pieces. Every worker fills its own bins,
    no row is shuffled, and memory holds one open bin (its pieces' rows) per class. A worker's last bin of a
    class is split into sequences of 2^i pieces, which are power-of-two sequences and need no padding.

    Returned per piece: id, start, length, ids_crc32 (of the ids as little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset, sequence_tokens (tokens in its sequence), pad_to (tokens with padding), and `ids` if
    asked for. Null texts are empty (just the end id); null and repeated document ids are packed row by row;
    empty tables give an empty result; other columns are not read."""
    sizes = class_sizes(capacity)
    names = ["i", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "pad_to"]
    slim = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    kind = slim.schema["i"].dataType.simpleString()

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"bytes:{path}", lambda: ByteIds(path))
        task = TaskContext.get().partitionId()
        bins, waiting = HarmonicBins(capacity), {}
        end = np.array([end_id], dtype="<u4").tobytes()
        rows: list[tuple] = []
        kind_of_id = None

        def emit(pieces: list[tuple], size: int, number: int) -> None:
            """Pieces of one bin: a full bin is one sequence, a part is several of 2^i pieces."""
            first = 0
            for k, run in enumerate(power_runs(len(pieces)) if len(pieces) * size < capacity else [len(pieces)]):
                tokens = run * size
                pad = tokens if tokens & (tokens - 1) == 0 else capacity
                for slot, piece in enumerate(pieces[first : first + run]):
                    # 2^20 tasks x 2^39 bins x 2^4 parts of a bin
                    rows.append((*piece[:5], task << 43 | number << 4 | k, slot * size, tokens, pad, piece[5]))
                first += run

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 10
            arrays = [pa.array(columns[0], kind_of_id), *(pa.array(c, pa.int64()) for c in columns[1:9])]
            if with_ids:
                data = b"".join(columns[9])
                bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in columns[9]], dtype=np.int64)]).astype(np.int32)
                flat = pa.array(np.frombuffer(data, dtype="<u4").astype(np.int32), pa.int32())
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat))
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[*names, *(["ids"] * with_ids)])

        for batch in batches:
            kind_of_id = batch.schema.field(0).type
            for part in byte_slices(batch, 1):
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode_all(byte_texts(part.column(1))), strict=True):
                    ids = memoryview(ids + end)
                    n = len(ids) // 4
                    start = 0
                    for size in cut_lengths(n, capacity, sizes):
                        piece = ids[4 * start : 4 * (start + size)]
                        row = (doc, start, size, zlib.crc32(piece), n, bytes(piece) if with_ids else None)
                        number, slot = bins.place(size)
                        if size == capacity:
                            emit([row], size, number)
                        else:
                            held = waiting.setdefault(size, [])
                            held.append(row)
                            if len(held) * size == capacity:
                                emit(held, size, number)
                                waiting[size] = []
                        start += size
                if len(rows) >= 2048:
                    yield out()
        for size, (number, _) in bins.unfinished().items():
            emit(waiting[size], size, number)
        if kind_of_id is not None:
            yield out()

    extra = ", ids array<int>" if with_ids else ""
    packed = slim.mapInArrow(fill, f"i {kind}, " + ", ".join(f"{c} long" for c in names[1:]) + extra)
    return packed.withColumnRenamed("i", id_col)
