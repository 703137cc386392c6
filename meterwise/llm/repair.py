"""Token ids on disk in Re-Pair compressed blocks with random access by document.

A block is a small grammar: symbols below `base` are token ids; symbol base + r stands for the pair
`left[r], right[r]`. Pairs never cross a document's end, so a document is a run of symbols and is
decoded alone. Each rule carries its expansion length, so lengths are known without expanding."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import byte_slices, byte_texts, id_bounds, scratch, shard_count, shard_of, table_batches, worker_state
from meterwise.llm.vocab import ByteIds

MAGIC = b"RPG1"
HEAD = "<4sIIIQQ"
ROWS_PER_SHARD = 100_000
BLOCK_IDS = 1 << 20
#: pairs are told apart by so many bits of a hash before they are sorted or looked up
SLOT_BITS = 18


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).view(np.int64)


def _pair_counts(keys: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, where each distinct one begins, and how often it occurs; the `wanted` most frequent are complete.

    Keys are counted by hash first. A key occurs at most as often as its hash, so if enough keys reach a bound, those
    with rarer hashes need not be sorted."""

    def counted(some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ordered = np.sort(some)
        edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, dtype=np.int64)
        return ordered, edges, np.diff(np.append(edges, len(ordered)))

    if len(keys) > 1 << SLOT_BITS:
        slots = _slots(keys)
        by_slot = np.bincount(slots, minlength=1 << SLOT_BITS)
        bound = np.partition(by_slot, -2 * wanted)[-2 * wanted] if 2 * wanted < len(by_slot) else 0
        found = counted(keys[by_slot[slots] >= bound])
        if bound and np.count_nonzero(found[2] >= bound) >= wanted:
            return found
    return counted(keys)


def repair(ids: np.ndarray, ends: np.ndarray, base: int, rounds: int = 4, per_round: int = 2048, least: int = 4):
    """Re-Pair grammar of one block: (left, right, symbols, symbol ends of the documents).

    A round counts all adjacent pairs of the block, takes the `per_round` most frequent that occur at least
    `least` times and replaces their occurrences from left to right. It ends early when no pair is frequent."""
    symbols, ends = ids.astype(np.int64), ends.astype(np.int64)
    left, right = [], []
    top = base
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        keys = symbols[:-1] << 32 | symbols[1:]
        inside = np.ones(len(keys), dtype=bool)
        inside[ends[(ends > 0) & (ends < len(symbols))] - 1] = False
        ordered, edges, counts = _pair_counts(keys[inside], per_round)
        if not len(ordered):
            break
        frequent = np.flatnonzero(counts >= least)
        if not len(frequent):
            break
        if len(frequent) > per_round:
            frequent = np.sort(frequent[np.argpartition(-counts[frequent], per_round - 1)[:per_round]])
        pairs = ordered[edges[frequent]]
        # most keys are ruled out by a table of hashes before they are looked up
        listed = np.zeros(1 << SLOT_BITS, dtype=bool)
        listed[_slots(pairs)] = True
        at = np.flatnonzero(listed[_slots(keys)] & inside)
        found = np.searchsorted(pairs, keys[at])
        found[found == len(pairs)] = 0
        hit = pairs[found] == keys[at]
        at, found = at[hit], found[hit]
        # of touching hits take every other one from the left
        fresh = np.concatenate([[True], np.diff(at) > 1])
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - run_start) % 2 == 0
        at = at[taken]
        symbols[at] = top + found[taken]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        ends = kept[ends]
        symbols = symbols[keep]
        left.append(pairs >> 32)
        right.append(pairs & 0xFFFFFFFF)
        top += len(pairs)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return join(left), join(right), symbols, ends


def rule_lengths(left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    """Expansion length of every rule; a rule only uses earlier ones."""
    lengths = np.ones(len(left), dtype=np.int64)
    while True:
        size = lambda s: np.where(s < base, 1, lengths[np.maximum(s - base, 0)])
        new = size(left) + size(right) if len(left) else lengths
        if np.array_equal(new, lengths):
            return lengths
        lengths = new


def write_block(start: int, doc_ids: list, ids: np.ndarray, ends: np.ndarray, base: int, **options) -> bytes:
    """A block as bytes: header, document ids, symbol and token ends, rules with lengths, symbols."""
    left, right, symbols, cuts = repair(ids, ends, base, **options)
    lengths = rule_lengths(left, right, base)
    width = "<u2" if base + len(left) <= 1 << 16 else "<u4"
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    body = [
        struct.pack(HEAD, MAGIC, len(doc_ids), len(left), base | (width == "<u4") << 31, start, len(symbols)),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        known.tobytes(),
        cuts.astype("<u4").tobytes(),
        ends.astype("<u4").tobytes(),
        left.astype("<u4").tobytes(),
        right.astype("<u4").tobytes(),
        lengths.astype("<u4").tobytes(),
        symbols.astype(width).tobytes(),
    ]
    return b"".join(body)


class Block:
    """Random access to a block's documents; only the symbols asked for are expanded."""

    def __init__(self, data: bytes):
        magic, n, rules, kind, self.start, count = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a Re-Pair block")
        self.base, wide = kind & 0x7FFFFFFF, kind >> 31
        at = struct.calcsize(HEAD)

        def take(dtype: str, k: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=dtype, count=k, offset=at)
            at += out.nbytes
            return out

        ids, known = take("<i8", n), take("u1", n)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.cuts, self.ends = take("<u4", n), take("<u4", n)
        left, right, lengths = (take("<u4", rules).astype(np.int64) for _ in range(3))
        self.symbols = take("<u4" if wide else "<u2", count)
        # full expansion of each rule, one after the other: symbol s covers flat[first[s] : first[s] + size[s]]
        self.size = np.concatenate([np.ones(self.base, dtype=np.int64), lengths])
        self.first = np.concatenate([np.arange(self.base), self.base + np.cumsum(lengths) - lengths]).astype(np.int64)
        self.flat = np.zeros(self.base + int(lengths.sum()), dtype=np.uint32)
        self.flat[: self.base] = np.arange(self.base)
        done = np.zeros(self.base + rules, dtype=bool)
        done[: self.base] = True
        while not done.all():
            ready = np.flatnonzero(~done[self.base :] & done[left] & done[right])
            if not len(ready):
                raise ValueError("a rule uses a later one")
            for side, shift in ((left[ready], 0), (right[ready], self.size[left[ready]])):
                self._copy(side, self.first[self.base + ready] + shift)
            done[self.base + ready] = True

    def _copy(self, symbols: np.ndarray, to: np.ndarray) -> None:
        sizes = self.size[symbols]
        steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.flat[np.repeat(to, sizes) + steps] = self.flat[np.repeat(self.first[symbols], sizes) + steps]

    def expand(self, first_symbol: int, last_symbol: int) -> np.ndarray:
        symbols = self.symbols[first_symbol:last_symbol].astype(np.int64)
        sizes = self.size[symbols]
        steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.flat[np.repeat(self.first[symbols], sizes) + steps]

    def document(self, i: int) -> np.ndarray:
        """Ids of the block's i-th document alone."""
        return self.expand(int(self.cuts[i - 1]) if i else 0, int(self.cuts[i]))


def write_ids(
    docs: DataFrame, path: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    rows_per_shard: int = ROWS_PER_SHARD, block_ids: int = BLOCK_IDS,
) -> None:
    """Encode whole texts, close each by `end_id` and write compressed blocks in ascending id order.

    Documents are range-partitioned by id into shards (bounds from an approximate quantile over the ids alone)
    and sorted inside a shard; a task streams its shard and holds one block of about `block_ids` ids. The files
    are a Parquet table with a row per block: shard, block (number in the shard), n_ids and the block's bytes;
    a block's header has its start inside the shard. Null ids come first, ties are ordered by text."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    shards = shard_count(slim.select("i"), rows_per_shard)
    bounds = id_bounds(slim.select("i"), "i", shards)
    vocabulary = spark.sparkContext.broadcast(_base(path, end_id))
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("data", pa.binary())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = worker_state(f"bytes:{path}", lambda: ByteIds(path))
        shard, number, start = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], dtype="<u4").tobytes()
        doc_ids, held, n = [], [], 0

        def close() -> tuple:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            ends = np.cumsum([len(x) // 4 for x in held])
            return shard, number, n, write_block(start, doc_ids, ids, ends, vocabulary.value)

        for batch in batches:
            for part in byte_slices(batch, 1):
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode_all(byte_texts(part.column(1))), strict=True):
                    doc_ids.append(doc)
                    held.append(ids + end)
                    n += len(held[-1]) // 4
                    if n >= block_ids:
                        yield close()
                        number, start = number + 1, start + n
                        doc_ids, held, n = [], [], 0
        if held:
            yield close()

    placed = slim.repartitionById(max(1, len(bounds) + 1), shard_of(F.col("i"), bounds)).sortWithinPartitions(F.col("i").asc_nulls_first(), "t")
    out = placed.mapInArrow(lambda batches: table_batches(blocks(batches), schema, 4), "shard int, block int, n_ids long, data binary")
    out.write.parquet(folder)


def _base(path: str, end_id: int) -> int:
    return max(ByteIds(path).library.get_vocab_size(with_added_tokens=True), end_id + 1)


def read_ids(spark, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents read back from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers), and the ids if asked for.

    A shard's start is the sum of the shards before it: one row per shard, added up from the block lengths
    without reading the blocks."""
    table = spark.read.schema("shard int, block int, n_ids long, data binary").parquet(folder)
    totals = table.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    starts, before = {}, 0
    for row in totals:
        starts[row["shard"]] = before
        before += row["n"]
    shard_start = spark.sparkContext.broadcast(starts)  # one number per shard of ROWS_PER_SHARD documents

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block = Block(data.as_buffer().to_pybytes())
                ids = block.expand(0, len(block.symbols)).astype("<u4")
                ends = block.ends.astype(np.int64)
                first = np.concatenate([[0], ends[:-1]])
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                columns = [
                    pa.array(block.doc_ids, pa.int64()),
                    pa.array(first + block.start + shard_start.value[shard], pa.int64()),
                    pa.array(ends - first, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    flat = pa.array(ids.astype(np.int32), pa.int32())
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(first, ends[-1:]).astype(np.int32), pa.int32()), flat))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] * with_ids)])

    extra = ", ids array<int>" if with_ids else ""
    return table.select("shard", "data").mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long" + extra)


def round_trip(docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of all documents to the shared folder and read them back.

    Null texts are empty (the end id alone); null ids stay null and come first; repeated rows are kept; an
    empty table gives an empty result; other columns are not read."""
    folder = scratch(docs.sparkSession, "token-ids")
    write_ids(docs, path, folder, end_id, id_col, text_col)
    return read_ids(docs.sparkSession, folder, with_ids=False)
