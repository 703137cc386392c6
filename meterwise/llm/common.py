"""Shared pieces: tables in the shared folder, worker state, id ranges, Arrow helpers."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.session import ensure_checkpoint_dir, parallelism

#: ASCII white space: everything outside `[^\x20\x09-\x0D]`
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """New folder in the shared checkpoint location; it goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, safe from lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like those given that the table does not have, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def worker_state(key: str, make: Callable[[], object]):
    """An object kept by a Python worker from task to task (caches, loaded vocabularies)."""
    holder = sys.modules.get("meterwise_worker_state")
    if holder is None:
        holder = sys.modules["meterwise_worker_state"] = types.ModuleType("meterwise_worker_state")
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def byte_slices(batch: pa.RecordBatch, column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows whose texts hold about `limit` bytes, so that work memory stays bounded."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes + 64) // limit
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else []
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(int(a), int(b - a))


def table_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows from tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def shard_count(df: DataFrame, rows_per_shard: int) -> int:
    """Shards that grow with the table and fill the session's parallelism."""
    return max(parallelism(df.sparkSession), -(-df.count() // rows_per_shard), 1)


def id_bounds(df: DataFrame, key: str, shards: int) -> list:
    """Ascending split values of a column, about equally many rows between them (at most shards - 1 values)."""
    if shards < 2:
        return []
    shares = [i / shards for i in range(1, shards)]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 20 * shards)).alias("b")).first()["b"]
    return sorted(set(found or []))


def shard_of(key: Column, bounds: list, descending: bool = False) -> Column:
    """Number of the id range a row belongs to; null ids are smaller than all others."""
    cuts = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), dtype=np.int32)
        out[known] = np.searchsorted(cuts, ids[known].to_numpy(dtype=np.int64), side="right")
        return pd.Series(len(cuts) - out if descending else out)

    return place(key)


def bitmap_of(keys: DataFrame, hash_column: str, bits: int = 1 << 24) -> np.ndarray:
    """A fixed-size bitmap (2 MB by default) holding a bit for each hash: what it lacks is surely absent."""
    spot = F.pmod(F.col(hash_column), F.lit(bits)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(spot).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("m"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.collect():
        piece = np.frombuffer(bytes(row["m"]), dtype=np.uint8)
        start = (row["b"] - 1) * 4096
        out[start : start + len(piece)] = piece
    return out


def in_bitmap(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Which hashes may be in a bitmap of `bitmap_of`."""
    spot = np.mod(hashes.astype(np.int64), np.int64(len(bitmap) * 8))
    return (bitmap[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1
