"""Tables in the shared folder that tasks read themselves, from end to end and as often as they need.

A blocked product needs every block beside every other.  Sent through a shuffle, each row would be copied once per block;
read from the shared folder, it is stored once however many blocks there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.session import durable, scratch_folder

#: without it, shuffle files stay until the driver happens to collect its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def kept(df: DataFrame, name: str, by: str | None = None) -> str:
    """Write a table to the shared folder, a subfolder per value of ``by``; its path. Shuffle files of the plan go at once."""
    spark = df.sparkSession
    path, cleaned = scratch_folder(spark, name), spark.conf.get(CLEANUP, "false")
    writer = df.write if by is None else df.write.partitionBy(by)
    spark.conf.set(CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(CLEANUP, cleaned)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, a column at a time and packed."""
    return df.sparkSession.read.schema(df.schema).parquet(kept(df, name))


def file_system(path: str):
    """File system and path of a shared folder, for tasks."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def batches_of(path: str, columns: Sequence[str], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Batches of all files below a path, one after the other; none if there is no such path."""
    from pyarrow import fs
    from pyarrow import parquet

    system, folder = file_system(path)
    found = system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    for info in sorted((i for i in found if i.base_name.endswith(".parquet")), key=lambda i: i.path):
        with system.open_input_file(info.path) as source:
            for batch in parquet.ParquetFile(source).iter_batches(rows, columns=list(columns), use_threads=False):
                if batch.num_rows:
                    yield batch.select(list(columns))


def runs_of(path: str, columns: Sequence[str], rows: int) -> Iterator[list[np.ndarray]]:
    """Columns of all files, cut where the first one changes: whole runs of its values, about so many rows at a time."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches_of(path, columns):
        found = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held.append(found)
        size += len(found[0])
        # the last value may go on in the next batch
        cut = int(np.flatnonzero(found[0] != found[0][-1])[-1]) + 1 if found[0][0] != found[0][-1] else 0
        if size < rows:
            continue
        if not cut:
            if len(held) == 1 or held[-2][0][-1] == found[0][0]:
                continue
            yield [np.concatenate(c) for c in zip(*held[:-1], strict=True)]
            held = [found]
        else:
            held[-1] = [c[:cut] for c in found]
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held = [[c[cut:] for c in found]]
        size = len(held[0][0])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    return np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def numbered(df: DataFrame, column: str, number: str) -> tuple[DataFrame, DataFrame | None]:
    """The table with ``number`` (long) in place of the column, in the same order, and what each number stands for (None
    if that is the number itself)."""
    rest = [c for c in df.columns if c != column]
    if dict(df.dtypes)[column] in INTEGRAL:
        return df.select(F.col(column).cast("long").alias(number), *rest), None
    names = durable(df.select(column).distinct().orderBy(column).withColumn(number, F.monotonically_increasing_id()))
    return df.join(names, column).select(number, *rest), names
