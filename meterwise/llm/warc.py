"""WARC archives with revisit records, and their capture index by an external merge of sorted runs."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import scratch, stored, table_batches
from meterwise.session import parallelism

ARCHIVE_BYTES = 32 << 20
ENTRIES_PER_PART = 1_000_000
#: a digest with more than this share of all captures is hot: there are at most 256 of them
HOT_SHARE = 1 / 256

ENTRY = pa.schema(
    [("url_key", pa.string()), ("captured", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("record_offset", pa.int64()), ("record_length", pa.int64())]
)
ENTRY_SQL = (
    "url_key string, captured long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "archive string, record_offset long, record_length long"
)


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: host labels reversed, then the path and query; the scheme, port and fragment go."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:
        return url
    return f"{host}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def file_system(path: str):
    """File system and path of a shared folder, for tasks."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def record(page_id: int | None, url: str | None, seconds: int, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit that names the response with the same payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (b"" if refers_to is not None else payload)
    name = "none" if page_id is None else str(page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {datetime.fromtimestamp(seconds, UTC):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, archive: str, offset: int, length: int) -> tuple:
    """Index entry of a record; a response's payload is measured and checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda field: None if (n := fields[field].strip("<>").rpartition(":")[2]) == "none" else int(n)
    if fields["WARC-Type"] == "response":
        size, refers_to = len(payload), None
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of record {offset} in {archive} does not match its digest")
    else:
        size, refers_to = int(re.search(rb"Content-Length: (\d+)", http)[1]), number("WARC-Refers-To")
    seconds = int(datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC).timestamp())
    return url_key(fields.get("WARC-Target-URI")), seconds, number("WARC-Record-ID"), size, digest, fields["WARC-Type"], refers_to, archive, offset, length


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Captures that repeat a payload: i, digest (hex), keep (the largest id with that payload, the response).

    Rows without an id are smaller than all. Digests that hold over 1/256 of all captures, at most 256, are looked up
    in a broadcast list; the others meet by a join, so no task gets a hot digest's rows."""
    slim = pages.select("i", F.sha1("html").alias("digest"), F.octet_length("html").alias("n"))
    slim = stored(slim.where(F.col("n") >= least_bytes), "captures")
    total = slim.count()
    groups = slim.groupBy("digest", "n").agg(F.max("i").alias("keep"), F.count(F.lit(1)).alias("c")).where("c > 1 AND keep IS NOT NULL")
    groups = stored(groups, "payloads")
    hot = F.broadcast(groups.where(F.col("c") > max(1.0, total * HOT_SHARE)).select("digest", "n", F.col("keep").alias("hot_keep")))
    marked = slim.join(hot, ["digest", "n"], "left")
    cold = marked.where("hot_keep IS NULL").drop("hot_keep").join(groups.select("digest", "n", "keep"), ["digest", "n"])
    found = cold.select("i", "digest", "keep").union(marked.where("hot_keep IS NOT NULL").select("i", "digest", F.col("hot_keep").alias("keep")))
    return found.where("i IS NULL OR i < keep").distinct()


def write_archives(pages: DataFrame, folder: str, captured: Column, id_col: str, url_col: str, html_col: str, least_bytes: int = 0) -> DataFrame:
    """Write all captures as gzipped WARC files (a member per record) and return the table of archives: path, records.

    Files get new names in every attempt of a task; only those that a finished task reports are read later."""
    rows = pages.select(F.col(id_col).cast("long").alias("i"), F.col(url_col).alias("u"), captured.cast("long").alias("at"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    again = revisits(rows, least_bytes).select(F.col("i").alias("j"), F.col("digest").alias("d"), "keep").hint("shuffle_hash")
    keyed = rows.withColumn("digest", F.sha1("html"))
    decided = keyed.join(again, keyed["i"].eqNullSafe(again["j"]) & (keyed["digest"] == again["d"]), "left").select("i", "u", "at", "html", "digest", "keep")
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        out, path, records, size = None, "", 0, 0
        for batch in batches:
            for i, url, at, html, digest, keep in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path, records, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path, compression=None)
                base32 = base64.b32encode(bytes.fromhex(digest)).decode()
                squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = squeeze.compress(record(i, url, at or 0, html.encode(), base32, keep)) + squeeze.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield path, records
        if out is not None:
            out.close()
            yield path, records

    return stored(decided.mapInArrow(lambda b: table_batches(archives(b), schema), "path string, records long"), "archives")


def sorted_runs(archives: DataFrame) -> DataFrame:
    """Index entries of all archives, read back record by record; each archive is a run sorted by URL key, time and id."""

    def run(path: str) -> list[tuple]:
        system, root = file_system(path)
        with system.open_input_stream(root, compression=None) as f:
            data = f.read()
        entries, offset = [], 0
        while offset < len(data):
            member = zlib.decompressobj(31)
            plain = member.decompress(memoryview(data)[offset:])
            length = len(data) - offset - len(member.unused_data)
            entries.append(parse_record(plain, path.rpartition("/")[2], offset, length))
            offset += length
        return sorted(entries, key=entry_key)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield from table_batches(iter(run(path)), ENTRY)

    spread = archives.select("path").repartition(parallelism(archives.sparkSession))
    return stored(spread.mapInArrow(read, ENTRY_SQL), "runs")


def entry_key(entry: tuple) -> tuple:
    """URL key, time, id (none first), archive and offset: a total order."""
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[7], entry[8]


class LoserTree:
    """Merge of k sorted runs: each inner node keeps the loser of its match, so the next entry takes log2 k comparisons."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.keys: list[tuple | None] = [entry_key(r[0]) if r else None for r in runs]
        self.loser = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._play(leaf, building=True)

    def _beats(self, a: int, b: int) -> bool:
        return self.keys[a] is not None and (self.keys[b] is None or self.keys[a] <= self.keys[b])

    def _play(self, leaf: int, building: bool = False) -> None:
        """Send a run up from its leaf; node 0 holds the winner."""
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.loser[node]
            if building and other < 0:
                self.loser[node] = winner
                return
            if self._beats(other, winner):
                self.loser[node], winner = winner, other
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.keys[self.loser[0]] is not None:
            first = self.loser[0]
            yield self.runs[first][self.at[first]]
            self.at[first] += 1
            run = self.runs[first]
            self.keys[first] = entry_key(run[self.at[first]]) if self.at[first] < len(run) else None
            self._play(first)


def merged_index(runs: DataFrame, entries_per_part: int = ENTRIES_PER_PART) -> DataFrame:
    """All index entries in one global order over the partitions: by URL key, time and id.

    Bounds come from a sample of keys; each run is cut at them and sent as sorted slices, and every task merges the
    slices of its part by a loser tree. Bounds include the time and id, so a host or URL with very many captures is
    split; a part holds about `entries_per_part` entries."""
    spark = runs.sparkSession
    total = runs.count()
    parts = max(parallelism(spark), -(-total // entries_per_part))
    columns = ["url_key", "captured", "page_id", "archive", "record_offset"]
    picked = runs.select(*columns).orderBy(F.xxhash64("archive", "record_offset"), "archive", "record_offset").limit(32 * parts).collect()
    keys = sorted(entry_key((r[0], r[1], r[2], 0, "", "", None, r[3], r[4])) for r in picked)
    bounds = spark.sparkContext.broadcast([keys[len(keys) * p // parts] for p in range(1, parts)] if keys else [])
    slices = pa.schema([("part", pa.int32()), ("entries", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Sorted slices: within a batch a new run starts wherever the order breaks."""
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            order = [entry_key(r) for r in rows]
            starts = [0, *(j for j in range(1, len(rows)) if order[j] < order[j - 1]), len(rows)]
            for a, b in zip(starts, starts[1:], strict=False):
                low = a
                for part, bound in enumerate([*bounds.value, None]):
                    high = b if bound is None else bisect_left(order, bound, low, b)
                    if high > low:
                        yield part, packed(batch.slice(low, high - low))
                    low = high

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = []
        for batch in batches:
            for data in batch.column(1):
                table = pa.ipc.open_stream(data.as_buffer()).read_all()
                held.append(list(zip(*(c.to_pylist() for c in table.columns), strict=True)))
        yield from table_batches(iter(LoserTree(held)), ENTRY)

    sent = runs.mapInArrow(lambda b: table_batches(cut(b), slices, 64), "part int, entries binary")
    return sent.repartitionById(parts, F.col("part")).mapInArrow(merge, ENTRY_SQL)


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def archive_pages(
    pages: DataFrame, captured: Column | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0
) -> DataFrame:
    """Write a WARC record per page to the shared folder, read the archives back and return their capture index in
    global order: url_key, captured (seconds), page_id, payload_bytes, payload_digest, record_type, refers_to, archive,
    record_offset, record_length.

    Of records with equal payloads (SHA-1 and length) of at least `least_bytes`, the largest id is the response and the
    others revisit it. Without `captured` a page's time is its id in seconds. Null html is an empty payload; a null url
    has no target field and an empty key; a row without an id revisits the largest id with its payload, or is a response
    if none has one; repeated rows are records alike, all responses or all revisits; an empty table gives an empty
    index; other columns are not read."""
    at = F.coalesce(F.col(id_col).cast("long"), F.lit(0)) % 4_000_000_000 if captured is None else captured
    folder = scratch(pages.sparkSession, "warc")
    return merged_index(sorted_runs(write_archives(pages, folder, at, id_col, url_col, html_col, least_bytes)))
