"""Homomorphic document fingerprints: sums of wide vectors hashed from pieces of paragraphs."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import id_bounds, shard_count, shard_of, table_batches

#: 8 lanes modulo 2^64 decide equality, 256 lanes modulo 2^16 measure likeness
WIDE, LANES = 8, 256
ROWS_PER_SHARD = 100_000
#: a paragraph (line) is cut behind punctuation, and where 200 bytes have none
PIECE = re.compile(rb"[^.,;:!?\n]{1,200}[.,;:!?\n]*|[.,;:!?\n]+")


class Fingerprint:
    """Sum over the multiset of a text's pieces; `+` and `-` add and take away multisets of pieces.

    A piece adds its 512-bit hash, as 8 numbers, to the wide lanes, and 1 or -1 to one of the narrow lanes
    that the hash names. The sum does not depend on the pieces' order."""

    __slots__ = ("wide", "narrow")

    def __init__(self, wide: np.ndarray | None = None, narrow: np.ndarray | None = None):
        self.wide = np.zeros(WIDE, dtype=np.uint64) if wide is None else wide
        self.narrow = np.zeros(LANES, dtype=np.uint16) if narrow is None else narrow

    @classmethod
    def of(cls, pieces: list[bytes]) -> Fingerprint:
        if not pieces:
            return cls()
        wide, narrow = np.zeros(WIDE, dtype=np.uint64), np.zeros(LANES, dtype=np.int64)
        for lo in range(0, len(pieces), 1 << 14):
            digests = b"".join([hashlib.blake2b(p).digest() for p in pieces[lo : lo + (1 << 14)]])
            rows = np.frombuffer(digests, dtype="<u8").reshape(-1, WIDE)
            wide += rows.sum(axis=0, dtype=np.uint64)
            signs = 1 - 2 * (rows[:, 1] & np.uint64(1)).astype(np.int64)
            narrow += np.bincount((rows[:, 0] % np.uint64(LANES)).astype(np.int64), weights=signs, minlength=LANES).astype(np.int64)
        return cls(wide, (narrow & 0xFFFF).astype(np.uint16))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide + other.wide, self.narrow + other.narrow)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide - other.wide, self.narrow - other.narrow)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and bool((self.wide == other.wide).all() and (self.narrow == other.narrow).all())

    __hash__ = None

    def text(self) -> str:
        return base64.b64encode(self.wide.astype("<u8").tobytes() + self.narrow.astype("<u2").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        data = base64.b64decode(text)
        return cls(np.frombuffer(data, "<u8", WIDE).copy(), np.frombuffer(data, "<u2", LANES, 8 * WIDE).copy())

    def likeness(self, other: Fingerprint) -> float:
        """Estimated share of common pieces, twice the common over all: 1 for equal multisets, about 0 for disjoint ones.

        The narrow lanes are a signed sketch, so the squared length of a difference counts the pieces in one but not
        the other, with a relative error of about sqrt(2 / 256)."""
        if self == other:
            return 1.0
        square = lambda x: float((x.astype(np.int16).astype(np.float64) ** 2).sum())
        both = square(self.narrow) + square(other.narrow)
        return min(1.0, max(0.0, 1.0 - square(self.narrow - other.narrow) / both)) if both else 0.0


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last third replaced by the start of the following one, and the code points that stay."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k], len(text) - k


def edited_fingerprint(own: Fingerprint, text: str, pieces: list[bytes], new: str, kept: int) -> Fingerprint:
    """Fingerprint of the edited text from that of the text: pieces behind the cut are taken out, new ones put in.

    Pieces that end before the cut are the same in both texts, since a piece depends only on what is in it and on
    the byte behind it."""
    cut = len(text[:kept].encode())
    ends = np.cumsum([len(p) for p in pieces]) if pieces else np.zeros(0, dtype=np.int64)
    same = int(np.searchsorted(ends, cut, side="left"))
    start = int(ends[same - 1]) if same else 0
    return own - Fingerprint.of(pieces[same:]) + Fingerprint.of(PIECE.findall(new.encode()[start:]))


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the next by descending id, after the last the first. Documents are range-partitioned by
    id, once; each range also gets the first document of the range behind it, so neighbours meet without a global
    order in one task, and a task holds two documents at a time. Null texts are empty; rows without an id come
    last; rows with one id are ordered by text hash and text; a single row is its own next; an empty table gives
    an empty result; other columns are not read."""
    slim = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t"))
    ids = docs.select(F.col(id_col).cast("long").alias("i"))
    bounds = id_bounds(ids, "i", shard_count(ids, rows_per_shard))
    shards = len(bounds) + 1
    # one row per range: its largest id, which comes first
    first = {r["s"]: r["m"] for r in ids.groupBy(shard_of(F.col("i"), bounds, descending=True).alias("s")).agg(F.max("i").alias("m")).collect()}
    order = sorted(first)
    before = {s: order[k - 1] for k, s in enumerate(order)}

    @F.pandas_udf("array<int>")
    def goes_to(ids: pd.Series, own: pd.Series) -> pd.Series:
        heads = [first.get(s) for s in own]
        is_head = [(pd.isna(i) and h is None) or (h is not None and i == h) for i, h in zip(ids, heads, strict=True)]
        return pd.Series([[s, before[s]] if h else [s] for s, h in zip(own.tolist(), is_head, strict=True)])

    placed = slim.withColumn("own", shard_of(F.col("i"), bounds, descending=True))
    placed = placed.select("i", "th", "t", F.posexplode(goes_to("i", "own")).alias("ahead", "to"))
    placed = placed.repartitionById(shards, F.col("to")).sortWithinPartitions("ahead", F.col("i").desc_nulls_last(), "th", "t").select("i", "t", "ahead")
    schema = pa.schema(
        [("i", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
         ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last = None  # the document whose next is still to come
        for batch in batches:
            for i, text, ahead in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                text = text or ""
                pieces = PIECE.findall(text.encode())
                own = Fingerprint.of(pieces)
                if last is not None:
                    yield finished(*last, text, own)
                    last = None
                    if ahead:
                        return
                if not ahead:
                    last = i, text, pieces, own

    def finished(i, text: str, pieces: list[bytes], own: Fingerprint, following: str, next_one: Fingerprint) -> tuple:
        new, kept = edited(text, following)
        changed = edited_fingerprint(own, text, pieces, new, kept)
        digest = hashlib.sha256(new.encode()).hexdigest()
        return i, len(text), digest, own.text(), changed.text(), own.likeness(changed), own.likeness(next_one)

    out = placed.mapInArrow(lambda batches: table_batches(rows(batches), schema, 512), ", ".join(["i long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"]))
    return out.withColumnRenamed("i", id_col)
