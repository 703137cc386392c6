"""Spelling variants: words one edit apart, found by probing Bloom filters with generated edits."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import byte_slices, stored

#: letters of words, and what they may be replaced by: A-Z are lowered first
RUN = "[A-Za-zÀ-ÿ]+"
LETTERS = bytes([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])

#: bits of all filters together, and bits wanted per word; beyond the bound filters get denser, the result stays exact
MOST_BITS = 1 << 29
WORD_BITS = 16
#: 64-bit blocks of a filter in one collected piece
PIECE = 8192
#: words that a task counts at once before it passes them on
COUNTED = 400_000

BASE = 0x9E3779B97F4A7C15


def word_counts(
    docs: DataFrame, least_letters: int = 6, least_count: int = 5, id_col: str = "doc_id", text_col: str = "text", slips: int = 0
) -> DataFrame:
    """Words (`word`, `n` occurrences) of whole texts with enough letters and occurrences.

    Words are maximal runs of Latin letters up to U+00FF, A-Z lowered. With `slips` > 0, a run loses a letter
    in the texts where the crc32 of `id:run` is a multiple of it (the letter at crc32 mod length). Each task adds up
    its own words before they are shuffled, so a frequent word is one row per task. Null texts have no words."""
    find = re.compile(RUN).findall
    lower = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        total: Counter[str] = Counter()
        for whole in batches:
            for batch in byte_slices(whole, 1):
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    words = Counter(find(text.translate(lower) if text else ""))
                    if slips:
                        words = _slipped(words, zlib.crc32(f"{key}:".encode()), slips)
                    for word, n in words.items():
                        if len(word) >= least_letters:
                            total[word] += n
            if len(total) > COUNTED:
                yield pa.RecordBatch.from_pydict({"word": list(total.keys()), "n": list(total.values())}, schema=schema)
                total = Counter()
        yield pa.RecordBatch.from_pydict({"word": list(total.keys()), "n": list(total.values())}, schema=schema)

    slim = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    counts = slim.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _slipped(words: Counter[str], start: int, slips: int) -> Counter[str]:
    """The words of a text after the slips; `start` is the crc32 of its id and a colon."""
    out: Counter[str] = Counter()
    for word, n in words.items():
        h = zlib.crc32(word.encode(), start)
        if h % slips == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _powers(length: int) -> np.ndarray:
    out = np.empty(length + 1, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        for i in range(length):
            out[i + 1] = out[i] * np.uint64(BASE)
    return out


def _blocks_and_masks(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The one 64-bit block that a word's bits lie in, and its four bits there."""
    h = _mixed(h)
    block = (h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    mask = np.zeros(len(h), dtype=np.uint64)
    for shift in (0, 6, 12, 18):
        mask |= np.uint64(1) << (h >> np.uint64(shift) & np.uint64(63))
    return block.astype(np.int64), mask


def _letters(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(-1, length)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], list[int]]]:
    """Words and their second column, in groups of one length."""
    words, more = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    groups: dict[int, tuple[list[str], list[int]]] = {}
    for word, n in zip(words, more, strict=True):
        group = groups.setdefault(len(word), ([], []))
        group[0].append(word)
        group[1].append(n)
    for length, (some, n) in groups.items():
        yield length, some, n


def bloom_filters(vocabulary: DataFrame, most_bits: int = MOST_BITS) -> dict[int, np.ndarray]:
    """A blocked Bloom filter for each word length: all bits of a word lie in one 64-bit block.

    Filters get WORD_BITS bits per word, all together at most `most_bits`, so what is collected and broadcast is
    bounded whatever the vocabulary holds. Tasks build pieces of PIECE blocks; only those reach the driver."""
    sizes = {r["k"]: r["n"] for r in vocabulary.groupBy(F.char_length("word").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    scale = min(1.0, most_bits / max(1, WORD_BITS * sum(sizes.values())))
    blocks = {k: max(1, int(n * WORD_BITS * scale) // 64) for k, n in sizes.items()}

    def bits(batches):
        for batch in batches:
            for length, words, _ in _by_length(batch):
                with np.errstate(over="ignore"):
                    h = (_letters(words, length).astype(np.uint64) * _powers(length)[:length]).sum(axis=1, dtype=np.uint64)
                    block, mask = _blocks_and_masks(h, blocks[length])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(block), length, dtype=np.int32)), pa.array(block // PIECE), pa.array((block % PIECE).astype(np.int32)), pa.array(mask.view(np.int64))],
                    names=["length", "piece", "block", "mask"],
                )

    def merge(group: pa.Table) -> pa.Table:
        piece = np.zeros(PIECE, dtype=np.uint64)
        np.bitwise_or.at(piece, group["block"].to_numpy(), group["mask"].to_numpy().view(np.uint64))
        return pa.table({"length": group["length"][:1], "piece": group["piece"][:1], "bits": pa.array([piece.tobytes()], pa.binary())})

    spread = vocabulary.select("word", "n").mapInArrow(bits, "length int, piece long, block int, mask long")
    # equal blocks are merged on the map side first
    spread = spread.groupBy("length", "piece", "block").agg(F.bit_or("mask").alias("mask"))
    pieces = spread.groupBy("length", "piece").applyInArrow(merge, "length int, piece long, bits binary")
    out = {k: np.zeros(n, dtype=np.uint64) for k, n in blocks.items()}
    for row in pieces.collect():
        some = np.frombuffer(bytes(row["bits"]), dtype=np.uint64)
        start = row["piece"] * PIECE
        target = out[row["length"]][start : start + PIECE]
        target[:] = some[: len(target)]
    return out


def _edits(letters: np.ndarray, filters: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
    """Edits of words of one length that a filter may hold: (word numbers, positions, new letter or None).

    Hashes are polynomials, so an edit's hash follows from the word's: a replaced letter changes one term, and
    a deleted one shifts the terms after it. Deleting any of several equal neighbours gives the same word: the last
    one counts."""
    count, length = letters.shape
    power = _powers(length)
    terms = letters.astype(np.uint64) * power[:length]
    whole = terms.sum(axis=1, dtype=np.uint64)
    if length - 1 in filters:
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        moved = letters[:, 1:].astype(np.uint64) * power[: length - 1]
        after = np.zeros((count, length), dtype=np.uint64)
        after[:, :-1] = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        last = np.ones((count, length), dtype=bool)
        last[:, :-1] = letters[:, 1:] != letters[:, :-1]
        row, at = np.nonzero(last)
        hit = _probe((before + after)[row, at], filters[length - 1])
        yield row[hit], at[hit], None
    if length in filters:
        for letter in LETTERS:
            change = whole[:, None] + np.uint64(letter) * power[:length] - terms
            row, at = np.nonzero(letters != letter)
            hit = _probe(change[row, at], filters[length])
            yield row[hit], at[hit], letter


def _probe(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    block, mask = _blocks_and_masks(h, len(bits))
    return bits[block] & mask == mask


def candidates(vocabulary: DataFrame, filters: dict[int, np.ndarray]) -> DataFrame:
    """Generated edits that pass the filters: word, n, edit, same_length. Each edit comes once per word."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(filters)

    def probe(batches):
        bits = shared.value
        for whole in batches:
            for length, words, n in _by_length(whole):
                # the edits of a few hundred words are looked up together, of long words fewer
                step = max(1, 4096 // length)
                for start in range(0, len(words), step):
                    some, counts = words[start : start + step], n[start : start + step]
                    with np.errstate(over="ignore"):
                        for row, at, letter in _edits(_letters(some, length), bits):
                            if len(row):
                                new = "" if letter is None else chr(letter)
                                picked = [(some[r], counts[r], some[r][:k] + new + some[r][k + 1 :]) for r, k in zip(row.tolist(), at.tolist(), strict=True)]
                                w, c, e = zip(*picked, strict=True)
                                yield pa.RecordBatch.from_arrays(
                                    [pa.array(w), pa.array(c, pa.int64()), pa.array(e), pa.array([letter is not None] * len(w))],
                                    names=["word", "n", "edit", "same_length"],
                                )

    return vocabulary.select("word", "n").mapInArrow(probe, "word string, n long, edit string, same_length boolean")


def near_words(vocabulary: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Words one inserted, deleted or replaced letter apart, both ways: word, n, near, near_n.

    `vocabulary` holds distinct words with n. What the filters let pass is joined with the vocabulary itself,
    so false positives go and no pair is lost. Pairs are never formed inside a group."""
    found = candidates(vocabulary, bloom_filters(vocabulary, most_bits))
    known = vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("near_n"))
    exact = found.join(known, "edit").select("word", "n", F.col("edit").alias("near"), "near_n", "same_length")
    # a deletion is found from the longer word only; replacements from both
    back = F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    there = F.struct("word", "n", "near", "near_n")
    both = F.when(F.col("same_length"), F.array(there)).otherwise(F.array(there, back))
    return exact.select(F.inline(both))


def roots(links: DataFrame) -> DataFrame:
    """The last form that each linked word leads to: word, root. `links` holds word and form.

    Each round doubles how far a word sees, so a chain of d forms takes log d rounds; a form has several times the
    occurrences of its word, so chains are short and never closed."""
    reached = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = reached.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stored(step, "roots")
        reached = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reached


def spelling_groups(vocabulary: DataFrame, ratio: Column | int = 5, most_bits: int = MOST_BITS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    `form` is the near word with the largest n (ties: smallest in code-point order) if that is at least `ratio` times
    the word's own n, else null with a null form_n; `root` follows forms to the last (the word itself if it has
    none); n_near counts near words.

    `vocabulary` holds distinct words of letters up to U+00FF with their n, as `word_counts` returns them; an
    empty vocabulary gives an empty result. Very long words only make more edits."""
    kept = stored(vocabulary.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(kept, most_bits).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = kept.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    enough = F.col("form_n") >= F.lit(ratio) * F.col("n")
    formed = stored(joined.select("word", F.when(enough, F.col("form")).alias("form"), "n", "n_near", F.when(enough, F.col("form_n")).alias("form_n")), "forms")
    last = roots(formed.where("form IS NOT NULL"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: int = 0) -> DataFrame:
    """`spelling_groups` of the words of whole texts with at least 6 letters and 5 occurrences.

    Null and empty texts have no words; a null id counts as the text `None` where slips are drawn; repeated rows count
    each; very long texts are counted whole; an empty table gives an empty result; other columns are not read."""
    return spelling_groups(word_counts(docs, 6, 5, id_col, text_col, slips))
