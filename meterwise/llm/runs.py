"""Periodic runs of words: harmonic grids of positions, extended by difference-cover longest common extensions."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import byte_slices, byte_texts

#: grid points looked at together, so that work memory stays bounded for texts of any length
GRID_POINTS = 1 << 18
#: runs from this many words on spare later grid points inside them
LONG_RUN = 256


def difference_cover(order: int) -> tuple[int, ...]:
    """A smallest set of residues modulo order² + order + 1 of which every residue is a difference."""
    modulus = order * order + order + 1

    def extend(chosen: tuple[int, ...], seen: frozenset[int]) -> tuple[int, ...] | None:
        if len(chosen) == order + 1:
            return chosen
        for x in range(chosen[-1] + 1, modulus):
            new = {(x - c) % modulus for c in chosen} | {(c - x) % modulus for c in chosen}
            if len(new) == 2 * len(chosen) and not new & seen:
                found = extend((*chosen, x), seen | new)
                if found:
                    return found
        return None

    found = extend((0, 1), frozenset({1, modulus - 1}))
    if found is None:
        raise ValueError(f"no perfect cover of order {order}")
    return found


class CommonExtension:
    """Longest common extensions of positions of an integer sequence.

    Only suffixes at the residues of a difference cover are sorted: by their first `v` words, then by
    doubling, which stays inside the sample. A query compares fewer than `v` words until both positions are
    sampled and takes the rest from a range minimum over the common prefixes of neighbours in sorted order.
    The sequence must begin and end with values that occur once, and so must all stretches that queries must
    not leave."""

    def __init__(self, words: np.ndarray, order: int = 5):
        cover = difference_cover(order)
        self.v, self.k = order * order + order + 1, order + 1
        v = self.v
        self.text = np.concatenate([words, np.full(v, words[-1])]).astype(np.int32)
        n = len(words)
        place = np.full(v, -1)
        place[list(cover)] = np.arange(self.k)
        self.place = place
        inside = place >= 0
        shifts = np.arange(v)
        both = inside[(shifts[:, None, None] + shifts) % v] & inside[(shifts[None, :, None] + shifts) % v]
        self.shift = both.argmax(axis=2).astype(np.int64)
        positions = (np.arange(-(-n // v))[:, None] * v + np.array(cover)).ravel()
        positions = positions[positions < n]
        levels = [self._block_ranks(positions)]
        step = v
        while levels[-1].max(initial=0) + 1 < len(positions):
            rank = levels[-1].astype(np.int64)
            after = np.zeros(len(positions), dtype=np.int64)
            there = positions + step < n
            after[there] = rank[self._spot(positions[there] + step)] + 1
            levels.append(np.unique(rank * (len(positions) + 1) + after, return_inverse=True)[1].astype(np.int32))
            step *= 2
        self.rank = levels[-1].astype(np.int64)
        order_of = np.argsort(self.rank)
        self.minima = [self._neighbour_prefixes(positions, order_of, levels, n)]
        while (1 << len(self.minima)) <= len(self.minima[0]):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def _spot(self, positions: np.ndarray) -> np.ndarray:
        """Number of a sampled position in the sample."""
        return positions // self.v * self.k + self.place[positions % self.v]

    def _block_ranks(self, positions: np.ndarray) -> np.ndarray:
        """Ranks of the sampled positions by their first `v` words."""
        windows = np.lib.stride_tricks.sliding_window_view(self.text, self.v)
        blocks = np.ascontiguousarray(windows[positions].astype(">i4"))
        keys = blocks.view(np.dtype((np.void, 4 * self.v))).ravel()
        return np.unique(keys, return_inverse=True)[1].astype(np.int32)

    def _neighbour_prefixes(self, positions: np.ndarray, order_of: np.ndarray, levels: list[np.ndarray], n: int) -> np.ndarray:
        """Common prefixes of neighbours in sorted order: doubled blocks first, then single words."""
        a, b = positions[order_of[:-1]], positions[order_of[1:]]
        length = np.zeros(len(a), dtype=np.int64)
        for level in range(len(levels) - 1, -1, -1):
            rank = levels[level]
            live = np.flatnonzero(np.maximum(a, b) + length < n)
            same = rank[self._spot(a[live] + length[live])] == rank[self._spot(b[live] + length[live])]
            length[live[same]] += self.v << level
        return length + self._compare(a + length, b + length, np.full(len(a), self.v))

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, `most` at most (each less than or equal to v)."""
        out = np.zeros(len(i), dtype=np.int64)
        live = np.flatnonzero(most > 0)
        for t in range(int(most.max(initial=0))):
            live = live[self.text[i[live] + t] == self.text[j[live] + t]]
            if not len(live):
                break
            out[live] = t + 1
            live = live[most[live] > t + 1]
        return out

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from the different positions i and j on."""
        shift = self.shift[i % self.v, j % self.v]
        out = self._compare(i, j, shift)
        far = np.flatnonzero(out == shift)
        a, b = self.rank[self._spot(i[far] + shift[far])], self.rank[self._spot(j[far] + shift[far])]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.log2(high - low).astype(np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.minima[k]
            out[far[at]] += np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out


def _grid(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, exponent: int):
    """Points (text, position, period) at multiples of each period that three periods in a row may match.

    Words that equal the word a period later fill exponent - 1 periods or more in a run, so the grid of a
    period has exponent - 1 points there; the sums over all periods are harmonic: n log n points."""
    periods = sizes // exponent
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (sizes[text] - 1) // period - (exponent - 2)
    ends = np.cumsum(points)
    at = 0
    while at < len(text):
        # one period of one text may be larger than the bound alone; its points are at most the text's words
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GRID_POINTS, side="right")))
        n = points[at:stop]
        which = np.repeat(np.arange(at, stop), n)
        step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        p = period[which]
        g = starts[text[which]] + step * p
        for ahead in range(exponent - 1):
            match = words[g + ahead * p] == words[g + (ahead + 1) * p]
            which, p, g = which[match], p[match], g[match]
        if len(g):
            yield text[which], g, p
        at = stop


def find_runs(texts: list[np.ndarray], least: int = 6, exponent: int = 4) -> list[np.ndarray]:
    """For each sequence of non-negative numbers its runs: rows (start, length, period), by start, then period.

    A run is a maximal stretch with smallest period q and length >= max(least, exponent * q), exponent >= 2."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out = [np.zeros((0, 3), dtype=np.int64) for _ in texts]
    busy = np.flatnonzero(sizes >= max(least, exponent))
    words, starts = _joined([texts[i] for i in busy])
    marked = np.zeros(len(busy), dtype=bool)
    for text, _, _ in _grid(words, starts, sizes[busy], exponent):
        marked[text] = True
    if not marked.any():
        return out
    # suffixes are sorted only for the texts that have a grid point left
    live = np.flatnonzero(marked)
    words, starts = _joined([texts[i] for i in busy[live]])
    forward, backward = CommonExtension(words), CommonExtension(words[::-1].copy())
    rows = [np.zeros((0, 4), dtype=np.int64)]
    inside, until = np.ones(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
    for row, g, p in _grid(words, starts, sizes[busy[live]], exponent):
        # a multiple of a known run's period finds that run again
        new = (g + p >= until[g]) | (p % inside[g] != 0)
        row, g, p = row[new], g[new], p[new]
        left = backward.extend(len(words) - g, len(words) - g - p)
        length = left + forward.extend(g, g + p) + p
        keep = length >= np.maximum(least, exponent * p)
        rows.append(np.unique(np.stack([row, g - left, length, p], axis=1)[keep], axis=0))
        for _, start, n, period in rows[-1][rows[-1][:, 2] >= LONG_RUN].tolist():
            inside[start : start + n], until[start : start + n] = period, start + n
    table = np.unique(np.concatenate(rows), axis=0)
    # multiples of a period cover the same stretch: the smallest comes first
    first = np.ones(len(table), dtype=bool)
    first[1:] = (table[1:, :3] != table[:-1, :3]).any(axis=1)
    table = table[first]
    table = table[np.lexsort((table[:, 3], table[:, 1], table[:, 0]))]
    cuts = np.searchsorted(table[:, 0], np.arange(len(live) + 1))
    for row, i in enumerate(busy[live]):
        out[i] = table[cuts[row] : cuts[row + 1], 1:] - np.array([starts[row], 0, 0])
    return out


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All sequences in one, each followed by a number of its own (one before the first too), and their starts."""
    parts: list[np.ndarray] = [np.array([-1])]
    for i, t in enumerate(texts):
        parts += [t, np.array([-2 - i])]
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    return np.concatenate(parts).astype(np.int32), 1 + np.cumsum(sizes) - sizes


def repeated_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n words a run holds after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """Per row: its id, `runs` (start, length and period in words, by start, then period) and `collapsed`, the
    words that no run holds after its first period, joined by one space.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text, numbered from 0. A run is a stretch of consecutive words
    with smallest period q (words q apart are equal) and at least max(least, exponent * q) words that no
    neighbouring word extends keeping q. Rows are independent, nothing is shuffled.

    Null and blank texts have no runs and an empty collapsed text; a very long text is handled whole, its grid in
    bounded blocks; null ids stay null; repeated rows give repeated rows; an empty table gives an empty result;
    other columns are not read."""
    slim = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    kind = slim.schema["i"].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for batch in byte_slices(whole, 1):
                numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
                texts = [t.split() for t in byte_texts(batch.column(1))]
                codes = [np.fromiter(map(numbers.__getitem__, t), dtype=np.int64, count=len(t)) for t in texts]
                found = find_runs(codes, least, exponent)
                collapsed = []
                for words, runs in zip(texts, found, strict=True):
                    if len(runs):
                        gone = repeated_words(runs, len(words))
                        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    collapsed.append(b" ".join(words))
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.concatenate([np.zeros((0, 3), dtype=np.int64), *found])
                rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), rows), pc.cast(pa.array(collapsed, pa.binary()), pa.string())],
                    names=["i", "runs", "collapsed"],
                )

    out = slim.mapInArrow(run, f"i {kind}, runs array<struct<start long, length long, period long>>, collapsed string")
    return out.withColumnRenamed("i", id_col)


def with_periodic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text, where the text of one document in ten (by crc32 of its id) repeats a few of its words to its end.

    With h = crc32 of the decimal id and g = h div 10: if h mod 10 = 0, word i >= a becomes word a + (i - a) mod p, where
    a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Texts without words, null texts and null ids stay."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def edited(words):
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        places = F.transform(F.array(F.struct(a.cast("int").alias("a"), p.cast("int").alias("p"))), lambda s: F.transform(
            words, lambda w, i: F.when(i < s["a"], w).otherwise(F.get(words, s["a"] + (i - s["a"]) % s["p"]))
        ))
        return F.array_join(F.get(places, F.lit(0)), " ")

    # the words are bound once, as a variable
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, edited(w))), F.lit(0))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    return docs.select(F.col(id_col), F.when(chosen, F.coalesce(text, F.col(text_col))).otherwise(F.col(text_col)).alias(text_col))
