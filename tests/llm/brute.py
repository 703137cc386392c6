"""Slow, plain versions of the operators for small tables."""

import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def distance(a, b):
    row, other, steps = np.arange(len(b) + 1), np.array([ord(c) for c in b]), np.arange(len(b) + 1)
    for i, c in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (other != ord(c)))])
        row = np.minimum.accumulate(new - steps) + steps
    return int(row[-1])


MASK = (1 << 64) - 1
PLAIN = {b: (chr(b).lower() if chr(b).isalnum() else "\n" if b == 10 else " ") for b in range(128)}


def scrambled(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def word_hash(word):
    """Hash of a word's bytes; digits are alike."""
    data = re.sub(rb"[0-9]", b"0", word.encode())
    return scrambled((sum(b * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(data)) + len(data)) & MASK)


def line_simhash(words):
    weights = [min(max((len(w.encode()) - 2) * 4 + 1, 1), 61) for w in words]
    hashes = [word_hash(w) for w in words]
    return sum(1 << b for b in range(64) if 2 * sum(w for w, h in zip(weights, hashes, strict=True) if h >> b & 1) > sum(weights))


def line_keys(words, tables=12, together=3):
    """For each table the three smallest word figures, where a long word is smaller more often."""
    races = -np.log((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
    hashes, shares = [word_hash(w) for w in words], [np.float32(1) / np.float32(len(w.encode())) for w in words]
    least = []
    for lane in range(tables * together):
        salted = [scrambled(h + 0x9E3779B97F4A7C15 * (lane // 4 + 1) & MASK) for h in hashes]
        least.append(float(min(races[h >> lane % 4 * 16 & 0xFFFF] * x for h, x in zip(salted, shares, strict=True))))
    return [(t, *(least[part * tables + t] for part in range(together))) for t in range(tables)]


def brute_lines(texts, least=5, chars=20):
    """Cleaned texts by comparing all pairs of distinct lines.

    Two lines are linked if the shorter has 0.8 of the longer's characters, their edit similarity is 0.8 or more and they
    either share a 16-bit block of the SimHash and differ in 12 bits at most, or share a key and differ in 24 at most."""
    occurrences, first = [], {}
    for doc in sorted(texts):
        for n, raw in enumerate(texts[doc].split("\n")):
            line = " ".join("".join(PLAIN.get(ord(c), c) for c in raw.lower()).split(" ")).strip()
            line = re.sub(" +", " ", line)
            if len(line.split(" ")) >= least or len(line) >= chars:
                occurrences.append((doc, n, line))
                first.setdefault(line, (doc, n))
    names = list(first)
    sizes = np.array([len(n) for n in names])
    values = np.array([line_simhash(n.split(" ")) for n in names], dtype=np.uint64)
    keys, numbers = [line_keys(n.split(" ")) for n in names], {}
    keys = np.array([[numbers.setdefault(k, len(numbers)) for k in row] for row in keys]).reshape(len(names), -1)
    groups = Union(len(names))
    for i in range(len(names)):
        x = values[i] ^ values[i + 1 :]
        block = np.zeros(len(x), dtype=bool)
        for b in range(4):
            block |= (x >> np.uint64(16 * b)) & np.uint64(0xFFFF) == 0
        meet = (keys[i + 1 :] == keys[i]).any(axis=1)
        like = (sizes[i + 1 :] * 5 >= sizes[i] * 4) & (sizes[i] * 5 >= sizes[i + 1 :] * 4)
        bits = np.bitwise_count(x)
        for j in np.flatnonzero(like & (block & (bits <= 12) | meet & (bits <= 24))):
            other = names[i + 1 + int(j)]
            if groups.find(i) != groups.find(i + 1 + int(j)) and distance(names[i], other) <= int(max(len(names[i]), len(other)) * (1 - 0.8) + 1e-9):
                groups.join(i, i + 1 + int(j))
    keep = {}
    for i, n in enumerate(names):
        keep[groups.find(i)] = min(keep.get(groups.find(i), first[n]), first[n])
    place, removed = {n: i for i, n in enumerate(names)}, {}
    for doc, n, line in occurrences:
        if keep[groups.find(place[line])] != (doc, n):
            removed.setdefault(doc, set()).add(n)
    return {d: ("\n".join(x for n, x in enumerate(t.split("\n")) if n not in removed.get(d, ())), len(removed.get(d, ()))) for d, t in texts.items()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_sequences(rows, ids_of, capacity=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids_of)
    for doc, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            part = ids_of[doc][at : at + p.length]
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids_of[doc]), crc(part)) and (not hasattr(p, "ids") or p.ids == part)
            at += p.length
        assert at == len(ids_of[doc])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity and {(p.sequence_tokens, p.pad_to) for p in pieces} == {(at, at if at & (at - 1) == 0 else capacity)}
        padding += pieces[0].pad_to - at
    return padding
