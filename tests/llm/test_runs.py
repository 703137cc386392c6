import hashlib
import re
import zlib

import numpy as np
import pytest
from fixtures import FOLDER, docs, odd_docs, texts  # noqa: F401

from meterwise.llm import queries, runs


def brute_runs(words, least=6, exponent=4):
    """All maximal stretches of every period, by comparing each word with the one a period later."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    t, found, smallest = np.array([numbers[w] for w in words]), [], {}
    for p in range(1, len(t) // exponent + 1):
        edge = np.diff(np.concatenate([[0], t[p:] == t[:-p], [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if b - a + p >= max(least, exponent * p) and smallest.setdefault((a, b + p), p) == p:
                found.append((a, b - a + p, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_difference_cover():
    cover = runs.difference_cover(5)
    assert len(cover) == 6 and {(a - b) % 31 for a in cover for b in cover} == set(range(31))
    with pytest.raises(ValueError):
        runs.difference_cover(6)


def test_common_extensions_of_random_words():
    rng = np.random.default_rng(0)
    for n, kinds in ((1, 1), (5, 2), (200, 1), (500, 2), (900, 5)):
        words = np.concatenate([[-1], rng.integers(0, kinds, n), [-2]])
        lce = runs.CommonExtension(words)
        i, j = rng.integers(1, n + 1, (2, 300))
        i, j = i[i != j], j[i != j]
        want = [next(k for k in range(n + 2) if words[a + k] != words[b + k]) for a, b in zip(i, j, strict=True)]
        assert lce.extend(i, j).tolist() == want


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (9, 3)])
def test_runs_of_random_words(least, exponent, monkeypatch):
    monkeypatch.setattr(runs, "GRID_POINTS", 300)
    monkeypatch.setattr(runs, "LONG_RUN", 8)
    rng = np.random.default_rng(3)
    for _ in range(60):
        many = []
        for _ in range(int(rng.integers(1, 12))):
            n = int(rng.integers(0, 120))
            words, at, p = rng.integers(0, int(rng.integers(1, 4)), n), int(rng.integers(0, n + 1)), int(rng.integers(1, 12))
            many.append(np.array([words[i] if i < at else words[at + (i - at) % p] if at + (i - at) % p < n else 0 for i in range(n)], dtype=np.int64))
        found = runs.find_runs(many, least, exponent)
        assert [[tuple(r) for r in f.tolist()] for f in found] == [brute_runs(t.tolist(), least, exponent) for t in many]


def test_query_against_brute_force(spark, texts):
    found = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    assert set(found) == set(texts)
    some = 0
    for doc, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        want, r = brute_runs(words), found[doc]
        gone = {i for s, size, p in want for i in range(s + p, s + size)}
        some += len(want) > 0
        assert r.n_runs == len(want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
        best = max(want, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best and r.exponent_milli == (1000 * best[1] // best[2] if want else None)
    assert some > 5


def test_odd_rows(spark, odd_docs):
    rows = runs.periodic_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count() and runs.periodic_runs(odd_docs.limit(0)).count() == 0
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[3][0].runs == [] and by_id[3][0].collapsed == "" == by_id[5][0].collapsed
    assert len(by_id[2]) == 2 and sorted(r.collapsed for r in by_id[7]) == ["", "one id with another text and more words"]
    ties = spark.createDataFrame([(1, "x a a a a a a y b b b b b b z"), (2, "a b a b a b a b " * 5000), (3, "q " * 100_000)], "doc_id long, text string")
    found = {r.doc_id: r for r in runs.periodic_runs(ties).collect()}
    assert [tuple(r) for r in found[1].runs] == [(1, 6, 1), (8, 6, 1)] and found[1].collapsed == "x a y b z"
    assert [tuple(r) for r in found[2].runs] == [(0, 40_000, 2)] and found[2].collapsed == "a b"
    assert [tuple(r) for r in found[3].runs] == [(0, 100_000, 1)] and found[3].collapsed == "q"
    edited = {r.doc_id: r.text for r in runs.with_periodic_tails(odd_docs).collect()}
    assert edited[3] is None and edited[5] == ""
