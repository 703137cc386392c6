import re
import zlib
from collections import Counter

import numpy as np
from fixtures import FOLDER, docs, odd_docs, texts  # noqa: F401

from meterwise.llm import queries, spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced letter apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts, ratio=5):
    words = sorted(counts)
    by_length, form, out = {}, {}, {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in words:
        others = [o for k in (-1, 0, 1) for o in by_length.get(len(w) + k, []) if o != w and near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
        out[w] = [form[w], w, counts[w], len(others), counts[form[w]] if form[w] else None]
    for w in words:
        while form[out[w][1]]:
            out[w][1] = form[out[w][1]]
    return {w: tuple(v) for w, v in out.items()}


def brute_counts(texts, slips=199, letters=6, least=5):
    counts = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if slips and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= letters and n >= least}


def as_map(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_query_against_brute_force(spark, texts):
    found = queries.QUERIES["op12_bloom_spelling_groups"](spark, FOLDER)
    want = brute_groups(brute_counts(texts.items()))
    assert as_map(found) == want and len(want) > 100
    assert sum(v[0] is not None for v in want.values()) > 5


def test_chains_ties_and_full_filters(spark):
    rng = np.random.default_rng(5)
    counts = {"".join(rng.choice(list("abéÿ"), rng.integers(1, 7))): int(rng.integers(1, 4)) * 5 ** int(rng.integers(0, 5)) for _ in range(600)}
    counts |= {"chains": 5, "chain": 25, "chainé": 125, "chxiné": 625, "aab": 7, "ab": 7, "b": 1, "loneliest": 9}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_map(spelling.spelling_groups(words)) == brute_groups(counts)
    # a filter of one block per length lets nearly all edits pass; the exact join then decides
    assert as_map(spelling.spelling_groups(words, most_bits=64)) == brute_groups(counts)


def test_filters_hold_every_word_and_few_others(spark):
    rng = np.random.default_rng(6)
    words = sorted({"".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(20_000)})
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    bits = spelling.bloom_filters(table)

    def passed(some):
        with np.errstate(over="ignore"):
            letters = spelling._letters(some, 8)
            h = (letters.astype(np.uint64) * spelling._powers(8)[:8]).sum(axis=1, dtype=np.uint64)
            return spelling._probe(h, bits[8]).mean()

    assert list(bits) == [8] and passed(words) == 1
    assert passed(["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(20_000)]) < 0.03
    # what is shuffled is near the true pairs, not the edits
    assert spelling.candidates(table, bits).count() < 20_000 * 8 * 90 * 0.02


def test_odd_rows(spark, odd_docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for slips in (0, 3):
        want = brute_counts(rows, slips, 2, 2)
        assert {r.word: r.n for r in spelling.word_counts(odd_docs, 2, 2, slips=slips).collect()} == want and len(want) > 10
    monkeypatch.setattr(spelling, "COUNTED", 10)
    assert {r.word: r.n for r in spelling.word_counts(odd_docs, 2, 2).collect()} == brute_counts(rows, 0, 2, 2)
    assert as_map(spelling.spelling_variants(odd_docs)) == brute_groups(brute_counts(rows, 0))
    assert spelling.spelling_variants(odd_docs.limit(0)).count() == 0
    assert spelling.spelling_variants(odd_docs.where("text IS NULL OR text = ''")).count() == 0
