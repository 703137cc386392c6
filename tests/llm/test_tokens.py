import random

import numpy as np
import public_tokenizers
import pytest
from brute import check_sequences, crc
from fixtures import docs, odd_docs, texts  # noqa: F401
from tokenizers import Tokenizer

from meterwise.llm.packing import class_sizes, cut_lengths, pack, power_runs
from meterwise.llm.repair import Block, _pair_counts, read_ids, repair, rule_lengths, round_trip, write_block, write_ids
from meterwise.llm.token_counts import token_counts
from meterwise.llm.vocab import ByteIds, WordCounts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\t", "a", "Bc", "é", ".", ",", "12", "'s", " ", "　", "你", "Σ", "İ", "<|endoftext|>", "<|ENDOFTEXT|>", "\x1c", "!", "ab cd", "É"]


@pytest.fixture(scope="module")
def byte_ids(texts):
    library = Tokenizer.from_file(BYTES)
    return {d: [*library.encode(t, add_special_tokens=False).ids, 0] for d, t in texts.items()}


def test_cached_pieces_equal_the_library():
    rng = random.Random(3)
    own, words = ByteIds(BYTES, limit=200), WordCounts(WORDS, limit=200)
    assert own.plain is not None and words.plain is not None
    samples = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    encoded = own.encode_all([s.encode() for s in samples])
    for text, ids in zip(samples, encoded, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.library.encode(text, add_special_tokens=False).ids, repr(text)
        assert words.count(text.encode(), {}) == len(words.library.encode(text, add_special_tokens=False).ids), repr(text)


def test_token_counts(docs, texts, odd_docs):
    library = Tokenizer.from_file(WORDS)
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, WORDS).collect()}
    counts = {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in texts.items()}
    assert found == {d: (len(t.encode()), counts[d], counts[d] > 2048) for d, t in texts.items()}
    odd = token_counts(odd_docs, WORDS)
    assert odd.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = sorted(((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd_docs.collect()))
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in odd.collect()) == expected
    assert token_counts(odd_docs.limit(0), WORDS).count() == 0


def test_lengths_are_cut_into_classes():
    sizes = class_sizes(1024)
    assert sizes == [1 << b for b in range(10, -1, -1)] and class_sizes(12) == [12, 6, 4, 3, 2, 1]
    assert cut_lengths(2 * 1024 + 700, 1024, sizes) == [1024, 1024, 512, 128, 32, 16, 8, 4]
    assert all(sum(cut_lengths(n, 60, class_sizes(60))) == n for n in range(200))
    assert power_runs(13) == [8, 4, 1]


def test_packing_covers_every_token(docs, byte_ids):
    assert check_sequences(pack(docs.repartition(3), BYTES).collect(), byte_ids) == 0


def test_packing_of_odd_rows(spark, odd_docs):
    library = Tokenizer.from_file(BYTES)
    rows = pack(odd_docs.coalesce(1), BYTES, capacity=60).collect()
    assert sum(r.length for r in rows) == sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    for r in rows:
        assert r.offset + r.length <= r.sequence_tokens <= 60
    assert pack(odd_docs.limit(0), BYTES).count() == 0


def test_grammar_round_trip():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 40, 300)
    ids = rng.zipf(1.6, lengths.sum()) % 50
    ids[:200] = 7  # runs of one symbol
    ends = np.cumsum(lengths)
    left, right, symbols, cuts = repair(ids, ends, 50, per_round=16)
    assert len(symbols) < len(ids) and len(left) and (rule_lengths(left, right, 50) >= 2).all()
    block = Block(write_block(10, [None, *range(1, 300)], ids, ends, 50, per_round=16))
    assert block.start == 10 and block.doc_ids[0] is None and block.doc_ids[1:] == list(range(1, 300))
    starts = np.concatenate([[0], ends[:-1]])
    for i in (0, 1, 17, 299):
        assert block.document(i).tolist() == ids[starts[i] : ends[i]].tolist()
    assert block.expand(0, len(block.symbols)).tolist() == ids.tolist()


def test_token_files(spark, docs, byte_ids, odd_docs, tmp_path):
    write_ids(docs.repartition(5), BYTES, str(tmp_path / "ids"), block_ids=5000)
    rows = sorted(read_ids(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.doc_id)
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32, r.ids) == (at, len(byte_ids[r.doc_id]), crc(byte_ids[r.doc_id]), byte_ids[r.doc_id])
        at += r.n_tokens
    assert len(rows) == len(byte_ids)
    odd = round_trip(odd_docs, BYTES).orderBy("start").collect()
    assert [r.doc_id for r in odd] == [None, None, 1, 2, 2, 3, 5, 6, 7, 7, 8]
    assert [r.start for r in odd] == [sum(x.n_tokens for x in odd[:i]) for i in range(len(odd))]
    assert round_trip(odd_docs.limit(0), BYTES).count() == 0


def test_frequent_pairs_are_counted_without_sorting_all():
    """The most frequent pairs are complete, rare ones are left unsorted, and a flat spread falls back to all pairs."""
    rng = np.random.default_rng(4)
    skewed, flat = rng.zipf(1.3, 600_000) % 200_000 << 32 | 7, rng.integers(0, 1 << 40, 600_000)
    for keys, all_sorted in ((skewed, False), (flat, True), (skewed[:1000], True), (skewed[:0], True)):
        ordered, edges, counts = _pair_counts(keys, 500)
        names, want = np.unique(keys, return_counts=True)
        assert (len(ordered) == len(keys)) == all_sorted and counts.sum() == len(ordered)
        assert sorted(counts)[-500:] == sorted(want)[-500:]
        assert dict(zip(ordered[edges].tolist(), counts.tolist(), strict=True)).items() <= dict(zip(names.tolist(), want.tolist(), strict=True)).items()
    ids, ends = (skewed[:400_000] >> 32).astype("<u4"), np.array([0, 1, 150_000, 150_000, 400_000])
    block = Block(write_block(0, [1, 2, 3, None, 5], ids, ends, 200_000))
    assert block.expand(0, len(block.symbols)).tolist() == ids.tolist() and len(block.document(2)) == 149_999
