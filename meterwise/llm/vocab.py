"""Ids and token counts of whole texts, equal to the `tokenizers` library, through caches of words.

White space always ends a pre-token in both vocabularies, so a text's ids are those of its pieces
one after the other. A worker keeps the ids of pieces it has seen; what it has not seen is encoded
from the same vocabulary file. Texts with special strings or runs of mixed white space are given to
the library whole.
"""

from __future__ import annotations

import json
import sys
from array import array

import numpy as np
import regex

# The split pattern of byte-level vocabularies, and a probe for the self-check.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PROBE = " The naïve café's 12,345 größten añadió?! don't (x=3.5) -- foo_bar\n"

#: pieces with characters beyond this go to the library, whose character classes then decide
LAST_PLAIN = "ɏ"


def _byte_symbols() -> dict[str, int]:
    """Byte of each symbol of a byte-level vocabulary: printable bytes stand for themselves, others follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def _u4(ids: list[int]) -> bytes:
    packed = array("I", ids)
    return packed.tobytes() if packed.itemsize == 4 and sys.byteorder == "little" else np.array(ids, dtype="<u4").tobytes()


class ByteIds:
    """Ids of a byte-level BPE file as little-endian unsigned 32-bit bytes.

    A text is cut before each space; the pieces' ids are kept up to `limit` pieces. When most pieces
    are new to a full table, it starts afresh."""

    def __init__(self, path: str, limit: int = 600_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.limit = limit
        self.seen: dict[bytes, bytes] = {}
        self.lengths = np.zeros(0, dtype=np.int64)
        self.plain = self._plain_encoder(path)

    def _plain_encoder(self, path: str):
        """The same merges in a quicker encoder, if the file is of the plain kind and both agree on a probe."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        if not plain or model["type"] != "BPE" or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix"):
            return None
        symbols = _byte_symbols()
        ranks = {bytes(symbols[c] for c in token): i for token, i in model["vocab"].items() if all(c in symbols for c in token)}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged):
            return None
        quick = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.lengths[list(ranks.values())] = [len(token) for token in ranks]
        return quick if quick.encode_ordinary(PROBE) == self.library.encode(PROBE, add_special_tokens=False).ids else None

    def _library_ids(self, text: str) -> bytes:
        return _u4(self.library.encode(text, add_special_tokens=False).ids)

    def _pieces_ids(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces that follow a space and do not start with white space."""
        text = b" " + b" ".join(pieces)
        if self.plain is None or max(text.decode()) > LAST_PLAIN:
            plain = [] if self.plain is None else [p for p in pieces if not p or max(p.decode()) <= LAST_PLAIN]
            chosen = set(plain)
            found = {p: self._library_ids(" " + p.decode()) for p in pieces if p not in chosen}
            return found | (self._pieces_ids(plain) if plain else {})
        ids = self.plain.encode_ordinary(text.decode())
        packed = _u4(ids)
        ends = np.cumsum(self.lengths[ids])
        cuts = np.searchsorted(ends, np.cumsum([len(p) + 1 for p in pieces])) + 1
        bounds = [0, *(4 * cuts).tolist()]
        return {p: packed[a:b] for p, a, b in zip(pieces, bounds[:-1], bounds[1:], strict=True)}

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each whole text given as UTF-8."""
        out: list[bytes | None] = []
        split, looked_up, new = [], [], set()
        for data in texts:
            whole = any(s in data for s in self.special)
            pieces = [] if whole or not data else data.split(b" ")
            found = list(map(self.seen.get, pieces[1:]))
            if None in found:
                fresh = {p for p, ids in zip(pieces[1:], found, strict=True) if ids is None}
                if any(not p or p[0] <= 32 or p[0] >= 0x80 and p.decode()[0].isspace() for p in fresh):
                    whole = whole or not _cuts_hold(pieces)
                if not whole:
                    new |= fresh
            out.append(self._library_ids(data.decode()) if whole else None if data else b"")
            split.append(pieces)
            looked_up.append(found)
        extra = self._pieces_ids(list(new)) if new else {}
        for i, pieces in enumerate(split):
            if out[i] is None:
                found = looked_up[i]
                if None in found:
                    found = [ids if ids is not None else extra[p] for p, ids in zip(pieces[1:], found, strict=True)]
                out[i] = self._first_ids(pieces[0]) + b"".join(found)
        self._keep(extra, sum(len(f) for f in looked_up))
        return out

    def _first_ids(self, piece: bytes) -> bytes:
        """A piece with no space before it, kept under a key that no other piece has."""
        key = b" " + piece
        ids = self.seen.get(key)
        if ids is None:
            text = piece.decode()
            quick = self.plain is not None and text and max(text) <= LAST_PLAIN
            ids = _u4(self.plain.encode_ordinary(text)) if quick else self._library_ids(text)
            if len(piece) <= 64 and len(self.seen) < self.limit:
                self.seen[key] = ids
        return ids

    def _keep(self, extra: dict[bytes, bytes], looked_up: int) -> None:
        """Blank pieces are never kept: they show where cuts must be looked at."""
        kept = {p: ids for p, ids in extra.items() if 0 < len(p) <= 64 and not p.decode()[0].isspace()}
        if len(self.seen) + len(kept) > self.limit:
            if 3 * len(extra) < looked_up:
                return
            self.seen = {}
        self.seen.update(kept)


def _cuts_hold(pieces: list[bytes]) -> bool:
    """Whether every cut before a space is a pre-token's end: not inside a run of white space, but for its last space."""
    for before, piece, i in zip(pieces, pieces[1:], range(len(pieces)), strict=False):
        if (not piece or piece.decode()[0].isspace()) and (before and before.decode()[-1].isspace() or not before and i > 0):
            return False
    return True


# Fixed value: the pre-token pattern of the word-level vocabulary.
WORD_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
#: stands for the end-of-word mark in the quicker encoder; words that hold it go to the library
END = "\x01"
#: words of these characters need no normal form, lower to single characters and hold no white space
PLAIN_WORD = regex.compile(r"[!-~\u00A1-\u012F\u0131-\u024F]+")


class WordCounts:
    """Token counts of a word-level BPE file (lower case, white space dropped): a table of frequent words
    first, then the worker's cache, then an encoder."""

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.limit = limit
        self.seen: dict[bytes, int] = {}
        self.pattern = regex.compile(WORD_LEVEL_PATTERN)
        self.plain = self._plain_encoder(path)

    def _plain_encoder(self, path: str):
        """The same merges in a quicker encoder, the end-of-word mark as a byte that merges first."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], json.dumps([spec.get("normalizer"), spec.get("pre_tokenizer")])
        mark = model.get("end_of_word_suffix")
        if model["type"] != "BPE" or not mark or '"Lowercase"' not in cut or json.dumps(WORD_LEVEL_PATTERN) not in cut:
            return None
        symbols, ranks = _byte_symbols(), {}
        for token, i in model["vocab"].items():
            body = token.removesuffix(mark)
            if body and all(c in symbols for c in body):
                ranks[bytes(symbols[c] for c in body) + END.encode() * (body != token)] = i
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        ends = [i for token, i in model["vocab"].items() if token.endswith(mark) and len(token) == len(mark) + 1]
        if merged != sorted(merged) or max(ends) > merged[0] or len(ends) != 256 or len(set(ranks.values())) != len(ranks):
            return None
        quick = tiktoken.Encoding("words", pat_str=f"[^{END}]+{END}", mergeable_ranks=ranks, special_tokens={})
        ids = quick.encode_ordinary("".join(p + END for p in self.pattern.findall(PROBE.lower())))
        return quick if ids == self.library.encode(PROBE, add_special_tokens=False).ids else None

    def length(self, word: bytes) -> int:
        text = word.decode()
        if self.plain is None or "<|" in text or not PLAIN_WORD.fullmatch(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        return len(self.plain.encode_ordinary("".join([p + END for p in self.pattern.findall(text.lower())])))

    def count(self, data: bytes, frequent: dict[bytes, int]) -> int:
        """Tokens of a whole text given as UTF-8."""
        words = words_of(data)
        found = list(map(frequent.get, words))
        if None not in found:
            return sum(found)
        total, seen = 0, self.seen
        for word, n in zip(words, found, strict=True):
            if n is None:
                n = seen.get(word)
                if n is None:
                    n = self.length(word)
                    if len(word) <= 64:
                        if len(seen) >= self.limit:
                            seen.clear()
                        seen[word] = n
            total += n
        return total


def words_of(data: bytes) -> list[bytes]:
    """White-space separated words; ASCII capitals are lowered unless special strings may occur."""
    return (data if b"<|" in data else data.lower()).split()
