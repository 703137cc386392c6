"""Language identification: presence kernels over blended byte n-grams, Nyström landmarks, kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterwise.llm.common import byte_slices, byte_texts, stored

#: lengths of the n-grams, in UTF-8 bytes
SPECTRUM = (1, 2, 3, 4)
#: labelled rows the regression is fitted on, landmarks among them, bytes of a landmark; all chosen by hashes
LABELLED_ROWS, LANDMARKS, LANDMARK_BYTES = 8_192, 256, 2_048
#: languages told apart at most (those with most rows)
CLASSES = 1_024
RIDGE = 0.001
#: values of the hash that chooses rows
HASHES = 1 << 40
#: texts whose presence vectors form one matrix, and bytes looked up together
BLOCK, CHUNK = 64, 1 << 18

# every ASCII byte but letters becomes a space, capitals are lowered; bytes beyond ASCII stay
PLAIN = bytes(b if b >= 128 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


class Grams(NamedTuple):
    """The n-grams of all landmarks as a hash table with linear probing: codes and their numbers."""

    codes: np.ndarray
    numbers: np.ndarray
    probes: int
    count: int


class Landmarks(NamedTuple):
    """N-gram numbers of all landmarks one after the other, where each begins, and the roots of their sizes."""

    flat: np.ndarray
    starts: np.ndarray
    norms: np.ndarray


def plain_bytes(texts: list[bytes]) -> np.ndarray:
    """Texts as one array of bytes: between zeros, letters only, one space between and around words."""
    joined = np.frombuffer(b"\0" + b"".join([b" " + t.translate(PLAIN) + b" \0" for t in texts]), dtype=np.uint8)
    keep = np.ones(len(joined), dtype=bool)
    keep[1:] = (joined[1:] != 32) | (joined[:-1] != 32)
    return joined[keep]


def gram_codes(data: np.ndarray, n: int) -> np.ndarray:
    """A number for the n bytes at each place, different for different n-grams of any length."""
    wide = data.astype(np.uint64)
    out = wide[: len(wide) - n + 1].copy()
    for k in range(1, n):
        out = out << np.uint64(8) | wide[k : len(wide) - n + 1 + k]
    return out | np.uint64(n << 56)


def _slots(codes: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (codes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def gram_table(codes: np.ndarray) -> Grams:
    """Hash table of distinct codes, at most an eighth full."""
    size = 1 << max(4, (8 * max(1, len(codes)) - 1).bit_length())
    table, numbers = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int32)
    left, probes = np.arange(len(codes)), 0
    while len(left):
        spot = (_slots(codes[left], size) + probes) & (size - 1)
        free = table[spot] == 0
        table[spot[free]] = codes[left[free]]
        won = table[spot] == codes[left]
        numbers[spot[won]] = left[won]
        left, probes = left[~won], probes + 1
    return Grams(table, numbers, probes, len(codes))


def gram_numbers(codes: np.ndarray, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """Places of the codes that the table holds, and their numbers."""
    size = len(grams.codes)
    spot = _slots(codes, size)
    at = grams.codes[spot]
    hit = at == codes
    places, numbers = [np.flatnonzero(hit)], [grams.numbers[spot[hit]]]
    left = np.flatnonzero(~hit & (at != 0))
    for probe in range(1, grams.probes):
        if not len(left):
            break
        spot_of = (spot[left] + probe) & (size - 1)
        at = grams.codes[spot_of]
        hit = at == codes[left]
        places.append(left[hit])
        numbers.append(grams.numbers[spot_of[hit]])
        left = left[~hit & (at != 0)]
    return np.concatenate(places), np.concatenate(numbers)


def presence(texts: list[bytes], grams: Grams) -> np.ndarray:
    """Which n-grams of the table each text has (texts × n-grams, 0 or 1)."""
    data = plain_bytes(texts)
    out = np.zeros((len(texts), grams.count), dtype=np.uint8)
    flat, owner = out.reshape(-1), -1
    for start in range(0, len(data), CHUNK):
        piece = data[start : start + CHUNK + max(SPECTRUM) - 1]
        text = owner + np.cumsum(piece == 0)
        for n in SPECTRUM:
            if len(piece) >= n:
                # n-grams that begin in the overlap are looked up with the next piece
                places, numbers = gram_numbers(gram_codes(piece, n)[:CHUNK], grams)
                flat[text[places] * grams.count + numbers] = 1
        owner = int(text[min(CHUNK, len(piece)) - 1])
    return out


def landmark_sets(texts: list[bytes]) -> tuple[Grams, Landmarks]:
    """The n-grams of the landmarks and which landmark has which."""
    sets = []
    for t in texts:
        data = plain_bytes([t])
        codes = np.unique(np.concatenate([gram_codes(data, n) for n in SPECTRUM if len(data) >= n]))
        # n-grams with a zero byte reach beyond the text
        bytes_of = [(codes >> np.uint64(8 * k) & np.uint64(255) == 0) & (codes >> np.uint64(56) > k) for k in range(max(SPECTRUM))]
        sets.append(codes[~np.logical_or.reduce(bytes_of)])
    known = np.unique(np.concatenate(sets))
    flat = np.concatenate([np.searchsorted(known, s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    return gram_table(known), Landmarks(flat, np.cumsum(sizes) - sizes, np.sqrt(sizes))


def kernel(present: np.ndarray, marks: Landmarks) -> np.ndarray:
    """Cosine of presence vectors with the landmarks': shared n-grams over the root of both numbers of n-grams.

    Of a text's n-grams those count that some landmark has."""
    shared = np.stack([np.add.reduceat(row[marks.flat], marks.starts, dtype=np.int64) for row in present])
    norms = np.sqrt(np.maximum(1, present.sum(axis=1, dtype=np.int64)))
    return shared / norms[:, None] / marks.norms


class Model(NamedTuple):
    """Languages and, for each, a weight per n-gram (n-grams × languages) and an intercept."""

    languages: tuple[str, ...]
    grams: Grams
    weights: np.ndarray
    intercepts: np.ndarray


def solve(inner: np.ndarray, products: np.ndarray, targets: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge regression in the Nyström features: coefficients of the landmarks, then the intercept, per language.

    `inner` is the landmarks' own kernel, `products` and `targets` are the weighted sums of products of the rows'
    kernel values (and a constant 1) with themselves and with the targets; weights add up to 1."""
    values, vectors = np.linalg.eigh(inner)
    good = values > 1e-9 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.zeros((len(inner) + 1, root.shape[1] + 1))
    features[:-1, :-1], features[-1, -1] = root, 1.0
    system = features.T @ products @ features
    system[np.arange(len(system) - 1), np.arange(len(system) - 1)] += ridge
    return features @ np.linalg.solve(system, features.T @ targets)


def compiled(languages: tuple[str, ...], grams: Grams, marks: Landmarks, beta: np.ndarray) -> Model:
    """Scores are linear in the kernel and the kernel is linear in presence, so both products become one."""
    weights = np.zeros((grams.count, len(languages)))
    ends = [*marks.starts[1:].tolist(), len(marks.flat)]
    for k, (a, b) in enumerate(zip(marks.starts.tolist(), ends, strict=True)):
        weights[marks.flat[a:b]] += beta[k] / marks.norms[k]
    return Model(languages, grams, weights.astype(np.float32), beta[-1])


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    """Regression values (texts × languages) by one matrix product for each block of texts."""
    out = np.zeros((len(texts), len(model.languages)))
    for start in range(0, len(texts), BLOCK):
        present = presence(texts[start : start + BLOCK], model.grams)
        norms = np.sqrt(np.maximum(1, present.sum(axis=1, dtype=np.int64)))
        out[start : start + BLOCK] = present.astype(np.float32) @ model.weights / norms[:, None] + model.intercepts
    return out


def _bounded(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most BLOCK rows whose texts are short together (one long text stands alone)."""
    for whole in batches:
        for batch in byte_slices(whole, column, CHUNK):
            for start in range(0, batch.num_rows, BLOCK):
                yield batch.slice(start, BLOCK)


def held_out(id_column: Column) -> Column:
    """Rows whose languages are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(
    docs: DataFrame, rows: int = LABELLED_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> tuple[tuple[str, ...], DataFrame]:
    """The languages and at most `rows` rows in equal parts (i, lang, t), chosen by a hash of the id.

    Null ids, languages and texts, and held-out rows, are left out; of rows with one id and language one counts."""
    known = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    slim = known.select(F.col(id_col).alias("i"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col)).alias("h"))
    common = slim.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(CLASSES).collect()
    languages = tuple(sorted(r["lang"] for r in common))
    share = max(1, rows // max(1, len(languages)))
    if not languages:
        return (), docs.limit(0).select(F.col(id_col).alias("i"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"))
    # rows of each language below a hash bound that lets about twice the share through, so that no task ranks a language
    bounds = [(r["lang"], int(min(1.0, (2 * share + 64) / r["n"]) * HASHES)) for r in common]
    below = docs.sparkSession.createDataFrame(bounds, "lang string, below long")
    few = slim.join(F.broadcast(below), "lang").where(F.pmod("h", F.lit(HASHES)) < F.col("below"))
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(HASHES)), "i")
    chosen = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= share).select("i", "lang")
    texts = known.select(F.col(id_col).alias("i"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"))
    picked = texts.join(F.broadcast(chosen.distinct()), ["i", "lang"])
    return languages, picked.groupBy("i", "lang").agg(F.min("t").alias("t"))


def landmark_texts(sample: DataFrame, languages: tuple[str, ...], landmarks: int = LANDMARKS, size: int = LANDMARK_BYTES) -> list[bytes]:
    """At most `landmarks` passages (2 a language at least) of at most `size` bytes, in equal parts.

    Texts of fewer than a tenth of `size` bytes come last; the passage of a longer text begins at a hashed place."""

    def passages(batches):
        for batch in batches:
            ids, langs, hashes, texts = (batch.column(k).to_pylist() for k in range(4))
            cut = []
            for h, t in zip(hashes, texts, strict=True):
                data = t.encode()
                start = h % (len(data) - size + 1) if len(data) > size else 0
                cut.append(data[start : start + size].decode(errors="ignore").encode())
            yield pa.RecordBatch.from_pydict({"lang": langs, "h": hashes, "short": [10 * len(c) < size for c in cut], "passage": pa.array(cut, pa.binary())})

    some = sample.select("i", "lang", F.xxhash64("i", F.lit(1)).alias("h"), "t").mapInArrow(passages, "lang string, h long, short boolean, passage binary")
    order = Window.partitionBy("lang").orderBy("short", "h", "passage")
    share = max(2, landmarks // max(1, len(languages)))
    rows = some.withColumn("k", F.row_number().over(order)).where(F.col("k") <= share).orderBy("lang", "k").collect()
    return list(dict.fromkeys(bytes(r["passage"]) for r in rows))


def fit(
    docs: DataFrame,
    rows: int = LABELLED_ROWS,
    landmarks: int = LANDMARKS,
    ridge: float = RIDGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model | None:
    """One-versus-rest ridge regressions of the languages; None without rows to learn from.

    Every language counts alike, however many rows it has. The sums of products are added up by tasks; what reaches
    the driver is one matrix of landmarks × landmarks from each of at most eight."""
    languages, chosen = training_rows(docs, rows, id_col, text_col, lang_col)
    if not languages:
        return None
    sample = stored(chosen.coalesce(8), "language-sample")
    grams, marks = landmark_sets(landmark_texts(sample, languages, landmarks))
    shared = sample.sparkSession.sparkContext.broadcast((tuple(grams), tuple(marks)))
    m = len(marks.norms)
    counts = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights = {lang: 1.0 / (n * len(counts)) for lang, n in counts.items()}

    def sums(batches):
        table, sets = Grams(*shared.value[0]), Landmarks(*shared.value[1])
        products, targets = np.zeros((m + 1, m + 1)), np.zeros((m + 1, len(languages)))
        for batch in _bounded(batches, 1):
            langs = batch.column(0).to_pylist()
            values = np.ones((len(langs), m + 1))
            values[:, :-1] = kernel(presence(byte_texts(batch.column(1)), table), sets)
            weighted = values * np.array([weights[x] for x in langs])[:, None]
            products += weighted.T @ values
            # targets are 1 for the language and -1 for all others
            targets += weighted.T @ np.array([[1.0 if x == name else -1.0 for name in languages] for x in langs])
        yield pa.RecordBatch.from_pydict({"g": [products.tobytes()], "b": [targets.tobytes()]})

    products, targets = np.zeros((m + 1, m + 1)), np.zeros((m + 1, len(languages)))
    for row in sample.select("lang", "t").mapInArrow(sums, "g binary, b binary").collect():
        products += np.frombuffer(bytes(row["g"])).reshape(products.shape)
        targets += np.frombuffer(bytes(row["b"])).reshape(targets.shape)
    inner = _inner(grams, marks)
    return compiled(languages, grams, marks, solve(inner, products, targets, ridge))


def _inner(grams: Grams, marks: Landmarks) -> np.ndarray:
    """The landmarks' kernel among themselves, a row at a time."""
    ends, out = [*marks.starts[1:].tolist(), len(marks.flat)], []
    for a, b in zip(marks.starts.tolist(), ends, strict=True):
        row = np.zeros((1, grams.count), dtype=np.uint8)
        row[0, marks.flat[a:b]] = 1
        out.append(kernel(row, marks)[0])
    return np.array(out)


def predicted(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", unknown: str = "und"
) -> DataFrame:
    """Per row: its id, lang_pred and score (0 to 1).

    Whole texts are scored; the language with the largest regression value wins (ties: the smallest name), its score is
    a logistic share of all values. Null texts, texts without a letter, and all texts when there is no model, get
    `unknown` and score 0. Null ids stay null; repeated rows give repeated rows; very long texts are looked up in pieces;
    an empty table gives an empty result; other columns are not read."""
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    slim = docs.select(F.col(id_col).alias("i"), F.when(letters, F.lower(text_col)).alias("t"))
    kind = slim.schema["i"].dataType.simpleString()
    if model is None:
        return slim.select(F.col("i").alias(id_col), F.lit(unknown).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, tuple(model.grams), model.weights, model.intercepts))

    def predict(batches):
        languages, grams, weights, intercepts = shared.value
        own = Model(languages, Grams(*grams), weights, intercepts)
        for batch in _bounded(batches, 1):
            values = scores(byte_texts(batch.column(1)), own)
            best = values.argmax(axis=1)
            shares = 1.0 / np.exp(4.0 * (values - values.max(axis=1)[:, None])).sum(axis=1)
            there = pc.is_valid(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.if_else(there, pa.array([languages[k] for k in best]), unknown),
                    pc.if_else(there, pa.array(shares), 0.0),
                ],
                names=["i", "lang_pred", "score"],
            )

    return slim.mapInArrow(predict, f"i {kind}, lang_pred string, score double").withColumnRenamed("i", id_col)


def languages_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: its id, held_out, lang_pred and score, by a model learned from the rows that are not held out.

    Cases as in `predicted`; without a labelled row every text is unknown."""
    found = predicted(docs, fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col), id_col, text_col)
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score")
