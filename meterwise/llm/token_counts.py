"""Token counts per document by a two-tier lookup on the map side; no pre-token is ever shuffled."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import byte_texts, worker_state
from meterwise.llm.vocab import WordCounts, words_of

SAMPLE_DOCUMENTS = 2_000
FREQUENT_WORDS = 16_384


def frequent_lengths(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCUMENTS, entries: int = FREQUENT_WORDS
) -> dict[bytes, int]:
    """Token counts of the most frequent pre-tokens of a bounded, hash-chosen sample of whole documents.

    The table only saves work: what it lacks is encoded, so the choice never changes a result. It holds
    at most `entries` words of at most 64 bytes (under 2 MB), whatever the corpus holds."""
    ids = docs.select(F.col(id_col).alias("i")).where("i IS NOT NULL").orderBy(F.xxhash64("i"), "i").limit(sample)
    picked = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(ids), "i", "left_semi")

    def summaries(batches):
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in byte_texts(batch.column(0)):
                counts.update(words_of(text))
                if len(counts) > 8 * entries:
                    counts = Counter(dict(counts.most_common(entries)))
        kept = [(w, n) for w, n in counts.most_common(entries) if len(w) <= 64]
        yield pa.RecordBatch.from_pydict({"w": pa.array([w for w, _ in kept], pa.binary()), "n": pa.array([n for _, n in kept], pa.int64())})

    # a few tasks, so that at most 4 summaries of a fixed size reach the driver
    parts = picked.select("t").repartition(4).mapInArrow(summaries, "w binary, n long").collect()
    total: Counter[bytes] = Counter()
    for row in parts:
        total[bytes(row["w"])] += row["n"]
    counter = WordCounts(path)
    chosen = sorted(total.items(), key=lambda x: (-x[1], x[0]))[:entries]
    return {w: counter.length(w) for w, _ in chosen}


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048) -> DataFrame:
    """Per row: its id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > max_tokens).

    Counts are those of the `tokenizers` library for the word-level file at `path`, without added special
    tokens; special strings inside texts count as the library counts them. First tier: the broadcast table
    of `frequent_lengths`. Second tier: a bounded cache kept by each worker, filled by encoding what it lacks.

    Null texts count as empty (0 bytes, 0 tokens); null ids stay null; repeated rows give repeated rows; an
    empty table gives an empty result; other columns are not read."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, path, id_col, text_col))

    def count(batches):
        counter = worker_state(f"words:{path}", lambda: WordCounts(path))
        table = frequent.value
        for batch in batches:
            texts = byte_texts(batch.column(1))
            n = [counter.count(t, table) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64()), pa.array([x > max_tokens for x in n], pa.bool_())],
                names=["i", "n_bytes", "n_tokens", "over_limit"],
            )

    slim = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    kind = slim.schema["i"].dataType.simpleString()
    return slim.mapInArrow(count, f"i {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("i", id_col)
