"""Registered queries of the training-data operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_adaptive_scan_neighbours")
def op1_adaptive_scan_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    from meterwise.llm.ann import nearest

    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op2_rule_quality")
def op2_rule_quality(spark: SparkSession, folder: str) -> DataFrame:
    from meterwise.llm.quality import held_out, scored

    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = scored(docs, table(spark, folder, "labels"), threshold=0.3)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from meterwise.llm.token_counts import token_counts

    return token_counts(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), max_tokens=2048)


@query("op4_simhash_near_duplicates")
def op4_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    from meterwise.llm.simhash import near_duplicates

    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS kept FROM p)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, CAST(k // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31 AS INT) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < kept THEN kept END AS refers_to
FROM d
"""


@query("op5_warc_index_merge", WARC_SQL)
def op5_warc_index_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the archives as read back, in the order of the merged capture index."""
    from meterwise.llm.warc import archive_pages

    return archive_pages(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_multiset_fingerprints")
def op6_multiset_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    from meterwise.llm.multiset import fingerprinted

    return fingerprinted(table(spark, folder, "documents"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS h,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source),
c AS (  -- sources in the order in which a rising level reaches three times their size
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(3.0 * source_size) OVER o, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS free
  FROM s WHERE source_size > 0
  WINDOW o AS (ORDER BY source_size / CAST(w AS DOUBLE), source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max(CAST(total - capped AS DOUBLE) / free) AS level FROM c),
t AS (
  SELECT s.source, source_size, w, CASE WHEN source_size = 0 THEN 0.0
    ELSE least(CAST(3 * source_size AS DOUBLE), (SELECT level FROM l) * w) END AS target FROM s),
p AS (
  SELECT d.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS goal,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 3) AS target,
  least(size, greatest(goal - a, 0)) + least(size, greatest(goal - a - source_size, 0)) + least(size, greatest(goal - a - 2 * source_size, 0)) AS taken
FROM p
"""


@query("op7_curriculum_mix", MIX_SQL)
def op7_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Per document in training order (of its first copy; documents that are not taken last)."""
    from meterwise.llm.curriculum import mix
    from meterwise.session import parallelism

    mixed = mix(table(spark, folder, "documents"), weights=(1, 2, 3), most=3)
    first = F.coalesce(F.get("passes", F.lit(0))["position"], F.lit((1 << 63) - 1))
    ordered = mixed.withColumn("p", first).repartitionByRange(parallelism(spark), "p", "doc_id").sortWithinPartitions("p", "doc_id")
    return ordered.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


@query("op8_fuzzy_line_dedup")
def op8_fuzzy_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its cleaned text and the number of lines taken out."""
    from meterwise.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, folder, "documents")).select("doc_id", "text", "removed_lines")


@query("op9_harmonic_packing")
def op9_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    from meterwise.llm.packing import pack

    return pack(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), capacity=1024, end_id=0, with_ids=False)


@query("op10_repair_token_ids")
def op10_repair_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    from meterwise.llm.repair import round_trip

    return round_trip(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's runs; one text in ten has a periodic tail put in first."""
    from meterwise.llm.runs import periodic_runs, with_periodic_tails

    found = periodic_runs(with_periodic_tails(table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.n div -best.p").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op12_bloom_spelling_groups")
def op12_bloom_spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents, one run in 199 with a letter taken out."""
    from meterwise.llm.spelling import spelling_variants

    return spelling_variants(table(spark, folder, "documents"), slips=199)


@query("op11_string_kernel_languages")
def op11_string_kernel_languages(spark: SparkSession, folder: str) -> DataFrame:
    from meterwise.llm.langid import languages_of

    return languages_of(table(spark, folder, "documents").select("doc_id", "text", "lang"))
