import duckdb
import numpy as np
from pyspark.sql import functions as F

from meterwise.llm import ann, queries
from meterwise.llm.warc import LoserTree, archive_pages, entry_key, url_key

FOLDER = "/root/testdata/sf0.001"


def key(r):
    return entry_key((r.url_key, r.captured, r.page_id, 0, "", "", None, r.archive, r.record_offset))


def test_loser_tree():
    rng = np.random.default_rng(1)
    for runs in (0, 1, 2, 3, 7, 16):
        parts = [sorted((f"u{x}", int(x), int(x), 0, "", "", None, f"a{r}", i) for i, x in enumerate(rng.integers(0, 9, rng.integers(0, 8)))) for r in range(runs)]
        parts = [sorted(p, key=entry_key) for p in parts]
        assert list(LoserTree(parts)) == sorted((e for p in parts for e in p), key=entry_key)


def test_url_keys():
    assert url_key("https://Blog.example.com:80/a?b=1#c") == "com,example,blog)/a?b=1" and url_key(None) == "" and url_key("http://[bad") == "http://[bad"


def test_archives_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    found = {tuple(r) for r in queries.QUERIES["op5_warc_index_merge"](spark, FOLDER).collect()}
    assert found == {tuple(r) for r in con.execute(queries.ORACLE["op5_warc_index_merge"]).fetchall()}


def test_copies_and_odd_pages(spark, monkeypatch):
    rows = [(i, f"http://a.b/{i % 5}", "hot payload", "x") for i in range(300)] + [(i, None, f"p{i // 2}", "x") for i in range(300, 340)]
    rows += [(None, None, "hot payload", "x"), (None, "u", None, "x"), (900, "ht tp://[", "", "x"), (901, "http://z.y:80/?q#f", "long " * 50000, "x"), (901, "http://z.y:80/?q#f", "long " * 50000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(4)
    found = archive_pages(pages).collect()
    assert [key(r) for r in found] == sorted(key(r) for r in found) and len(found) == len(rows)
    by_id = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in found}
    assert by_id[299] == ("response", None, 11) and by_id[0] == ("revisit", 299, 11)
    assert by_id[300] == ("revisit", 301, 4) and by_id[301] == ("response", None, 4) and by_id[901] == ("response", None, 250000)
    assert sorted((r.refers_to, r.payload_bytes) for r in found if r.page_id is None) == [(299, 11), (900, 0)]
    assert {r.record_type for r in archive_pages(pages, least_bytes=12).collect()} == {"response"}
    assert archive_pages(pages.limit(0)).count() == 0


def brute(ids, vectors, queries_of, k):
    width = max(map(len, vectors))
    x = np.array([[*v, *[0.0] * (width - len(v))] for v in vectors])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries_of:
        s = x @ x[ids.index(q)]
        out[q] = [(ids[j], s[j]) for j in sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-round(s[j], 12), ids[j]))[:k]]
    return out


def test_recall_and_exact_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.collect()
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows], [r.vec_id for r in rows if r.vec_id % 50 == 0], 5)
    hits = 0
    found = queries.QUERIES["op1_adaptive_scan_neighbours"](spark, "/root/testdata/sf0.01").collect()
    exact = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows}
    for r in found:
        a, b = exact[r.query_id], exact[r.vec_id]
        assert abs(r.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
        hits += r.vec_id in [v for v, _ in want[r.query_id]]
    assert len(found) == 5 * len(want) and hits >= 0.9 * len(found)


def test_copies_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "VECTORS_PER_CHUNK", 7)
    monkeypatch.setattr(ann, "QUERIES_PER_CHUNK", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, -0.0, 0.5]) for i in range(0, 120)]  # a third are copies
    rows += [(i, rng.standard_normal(4).tolist()) for i in range(120, 330)]
    valid = list(rows)
    rows += [(1000, None), (1001, []), (1002, [0.0, 0.0, 0.0, 0.0]), (1003, [1.0, None, 0.0, 0.0]), (1004, [float("nan"), 1.0, 0.0, 0.0]), (1005, [float("inf"), 1.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]), (0, [1.0, 2.0, 0.0, 0.5]), (1050, [1e-200, 0.0])]
    valid.append((1050, [1.0, 0.0]))
    table = spark.createDataFrame([(*r, 1, 1) for r in rows], "vec_id long, embedding array<double>, n int, rank int")
    found = ann.nearest(table, F.col("vec_id") % 10 == 0, k=5).collect()
    want = brute([i for i, _ in valid], [v for _, v in valid], [i for i, _ in valid if i % 10 == 0], 5)
    got = {q: [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in want}
    assert {r.query_id for r in found} == set(want)
    assert [v for v, _ in got[0]] == [1, 2, 3, 4, 5] and [v for v, _ in got[50]] == [0, 1, 2, 3, 4]
    shared = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert shared >= 0.9 * 5 * len(want) and all(len(x) == 5 for x in got.values())
    assert ann.nearest(table.limit(0), F.lit(True)).count() == 0
    few = ann.nearest(table.where("vec_id IN (120, 121, 122)"), F.col("vec_id") == 120).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2]
