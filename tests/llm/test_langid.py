import zlib

import numpy as np
from fixtures import FOLDER, docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from meterwise.llm import langid, queries


def brute_grams(text):
    """The set of n-grams of a text, from its words."""
    kept = "".join(c.lower() if c.isascii() and c.isalpha() else c if not c.isascii() else " " for c in text)
    words = kept.encode().split(b" ")
    data = b" " + b" ".join(w for w in words if w) + b" "
    data = data if data.strip() else b" "
    return {data[i : i + n] for n in langid.SPECTRUM for i in range(len(data) - n + 1)}


def test_kernel_against_sets():
    rng = np.random.default_rng(1)
    texts = ["", "a", "The  cat, the CAT!", "naïve café\n12 où", *("".join(rng.choice(list("abé Z.\n"), rng.integers(0, 400))) for _ in range(30))]
    marks = texts[1:12]
    grams, sets = langid.landmark_sets([m.encode() for m in marks])
    known = set().union(*map(brute_grams, marks))
    present = langid.presence([t.encode() for t in texts], grams)
    want = np.zeros((len(texts), len(marks)))
    for i, t in enumerate(texts):
        own = brute_grams(t) & known
        assert present[i].sum() == len(own)
        for j, m in enumerate(marks):
            other = brute_grams(m)
            want[i, j] = len(own & other) / np.sqrt(max(1, len(own)) * len(other))
    assert np.allclose(langid.kernel(present, sets), want)
    assert np.allclose(langid._inner(grams, sets), want[1:12])


def test_long_texts_are_read_whole(monkeypatch):
    grams, _ = langid.landmark_sets([b"end of the text", b"some words"])
    texts = [b"x " * 5000 + b"end", b"", b"some" + b" q" * 3000 + b"words"]
    whole = langid.presence(texts, grams)
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert (langid.presence(texts, grams) == whole).all() and whole[0].sum() > 5


def test_compiled_scores_are_those_of_the_regression():
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list(alphabet), 80)).encode() for alphabet in ("abcd ", "cdef ", "efgh ") for _ in range(12)]
    grams, sets = langid.landmark_sets(texts[::4])
    labels = np.repeat(np.arange(3), 12)
    values = np.ones((36, 10))
    values[:, :-1] = langid.kernel(langid.presence(texts, grams), sets)
    y = np.where(labels[:, None] == np.arange(3), 1.0, -1.0)
    inner = langid._inner(grams, sets)
    beta = langid.solve(inner, values.T @ values / 36, values.T @ y / 36, 0.01)
    # the gradient of the penalised squares is zero in every direction of the landmarks
    penalty = np.zeros((10, 10))
    penalty[:-1, :-1] = inner
    gradient = values.T @ (values @ beta - y) / 36 + 0.01 * penalty @ beta
    assert np.abs(gradient).max() < 1e-8
    found = langid.scores(texts, langid.compiled(("a", "b", "c"), grams, sets, beta))
    assert np.allclose(found, values @ beta, atol=1e-4) and (found.argmax(axis=1) == labels).mean() > 0.9


def test_query(spark, docs):
    found = {r.doc_id: r for r in queries.QUERIES["op11_string_kernel_languages"](spark, FOLDER).collect()}
    langs = {r.doc_id: r.lang for r in docs.collect()}
    assert set(found) == set(langs) and all(0 <= r.score <= 1 for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in found.items())
    judged = [r.lang_pred == langs[d] for d, r in found.items() if r.held_out and langs[d] is not None and r.lang_pred != "und"]
    assert len(judged) > 30 and np.mean(judged) > 0.95
    # held-out languages are not learned from
    blind = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    again = {r.doc_id: (r.lang_pred, r.score) for r in langid.languages_of(blind).collect()}
    assert again == {d: (r.lang_pred, r.score) for d, r in found.items()}


def test_odd_rows(spark, odd_docs):
    rows = langid.languages_of(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1
    assert {r.lang_pred for r in rows if r.doc_id in (3, 5)} == {"und"}
    assert langid.languages_of(odd_docs.limit(0)).count() == 0
    none = langid.languages_of(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    one = langid.languages_of(odd_docs.withColumn("lang", F.lit("zz"))).collect()
    assert {r.lang_pred for r in one} == {"zz", "und"}
