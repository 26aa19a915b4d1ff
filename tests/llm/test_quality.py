import math
from collections import Counter, defaultdict

import numpy as np

from plantline.llm import quality
from plantline.llm.queries import op5_quality
from tests.llm.helpers import no_documents, odd_documents

FOLDER = "/root/testdata/sf0.1"


def coded(text):
    return [quality.EDGE] * 3 + [int(quality._TABLE[min(ord(c), 0x3000)]) for c in text]


def plain_model(texts):
    """P(c | a, b, d) by the textbook recursion over dictionaries."""
    counts = {4: Counter()}
    for text in texts:
        codes = coded(text)
        counts[4].update(tuple(codes[i : i + 4]) for i in range(len(codes) - 3))
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    facts = {}
    for n, held in counts.items():
        m = Counter(held.values())
        if m[1] and m[2]:
            y = m[1] / (m[1] + 2 * m[2])
            d = [min(max(k - (k + 1) * y * m[k + 1] / m[k] if m[k] else y, 0.01), k - 0.01) for k in (1, 2, 3)]
        else:
            d = [0.5] * 3
        total, back = defaultdict(int), defaultdict(float)
        for g, c in held.items():
            total[g[:-1]] += c
            back[g[:-1]] += d[min(c, 3) - 1]
        facts[n] = d, total, back

    def probability(gram):
        n = len(gram)
        if n == 0:
            return 1 / quality.CLASSES
        d, total, back = facts[n]
        lower = probability(gram[1:])
        if not total[gram[:-1]]:
            return lower
        c = counts[n][gram]
        return ((c - d[min(c, 3) - 1] if c else 0) + back[gram[:-1]] * lower) / total[gram[:-1]]

    return probability


def test_model_agrees_with_the_recursion(spark):
    texts = ["the cat sat on the mat.", "The dog, the cat; and 12 more!", "à la carte\nnext line", "the the the", "a"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id bigint, quality int, toxic int")
    logs = quality.train(docs, labels)
    probability = plain_model(texts)
    for text in [*texts, "Zebra? unseen #text", "cat mat"]:
        codes = coded(text)
        grams = [tuple(codes[i : i + 4]) for i in range(len(codes) - 3)]
        numbers = np.concatenate(list(quality.grams(text)))
        assert np.allclose(logs[numbers], [math.log(probability(g)) for g in grams], atol=1e-4)
    table = np.exp(logs.astype(np.float64)).reshape(-1, quality.CLASSES)
    assert np.allclose(table.sum(axis=1), 1, atol=1e-4)


def test_long_texts_are_cut_without_a_seam(monkeypatch):
    text = "some words, and More 1 " * 50
    whole = np.concatenate(list(quality.grams(text)))
    monkeypatch.setattr(quality, "STEP", 37)
    assert (np.concatenate(list(quality.grams(text))) == whole).all()


def test_bounds_are_exact_quantiles(spark):
    rows = [("la", m) for m in (5, 1, 9, 9, 3, 7, 2, 8, 6, 4)] + [("lb", 100)]
    found = {r.lkey: (r.low, r.high) for r in quality.bounds(spark.createDataFrame(rows, "lkey string, milli bigint"), 0.2, 0.2).collect()}
    assert found["la"] == (3, 8) and found["lb"] == (100, 100) and found[None] == (3, 9)


def test_held_out_documents_are_told_apart(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    known = labels.where("doc_id % 2 = 0")
    rows = {r.doc_id: r.kept for r in quality.classify(docs, known).select("doc_id", "kept").collect()}
    held = labels.where("doc_id % 2 = 1").collect()
    share = lambda q: np.mean([rows[r.doc_id] for r in held if r.quality == q and r.toxic == 0])
    assert share(1) > 0.97 and share(0) < 0.1


def test_query_returns_every_document(spark):
    folder = "/root/testdata/sf0.001"
    rows = op5_quality(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert all(r.kept == (r.low <= r.perplexity <= r.high) for r in rows)


def test_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (2, 1, None), (3, 1, 0), (6, 1, 0), (7, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all((r.perplexity is None and not r.kept) == (not r.text) for r in rows if not r.kept or not r.text)
    nothing = quality.classify(docs, labels.where("false")).collect()
    assert [r.kept for r in nothing] == [bool(r.text) for r in nothing]
    assert quality.classify(no_documents(spark), labels).collect() == []


def test_inner_names_come_back_as_they_were(spark):
    names = ["milli", "lkey", "gram", "n", "upto"]
    docs = spark.createDataFrame([(k, "some plain words here", "en", *names) for k in range(4)], "doc_id bigint, text string, lang string, " + ", ".join(f"{n} string" for n in names))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic")
    found = quality.classify(docs, labels)
    assert set(names) <= set(found.columns)
    assert {tuple(r[n] for n in names) for r in found.collect()} == {tuple(names)}
