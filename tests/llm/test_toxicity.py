"""Toxicity: held-out accuracy, odd rows, and the parts of the features."""

import zlib

import pytest

from plantline.llm import toxicity
from plantline.llm.queries import op11_toxicity
from tests.llm.helpers import LONG, no_documents, odd_documents

FOLDER = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_documents_are_told_apart(spark):
    found = {r.doc_id: r for r in op11_toxicity(spark, FOLDER).collect()}
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert len(found) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(labels[i], r.predicted, r.score) for i, r in found.items() if r.held_out and i in labels]
    toxic = [p for t, p, _ in held if t == 1]
    clean = [p for t, p, _ in held if t == 0]
    assert len(toxic) > 80 and sum(toxic) / len(toxic) > 0.9
    assert sum(clean) / len(clean) < 0.01
    assert sum(s for t, _, s in held if t == 1) / len(toxic) > 0.85


def labelled(spark):
    clean = [(100 + k, f"a quiet word about river number {k}", "en", "s", 1, 1, "", "") for k in range(300)]
    toxic = [(1000 + k, f"you are a grolbat and river number {k}", "en", "s", 1, 1, "", "") for k in range(200)]
    odd = odd_documents(spark)
    docs = odd.unionByName(spark.createDataFrame(clean + toxic, odd.schema))
    labels = [(r[0], 1, 0) for r in clean] + [(r[0], 1, 1) for r in toxic] + [(1, 1, None), (None, 0, 1), (2, 1, 0), (2, 1, 1), (6, 0, 0)]
    return docs, spark.createDataFrame(labels, LABELS)


def test_odd_rows_and_clashing_names(spark):
    docs, labels = labelled(spark)
    for name in ("values", "features", "given", "margin", "score", "toxic", "fold", "rawPrediction", "probability", "prediction"):
        docs = docs.withColumn(name, docs.lang)
    scored = toxicity.score_toxicity(docs, labels)
    assert scored.columns == [*(c for c in docs.columns if c not in ("text", "score")), "held_out", "score", "predicted"]
    rows = scored.collect()
    assert len(rows) == docs.count() and all(r.score is not None for r in rows)
    assert all(r.toxic == r.lang and r.margin == r.lang for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].score == by_id[4].score and by_id[None].held_out is False
    # A word that only labels teach: texts that were never learned from are found too.
    unseen = [r for r in rows if (r.doc_id or 0) >= 1000 and r.held_out]
    assert len(unseen) > 20 and all(r.predicted == 1 for r in unseen)
    assert all(r.predicted == 0 for r in rows if 100 <= (r.doc_id or 0) < 1000)


@pytest.mark.parametrize("marks,expected", [([], 0.0), ([(100 + k, 1, 0) for k in range(40)], 0.0), ([(100 + k, 1, 1) for k in range(40)], 1.0)])
def test_labels_of_one_kind(spark, marks, expected):
    docs, _ = labelled(spark)
    rows = toxicity.score_toxicity(docs, spark.createDataFrame(marks, LABELS)).collect()
    assert {r.score for r in rows} == {expected}


def test_no_documents(spark):
    assert toxicity.score_toxicity(no_documents(spark), spark.createDataFrame([(1, 1, 1)], LABELS)).collect() == []


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = labelled(spark)
    flipped = spark.createDataFrame(
        [(r.doc_id, r.quality, 1 - r.toxic if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.toxic) for r in labels.collect()],
        LABELS,
    )
    ranked = lambda x: sorted((str(r.doc_id), r.score) for r in toxicity.score_toxicity(docs, x).collect())
    assert ranked(labels) == ranked(flipped)


def value(text, name, learned=None):
    return toxicity.features(text, toxicity.Lexicon(learned or {}))[toxicity.FEATURES.index(name)]


def test_features():
    assert value("you idiot", "seed_density") == 500 and value("idiotic", "seed_density") == 1000
    assert value("an idiotism", "seed_density") == 0
    assert value("you idiot", "near_second_person") == 500
    assert value("you " + "word " * 40 + "idiot", "near_second_person") == 0
    assert value("lowermost low", "learned_density", {" lowe": 2.0}) == 500
    assert value("ABcd", "capitals") == 0.5 and value("WHAT now", "capital_words") == 0.5
    assert value("no!! what?", "exclamations") == 1000 and value("no!! what?", "runs_of_signs") == 500
    for text in ("1d10t", "i d i o t", "i.d.i.o.t", "idiooot", "$tupid"):
        assert value(f"a {text} here", "obfuscated_hits") >= (text != "$tupid"), text
    assert value("", "log_words") == 0 and value("x" * 2_500_000, "log_words") > 0


def test_pieces_of_long_texts_count_once(monkeypatch):
    text = LONG[:60_000] + " you idiot " + LONG[:60_000]
    whole = toxicity.features(text, toxicity.Lexicon({}))
    monkeypatch.setattr(toxicity, "STEP", 60_005)
    assert toxicity.features(text, toxicity.Lexicon({}))[0] == pytest.approx(whole[0], rel=0.01)
