"""The pipeline's first stage judges by runs of code points, so letters of all scripts are told apart."""

import random

import corpus_pipeline
from tests.llm import test_pipeline
from tests.llm.test_quality_sharded import DOCS, LABELS, RUSSIAN, plain_probability

EDGE = "￿"


def code_points(monkeypatch):
    """The brute-force version of test_pipeline, with the model over code points in place of classes."""

    def model(texts):
        probability = plain_probability(texts, EDGE)
        return lambda gram: probability("".join(gram))

    monkeypatch.setattr(test_pipeline, "plain_model", model)
    monkeypatch.setattr(test_pipeline, "coded", lambda text: EDGE * 3 + text)


def test_whole_pipeline_agrees_with_brute_force_over_code_points(spark, monkeypatch):
    code_points(monkeypatch)
    test_pipeline.test_pipeline_agrees_with_brute_force(spark)


def test_quality_stage_rejects_gibberish_of_another_script(spark, tmp_path):
    """It has the spacing and capitals of the clean text; classes of characters gave both the same score."""
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice(RUSSIAN) for _ in range(40)), "ru") for i in range(60)]
    letters = sorted(set("".join(RUSSIAN)))
    rows += [(100 + i, "".join(c if c == " " else draw.choice(letters) for c in rows[i][1]), "ru") for i in range(10)]
    spark.createDataFrame([(i, 1, 0) for i in range(50)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality_stage(spark, spark.createDataFrame(rows, DOCS), str(tmp_path)).collect()
    assert len(kept) > 40 and all(r.doc_id < 100 for r in kept)
