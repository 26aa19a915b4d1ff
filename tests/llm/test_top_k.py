import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantline.llm import topk
from plantline.llm.oracles import ORACLES
from plantline.llm.queries import op9_top_k
from tests.compare import differences, open_duck

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, far string, rank int"


def plain(rows, k):
    held = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    found = set()
    for q, own in {(i, tuple(v)) for i, v in held if i % 2 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in held if i != q and len(v) == len(own))
        found |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return found


def test_query_agrees_with_sql(spark):
    assert differences(op9_top_k(spark, FOLDER).toPandas(), open_duck(FOLDER).execute(ORACLES["op9_top_k"]).df()) == []


def test_ties_odd_vectors_and_mixed_lengths(spark):
    draw = random.Random(2)
    rows = [(i, [float(draw.randrange(-2, 3)) for _ in range(4)]) for i in range(120)]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [1.0, math.nan, 0.0, 0.0]), (204, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(7, [1.0, 1.0, 1.0, 1.0]), (8, [2.0, 0.0, 0.0, 0.0]), (None, [5.0, 5.0, 5.0, 5.0]), (300, [1.0, 2.0]), (301, [3.0, 4.0])]
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    found = topk.top_k(vectors, F.col("vec_id") % 2 == 0, k=5)
    assert {tuple(r) for r in found.collect()} == plain(rows, 5)


def test_bound_order_stops_early_and_stays_exact():
    draw = np.random.default_rng(3)
    rows = np.concatenate([draw.integers(-50, 50, (3000, 8)), draw.integers(400, 500, (40, 8))]).astype(np.int64)
    query, loose = rows[-1], rows.astype(np.float64)
    pivots = loose[:: len(rows) // 20]
    upper = topk.bounds(query.astype(float), loose, topk.distances(query.astype(float), pivots), np.array([topk.distances(v, pivots) for v in loose]))
    exact = rows @ query
    assert (upper >= exact).all()
    best = topk.top_scores(query, -1, np.arange(len(rows)), rows, upper, 10)
    assert best == [(int(exact[i]), int(i)) for i in np.lexsort((np.arange(len(rows)), -exact))[:10]]
    assert (upper >= best[-1][0]).sum() < 300


def test_huge_components_are_summed_exactly(spark):
    rows = [(i, [float(2**29 + i * 64), float(2**29 - i * 64)] * 40) for i in range(6)]
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).withColumn("embedding", F.transform("embedding", lambda x: x / 4096))
    held = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert {tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 2 == 0, k=3).collect()} == plain(held, 3)


def test_all_finite_vectors_take_part(spark):
    big = [2.0**31, -(2.0**60), 1e300, -1e305, 1.7e308]
    rows = [(2 * i, [0.0, float(i)]) for i in range(6)] + [(100 + i, [b, float(i)]) for i, b in enumerate(big)]
    rows = [(i, v) for i, v in rows if i % 2 or i < 100] + [(102, [2.0**31, 5.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = topk.top_k(vectors, F.col("vec_id") < 100, k=4)
    held = [(i, v) for i, v in rows]
    expected = {r for r in plain(held, 4) if r[0] < 100}
    assert {tuple(r) for r in found.collect()} == expected and any(r[2] >= 100 for r in expected)


def test_a_score_beyond_a_long_is_an_error(spark):
    vectors = spark.createDataFrame([(1, [1e300]), (2, [1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW"):
        topk.top_k(vectors, F.col("vec_id") == 2).collect()


def test_many_lengths_have_few_pivots(spark):
    draw = random.Random(5)
    rows = [(i, [float(draw.randrange(-9, 9)) for _ in range(1 + i // 3)]) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    held = vectors.selectExpr("vec_id", "embedding as vector", "size(embedding) as dim")
    assert len(topk.choose_pivots(held, lengths=8)) == 8
    assert {tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 2 == 0, k=3).collect()} == plain(rows, 3)


def test_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 2 == 0).collect() == []
