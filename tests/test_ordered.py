"""Blocked windows against plain windows and brute force."""

import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plantline.operators.grid import pair_with_all
from plantline.operators.ordered import dense_ranks, exact_median, running_totals, running_totals_in_one_scan, trailing_sums
from plantline.plans import comparisons, marts, trends
from plantline.sources.star import StarSchema


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    # Two thirds of the rows belong to one key.
    data = [("hot" if rng.random() < 0.66 else f"k{i % 5}", i // 9, i, rng.randint(-9, 9)) for i in range(900)]
    return spark.createDataFrame(data, "k string, day int, id int, v int")


def test_running_totals_equal_one_window(rows):
    got = running_totals(rows, ["k"], F.col("day"), [F.col("day"), F.col("id")], {"total": F.col("v")})
    plain = Window.partitionBy("k").orderBy("day", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("total", F.sum("v").over(plain))
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_running_totals_without_keys(rows):
    got = running_totals(rows, [], F.col("day"), [F.col("id")], {"n": F.lit(1)})
    assert sorted(r.n for r in got.collect()) == list(range(1, 901))


@pytest.mark.parametrize("chunk", [31, 40, 1 << 20])
def test_trailing_sums_equal_one_window(rows, chunk):
    numbered = running_totals(rows, ["k"], F.col("day"), [F.col("day"), F.col("id")], {"pos": F.lit(1)})
    got = trailing_sums(numbered, ["k"], "pos", 31, {"s": F.col("v")}, chunk=chunk)
    frame = Window.partitionBy("k").orderBy("pos").rowsBetween(-30, 0)
    want = numbered.withColumn("s", F.sum("v").over(frame))
    assert sorted(got.collect()) == sorted(want.collect())


def test_trailing_sums_rejects_short_chunks(rows):
    with pytest.raises(ValueError):
        trailing_sums(rows, ["k"], "id", 31, {"s": F.col("v")}, chunk=30)


@pytest.mark.parametrize("blocked", [False, True])
def test_dense_ranks(rows, blocked):
    block = -F.floor(F.col("v") / 4) if blocked else None
    got = dense_ranks(rows, ["k"], [("v", False), ("day", True)], "r", block)
    want = rows.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy(F.desc("v"), "day")).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("plans", [(marts.supplier_figures, marts.supplier_performance), (trends.rolled, trends.ranked_months)])
def test_ranks_are_planned_without_a_job_and_scan_facts_once(spark, plans):
    star = StarSchema(spark, "/root/testdata/sf0.001")
    rows, ranked = plans
    rows(star)  # reads the schemas of its tables
    spark.sparkContext.setJobGroup("planning", "no job while a plan is built")
    df = ranked(star)
    spark.sparkContext.setJobGroup("running", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == 0

    def fact_scans(frame):
        frame.collect()
        final = frame._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
        return sum("FileScan parquet" in line and "lineitem" in line for line in final.splitlines())

    assert fact_scans(df) == fact_scans(rows(star)) > 0


@pytest.mark.parametrize("n", [1, 2, 7, 500, 501])
def test_exact_median(spark, n):
    rng = random.Random(n)
    values = [round(rng.random() * 30, 1) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v", F.floor("v")).first()[0] == pytest.approx(statistics.median(values))


def test_median_of_nothing_is_null(spark):
    assert exact_median(spark.createDataFrame([], "v double"), "v", F.floor("v")).first()[0] is None


def test_grid_pairs_everything(spark):
    left, right = spark.range(50).withColumnRenamed("id", "a"), spark.range(7).withColumnRenamed("id", "b")
    got = {(r.a, r.b) for r in pair_with_all(left, "a", right, copies=8).collect()}
    assert got == {(a, b) for a in range(50) for b in range(7)}
    assert pair_with_all(left, "a", right).count() == 350


def test_grid_never_broadcasts_the_repeated_side(spark):
    left, right = spark.range(50).withColumnRenamed("id", "a"), spark.range(300_000).withColumnRenamed("id", "b")
    plan = pair_with_all(left, "a", right, copies=200)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_balance_plans_run_no_job(spark):
    moves = spark.createDataFrame(
        [(1, 0, date(2001, 1, 1), "m1", 5)],
        "material_id int, warehouse_id int, movement_date date, movement_id string, quantity int",
    )
    spark.sparkContext.setJobGroup("balance-plan", "balance-plan")
    try:
        comparisons.balance_and_burn(moves)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("balance-plan")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("numeric", [False, True])
def test_balance_and_burn_agree_with_a_loop(spark, numeric, monkeypatch):
    """One cell holds two thirds of the rows; ids cut each day into several blocks."""
    monkeypatch.setattr(comparisons, "ID_PREFIX", 2)
    monkeypatch.setattr(comparisons, "ID_SPAN", 64)
    rng = random.Random(11)
    data = [
        (1 if i % 3 else 2 + i % 4, 0, date(2001, 1, 1) + timedelta(days=rng.randint(0, 40)), i if numeric else f"m{i}", rng.randint(-9, 9))
        for i in range(400)
    ]
    moves = spark.createDataFrame(
        data, "material_id int, warehouse_id int, movement_date date, movement_id " + ("bigint" if numeric else "string") + ", quantity int"
    )
    got = {r.movement_id: r for r in comparisons.balance_and_burn(moves).collect()}
    seen: dict[int, list[int]] = {}
    for material, _, day, name, quantity in sorted(data, key=lambda r: (r[0], r[2], r[3])):
        past = seen.setdefault(material, [])
        past.append(quantity)
        outs = [-q for q in past[-31:] if q < 0]
        assert got[name].running_balance == sum(past)
        assert got[name].rolling_30d_burn_rate == (sum(outs) / len(outs) if outs else None)
    balances = {r.movement_id: r.running_balance for r in comparisons.running_balance(moves).collect()}
    assert balances == {name: r.running_balance for name, r in got.items()}


def test_rows_with_null_keys_keep_their_running_balance(spark):
    rows = [(m, w, date(2024, 1, d), f"M{d}", 10 * d) for m in (1, None) for w in (2, None) for d in (1, 2, 3)]
    schema = "material_id bigint, warehouse_id bigint, movement_date date, movement_id string, quantity int"
    found = comparisons.balance_and_burn(spark.createDataFrame(rows, schema)).collect()
    expected = {(m, w, d, b) for m in (1, None) for w in (2, None) for d, b in ((1, 10), (2, 30), (3, 60))}
    assert len(found) == len(rows)
    assert {(r.material_id, r.warehouse_id, r.movement_date.day, r.running_balance) for r in found} == expected


def test_running_totals_read_their_input_once(spark, tmp_path):
    rows = [(k, d, d * (k or 3)) for k in (1, 2, None, 0) for d in range(40)]
    spark.createDataFrame(rows, "k int, d int, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    result = running_totals_in_one_scan(df, ["k"], F.floor(F.col("d") / 7), [F.col("d")], {"upto": F.col("v")})
    found = {(r.k, r.d): r.upto for r in result.collect()}
    assert len(found) == 160 and all(found[k, d] == (k or 3) * d * (d + 1) // 2 for k in (1, 2, None, 0) for d in range(40))
    assert sorted(map(str, result.collect())) == sorted(map(str, running_totals(df, ["k"], F.floor(F.col("d") / 7), [F.col("d")], {"upto": F.col("v")}).collect()))
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
