from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantline import cases
from plantline.operators import validation
from plantline.plans import daily, serving
from plantline.risk import models
from plantline.sources.star import AS_OF, StarSchema
from plantline.sources.warehouse import current

AT = datetime(2001, 5, 15, 6)
SMALL = {"boosting": {"maxIter": 3}, "forest": {"numTrees": 5}}


@pytest.fixture(scope="module")
def star(spark):
    return StarSchema(spark, "/root/testdata/sf0.001")


def test_scoring_twice_a_day_updates_and_next_day_adds(spark, star, tmp_path):
    out = str(tmp_path)
    counts = daily.run_scoring(star, spark, out, AT, **SMALL)
    assert counts == {"suppliers": 10, "materials": 200}
    alerts = current(spark, out, daily.ALERTS).count()
    assert alerts > 0
    for again in (AT, AT + timedelta(hours=1)):
        daily.run_scoring(star, spark, out, again, **SMALL)
    assert current(spark, out, daily.SUPPLIER_SCORES).count() == 10
    assert current(spark, out, daily.ALERTS).count() == alerts
    daily.run_scoring(star, spark, out, AT + timedelta(days=1), **SMALL)
    assert current(spark, out, daily.SUPPLIER_SCORES).count() == 20
    assert current(spark, out, daily.STOCKOUT_SCORES).count() == 400
    assert current(spark, out, daily.ALERTS).count() == 2 * alerts


def test_stored_models_score_without_fitting(spark, star, tmp_path, monkeypatch):
    out = str(tmp_path)
    with pytest.raises(LookupError):
        daily.run_scoring(star, spark, out, AT, refit=False)
    daily.run_scoring(star, spark, out, AT, **SMALL)

    def scores(table, key, column):
        return {(r[key], r[column], r.risk_tier) for r in current(spark, out, table).collect()}

    tables = ((daily.SUPPLIER_SCORES, "supplier_id", "risk_score"), (daily.STOCKOUT_SCORES, "material_id", "stockout_risk_score"))
    fitted = [scores(*t) for t in tables]
    for name in ("fit_supplier_model", "fit_stockout_model"):
        monkeypatch.setattr(models, name, lambda *_, **__: pytest.fail("fitted again"))
    assert daily.run_scoring(star, spark, out, AT + timedelta(hours=1), refit=False) == {"suppliers": 10, "materials": 200}
    assert [scores(*t) for t in tables] == fitted
    with pytest.raises(ValueError, match="fitted to"):
        models.stored_model(spark, out, daily.SUPPLIER_MODEL, models.MATERIAL_FEATURES)


def test_old_versions_of_a_job_are_removed(spark, star, tmp_path):
    out = str(tmp_path)
    for hours in (0, 1, 2):
        daily.run_scoring(star, spark, out, AT + timedelta(hours=hours), refit=not hours, **SMALL)
    assert daily.remove_old_versions(spark, out, keep=1) == []
    # Three versions of two score tables and the alerts, one version of each model.
    assert len(daily.remove_old_versions(spark, out, keep=1, grace_seconds=0)) == 6
    assert daily.run_scoring(star, spark, out, AT, refit=False)["suppliers"] == 10


def test_quality_run_raises_each_alert_once(spark, star, tmp_path):
    out = str(tmp_path)
    first = daily.run_quality(star, spark, out, "run-1", AT)
    failed = first.where("status = 'FAIL'").count()
    assert first.count() == 7 and failed > 0
    daily.run_quality(star, spark, out, "run-2", AT + timedelta(days=1))
    assert current(spark, out, daily.ALERTS).count() == failed


def test_operational_tables_compute_features_and_suite_once(spark, monkeypatch):
    calls = []
    for module, name in ((cases, "suppliers"), (cases, "materials"), (cases.quality, "suite")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _plain=plain, _name=name, **k: calls.append(_name) or _plain(*a, **k))
    tables = cases.operational_tables(StarSchema(spark, "/root/testdata/sf0.001"), AS_OF)
    assert sorted(calls) == ["materials", "suite", "suppliers"]
    runs = [r.run_id for r in tables["data_quality_test_results"].select("run_id").collect()]
    assert sorted(runs) == [cases.RUN_KNOWN] * 7 + ["run-unknown"] * 7


def test_rejects_of_one_run_are_sorted_by_several_tasks(spark):
    rows = spark.range(20_000).selectExpr(
        "'raw_x' as source_table", "concat('{\"id\": ', id, '}') as payload", "timestamp'2001-05-15 06:04:00' as rejected_at"
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = serving.list_rejects(rows).select(F.spark_partition_id().alias("task")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1


def test_only_repeated_keys_are_joined_back(spark):
    """Duplicates are found as before when most keys occur once, some several times, some only in invalid rows."""
    rows = [("S1", "TIER_1", 1), ("S2", "x", 2), ("S2", "TIER_1", 3), ("S2", "TIER_1", 4), ("S3", "x", 5), ("S3", "x", 6), (None, "TIER_1", 7)]
    rest = {f.name: F.lit("1") for f in validation.ENTITIES["suppliers"].fields if f.name not in ("supplier_id", "tier")}
    raw = spark.createDataFrame(rows, "supplier_id string, tier string, seq int").withColumns(rest)
    classified = validation.classify("suppliers", raw, "seq")
    found = {r.seq: r.error_code for r in classified.select("seq", "error_code").collect()}
    bad, twice = validation.ERR_SCHEMA, validation.ERR_DUPLICATE
    assert found == {1: None, 2: bad, 3: None, 4: twice, 5: bad, 6: bad, 7: bad}
