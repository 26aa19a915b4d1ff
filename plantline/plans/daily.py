"""Daily jobs on a stored warehouse: risk scoring and quality checks."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantline.operators.merge import absent_rows
from plantline.plans import incidents, loading, quality
from plantline.risk import models
from plantline.session import cut_lineage
from plantline.sources import warehouse
from plantline.sources.warehouse import current_or, latest_number, publish

SUPPLIER_SCORES, STOCKOUT_SCORES = "fact_supplier_risk_scores", "fact_stockout_risk_scores"
ALERTS, RESULTS = "supply_alerts", "data_quality_test_results"
SUPPLIER_MODEL, STOCKOUT_MODEL = "models/supplier_risk", "models/stockout_risk"
PUBLISHED = (
    SUPPLIER_SCORES, STOCKOUT_SCORES, ALERTS, SUPPLIER_MODEL, STOCKOUT_MODEL, "dim_supplier", "dim_material",
    "fact_purchase_orders", "supplier_performance", "inventory_health", "production_at_risk",
)


def _publish_merged(spark: SparkSession, output: str, table: str, rows: DataFrame, merge, version: str) -> None:
    """Publish a table with ``rows`` merged in; a version that another writer adds meanwhile makes this one fail."""
    base = latest_number(spark, output, table)
    publish(merge(current_or(spark, output, table, rows.limit(0)), rows), output, table, version, base=base)


def raise_alerts(spark: SparkSession, output: str, offered: DataFrame, version: str) -> None:
    """Publish the alert table with the alerts it did not hold yet."""

    def added(known: DataFrame, rows: DataFrame) -> DataFrame:
        return known.unionByName(absent_rows(known, rows, loading.ALERT_KEYS).select(*known.columns))

    _publish_merged(spark, output, ALERTS, offered, added, version)


def fit_models(
    suppliers: DataFrame, materials: DataFrame, output: str, version: str, boosting: dict | None = None, forest: dict | None = None
) -> tuple[PipelineModel, PipelineModel]:
    """Fit both models to their training rows and store them as new versions."""
    found = (
        models.fit_supplier_model(suppliers, **(boosting or {})),
        models.fit_stockout_model(materials, **(forest or {})),
    )
    for model, name in zip(found, (SUPPLIER_MODEL, STOCKOUT_MODEL), strict=True):
        models.store_model(model, suppliers.sparkSession, output, name, version)
    return found


def run_scoring(
    t: Mapping[str, DataFrame],
    spark: SparkSession,
    output: str,
    at: datetime,
    boosting: dict | None = None,
    forest: dict | None = None,
    refit: bool = True,
) -> dict[str, int]:
    """Score suppliers and materials, upsert the score tables, raise alerts; returns the rows scored.

    The models are fitted to the present tables and stored; without ``refit`` those
    stored last score the present tables, and it is an error if there are none.
    Scores are stored before use: the score tables, the alerts and the count read them.
    """
    version, day = loading.version_of(at), at.date()
    if refit:
        suppliers, materials = models.supplier_training(t), models.material_training(t)
        supplier_model, stockout_model = fit_models(suppliers, materials, output, version, boosting, forest)
    else:
        # Loaded before any work; scoring is one pass, so the rows need not be fixed first.
        supplier_model = models.stored_model(spark, output, SUPPLIER_MODEL, models.SUPPLIER_FEATURES)
        stockout_model = models.stored_model(spark, output, STOCKOUT_MODEL, models.MATERIAL_FEATURES)
        suppliers, materials = models.supplier_rows(t), models.material_rows(t)
    scored = cut_lineage(models.score(supplier_model, suppliers))
    stocked = cut_lineage(models.score(stockout_model, materials))
    supplier_rows = incidents.supplier_score_rows(scored, day)
    stockout_rows = incidents.stockout_score_rows(stocked, day)
    _publish_merged(spark, output, SUPPLIER_SCORES, supplier_rows, loading.upsert_supplier_scores, version)
    _publish_merged(spark, output, STOCKOUT_SCORES, stockout_rows, loading.upsert_stockout_scores, version)
    raise_alerts(spark, output, incidents.scoring_alerts(scored, stocked, day), version)
    return {"suppliers": scored.count(), "materials": stocked.count()}


def remove_old_versions(spark: SparkSession, output: str, keep: int = 2, grace_seconds: float = 7 * 86400) -> list[str]:
    """Delete outdated versions of every table and model that the jobs publish below ``output``; returns their paths."""
    removed = []
    for name in PUBLISHED:
        removed += warehouse.remove_old_versions(spark, output, name, keep, grace_seconds)
    return removed


def run_quality(
    t: Mapping[str, DataFrame], spark: SparkSession, output: str, run_id: str, at: datetime
) -> DataFrame:
    """Record the assertions of this run and raise an alert for each failed one; returns this run's results."""
    path = f"{output}/{RESULTS}"
    quality.record_suite(t, at.date(), path, run_id, at)
    results = spark.read.parquet(path).where(F.col("run_id") == run_id)
    raise_alerts(spark, output, quality.alerts_from(results), loading.version_of(at))
    return results
