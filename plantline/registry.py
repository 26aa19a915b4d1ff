"""Every registered query as (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantline import cases
from plantline.plans import analytics, charts, comparisons, marts, quality, serving, trends
from plantline.risk import features, models
from plantline.sources.star import AS_OF, StarSchema

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Plain output types: decimals as double, whole numbers as bigint, dates and times as text."""

    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType | T.FloatType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegerType | T.ShortType | T.ByteType):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


def register(key: str, plan: Callable[..., DataFrame], **params) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(plan(StarSchema(spark, folder), AS_OF, **params))

    QUERIES[key] = run


register("mart_supplier_performance", marts.supplier_performance)
register("mart_inventory_health", marts.inventory_health)
register("mart_production_at_risk", marts.production_at_risk)
register("mart_inventory_health_stored", cases.inventory_health_from_totals)

register("window_lag_otd", trends.lag_otd)
register("window_lead_variance", trends.lead_variance)
register("window_rolling_3m", trends.rolling_3m)
register("window_rank_monthly", trends.rank_monthly)
register("window_rank_category", marts.category_ranks)
register("window_running_balance", comparisons.all_running_balances)
register("window_rolling_burn", comparisons.all_burn_rates)
register("q1_supplier_trajectory", trends.supplier_trajectory)
register("q2_inventory_turnover", analytics.inventory_turnover)
register("q3_delayed_po_impact", analytics.delayed_po_impact)
register("q4_bom_production_risk", analytics.bom_production_risk)

BALANCE = {"material_id": 42, "since": date(2000, 10, 1)}
SCORECARD = {"since": date(1999, 1, 1)}
register("b1_running_balance_formatted", comparisons.material_balance_formatted, **BALANCE)
register("b1_running_balance", comparisons.material_balance, **BALANCE)
register("b2_scorecard_correlated", comparisons.scorecard_correlated, **SCORECARD)
register("b2_scorecard", comparisons.scorecard, **SCORECARD)
register("b3_bom_shortage_correlated", comparisons.bom_shortage_correlated)
register("b3_bom_shortage_mart", comparisons.bom_shortage_mart)

register("source_csv_roundtrip", cases.csv_roundtrip)
register("ledger_quarter_partitions", cases.ledger_partitions)
register("ledger_range_stored", cases.ledger_stored, low=date(1999, 12, 15), high=date(2000, 8, 10))
register("dim_date_calendar", cases.order_calendar)
register("refresh_marts", cases.refreshed_marts)

for _entity, _key in (
    ("suppliers", "validate_suppliers"),
    ("materials", "validate_materials"),
    ("purchase_orders", "validate_purchase_orders"),
    ("inventory_movements", "validate_movements"),
):
    register(_key, cases.validate, entity=_entity)
register("validate_duplicates", cases.duplicates)
register("rejected_records", cases.dead_letters)
register("rejected_records_stored", cases.dead_letters_stored)
register("ingest_summary", cases.ingest_summary)
register("load_audit", cases.load_audit)
register("upsert_suppliers", cases.upsert_suppliers)
register("upsert_materials", cases.upsert_materials)
register("upsert_purchase_orders", cases.upsert_purchase_orders)
register("merge_orders_by_month", cases.orders_merged_by_month)
register("append_movements", cases.append_movements)
register("append_movements_stored", cases.append_stored)
register("append_movement_counts", cases.append_counts)

register("dq_negative_balance", quality.negative_balance)
register("dq_orphan_receipts", cases.orphan_receipts)
register("dq_receipt_chronology", quality.receipt_chronology)
register("dq_ppm_bounds", quality.ppm_bounds)
register("dq_reorder_point", quality.reorder_point)
register("dq_shortage_rate", quality.shortage_rate)
register("dq_future_receipts", quality.future_receipts)
register("dq_suite", cases.dq_suite)
register("dq_suite_stored", cases.dq_suite_stored)
register("dq_alerts", cases.dq_alerts)
register("dq_dataset_contracts", cases.dq_contracts)
register("dq_constraints", cases.dq_constraints)
register("dq_operational_constraints", cases.dq_operational_constraints)

register("risk_supplier_features", features.supplier_features)
register("risk_material_features", cases.material_feature_rows)
register("open_pos_by_warehouse", features.open_orders_by_warehouse)
register("risk_supplier_rule_score", cases.supplier_rule_scores)
register("risk_stockout_rule_score", cases.stockout_rule_scores)
register("risk_supplier_factors", cases.supplier_factor_rows)
register("risk_stockout_factors", cases.stockout_factor_rows)
register("risk_tiers", cases.tier_counts)
register("risk_supplier_predictions", cases.supplier_prediction_rows)
register("risk_stockout_predictions", cases.stockout_prediction_rows)
register("risk_supplier_narrative", cases.supplier_narratives)
register("risk_stockout_narrative", cases.stockout_narratives)
register("risk_supplier_model", models.supplier_model_scores)
register("risk_stockout_model", models.stockout_model_scores)
register("risk_stored_models", cases.stored_models)
register("eval_regression", cases.eval_regression)
register("eval_classification", cases.eval_classification)
register("eval_roc_auc", cases.eval_roc_auc)
register("eval_report", models.evaluation_report)
register("scoring_alerts", cases.day_alerts)
register("scoring_summary", serving.scoring_summary)
register("insert_alerts_if_absent", cases.alerts_inserted)
register("upsert_supplier_scores", cases.supplier_scores_upserted)
register("upsert_stockout_scores", cases.stockout_scores_upserted)

register("kpi_executive", cases.kpis)
register("list_suppliers", cases.list_suppliers)
register(
    "list_suppliers_filtered", cases.list_suppliers, tier="TIER_2", category="CAT_1", risk="CRITICAL", search="ER#0"
)
register("supplier_detail", cases.supplier_detail, supplier_id=7)
register("search_suppliers", cases.list_suppliers, search="Nation_1", search_in=("name", "code", "country"))
register("list_materials", cases.list_materials, limit=200)
register("list_purchase_orders", serving.list_purchase_orders, limit=150)
register(
    "search_orders", serving.list_purchase_orders, search="R#000000001", search_in=("po_number", "supplier_name"),
    limit=None,
)
register("distinct_categories", serving.filter_boxes)
register("alerts_from_scores", cases.seeded_alerts)
register("actions_from_alerts", cases.seeded_actions)
register("list_alerts", cases.list_alerts, severity="CRITICAL", alert_type="STOCKOUT")
register("list_critical_active_alerts", cases.list_alerts, severity="CRITICAL", status="ACTIVE", limit=4)
register("list_actions", cases.list_actions, status="OPEN")
register("list_governance", cases.list_governance)
register("apply_alert_updates", cases.alerts_updated)
register("create_actions", cases.actions_created)
register("apply_action_updates", cases.actions_updated)
register("snapshot_export", cases.snapshot)

for _name, _chart in charts.CHARTS.items():
    register(_name, _chart, **({"limit": 20} if _name in ("chart_high_risk_suppliers", "chart_top_ppm_materials") else {}))
