"""Read layer: scored lists, filters, searches and headline figures.

``suppliers`` and ``materials`` are feature rows with a raw ``score``, from a
model or from the rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantline.functions.exprs import all_of, contains_text, risk_tier, round_half_even
from plantline.operators.ordered import exact_median
from plantline.plans.marts import MONEY, Tables, spend_totals
from plantline.risk.features import material_features, supplier_features
from plantline.risk.narrative import stockout_text, supplier_text
from plantline.risk.scoring import (
    stockout_predictions,
    stockout_rule_score,
    supplier_predictions,
    supplier_rule_score,
)


def rule_scored_suppliers(t: Tables) -> DataFrame:
    return supplier_features(t).withColumn("score", supplier_rule_score())


def rule_scored_materials(t: Tables) -> DataFrame:
    return material_features(t).withColumn("score", stockout_rule_score())


def _equal(column: str, wanted):
    return None if wanted is None else F.col(column) == wanted


def _matches(search: str | None, columns: Sequence[str]):
    return contains_text(search, [F.col(c) for c in columns]) if search else None


def list_suppliers(
    t: Tables,
    scored: DataFrame,
    tier: str | None = None,
    category: str | None = None,
    risk: str | None = None,
    search: str | None = None,
    search_in: Sequence[str] = ("name", "code", "supplier_id"),
) -> DataFrame:
    """Supplier scorecards, riskiest first. Filters on stored columns apply before the scores are joined on."""
    suppliers = t["dim_supplier"].where(
        all_of([_equal("tier", tier), _equal("category", category), _matches(search, search_in)])
    )
    shown = supplier_predictions(scored).withColumn("explanation_text", supplier_text())
    spread = scored.select("supplier_id", round_half_even(F.col("std_variance_days"), 1).alias("_std"))
    rows = (
        suppliers.join(shown.where(all_of([_equal("risk_tier", risk)])), "supplier_id")
        .join(spread, "supplier_id")
        .join(spend_totals(t), "supplier_id", "left")
    )
    nothing = F.lit(0).cast(MONEY)
    return rows.select(
        "supplier_id", "code", "name", "category", "country", "city", "tier", "reliability_rating",
        "financial_health_score",
        F.col("otd_rate_90d").alias("otd_percentage"),
        F.col("lead_time_variance_avg").alias("avg_lead_time_variance_days"),
        F.col("_std").alias("lead_time_variance_std"),
        F.col("defect_ppm_90d").alias("overall_defect_ppm"),
        F.coalesce("spend", nothing).alias("total_spend"),
        F.coalesce("overdue", nothing).alias("overdue_spend"),
        "risk_score", "risk_tier", "top_contributing_factors", "explanation_text",
    ).orderBy(F.desc("risk_score"), "supplier_id")


def supplier_detail(t: Tables, scored: DataFrame, supplier_id) -> DataFrame:
    return list_suppliers(t, scored).where(F.col("supplier_id") == supplier_id)


def list_materials(
    t: Tables,
    scored: DataFrame,
    category: str | None = None,
    risk: str | None = None,
    is_critical: bool | None = None,
    search: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Materials, riskiest first; the health label has no overstock class here."""
    stock = F.col("current_stock")
    health = (
        F.when(stock <= 0, "STOCKOUT")
        .when(stock < F.col("safety_stock_level"), "SAFETY_STOCK_BREACH")
        .when(stock < F.col("reorder_point"), "REORDER_TRIGGER")
        .otherwise("HEALTHY")
    )
    about = t["dim_material"].select(
        "material_id", "name", "category", "unit_of_measure", "standard_cost", "safety_stock_level", "reorder_point"
    ).where(all_of([_equal("category", category)]))
    shown = stockout_predictions(scored).where(
        all_of([
            _equal("risk_tier", risk), _equal("is_critical", is_critical),
            _matches(search, ("material_name", "sku")),
        ])
    )
    rows = about.join(shown, "material_id").select(
        "material_id", "sku", "name", "category", "unit_of_measure", "standard_cost", "safety_stock_level",
        "reorder_point", "current_stock", "days_of_inventory", health.alias("stock_health_status"), "is_critical",
        "stockout_risk_score", "risk_tier", stockout_text().alias("explanation_text"),
    ).orderBy(F.desc("stockout_risk_score"), "material_id")
    return rows if limit is None else rows.limit(limit)


def list_purchase_orders(
    t: Tables,
    as_of: date,
    status: str | None = None,
    supplier_id=None,
    search: str | None = None,
    search_in: Sequence[str] = ("po_number", "po_id"),
    limit: int | None = None,
) -> DataFrame:
    """Orders, longest overdue first. The limit is taken before the supplier names are looked up,
    unless the search needs the name."""
    late = F.greatest(F.datediff(F.lit(as_of), "promised_delivery_date"), F.lit(0))
    orders = t["fact_purchase_orders"].where(
        all_of([_equal("status", status), _equal("supplier_id", supplier_id)])
    ).withColumn("days_overdue", F.when(F.col("status") == "OVERDUE", late).otherwise(0))
    names = t["dim_supplier"].select("supplier_id", F.col("name").alias("supplier_name"))
    order = [F.desc(F.col("status") == "OVERDUE"), F.desc("days_overdue"), F.col("po_id")]
    by_name = search is not None and "supplier_name" in search_in
    if by_name:
        orders = orders.join(names, "supplier_id", "left")
    if search:
        orders = orders.where(_matches(search, search_in))
    if limit is not None:
        orders = orders.orderBy(*order).limit(limit)
    if not by_name:
        orders = orders.join(names, "supplier_id", "left")
    return orders.select(
        "po_id", "po_number", "supplier_id", F.coalesce("supplier_name", F.lit("")).alias("supplier_name"),
        "order_date", "promised_delivery_date", "status", "total_amount", "currency", "days_overdue",
    ).orderBy(*order)


def filter_boxes(t: Tables, as_of: date | None = None) -> DataFrame:
    """Values of the category filters, with ALL."""
    def box(name: str, table: str) -> DataFrame:
        values = t[table].select(F.explode(F.array(F.lit("ALL"), F.col("category"))).alias("value")).distinct()
        return values.select(F.lit(name).alias("filter"), "value")

    return box("supplier_category", "dim_supplier").unionByName(box("material_category", "dim_material"))


def doi_block():
    """Order-preserving cells of a non-negative figure: whole numbers, then logarithmic steps."""
    value = F.col("days_of_inventory")
    return F.when(value < 65536, F.floor(value)).otherwise(
        65536 + F.floor(F.log2(F.greatest(value, F.lit(65536.0))) * 1000)
    )


def executive_kpis(
    t: Tables, suppliers: DataFrame, materials: DataFrame, alerts: DataFrame, actions: DataFrame
) -> DataFrame:
    """Eight headline figures in one row, one aggregation per source."""
    slip = F.col("delivery_variance_days")
    punctual = t["fact_goods_receipts"].agg(
        F.count_if(slip <= 0).alias("hits"), F.count(F.lit(1)).alias("n")
    )
    overdue = t["fact_purchase_orders"].where(F.col("status") == "OVERDUE").agg(
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast(MONEY)
    )
    tier = risk_tier(round_half_even(F.col("score"), 1))
    value = (F.col("current_stock").cast("decimal(18,0)") * F.col("standard_cost")).cast(MONEY)
    stock = materials.agg(F.struct(
        F.count_if((F.col("days_of_inventory") <= 0) | (tier == "CRITICAL")).alias("out"),
        F.sum(value).cast(MONEY).alias("value"),
    )).scalar()
    risky = suppliers.agg(F.count_if(tier.isin("CRITICAL", "HIGH")))
    median = exact_median(materials, "days_of_inventory", doi_block())
    share = F.col("hits").cast("double") / F.nullif(F.col("n"), F.lit(0)).cast("double")
    return punctual.select(
        round_half_even(share * 100.0, 1).alias("on_time_delivery_rate"),
        overdue.scalar().alias("total_spend_at_risk_usd"),
        stock["out"].alias("active_stockouts_count"),
        stock["value"].alias("total_inventory_valuation_usd"),
        round_half_even(median.scalar(), 1).alias("average_days_of_inventory"),
        risky.scalar().alias("high_risk_suppliers_count"),
        alerts.agg(F.count_if(F.col("status") == "ACTIVE")).scalar().alias("active_alerts_count"),
        actions.agg(F.count_if(F.col("status").isin("OPEN", "IN_PROGRESS"))).scalar()
        .alias("open_corrective_actions_count"),
    )


def list_alerts(
    alerts: DataFrame, severity: str | None = None, alert_type: str | None = None, status: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    rows = alerts.where(
        all_of([_equal("severity", severity), _equal("alert_type", alert_type), _equal("status", status)])
    ).orderBy(F.desc("created_at"), "alert_id")
    return rows if limit is None else rows.limit(limit)


def list_actions(actions: DataFrame, status: str | None = None) -> DataFrame:
    return actions.where(all_of([_equal("status", status)])).orderBy(F.desc("updated_at"), "action_id")


def list_runs(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.desc("start_time"), "run_id")


def list_rejects(rejects: DataFrame) -> DataFrame:
    """Newest first. The rejects of a run share time and table, so the payload parts them among tasks."""
    return rejects.orderBy(F.desc("rejected_at"), "source_table", "payload")


def list_quality_results(results: DataFrame) -> DataFrame:
    return results.orderBy(F.desc("executed_at"), "test_name")


def scoring_summary(t: Tables, as_of: date | None = None) -> DataFrame:
    return t["fact_purchase_orders"].agg(F.max("order_date").alias("timestamp")).select(
        F.lit("COMPLETED").alias("status"),
        t["dim_supplier"].agg(F.count(F.lit(1))).scalar().alias("scored_suppliers"),
        t["dim_material"].agg(F.count(F.lit(1))).scalar().alias("scored_materials"),
        "timestamp",
    )


def export_snapshot(lists: dict[str, DataFrame], folder: str) -> None:
    """Write each list as JSON files of its own."""
    for name, df in lists.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


