"""Dashboard charts as aggregate queries over the marts and facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantline.functions.exprs import ratio
from plantline.plans.analytics import FINISHED_UNIT_VALUE, delayed_orders
from plantline.plans.marts import (
    MONEY,
    Tables,
    inventory_health,
    movement_totals,
    production_at_risk,
    raw_warehouses,
    supplier_figures,
    supplier_performance,
)

BREACHES = ("STOCKOUT", "SAFETY_STOCK_BREACH")


def _money_sum(column: str) -> Column:
    return F.sum(column).cast(MONEY)


def global_otd(t: Tables, as_of: date) -> DataFrame:
    """Weighted by deliveries; summed over receipts of known suppliers."""
    known = t["fact_goods_receipts"].join(t["dim_supplier"].select("supplier_id"), "supplier_id", "left_semi")
    return known.agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.count_if(F.col("delivery_variance_days") <= 0).alias("on_time_deliveries"),
    ).withColumn("otd_pct", ratio(F.col("on_time_deliveries"), F.col("total_deliveries"), 2, per=100))


def overdue_spend(t: Tables, as_of: date) -> DataFrame:
    late = t["fact_purchase_orders"].where(F.col("status") == "OVERDUE").join(
        t["dim_supplier"].select("supplier_id"), "supplier_id", "left_semi"
    )
    return late.agg(F.coalesce(_money_sum("total_amount"), F.lit(0).cast(MONEY)).alias("overdue_spend"))


def stock_health(t: Tables, as_of: date) -> DataFrame:
    return inventory_health(t, as_of).groupBy("stock_health_status").agg(F.count(F.lit(1)).alias("cells"))


def stockout_breach(t: Tables, as_of: date) -> DataFrame:
    return stock_health(t, as_of).where(F.col("stock_health_status").isin(*BREACHES))


def monthly_otd(t: Tables, as_of: date) -> DataFrame:
    months = t["fact_goods_receipts"].groupBy(F.trunc("receipt_date", "MM").alias("delivery_month")).agg(
        F.count(F.lit(1)).alias("deliveries"), F.count_if(F.col("delivery_variance_days") <= 0).alias("_hits")
    )
    return months.select(
        "delivery_month", "deliveries", ratio(F.col("_hits"), F.col("deliveries"), 2, per=100).alias("otd_pct")
    ).orderBy("delivery_month")


def high_risk_suppliers(t: Tables, as_of: date, limit: int | None = None) -> DataFrame:
    rows = supplier_figures(t).select(
        "supplier_id", "supplier_name", "supplier_category", "otd_percentage", "overall_defect_ppm"
    ).orderBy("otd_percentage", F.desc("overall_defect_ppm"), "supplier_id")
    return rows if limit is None else rows.limit(limit)


def otd_vs_ppm(t: Tables, as_of: date) -> DataFrame:
    return supplier_figures(t).select(
        "supplier_id", "supplier_name", "otd_percentage", "overall_defect_ppm", "total_spend"
    )


def lead_time_variance(t: Tables, as_of: date) -> DataFrame:
    return supplier_figures(t).select("supplier_id", "supplier_name", "avg_lead_time_variance_days").orderBy(
        F.desc("avg_lead_time_variance_days"), "supplier_id"
    )


def spend_by_category(t: Tables, as_of: date) -> DataFrame:
    spend = t["fact_purchase_orders"].groupBy("supplier_id").agg(_money_sum("total_amount").alias("spend"))
    return t["dim_supplier"].select("supplier_id", "category").join(spend, "supplier_id", "left").groupBy(
        F.col("category").alias("supplier_category")
    ).agg(F.coalesce(_money_sum("spend"), F.lit(0).cast(MONEY)).alias("total_spend"))


def scorecard_ledger(t: Tables, as_of: date) -> DataFrame:
    return supplier_performance(t).drop("on_time_deliveries").orderBy("supplier_category", "category_rank",
                                                                      "supplier_id")


def doi_by_category(t: Tables, as_of: date) -> DataFrame:
    """Summed stock over summed burn, so cells without consumption do not distort the figure."""
    return inventory_health(t, as_of).groupBy("category").agg(
        F.sum("current_stock").alias("stock"), F.sum("consumption_last_30d").alias("consumed")
    ).select(
        "category", "stock", "consumed", ratio(F.col("stock"), F.col("consumed"), 1, per=30).alias("days_of_inventory")
    )


def warehouse_valuation(t: Tables, as_of: date) -> DataFrame:
    """Cells without stock add nothing, so the ledger totals are joined straight to the materials."""
    cells = movement_totals(t, as_of, 30).join(
        raw_warehouses(t).select("warehouse_id", F.col("name").alias("warehouse_name")), "warehouse_id"
    )
    materials = t["dim_material"].select("material_id", "category", "standard_cost")
    worth = (F.col("stock").cast("decimal(18,0)") * F.col("standard_cost")).cast(MONEY)
    return cells.join(materials, "material_id").groupBy("warehouse_id", "warehouse_name", "category").agg(
        F.sum(worth).cast(MONEY).alias("valuation")
    )


def critical_below_safety(t: Tables, as_of: date) -> DataFrame:
    return inventory_health(t, as_of).where(
        F.col("is_critical") & F.col("stock_health_status").isin(*BREACHES)
    ).select("material_id", "sku", "warehouse_name", "current_stock", "safety_stock_level", "stock_health_status")


def po_aging(t: Tables, as_of: date) -> DataFrame:
    late = F.col("days_overdue")
    bracket = F.when(late <= 7, "1-7d").when(late <= 14, "8-14d").otherwise(">14d")
    return delayed_orders(t, as_of).groupBy(bracket.alias("aging_bracket")).agg(
        F.count(F.lit(1)).alias("orders"), _money_sum("total_amount").alias("total_value")
    )


def delayed_by_factory(t: Tables, as_of: date) -> DataFrame:
    """Counted per factory key first, then named."""
    counts = delayed_orders(t, as_of).groupBy("factory_id").agg(
        F.count(F.lit(1)).alias("orders"), _money_sum("total_amount").alias("total_value")
    )
    return counts.join(t["dim_factory"], "factory_id").select(
        "factory_id", F.col("name").alias("factory_name"), "orders", "total_value"
    )


def delayed_tracker(t: Tables, as_of: date) -> DataFrame:
    names = t["dim_supplier"].select("supplier_id", F.col("name").alias("supplier_name"))
    return delayed_orders(t, as_of).join(names, "supplier_id").select(
        "po_id", "po_number", "supplier_name", "status", "promised_delivery_date", "total_amount", "days_overdue"
    ).orderBy(F.desc("days_overdue"), "po_id")


def inspection_outcomes(t: Tables, as_of: date) -> DataFrame:
    counts = t["fact_quality_inspections"].groupBy("disposition").agg(F.count(F.lit(1)).alias("inspections"))
    total = F.sum("inspections").over(Window.partitionBy())
    return counts.withColumn("share_pct", ratio(F.col("inspections"), total, 2, per=100))


def defect_pareto(t: Tables, as_of: date) -> DataFrame:
    """The cumulative share is windowed over one row per defect code."""
    counts = t["fact_quality_inspections"].where(F.col("defect_type_code").isNotNull()).groupBy(
        "defect_type_code"
    ).agg(F.sum("defect_count").alias("defects"))
    so_far = F.sum("defects").over(
        Window.orderBy(F.desc("defects"), "defect_type_code").rowsBetween(Window.unboundedPreceding, 0)
    )
    total = F.sum("defects").over(Window.partitionBy())
    return counts.withColumn("cumulative_pct", ratio(so_far, total, 2, per=100))


def top_ppm_materials(t: Tables, as_of: date, limit: int | None = None) -> DataFrame:
    sums = t["fact_quality_inspections"].groupBy("material_id").agg(
        F.sum("defect_count").alias("defects"), F.sum("sample_size").alias("samples")
    )
    worst = sums.withColumn("defect_ppm", ratio(F.col("defects"), F.col("samples"), 0, per=1_000_000)).orderBy(
        F.desc("defect_ppm"), "material_id"
    )
    if limit is not None:
        worst = worst.limit(limit)
    return worst.join(t["dim_material"].select("material_id", "sku"), "material_id")


def fg_value_at_risk(t: Tables, as_of: date) -> DataFrame:
    """Each at-risk work order counts once, however many components it lacks."""
    orders = production_at_risk(t).where(F.col("risk_classification") != "ALLOCATED").groupBy("work_order_id").agg(
        F.max("planned_quantity").alias("planned")
    )
    return orders.agg(
        F.count(F.lit(1)).alias("work_orders"),
        F.coalesce((F.sum("planned") * FINISHED_UNIT_VALUE).cast(MONEY), F.lit(0).cast(MONEY)).alias("value_at_risk"),
    )


def work_orders_by_risk(t: Tables, as_of: date) -> DataFrame:
    pairs = production_at_risk(t).select("risk_classification", "work_order_id").distinct()
    return pairs.groupBy("risk_classification").agg(F.count(F.lit(1)).alias("work_orders"))


def bom_shortage_matrix(t: Tables, as_of: date) -> DataFrame:
    return production_at_risk(t).where(F.col("risk_classification") != "ALLOCATED").select(
        "work_order_id", "product_sku", "factory_name", "priority", "material_id", "component_sku",
        "required_quantity", "shortage_quantity", "total_network_stock", "component_cost_at_risk",
        "risk_classification",
    )


CHARTS = {
    "chart_global_otd": global_otd,
    "chart_overdue_spend": overdue_spend,
    "chart_stockout_breach": stockout_breach,
    "chart_monthly_otd": monthly_otd,
    "chart_high_risk_suppliers": high_risk_suppliers,
    "chart_otd_vs_ppm": otd_vs_ppm,
    "chart_lead_time_variance": lead_time_variance,
    "chart_spend_by_category": spend_by_category,
    "chart_scorecard_ledger": scorecard_ledger,
    "chart_doi_by_category": doi_by_category,
    "chart_stock_health": stock_health,
    "chart_warehouse_valuation": warehouse_valuation,
    "chart_critical_below_safety": critical_below_safety,
    "chart_po_aging": po_aging,
    "chart_delayed_by_factory": delayed_by_factory,
    "chart_delayed_tracker": delayed_tracker,
    "chart_inspection_outcomes": inspection_outcomes,
    "chart_defect_pareto": defect_pareto,
    "chart_top_ppm_materials": top_ppm_materials,
    "chart_fg_value_at_risk": fg_value_at_risk,
    "chart_wo_by_risk": work_orders_by_risk,
    "chart_bom_shortage_matrix": bom_shortage_matrix,
}
