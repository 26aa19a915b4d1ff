"""The three marts: supplier performance, inventory health, production at risk."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantline.functions.exprs import quotient, ratio, real_ratio, sample_std
from plantline.operators.grid import pair_with_all
from plantline.operators.ordered import dense_ranks
from plantline.sources.warehouse import ledger_flows

Tables = Mapping[str, DataFrame]

OPEN_ORDER_STATES = ("PENDING", "IN_TRANSIT")
OPEN_WORK_STATES = ("PLANNED", "IN_PROGRESS", "BLOCKED_SHORTAGE")
MONEY = "decimal(20,2)"


def raw_warehouses(t: Tables) -> DataFrame:
    return t["dim_warehouse"].where(F.col("warehouse_type") == "RAW_MATERIALS")


def delivery_totals(t: Tables) -> DataFrame:
    """Whole-number delivery sums per supplier; every later figure is derived from these."""
    slip = F.col("delivery_variance_days").cast("bigint")
    return t["fact_goods_receipts"].groupBy("supplier_id").agg(
        F.count("receipt_id").alias("total_deliveries"),
        F.count_if(slip <= 0).alias("on_time_deliveries"),
        F.sum(slip).alias("slip_sum"),
        F.sum(slip * slip).alias("slip_squares"),
    )


def inspection_totals(t: Tables) -> DataFrame:
    return t["fact_quality_inspections"].groupBy("supplier_id").agg(
        F.sum("defect_count").alias("defects"), F.sum("sample_size").alias("samples")
    )


def spend_totals(t: Tables) -> DataFrame:
    amount = F.col("total_amount")
    return t["fact_purchase_orders"].groupBy("supplier_id").agg(
        F.sum(amount).cast(MONEY).alias("spend"),
        F.sum(F.when(F.col("status") == "OVERDUE", amount).otherwise(0)).cast(MONEY).alias("overdue"),
    )


def supplier_figures(t: Tables) -> DataFrame:
    """One row per supplier: deliveries, punctuality, defects and spend, without the rank."""
    delivered = F.coalesce("total_deliveries", F.lit(0))
    joined = (
        t["dim_supplier"]
        .select("supplier_id", "code", "name", "category", "country", "tier", "reliability_rating",
                "financial_health_score")
        .join(delivery_totals(t), "supplier_id", "left")
        .join(inspection_totals(t), "supplier_id", "left")
        .join(spend_totals(t), "supplier_id", "left")
    )
    zero = F.lit(0.0)
    return joined.select(
        "supplier_id",
        F.col("code").alias("supplier_code"),
        F.col("name").alias("supplier_name"),
        F.col("category").alias("supplier_category"),
        "country",
        "tier",
        F.col("reliability_rating").alias("baseline_reliability"),
        "financial_health_score",
        delivered.alias("total_deliveries"),
        F.when(delivered > 0, ratio(F.col("on_time_deliveries"), F.col("total_deliveries"), 2, per=100))
        .otherwise(100.0).alias("otd_percentage"),
        F.coalesce(ratio(F.col("slip_sum"), F.col("total_deliveries"), 2), zero).alias("avg_lead_time_variance_days"),
        F.coalesce(
            F.round(sample_std(F.col("total_deliveries"), F.col("slip_sum"), F.col("slip_squares")), 2), zero
        ).alias("lead_time_variance_std"),
        F.coalesce(ratio(F.col("defects"), F.col("samples"), 0, per=1_000_000), zero).alias("overall_defect_ppm"),
        F.coalesce("spend", F.lit(0).cast(MONEY)).alias("total_spend"),
        F.coalesce("overdue", F.lit(0).cast(MONEY)).alias("overdue_spend"),
        F.coalesce(F.col("on_time_deliveries"), F.lit(0)).alias("on_time_deliveries"),
        F.coalesce(real_ratio(F.col("on_time_deliveries"), F.col("total_deliveries")), F.lit(1.0)).alias("_share"),
    )


def supplier_performance(t: Tables, as_of: date | None = None) -> DataFrame:
    """The supplier figures with the rank in the category, by punctuality and then defect rate.

    Ranking uses the figures twice; both uses take the same exchanges, so that the
    facts behind them are scanned once.
    """
    # Blocks of one millionth of the punctuality range; within a block the defect
    # rate is a whole number of at most a million, so blocks stay small.
    block = F.floor((1.0 - F.col("_share")) * 1_000_000)
    ranked = dense_ranks(
        supplier_figures(t), ["supplier_category"], [("_share", False), ("overall_defect_ppm", True)], "category_rank", block
    )
    return ranked.drop("_share")


def category_ranks(t: Tables, as_of: date | None = None) -> DataFrame:
    return supplier_performance(t).select(
        "supplier_id", "supplier_category", "otd_percentage", "overall_defect_ppm", "category_rank"
    )


def movement_totals(t: Tables, as_of: date, days: int) -> DataFrame:
    """Stock and recent consumption per material and warehouse, in one pass over the quarters not summed up yet."""
    flows = ledger_flows(t, as_of - timedelta(days=days))
    return flows.groupBy("material_id", "warehouse_id").agg(
        F.sum("quantity").alias("stock"), F.coalesce(F.sum("recent"), F.lit(0)).alias("consumed")
    )


def open_pipeline(t: Tables) -> DataFrame:
    """Quantity still to arrive per material and warehouse."""
    orders = t["fact_purchase_orders"].where(F.col("status").isin(*OPEN_ORDER_STATES)).select("po_id", "warehouse_id")
    return (
        t["fact_purchase_order_lines"].select("po_id", "material_id", "quantity_ordered")
        .join(orders, "po_id")
        .groupBy("material_id", "warehouse_id")
        .agg(F.sum("quantity_ordered").alias("on_order"))
    )


def stocked_materials(t: Tables, as_of: date, days: int, columns: list[str]) -> DataFrame:
    """Material x raw warehouse grid with its ledger totals; absent cells count as zero."""
    warehouses = raw_warehouses(t).select(
        "warehouse_id", F.col("name").alias("warehouse_name"), "factory_id", "warehouse_type"
    )
    materials = t["dim_material"].withColumnRenamed("name", "material_name").select(*columns)
    return (
        pair_with_all(materials, "material_id", warehouses)
        .join(movement_totals(t, as_of, days), ["material_id", "warehouse_id"], "left")
        .withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("stock", "consumed")})
    )


def inventory_health(t: Tables, as_of: date) -> DataFrame:
    """Stock, 30-day consumption, days of inventory and health per material and raw warehouse."""
    grid = stocked_materials(
        t, as_of, 30,
        ["material_id", "sku", "material_name", "category", "is_critical", "standard_cost", "safety_stock_level",
         "reorder_point"],
    ).join(open_pipeline(t), ["material_id", "warehouse_id"], "left")
    stock, consumed = F.col("stock"), F.col("consumed")
    cover = quotient(stock, consumed, per=30)
    return grid.select(
        "material_id", "sku", "material_name", "category", "is_critical", "standard_cost", "safety_stock_level",
        "reorder_point", "warehouse_id", "warehouse_name", "factory_id",
        stock.alias("current_stock"),
        (stock.cast("decimal(18,0)") * F.col("standard_cost")).cast(MONEY).alias("current_stock_valuation"),
        consumed.alias("consumption_last_30d"),
        ratio(consumed, F.lit(30), 2).alias("daily_burn_rate"),
        F.coalesce(F.round(cover, 1).cast("double"), F.lit(999.0)).alias("days_of_inventory"),
        F.coalesce("on_order", F.lit(0)).cast("bigint").alias("quantity_on_order"),
        F.when(stock <= 0, "STOCKOUT")
        .when(stock < F.col("safety_stock_level"), "SAFETY_STOCK_BREACH")
        .when(stock < F.col("reorder_point"), "REORDER_TRIGGER")
        .when(cover > 90, "OVERSTOCK")
        .otherwise("HEALTHY").alias("stock_health_status"),
    )


def network_stock(t: Tables) -> DataFrame:
    """Stock of each material over all raw warehouses, straight from the ledger."""
    return (
        t["fact_inventory_movements"].select("material_id", "warehouse_id", "quantity")
        .join(raw_warehouses(t).select("warehouse_id"), "warehouse_id", "left_semi")
        .groupBy("material_id")
        .agg(F.sum("quantity").alias("total_network_stock"))
    )


def production_at_risk(t: Tables, as_of: date | None = None, inventory: DataFrame | None = None) -> DataFrame:
    """One row per component of an open work order, with its shortage class.

    ``inventory`` is a stored inventory mart; without one the network stock is
    summed from the ledger, which gives the same totals with one aggregation.
    """
    if inventory is None:
        stock = network_stock(t)
    else:
        stock = inventory.groupBy("material_id").agg(F.sum("current_stock").alias("total_network_stock"))
    orders = t["fact_production_schedules"].where(F.col("status").isin(*OPEN_WORK_STATES))
    factories = t["dim_factory"].select("factory_id", F.col("name").alias("factory_name"))
    materials = t["dim_material"].select(
        "material_id",
        F.col("sku").alias("component_sku"),
        F.col("name").alias("component_name"),
        F.col("is_critical").alias("is_component_critical"),
        "standard_cost",
    )
    available = F.coalesce("total_network_stock", F.lit(0)).cast("bigint")
    required = F.col("required_quantity")
    return (
        t["fact_bom_allocations"]
        .join(orders, "work_order_id")
        .join(factories, "factory_id")
        .join(materials, "material_id")
        .join(stock, "material_id", "left")
        .select(
            "work_order_id", "product_sku", "factory_id", "factory_name", "planned_quantity", "start_date",
            "end_date", F.col("status").alias("wo_status"), "priority", "material_id", "component_sku",
            "component_name", "is_component_critical", "required_quantity", "allocated_quantity",
            "shortage_quantity", available.alias("total_network_stock"),
            (required.cast("decimal(10,0)") * F.col("standard_cost")).cast(MONEY).alias("component_cost_at_risk"),
            F.when(F.col("shortage_quantity") > 0, "CRITICAL_SHORTAGE")
            .when(available < required, "PROJECTED_SHORTAGE")
            .otherwise("ALLOCATED").alias("risk_classification"),
        )
    )
