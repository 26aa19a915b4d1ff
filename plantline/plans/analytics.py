"""Inventory turnover, delayed orders and work-order shortage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.functions.exprs import quotient, ratio
from plantline.plans.marts import MONEY, OPEN_WORK_STATES, Tables, stocked_materials

# Fixed value: worth of one finished unit.
FINISHED_UNIT_VALUE = 2500


def inventory_turnover(t: Tables, as_of: date) -> DataFrame:
    """Stock, 90-day burn, cover and yearly turnover per material and raw warehouse."""
    grid = stocked_materials(
        t, as_of, 90,
        ["material_id", "sku", "material_name", "category", "is_critical", "standard_cost", "safety_stock_level",
         "reorder_point"],
    )
    stock, burned = F.col("stock"), F.col("consumed")
    value = (stock.cast("decimal(18,0)") * F.col("standard_cost")).cast(MONEY)
    cover = quotient(stock, burned, per=90)
    status = (
        F.when(stock <= 0, "OUT_OF_STOCK")
        .when(stock < F.col("safety_stock_level"), "CRITICAL_SAFETY_BREACH")
        .when(stock < F.col("reorder_point"), "REORDER_RECOMMENDED")
        .when(cover > 90, "EXCESS_INVENTORY")
        .otherwise("OPTIMAL")
    )
    return grid.select(
        "material_id", "sku", "material_name", "category", "is_critical", "standard_cost", "warehouse_id",
        "warehouse_name", "warehouse_type",
        stock.alias("on_hand_units"),
        value.alias("total_inventory_value_usd"),
        "safety_stock_level", "reorder_point",
        ratio(burned, F.lit(90), 2).alias("avg_daily_burn_rate"),
        F.coalesce(F.round(cover, 1).cast("double"), F.lit(999.0)).alias("days_of_inventory"),
        # The unit cost cancels out of cost of goods over inventory value.
        F.when(value > 0, ratio(burned, stock * 90, 2, per=365)).otherwise(0.0).alias("inventory_turnover_ratio"),
        status.alias("safety_stock_status"),
    ).orderBy(
        F.when(F.col("on_hand_units") <= 0, 1)
        .when(F.col("on_hand_units") < F.col("safety_stock_level"), 2)
        .otherwise(3),
        F.desc("is_critical"),
        "days_of_inventory",
        "material_id",
        "warehouse_id",
    )


def is_delayed(as_of: date) -> Column:
    late = F.col("promised_delivery_date") < F.lit(as_of)
    return (F.col("status") == "OVERDUE") | ((F.col("status") == "IN_TRANSIT") & late)


def delayed_orders(t: Tables, as_of: date) -> DataFrame:
    """Orders overdue by status, or in transit past their promised date."""
    return t["fact_purchase_orders"].where(is_delayed(as_of)).withColumn(
        "days_overdue", F.datediff(F.lit(as_of), "promised_delivery_date")
    )


def delayed_po_impact(t: Tables, as_of: date) -> DataFrame:
    """Delayed orders by supplier name, category and rating; orders without lines do not count.

    Lines are reduced to one row per delayed order before anything else is joined.
    """
    orders = delayed_orders(t, as_of).select("po_id", "supplier_id", "factory_id", "total_amount", "days_overdue")
    materials = t["dim_material"].select("material_id", F.col("is_critical").cast("int").alias("critical"))
    lines = (
        t["fact_purchase_order_lines"].select("po_id", "material_id")
        .join(orders.select("po_id"), "po_id", "left_semi")
        .join(materials, "material_id")
        .groupBy("po_id")
        .agg(F.sum("critical").alias("critical_lines"))
    )
    suppliers = t["dim_supplier"].select(
        "supplier_id", F.col("name").alias("supplier_name"), F.col("category").alias("supplier_category"),
        "reliability_rating",
    )
    amount, late = F.col("total_amount"), F.col("days_overdue")

    def value_where(condition: Column) -> Column:
        return F.sum(F.when(condition, amount).otherwise(0)).cast(MONEY)

    totals = (
        orders.join(lines, "po_id")
        .join(t["dim_factory"].select("factory_id"), "factory_id")
        .join(suppliers, "supplier_id")
        .groupBy("supplier_name", "supplier_category", "reliability_rating")
        .agg(
            F.count("po_id").alias("total_delayed_pos"),
            F.sum(amount).cast(MONEY).alias("total_delayed_value_usd"),
            F.sum(late).alias("late_sum"),
            F.max(late).alias("max_days_overdue"),
            F.sum("critical_lines").alias("total_critical_lines_impacted"),
            value_where(late <= 7).alias("value_overdue_1_7_days"),
            value_where(late.between(8, 14)).alias("value_overdue_8_14_days"),
            value_where(late > 14).alias("value_overdue_gt_14_days"),
        )
    )
    critical = F.col("total_critical_lines_impacted") > 0
    return totals.select(
        "supplier_name", "supplier_category", "reliability_rating", "total_delayed_pos", "total_delayed_value_usd",
        ratio(F.col("late_sum"), F.col("total_delayed_pos"), 1).alias("avg_days_overdue"),
        "max_days_overdue", "total_critical_lines_impacted", "value_overdue_1_7_days", "value_overdue_8_14_days",
        "value_overdue_gt_14_days",
        F.when(critical & (F.col("late_sum") > F.col("total_delayed_pos") * 10), "URGENT_PRODUCTION_HALT_RISK")
        .when(critical, "ELEVATED_SCHEDULE_RISK")
        .otherwise("STANDARD_LOGISTICS_DELAY").alias("delay_severity_tier"),
    ).orderBy(F.desc("total_delayed_value_usd"), "supplier_name")


def bom_production_risk(t: Tables, as_of: date | None = None) -> DataFrame:
    """Open work orders with their short components and the finished goods they hold up."""
    materials = t["dim_material"].select("material_id", "standard_cost")
    short = F.col("shortage_quantity")
    shortages = (
        t["fact_bom_allocations"].where(short > 0)
        .join(materials, "material_id")
        .groupBy("work_order_id")
        .agg(
            F.count("material_id").alias("components"),
            F.sum(short).alias("units"),
            F.sum((short.cast("decimal(10,0)") * F.col("standard_cost")).cast(MONEY)).cast(MONEY).alias("cost"),
        )
    )
    components = F.coalesce("components", F.lit(0))
    factories = t["dim_factory"].select("factory_id", F.col("name").alias("factory_name"))
    impact = (
        F.when((F.col("priority") == "CRITICAL") & (components > 0), "CRITICAL_LINE_DOWN")
        .when(components > 0, "SCHEDULE_COMPROMISED")
        .otherwise("ON_SCHEDULE")
    )
    return (
        t["fact_production_schedules"].where(F.col("status").isin(*OPEN_WORK_STATES))
        .join(factories, "factory_id")
        .join(shortages, "work_order_id", "left")
        .select(
            "work_order_id", "product_sku", "factory_name", "start_date", "end_date", "planned_quantity",
            F.col("status").alias("work_order_status"), "priority",
            components.alias("shortage_components_count"),
            F.coalesce("units", F.lit(0)).cast("bigint").alias("total_shortage_units"),
            F.coalesce("cost", F.lit(0).cast(MONEY)).alias("material_cost_shortfall_usd"),
            (F.col("planned_quantity").cast("decimal(12,0)") * FINISHED_UNIT_VALUE).cast(MONEY)
            .alias("finished_goods_value_at_risk"),
            impact.alias("operational_impact_status"),
        )
        .orderBy(
            F.when(F.col("priority") == "CRITICAL", 1).when(F.col("priority") == "HIGH", 2).otherwise(3),
            "operational_impact_status",
            F.desc("finished_goods_value_at_risk"),
            "work_order_id",
        )
    )
