"""Risk features per supplier and per material, from the whole history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantline.functions.exprs import real_ratio, round_scaled, sample_std
from plantline.plans.marts import MONEY, OPEN_ORDER_STATES, Tables, delivery_totals, inspection_totals
from plantline.sources.warehouse import ledger_flows

SUPPLIER_FEATURES = (
    "otd_rate_90d", "avg_variance_days", "std_variance_days", "defect_ppm_90d", "financial_risk_score",
    "single_source_count", "overdue_po_count",
)
MATERIAL_FEATURES = (
    "days_of_inventory", "safety_stock_ratio", "daily_burn_rate", "lead_time_days", "total_shortage_units",
    "active_allocations_count", "is_critical",
)

# Stand-ins for suppliers and materials without history.
PPM_WITHOUT_INSPECTION = 500.0
STD_WITHOUT_RECEIPT, STD_OF_ONE_RECEIPT = 1.0, 0.0
STOCK_WITHOUT_MOVEMENT = 100
BURN_WITHOUT_CONSUMPTION, LEAST_BURN, BURN_DAYS = 5.0, 0.1, 90.0


def supplier_features(t: Tables, as_of: date | None = None) -> DataFrame:
    overdue = t["fact_purchase_orders"].where(F.col("status") == "OVERDUE").groupBy("supplier_id").agg(
        F.count("po_id").alias("late"), F.sum("total_amount").cast(MONEY).alias("late_spend")
    )
    sole = t["dim_material"].where(F.col("secondary_supplier_id").isNull() & F.col("is_critical")).groupBy(
        F.col("primary_supplier_id").alias("supplier_id")
    ).agg(F.count("material_id").alias("sole"))
    joined = (
        t["dim_supplier"]
        .join(delivery_totals(t), "supplier_id", "left")
        .join(inspection_totals(t), "supplier_id", "left")
        .join(overdue, "supplier_id", "left")
        .join(sole, "supplier_id", "left")
    )
    n, hits, slip = F.col("total_deliveries"), F.col("on_time_deliveries"), F.col("slip_sum")
    spread = sample_std(n, slip, F.col("slip_squares"))
    share = real_ratio(F.col("defects"), F.col("samples"))
    return joined.select(
        *t["dim_supplier"].columns,
        F.coalesce(real_ratio(hits, n) * 100.0, F.col("reliability_rating")).alias("otd_rate_90d"),
        F.coalesce(real_ratio(slip, n), F.lit(0.0)).alias("avg_variance_days"),
        F.when(n.isNull(), STD_WITHOUT_RECEIPT)
        .otherwise(F.coalesce(spread, F.lit(STD_OF_ONE_RECEIPT))).alias("std_variance_days"),
        F.when(F.col("samples").isNull(), PPM_WITHOUT_INSPECTION)
        .otherwise(F.coalesce(share * 1_000_000.0, F.lit(0.0))).alias("defect_ppm_90d"),
        F.coalesce("late", F.lit(0)).alias("overdue_po_count"),
        F.coalesce("late_spend", F.lit(0).cast(MONEY)).alias("overdue_spend_usd"),
        F.coalesce("sole", F.lit(0)).alias("single_source_count"),
        (100.0 - F.col("financial_health_score")).alias("financial_risk_score"),
    )


def material_features(t: Tables, as_of: date | None = None) -> DataFrame:
    ledger = ledger_flows(t, cell=["material_id"]).groupBy("material_id").agg(F.sum("quantity").alias("stock"), F.sum("outflow").alias("consumed"))
    allocations = t["fact_bom_allocations"].groupBy("material_id").agg(
        F.count("allocation_id").alias("allocations"),
        F.sum("required_quantity").alias("total_required_units"),
        F.sum("shortage_quantity").alias("short"),
    )
    stock = F.greatest(F.coalesce("stock", F.lit(STOCK_WITHOUT_MOVEMENT)), F.lit(0)).cast("bigint")
    burn = F.coalesce(
        F.greatest(F.col("consumed").cast("double") / BURN_DAYS, F.lit(LEAST_BURN)), F.lit(BURN_WITHOUT_CONSUMPTION)
    )
    # greatest skips nulls, so "no consumption" is decided first.
    burn = F.when(F.col("consumed").isNull(), BURN_WITHOUT_CONSUMPTION).otherwise(burn)
    return (
        t["dim_material"]
        .join(ledger, "material_id", "left")
        .join(allocations, "material_id", "left")
        .select(
            *t["dim_material"].columns,
            stock.alias("current_stock"),
            burn.alias("daily_burn_rate"),
            round_scaled(stock.cast("double") / burn, 1).alias("days_of_inventory"),
            round_scaled(
                stock.cast("double") / F.greatest(F.col("safety_stock_level"), F.lit(1)).cast("double"), 2
            ).alias("safety_stock_ratio"),
            F.coalesce("allocations", F.lit(0)).alias("active_allocations_count"),
            "total_required_units",
            F.coalesce("short", F.lit(0)).alias("total_shortage_units"),
        )
    )


def open_orders_by_warehouse(t: Tables, as_of: date | None = None) -> DataFrame:
    return t["fact_purchase_orders"].where(F.col("status").isin(*OPEN_ORDER_STATES)).groupBy("warehouse_id").agg(
        F.count("po_id").alias("open_pos_count")
    )
