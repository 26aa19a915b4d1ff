"""Three questions, each asked in a slow and in a fast form."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantline.functions.exprs import ratio, real_ratio
from plantline.operators.ordered import running_totals_in_one_scan, trailing_sums
from plantline.plans.marts import MONEY, Tables, production_at_risk
from plantline.sources.warehouse import LEDGER_RANGE, ledger_between

CELL = ["material_id", "warehouse_id"]
LEDGER_ORDER = ["movement_date", "movement_id", "quantity"]
BURN_ROWS = 31
# What of a movement id names its block within a day: leading characters (of an id like MOV-00012345 all but the last
# three, so a thousand ids), or a span of numbers.
ID_PREFIX, ID_SPAN = 9, 1 << 20


def _ledger_rows(movements: DataFrame) -> DataFrame:
    return movements.select(*CELL, *LEDGER_ORDER)


def _block(rows: DataFrame) -> Column:
    """Day and leading part of the movement id: follows the order of the ledger and cuts busy days too."""
    text = isinstance(rows.schema["movement_id"].dataType, T.StringType)
    part = F.substring("movement_id", 1, ID_PREFIX) if text else F.floor(F.col("movement_id") / ID_SPAN)
    return F.struct(F.col("movement_date").alias("day"), part.alias("part"))


def _balance(rows: DataFrame, **more: Column) -> DataFrame:
    return running_totals_in_one_scan(
        rows, CELL, _block(rows), [F.col(c) for c in LEDGER_ORDER], {"running_balance": F.col("quantity"), **more}
    )


def running_balance(movements: DataFrame) -> DataFrame:
    """Balance since the first row given, per material and warehouse."""
    return _balance(_ledger_rows(movements))


def balance_and_burn(movements: DataFrame) -> DataFrame:
    """Running balance plus the mean outflow over the last 31 rows (rows, not days)."""
    out = F.col("quantity") < 0
    outflow = {"_out": F.when(out, -F.col("quantity")), "_outs": F.when(out, 1)}
    numbered = _balance(_ledger_rows(movements), _position=F.lit(1))
    sums = trailing_sums(numbered, CELL, "_position", BURN_ROWS, outflow)
    return sums.withColumn("rolling_30d_burn_rate", real_ratio(F.col("_out"), F.col("_outs"))).drop(
        "_position", "_out", "_outs"
    )


def all_running_balances(t: Tables, as_of: date | None = None) -> DataFrame:
    return running_balance(t["fact_inventory_movements"])


def all_burn_rates(t: Tables, as_of: date | None = None) -> DataFrame:
    return balance_and_burn(t["fact_inventory_movements"]).drop("running_balance")


def material_balance_formatted(t: Tables, as_of: date | None, material_id: int, since: date) -> DataFrame:
    """Month compared as text: the filter cannot reach the parquet statistics."""
    month = F.date_format("movement_date", "yyyy-MM")
    return balance_and_burn(
        t["fact_inventory_movements"].where((F.col("material_id") == material_id) & (month >= f"{since:%Y-%m}"))
    )


def material_balance(
    t: Tables, as_of: date | None, material_id: int, since: date, declared: tuple[date, date] = LEDGER_RANGE
) -> DataFrame:
    """The same rows by a date comparison, which is pushed into the scan and prunes ledger quarters."""
    ledger = ledger_between(t["fact_inventory_movements"], since, declared=declared)
    return balance_and_burn(ledger.where(F.col("material_id") == material_id))


def scorecard_correlated(t: Tables, as_of: date | None, since: date) -> DataFrame:
    """One scalar subquery per figure; missing sums stay null."""
    suppliers = t["dim_supplier"].where("is_active").alias("s")
    receipts, orders = t["fact_goods_receipts"], t["fact_purchase_orders"]
    same = F.col("supplier_id") == F.col("s.supplier_id").outer()
    recent = receipts.where(same).where(F.col("receipt_date") >= F.lit(since))
    slip = F.col("delivery_variance_days")
    return suppliers.select(
        "supplier_id",
        "name",
        "category",
        recent.select(F.count(F.lit(1))).scalar().alias("total_receipts"),
        recent.where(slip <= 0).select(F.count(F.lit(1))).scalar().alias("on_time_receipts"),
        F.round(recent.select(real_ratio(F.sum(slip), F.count(slip))).scalar(), 6).alias("avg_delay_days"),
        orders.where(same).where(F.col("status") == "OVERDUE").select(F.sum("total_amount").cast(MONEY)).scalar()
        .alias("overdue_po_amount"),
    )


def scorecard(t: Tables, as_of: date | None, since: date) -> DataFrame:
    """The same question with one aggregation per fact; missing sums become zero."""
    slip = F.col("delivery_variance_days")
    receipts = t["fact_goods_receipts"].where(F.col("receipt_date") >= F.lit(since)).groupBy("supplier_id").agg(
        F.count("receipt_id").alias("n"), F.count_if(slip <= 0).alias("hits"), F.sum(slip).alias("slip_sum")
    )
    overdue = t["fact_purchase_orders"].where(F.col("status") == "OVERDUE").groupBy("supplier_id").agg(
        F.sum("total_amount").cast(MONEY).alias("amount")
    )
    count = F.coalesce("n", F.lit(0))
    return (
        t["dim_supplier"].where("is_active").select("supplier_id", "name", "category")
        .join(receipts, "supplier_id", "left")
        .join(overdue, "supplier_id", "left")
        .select(
            "supplier_id",
            "name",
            "category",
            count.alias("total_receipts"),
            F.coalesce("hits", F.lit(0)).alias("on_time_receipts"),
            F.coalesce(ratio(F.col("hits"), F.col("n"), 2, per=100), F.lit(100.0)).alias("otd_pct"),
            F.coalesce(ratio(F.col("slip_sum"), F.col("n"), 2), F.lit(0.0)).alias("avg_delay_days"),
            F.coalesce("amount", F.lit(0).cast(MONEY)).alias("overdue_po_amount"),
        )
    )


def _short_components(t: Tables) -> DataFrame:
    orders = t["fact_production_schedules"].where(F.col("status").isin("PLANNED", "BLOCKED_SHORTAGE")).select(
        "work_order_id", "product_sku", "priority"
    )
    materials = t["dim_material"].select("material_id", F.col("name").alias("material_name"), "standard_cost")
    return (
        t["fact_bom_allocations"].where("shortage_quantity > 0")
        .join(orders, "work_order_id")
        .join(materials, "material_id")
    )


def _line_value() -> Column:
    return (F.col("required_quantity").cast("decimal(10,0)") * F.col("standard_cost")).cast(MONEY)


def bom_shortage_correlated(t: Tables, as_of: date | None = None) -> DataFrame:
    """Short components with the stock of all warehouses, looked up by a scalar subquery."""
    stock = (
        t["fact_inventory_movements"]
        .where(F.col("material_id") == F.col("b.material_id").outer())
        .select(F.coalesce(F.sum("quantity"), F.lit(0)))
        .scalar()
    )
    return _short_components(t).alias("b").select(
        "work_order_id", "product_sku", "priority", "material_id", "material_name", "required_quantity",
        stock.alias("network_stock_on_hand"), _line_value().alias("line_value_usd"),
    )


def bom_shortage_mart(t: Tables, as_of: date | None = None, mart: DataFrame | None = None) -> DataFrame:
    """Critical shortages of the production mart: raw warehouses only, work in progress included."""
    source = production_at_risk(t) if mart is None else mart
    return source.where(F.col("risk_classification") == "CRITICAL_SHORTAGE").select(
        "work_order_id", "product_sku", "priority", "material_id", "component_name", "required_quantity",
        F.col("total_network_stock").alias("network_stock_on_hand"),
        F.col("component_cost_at_risk").alias("line_value_usd"), "risk_classification",
    )
