"""Data-quality assertions, dataset contracts and declared constraints."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from datetime import date, datetime, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.functions.exprs import fixed_text, round_half_even
from plantline.operators.checks import (
    KeyCheck,
    Reference,
    covers_years,
    duplicate_keys,
    minimum_rows,
    row_rules,
    table_checks,
    union_all,
)
from plantline.operators.validation import TIERS
from plantline.plans.marts import Tables
from plantline.sources.warehouse import ledger_flows

log = logging.getLogger(__name__)

# Thresholds of the two monitoring rules.
SHORTAGE_RATE_LIMIT = 25.0
FUTURE_RECEIPT_LIMIT = 50_000


def _result(
    counted: DataFrame,
    name: str,
    table: str,
    kind: str,
    metric: Column,
    threshold: float,
    failed: str,
    severity: str,
    details: Column,
    passed: Column | None = None,
) -> DataFrame:
    ok = metric <= threshold if passed is None else passed
    return counted.select(
        F.lit(name).alias("test_name"),
        F.lit(table).alias("target_table"),
        F.lit(kind).alias("assertion_type"),
        metric.cast("double").alias("metric_value"),
        F.lit(threshold).alias("threshold"),
        F.when(ok, "PASS").otherwise(failed).alias("status"),
        F.lit(severity).alias("severity"),
        details.alias("details"),
    )


def _found(text: str) -> Column:
    return F.concat(F.lit("Found "), F.col("n").cast("string"), F.lit(f" {text}"))


def negative_balance(t: Tables, as_of: date | None = None) -> DataFrame:
    balances = ledger_flows(t).groupBy("material_id", "warehouse_id").agg(F.sum("quantity").alias("stock"))
    return _result(
        balances.agg(F.count_if(F.col("stock") < 0).alias("n")),
        "assert_non_negative_inventory_balance", "fact_inventory_movements", "RANGE", F.col("n"), 0.0, "FAIL",
        "CRITICAL", _found("warehouse-material combinations with negative cumulative stock."),
    )


def orphan_receipts(t: Tables, as_of: date | None = None) -> DataFrame:
    orphans = t["fact_goods_receipts"].select("po_id").join(
        t["fact_purchase_orders"].select("po_id"), "po_id", "left_anti"
    )
    return _result(
        orphans.agg(F.count(F.lit(1)).alias("n")),
        "assert_no_orphaned_goods_receipts", "fact_goods_receipts", "REFERENTIAL", F.col("n"), 0.0, "FAIL",
        "CRITICAL", _found("orphaned goods receipt records without parent PO."),
    )


def receipt_chronology(t: Tables, as_of: date | None = None) -> DataFrame:
    orders = t["fact_purchase_orders"].select("po_id", "order_date")
    early = t["fact_goods_receipts"].select("po_id", "receipt_date").join(orders, "po_id").where(
        F.col("receipt_date") < F.col("order_date")
    )
    return _result(
        early.agg(F.count(F.lit(1)).alias("n")),
        "assert_delivery_date_chronology", "fact_goods_receipts", "POSITIVE_VALUE", F.col("n"), 0.0, "FAIL", "HIGH",
        _found("delivery receipts with receipt date earlier than order date."),
    )


def ppm_bounds(t: Tables, as_of: date | None = None) -> DataFrame:
    ppm = F.col("defect_ppm")
    return _result(
        t["fact_quality_inspections"].agg(F.count_if((ppm < 0) | (ppm > 1_000_000)).alias("n")),
        "assert_quality_ppm_within_physical_bounds", "fact_quality_inspections", "RANGE", F.col("n"), 0.0, "FAIL",
        "MEDIUM", _found("inspection records with invalid defect PPM."),
    )


def reorder_point(t: Tables, as_of: date | None = None) -> DataFrame:
    below = F.col("reorder_point") < F.col("safety_stock_level")
    return _result(
        t["dim_material"].agg(F.count_if(below).alias("n")),
        "assert_reorder_point_ge_safety_stock", "dim_material", "RANGE", F.col("n"), 0.0, "FAIL", "HIGH",
        _found("materials where reorder point is below safety stock."),
    )


def shortage_rate(t: Tables, as_of: date | None = None) -> DataFrame:
    """Work orders are reduced to one row each, so no distinct count is needed."""
    orders = t["fact_bom_allocations"].groupBy("work_order_id").agg(F.max("shortage_quantity").alias("worst"))
    counted = orders.agg(F.count_if(F.col("worst") > 0).alias("short"), F.count(F.lit(1)).alias("all"))
    total = F.greatest(F.col("all"), F.lit(1))
    rate = F.col("short").cast("double") / total.cast("double") * 100.0
    counted = counted.select("short", total.alias("total"), rate.alias("rate"))
    details = F.concat(
        F.col("short").cast("string"), F.lit(" out of "), F.col("total").cast("string"), F.lit(" work orders ("),
        fixed_text(F.col("rate"), 1), F.lit("%) have component shortages."),
    )
    return _result(
        counted, "monitor_work_order_shortage_rate", "fact_bom_allocations", "RANGE",
        round_half_even(F.col("rate"), 2), SHORTAGE_RATE_LIMIT, "WARNING", "MEDIUM", details,
        passed=F.col("rate") <= SHORTAGE_RATE_LIMIT,
    )


def future_receipts(t: Tables, as_of: date) -> DataFrame:
    future = F.col("receipt_date") > F.lit(as_of + timedelta(days=1))
    return _result(
        t["fact_goods_receipts"].agg(F.count_if(future).alias("n")),
        "assert_sensible_timestamp_ranges", "fact_goods_receipts", "RANGE", F.col("n"), float(FUTURE_RECEIPT_LIMIT),
        "WARNING", "LOW", F.lit("Verified receipt dates within permissible simulation timeline."),
        passed=F.col("n") < FUTURE_RECEIPT_LIMIT,
    )


RULES: tuple[Callable[[Tables, date], DataFrame], ...] = (
    negative_balance, orphan_receipts, receipt_chronology, ppm_bounds, reorder_point, shortage_rate, future_receipts,
)


def suite(t: Tables, as_of: date, run_id: str | None = None, at: datetime | None = None, rules=RULES) -> DataFrame:
    """All rules as one table. A rule that cannot be planned (missing table or column) is logged and left out."""
    results = []
    for rule in rules:
        try:
            results.append(rule(t, as_of))
        except (PySparkException, KeyError) as problem:
            log.error("rule %s left out: %s", rule.__name__, problem)
    if not results:
        raise ValueError("no rule could be planned")
    tagged = union_all(results).withColumn("run_id", F.lit(run_id).cast("string"))
    return tagged.withColumn("executed_at", F.lit(at).cast("timestamp")) if at else tagged


def record_suite(t: Tables, as_of: date, path: str, run_id: str | None, at: datetime, rules=RULES) -> int:
    """Append the result of each rule on its own, so that a failing rule loses only its own row."""
    stored = 0
    for rule in rules:
        try:
            suite(t, as_of, run_id, at, (rule,)).write.mode("append").parquet(path)
            stored += 1
        except (PySparkException, ValueError) as problem:
            log.error("rule %s failed: %s", rule.__name__, problem)
    return stored


def alerts_from(results: DataFrame) -> DataFrame:
    """One alert per failed rule; warnings raise none."""
    failed = results.where(F.col("status") == "FAIL")
    return failed.select(
        F.concat(F.lit("DQ-ALERT-"), "test_name").alias("alert_id"),
        F.lit("DATA_QUALITY_FAILURE").alias("alert_type"),
        "severity",
        F.concat(F.lit("Data Quality Assertion Failed: "), "test_name").alias("title"),
        F.col("details").alias("message"),
        F.lit("SYSTEM_TABLE").alias("entity_type"),
        F.col("target_table").alias("entity_id"),
        F.lit("ACTIVE").alias("status"),
    )


def dataset_contracts(t: Tables, as_of: date | None, minimums: Mapping[str, int], years: tuple[int, ...]) -> DataFrame:
    """Row floors, key uniqueness, ranges, domains and covered years of a data set."""
    col = F.col
    rules = [
        row_rules(t["dim_supplier"], "dim_supplier", {
            "range_reliability_rating": ("RANGE", ~col("reliability_rating").between(0, 100)),
            "in_set_tier": ("IN_SET", ~col("tier").isin(*TIERS)),
        }),
        row_rules(t["dim_material"], "dim_material", {
            "positive_standard_cost": ("RANGE", ~(col("standard_cost") > 0)),
            "non_negative_safety_stock": ("RANGE", ~(col("safety_stock_level") >= 0)),
            "reorder_ge_safety": ("ROW_RULE", ~(col("reorder_point") >= col("safety_stock_level"))),
        }),
        row_rules(t["fact_goods_receipts"], "fact_goods_receipts", {
            "non_negative_delivered": ("RANGE", ~(col("quantity_delivered") >= 0)),
            "non_negative_accepted": ("RANGE", ~(col("quantity_accepted") >= 0)),
            "accepted_within_delivered": ("ROW_RULE", ~(col("quantity_accepted") <= col("quantity_delivered"))),
        }),
        covers_years(t["fact_inventory_movements"], "fact_inventory_movements", "movement_date", years),
        duplicate_keys(t, [KeyCheck("dim_supplier", ("supplier_id",)), KeyCheck("dim_material", ("material_id",))]),
        *[minimum_rows(t[name], name, least) for name, least in minimums.items()],
    ]
    return with_status(union_all(rules))


def with_status(violations: DataFrame) -> DataFrame:
    return violations.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


# The declared keys, references and checks of the star schema.
PRIMARY_KEYS = {
    "dim_defect_type": ("defect_type_code",),
    "dim_factory": ("factory_id",),
    "dim_warehouse": ("warehouse_id",),
    "dim_supplier": ("supplier_id",),
    "dim_material": ("material_id",),
    "fact_purchase_orders": ("po_id",),
    "fact_purchase_order_lines": ("po_line_id",),
    "fact_goods_receipts": ("receipt_id",),
    "fact_quality_inspections": ("inspection_id",),
    "fact_inventory_movements": ("movement_id", "movement_date"),
    "fact_production_schedules": ("work_order_id",),
    "fact_bom_allocations": ("allocation_id",),
}
UNIQUE_COLUMNS = {"dim_supplier": ("code",), "dim_material": ("sku",), "fact_purchase_orders": ("po_number",)}
REFERENCES = {
    "dim_warehouse": {"factory_id": ("dim_factory", "factory_id")},
    "dim_material": {
        "primary_supplier_id": ("dim_supplier", "supplier_id"),
        "secondary_supplier_id": ("dim_supplier", "supplier_id"),
    },
    "fact_purchase_orders": {
        "supplier_id": ("dim_supplier", "supplier_id"),
        "factory_id": ("dim_factory", "factory_id"),
        "warehouse_id": ("dim_warehouse", "warehouse_id"),
        "order_date": ("dim_date", "date_key"),
        "promised_delivery_date": ("dim_date", "date_key"),
    },
    "fact_purchase_order_lines": {
        "po_id": ("fact_purchase_orders", "po_id"),
        "material_id": ("dim_material", "material_id"),
    },
    "fact_goods_receipts": {
        "po_id": ("fact_purchase_orders", "po_id"),
        "po_line_id": ("fact_purchase_order_lines", "po_line_id"),
        "supplier_id": ("dim_supplier", "supplier_id"),
        "material_id": ("dim_material", "material_id"),
        "warehouse_id": ("dim_warehouse", "warehouse_id"),
        "factory_id": ("dim_factory", "factory_id"),
        "receipt_date": ("dim_date", "date_key"),
    },
    "fact_quality_inspections": {
        "receipt_id": ("fact_goods_receipts", "receipt_id"),
        "material_id": ("dim_material", "material_id"),
        "supplier_id": ("dim_supplier", "supplier_id"),
        "inspection_date": ("dim_date", "date_key"),
        "defect_type_code": ("dim_defect_type", "defect_type_code"),
    },
    "fact_inventory_movements": {
        "material_id": ("dim_material", "material_id"),
        "warehouse_id": ("dim_warehouse", "warehouse_id"),
        "factory_id": ("dim_factory", "factory_id"),
    },
    "fact_production_schedules": {
        "factory_id": ("dim_factory", "factory_id"),
        "start_date": ("dim_date", "date_key"),
        "end_date": ("dim_date", "date_key"),
    },
    "fact_bom_allocations": {
        "work_order_id": ("fact_production_schedules", "work_order_id"),
        "material_id": ("dim_material", "material_id"),
    },
}
# Tables that exist only in a running deployment; checked when present.
OPERATIONAL_KEYS = {
    "fact_supplier_risk_scores": ("supplier_id", "score_date"),
    "fact_stockout_risk_scores": ("material_id", "score_date"),
    "supply_alerts": ("alert_id",),
    "corrective_actions": ("action_id",),
    "etl_pipeline_audit": ("run_id",),
}
OPERATIONAL_REFERENCES = {
    "fact_supplier_risk_scores": {"supplier_id": ("dim_supplier", "supplier_id")},
    "fact_stockout_risk_scores": {"material_id": ("dim_material", "material_id")},
    "corrective_actions": {"alert_id": ("supply_alerts", "alert_id")},
    "data_quality_test_results": {"run_id": ("etl_pipeline_audit", "run_id")},
}
OPERATIONAL_NOT_NULL = {
    "etl_pipeline_audit": ("pipeline_name", "start_time", "status"),
    "etl_rejected_records": ("pipeline_name", "source_table", "payload", "error_code", "error_reason"),
    "data_quality_test_results": ("test_name", "target_table", "assertion_type", "status", "severity"),
    "fact_supplier_risk_scores": ("risk_score", "risk_tier", "top_contributing_factors", "explanation_text"),
    "fact_stockout_risk_scores": ("stockout_risk_score", "risk_tier", "current_stock", "top_contributing_factors",
                                  "explanation_text"),
    "supply_alerts": ("alert_type", "severity", "title", "message", "entity_type", "entity_id", "status"),
    "corrective_actions": ("title", "description", "assigned_to", "priority", "status"),
}
NOT_NULL = {
    "dim_defect_type": ("name", "severity", "category"),
    "dim_factory": ("name",),
    "dim_warehouse": ("factory_id", "name", "warehouse_type"),
    "dim_supplier": ("code", "name", "category", "country", "city", "tier", "reliability_rating",
                     "financial_health_score", "baseline_lead_time_days"),
    "dim_material": ("sku", "name", "category", "unit_of_measure", "standard_cost", "current_unit_price",
                     "safety_stock_level", "reorder_point", "target_stock_level", "min_order_qty", "lead_time_days"),
    "dim_date": ("year", "quarter", "month", "month_name", "week", "day", "day_name", "is_weekend"),
    "fact_purchase_orders": ("po_number", "supplier_id", "factory_id", "warehouse_id", "order_date",
                             "promised_delivery_date", "status", "total_amount"),
    "fact_purchase_order_lines": ("po_id", "line_number", "material_id", "quantity_ordered", "line_total"),
    "fact_goods_receipts": ("po_id", "po_line_id", "supplier_id", "material_id", "warehouse_id", "factory_id",
                            "receipt_date", "quantity_delivered", "quantity_accepted", "quantity_rejected",
                            "delivery_variance_days"),
    "fact_quality_inspections": ("receipt_id", "material_id", "supplier_id", "inspection_date", "sample_size",
                                 "defect_count", "defect_ppm", "disposition"),
    "fact_inventory_movements": ("material_id", "warehouse_id", "factory_id", "movement_type", "quantity"),
    "fact_production_schedules": ("product_sku", "factory_id", "planned_quantity", "start_date", "end_date", "status",
                                  "priority"),
    "fact_bom_allocations": ("work_order_id", "material_id", "required_quantity", "allocated_quantity",
                             "shortage_quantity"),
}
CHECKS = {
    "fact_purchase_order_lines": {"quantity_ordered": "quantity_ordered > 0"},
    "fact_goods_receipts": {
        "quantity_delivered": "quantity_delivered >= 0",
        "quantity_accepted": "quantity_accepted >= 0",
        "quantity_rejected": "quantity_rejected >= 0",
    },
    "fact_quality_inspections": {
        "sample_size": "sample_size > 0", "defect_count": "defect_count >= 0", "defect_ppm": "defect_ppm >= 0",
    },
    "fact_production_schedules": {"planned_quantity": "planned_quantity > 0"},
    "fact_bom_allocations": {"required_quantity": "required_quantity > 0"},
}


def declared_constraints(t: Tables, calendar: DataFrame) -> DataFrame:
    """Every declared primary key, unique column, reference, NOT NULL and CHECK, with its violations.

    Operational tables are checked as far as ``t`` holds them.
    """
    tables = {**{name: t[name] for name in t}, "dim_date": calendar}
    keys = [KeyCheck(n, c, "PRIMARY_KEY") for n, c in {**PRIMARY_KEYS, "dim_date": ("date_key",)}.items()]
    keys += [KeyCheck(n, c) for n, c in UNIQUE_COLUMNS.items()]
    required = {c.table: c.columns for c in keys if c.kind == "PRIMARY_KEY"}
    checked = _constraints(tables, keys, REFERENCES, required, NOT_NULL, CHECKS)
    if any(n in tables for n in OPERATIONAL_NOT_NULL):
        checked = checked.unionByName(_operational(tables))
    return with_status(checked)


def operational_constraints(t: Tables) -> DataFrame:
    """The constraints of the operational tables that ``t`` holds, with their violations."""
    return with_status(_operational(t))


def _operational(tables: Tables) -> DataFrame:
    def held(declared: dict) -> dict:
        return {n: c for n, c in declared.items() if n in tables}

    keys = [KeyCheck(n, c) for n, c in held(OPERATIONAL_KEYS).items()]
    return _constraints(
        tables, keys, held(OPERATIONAL_REFERENCES), held(OPERATIONAL_KEYS), held(OPERATIONAL_NOT_NULL), {}
    )


def _constraints(
    tables: Tables, keys: list[KeyCheck], references: dict, required: dict, not_null: dict, checks: dict
) -> DataFrame:
    """One plan for the keys, the references and the row rules of all tables.

    ``required`` names the key columns: they must not be null either, as null keys
    do not clash and the key checks pass over them.
    """
    foreign = [
        Reference(child, column, parent, key)
        for child, columns in references.items()
        for column, (parent, key) in columns.items()
        if parent in tables
    ]
    rules = {}
    for name in sorted({*required, *not_null, *checks}):
        columns = (*required.get(name, ()), *not_null.get(name, ()))
        found = {f"nn_{name}_{c}": ("NOT_NULL", F.col(c).isNull()) for c in columns}
        rules[name] = found | {f"ck_{name}_{c}": ("CHECK", ~F.expr(e)) for c, e in checks.get(name, {}).items()}
    return table_checks(tables, keys, foreign, rules)
