"""Alerts and corrective actions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.functions.exprs import round_half_even
from plantline.operators.merge import unique_rows
from plantline.operators.ordered import running_totals
from plantline.risk.narrative import stockout_text, supplier_text
from plantline.risk.scoring import stockout_predictions, supplier_predictions

# Valuation factors, texts of the first actions.
STOCKOUT_VALUE, SUPPLIER_VALUE = 450.0, 320.0
DUE_DAYS = 7
ACTION_PREFIX = "CA-2026-"
REQUESTS_PER_BLOCK = 4096
LEAD, ENGINEER = "Lead Strategic Procurement Manager", "Senior DI Engineer"
ROOT_CAUSE = "Tier-2 raw material supply bottleneck at regional port facility."
PLAN = (
    "Initiate air freight spot order for 500 units; dual-source qualification pending engineering review."
)
NO_TEXT, NO_TIME = "string", "timestamp_ntz"


def _hours_before(now: datetime, hours: Column) -> Column:
    return F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), hours)


def _numbered(rows: DataFrame, key: str, most: int | None) -> DataFrame:
    """Rows with their number in the order of ``key``, counted by blocks; the first ``most`` of them, or all."""
    if most is not None:
        rows = rows.orderBy(key).limit(most)
    return running_totals(rows, [], F.floor(F.col(key) / REQUESTS_PER_BLOCK), [F.col(key)], {"_n": F.lit(1)})


def seed_alerts(
    suppliers: DataFrame, materials: DataFrame, now: datetime, stock_cap: int | None = None, total_cap: int | None = None
) -> DataFrame:
    """Alerts for critical materials, then for risky suppliers, on one counter.

    ``stock_cap`` limits the first kind, ``total_cap`` the counter; None stands for no limit.
    """
    stock = stockout_predictions(materials).where(F.col("risk_tier") == "CRITICAL")
    stock = _numbered(stock, "material_id", stock_cap)
    risky = supplier_predictions(suppliers).where(F.col("risk_tier").isin("CRITICAL", "HIGH"))
    risky = _numbered(risky, "supplier_id", total_cap).withColumn(
        "_n", F.col("_n") + stock.agg(F.count(F.lit(1))).scalar()
    )

    def row(prefix, kind, severity, title, message, entity, key, impact, hours) -> list[Column]:
        return [
            F.concat(F.lit(prefix), F.lpad(F.col("_n").cast("string"), 4, "0")).alias("alert_id"),
            F.lit(kind).alias("alert_type"),
            severity.alias("severity"),
            title.alias("title"),
            message.alias("message"),
            F.lit(entity).alias("entity_type"),
            F.col(key).cast("string").alias("entity_id"),
            round_half_even(impact, 2).alias("impact_valuation"),
            F.lit("ACTIVE").alias("status"),
            _hours_before(now, (F.col("_n") * hours).cast("int")).alias("created_at"),
            F.lit(None).cast(NO_TIME).alias("resolved_at"),
        ]

    from_stock = stock.select(*row(
        "ALT-STK-", "STOCKOUT", F.lit("CRITICAL"), F.concat(F.lit("Critical Stockout Breach: SKU "), "sku"),
        stockout_text(), "MATERIAL", "material_id", F.col("days_of_inventory") * STOCKOUT_VALUE, 3,
    ))
    from_suppliers = (risky if total_cap is None else risky.where(F.col("_n") <= total_cap)).select(*row(
        "ALT-SUP-", "HIGH_RISK_SUPPLIER", F.col("risk_tier"),
        F.concat(F.lit("Vendor Performance Deterioration: "), "supplier_name"),
        supplier_text(), "SUPPLIER", "supplier_id", F.col("financial_risk_score") * SUPPLIER_VALUE, 2,
    ))
    return from_stock.unionByName(from_suppliers)


def _counter(alert_id: Column) -> Column:
    return F.split_part(alert_id, F.lit("-"), F.lit(-1)).cast("int")


def seed_actions(alerts: DataFrame, now: datetime, count: int | None = None) -> DataFrame:
    """Corrective actions for the first ``count`` alerts by counter, or for all; every other one already in progress."""
    n = _counter(F.col("alert_id"))
    first = alerts.withColumn("_n", n)
    if count is not None:
        first = first.orderBy("_n").limit(count)
    even = F.col("_n") % 2 == 0
    return first.select(
        F.concat(F.lit(ACTION_PREFIX), F.lpad(F.col("_n").cast("string"), 4, "0")).alias("action_id"),
        "alert_id",
        F.concat(F.lit("Mitigation Protocol: "), "title").alias("title"),
        F.concat(
            F.lit("Expedite root-cause analysis and execute alternate supply routing. Alert: "), "message"
        ).alias("description"),
        F.when(even, LEAD).otherwise(ENGINEER).alias("assigned_to"),
        F.col("severity").alias("priority"),
        F.when(even, "IN_PROGRESS").otherwise("OPEN").alias("status"),
        F.when(even, ROOT_CAUSE).alias("root_cause"),
        F.when(even, PLAN).alias("mitigation_plan"),
        F.lit(None).cast(NO_TEXT).alias("resolution_notes"),
        F.date_add(F.lit(now.date()), DUE_DAYS).alias("target_completion_date"),
        "created_at",
        _hours_before(now, (F.col("_n") * 2).cast("int")).alias("updated_at"),
        F.lit(None).cast(NO_TIME).alias("resolved_at"),
    )


def apply_alert_updates(alerts: DataFrame, updates: DataFrame, now: datetime) -> DataFrame:
    """Set the status of the alerts named in ``updates`` (alert_id, status); unknown ids are ignored.

    Every update to RESOLVED stamps the time, also on an alert resolved before.
    """
    changes = unique_rows(updates, ["alert_id"])
    status = F.col("_row.status")
    resolved = F.when(status == "RESOLVED", F.lit(now).cast(NO_TIME)).otherwise(F.col("resolved_at"))
    set_to = {"status": F.coalesce(status, F.col("status")), "resolved_at": resolved}
    return alerts.join(changes, "alert_id", "left").select(
        *[set_to[c].alias(c) if c in set_to else F.col(c) for c in alerts.columns]
    )


def create_actions(actions: DataFrame, requests: DataFrame, now: datetime) -> DataFrame:
    """Open new actions numbered on from the actions there are, in the order of the whole number ``request_id``."""
    block = F.floor(F.col("request_id") / REQUESTS_PER_BLOCK)
    requests = running_totals(requests, [], block, [F.col("request_id")], {"_n": F.lit(1)})
    count = actions.agg(F.count(F.lit(1))).scalar()
    stamp = F.lit(now).cast(NO_TIME)
    given = set(requests.columns)

    def text(name: str) -> Column:
        return F.col(name) if name in given else F.lit(None).cast(NO_TEXT)

    digits = (F.col("_n") + count).cast("string")
    return requests.select(
        F.concat(
            F.lit(ACTION_PREFIX), F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0"))
        ).alias("action_id"),
        text("alert_id").alias("alert_id"),
        "title", "description", "assigned_to",
        F.coalesce(text("priority"), F.lit("HIGH")).alias("priority"),
        F.lit("OPEN").alias("status"),
        text("root_cause").alias("root_cause"),
        text("mitigation_plan").alias("mitigation_plan"),
        F.lit(None).cast(NO_TEXT).alias("resolution_notes"),
        text("target_completion_date").cast("date").alias("target_completion_date"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
        F.lit(None).cast(NO_TIME).alias("resolved_at"),
    )


def apply_action_updates(actions: DataFrame, updates: DataFrame, now: datetime) -> DataFrame:
    """Overwrite with the non-null fields of ``updates``; RESOLVED stamps ``resolved_at`` once."""
    fields = [c for c in updates.columns if c != "action_id"]
    changes = unique_rows(updates, ["action_id"])
    stamp = F.lit(now).cast(NO_TIME)
    given = F.col("_row").isNotNull()
    value = {c: F.coalesce(F.col(f"_row.{c}").cast(actions.schema[c].dataType), F.col(c)) for c in fields}
    status = value.get("status", F.col("status"))
    value["updated_at"] = F.when(given, stamp).otherwise(F.col("updated_at"))
    value["resolved_at"] = F.when(
        given & (status == "RESOLVED") & F.col("resolved_at").isNull(), stamp
    ).otherwise(value.get("resolved_at", F.col("resolved_at")))
    return actions.join(changes, "action_id", "left").select(
        *[value[c].alias(c) if c in value else F.col(c) for c in actions.columns]
    )


def scoring_alerts(suppliers: DataFrame, materials: DataFrame, day: date) -> DataFrame:
    """Alerts of a daily scoring run, one per risky supplier and per critical material."""
    suffix = F.lit(f"-{day:%Y-%m-%d}")
    risky = supplier_predictions(suppliers).where(F.col("risk_tier").isin("CRITICAL", "HIGH")).select(
        F.concat(F.lit("ALT-SUP-"), F.col("supplier_id").cast("string"), suffix).alias("alert_id"),
        F.lit("HIGH_RISK_SUPPLIER").alias("alert_type"),
        F.col("risk_tier").alias("severity"),
        F.concat(F.lit("Supplier Risk Alert: "), "supplier_name", F.lit(" ("), "risk_tier", F.lit(")")).alias("title"),
        supplier_text().alias("message"),
        F.lit("SUPPLIER").alias("entity_type"),
        F.col("supplier_id").cast("string").alias("entity_id"),
        F.lit("ACTIVE").alias("status"),
    )
    out = stockout_predictions(materials).where(F.col("risk_tier") == "CRITICAL").select(
        F.concat(F.lit("ALT-MAT-"), F.col("material_id").cast("string"), suffix).alias("alert_id"),
        F.lit("STOCKOUT").alias("alert_type"),
        F.lit("CRITICAL").alias("severity"),
        F.concat(F.lit("Critical Stockout Alert: "), "sku").alias("title"),
        stockout_text().alias("message"),
        F.lit("MATERIAL").alias("entity_type"),
        F.col("material_id").cast("string").alias("entity_id"),
        F.lit("ACTIVE").alias("status"),
    )
    return risky.unionByName(out)


def supplier_score_rows(suppliers: DataFrame, day: date) -> DataFrame:
    """Rows of the supplier score table; factors are stored as JSON."""
    return supplier_predictions(suppliers).select(
        "supplier_id", F.lit(day).alias("score_date"), "risk_score", "risk_tier", "otd_rate_90d", "defect_ppm_90d",
        "lead_time_variance_avg", "financial_risk_score", "single_source_material_count",
        F.to_json("top_contributing_factors").alias("top_contributing_factors"),
        supplier_text().alias("explanation_text"),
    )


def stockout_score_rows(materials: DataFrame, day: date) -> DataFrame:
    """Rows of the stockout score table; trend factor and open orders are constants."""
    return stockout_predictions(materials).select(
        "material_id", F.lit(day).alias("score_date"), "stockout_risk_score", "risk_tier", "current_stock",
        "days_of_inventory", "safety_stock_ratio", F.lit(1.0).alias("consumption_trend_factor"),
        F.lit(1).alias("open_po_count"), F.to_json("top_contributing_factors").alias("top_contributing_factors"),
        stockout_text().alias("explanation_text"),
    )
