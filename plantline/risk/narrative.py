"""Prediction records as sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plantline.functions.exprs import fixed_text, grouped_text, plain_text

# Factor labels and advice texts.
LABELS = {
    "otd_rate_90d": "On-Time Delivery Degradation",
    "avg_variance_days": "Excess Delivery Delay Variance",
    "std_variance_days": "Lead-Time Volatility",
    "defect_ppm_90d": "Elevated Defect PPM Rate",
    "financial_risk_score": "Supplier Financial Distress",
    "single_source_count": "Single-Source Material Bottleneck",
    "overdue_po_count": "Overdue PO Order Backlog",
    "days_of_inventory": "Depleted Days of Inventory (DOI)",
    "safety_stock_ratio": "Safety Stock Threshold Breach",
    "is_critical": "Critical Path BOM Component",
    "total_shortage_units": "Active Work Order Shortage",
}
SUPPLIER_ADVICE = {
    "CRITICAL": "IMMEDIATE MITIGATION: Dual-source critical parts immediately, enforce mandatory lot quality "
    "inspections, and issue formal supplier corrective action request (SCAR).",
    "HIGH": "RECOMMENDED ACTION: Expedite buffer stock orders, increase incoming QC sample rates, and schedule "
    "operational review with vendor leadership.",
    "MEDIUM": "MONITOR: Track next 3 inbound shipments for lead-time stabilization and verify quality certs.",
    "LOW": "MAINTAIN: Supplier operating within acceptable tolerances. Eligible for preferred vendor rebate tiers.",
}
NO_DRIVER = "Standard historical baseline"
URGENT_RESTOCK = "Trigger emergency spot-buy purchase order and resequence scheduled factory work orders."
PLANNED_RESTOCK = "Initiate planned reorder replenishment through standard procurement channels."
NO_CONDITION = "inventory levels tracking near reorder trigger"


def label_of(feature: Column) -> Column:
    pairs = [F.lit(part) for item in LABELS.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), feature), feature)


def _driver(factor: Column, index: Column) -> Column:
    feature, value = factor["feature"], factor["raw_value"]
    detail = (
        F.when(feature == "otd_rate_90d", F.concat(F.lit("current OTD at "), fixed_text(value, 1), F.lit("%")))
        .when(feature == "defect_ppm_90d", F.concat(F.lit("defect rate at "), grouped_text(value), F.lit(" PPM")))
        .when(
            feature == "avg_variance_days",
            F.concat(F.lit("average delivery slip +"), fixed_text(value, 1), F.lit(" days")),
        )
        .when(
            feature == "single_source_count",
            F.concat(F.lit("exclusive supplier for "), value.cast("bigint").cast("string"), F.lit(" critical SKUs")),
        )
        .otherwise(F.concat(F.lit("metric value "), plain_text(value, 2)))
    )
    return F.concat(
        F.lit("("), (index + 1).cast("string"), F.lit(") "), label_of(feature), F.lit(" ("),
        fixed_text(factor["impact_percentage"], 0), F.lit("% contribution; "), detail, F.lit(")"),
    )


def supplier_text() -> Column:
    """Sentence over the columns of a supplier prediction record."""
    drivers = F.array_join(F.transform(F.slice("top_contributing_factors", 1, 3), _driver), "; ")
    advice = F.when(F.lit(False), "")
    for tier, text in SUPPLIER_ADVICE.items():
        advice = advice.when(F.col("risk_tier") == tier, text)
    return F.concat(
        F.col("risk_tier"), F.lit(" RISK (Score: "), plain_text(F.col("risk_score"), 1), F.lit("/100) for "),
        F.coalesce("supplier_name", F.col("supplier_id").cast("string")), F.lit(". Primary disruption drivers: "),
        F.when(drivers == "", NO_DRIVER).otherwise(drivers), F.lit(". "), advice,
    )


def stockout_text() -> Column:
    """Sentence over the columns of a stockout prediction record."""
    doi, safety, short = F.col("days_of_inventory"), F.col("safety_stock_ratio"), F.col("total_shortage_units")
    conditions = F.array_compact(F.array(
        F.when(
            doi < 7,
            F.concat(F.lit("critically low inventory covering only "), fixed_text(doi, 1),
                     F.lit(" days of production")),
        ).when(
            doi < 15,
            F.concat(F.lit("below-target buffer with "), fixed_text(doi, 1), F.lit(" days of inventory remaining")),
        ),
        F.when(
            safety < 0.5,
            F.concat(F.lit("operating at "), fixed_text(safety * 100.0, 0), F.lit("% of minimum safety threshold")),
        ),
        F.when(
            short > 0,
            F.concat(F.format_number(short, 0), F.lit(" units already short across active production schedules")),
        ),
    ))
    joined = F.array_join(conditions, ", ")
    action = F.when(F.col("risk_tier").isin("CRITICAL", "HIGH"), URGENT_RESTOCK).otherwise(PLANNED_RESTOCK)
    return F.concat(
        F.col("risk_tier"), F.lit(" STOCKOUT RISK (Score: "), plain_text(F.col("stockout_risk_score"), 1),
        F.lit("/100) on SKU "), F.coalesce("sku", F.col("material_id").cast("string")), F.lit(". Condition: "),
        F.when(joined == "", NO_CONDITION).otherwise(joined), F.lit(". Action: "), action,
    )
