"""Inbound batches with injected faults (FIXTURES.md section 4): text columns plus ``batch_seq``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantline.sources.star import StarSchema

SEQ = "batch_seq"
LATER = 100_000_000


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c) if c == SEQ else F.col(c).cast("string").alias(c) for c in df.columns])


def _repeat(df: DataFrame) -> DataFrame:
    return df.withColumn(SEQ, F.col(SEQ) + LATER)


def raw_purchase_orders(star: StarSchema) -> DataFrame:
    orders = star["fact_purchase_orders"].withColumn(SEQ, F.col("po_id"))
    clean = orders.withColumn("promised_delivery_date", F.date_add("order_date", 20))
    faulty = clean.withColumn(
        "promised_delivery_date",
        F.expr("if(po_id % 53 = 0, date_sub(order_date, 3), promised_delivery_date)"),
    )
    faulty = _as_text(faulty).withColumn(
        "total_amount",
        F.expr(f"case when {SEQ} % 71 = 0 then '-1' when {SEQ} % 89 = 0 then 'n/a' else total_amount end"),
    )
    repeats = _as_text(_repeat(clean.where("po_id % 97 = 0 or po_id % 371 = 0"))).withColumn(
        "total_amount", F.lit("1.00")
    )
    return faulty.unionByName(repeats)


def raw_suppliers(star: StarSchema) -> DataFrame:
    suppliers = star["dim_supplier"].withColumn(SEQ, F.col("supplier_id"))
    faulty = _as_text(suppliers).withColumns({
        "tier": F.expr(f"if({SEQ} % 13 = 5, 'TIER_99', tier)"),
        "reliability_rating": F.expr(f"if({SEQ} % 17 = 3, '120', reliability_rating)"),
        "baseline_lead_time_days": F.expr(f"if({SEQ} % 19 = 4, '0', baseline_lead_time_days)"),
    })
    return faulty.unionByName(_repeat(faulty.where(f"{SEQ} % 7 = 1")))


def raw_materials(star: StarSchema) -> DataFrame:
    materials = star["dim_material"].withColumn(SEQ, F.col("material_id"))
    clean = _as_text(materials)
    faulty = clean.withColumns({
        "reorder_point": F.expr(
            f"if({SEQ} % 41 = 0, cast(cast(safety_stock_level as int) - 1 as string), reorder_point)"
        ),
        "standard_cost": F.expr(f"if({SEQ} % 43 = 0, '0', standard_cost)"),
        "lead_time_days": F.expr(f"if({SEQ} % 47 = 0, 'x', lead_time_days)"),
    })
    return faulty.unionByName(_repeat(faulty.where(f"{SEQ} % 59 = 0"))).unionByName(
        _repeat(clean.where(f"{SEQ} % 82 = 0 and {SEQ} % 59 <> 0"))
    )


def raw_movements(star: StarSchema) -> DataFrame:
    """Faults by order key, which is the leading part of the movement id."""
    order_key = "cast(split_part(movement_id, '-', 1) as bigint)"
    line = "cast(split_part(movement_id, '-', 2) as bigint)"
    moved = star["fact_inventory_movements"].withColumns({
        "_order": F.expr(order_key),
        SEQ: F.expr(f"{order_key} * 10 + {line}"),
        "reference_doc_type": F.lit("ORDER"),
        "reference_doc_id": F.expr(order_key),
    })
    changed = moved.withColumn(
        "quantity",
        F.expr(
            "case when movement_type = 'GOODS_RECEIPT' and _order % 103 = 0 then 0"
            " when movement_type = 'PRODUCTION_ISSUE' and _order % 107 = 0 then 0"
            " when movement_type = 'PRODUCTION_ISSUE' and _order % 109 = 0 then -quantity else quantity end"
        ),
    ).withColumn("movement_type", F.expr("if(_order % 101 = 0, 'RETURN', movement_type)"))
    return _as_text(changed.drop("_order"))


BATCHES = {
    "suppliers": raw_suppliers,
    "materials": raw_materials,
    "purchase_orders": raw_purchase_orders,
    "inventory_movements": raw_movements,
}
