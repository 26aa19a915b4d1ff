import json

import pytest
from pyspark.sql import functions as F

from plantline.operators import validation as v

SUPPLIER = {
    "supplier_id": "SUP-1", "code": "VND-1", "name": "Precision Tech", "category": "Machining", "country": "Germany",
    "city": "Stuttgart", "tier": "TIER_1", "reliability_rating": "95.5", "financial_health_score": "88.0",
    "baseline_lead_time_days": "14", "payment_terms": "NET30", "iso_certified": "True", "is_active": "True",
}
MATERIAL = {
    "material_id": "MAT-1", "sku": "SKU-1", "name": "Hydraulic Fluid", "category": "Chemical",
    "unit_of_measure": "LITER", "standard_cost": "25.0", "current_unit_price": "27.5", "safety_stock_level": "100",
    "reorder_point": "150", "target_stock_level": "200", "min_order_qty": "25", "lead_time_days": "14",
    "is_critical": "False", "primary_supplier_id": "SUP-1", "secondary_supplier_id": None,
}
ORDER = {
    "po_id": "PO-1", "po_number": "N-1", "supplier_id": "SUP-1", "factory_id": "F1", "warehouse_id": "W1",
    "order_date": "2025-01-10", "promised_delivery_date": "2025-02-01", "status": "PENDING", "total_amount": "10",
    "currency": "USD",
}
MOVE = {
    "movement_id": "MV-1", "material_id": "MAT-1", "warehouse_id": "W1", "factory_id": "F1",
    "movement_date": "2025-01-10", "movement_type": "GOODS_RECEIPT", "quantity": "5", "reference_doc_type": "PO",
    "reference_doc_id": "PO-1",
}
BASE = {"suppliers": SUPPLIER, "materials": MATERIAL, "purchase_orders": ORDER, "inventory_movements": MOVE}


def batch(spark, entity, *changes, drop=()):
    rows = [{**BASE[entity], **c, "seq": i} for i, c in enumerate(changes)]
    names = [n for n in BASE[entity] if n not in drop]
    schema = ", ".join(f"{n} string" for n in names) + ", seq bigint"
    return spark.createDataFrame([tuple(r[n] for n in [*names, "seq"]) for r in rows], schema)


def outcome(spark, entity, *changes, drop=()):
    rows = v.classify(entity, batch(spark, entity, *changes, drop=drop), "seq").orderBy("seq").collect()
    return [(r.error_code, r.error_reason) for r in rows]


def reason(spark, entity, change, drop=()):
    return outcome(spark, entity, change, drop=drop)[0][1]


def test_valid_supplier(spark):
    accepted, rejected = v.validate("suppliers", batch(spark, "suppliers", {}), "seq", "RUN", "B1")
    row = accepted.first()
    assert (row.reliability_rating, row.baseline_lead_time_days, row.iso_certified) == (95.5, 14, True)
    assert rejected.count() == 0


def test_bad_tier_and_default_flag(spark):
    (code, text), = outcome(spark, "suppliers", {"tier": "TIER_INVALID"}, drop=("is_active",))
    assert code == v.ERR_SCHEMA
    assert text == (
        "tier: Value error, Invalid supplier tier: TIER_INVALID. Expected one of {'TIER_1', 'TIER_2', 'TIER_3'}"
    )
    good = v.classify("suppliers", batch(spark, "suppliers", {}, drop=("is_active",)), "seq")
    assert v.accepted("suppliers", good).first().is_active is True


def test_duplicate_key(spark):
    assert outcome(spark, "suppliers", {}, {"name": "second"}) == [
        (None, None),
        (v.ERR_DUPLICATE, "Duplicate primary business key 'SUP-1' detected in batch."),
    ]


def test_invalid_row_does_not_claim_its_key(spark):
    codes = [c for c, _ in outcome(spark, "suppliers", {"tier": "x"}, {}, {"tier": "x"}, {})]
    assert codes == [v.ERR_SCHEMA, None, v.ERR_DUPLICATE, v.ERR_DUPLICATE]


def test_order_of_input_rows_does_not_matter(spark):
    changes = [{"tier": "x"}, {}, {"supplier_id": "SUP-2"}, {"supplier_id": "SUP-2"}, {}]
    rows = batch(spark, "suppliers", *changes)
    shuffled = rows.orderBy(F.desc("seq")).repartition(3)
    pick = ["seq", "error_code", "error_reason"]
    one = v.classify("suppliers", rows, "seq").select(*pick).orderBy("seq").collect()
    assert one == v.classify("suppliers", shuffled, "seq").select(*pick).orderBy("seq").collect()


def test_reorder_below_safety(spark):
    text = reason(spark, "materials", {"reorder_point": "50"})
    assert text == (
        "reorder_point: Value error, Reorder point (50) must be greater than or equal to safety stock (100)"
    )


def test_reorder_rule_waits_for_valid_safety_stock(spark):
    text = reason(spark, "materials", {"reorder_point": "50", "safety_stock_level": "-1"})
    assert text == "safety_stock_level: Input should be greater than or equal to 0"


@pytest.mark.parametrize(("field", "value", "message"), [
    ("standard_cost", "0", "Input should be greater than 0"),
    ("standard_cost", "abc", v.NOT_A_NUMBER),
    ("standard_cost", None, v.MISSING),
    ("lead_time_days", "14.5", v.NOT_WHOLE),
    ("lead_time_days", "", v.NOT_WHOLE),
    ("is_critical", "maybe", v.NOT_A_FLAG),
])
def test_field_messages(spark, field, value, message):
    assert reason(spark, "materials", {field: value}) == f"{field}: {message}"


@pytest.mark.parametrize("value", ["14.0", " 14 ", "+14", "14."])
def test_lenient_whole_numbers(spark, value):
    assert outcome(spark, "materials", {"lead_time_days": value}) == [(None, None)]


def test_single_source_material_is_valid(spark):
    assert outcome(spark, "materials", {"secondary_supplier_id": None}) == [(None, None)]


def test_errors_follow_field_order(spark):
    text = reason(spark, "suppliers", {"baseline_lead_time_days": "0", "reliability_rating": "120", "name": None})
    assert text == (
        "name: Field required; reliability_rating: Input should be less than or equal to 100; "
        "baseline_lead_time_days: Input should be greater than 0"
    )


@pytest.mark.parametrize(("change", "message"), [
    ({"promised_delivery_date": "2025-01-09"},
     "Promised delivery date (2025-01-09) cannot be before order date (2025-01-10)"),
    ({"promised_delivery_date": "2025-13-01"}, "time data '2025-13-01' does not match format '%Y-%m-%d'"),
    ({"order_date": "10.01.2025"}, "time data '10.01.2025' does not match format '%Y-%m-%d'"),
])
def test_order_dates(spark, change, message):
    assert reason(spark, "purchase_orders", change) == f"promised_delivery_date: Value error, {message}"


def test_order_date_edge_cases(spark):
    assert outcome(spark, "purchase_orders", {"promised_delivery_date": "2025-1-10"}) == [(None, None)]
    assert outcome(spark, "purchase_orders", {"order_date": "", "promised_delivery_date": "?"}) == [(None, None)]
    assert reason(spark, "purchase_orders", {"total_amount": "-1"}) == (
        "total_amount: Input should be greater than or equal to 0"
    )


@pytest.mark.parametrize(("kind", "quantity", "valid"), [
    ("GOODS_RECEIPT", "0", False), ("GOODS_RECEIPT", "1", True), ("PRODUCTION_ISSUE", "0", True),
    ("PRODUCTION_ISSUE", "1", False), ("SCRAP", "-1", True), ("SCRAP", "2", False), ("CYCLE_ADJUSTMENT", "3", True),
    ("TRANSFER_OUT", "-3", True),
])
def test_movement_signs(spark, kind, quantity, valid):
    (code, _), = outcome(spark, "inventory_movements", {"movement_type": kind, "quantity": quantity})
    assert (code is None) == valid


def test_unknown_movement_type_skips_sign_rule(spark):
    text = reason(spark, "inventory_movements", {"movement_type": "RETURN", "quantity": "0"})
    assert text.startswith("movement_type: Value error, Invalid movement type 'RETURN'. Allowed: {'CYCLE_ADJUSTMENT'")
    assert "quantity" not in text


def test_reject_record(spark):
    raw = batch(spark, "purchase_orders", {"total_amount": None})
    _, rejected = v.validate("purchase_orders", raw, "seq", "RUN", "B1")
    row = rejected.first()
    assert (row.pipeline_name, row.batch_id, row.source_table) == ("RUN", "B1", "raw_purchase_orders")
    payload = json.loads(row.payload)
    assert payload["total_amount"] is None and payload["po_id"] == "PO-1" and "seq" not in payload


def test_entity_without_rules_passes_through(spark):
    df = spark.range(3)
    assert v.validate("unknown", df, "id", "RUN") == (df, None)


def test_one_key_in_most_of_the_batch(spark):
    changes = [{"supplier_id": "HOT" if i % 3 else f"S{i}"} for i in range(300)]
    codes = [c for c, _ in outcome(spark, "suppliers", *changes)]
    assert codes.count(v.ERR_DUPLICATE) == 199 and codes.count(None) == 101
