"""Column types of the entity files and of the operational tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(text: str) -> T.StructType:
    return T.StructType.fromDDL(text) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(text)


# File layouts, columns in file order.
ENTITY_FILES: dict[str, str] = {
    "suppliers": "supplier_id string, name string, code string, category string, country string, city string, "
    "tier string, reliability_rating double, financial_health_score double, baseline_lead_time_days int, "
    "payment_terms string, iso_certified boolean, is_active boolean, created_at timestamp",
    "materials": "material_id string, sku string, name string, category string, unit_of_measure string, "
    "standard_cost decimal(12,2), current_unit_price decimal(12,2), safety_stock_level int, reorder_point int, "
    "target_stock_level int, min_order_qty int, lead_time_days int, is_critical boolean, "
    "primary_supplier_id string, secondary_supplier_id string, created_at timestamp",
    "factories": "factory_id string, name string, country string, region string",
    "warehouses": "warehouse_id string, factory_id string, name string, warehouse_type string, capacity_sqm int",
    "defect_types": "defect_type_code string, name string, severity string, category string",
    "purchase_orders": "po_id string, po_number string, supplier_id string, factory_id string, "
    "warehouse_id string, order_date date, promised_delivery_date date, status string, "
    "total_amount decimal(14,2), currency string, created_at timestamp",
    "purchase_order_lines": "po_line_id string, po_id string, line_number int, material_id string, "
    "quantity_ordered int, unit_price decimal(12,2), line_total decimal(14,2), line_status string",
    "goods_receipts": "receipt_id string, po_id string, po_line_id string, supplier_id string, material_id string, "
    "warehouse_id string, factory_id string, receipt_date date, quantity_delivered int, quantity_accepted int, "
    "quantity_rejected int, delivery_variance_days int, damage_detected boolean, created_at timestamp",
    "quality_inspections": "inspection_id string, receipt_id string, material_id string, supplier_id string, "
    "inspection_date date, sample_size int, defect_count int, defect_ppm int, defect_type_code string, "
    "disposition string, inspector_id string",
    "inventory_movements": "movement_id string, material_id string, warehouse_id string, factory_id string, "
    "movement_date date, movement_type string, quantity int, reference_doc_type string, reference_doc_id string",
    "production_schedules": "work_order_id string, product_sku string, factory_id string, planned_quantity int, "
    "completed_quantity int, start_date date, end_date date, status string, priority string",
    "bom_allocations": "allocation_id string, work_order_id string, material_id string, required_quantity int, "
    "allocated_quantity int, shortage_quantity int",
}

# Entity file -> star table.
STAR_TABLE = {
    "suppliers": "dim_supplier",
    "materials": "dim_material",
    "factories": "dim_factory",
    "warehouses": "dim_warehouse",
    "defect_types": "dim_defect_type",
    "purchase_orders": "fact_purchase_orders",
    "purchase_order_lines": "fact_purchase_order_lines",
    "goods_receipts": "fact_goods_receipts",
    "quality_inspections": "fact_quality_inspections",
    "inventory_movements": "fact_inventory_movements",
    "production_schedules": "fact_production_schedules",
    "bom_allocations": "fact_bom_allocations",
}

AUDIT = (
    "run_id string, pipeline_name string, batch_id string, start_time timestamp, end_time timestamp, "
    "duration_seconds decimal(10,2), rows_extracted bigint, rows_loaded bigint, rows_rejected bigint, "
    "status string, error_message string"
)
RUN_RESULT = (
    "run_id string, end_time timestamp, status string, rows_extracted bigint, rows_loaded bigint, "
    "rows_rejected bigint, error_message string"
)


def entity(name: str) -> T.StructType:
    return _struct(ENTITY_FILES[name])
