"""Declared constraints of the star schema. Fixed values, held apart from those of the package."""

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
# Tables of a running deployment.
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
