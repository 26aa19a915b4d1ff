"""Marts as DuckDB texts."""

from oracle.star import ratio

_SHARE = "CASE WHEN d.n > 0 THEN d.hits::DOUBLE / d.n::DOUBLE ELSE 1.0 END"

PARTS = {
    "sup_deliveries": """
        SELECT supplier_id, count(*) AS n, count(*) FILTER (WHERE delivery_variance_days <= 0) AS hits,
               sum(delivery_variance_days)::BIGINT AS slip,
               sum(delivery_variance_days * delivery_variance_days)::BIGINT AS slip2
        FROM fact_goods_receipts GROUP BY ALL""",
    "sup_quality": """
        SELECT supplier_id, sum(defect_count)::BIGINT AS defects, sum(sample_size)::BIGINT AS samples
        FROM fact_quality_inspections GROUP BY ALL""",
    "sup_spend": """
        SELECT supplier_id, sum(total_amount) AS spend,
               coalesce(sum(total_amount) FILTER (WHERE status = 'OVERDUE'), 0) AS overdue
        FROM fact_purchase_orders GROUP BY ALL""",
    "mart_supplier": f"""
        SELECT s.supplier_id, s.code AS supplier_code, s.name AS supplier_name, s.category AS supplier_category,
               s.country, s.tier, s.reliability_rating AS baseline_reliability, s.financial_health_score,
               coalesce(d.n, 0) AS total_deliveries, coalesce(d.hits, 0) AS on_time_deliveries,
               CASE WHEN d.n > 0 THEN {ratio('d.hits', 'd.n', 2, 100)} ELSE 100.0 END::DOUBLE AS otd_percentage,
               CASE WHEN d.n > 0 THEN {ratio('d.slip', 'd.n', 2)} ELSE 0 END::DOUBLE AS avg_lead_time_variance_days,
               CASE WHEN d.n > 1 THEN round(sqrt((d.n::HUGEINT * d.slip2 - d.slip::HUGEINT * d.slip)::DOUBLE
                    / (d.n::DOUBLE * (d.n - 1))), 2) ELSE 0 END::DOUBLE AS lead_time_variance_std,
               CASE WHEN q.samples > 0 THEN {ratio('q.defects', 'q.samples', 0, 1000000)}
                    ELSE 0 END::DOUBLE AS overall_defect_ppm,
               coalesce(p.spend, 0)::DOUBLE AS total_spend, coalesce(p.overdue, 0)::DOUBLE AS overdue_spend,
               dense_rank() OVER (PARTITION BY s.category ORDER BY {_SHARE} DESC,
                   CASE WHEN q.samples > 0 THEN {ratio('q.defects', 'q.samples', 0, 1000000)} ELSE 0 END)
                   AS category_rank
        FROM dim_supplier s LEFT JOIN sup_deliveries d USING (supplier_id)
             LEFT JOIN sup_quality q USING (supplier_id) LEFT JOIN sup_spend p USING (supplier_id)""",
    "cell_moves": """
        SELECT material_id, warehouse_id, sum(quantity)::BIGINT AS stock,
               coalesce(-sum(quantity) FILTER (WHERE quantity < 0 AND movement_date >= DATE '2001-05-15' - 30), 0)
                   ::BIGINT AS c30,
               coalesce(-sum(quantity) FILTER (WHERE quantity < 0 AND movement_date >= DATE '2001-05-15' - 90), 0)
                   ::BIGINT AS c90
        FROM fact_inventory_movements GROUP BY ALL""",
    "cell_orders": """
        SELECT material_id, warehouse_id, sum(quantity_ordered)::BIGINT AS on_order
        FROM fact_purchase_order_lines JOIN fact_purchase_orders USING (po_id)
        WHERE status IN ('PENDING', 'IN_TRANSIT') GROUP BY ALL""",
    "stock_cells": """
        SELECT m.*, w.warehouse_id, w.name AS warehouse_name, w.factory_id, w.warehouse_type,
               coalesce(v.stock, 0) AS stock, coalesce(v.c30, 0) AS c30, coalesce(v.c90, 0) AS c90,
               coalesce(o.on_order, 0) AS on_order
        FROM dim_material m CROSS JOIN (FROM dim_warehouse WHERE warehouse_type = 'RAW_MATERIALS') w
             LEFT JOIN cell_moves v ON v.material_id = m.material_id AND v.warehouse_id = w.warehouse_id
             LEFT JOIN cell_orders o ON o.material_id = m.material_id AND o.warehouse_id = w.warehouse_id""",
    "mart_inventory": f"""
        SELECT material_id, sku, name AS material_name, category, is_critical, standard_cost::DOUBLE AS standard_cost,
               safety_stock_level::BIGINT AS safety_stock_level, reorder_point::BIGINT AS reorder_point,
               warehouse_id::BIGINT AS warehouse_id, warehouse_name, factory_id::BIGINT AS factory_id,
               stock AS current_stock, (stock::DECIMAL(18,0) * standard_cost)::DOUBLE AS current_stock_valuation,
               c30 AS consumption_last_30d, {ratio('c30', '30', 2)} AS daily_burn_rate,
               CASE WHEN c30 > 0 THEN {ratio('stock', 'c30', 1, 30)} ELSE 999.0 END::DOUBLE AS days_of_inventory,
               on_order AS quantity_on_order,
               CASE WHEN stock <= 0 THEN 'STOCKOUT' WHEN stock < safety_stock_level THEN 'SAFETY_STOCK_BREACH'
                    WHEN stock < reorder_point THEN 'REORDER_TRIGGER'
                    WHEN c30 > 0 AND stock * 30 > 90 * c30 THEN 'OVERSTOCK' ELSE 'HEALTHY' END AS stock_health_status
        FROM stock_cells""",
    "mart_production": """
        SELECT w.work_order_id, w.product_sku, w.factory_id::BIGINT AS factory_id, f.name AS factory_name,
               w.planned_quantity::BIGINT AS planned_quantity, w.start_date::VARCHAR AS start_date,
               w.end_date::VARCHAR AS end_date, w.status AS wo_status, w.priority, b.material_id,
               m.sku AS component_sku, m.name AS component_name, m.is_critical AS is_component_critical,
               b.required_quantity::BIGINT AS required_quantity, b.allocated_quantity::BIGINT AS allocated_quantity,
               b.shortage_quantity::BIGINT AS shortage_quantity, coalesce(n.net, 0)::BIGINT AS total_network_stock,
               (b.required_quantity::DECIMAL(10,0) * m.standard_cost)::DOUBLE AS component_cost_at_risk,
               CASE WHEN b.shortage_quantity > 0 THEN 'CRITICAL_SHORTAGE'
                    WHEN coalesce(n.net, 0) < b.required_quantity THEN 'PROJECTED_SHORTAGE'
                    ELSE 'ALLOCATED' END AS risk_classification
        FROM fact_production_schedules w JOIN dim_factory f USING (factory_id)
             JOIN fact_bom_allocations b USING (work_order_id) JOIN dim_material m USING (material_id)
             LEFT JOIN (SELECT material_id, sum(current_stock) AS net FROM mart_inventory GROUP BY ALL) n
                       USING (material_id)
        WHERE w.status IN ('PLANNED', 'IN_PROGRESS', 'BLOCKED_SHORTAGE')""",
}

QUERIES = {
    "mart_supplier_performance": "SELECT * FROM mart_supplier",
    "mart_inventory_health": "SELECT * FROM mart_inventory",
    "mart_inventory_health_stored": "SELECT * FROM mart_inventory",
    "mart_production_at_risk": "SELECT * FROM mart_production",
}
