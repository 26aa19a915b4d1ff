"""Dashboard charts as DuckDB texts."""

from oracle.star import ratio

PARTS: dict[str, str] = {}

QUERIES = {
    "chart_global_otd": f"""
        SELECT sum(total_deliveries)::BIGINT AS total_deliveries, sum(on_time_deliveries)::BIGINT AS on_time_deliveries,
               {ratio('sum(on_time_deliveries)', 'sum(total_deliveries)', 2, 100)} AS otd_pct FROM mart_supplier""",
    "chart_overdue_spend": """
        SELECT coalesce(sum(overdue), 0)::DOUBLE AS overdue_spend FROM sup_spend JOIN dim_supplier USING (supplier_id)""",
    "chart_stockout_breach": """
        SELECT stock_health_status, count(*) AS cells FROM mart_inventory
        WHERE stock_health_status IN ('STOCKOUT', 'SAFETY_STOCK_BREACH') GROUP BY ALL""",
    "chart_monthly_otd": f"""
        SELECT date_trunc('month', receipt_date)::DATE::VARCHAR AS delivery_month, count(*) AS deliveries,
               {ratio('(count(*) FILTER (WHERE delivery_variance_days <= 0))', 'count(*)', 2, 100)} AS otd_pct
        FROM fact_goods_receipts GROUP BY 1""",
    "chart_high_risk_suppliers": """
        SELECT supplier_id, supplier_name, supplier_category, otd_percentage, overall_defect_ppm FROM mart_supplier
        ORDER BY otd_percentage, overall_defect_ppm DESC, supplier_id LIMIT 20""",
    "chart_otd_vs_ppm": """
        SELECT supplier_id, supplier_name, otd_percentage, overall_defect_ppm, total_spend FROM mart_supplier""",
    "chart_lead_time_variance": "SELECT supplier_id, supplier_name, avg_lead_time_variance_days FROM mart_supplier",
    "chart_spend_by_category": """
        SELECT s.category AS supplier_category, coalesce(sum(p.spend), 0)::DOUBLE AS total_spend
        FROM dim_supplier s LEFT JOIN sup_spend p USING (supplier_id) GROUP BY ALL""",
    "chart_scorecard_ledger": "SELECT * EXCLUDE (on_time_deliveries) FROM mart_supplier",
    "chart_doi_by_category": f"""
        SELECT category, sum(current_stock)::BIGINT AS stock, sum(consumption_last_30d)::BIGINT AS consumed,
               CASE WHEN sum(consumption_last_30d) > 0
                    THEN {ratio('sum(current_stock)', 'sum(consumption_last_30d)', 1, 30)} END AS days_of_inventory
        FROM mart_inventory GROUP BY ALL""",
    "chart_stock_health": "SELECT stock_health_status, count(*) AS cells FROM mart_inventory GROUP BY ALL",
    "chart_warehouse_valuation": """
        SELECT warehouse_id::BIGINT AS warehouse_id, warehouse_name, category,
               sum(stock::DECIMAL(18,0) * standard_cost)::DOUBLE AS valuation FROM stock_cells GROUP BY ALL""",
    "chart_critical_below_safety": """
        SELECT material_id, sku, warehouse_name, current_stock, safety_stock_level, stock_health_status
        FROM mart_inventory WHERE is_critical AND stock_health_status IN ('STOCKOUT', 'SAFETY_STOCK_BREACH')""",
    "chart_po_aging": """
        SELECT CASE WHEN late <= 7 THEN '1-7d' WHEN late <= 14 THEN '8-14d' ELSE '>14d' END AS aging_bracket,
               count(*) AS orders, sum(total_amount)::DOUBLE AS total_value FROM late_orders GROUP BY ALL""",
    "chart_delayed_by_factory": """
        SELECT factory_id::BIGINT AS factory_id, f.name AS factory_name, count(*) AS orders,
               sum(total_amount)::DOUBLE AS total_value
        FROM late_orders JOIN dim_factory f USING (factory_id) GROUP BY ALL""",
    "chart_delayed_tracker": """
        SELECT po_id, po_number, s.name AS supplier_name, status,
               promised_delivery_date::VARCHAR AS promised_delivery_date, total_amount::DOUBLE AS total_amount,
               late::BIGINT AS days_overdue
        FROM late_orders JOIN dim_supplier s USING (supplier_id)""",
    "chart_inspection_outcomes": f"""
        SELECT disposition, count(*) AS inspections,
               {ratio('count(*)', '(SELECT count(*) FROM fact_quality_inspections)', 2, 100)} AS share_pct
        FROM fact_quality_inspections GROUP BY disposition""",
    "chart_defect_pareto": f"""
        WITH code_sums AS (SELECT defect_type_code, sum(defect_count)::BIGINT AS defects
                           FROM fact_quality_inspections WHERE defect_type_code IS NOT NULL GROUP BY ALL),
             code_runs AS (SELECT *, (sum(defects) OVER (ORDER BY defects DESC, defect_type_code
                                      ROWS UNBOUNDED PRECEDING))::BIGINT AS run,
                                  (sum(defects) OVER ())::BIGINT AS whole FROM code_sums)
        SELECT defect_type_code, defects, {ratio('run', 'whole', 2, 100)} AS cumulative_pct FROM code_runs""",
    "chart_top_ppm_materials": f"""
        SELECT material_id, sku, defects, samples, {ratio('defects', 'samples', 0, 1000000)} AS defect_ppm
        FROM (SELECT material_id, sum(defect_count)::BIGINT AS defects, sum(sample_size)::BIGINT AS samples
              FROM fact_quality_inspections GROUP BY ALL) JOIN dim_material USING (material_id)
        ORDER BY defect_ppm DESC, material_id LIMIT 20""",
    "chart_fg_value_at_risk": """
        SELECT count(*) AS work_orders, (coalesce(sum(planned), 0) * 2500)::DOUBLE AS value_at_risk
        FROM (SELECT work_order_id, max(planned_quantity) AS planned FROM mart_production
              WHERE risk_classification <> 'ALLOCATED' GROUP BY ALL)""",
    "chart_wo_by_risk": """
        SELECT risk_classification, count(DISTINCT work_order_id) AS work_orders FROM mart_production GROUP BY ALL""",
    "chart_bom_shortage_matrix": """
        SELECT work_order_id, product_sku, factory_name, priority, material_id, component_sku, required_quantity,
               shortage_quantity, total_network_stock, component_cost_at_risk, risk_classification
        FROM mart_production WHERE risk_classification <> 'ALLOCATED'""",
}
