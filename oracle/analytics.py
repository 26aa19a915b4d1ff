"""Trends, turnover, delays, shortages and the slow/fast pairs as DuckDB texts."""

from oracle.star import ratio

_MONTHS = "PARTITION BY supplier_id ORDER BY delivery_month"
_CELL = "PARTITION BY material_id, warehouse_id ORDER BY movement_date, movement_id, quantity"

PARTS = {
    "supplier_months": f"""
        SELECT supplier_id, name AS supplier_name, category, delivery_month,
               {ratio('hits', 'n', 0, 10000)}::BIGINT AS points, {ratio('slip', 'n', 2)} AS avg_slip,
               bad::DOUBLE / nullif(good, 0)::DOUBLE * 1000000.0 AS ppm
        FROM (SELECT supplier_id, date_trunc('month', receipt_date)::DATE AS delivery_month, count(*) AS n,
                     count(*) FILTER (WHERE delivery_variance_days <= 0) AS hits,
                     sum(delivery_variance_days)::BIGINT AS slip, sum(quantity_rejected)::BIGINT AS bad,
                     sum(quantity_delivered)::BIGINT AS good
              FROM fact_goods_receipts GROUP BY ALL) JOIN dim_supplier USING (supplier_id)""",
    "supplier_rolling": f"""
        SELECT *, lag(points) OVER ({_MONTHS}) AS prior_points, lead(avg_slip) OVER ({_MONTHS}) AS next_slip,
               (sum(points) OVER ({_MONTHS} ROWS 2 PRECEDING))::BIGINT AS sum3,
               count(points) OVER ({_MONTHS} ROWS 2 PRECEDING) AS n3,
               avg(ppm) OVER ({_MONTHS} ROWS 2 PRECEDING) AS ppm3
        FROM supplier_months""",
    "supplier_ranked": f"""
        SELECT *, {ratio('sum3', '(n3 * 100)', 2)} AS rolling_pct, round(ppm3, 0) AS rolling_ppm,
               dense_rank() OVER (PARTITION BY category, delivery_month
                                  ORDER BY sum3::DOUBLE / (n3 * 100)::DOUBLE DESC) AS category_rank
        FROM supplier_rolling""",
    "late_orders": """
        SELECT *, DATE '2001-05-15' - promised_delivery_date AS late FROM fact_purchase_orders
        WHERE status = 'OVERDUE' OR (status = 'IN_TRANSIT' AND promised_delivery_date < DATE '2001-05-15')""",
    "cell_balances": f"""
        SELECT material_id, warehouse_id::BIGINT AS warehouse_id, movement_date::VARCHAR AS movement_date,
               movement_id, quantity::BIGINT AS quantity,
               (sum(quantity) OVER ({_CELL} ROWS UNBOUNDED PRECEDING))::BIGINT AS running_balance,
               (sum(-quantity) FILTER (WHERE quantity < 0) OVER ({_CELL} ROWS 30 PRECEDING))::DOUBLE
                 / (count(*) FILTER (WHERE quantity < 0) OVER ({_CELL} ROWS 30 PRECEDING))::DOUBLE
                   AS rolling_30d_burn_rate
        FROM fact_inventory_movements""",
    "material_42": f"""
        SELECT material_id, warehouse_id::BIGINT AS warehouse_id, movement_date::VARCHAR AS movement_date,
               movement_id, quantity::BIGINT AS quantity,
               (sum(quantity) OVER ({_CELL} ROWS UNBOUNDED PRECEDING))::BIGINT AS running_balance,
               avg(CASE WHEN quantity < 0 THEN -quantity END) OVER ({_CELL} ROWS 30 PRECEDING)
                   AS rolling_30d_burn_rate
        FROM fact_inventory_movements WHERE material_id = 42 AND movement_date >= DATE '2000-10-01'""",
}

QUERIES = {
    "window_lag_otd": """
        SELECT supplier_id, delivery_month::VARCHAR AS delivery_month, points / 100.0::DOUBLE AS monthly_otd_pct,
               prior_points / 100.0::DOUBLE AS prior_month_otd_pct FROM supplier_rolling""",
    "window_lead_variance": """
        SELECT supplier_id, delivery_month::VARCHAR AS delivery_month, avg_slip AS avg_variance_days,
               next_slip AS next_month_variance_days FROM supplier_rolling""",
    "window_rolling_3m": """
        SELECT supplier_id, delivery_month::VARCHAR AS delivery_month, rolling_pct AS rolling_3m_otd_pct,
               rolling_ppm AS rolling_3m_defect_ppm FROM supplier_ranked""",
    "window_rank_monthly": """
        SELECT supplier_id, category, delivery_month::VARCHAR AS delivery_month, rolling_pct AS rolling_3m_otd_pct,
               category_rank FROM supplier_ranked""",
    "window_rank_category": """
        SELECT supplier_id, supplier_category, otd_percentage, overall_defect_ppm, category_rank
        FROM mart_supplier""",
    "window_running_balance": """
        SELECT material_id, warehouse_id, movement_date, movement_id, quantity, running_balance FROM cell_balances""",
    "window_rolling_burn": """
        SELECT material_id, warehouse_id, movement_date, movement_id, quantity,
               CASE WHEN isfinite(rolling_30d_burn_rate) THEN rolling_30d_burn_rate END AS rolling_30d_burn_rate
        FROM cell_balances""",
    "q1_supplier_trajectory": """
        SELECT supplier_id, supplier_name, category, delivery_month::VARCHAR AS delivery_month,
               points / 100.0::DOUBLE AS monthly_otd_pct, prior_points / 100.0::DOUBLE AS prior_month_otd_pct,
               (points - prior_points) / 100.0::DOUBLE AS otd_mom_change_pct, rolling_pct AS rolling_3m_otd_pct,
               rolling_ppm AS rolling_3m_defect_ppm, category_rank,
               CASE WHEN points - prior_points < -1000 THEN 'SEVERE_DEGRADATION'
                    WHEN points - prior_points < -500 THEN 'MODERATE_DEGRADATION'
                    WHEN points - prior_points > 500 THEN 'SIGNIFICANT_IMPROVEMENT'
                    ELSE 'STABLE' END AS performance_trajectory
        FROM supplier_ranked""",
    "q2_inventory_turnover": f"""
        SELECT material_id, sku, name AS material_name, category, is_critical, standard_cost::DOUBLE AS standard_cost,
               warehouse_id::BIGINT AS warehouse_id, warehouse_name, warehouse_type, stock AS on_hand_units,
               (stock::DECIMAL(18,0) * standard_cost)::DOUBLE AS total_inventory_value_usd,
               safety_stock_level::BIGINT AS safety_stock_level, reorder_point::BIGINT AS reorder_point,
               {ratio('c90', '90', 2)} AS avg_daily_burn_rate,
               CASE WHEN c90 > 0 THEN {ratio('stock', 'c90', 1, 90)} ELSE 999.0 END::DOUBLE AS days_of_inventory,
               CASE WHEN stock > 0 AND standard_cost > 0 THEN {ratio('c90', '(stock * 90)', 2, 365)}
                    ELSE 0 END::DOUBLE AS inventory_turnover_ratio,
               CASE WHEN stock <= 0 THEN 'OUT_OF_STOCK' WHEN stock < safety_stock_level THEN 'CRITICAL_SAFETY_BREACH'
                    WHEN stock < reorder_point THEN 'REORDER_RECOMMENDED'
                    WHEN c90 > 0 AND stock > c90 THEN 'EXCESS_INVENTORY' ELSE 'OPTIMAL' END AS safety_stock_status
        FROM stock_cells""",
    "q3_delayed_po_impact": f"""
        WITH delay_lines AS (
            SELECT o.po_id, o.supplier_id, o.total_amount, o.late, count(*) FILTER (WHERE m.is_critical) AS crit
            FROM late_orders o JOIN fact_purchase_order_lines l USING (po_id) JOIN dim_material m USING (material_id)
            GROUP BY ALL)
        SELECT s.name AS supplier_name, s.category AS supplier_category, s.reliability_rating,
               count(*) AS total_delayed_pos, sum(total_amount)::DOUBLE AS total_delayed_value_usd,
               {ratio('sum(late)', 'count(*)', 1)} AS avg_days_overdue, max(late)::BIGINT AS max_days_overdue,
               sum(crit)::BIGINT AS total_critical_lines_impacted,
               coalesce(sum(total_amount) FILTER (WHERE late <= 7), 0)::DOUBLE AS value_overdue_1_7_days,
               coalesce(sum(total_amount) FILTER (WHERE late BETWEEN 8 AND 14), 0)::DOUBLE AS value_overdue_8_14_days,
               coalesce(sum(total_amount) FILTER (WHERE late > 14), 0)::DOUBLE AS value_overdue_gt_14_days,
               CASE WHEN sum(crit) = 0 THEN 'STANDARD_LOGISTICS_DELAY' WHEN avg(late) > 10
                    THEN 'URGENT_PRODUCTION_HALT_RISK' ELSE 'ELEVATED_SCHEDULE_RISK' END AS delay_severity_tier
        FROM delay_lines JOIN dim_supplier s USING (supplier_id) GROUP BY ALL""",
    "q4_bom_production_risk": """
        WITH short_orders AS (
            SELECT work_order_id, count(*) AS n, sum(shortage_quantity)::BIGINT AS units,
                   sum(shortage_quantity::DECIMAL(10,0) * standard_cost)::DOUBLE AS cost
            FROM fact_bom_allocations JOIN dim_material USING (material_id) WHERE shortage_quantity > 0 GROUP BY ALL)
        SELECT w.work_order_id, w.product_sku, f.name AS factory_name, w.start_date::VARCHAR AS start_date,
               w.end_date::VARCHAR AS end_date, w.planned_quantity::BIGINT AS planned_quantity,
               w.status AS work_order_status, w.priority, coalesce(n, 0) AS shortage_components_count,
               coalesce(units, 0) AS total_shortage_units, coalesce(cost, 0)::DOUBLE AS material_cost_shortfall_usd,
               (w.planned_quantity * 2500)::DOUBLE AS finished_goods_value_at_risk,
               CASE WHEN n IS NULL THEN 'ON_SCHEDULE' WHEN w.priority = 'CRITICAL' THEN 'CRITICAL_LINE_DOWN'
                    ELSE 'SCHEDULE_COMPROMISED' END AS operational_impact_status
        FROM fact_production_schedules w JOIN dim_factory f USING (factory_id)
             LEFT JOIN short_orders USING (work_order_id)
        WHERE w.status IN ('PLANNED', 'IN_PROGRESS', 'BLOCKED_SHORTAGE')""",
    "b1_running_balance_formatted": "SELECT * FROM material_42",
    "b1_running_balance": "SELECT * FROM material_42",
    "b2_scorecard_correlated": """
        SELECT supplier_id, name, category,
               (SELECT count(*) FROM fact_goods_receipts r WHERE r.supplier_id = s.supplier_id
                  AND r.receipt_date >= DATE '1999-01-01') AS total_receipts,
               (SELECT count(*) FROM fact_goods_receipts r WHERE r.supplier_id = s.supplier_id
                  AND r.receipt_date >= DATE '1999-01-01' AND r.delivery_variance_days <= 0) AS on_time_receipts,
               round((SELECT avg(delivery_variance_days) FROM fact_goods_receipts r
                  WHERE r.supplier_id = s.supplier_id AND r.receipt_date >= DATE '1999-01-01'), 6) AS avg_delay_days,
               (SELECT sum(total_amount)::DOUBLE FROM fact_purchase_orders p WHERE p.supplier_id = s.supplier_id
                  AND p.status = 'OVERDUE') AS overdue_po_amount
        FROM dim_supplier s WHERE is_active""",
    "b2_scorecard": f"""
        WITH seen AS (
            SELECT supplier_id, count(*) AS n, count(*) FILTER (WHERE delivery_variance_days <= 0) AS hits,
                   sum(delivery_variance_days)::BIGINT AS slip
            FROM fact_goods_receipts WHERE receipt_date >= DATE '1999-01-01' GROUP BY ALL)
        SELECT s.supplier_id, s.name, s.category, coalesce(n, 0) AS total_receipts,
               coalesce(hits, 0) AS on_time_receipts,
               CASE WHEN n > 0 THEN {ratio('hits', 'n', 2, 100)} ELSE 100 END::DOUBLE AS otd_pct,
               CASE WHEN n > 0 THEN {ratio('slip', 'n', 2)} ELSE 0 END::DOUBLE AS avg_delay_days,
               coalesce(o.amount, 0)::DOUBLE AS overdue_po_amount
        FROM dim_supplier s LEFT JOIN seen USING (supplier_id)
             LEFT JOIN (SELECT supplier_id, sum(total_amount) AS amount FROM fact_purchase_orders
                        WHERE status = 'OVERDUE' GROUP BY ALL) o USING (supplier_id)
        WHERE s.is_active""",
    "b3_bom_shortage_correlated": """
        SELECT w.work_order_id, w.product_sku, w.priority, b.material_id, m.name AS material_name,
               b.required_quantity::BIGINT AS required_quantity,
               coalesce(n.net, 0)::BIGINT AS network_stock_on_hand,
               (b.required_quantity::DECIMAL(10,0) * m.standard_cost)::DOUBLE AS line_value_usd
        FROM fact_production_schedules w JOIN fact_bom_allocations b USING (work_order_id)
             JOIN dim_material m USING (material_id)
             LEFT JOIN (SELECT material_id, sum(quantity) AS net FROM fact_inventory_movements GROUP BY ALL) n
                       USING (material_id)
        WHERE w.status IN ('PLANNED', 'BLOCKED_SHORTAGE') AND b.shortage_quantity > 0""",
    "b3_bom_shortage_mart": """
        SELECT work_order_id, product_sku, priority, material_id, component_name, required_quantity,
               total_network_stock AS network_stock_on_hand, component_cost_at_risk AS line_value_usd,
               risk_classification
        FROM mart_production WHERE risk_classification = 'CRITICAL_SHORTAGE'""",
}
