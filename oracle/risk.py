"""Features, scores, narratives, evaluation, lists and incidents as DuckDB texts."""

from oracle.texts import LABELS, SUPPLIER_ADVICE


def py1(x: str) -> str:
    return f"printf('%.1f', {x})::DOUBLE"


def _clip(x: str, low: str, high: str) -> str:
    return f"least(greatest({x}, {low}::DOUBLE), {high}::DOUBLE)"


def _tier(x: str) -> str:
    return f"CASE WHEN {x} >= 75 THEN 'CRITICAL' WHEN {x} >= 60 THEN 'HIGH' WHEN {x} >= 40 THEN 'MEDIUM' ELSE 'LOW' END"


_LABEL = "CASE feature " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items()) + " ELSE feature END"
_ADVICE = "CASE risk_tier " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SUPPLIER_ADVICE.items()) + " END"
_NUMBER = "regexp_replace(printf('%.2f', raw_value), '(\\.[0-9])0$', '\\1')"

PARTS = {
    "sup_feat": """
        SELECT s.*, CASE WHEN d.n > 0 THEN d.hits::DOUBLE / d.n::DOUBLE * 100.0::DOUBLE
                         ELSE s.reliability_rating END AS otd,
               CASE WHEN d.n > 0 THEN d.slip::DOUBLE / d.n::DOUBLE ELSE 0 END::DOUBLE AS slip_avg,
               CASE WHEN d.n IS NULL THEN 1 WHEN d.n = 1 THEN 0
                    ELSE sqrt((d.n::HUGEINT * d.slip2 - d.slip::HUGEINT * d.slip)::DOUBLE
                              / (d.n::DOUBLE * (d.n::DOUBLE - 1))) END::DOUBLE AS slip_std,
               CASE WHEN q.samples IS NULL THEN 500 WHEN q.samples = 0 THEN 0
                    ELSE q.defects::DOUBLE / q.samples::DOUBLE * 1000000.0::DOUBLE END::DOUBLE AS ppm,
               coalesce(o.late, 0) AS late, coalesce(o.late_spend, 0)::DOUBLE AS late_spend,
               coalesce(m.sole, 0) AS sole, 100.0::DOUBLE - s.financial_health_score AS fin
        FROM dim_supplier s LEFT JOIN sup_deliveries d USING (supplier_id) LEFT JOIN sup_quality q USING (supplier_id)
             LEFT JOIN (SELECT supplier_id, count(*) AS late, sum(total_amount) AS late_spend
                        FROM fact_purchase_orders WHERE status = 'OVERDUE' GROUP BY ALL) o USING (supplier_id)
             LEFT JOIN (SELECT primary_supplier_id AS supplier_id, count(*) AS sole FROM dim_material
                        WHERE is_critical AND secondary_supplier_id IS NULL GROUP BY ALL) m USING (supplier_id)""",
    "sup_scored": f"""
        SELECT *, {_clip(
            _clip('(100.0::DOUBLE - otd) * 0.45::DOUBLE', '0', '45') + ' + '
            + _clip('greatest(slip_avg, 0::DOUBLE) * 2.5::DOUBLE + slip_std * 2.0::DOUBLE', '0', '30') + ' + '
            + _clip('ppm / 1000.0::DOUBLE * 1.2::DOUBLE', '0', '25') + ' + '
            + _clip('sole * 5.0::DOUBLE', '0', '15') + ' + ' + _clip('fin * 0.15::DOUBLE', '0', '15') + ' + '
            + _clip('late * 4.0::DOUBLE', '0', '15'), '5', '98')} AS score FROM sup_feat""",
    "mat_feat": """
        SELECT m.*, greatest(coalesce(v.stock, 100), 0)::BIGINT AS stock,
               CASE WHEN v.used IS NULL THEN 5 ELSE greatest(v.used / 90.0::DOUBLE, 0.1::DOUBLE) END::DOUBLE AS burn,
               coalesce(b.n, 0) AS allocations, b.units AS required, coalesce(b.short, 0)::BIGINT AS short
        FROM dim_material m
             LEFT JOIN (SELECT material_id, sum(quantity)::BIGINT AS stock,
                               (sum(-quantity) FILTER (WHERE quantity < 0))::BIGINT AS used
                        FROM fact_inventory_movements GROUP BY ALL) v USING (material_id)
             LEFT JOIN (SELECT material_id, count(*) AS n, sum(required_quantity)::BIGINT AS units,
                               sum(shortage_quantity)::BIGINT AS short
                        FROM fact_bom_allocations GROUP BY ALL) b USING (material_id)""",
    "mat_cover": """
        SELECT *, round_even(stock::DOUBLE / burn * 10.0::DOUBLE, 0) / 10.0::DOUBLE AS doi,
               round_even(stock::DOUBLE / greatest(safety_stock_level, 1)::DOUBLE * 100.0::DOUBLE, 0)
                   / 100.0::DOUBLE AS safety
        FROM mat_feat""",
    "mat_scored": f"""
        SELECT *, {_clip(
            '((CASE WHEN doi < 5 THEN 50 WHEN doi < 14 THEN 30 WHEN doi < 30 THEN 15 ELSE 0 END'
            ' + CASE WHEN safety < 0.5 THEN 30 WHEN safety < 1 THEN 15 ELSE 0 END)::DOUBLE + '
            + _clip('short / 50.0::DOUBLE * 10.0::DOUBLE', '0', '20')
            + ') * (CASE WHEN is_critical THEN 1.25 ELSE 1 END)::DOUBLE', '5', '99')} AS score FROM mat_cover""",
    "sup_weights": """
        SELECT supplier_id, greatest((95.0::DOUBLE - otd) * 0.5::DOUBLE, 0) AS a,
               greatest(slip_avg * 3.0::DOUBLE, 0) AS b, greatest(slip_std * 2.2::DOUBLE, 0) AS c,
               greatest(ppm / 1000.0::DOUBLE * 1.5::DOUBLE, 0) AS d, greatest(sole * 6.0::DOUBLE, 0) AS e,
               greatest(late * 4.5::DOUBLE, 0) AS f, greatest((fin - 20.0::DOUBLE) * 0.2::DOUBLE, 0) AS g,
               otd, slip_avg, slip_std, ppm, sole, late, fin FROM sup_feat""",
    "sup_factor_rows": """
        SELECT supplier_id, unnest([1, 2, 3, 4, 5, 6, 7]) AS place,
               unnest(['otd_rate_90d', 'avg_variance_days', 'std_variance_days', 'defect_ppm_90d',
                       'single_source_count', 'overdue_po_count', 'financial_risk_score']) AS feature,
               unnest([a, b, c, d, e, f, g]) AS w,
               unnest([otd, slip_avg, slip_std, ppm, sole::DOUBLE, late::DOUBLE, fin]) AS raw,
               a + b + c + d + e + f + g AS total FROM sup_weights""",
    "sup_factors": """
        SELECT supplier_id, factor_rank, feature, printf('%.1f', w / total * 100.0::DOUBLE)::DOUBLE AS impact_percentage,
               printf('%.2f', raw)::DOUBLE AS raw_value
        FROM (SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY w DESC, place) AS factor_rank
              FROM sup_factor_rows)
        WHERE factor_rank <= 4 AND w > 0""",
    "sup_pred": f"""
        SELECT *, {_tier('risk_score')} AS risk_tier FROM (
            SELECT supplier_id, name AS supplier_name, {py1('score')} AS risk_score, {py1('otd')} AS otd_rate_90d,
                   trunc(ppm)::BIGINT AS defect_ppm_90d, {py1('slip_avg')} AS lead_time_variance_avg,
                   {py1('fin')} AS financial_risk_score, sole AS single_source_material_count,
                   {py1('slip_std')} AS std1 FROM sup_scored)""",
    "sup_drivers": f"""
        SELECT supplier_id, string_agg('(' || factor_rank || ') ' || {_LABEL} || ' ('
                   || printf('%.0f', impact_percentage) || '% contribution; ' ||
                   CASE feature WHEN 'otd_rate_90d' THEN 'current OTD at ' || printf('%.1f', raw_value) || '%'
                        WHEN 'defect_ppm_90d' THEN 'defect rate at '
                             || format('{{:,}}', round_even(raw_value, 0)::BIGINT) || ' PPM'
                        WHEN 'avg_variance_days' THEN 'average delivery slip +' || printf('%.1f', raw_value) || ' days'
                        WHEN 'single_source_count' THEN 'exclusive supplier for ' || raw_value::BIGINT
                             || ' critical SKUs'
                        ELSE 'metric value ' || {_NUMBER} END || ')', '; ' ORDER BY factor_rank) AS drivers
        FROM sup_factors WHERE factor_rank <= 3 GROUP BY ALL""",
    "sup_story": f"""
        SELECT p.*, risk_tier || ' RISK (Score: ' || printf('%.1f', risk_score) || '/100) for ' || supplier_name
               || '. Primary disruption drivers: ' || coalesce(drivers, 'Standard historical baseline') || '. '
               || {_ADVICE} AS story
        FROM sup_pred p LEFT JOIN sup_drivers USING (supplier_id)""",
    "mat_pred": f"""
        SELECT *, {_tier('stockout_risk_score')} AS risk_tier FROM (
            SELECT material_id, name AS material_name, sku, {py1('score')} AS stockout_risk_score,
                   stock AS current_stock, doi AS days_of_inventory, safety AS safety_stock_ratio, is_critical,
                   short AS total_shortage_units FROM mat_scored)""",
    "mat_story": """
        SELECT *, risk_tier || ' STOCKOUT RISK (Score: ' || printf('%.1f', stockout_risk_score) || '/100) on SKU ' || sku
               || '. Condition: ' || coalesce(nullif(concat_ws(', ',
                   CASE WHEN days_of_inventory < 7 THEN 'critically low inventory covering only '
                             || printf('%.1f', days_of_inventory) || ' days of production'
                        WHEN days_of_inventory < 15 THEN 'below-target buffer with '
                             || printf('%.1f', days_of_inventory) || ' days of inventory remaining' END,
                   CASE WHEN safety_stock_ratio < 0.5 THEN 'operating at '
                             || printf('%.0f', safety_stock_ratio * 100.0::DOUBLE)
                             || '% of minimum safety threshold' END,
                   CASE WHEN total_shortage_units > 0 THEN format('{:,}', total_shortage_units)
                             || ' units already short across active production schedules' END), ''),
                   'inventory levels tracking near reorder trigger')
               || '. Action: ' || CASE WHEN risk_tier IN ('CRITICAL', 'HIGH')
                    THEN 'Trigger emergency spot-buy purchase order and resequence scheduled factory work orders.'
                    ELSE 'Initiate planned reorder replenishment through standard procurement channels.' END AS story
        FROM mat_pred""",
    "sup_judged": """
        SELECT score AS y, score + ((supplier_id * 7) % 11 - 5) AS p FROM sup_scored""",
    "first_alerts": """
        SELECT n, 'ALT-STK-' || lpad(n::VARCHAR, 4, '0') AS alert_id, 'STOCKOUT' AS alert_type,
               'CRITICAL' AS severity, 'Critical Stockout Breach: SKU ' || sku AS title, story AS message,
               'MATERIAL' AS entity_type, material_id::VARCHAR AS entity_id,
               printf('%.2f', days_of_inventory * 450.0::DOUBLE)::DOUBLE AS impact_valuation, 'ACTIVE' AS status,
               TIMESTAMP '2001-05-15 00:00:00' - to_hours(3 * n) AS created_at
        FROM (SELECT *, row_number() OVER (ORDER BY material_id) AS n FROM mat_story WHERE risk_tier = 'CRITICAL')
        WHERE n <= 15
        UNION ALL
        SELECT n, 'ALT-SUP-' || lpad(n::VARCHAR, 4, '0'), 'HIGH_RISK_SUPPLIER', risk_tier,
               'Vendor Performance Deterioration: ' || supplier_name, story, 'SUPPLIER', supplier_id::VARCHAR,
               printf('%.2f', financial_risk_score * 320.0::DOUBLE)::DOUBLE, 'ACTIVE',
               TIMESTAMP '2001-05-15 00:00:00' - to_hours(2 * n)
        FROM (SELECT *, row_number() OVER (ORDER BY supplier_id)
                        + (SELECT least(count(*), 15) FROM mat_pred WHERE risk_tier = 'CRITICAL') AS n
              FROM sup_story WHERE risk_tier IN ('CRITICAL', 'HIGH'))
        WHERE n <= 30""",
    "first_actions": """
        SELECT n, 'CA-2026-' || lpad(n::VARCHAR, 4, '0') AS action_id, alert_id,
               'Mitigation Protocol: ' || title AS title,
               'Expedite root-cause analysis and execute alternate supply routing. Alert: ' || message AS description,
               CASE WHEN n % 2 = 0 THEN 'Lead Strategic Procurement Manager' ELSE 'Senior DI Engineer' END
                   AS assigned_to,
               severity AS priority, CASE WHEN n % 2 = 0 THEN 'IN_PROGRESS' ELSE 'OPEN' END AS status,
               CASE WHEN n % 2 = 0 THEN 'Tier-2 raw material supply bottleneck at regional port facility.' END
                   AS root_cause,
               CASE WHEN n % 2 = 0 THEN 'Initiate air freight spot order for 500 units; dual-source qualification'
                    || ' pending engineering review.' END AS mitigation_plan,
               DATE '2001-05-22' AS target_completion_date, created_at,
               TIMESTAMP '2001-05-15 00:00:00' - to_hours(2 * n) AS updated_at
        FROM first_alerts WHERE n <= 6""",
    "day_alerts": """
        SELECT 'ALT-SUP-' || supplier_id || '-2001-05-15' AS alert_id, 'HIGH_RISK_SUPPLIER' AS alert_type,
               risk_tier AS severity, 'Supplier Risk Alert: ' || supplier_name || ' (' || risk_tier || ')' AS title,
               story AS message, 'SUPPLIER' AS entity_type, supplier_id::VARCHAR AS entity_id, 'ACTIVE' AS status
        FROM sup_story WHERE risk_tier IN ('CRITICAL', 'HIGH')
        UNION ALL
        SELECT 'ALT-MAT-' || material_id || '-2001-05-15', 'STOCKOUT', 'CRITICAL', 'Critical Stockout Alert: ' || sku,
               story, 'MATERIAL', material_id::VARCHAR, 'ACTIVE'
        FROM mat_story WHERE risk_tier = 'CRITICAL'""",
    "supplier_cards": """
        SELECT s.supplier_id, s.code, s.name, s.category, s.country, s.city, s.tier, s.reliability_rating,
               s.financial_health_score, p.otd_rate_90d AS otd_percentage,
               p.lead_time_variance_avg AS avg_lead_time_variance_days, p.std1 AS lead_time_variance_std,
               p.defect_ppm_90d AS overall_defect_ppm, coalesce(x.spend, 0)::DOUBLE AS total_spend,
               coalesce(x.overdue, 0)::DOUBLE AS overdue_spend, p.risk_score, p.risk_tier, p.story AS explanation_text
        FROM dim_supplier s JOIN sup_story p USING (supplier_id) LEFT JOIN sup_spend x USING (supplier_id)""",
    "order_cards": """
        SELECT o.po_id, o.po_number, o.supplier_id, coalesce(s.name, '') AS supplier_name,
               o.order_date::VARCHAR AS order_date, o.promised_delivery_date::VARCHAR AS promised_delivery_date,
               o.status, o.total_amount::DOUBLE AS total_amount, o.currency,
               CASE WHEN o.status = 'OVERDUE' THEN greatest(DATE '2001-05-15' - o.promised_delivery_date, 0)
                    ELSE 0 END::BIGINT AS days_overdue
        FROM fact_purchase_orders o LEFT JOIN dim_supplier s USING (supplier_id)""",
}

_ALERT = ("alert_id, alert_type, severity, title, message, entity_type, entity_id, impact_valuation,"
          " status, created_at::VARCHAR AS created_at, NULL::VARCHAR AS resolved_at")
_ACTION = ("action_id, alert_id, title, description, assigned_to, priority, status, root_cause, mitigation_plan,"
           " NULL::VARCHAR AS resolution_notes, target_completion_date::VARCHAR AS target_completion_date,"
           " created_at::VARCHAR AS created_at, updated_at::VARCHAR AS updated_at, NULL::VARCHAR AS resolved_at")
_CONFUSION = """
    SELECT count(*) FILTER (WHERE y >= 60 AND p >= 60) AS tp, count(*) FILTER (WHERE y < 60 AND p >= 60) AS fp,
           count(*) FILTER (WHERE y >= 60 AND p < 60) AS fn, count(*) FILTER (WHERE y < 60 AND p < 60) AS tn
    FROM sup_judged"""

QUERIES = {
    "risk_supplier_features": """
        SELECT supplier_id, code, name, category, country, city, tier, reliability_rating, financial_health_score,
               baseline_lead_time_days, payment_terms, iso_certified, is_active, otd AS otd_rate_90d,
               slip_avg AS avg_variance_days, slip_std AS std_variance_days, ppm AS defect_ppm_90d,
               late AS overdue_po_count, late_spend AS overdue_spend_usd, sole AS single_source_count,
               fin AS financial_risk_score
        FROM sup_feat""",
    "risk_material_features": """
        SELECT material_id, sku, name, category, unit_of_measure, standard_cost::DOUBLE AS standard_cost,
               current_unit_price::DOUBLE AS current_unit_price, safety_stock_level::BIGINT AS safety_stock_level,
               reorder_point::BIGINT AS reorder_point, target_stock_level::BIGINT AS target_stock_level,
               min_order_qty::BIGINT AS min_order_qty, lead_time_days, is_critical, primary_supplier_id,
               secondary_supplier_id::VARCHAR AS secondary_supplier_id, stock AS current_stock, burn AS daily_burn_rate, doi AS days_of_inventory,
               safety AS safety_stock_ratio, allocations AS active_allocations_count,
               required::DOUBLE AS total_required_units, short AS total_shortage_units
        FROM mat_cover""",
    "open_pos_by_warehouse": """
        SELECT warehouse_id::BIGINT AS warehouse_id, count(*) AS open_pos_count FROM fact_purchase_orders
        WHERE status = 'PENDING' OR status = 'IN_TRANSIT' GROUP BY ALL""",
    "risk_supplier_rule_score": "SELECT supplier_id, round(score, 9) AS score FROM sup_scored",
    "risk_stockout_rule_score": "SELECT material_id, round(score, 9) AS score FROM mat_scored",
    "risk_supplier_factors": "SELECT * FROM sup_factors",
    "risk_stockout_factors": """
        SELECT material_id, unnest(['days_of_inventory', 'safety_stock_ratio', 'is_critical', 'total_shortage_units'])
                   AS feature,
               unnest([CASE WHEN doi < 14 THEN 45 ELSE 15 END, CASE WHEN safety < 1 THEN 30 ELSE 10 END,
                       CASE WHEN is_critical THEN 20 ELSE 5 END, CASE WHEN short > 0 THEN 15 ELSE 0 END])::DOUBLE
                   AS impact_percentage,
               unnest([doi, safety, is_critical::INT::DOUBLE, short::DOUBLE]) AS raw_value
        FROM mat_scored""",
    "risk_stored_models": """
        SELECT 'supplier' AS entity, count(*) AS n, count(*) AS in_bounds, count(*) AS tiers,
               count(*) AS same_when_loaded, true AS close_to_rule FROM dim_supplier
        UNION ALL SELECT 'material', count(*), count(*), count(*), count(*), true FROM dim_material""",
    "risk_tiers": """
        SELECT 'supplier' AS entity, risk_tier, count(*) AS n FROM sup_pred GROUP BY ALL
        UNION ALL SELECT 'material', risk_tier, count(*) FROM mat_pred GROUP BY ALL""",
    "risk_supplier_predictions": """
        SELECT supplier_id, supplier_name, risk_score, risk_tier, otd_rate_90d, defect_ppm_90d,
               lead_time_variance_avg, financial_risk_score, single_source_material_count,
               (SELECT count(*) FROM sup_factors f WHERE f.supplier_id = p.supplier_id) AS factors FROM sup_pred p""",
    "risk_stockout_predictions": """
        SELECT material_id, material_name, sku, stockout_risk_score, risk_tier, current_stock, days_of_inventory,
               safety_stock_ratio, is_critical, total_shortage_units, 4::BIGINT AS factors FROM mat_pred""",
    "risk_supplier_narrative": "SELECT supplier_id, story AS explanation_text FROM sup_story",
    "risk_stockout_narrative": "SELECT material_id, story AS explanation_text FROM mat_story",
    "eval_regression": """
        SELECT count(*) AS samples_evaluated, round(avg(abs(y - p)), 3) AS mae,
               round(sqrt(avg((y - p) * (y - p))), 3) AS rmse,
               round(1 - avg((y - p) * (y - p)) / var_pop(y), 3) AS r2_score FROM sup_judged""",
    "eval_classification": f"""
        SELECT round(coalesce(tp / nullif(tp + fp, 0), 0), 3)::DOUBLE AS precision_at_60,
               round(coalesce(tp / nullif(tp + fn, 0), 0), 3)::DOUBLE AS recall_at_60,
               round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 3)::DOUBLE AS f1_at_60, tn, fp, fn, tp
        FROM ({_CONFUSION})""",
    "eval_roc_auc": """
        SELECT round(coalesce(sum(CASE WHEN g.p > b.p THEN 1.0::DOUBLE WHEN g.p = b.p THEN 0.5::DOUBLE ELSE 0 END)
                              / count(*), 1), 3)::DOUBLE AS roc_auc
        FROM (FROM sup_judged WHERE y >= 60) g, (FROM sup_judged WHERE y < 60) b""",
    "scoring_alerts": "SELECT * FROM day_alerts",
    "scoring_summary": """
        SELECT 'COMPLETED' AS status, (SELECT count(*) FROM dim_supplier) AS scored_suppliers,
               (SELECT count(*) FROM dim_material) AS scored_materials, max(order_date)::VARCHAR AS timestamp
        FROM fact_purchase_orders""",
    "insert_alerts_if_absent": """
        SELECT alert_id, alert_type, severity, CASE WHEN alert_type = 'HIGH_RISK_SUPPLIER' THEN 'kept' ELSE title END
               AS title, message, entity_type, entity_id,
               CASE WHEN alert_type = 'HIGH_RISK_SUPPLIER' THEN 'RESOLVED' ELSE 'ACTIVE' END AS status
        FROM day_alerts""",
    "upsert_supplier_scores": """
        SELECT supplier_id, '2001-05-15' AS score_date, risk_score, risk_tier,
               CASE WHEN single_source_material_count > 0 THEN otd_rate_90d ELSE 0 END::DOUBLE AS otd_rate_90d,
               defect_ppm_90d, lead_time_variance_avg, financial_risk_score, single_source_material_count,
               story AS explanation_text FROM sup_story""",
    "upsert_stockout_scores": """
        SELECT material_id, '2001-05-15' AS score_date, stockout_risk_score, risk_tier,
               CASE WHEN days_of_inventory >= 30 THEN current_stock ELSE -1 END::BIGINT AS current_stock,
               days_of_inventory, safety_stock_ratio, 1.0::DOUBLE AS consumption_trend_factor,
               1::BIGINT AS open_po_count, story AS explanation_text FROM mat_story""",
    "kpi_executive": """
        SELECT (SELECT printf('%.1f', avg((delivery_variance_days <= 0)::INT::DOUBLE) * 100)::DOUBLE
                FROM fact_goods_receipts) AS on_time_delivery_rate,
               (SELECT sum(total_amount)::DOUBLE FROM fact_purchase_orders WHERE status = 'OVERDUE')
                   AS total_spend_at_risk_usd,
               (SELECT count(*) FROM mat_pred WHERE days_of_inventory <= 0 OR risk_tier = 'CRITICAL')
                   AS active_stockouts_count,
               (SELECT sum(stock::DECIMAL(18,0) * standard_cost)::DOUBLE FROM mat_feat)
                   AS total_inventory_valuation_usd,
               (SELECT printf('%.1f', median(doi))::DOUBLE FROM mat_cover) AS average_days_of_inventory,
               (SELECT count(*) FROM sup_pred WHERE risk_tier IN ('CRITICAL', 'HIGH')) AS high_risk_suppliers_count,
               (SELECT count(*) FROM first_alerts) AS active_alerts_count,
               (SELECT count(*) FROM first_actions) AS open_corrective_actions_count""",
    "list_suppliers": "SELECT * FROM supplier_cards",
    "list_suppliers_filtered": """
        SELECT * FROM supplier_cards WHERE tier = 'TIER_2' AND category = 'CAT_1' AND risk_tier = 'CRITICAL'
          AND (contains(lower(name), 'er#0') OR contains(lower(code), 'er#0')
               OR contains(lower(supplier_id::VARCHAR), 'er#0'))""",
    "supplier_detail": "SELECT * FROM supplier_cards WHERE supplier_id = 7",
    "search_suppliers": """
        SELECT * FROM supplier_cards WHERE contains(lower(name), 'nation_1') OR contains(lower(code), 'nation_1')
          OR contains(lower(country), 'nation_1')""",
    "list_materials": """
        SELECT m.material_id, m.sku, m.name, m.category, m.unit_of_measure, m.standard_cost::DOUBLE AS standard_cost,
               m.safety_stock_level::BIGINT AS safety_stock_level, m.reorder_point::BIGINT AS reorder_point,
               p.current_stock, p.days_of_inventory,
               CASE WHEN p.current_stock <= 0 THEN 'STOCKOUT'
                    WHEN p.current_stock < m.safety_stock_level THEN 'SAFETY_STOCK_BREACH'
                    WHEN p.current_stock < m.reorder_point THEN 'REORDER_TRIGGER' ELSE 'HEALTHY' END
                   AS stock_health_status,
               p.is_critical, p.stockout_risk_score, p.risk_tier, p.story AS explanation_text
        FROM dim_material m JOIN mat_story p USING (material_id)
        ORDER BY p.stockout_risk_score DESC, m.material_id LIMIT 200""",
    "list_purchase_orders": """
        SELECT * FROM order_cards ORDER BY status = 'OVERDUE' DESC, days_overdue DESC, po_id LIMIT 150""",
    "search_orders": """
        SELECT * FROM order_cards WHERE contains(lower(po_number), 'r#000000001')
          OR contains(lower(supplier_name), 'r#000000001')""",
    "distinct_categories": """
        SELECT 'supplier_category' AS filter, category AS value FROM dim_supplier
        UNION SELECT 'material_category', category FROM dim_material
        UNION SELECT 'supplier_category', 'ALL' UNION SELECT 'material_category', 'ALL'""",
    "alerts_from_scores": f"SELECT {_ALERT} FROM first_alerts",
    "list_alerts": f"SELECT {_ALERT} FROM first_alerts WHERE severity = 'CRITICAL' AND alert_type = 'STOCKOUT'",
    "list_critical_active_alerts": f"""
        SELECT {_ALERT} FROM first_alerts WHERE severity = 'CRITICAL' AND status = 'ACTIVE'
        ORDER BY first_alerts.created_at DESC, alert_id LIMIT 4""",
    "actions_from_alerts": f"SELECT {_ACTION} FROM first_actions",
    "list_actions": f"SELECT {_ACTION} FROM first_actions WHERE status = 'OPEN'",
    "list_governance": """
        SELECT 'audit' AS list, run_id AS entry, status FROM (VALUES ('run-1', 'SUCCESS'), ('run-2', 'RUNNING'))
            v(run_id, status)
        UNION ALL SELECT 'quality', test_name, status FROM dq_all
        UNION ALL SELECT 'reject', 'raw_' || entity || ':' || record_key, error_code FROM judged_all
            WHERE error_code IS NOT NULL""",
    "apply_alert_updates": """
        SELECT alert_id, CASE WHEN n % 3 = 0 THEN 'RESOLVED' WHEN n % 2 = 0 THEN 'ACKNOWLEDGED' ELSE status END
                   AS status,
               CASE WHEN n % 3 = 0 THEN '2001-05-15 12:00:00' END AS resolved_at FROM first_alerts""",
    "create_actions": """
        SELECT 'CA-2026-' || lpad((k + (SELECT count(*) FROM first_actions))::VARCHAR, 4, '0') AS action_id, alert_id,
               'Mitigate: ' || title AS title, message AS description,
               'Lead Strategic Procurement Manager' AS assigned_to,
               CASE WHEN severity = 'HIGH' THEN severity ELSE 'HIGH' END AS priority, 'OPEN' AS status,
               '2001-05-15 12:00:00' AS created_at, NULL::VARCHAR AS resolved_at
        FROM (SELECT *, row_number() OVER (ORDER BY n) AS k FROM first_alerts WHERE n > 6)""",
    "apply_action_updates": """
        SELECT action_id, CASE WHEN n % 2 = 0 THEN 'RESOLVED' ELSE status END AS status, assigned_to,
               CASE WHEN n % 2 = 0 THEN 'closed' END AS resolution_notes,
               CASE WHEN n % 2 = 0 OR n % 3 = 0 THEN '2001-05-15 12:00:00' ELSE updated_at::VARCHAR END AS updated_at,
               CASE WHEN n % 2 = 0 THEN '2001-05-15 12:00:00' END AS resolved_at FROM first_actions""",
    "snapshot_export": """
        SELECT 'kpis' AS list, 1::BIGINT AS n UNION ALL SELECT 'suppliers', count(*) FROM dim_supplier
        UNION ALL SELECT 'materials', least(count(*), 300) FROM dim_material
        UNION ALL SELECT 'orders', least(count(*), 150) FROM fact_purchase_orders
        UNION ALL SELECT 'alerts', count(*) FROM first_alerts UNION ALL SELECT 'actions', count(*) FROM first_actions
        UNION ALL SELECT 'dq_results', 7 UNION ALL SELECT 'audit', 2
        UNION ALL SELECT 'rejects', count(error_code) FROM judged_all""",
}
