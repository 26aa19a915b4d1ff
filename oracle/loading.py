"""Validation, merges, calendar, ledger and quality checks as DuckDB texts."""

from oracle import constraints as declared

_DECLARED_LOW, _DECLARED_HIGH = "DATE '2000-01-01'", "DATE '2001-07-01'"
_TIERS = "''TIER_1'', ''TIER_2'', ''TIER_3''"
_TYPES = (
    "''CYCLE_ADJUSTMENT'', ''GOODS_RECEIPT'', ''PRODUCTION_ISSUE'', ''SCRAP'', ''TRANSFER_IN'', ''TRANSFER_OUT''"
)


def _outcome(batch: str, key: str, errors: list[str], also: str = "") -> str:
    listed = ", ".join(errors)
    return f"""
        SELECT record_key, batch_seq, payload{also},
               CASE WHEN batch_seq > claimed THEN 'ERR_DUPLICATE_KEY'
                    WHEN problem <> '' THEN 'ERR_SCHEMA_VALIDATION' END AS error_code,
               CASE WHEN batch_seq > claimed
                    THEN 'Duplicate primary business key ''' || record_key || ''' detected in batch.'
                    WHEN problem <> '' THEN problem END AS error_reason
        FROM (SELECT *, min(batch_seq) FILTER (WHERE problem = '') OVER (PARTITION BY record_key) AS claimed
              FROM (SELECT *, {key} AS record_key, concat_ws('; ', {listed}) AS problem FROM {batch}))"""


def _json(columns: str) -> str:
    fields = ", ".join(f"'{c}', {c}" for c in columns.split())
    return f"json_object({fields})::VARCHAR AS payload"


_SUP = ("supplier_id code name category country city tier reliability_rating financial_health_score"
        " baseline_lead_time_days payment_terms iso_certified is_active")
_MAT = ("material_id sku name category unit_of_measure standard_cost current_unit_price safety_stock_level"
        " reorder_point target_stock_level min_order_qty lead_time_days is_critical primary_supplier_id"
        " secondary_supplier_id")
_ORD = ("po_id po_number supplier_id warehouse_id factory_id order_date promised_delivery_date status total_amount"
        " currency")
_MOV = ("movement_id material_id warehouse_id factory_id movement_date movement_type quantity reference_doc_type"
        " reference_doc_id")

PARTS = {
    "text_suppliers": f"""
        SELECT *, {_json(_SUP)} FROM (
            SELECT supplier_id::VARCHAR AS supplier_id, code, name, category, country, city,
                   CASE WHEN supplier_id % 13 = 5 THEN 'TIER_99' ELSE tier END AS tier,
                   CASE WHEN supplier_id % 17 = 3 THEN '120' ELSE reliability_rating::VARCHAR END
                       AS reliability_rating,
                   financial_health_score::VARCHAR AS financial_health_score,
                   CASE WHEN supplier_id % 19 = 4 THEN '0' ELSE baseline_lead_time_days::VARCHAR END
                       AS baseline_lead_time_days,
                   payment_terms, iso_certified::VARCHAR AS iso_certified, is_active::VARCHAR AS is_active,
                   supplier_id + again * 100000000 AS batch_seq
            FROM dim_supplier, (VALUES (0), (1)) r(again) WHERE again = 0 OR supplier_id % 7 = 1)""",
    "text_materials": f"""
        SELECT * EXCLUDE (fault), {_json(_MAT)} FROM (
            SELECT material_id::VARCHAR AS material_id, sku, name, category, unit_of_measure,
                   CASE WHEN fault AND material_id % 43 = 0 THEN '0' ELSE standard_cost::VARCHAR END AS standard_cost,
                   current_unit_price::VARCHAR AS current_unit_price,
                   safety_stock_level::VARCHAR AS safety_stock_level,
                   CASE WHEN fault AND material_id % 41 = 0 THEN safety_stock_level - 1
                        ELSE reorder_point END::VARCHAR AS reorder_point,
                   target_stock_level::VARCHAR AS target_stock_level, min_order_qty::VARCHAR AS min_order_qty,
                   CASE WHEN fault AND material_id % 47 = 0 THEN 'x' ELSE lead_time_days::VARCHAR END
                       AS lead_time_days,
                   is_critical::VARCHAR AS is_critical, primary_supplier_id::VARCHAR AS primary_supplier_id,
                   secondary_supplier_id::VARCHAR AS secondary_supplier_id,
                   material_id + again * 100000000 AS batch_seq, fault
            FROM (SELECT *, again = 0 OR material_id % 59 = 0 AS fault FROM dim_material, (VALUES (0), (1)) r(again)
                  WHERE again = 0 OR material_id % 59 = 0 OR material_id % 82 = 0))""",
    "text_orders": f"""
        SELECT *, {_json(_ORD)} FROM (
            SELECT po_id::VARCHAR AS po_id, po_number, supplier_id::VARCHAR AS supplier_id,
                   warehouse_id::VARCHAR AS warehouse_id, factory_id::VARCHAR AS factory_id,
                   order_date::VARCHAR AS order_date,
                   (order_date + CASE WHEN again = 0 AND po_id % 53 = 0 THEN -3 ELSE 20 END)::VARCHAR
                       AS promised_delivery_date,
                   status,
                   CASE WHEN again = 1 THEN '1.00' WHEN po_id % 71 = 0 THEN '-1' WHEN po_id % 89 = 0 THEN 'n/a'
                        ELSE total_amount::VARCHAR END AS total_amount,
                   currency, po_id + again * 100000000 AS batch_seq
            FROM fact_purchase_orders, (VALUES (0), (1)) r(again)
            WHERE again = 0 OR po_id % 97 = 0 OR po_id % 371 = 0)""",
    "text_moves": f"""
        SELECT *, {_json(_MOV)} FROM (
            SELECT movement_id, material_id::VARCHAR AS material_id, warehouse_id::VARCHAR AS warehouse_id,
                   factory_id::VARCHAR AS factory_id, movement_date::VARCHAR AS movement_date,
                   CASE WHEN k % 101 = 0 THEN 'RETURN' ELSE movement_type END AS movement_type,
                   CASE WHEN movement_type = 'GOODS_RECEIPT' AND k % 103 = 0 THEN 0
                        WHEN movement_type = 'PRODUCTION_ISSUE' AND k % 107 = 0 THEN 0
                        WHEN movement_type = 'PRODUCTION_ISSUE' AND k % 109 = 0 THEN -quantity
                        ELSE quantity END::VARCHAR AS quantity,
                   'ORDER' AS reference_doc_type, k::VARCHAR AS reference_doc_id,
                   k * 10 + split_part(movement_id, '-', 2)::BIGINT AS batch_seq
            FROM (SELECT *, split_part(movement_id, '-', 1)::BIGINT AS k FROM fact_inventory_movements))""",
    "judged_suppliers": _outcome("text_suppliers", "supplier_id", [
        "CASE WHEN tier NOT IN ('TIER_1', 'TIER_2', 'TIER_3') THEN 'tier: Value error, Invalid supplier tier: ' || tier"
        f" || '. Expected one of {{{_TIERS}}}' END",
        "CASE WHEN reliability_rating::DOUBLE > 100"
        " THEN 'reliability_rating: Input should be less than or equal to 100' END",
        "CASE WHEN baseline_lead_time_days::INT <= 0"
        " THEN 'baseline_lead_time_days: Input should be greater than 0' END",
    ], ", " + _SUP.replace(" ", ", ")),
    "judged_materials": _outcome("text_materials", "material_id", [
        "CASE WHEN standard_cost::DOUBLE <= 0 THEN 'standard_cost: Input should be greater than 0' END",
        "CASE WHEN reorder_point::INT < 0 THEN 'reorder_point: Input should be greater than or equal to 0'"
        " WHEN reorder_point::INT < safety_stock_level::INT THEN 'reorder_point: Value error, Reorder point (' ||"
        " reorder_point || ') must be greater than or equal to safety stock (' || safety_stock_level || ')' END",
        "CASE WHEN try_cast(lead_time_days AS INT) IS NULL THEN 'lead_time_days: Input should be a valid integer,"
        " unable to parse string as an integer' END",
    ], ", " + _MAT.replace(" ", ", ")),
    "judged_orders": _outcome("text_orders", "po_id", [
        "CASE WHEN promised_delivery_date < order_date THEN 'promised_delivery_date: Value error, Promised delivery"
        " date (' || promised_delivery_date || ') cannot be before order date (' || order_date || ')' END",
        "CASE WHEN try_cast(total_amount AS DOUBLE) IS NULL THEN 'total_amount: Input should be a valid number,"
        " unable to parse string as a number' WHEN total_amount::DOUBLE < 0"
        " THEN 'total_amount: Input should be greater than or equal to 0' END",
    ]),
    "judged_moves": _outcome("text_moves", "movement_id", [
        "CASE WHEN movement_type = 'RETURN' THEN 'movement_type: Value error, Invalid movement type ''RETURN''."
        f" Allowed: {{{_TYPES}}}' END",
        "CASE WHEN movement_type = 'GOODS_RECEIPT' AND quantity::INT <= 0 THEN 'quantity: Value error, GOODS_RECEIPT"
        " movements must have positive quantity.' WHEN movement_type IN ('PRODUCTION_ISSUE', 'SCRAP')"
        " AND quantity::INT > 0 THEN 'quantity: Value error, ' || movement_type ||"
        " ' movements must have negative quantity consumption.' END",
    ]),
    "judged_all": """
        SELECT 'suppliers' AS entity, record_key, batch_seq, payload, error_code, error_reason FROM judged_suppliers
        UNION ALL SELECT 'materials', record_key, batch_seq, payload, error_code, error_reason FROM judged_materials
        UNION ALL SELECT 'purchase_orders', record_key, batch_seq, payload, error_code, error_reason FROM judged_orders
        UNION ALL SELECT 'inventory_movements', record_key, batch_seq, payload, error_code, error_reason
        FROM judged_moves""",
    "ingest_totals": """
        SELECT entity, count(*) AS rows_extracted, count(*) FILTER (WHERE error_code IS NULL) AS rows_loaded,
               count(error_code) AS rows_rejected,
               count(*) FILTER (WHERE error_code = 'ERR_SCHEMA_VALIDATION') AS schema_errors,
               count(*) FILTER (WHERE error_code = 'ERR_DUPLICATE_KEY') AS duplicate_keys
        FROM judged_all WHERE entity <> 'inventory_movements' GROUP BY ALL""",
    "ledger_before": "FROM fact_inventory_movements WHERE movement_date < DATE '2001-05-15'",
    "ledger_offer": "FROM fact_inventory_movements WHERE movement_date >= DATE '2001-05-15' - 30",
    "ledger_named": f"""
        SELECT *, CASE WHEN movement_date >= {_DECLARED_LOW} AND movement_date < {_DECLARED_HIGH}
                  THEN year(movement_date) || '_q' || quarter(movement_date) ELSE 'default' END AS movement_quarter
        FROM fact_inventory_movements""",
    "dim_date": """
        SELECT d AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
               week(d) AS week, day(d) AS day, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))::DATE AS d)""",
}


def _outcomes_of(name: str) -> str:
    return f"SELECT record_key, batch_seq, error_code, error_reason FROM {name}"


QUERIES = {
    "dim_date_calendar": """
        WITH day_span AS (SELECT date_trunc('year', min(order_date)) AS a, date_trunc('year', max(order_date)) AS b
                          FROM fact_purchase_orders),
             day_rows AS (SELECT unnest(generate_series(a, b + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY))
                          ::DATE AS d FROM day_span)
        SELECT d::VARCHAR AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
               monthname(d) AS month_name, week(d) AS week, day(d) AS day, dayname(d) AS day_name,
               isodow(d) >= 6 AS is_weekend,
               (SELECT count(*) FROM fact_purchase_orders WHERE order_date = d) AS orders_placed
        FROM day_rows""",
    "validate_suppliers": _outcomes_of("judged_suppliers"),
    "validate_materials": _outcomes_of("judged_materials"),
    "validate_purchase_orders": _outcomes_of("judged_orders"),
    "validate_movements": _outcomes_of("judged_moves"),
    "validate_duplicates": """
        SELECT entity, record_key, batch_seq, error_reason FROM judged_all
        WHERE error_code = 'ERR_DUPLICATE_KEY'""",
    "rejected_records": """
        SELECT 'INBOUND_LOAD' AS pipeline_name, 'BATCH-1' AS batch_id, 'raw_' || entity AS source_table, payload,
               error_code, error_reason FROM judged_all WHERE error_code IS NOT NULL""",
    "rejected_records_stored": """
        SELECT 'raw_' || entity AS source_table, error_code, count(*) AS n FROM judged_all
        WHERE error_code IS NOT NULL GROUP BY ALL""",
    "ingest_summary": "SELECT * FROM ingest_totals",
    "load_audit": """
        SELECT 'run-1' AS run_id, 'INGESTION' AS pipeline_name, 'BATCH-1' AS batch_id,
               '2001-05-15 06:00:00' AS start_time, '2001-05-15 06:04:00' AS end_time,
               240.0::DOUBLE AS duration_seconds, sum(rows_extracted)::BIGINT AS rows_extracted,
               sum(rows_loaded)::BIGINT AS rows_loaded, sum(rows_rejected)::BIGINT AS rows_rejected,
               'SUCCESS' AS status, NULL::VARCHAR AS error_message FROM ingest_totals
        UNION ALL SELECT 'run-2', 'MOVEMENTS_LOAD', 'BATCH-1', '2001-05-15 06:04:00', NULL, NULL, 0, 0, 0,
               'RUNNING', NULL""",
    "upsert_suppliers": """
        WITH known_sup AS (FROM dim_supplier WHERE tier <> 'TIER_2'),
             batch_sup AS (FROM judged_suppliers WHERE error_code IS NULL)
        SELECT coalesce(b.supplier_id, k.supplier_id::VARCHAR) AS supplier_id,
               coalesce('OLD-' || k.supplier_id, b.code) AS code,
               coalesce(b.name, 'former name') AS name, coalesce(b.category, k.category) AS category,
               coalesce(b.country, k.country) AS country, coalesce(b.city, k.city) AS city,
               coalesce(b.tier, k.tier) AS tier,
               coalesce(b.reliability_rating::DOUBLE, k.reliability_rating) AS reliability_rating,
               coalesce(b.financial_health_score::DOUBLE, k.financial_health_score) AS financial_health_score,
               coalesce(b.baseline_lead_time_days::BIGINT, k.baseline_lead_time_days) AS baseline_lead_time_days,
               coalesce(b.payment_terms, k.payment_terms) AS payment_terms,
               coalesce(b.iso_certified::BOOLEAN, k.iso_certified) AS iso_certified,
               coalesce(b.is_active::BOOLEAN, k.is_active) AS is_active,
               CASE WHEN k.code IS NULL THEN '2001-05-15' ELSE '2001-01-01' END AS created_at,
               CASE WHEN b.code IS NULL THEN '2001-01-01' ELSE '2001-05-15' END AS updated_at
        FROM known_sup k FULL JOIN batch_sup b ON b.supplier_id = k.supplier_id::VARCHAR""",
    "upsert_materials": """
        WITH known_mat AS (FROM dim_material WHERE lead_time_days >= 20),
             batch_mat AS (FROM judged_materials WHERE error_code IS NULL)
        SELECT coalesce(b.material_id, k.material_id::VARCHAR) AS material_id, coalesce(b.sku, k.sku) AS sku,
               coalesce(b.name, 'former name') AS name, coalesce(b.category, k.category) AS category,
               coalesce(b.unit_of_measure, k.unit_of_measure) AS unit_of_measure,
               coalesce(b.standard_cost::DOUBLE, 1) AS standard_cost,
               coalesce(b.current_unit_price::DOUBLE, k.current_unit_price::DOUBLE) AS current_unit_price,
               coalesce(b.safety_stock_level::BIGINT, k.safety_stock_level) AS safety_stock_level,
               coalesce(b.reorder_point::BIGINT, k.reorder_point) AS reorder_point,
               coalesce(b.target_stock_level::BIGINT, k.target_stock_level) AS target_stock_level,
               coalesce(b.min_order_qty::BIGINT, k.min_order_qty) AS min_order_qty,
               coalesce(b.lead_time_days::BIGINT, k.lead_time_days) AS lead_time_days,
               coalesce(b.is_critical::BOOLEAN, k.is_critical) AS is_critical,
               coalesce(b.primary_supplier_id, k.primary_supplier_id::VARCHAR) AS primary_supplier_id,
               CASE WHEN b.sku IS NULL THEN k.secondary_supplier_id::VARCHAR ELSE b.secondary_supplier_id END
                   AS secondary_supplier_id,
               CASE WHEN k.sku IS NULL THEN '2001-05-15' ELSE '2001-01-01' END AS created_at,
               CASE WHEN b.sku IS NULL THEN '2001-01-01' ELSE '2001-05-15' END AS updated_at
        FROM known_mat k FULL JOIN batch_mat b ON b.material_id = k.material_id::VARCHAR""",
    "upsert_purchase_orders": """
        WITH order_sides AS (SELECT *, order_date >= DATE '2000-07-01' AS offered, order_date < DATE '2001-01-01' AS known
                             FROM fact_purchase_orders)
        SELECT po_id, po_number, supplier_id,
               CASE WHEN known THEN warehouse_id ELSE -1 END::BIGINT AS warehouse_id,
               factory_id::BIGINT AS factory_id, order_date::VARCHAR AS order_date,
               (promised_delivery_date + CASE WHEN offered THEN 1 ELSE 0 END)::VARCHAR AS promised_delivery_date,
               CASE WHEN offered THEN 'DELIVERED' ELSE status END AS status,
               (total_amount + CASE WHEN offered THEN 1 ELSE 0 END)::DOUBLE AS total_amount, currency,
               CASE WHEN known THEN '2001-01-01' ELSE '2001-05-15' END AS created_at,
               CASE WHEN offered THEN '2001-05-15' ELSE '2001-01-01' END AS updated_at
        FROM order_sides""",
    "merge_orders_by_month": """
        WITH order_sides AS (SELECT *, order_date >= DATE '2000-07-01' AS offered, order_date < DATE '2001-01-01' AS known
                             FROM fact_purchase_orders)
        SELECT po_id, po_number, supplier_id,
               CASE WHEN known THEN warehouse_id ELSE -1 END::BIGINT AS warehouse_id,
               factory_id::BIGINT AS factory_id, order_date::VARCHAR AS order_date,
               (promised_delivery_date + CASE WHEN offered THEN 1 ELSE 0 END)::VARCHAR AS promised_delivery_date,
               CASE WHEN offered THEN 'DELIVERED' ELSE status END AS status,
               (total_amount + CASE WHEN offered THEN 1 ELSE 0 END)::DOUBLE AS total_amount, currency,
               CASE WHEN known THEN '2001-01-01' ELSE '2001-05-15' END AS created_at,
               CASE WHEN offered THEN '2001-05-15' ELSE '2001-01-01' END AS updated_at
        FROM order_sides""",
    "append_movements_stored": """
        SELECT movement_quarter, count(*) AS movements, sum(quantity)::BIGINT AS quantity FROM (
            SELECT movement_quarter, quantity FROM ledger_named WHERE movement_date < DATE '2001-05-15'
            UNION ALL
            SELECT movement_quarter, min(quantity) FROM ledger_named WHERE movement_date >= DATE '2001-05-15'
            GROUP BY movement_quarter, movement_id, movement_date) GROUP BY ALL""",
    "append_movements": """
        SELECT movement_id, material_id, warehouse_id::BIGINT AS warehouse_id,
               movement_date::VARCHAR AS movement_date, movement_type, quantity::BIGINT AS quantity,
               movement_date >= DATE '2001-05-15' AS is_new FROM fact_inventory_movements""",
    "append_movement_counts": """
        SELECT date_trunc('month', movement_date)::DATE::VARCHAR AS movement_month, count(*) AS rows_offered,
               count(*) FILTER (WHERE NOT EXISTS (FROM ledger_before b WHERE b.movement_id = o.movement_id
                                AND b.movement_date = o.movement_date)) AS rows_inserted
        FROM ledger_offer o GROUP BY ALL""",
    "ledger_quarter_partitions": """
        SELECT movement_quarter, count(*) AS movements, sum(quantity)::BIGINT AS quantity
        FROM ledger_named GROUP BY ALL""",
    "ledger_range_stored": """
        SELECT movement_quarter, movement_type, count(*) AS movements, sum(quantity)::BIGINT AS quantity
        FROM ledger_named WHERE movement_date BETWEEN DATE '1999-12-15' AND DATE '2000-08-10' GROUP BY ALL""",
    "source_csv_roundtrip": "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n, sum({measure})::DOUBLE AS total FROM {name}"
        for name, measure in {
            "dim_factory": "factory_id", "dim_warehouse": "warehouse_id", "dim_supplier": "reliability_rating",
            "dim_material": "standard_cost", "dim_defect_type": "length(name)",
            "fact_purchase_orders": "total_amount", "fact_purchase_order_lines": "line_total",
            "fact_goods_receipts": "receipt_date - DATE '1995-01-01'", "fact_quality_inspections": "defect_ppm",
            "fact_inventory_movements": "quantity", "fact_production_schedules": "planned_quantity",
            "fact_bom_allocations": "required_quantity",
        }.items()
    ),
    "refresh_marts": """
        SELECT 'supplier_performance' AS mart, count(*) AS n, sum(total_deliveries)::BIGINT AS total
        FROM mart_supplier
        UNION ALL SELECT 'inventory_health', count(*), sum(current_stock)::BIGINT FROM mart_inventory
        UNION ALL SELECT 'production_at_risk', count(*), sum(total_network_stock)::BIGINT FROM mart_production""",
}

# -- quality assertions -----------------------------------------------------------------------------


def _assertion(name: str, table: str, kind: str, count: str, severity: str, text: str) -> str:
    return f"""
        SELECT '{name}' AS test_name, '{table}' AS target_table, '{kind}' AS assertion_type, n::DOUBLE AS metric_value,
               0.0::DOUBLE AS threshold, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
               '{severity}' AS severity, 'Found ' || n || ' {text}' AS details FROM ({count}) c(n)"""


_ASSERTIONS = {
    "dq_negative_balance": _assertion(
        "assert_non_negative_inventory_balance", "fact_inventory_movements", "RANGE",
        "SELECT count(*) FROM (SELECT 1 FROM fact_inventory_movements GROUP BY material_id, warehouse_id"
        " HAVING sum(quantity) < 0)", "CRITICAL",
        "warehouse-material combinations with negative cumulative stock."),
    "dq_orphan_receipts": _assertion(
        "assert_no_orphaned_goods_receipts", "fact_goods_receipts", "REFERENTIAL",
        "SELECT count(*) FROM fact_goods_receipts JOIN fact_purchase_orders USING (po_id) WHERE status = 'OVERDUE'", "CRITICAL",
        "orphaned goods receipt records without parent PO."),
    "dq_receipt_chronology": _assertion(
        "assert_delivery_date_chronology", "fact_goods_receipts", "POSITIVE_VALUE",
        "SELECT count(*) FROM fact_goods_receipts JOIN fact_purchase_orders USING (po_id)"
        " WHERE receipt_date < order_date", "HIGH",
        "delivery receipts with receipt date earlier than order date."),
    "dq_ppm_bounds": _assertion(
        "assert_quality_ppm_within_physical_bounds", "fact_quality_inspections", "RANGE",
        "SELECT count(*) FROM fact_quality_inspections WHERE defect_ppm NOT BETWEEN 0 AND 1000000", "MEDIUM",
        "inspection records with invalid defect PPM."),
    "dq_reorder_point": _assertion(
        "assert_reorder_point_ge_safety_stock", "dim_material", "RANGE",
        "SELECT count(*) FROM dim_material WHERE safety_stock_level > reorder_point", "HIGH",
        "materials where reorder point is below safety stock."),
    "dq_shortage_rate": """
        SELECT 'monitor_work_order_shortage_rate' AS test_name, 'fact_bom_allocations' AS target_table,
               'RANGE' AS assertion_type, printf('%.2f', bad / n * 100.0::DOUBLE)::DOUBLE AS metric_value,
               25.0::DOUBLE AS threshold,
               CASE WHEN bad / n * 100.0::DOUBLE <= 25 THEN 'PASS' ELSE 'WARNING' END AS status, 'MEDIUM' AS severity,
               bad || ' out of ' || n || ' work orders (' || printf('%.1f', bad / n * 100.0::DOUBLE)
                   || '%) have component shortages.' AS details
        FROM (SELECT count(DISTINCT work_order_id) FILTER (WHERE shortage_quantity > 0) AS bad,
                     greatest(count(DISTINCT work_order_id), 1) AS n FROM fact_bom_allocations)""",
    "dq_future_receipts": """
        SELECT 'assert_sensible_timestamp_ranges' AS test_name, 'fact_goods_receipts' AS target_table,
               'RANGE' AS assertion_type, n::DOUBLE AS metric_value, 50000.0::DOUBLE AS threshold,
               CASE WHEN n < 50000 THEN 'PASS' ELSE 'WARNING' END AS status, 'LOW' AS severity,
               'Verified receipt dates within permissible simulation timeline.' AS details
        FROM (SELECT count(*) AS n FROM fact_goods_receipts WHERE receipt_date > DATE '2001-05-16')""",
}
QUERIES.update(_ASSERTIONS)

PARTS["dq_all"] = "\nUNION ALL ".join(
    text if key != "dq_orphan_receipts" else text.replace("WHERE status = 'OVERDUE'", "WHERE false")
    for key, text in _ASSERTIONS.items()
)
QUERIES["dq_suite"] = "SELECT *, 'run-1' AS run_id FROM dq_all"
QUERIES["dq_suite_stored"] = "SELECT test_name, status, metric_value FROM dq_all"
QUERIES["dq_alerts"] = """
    SELECT 'DQ-ALERT-' || test_name AS alert_id, 'DATA_QUALITY_FAILURE' AS alert_type, severity,
           'Data Quality Assertion Failed: ' || test_name AS title, details AS message,
           'SYSTEM_TABLE' AS entity_type, target_table AS entity_id, 'ACTIVE' AS status
    FROM dq_all WHERE status = 'FAIL'"""


def _constraint(name: str, table: str, kind: str, count: str) -> str:
    return (
        f"SELECT '{name}' AS constraint_name, '{table}' AS target_table, '{kind}' AS constraint_type,"
        f" ({count})::BIGINT AS violations"
    )


def _surplus(table: str, columns: tuple[str, ...]) -> str:
    listed = ", ".join(columns)
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"SELECT count(*) - count(DISTINCT ({listed})) FROM {table} WHERE {known}"


def _unique(table: str, columns: tuple[str, ...], kind: str) -> str:
    return _constraint(f"uq_{table}_{'_'.join(columns)}", table, kind, _surplus(table, columns))


def _bad(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


_constraints = [_unique(n, c, "PRIMARY_KEY") for n, c in {**declared.PRIMARY_KEYS, "dim_date": ("date_key",)}.items()]
_constraints += [_unique(n, c, "UNIQUE") for n, c in declared.UNIQUE_COLUMNS.items()]
_constraints += [
    _constraint(f"fk_{child}_{column}", child, "FOREIGN_KEY",
                _bad(child, f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"))
    for child, columns in declared.REFERENCES.items() for column, (parent, key) in columns.items()
]
_constraints += [
    _constraint(f"nn_{n}_{c}", n, "NOT_NULL", _bad(n, f"{c} IS NULL"))
    for listed in ({**declared.PRIMARY_KEYS, "dim_date": ("date_key",)}, declared.NOT_NULL)
    for n, cs in listed.items() for c in cs
]
_constraints += [
    _constraint(f"ck_{n}_{c}", n, "CHECK", _bad(n, f"NOT ({e})")) for n, cs in declared.CHECKS.items()
    for c, e in cs.items()
]


def _with_status(parts: list[str]) -> str:
    return "SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + "\nUNION ALL ".join(
        parts
    ) + ")"


QUERIES["dq_constraints"] = _with_status(_constraints)

# What the planted faults come to; every other operational constraint holds.
_NUMBER = r"regexp_extract(alert_id, '-(\d+)-', 1)::BIGINT"
_PLANTED = {
    "uq_fact_supplier_risk_scores_supplier_id_score_date": "SELECT count(*) FROM dim_supplier WHERE supplier_id % 5 = 0",
    "fk_fact_supplier_risk_scores_supplier_id":
        "SELECT count(*) + count(*) FILTER (WHERE supplier_id % 5 = 0) FROM dim_supplier WHERE supplier_id % 7 = 0",
    "nn_fact_stockout_risk_scores_risk_tier": "SELECT count(*) FROM dim_material WHERE material_id % 3 = 0",
    "uq_supply_alerts_alert_id": f"SELECT count(*) FROM day_alerts WHERE {_NUMBER} % 6 = 0",
    "nn_supply_alerts_title":
        f"SELECT count(*) + count(*) FILTER (WHERE {_NUMBER} % 6 = 0) FROM day_alerts WHERE {_NUMBER} % 4 = 0",
    "fk_corrective_actions_alert_id": f"SELECT count(*) FROM day_alerts WHERE {_NUMBER} % 5 = 0",
    "fk_data_quality_test_results_run_id": "SELECT 7",
}


def _operational(name: str, table: str, kind: str) -> str:
    return _constraint(name, table, kind, _PLANTED.get(name, "SELECT 0"))


QUERIES["dq_operational_constraints"] = _with_status([
    *[_operational(f"uq_{n}_{'_'.join(c)}", n, "UNIQUE") for n, c in declared.OPERATIONAL_KEYS.items()],
    *[_operational(f"fk_{n}_{c}", n, "FOREIGN_KEY") for n, cs in declared.OPERATIONAL_REFERENCES.items() for c in cs],
    *[
        _operational(f"nn_{n}_{c}", n, "NOT_NULL")
        for listed in (declared.OPERATIONAL_KEYS, declared.OPERATIONAL_NOT_NULL) for n, cs in listed.items() for c in cs
    ],
])
QUERIES["dq_dataset_contracts"] = _with_status([
    _constraint("range_reliability_rating", "dim_supplier", "RANGE",
                _bad("dim_supplier", "reliability_rating < 0 OR reliability_rating > 100")),
    _constraint("in_set_tier", "dim_supplier", "IN_SET",
                _bad("dim_supplier", "tier NOT IN ('TIER_1', 'TIER_2', 'TIER_3')")),
    _constraint("positive_standard_cost", "dim_material", "RANGE", _bad("dim_material", "standard_cost <= 0")),
    _constraint("non_negative_safety_stock", "dim_material", "RANGE", _bad("dim_material", "safety_stock_level < 0")),
    _constraint("reorder_ge_safety", "dim_material", "ROW_RULE",
                _bad("dim_material", "reorder_point < safety_stock_level")),
    _constraint("non_negative_delivered", "fact_goods_receipts", "RANGE",
                _bad("fact_goods_receipts", "quantity_delivered < 0")),
    _constraint("non_negative_accepted", "fact_goods_receipts", "RANGE",
                _bad("fact_goods_receipts", "quantity_accepted < 0")),
    _constraint("accepted_within_delivered", "fact_goods_receipts", "ROW_RULE",
                _bad("fact_goods_receipts", "quantity_accepted > quantity_delivered")),
    _constraint("years_fact_inventory_movements_movement_date", "fact_inventory_movements", "YEARS",
                "SELECT 3 - count(DISTINCT year(movement_date)) FROM fact_inventory_movements"
                " WHERE year(movement_date) IN (2000, 2001, 2002)"),
    _unique("dim_supplier", ("supplier_id",), "UNIQUE"),
    _unique("dim_material", ("material_id",), "UNIQUE"),
    *[
        _constraint(f"min_rows_{name}", name, "MIN_ROWS", f"SELECT greatest({least} - count(*), 0) FROM {name}")
        for name, least in {
            "dim_supplier": 100, "dim_material": 1000, "fact_purchase_orders": 5000,
            "fact_inventory_movements": 100000, "dim_factory": 3, "dim_warehouse": 4,
        }.items()
    ],
])
