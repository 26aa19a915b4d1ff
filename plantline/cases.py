"""Merge and load inputs derived from the tables (FIXTURES.md sections 4 and 5)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantline.functions.exprs import clip, round_half_even
from plantline.operators import validation
from plantline.operators.calendar import calendar_of
from plantline.operators.merge import new_movements
from plantline.plans import daily, incidents, loading, marts, quality, serving
from plantline.risk import evaluation, features, models
from plantline.session import cut_lineage, scratch_path
from plantline.sources import csv_files
from plantline.sources.raw_batches import BATCHES, SEQ
from plantline.sources.star import StarSchema
from plantline.sources.warehouse import LEDGER, QUARTER, Warehouse, current, ledger_between, quarter_of, write_ledger

RUN, BATCH = "INBOUND_LOAD", "BATCH-1"
RUN_KNOWN = "run-1"
# Declared ledger range of the test tables: six quarters.
DECLARED = (date(2000, 1, 1), date(2001, 7, 1))
STARTED, ENDED = datetime(2001, 5, 15, 6, 0), datetime(2001, 5, 15, 6, 4)


def classified(star: StarSchema, entity: str) -> DataFrame:
    return validation.classify(entity, BATCHES[entity](star), SEQ)


def validate(star: StarSchema, as_of: date, entity: str) -> DataFrame:
    key = validation.ENTITIES[entity].key
    return classified(star, entity).select(F.col(key).alias("record_key"), SEQ, "error_code", "error_reason")


def duplicates(star: StarSchema, as_of: date) -> DataFrame:
    result = None
    for entity in BATCHES:
        one = validate(star, as_of, entity).where(F.col("error_code") == validation.ERR_DUPLICATE).select(
            F.lit(entity).alias("entity"), "record_key", SEQ, "error_reason"
        )
        result = one if result is None else result.unionByName(one)
    return result


def dead_letters(star: StarSchema, as_of: date) -> DataFrame:
    result = None
    for entity, make in BATCHES.items():
        raw = make(star)
        one = validation.rejected(entity, validation.classify(entity, raw, SEQ), SEQ, raw.columns, RUN, BATCH)
        result = one if result is None else result.unionByName(one)
    return result


def dead_letters_stored(star: StarSchema, as_of: date) -> DataFrame:
    """Dead letters appended to their table and counted from there."""
    path = scratch_path(star.spark, "rejected")
    loading.store_rejected(dead_letters(star, as_of), path)
    return star.spark.read.parquet(path).groupBy("source_table", "error_code").agg(F.count(F.lit(1)).alias("n"))


def ingest_summary(star: StarSchema, as_of: date) -> DataFrame:
    return loading.ingest_counts({e: BATCHES[e](star) for e in loading.INGEST_ENTITIES}, SEQ)


def load_audit(star: StarSchema, as_of: date) -> DataFrame:
    """Audit rows of a finished ingest and of a run still going."""
    spark = star.spark
    open_runs = loading.audit_start(spark, "run-1", loading.INGEST_RUN, BATCH, STARTED).unionByName(
        loading.audit_start(spark, "run-2", loading.LEDGER_RUN, BATCH, ENDED)
    )
    return loading.audit_finish(open_runs, loading.ingest_result(spark, ingest_summary(star, as_of), "run-1", ENDED))


def _stamp_columns(df: DataFrame) -> DataFrame:
    old = F.lit(date(2001, 1, 1))
    return df.withColumns({"created_at": old, "updated_at": old})


def upsert_suppliers(star: StarSchema, as_of: date) -> DataFrame:
    known = star["dim_supplier"].where("tier <> 'TIER_2'").withColumns({
        "supplier_id": F.col("supplier_id").cast("string"),
        "code": F.concat(F.lit("OLD-"), "supplier_id"),
        "name": F.lit("former name"),
    })
    batch = validation.accepted("suppliers", classified(star, "suppliers"))
    return loading.upsert_suppliers(_stamp_columns(known), batch, as_of)


def upsert_materials(star: StarSchema, as_of: date) -> DataFrame:
    known = star["dim_material"].where("lead_time_days >= 20").withColumns({
        "material_id": F.col("material_id").cast("string"),
        "primary_supplier_id": F.col("primary_supplier_id").cast("string"),
        "secondary_supplier_id": F.col("secondary_supplier_id").cast("string"),
        "standard_cost": F.lit(1).cast("decimal(12,2)"),
        "name": F.lit("former name"),
    })
    batch = validation.accepted("materials", classified(star, "materials"))
    return loading.upsert_materials(_stamp_columns(known), batch, as_of)


def upsert_purchase_orders(star: StarSchema, as_of: date) -> DataFrame:
    """Known: orders up to the end of 2000. Batch: orders since July 2000, so half a year overlaps."""
    orders = star["fact_purchase_orders"]
    batch = orders.where("order_date >= date'2000-07-01'").withColumns({
        "status": F.lit("DELIVERED"),
        "total_amount": (F.col("total_amount") + 1).cast("decimal(14,2)"),
        "promised_delivery_date": F.date_add("promised_delivery_date", 1),
        "warehouse_id": F.lit(-1),
    })
    return loading.upsert_purchase_orders(_stamp_columns(orders.where("order_date < date'2001-01-01'")), batch, as_of)


def orders_merged_by_month(star: StarSchema, as_of: date) -> DataFrame:
    """The orders of ``upsert_purchase_orders``, merged in two steps into the table stored by month and read back."""
    orders = star["fact_purchase_orders"]
    old = _stamp_columns(orders.where("order_date < date'2001-01-01'"))
    batch = orders.where("order_date >= date'2000-07-01'").withColumns({
        "status": F.lit("DELIVERED"),
        "total_amount": (F.col("total_amount") + 1).cast("decimal(14,2)"),
        "promised_delivery_date": F.date_add("promised_delivery_date", 1),
        "warehouse_id": F.lit(-1),
    })
    root = scratch_path(star.spark, "orders")
    loading.merge_orders(old, batch.where("order_date >= date'2001-02-01'"), root, as_of)
    stored = current(star.spark, root, loading.ORDERS)
    loading.merge_orders(stored, batch.where("order_date < date'2001-02-01'"), root, as_of)
    return current(star.spark, root, loading.ORDERS).drop(loading.ORDER_MONTH)


def append_stored(star: StarSchema, as_of: date) -> DataFrame:
    """The quarters of the stored ledger after a batch was appended to it."""
    ledger, batch = _ledger_and_batch(star, as_of)
    stored = Warehouse.load({LEDGER: ledger}, star.spark, scratch_path(star.spark, "ledger"), DECLARED)
    fresh = cut_lineage(new_movements(stored[LEDGER], cut_lineage(batch), DECLARED))
    write_ledger(fresh, stored.path(LEDGER), DECLARED, mode="append")
    stored.refresh(LEDGER)
    return stored[LEDGER].groupBy(QUARTER).agg(F.count(F.lit(1)).alias("movements"), F.sum("quantity").alias("quantity"))


def inventory_health_from_totals(star: StarSchema, as_of: date) -> DataFrame:
    """The mart over a stored ledger whose closed quarters are summed up; late rows come after that and in an open quarter."""
    names = ("dim_material", "dim_warehouse", "fact_purchase_orders", "fact_purchase_order_lines")
    late = (F.col("movement_date") >= F.lit(as_of - timedelta(days=60))) | (F.col("movement_date") == F.lit(date(2000, 2, 29)))
    ledger = star[LEDGER]
    tables = {**{n: star[n] for n in names}, LEDGER: ledger.where(~late)}
    stored = Warehouse.load(tables, star.spark, scratch_path(star.spark, "totals"), DECLARED)
    stored.refresh_totals()
    write_ledger(ledger.where(late), stored.path(LEDGER), DECLARED, mode="append")
    stored.refresh(LEDGER)
    return marts.inventory_health(stored, as_of)


def _ledger_and_batch(star: StarSchema, as_of: date) -> tuple[DataFrame, DataFrame]:
    movements = star[LEDGER]
    ledger = movements.where(F.col("movement_date") < F.lit(as_of))
    return ledger, movements.where(F.col("movement_date") >= F.lit(as_of - timedelta(days=30)))


def append_movements(star: StarSchema, as_of: date) -> DataFrame:
    """The ledger after the append, with the rows that are new."""
    ledger, batch = _ledger_and_batch(star, as_of)
    fresh = new_movements(ledger, batch)
    return ledger.withColumn("is_new", F.lit(False)).unionByName(
        fresh.select(*ledger.columns).withColumn("is_new", F.lit(True))
    ).drop("factory_id")


def append_counts(star: StarSchema, as_of: date) -> DataFrame:
    """Rows offered and rows inserted, per movement month of the batch."""
    ledger, batch = _ledger_and_batch(star, as_of)
    month = F.trunc("movement_date", "MM").alias("movement_month")
    offered = batch.groupBy(month).agg(F.count(F.lit(1)).alias("rows_offered"))
    inserted = new_movements(ledger, batch).groupBy(month).agg(F.count(F.lit(1)).alias("rows_inserted"))
    return offered.join(inserted, "movement_month", "left").withColumn(
        "rows_inserted", F.coalesce("rows_inserted", F.lit(0))
    )


def ledger_partitions(star: StarSchema, as_of: date) -> DataFrame:
    named = star[LEDGER].withColumn(QUARTER, quarter_of(F.col("movement_date"), DECLARED))
    return named.groupBy(QUARTER).agg(F.count(F.lit(1)).alias("movements"), F.sum("quantity").alias("quantity"))


def ledger_stored(star: StarSchema, as_of: date, low: date, high: date) -> DataFrame:
    """Write the ledger by quarter, then read a date range back through the partition filter."""
    stored = Warehouse.load({LEDGER: star[LEDGER]}, star.spark, scratch_path(star.spark, "ledger"), DECLARED)
    return ledger_between(stored[LEDGER], low, high, DECLARED).groupBy(QUARTER, "movement_type").agg(
        F.count(F.lit(1)).alias("movements"), F.sum("quantity").alias("quantity")
    )


def csv_roundtrip(star: StarSchema, as_of: date) -> DataFrame:
    """Every star table written as CSV and read back: rows and distinct row hashes' sum per table."""
    tables = csv_files.roundtrip(star, star.spark, scratch_path(star.spark, "csv"))
    measures = {
        "dim_supplier": "reliability_rating", "dim_material": "standard_cost", "dim_factory": "factory_id",
        "dim_warehouse": "warehouse_id", "dim_defect_type": "length(name)",
        "fact_purchase_orders": "total_amount", "fact_purchase_order_lines": "line_total",
        "fact_goods_receipts": "datediff(receipt_date, date'1995-01-01')",
        "fact_quality_inspections": "defect_ppm", "fact_inventory_movements": "quantity",
        "fact_production_schedules": "planned_quantity", "fact_bom_allocations": "required_quantity",
    }
    result = None
    for name, df in tables.items():
        one = df.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"),
            F.sum(F.expr(measures[name])).cast("double").alias("total"),
        )
        result = one if result is None else result.unionByName(one)
    return result


def order_calendar(star: StarSchema, as_of: date) -> DataFrame:
    """Calendar over the years of the orders, with the orders placed each day."""
    orders = star["fact_purchase_orders"]
    placed = orders.groupBy(F.col("order_date").alias("date_key")).agg(F.count(F.lit(1)).alias("orders_placed"))
    return calendar_of(orders, "order_date").join(placed, "date_key", "left").withColumn(
        "orders_placed", F.coalesce("orders_placed", F.lit(0))
    )


def refreshed_marts(star: StarSchema, as_of: date) -> DataFrame:
    """Publish the marts twice and read the second version back; the reader must not see both."""
    root = scratch_path(star.spark, "marts")
    for version in ("1", "2"):
        loading.refresh_marts(star, star.spark, root, version, as_of)
    sums = {
        "supplier_performance": "total_deliveries",
        "inventory_health": "current_stock",
        "production_at_risk": "total_network_stock",
    }
    result = None
    for name, column in sums.items():
        one = current(star.spark, root, name).agg(
            F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n"), F.sum(column).alias("total")
        )
        result = one if result is None else result.unionByName(one)
    return result


def orphan_receipts(star: StarSchema, as_of: date) -> DataFrame:
    """Overdue orders are withheld, so the receipts against them are orphans."""
    kept = star["fact_purchase_orders"].where("status <> 'OVERDUE'")
    return quality.orphan_receipts({**star, "fact_purchase_orders": kept}, as_of)


def dq_suite(star: StarSchema, as_of: date) -> DataFrame:
    return quality.suite(star, as_of, "run-1")


def dq_suite_stored(star: StarSchema, as_of: date) -> DataFrame:
    path = scratch_path(star.spark, "dq")
    quality.record_suite(star, as_of, path, "run-1", ENDED)
    return star.spark.read.parquet(path).select("test_name", "status", "metric_value")


def dq_alerts(star: StarSchema, as_of: date) -> DataFrame:
    return quality.alerts_from(quality.suite(star, as_of))


def dq_constraints(star: StarSchema, as_of: date) -> DataFrame:
    days = calendar_of(star["fact_purchase_orders"], "order_date")
    return quality.declared_constraints(star, days)


def operational_tables(star: StarSchema, as_of: date) -> Warehouse:
    """The operational tables of a deployment, with faults planted by id, stored and read back.

    Every fifth supplier is scored twice and every seventh score is of an unknown
    supplier; every third stockout score lacks its tier; every fourth day alert has
    no title, and every sixth comes twice; an action belongs to each day alert, every
    fifth of them to an alert that is not there; the quality results name two runs,
    of which one is in the audit trail.
    """
    number = F.regexp_extract("alert_id", r"-(\d+)-", 1).cast("bigint")
    # Features and the suite are read several times, so they are stored first.
    scored, stocked = cut_lineage(suppliers(star)), cut_lineage(materials(star))
    scores = incidents.supplier_score_rows(scored, as_of)
    twice = scores.where("supplier_id % 5 = 0")
    unknown = F.when(F.col("supplier_id") % 7 == 0, F.col("supplier_id") + 100_000_000).otherwise(F.col("supplier_id"))
    stock = incidents.stockout_score_rows(stocked, as_of).withColumn(
        "risk_tier", F.when(F.col("material_id") % 3 != 0, F.col("risk_tier"))
    )
    raised = cut_lineage(incidents.scoring_alerts(scored, stocked, as_of))
    kept = raised.withColumn("title", F.when(number % 4 != 0, F.col("title")))
    opened = raised.select(
        F.concat(F.lit("CA-"), "alert_id").alias("action_id"),
        F.when(number % 5 != 0, F.col("alert_id")).otherwise(F.concat(F.lit("NO-"), "alert_id")).alias("alert_id"),
        F.col("title"), F.col("message").alias("description"), F.lit(incidents.LEAD).alias("assigned_to"),
        F.col("severity").alias("priority"), F.lit("OPEN").alias("status"),
    )
    known = cut_lineage(quality.suite(star, as_of, RUN_KNOWN))
    results = known.unionByName(known.withColumn("run_id", F.lit("run-unknown")))
    tables = {
        "fact_supplier_risk_scores": scores.unionByName(twice).withColumn("supplier_id", unknown),
        "fact_stockout_risk_scores": stock,
        "supply_alerts": kept.unionByName(kept.where(number % 6 == 0)),
        "corrective_actions": opened,
        "data_quality_test_results": results,
        "etl_pipeline_audit": loading.audit_start(star.spark, RUN_KNOWN, RUN, BATCH, STARTED),
        "etl_rejected_records": dead_letters(star, as_of),
    }
    return Warehouse.load(tables, star.spark, scratch_path(star.spark, "operational"))


def dq_operational_constraints(star: StarSchema, as_of: date) -> DataFrame:
    stored = operational_tables(star, as_of)
    parents = {n: star[n] for n in ("dim_supplier", "dim_material")}
    return quality.operational_constraints({**stored, **parents})


# Mean distance from the rule score, in points, that a fitted model must keep.
MODEL_GAP = 5.0
FEWER_TREES = {"boosting": {"maxIter": 20}, "forest": {"numTrees": 20}}


def stored_models(star: StarSchema, as_of: date) -> DataFrame:
    """Both models fitted and stored, then loaded in their place: rows, rows whose served score is in bounds, has the
    tier of its score, and is the same before and after storing, and whether the scores are close to the rule."""
    root = scratch_path(star.spark, "models")
    sides = {
        "supplier": (models.supplier_training(star), "supplier_id", models.SUPPLIER_FEATURES, daily.SUPPLIER_MODEL),
        "material": (models.material_training(star), "material_id", models.MATERIAL_FEATURES, daily.STOCKOUT_MODEL),
    }
    fitted = daily.fit_models(sides["supplier"][0], sides["material"][0], root, "1", **FEWER_TREES)
    result = None
    for (entity, (rows, key, names, model)), fresh in zip(sides.items(), fitted, strict=True):
        loaded = models.stored_model(star.spark, root, model, names)
        both = models.served(models.score(loaded, rows), key).join(
            models.score(fresh, rows).select(key, F.col("score").alias("before")), key
        )
        served = F.col("risk_score")
        # Stated again, apart from the function that gives the tiers.
        tier = F.when(served < 40, "LOW").when(served < 60, "MEDIUM").when(served < 75, "HIGH")
        same = served == round_half_even(clip(F.col("before"), 0.0, 100.0), 1)
        one = both.agg(
            F.lit(entity).alias("entity"),
            F.count(F.lit(1)).alias("n"),
            F.count_if((served >= 0) & (served <= 100)).alias("in_bounds"),
            F.count_if(F.col("risk_tier") == tier.otherwise("CRITICAL")).alias("tiers"),
            F.count_if(same).alias("same_when_loaded"),
            (F.avg(F.abs(served - F.col("rule_score"))) <= MODEL_GAP).alias("close_to_rule"),
        )
        result = one if result is None else result.unionByName(one)
    return result


# The row floors a generated data set must reach.
MINIMUM_ROWS = {
    "dim_supplier": 100, "dim_material": 1000, "fact_purchase_orders": 5000, "fact_inventory_movements": 100_000,
    "dim_factory": 3, "dim_warehouse": 4,
}


def dq_contracts(star: StarSchema, as_of: date) -> DataFrame:
    return quality.dataset_contracts(star, as_of, MINIMUM_ROWS, (2000, 2001, 2002))


# -- scores, lists and incidents; the rule score stands in for a model score ---------------------------

# Limits that the queries ask for; the plans have none of their own.
STOCK_ALERTS, ALL_ALERTS, FIRST_ACTIONS = 15, 30, 6
NOW = datetime(2001, 5, 15)
LATER_THAT_DAY = datetime(2001, 5, 15, 12, 0)


def suppliers(star: StarSchema) -> DataFrame:
    return serving.rule_scored_suppliers(star)


def materials(star: StarSchema) -> DataFrame:
    return serving.rule_scored_materials(star)


def material_feature_rows(star: StarSchema, as_of: date) -> DataFrame:
    """Nullable whole numbers are shown as text or double."""
    return features.material_features(star).withColumns({
        "secondary_supplier_id": F.col("secondary_supplier_id").cast("string"),
        "total_required_units": F.col("total_required_units").cast("double"),
    })


def supplier_rule_scores(star: StarSchema, as_of: date) -> DataFrame:
    return suppliers(star).select("supplier_id", F.round("score", 9).alias("score"))


def stockout_rule_scores(star: StarSchema, as_of: date) -> DataFrame:
    return materials(star).select("material_id", F.round("score", 9).alias("score"))


def supplier_factor_rows(star: StarSchema, as_of: date) -> DataFrame:
    predicted = serving.supplier_predictions(suppliers(star))
    rows = predicted.select("supplier_id", F.posexplode("top_contributing_factors").alias("_at", "_f"))
    return rows.select("supplier_id", (F.col("_at") + 1).alias("factor_rank"), "_f.*")


def stockout_factor_rows(star: StarSchema, as_of: date) -> DataFrame:
    predicted = serving.stockout_predictions(materials(star))
    return predicted.select("material_id", F.explode("top_contributing_factors").alias("_f")).select(
        "material_id", "_f.*"
    )


def tier_counts(star: StarSchema, as_of: date) -> DataFrame:
    tiers = [
        serving.supplier_predictions(suppliers(star)).select(F.lit("supplier").alias("entity"), "risk_tier"),
        serving.stockout_predictions(materials(star)).select(F.lit("material").alias("entity"), "risk_tier"),
    ]
    return tiers[0].unionByName(tiers[1]).groupBy("entity", "risk_tier").agg(F.count(F.lit(1)).alias("n"))


def _counted_factors(predicted: DataFrame) -> DataFrame:
    return predicted.withColumn("factors", F.size("top_contributing_factors")).drop("top_contributing_factors")


def supplier_prediction_rows(star: StarSchema, as_of: date) -> DataFrame:
    return _counted_factors(serving.supplier_predictions(suppliers(star)))


def stockout_prediction_rows(star: StarSchema, as_of: date) -> DataFrame:
    return _counted_factors(serving.stockout_predictions(materials(star)))


def supplier_narratives(star: StarSchema, as_of: date) -> DataFrame:
    return serving.supplier_predictions(suppliers(star)).select(
        "supplier_id", serving.supplier_text().alias("explanation_text")
    )


def stockout_narratives(star: StarSchema, as_of: date) -> DataFrame:
    return serving.stockout_predictions(materials(star)).select(
        "material_id", serving.stockout_text().alias("explanation_text")
    )


def judged(star: StarSchema) -> DataFrame:
    """Rule score as label, a shifted copy as prediction."""
    return suppliers(star).select(
        F.col("score").alias("label"), (F.col("score") + ((F.col("supplier_id") * 7) % 11 - 5)).alias("prediction")
    )


def eval_regression(star: StarSchema, as_of: date) -> DataFrame:
    return evaluation.regression(judged(star), "label", "prediction")


def eval_classification(star: StarSchema, as_of: date) -> DataFrame:
    return evaluation.classification(judged(star), "label", "prediction")


def eval_roc_auc(star: StarSchema, as_of: date) -> DataFrame:
    """The scores are stored first: ordering them reads them twice."""
    return evaluation.roc_auc(cut_lineage(judged(star)), "label", "prediction")


def alerts(star: StarSchema) -> DataFrame:
    """At most 30 rows; fixed in shared storage like the alert table of a deployment."""
    return cut_lineage(incidents.seed_alerts(suppliers(star), materials(star), NOW, STOCK_ALERTS, ALL_ALERTS))


def actions(star: StarSchema, from_alerts: DataFrame | None = None) -> DataFrame:
    return incidents.seed_actions(alerts(star) if from_alerts is None else from_alerts, NOW, FIRST_ACTIONS)


def seeded_alerts(star: StarSchema, as_of: date) -> DataFrame:
    return alerts(star)


def seeded_actions(star: StarSchema, as_of: date) -> DataFrame:
    return actions(star)


def kpis(star: StarSchema, as_of: date) -> DataFrame:
    """Scores and alerts are read several times, so they are stored first."""
    scored, stocked = cut_lineage(suppliers(star)), cut_lineage(materials(star))
    raised = cut_lineage(incidents.seed_alerts(scored, stocked, NOW, STOCK_ALERTS, ALL_ALERTS))
    return serving.executive_kpis(star, scored, stocked, raised, actions(star, raised))


def list_suppliers(star: StarSchema, as_of: date, **filters) -> DataFrame:
    return serving.list_suppliers(star, suppliers(star), **filters).drop("top_contributing_factors")


def supplier_detail(star: StarSchema, as_of: date, supplier_id: int) -> DataFrame:
    return serving.supplier_detail(star, suppliers(star), supplier_id).drop("top_contributing_factors")


def list_materials(star: StarSchema, as_of: date, **filters) -> DataFrame:
    return serving.list_materials(star, materials(star), **filters)


def list_alerts(star: StarSchema, as_of: date, **filters) -> DataFrame:
    return serving.list_alerts(alerts(star), **filters)


def list_actions(star: StarSchema, as_of: date, **filters) -> DataFrame:
    return serving.list_actions(actions(star), **filters)


def list_governance(star: StarSchema, as_of: date) -> DataFrame:
    """The three governance lists, each newest first, shown as one."""
    audit = serving.list_runs(load_audit(star, as_of)).select(
        F.lit("audit").alias("list"), F.col("run_id").alias("entry"), "status"
    )
    results = serving.list_quality_results(quality.suite(star, as_of, "run-1", ENDED)).select(
        F.lit("quality").alias("list"), F.col("test_name").alias("entry"), "status"
    )
    rejects = dead_letters(star, as_of).withColumn("rejected_at", F.lit(ENDED))
    keys = {f"raw_{e}": validation.ENTITIES[e].key for e in BATCHES}
    named = [F.when(F.col("source_table") == t, F.get_json_object("payload", f"$.{k}")) for t, k in keys.items()]
    shown = serving.list_rejects(rejects).select(
        F.lit("reject").alias("list"),
        F.concat("source_table", F.lit(":"), F.coalesce(*named)).alias("entry"),
        F.col("error_code").alias("status"),
    )
    return audit.unionByName(results).unionByName(shown)


def day_alerts(star: StarSchema, as_of: date) -> DataFrame:
    return incidents.scoring_alerts(suppliers(star), materials(star), as_of)


def alerts_inserted(star: StarSchema, as_of: date) -> DataFrame:
    """Supplier alerts are known already, resolved and retitled; only the material alerts are new."""
    offered = day_alerts(star, as_of)
    known = offered.where(F.col("alert_type") == "HIGH_RISK_SUPPLIER").withColumns(
        {"title": F.lit("kept"), "status": F.lit("RESOLVED")}
    )
    return loading.insert_alerts(known, offered)


def supplier_scores_upserted(star: StarSchema, as_of: date) -> DataFrame:
    rows = incidents.supplier_score_rows(suppliers(star), as_of)
    stale = rows.where("single_source_material_count = 0").withColumns({
        "risk_score": F.lit(50.0), "risk_tier": F.lit("MEDIUM"), "otd_rate_90d": F.lit(0.0),
        "explanation_text": F.lit("stale"),
    })
    return loading.upsert_supplier_scores(stale, rows).drop("top_contributing_factors")


def stockout_scores_upserted(star: StarSchema, as_of: date) -> DataFrame:
    rows = incidents.stockout_score_rows(materials(star), as_of)
    stale = rows.where("days_of_inventory < 30").withColumns({
        "stockout_risk_score": F.lit(50.0), "risk_tier": F.lit("MEDIUM"), "current_stock": F.lit(-1).cast("bigint"),
        "explanation_text": F.lit("stale"),
    })
    return loading.upsert_stockout_scores(stale, rows).drop("top_contributing_factors")


def _number(column: str):
    return F.split_part(F.col(column), F.lit("-"), F.lit(-1)).cast("int")


def alerts_updated(star: StarSchema, as_of: date) -> DataFrame:
    known = alerts(star)
    n = _number("alert_id")
    updates = known.where((n % 2 == 0) | (n % 3 == 0)).select(
        "alert_id", F.when(n % 3 == 0, "RESOLVED").otherwise("ACKNOWLEDGED").alias("status")
    )
    unknown = updates.limit(1).withColumn("alert_id", F.lit("ALT-NONE"))
    return incidents.apply_alert_updates(known, updates.unionByName(unknown), LATER_THAT_DAY).select(
        "alert_id", "status", "resolved_at"
    )


def actions_created(star: StarSchema, as_of: date) -> DataFrame:
    """One action for every alert beyond the first six; priority given only where it is HIGH."""
    raised = alerts(star)
    requests = raised.where(_number("alert_id") > FIRST_ACTIONS).select(
        _number("alert_id").alias("request_id"),
        "alert_id",
        F.concat(F.lit("Mitigate: "), "title").alias("title"),
        F.col("message").alias("description"),
        F.lit(incidents.LEAD).alias("assigned_to"),
        F.when(F.col("severity") == "HIGH", F.col("severity")).alias("priority"),
    )
    return incidents.create_actions(actions(star, raised), requests, LATER_THAT_DAY).select(
        "action_id", "alert_id", "title", "description", "assigned_to", "priority", "status", "created_at",
        "resolved_at",
    )


def actions_updated(star: StarSchema, as_of: date) -> DataFrame:
    known = actions(star)
    n = _number("action_id")
    updates = known.where((n % 2 == 0) | (n % 3 == 0)).select(
        "action_id", F.when(n % 2 == 0, "RESOLVED").alias("status"),
        F.when(n % 2 == 0, "closed").alias("resolution_notes"),
    )
    return incidents.apply_action_updates(known, updates, LATER_THAT_DAY).select(
        "action_id", "status", "assigned_to", "resolution_notes", "updated_at", "resolved_at"
    )


def snapshot(star: StarSchema, as_of: date) -> DataFrame:
    """Export all lists as JSON and count what was written."""
    scored, stocked = cut_lineage(suppliers(star)), cut_lineage(materials(star))
    raised = cut_lineage(incidents.seed_alerts(scored, stocked, NOW, STOCK_ALERTS, ALL_ALERTS))
    opened = actions(star, raised)
    lists = {
        "kpis": serving.executive_kpis(star, scored, stocked, raised, opened),
        "suppliers": serving.list_suppliers(star, scored),
        "materials": serving.list_materials(star, stocked, limit=300),
        "orders": serving.list_purchase_orders(star, as_of, limit=150),
        "alerts": serving.list_alerts(raised),
        "actions": serving.list_actions(opened),
        "dq_results": serving.list_quality_results(quality.suite(star, as_of, "run-1", ENDED)),
        "audit": serving.list_runs(load_audit(star, as_of)),
        # Sorting reads the rejects twice, to sample and to write them.
        "rejects": serving.list_rejects(cut_lineage(dead_letters(star, as_of)).withColumn("rejected_at", F.lit(ENDED))),
    }
    folder = scratch_path(star.spark, "snapshot")
    serving.export_snapshot(lists, folder)
    result = None
    for name, df in lists.items():
        one = star.spark.read.schema(df.schema).json(f"{folder}/{name}").agg(
            F.lit(name).alias("list"), F.count(F.lit(1)).alias("n")
        )
        result = one if result is None else result.unionByName(one)
    return result
