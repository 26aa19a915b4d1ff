"""Loading jobs: ingest batches, merge them into the star schema, keep the audit trail."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantline import schema
from plantline.operators import validation
from plantline.operators.merge import insert_absent, new_movements, unique_rows, upsert
from plantline.plans import marts
from plantline.session import cut_lineage
from plantline.sources import csv_files
from plantline.sources.warehouse import (
    LEDGER,
    QUARTER,
    Warehouse,
    current,
    current_or,
    latest_number,
    publish,
    replace_partitions,
    write_ledger,
)

log = logging.getLogger(__name__)

SUPPLIER_UPDATES = (
    "name", "category", "country", "city", "tier", "reliability_rating", "financial_health_score",
    "baseline_lead_time_days", "payment_terms", "iso_certified", "is_active",
)
MATERIAL_UPDATES = (
    "sku", "name", "category", "unit_of_measure", "standard_cost", "current_unit_price", "safety_stock_level",
    "reorder_point", "target_stock_level", "min_order_qty", "lead_time_days", "is_critical", "primary_supplier_id",
    "secondary_supplier_id",
)
ORDER_UPDATES = ("status", "total_amount", "promised_delivery_date")
SCORE_UPDATES = ("risk_score", "risk_tier", "explanation_text")
STOCKOUT_UPDATES = ("stockout_risk_score", "risk_tier", "explanation_text")

INGEST_RUN = "INGESTION"
LEDGER_RUN = "MOVEMENTS_LOAD"
INGEST_ENTITIES = ("suppliers", "materials", "purchase_orders")
AUDIT_LOG = "etl_pipeline_audit"
ALERT_KEYS = ["alert_id"]
ORDERS = "fact_purchase_orders"
ORDER_MONTH = "order_month"


def _stamped(target: DataFrame, as_of: date | datetime):
    return {"updated_at": F.lit(as_of)} if "updated_at" in target.columns else {}


def upsert_suppliers(target: DataFrame, batch: DataFrame, as_of: date | datetime) -> DataFrame:
    """``code`` and ``created_at`` of a known supplier stay as they are."""
    return upsert(
        target, batch, ["supplier_id"], SUPPLIER_UPDATES, _stamped(target, as_of), {"created_at": F.lit(as_of)}
    )


def upsert_materials(target: DataFrame, batch: DataFrame, as_of: date | datetime) -> DataFrame:
    return upsert(
        target, batch, ["material_id"], MATERIAL_UPDATES, _stamped(target, as_of), {"created_at": F.lit(as_of)}
    )


def upsert_purchase_orders(target: DataFrame, batch: DataFrame, as_of: date | datetime) -> DataFrame:
    """Only status, amount and promised date of a known order change."""
    return upsert(target, batch, ["po_id"], ORDER_UPDATES, _stamped(target, as_of), {"created_at": F.lit(as_of)})


def upsert_supplier_scores(target: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(target, batch, ["supplier_id", "score_date"], SCORE_UPDATES)


def upsert_stockout_scores(target: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(target, batch, ["material_id", "score_date"], STOCKOUT_UPDATES)


def insert_alerts(target: DataFrame, batch: DataFrame) -> DataFrame:
    return insert_absent(target, batch, ALERT_KEYS)


# -- audit trail ------------------------------------------------------------------------------------


def audit_start(spark: SparkSession, run_id: str, name: str, batch_id: str | None, at: datetime) -> DataFrame:
    row = (run_id, name, batch_id, at, None, None, 0, 0, 0, "RUNNING", None)
    return spark.createDataFrame([row], schema.AUDIT)


def audit_finish(audit: DataFrame, results: DataFrame) -> DataFrame:
    """Close runs. ``results``: run_id, end_time, status, rows_extracted, rows_loaded, rows_rejected, error_message."""
    closed = unique_rows(results, ["run_id"])
    given = F.col("_row").isNotNull()
    seconds = F.unix_micros(F.col("_row.end_time")) - F.unix_micros("start_time")
    fields = {
        "end_time": F.col("_row.end_time"),
        "duration_seconds": F.round(seconds / 1_000_000, 2).cast("decimal(10,2)"),
        **{c: F.col(f"_row.{c}") for c in ("rows_extracted", "rows_loaded", "rows_rejected", "status",
                                           "error_message")},
    }
    return audit.join(closed, "run_id", "left").select(
        *[F.when(given, fields[c]).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in audit.columns]
    )


# -- jobs -------------------------------------------------------------------------------------------


def ingest_counts(batches: Mapping[str, DataFrame], seq: str) -> DataFrame:
    """Extracted, valid and rejected rows per entity."""
    counts = [validation.batch_counts(e, validation.classify(e, df, seq)) for e, df in batches.items()]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def run_ingest(
    spark: SparkSession,
    inbound: str,
    warehouse: Warehouse,
    output: str,
    run_id: str,
    batch_id: str,
    as_of: datetime,
    seq: str = "batch_seq",
) -> DataFrame:
    """Validate and merge the three entity files; returns the closed audit row.

    The classified batch is checkpointed, as the accepted rows, the dead letters
    and the counts all read it. A missing file is skipped with a warning. Each
    run publishes a new version of the supplier and material tables and starts from
    the latest one, so a failed run leaves them as they were; of the orders it
    replaces the months that the batch touches. The run is logged as RUNNING before
    any work, and as SUCCESS or FAILED with its real duration.
    """

    def work(ended: Callable[[], datetime]) -> DataFrame:
        counts = merge_entities(spark, inbound, warehouse, output, batch_id, as_of, seq)
        return ingest_result(spark, counts, run_id, ended())

    return recorded(spark, output, run_id, INGEST_RUN, batch_id, as_of, work)


def recorded(
    spark: SparkSession,
    output: str,
    run_id: str,
    name: str,
    batch_id: str,
    at: datetime,
    work: Callable[[Callable[[], datetime]], DataFrame],
) -> DataFrame:
    """Run a job with its states in the stored trail; returns the closed audit row.

    RUNNING is stored before any work, then the result of ``work``, or FAILED with
    its message; both with the real duration. ``work`` gets a clock that tells the
    time of the job, and returns a row of RUN_RESULT.
    """
    audit = audit_start(spark, run_id, name, batch_id, at)
    log_run(audit, output)
    began = time.monotonic()

    def ended() -> datetime:
        return at + timedelta(seconds=time.monotonic() - began)

    try:
        closed = cut_lineage(audit_finish(audit, work(ended)))
    except Exception as problem:
        result = [(run_id, ended(), "FAILED", 0, 0, 0, str(problem))]
        log_run(audit_finish(audit, spark.createDataFrame(result, schema.RUN_RESULT)), output)
        raise
    log_run(closed, output)
    return closed


def log_run(rows: DataFrame, output: str) -> None:
    """Append states of runs to the stored audit trail."""
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in rows.sparkSession.createDataFrame([], schema.AUDIT).schema])
    typed.coalesce(1).write.mode("append").parquet(f"{output}/{AUDIT_LOG}")


def stored_runs(spark: SparkSession, output: str) -> DataFrame:
    """The last state of each run: a closed row counts before the RUNNING row that it closes."""
    states = spark.read.schema(schema.AUDIT).parquet(f"{output}/{AUDIT_LOG}")
    state = F.struct(F.col("start_time"), F.col("end_time").isNotNull(), F.col("end_time"))
    return states.groupBy("run_id").agg(F.max_by(F.struct(*states.columns), state).alias("r")).select("r.*")


def merge_entities(
    spark: SparkSession, inbound: str, warehouse: Warehouse, output: str, batch_id: str, as_of: datetime, seq: str
) -> DataFrame | None:
    """Classify and merge each entity file that is there; returns the counts, or nothing without any file."""
    upserts: dict[str, tuple[str, Callable]] = {
        "suppliers": ("dim_supplier", upsert_suppliers),
        "materials": ("dim_material", upsert_materials),
        "purchase_orders": ("fact_purchase_orders", upsert_purchase_orders),
    }
    counts = None
    for entity in INGEST_ENTITIES:
        raw = csv_files.read_text_batch(spark, f"{inbound}/{entity}.csv", seq)
        if raw is None:
            log.warning("no file for %s below %s", entity, inbound)
            continue
        classified = cut_lineage(validation.classify(entity, raw, seq))
        store_rejected(
            validation.rejected(entity, classified, seq, raw.columns, INGEST_RUN, batch_id), f"{output}/rejected"
        )
        table, merge = upserts[entity]
        base = latest_number(spark, output, table)
        target = current_or(spark, output, table, warehouse[table])
        accepted = validation.accepted(entity, classified)
        if table == ORDERS:
            merge_orders(target, accepted, output, as_of, base)
        else:
            publish(merge(target, accepted, as_of), output, table, version_of(as_of), base=base)
        one = validation.batch_counts(entity, classified)
        counts = one if counts is None else counts.unionByName(one)
    return counts


def month_of(day: str) -> Column:
    """Partition name of an order date; orders without a date share one."""
    return F.coalesce(F.date_format(day, "yyyy_MM"), F.lit("none"))


def touched_months(stored: DataFrame, batch: DataFrame) -> list[str]:
    """The months that an order batch changes: those of the known orders it names, and those of its new orders.

    An order stays in the month it was stored under, whatever date the batch gives.
    Of the stored orders only ids and months are read.
    """
    known = stored.select("po_id", ORDER_MONTH)
    ids = batch.select("po_id").distinct()
    matched = known.join(ids, "po_id", "left_semi").select(ORDER_MONTH)
    new = batch.join(known, "po_id", "left_anti").select(month_of("order_date").alias(ORDER_MONTH))
    return sorted(r[0] for r in matched.unionByName(new).distinct().collect())


def merge_orders(
    target: DataFrame, batch: DataFrame, output: str, as_of: date | datetime, base: int | None = None
) -> list[str]:
    """Merge an order batch into the orders stored by month below ``output``; returns the months written.

    The first merge publishes the whole table by month, after version ``base`` if given. Later ones read and replace
    only the months that the batch touches; the merge is the same upsert. A run that
    fails while it replaces months is repaired by running the same batch again.
    """
    month = month_of("order_date").alias(ORDER_MONTH)
    if ORDER_MONTH not in target.columns:
        merged = upsert_purchase_orders(target, batch, as_of)
        publish(merged.select("*", month), output, ORDERS, version_of(as_of), by=ORDER_MONTH, base=base)
        return []
    batch = cut_lineage(batch)
    months = touched_months(target, batch)
    if months:
        part = target.where(F.col(ORDER_MONTH).isin(*months)).drop(ORDER_MONTH)
        # The months are read and replaced, so the merged rows are fixed in between.
        replace_partitions(cut_lineage(upsert_purchase_orders(part, batch, as_of).select("*", month)), output, ORDERS, ORDER_MONTH)
    return months


def version_of(at: datetime) -> str:
    """Version names sort by time."""
    return f"{at:%Y%m%dT%H%M%S}"


def ingest_result(spark: SparkSession, counts: DataFrame | None, run_id: str, end: datetime) -> DataFrame:
    if counts is None:
        return spark.createDataFrame([(run_id, end, "SUCCESS", 0, 0, 0, None)], schema.RUN_RESULT)
    return counts.agg(
        F.lit(run_id).alias("run_id"),
        F.lit(end).alias("end_time"),
        F.lit("SUCCESS").alias("status"),
        F.sum("rows_extracted").alias("rows_extracted"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("rows_rejected").alias("rows_rejected"),
        F.lit(None).cast("string").alias("error_message"),
    )


def store_rejected(rows: DataFrame, path: str) -> None:
    """Append dead letters; nothing to append leaves only an empty commit."""
    rows.write.mode("append").parquet(path)


def load_movements(
    spark: SparkSession, path: str, warehouse: Warehouse, run_id: str, batch_id: str, at: datetime, output: str | None = None
) -> DataFrame:
    """Append a movement file to the partitioned ledger; returns the closed audit row.

    The run is kept in the audit trail below ``output`` (by default the warehouse's
    folder) as RUNNING and then as SUCCESS or FAILED; a missing file is a failure
    that is reported and not raised. The file is parsed once, and only the quarters
    it falls into are opened. ``rows_loaded`` counts the rows offered, whether or
    not they were already there.
    """

    def work(ended: Callable[[], datetime]) -> DataFrame:
        try:
            batch = csv_files.read_entity(spark, path, "inventory_movements")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = [(run_id, ended(), "FAILED", 0, 0, 0, "File not found")]
            return spark.createDataFrame(missing, schema.RUN_RESULT)
        ledger = warehouse[LEDGER]
        columns = [c for c in ledger.columns if c != QUARTER]
        batch = cut_lineage(batch.select(*columns))
        fresh = new_movements(ledger, batch, warehouse.declared)
        # The ledger is read to find the new rows, so these are fixed before it is written to.
        write_ledger(cut_lineage(fresh), warehouse.path(LEDGER), warehouse.declared, mode="append")
        warehouse.refresh(LEDGER)
        # Totals of the quarters written to are out of date from the append on; where totals are kept, they follow.
        if warehouse.summed_quarters():
            warehouse.refresh_totals()
        offered = batch.count()
        return spark.createDataFrame([(run_id, ended(), "SUCCESS", offered, offered, 0, None)], schema.RUN_RESULT)

    return recorded(spark, output or warehouse.root, run_id, LEDGER_RUN, batch_id, at, work)


def refresh_marts(t: Mapping[str, DataFrame], spark: SparkSession, root: str, version: str, as_of: date) -> None:
    """Publish the three marts in dependency order; production reads the stored inventory mart."""
    publish(marts.supplier_performance(t, as_of), root, "supplier_performance", version)
    publish(marts.inventory_health(t, as_of), root, "inventory_health", version)
    stored = current(spark, root, "inventory_health")
    publish(marts.production_at_risk(t, as_of, stored), root, "production_at_risk", version)
