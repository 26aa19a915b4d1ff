import os
import time
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from plantline import schema
from plantline.operators.calendar import fixed_calendar
from plantline.operators.merge import new_movements
from plantline.plans import analytics, loading, quality
from plantline.sources import csv_files
from plantline.sources.star import AS_OF, StarSchema
from plantline.sources.warehouse import (
    CLAIM_SECONDS,
    LEDGER,
    QUARTER,
    TOTALS,
    ConcurrentWrite,
    Warehouse,
    current,
    current_or,
    latest_number,
    ledger_between,
    ledger_flows,
    publish,
    quarters_between,
    remove_old_versions,
    write_ledger,
)

FOLDER = "/root/testdata/sf0.001"
DECLARED = (date(2000, 1, 1), date(2001, 7, 1))
AT = datetime(2001, 5, 15, 6)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quarters():
    assert quarters_between(date(2000, 5, 1), date(2000, 8, 1), DECLARED) == ["2000_q2", "2000_q3"]
    assert quarters_between(date(2001, 4, 1), None, DECLARED) == ["2001_q2", "default"]
    assert quarters_between(date(1999, 1, 1), date(1999, 2, 1), DECLARED) == ["default"]
    assert quarters_between(date(1999, 12, 31), date(2000, 1, 1), DECLARED) == ["2000_q1", "default"]


def test_ledger_range_prunes_partitions_and_pushes_filters(spark, tmp_path):
    star = StarSchema(spark, FOLDER)
    stored = Warehouse.load({LEDGER: star[LEDGER]}, spark, str(tmp_path), DECLARED)
    low, high = date(2000, 5, 1), date(2000, 8, 1)
    part = ledger_between(stored[LEDGER], low, high, DECLARED).where("material_id = 7").select("quantity")
    plan = plan_of(part)
    assert QUARTER in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(movement_date,2000-05-01)" in plan and "EqualTo(material_id,7)" in plan
    inside = F.col("movement_date").between(low, high)
    assert ledger_between(stored[LEDGER], low, high, DECLARED).count() == star[LEDGER].where(inside).count()
    assert stored[LEDGER].count() == star[LEDGER].count()


def test_standard_calendar(spark):
    days = fixed_calendar(spark)
    assert days.count() == 1461
    row = days.where("date_key = date'2024-12-30'").first()
    assert (row.year, row.week, row.month_name, row.day_name, row.is_weekend) == (2024, 1, "December", "Monday", False)
    assert days.where("is_weekend").count() == days.where("day_name in ('Saturday', 'Sunday')").count()


def test_readers_see_the_latest_version_only(spark, tmp_path):
    root = str(tmp_path)
    publish(spark.range(3), root, "m", "2001-05-14")
    publish(spark.range(5), root, "m", "2001-05-15")
    mart = current(spark, root, "m")
    assert mart.count() == 5 and mart.columns == ["id"]
    assert len({f.rsplit("/", 2)[-2] for f in mart.inputFiles()}) == 1


def test_an_older_business_date_published_later_is_seen(spark, tmp_path):
    root = str(tmp_path)
    publish(spark.range(5), root, "m", "2001-05-15")
    publish(spark.range(3), root, "m", "2001-05-14")
    assert current(spark, root, "m").count() == 3


def test_a_writer_that_was_overtaken_is_refused(spark, tmp_path):
    root = str(tmp_path)
    base = latest_number(spark, root, "m")
    assert base == 0
    publish(spark.range(3), root, "m", "first", base=base)
    with pytest.raises(ConcurrentWrite):
        publish(spark.range(9), root, "m", "overtaken", base=base)
    assert current(spark, root, "m").count() == 3
    # The files of the refused version are gone.
    assert len(list((tmp_path / "m").iterdir())) == 1
    publish(spark.range(4), root, "m", "second", base=latest_number(spark, root, "m"))
    assert current(spark, root, "m").count() == 4


def test_two_writers_at_once_do_not_both_follow_a_version(spark, tmp_path):
    root = str(tmp_path)
    publish(spark.range(3), root, "m", "first")
    claim = tmp_path / "_claims" / "m" / f"{latest_number(spark, root, 'm'):020d}"
    claim.touch()
    with pytest.raises(ConcurrentWrite):
        publish(spark.range(9), root, "m", "second")
    assert current(spark, root, "m").count() == 3
    # The claim of a writer that died counts no more after a while.
    os.utime(claim, (time.time() - 2 * CLAIM_SECONDS,) * 2)
    publish(spark.range(9), root, "m", "second")
    assert current(spark, root, "m").count() == 9


def test_only_versions_out_of_use_are_removed(spark, tmp_path):
    root = str(tmp_path)
    assert remove_old_versions(spark, root, "m") == []
    for n in (1, 2, 3, 4):
        publish(spark.range(n), root, "m", str(n))
    opened = current(spark, root, "m")
    spark.range(9).write.parquet(f"{root}/m/stray")
    # Within the grace time a reader may still be at work, and a writer may still publish.
    assert remove_old_versions(spark, root, "m", keep=1, grace_seconds=3600) == []
    assert len(remove_old_versions(spark, root, "m", keep=2, grace_seconds=0)) == 3
    assert opened.count() == 4 and current(spark, root, "m").count() == 4
    assert len(list((tmp_path / "m").iterdir())) == 2
    remove_old_versions(spark, root, "m", keep=1, grace_seconds=0)
    assert current(spark, root, "m").count() == 4 and len(list((tmp_path / "m").iterdir())) == 1


def test_only_a_table_never_published_is_replaced(spark, tmp_path):
    root, other = str(tmp_path), spark.range(1)
    assert current_or(spark, root, "m", other).count() == 1
    with pytest.raises(LookupError):
        current(spark, root, "m")
    publish(spark.range(5), root, "m", "2001-05-15")
    # A version without its row in the log, as an aborted write leaves it, is not read.
    spark.range(9).write.parquet(f"{root}/m/{2**63 - 1:020d}")
    assert current_or(spark, root, "m", other).count() == 5
    (tmp_path / "_versions" / "n").mkdir()
    (tmp_path / "_versions" / "n" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        current_or(spark, root, "n", other)


def test_load_movements_appends_once_and_reports_rows_offered(spark, tmp_path):
    star = StarSchema(spark, FOLDER)
    moves = star[LEDGER].withColumns({c: F.col(c).cast("string") for c in ("material_id", "warehouse_id", "factory_id")})
    old = moves.where("movement_date < date'2001-01-01'").dropDuplicates(["movement_id", "movement_date"])
    stored = Warehouse.load({LEDGER: old}, spark, str(tmp_path / "wh"), DECLARED)
    columns = list(schema.entity("inventory_movements").names)
    offered = moves.where("movement_date >= date'2000-06-01'").withColumns(
        {"reference_doc_type": F.lit("X"), "reference_doc_id": F.lit("1")}
    ).select(columns)
    csv_files.write_csv({"inventory_movements": offered}, str(tmp_path))
    path = str(tmp_path / "inventory_movements.csv")
    before = stored[LEDGER].count()
    fresh = moves.where("movement_date >= date'2001-01-01'").select("movement_id", "movement_date").distinct().count()
    for run in ("r1", "r2"):
        audit = loading.load_movements(spark, path, stored, run, "B", AT).first()
        assert (audit.status, audit.rows_loaded) == ("SUCCESS", offered.count())
        assert stored[LEDGER].count() == before + fresh


def test_missing_movement_file_fails_the_run(spark, tmp_path):
    stored = Warehouse(spark, str(tmp_path), [LEDGER], DECLARED)
    audit = loading.load_movements(spark, str(tmp_path / "none.csv"), stored, "r", "B", AT).first()
    assert (audit.status, audit.error_message, audit.rows_extracted) == ("FAILED", "File not found", 0)


def test_ingest_job(spark, tmp_path):
    """Two files are there, one is missing; the second file carries a duplicate and a bad row."""
    star = StarSchema(spark, FOLDER)
    text = {"supplier_id": F.col("supplier_id").cast("string")}
    tables = {
        "dim_supplier": star["dim_supplier"].withColumns(text),
        "dim_material": star["dim_material"],
        "fact_purchase_orders": star["fact_purchase_orders"].withColumns(
            {c: F.col(c).cast("string") for c in ("po_id", "supplier_id", "factory_id", "warehouse_id")}
        ),
    }
    stored = Warehouse.load(tables, spark, str(tmp_path / "wh"), DECLARED)
    inbound = tmp_path / "in"
    inbound.mkdir()
    names = "supplier_id,name,code,category,country,city,tier,reliability_rating,financial_health_score," \
        "baseline_lead_time_days,payment_terms,iso_certified,is_active"
    (inbound / "suppliers.csv").write_text(
        names + "\n1,New name,NEW,C,Y,Z,TIER_1,90,80,14,NET30,True,True\n"
        "900,Added,VND-900,C,Y,Z,TIER_2,90,80,14,NET30,True,\n"
    )
    (inbound / "purchase_orders.csv").write_text(
        "po_id,po_number,supplier_id,factory_id,warehouse_id,order_date,promised_delivery_date,status,total_amount,"
        "currency\n"
        "77,PO-77,1,0,0,2001-05-01,2001-05-09,DELIVERED,12.5,USD\n"
        "77,PO-77,1,0,0,2001-05-01,2001-05-09,PENDING,1,USD\n"
        "78,PO-78,1,0,0,2001-05-01,2001-04-01,PENDING,1,USD\n"
    )
    out = str(tmp_path / "out")
    audit = loading.run_ingest(spark, str(inbound), stored, out, "run-1", "B", AT).first()
    assert (audit.status, audit.rows_extracted, audit.rows_loaded, audit.rows_rejected) == ("SUCCESS", 5, 3, 2)
    assert audit.duration_seconds > 0
    del stored._opened["dim_supplier"]
    stored.names.remove("dim_supplier")
    with pytest.raises(KeyError):
        loading.run_ingest(spark, str(inbound), stored, out, "run-2", "B", AT)
    runs = {r.run_id: r for r in loading.stored_runs(spark, out).collect()}
    assert (runs["run-1"].status, runs["run-1"].rows_loaded) == ("SUCCESS", 3)
    assert (runs["run-2"].status, runs["run-2"].error_message) == ("FAILED", "'dim_supplier'")
    suppliers = {r.supplier_id: r for r in current(spark, out, "dim_supplier").collect()}
    assert (suppliers["1"].name, suppliers["1"].code, suppliers["900"].is_active) == ("New name", "VND-1", True)
    order = current(spark, out, "fact_purchase_orders").where("po_id = '77'").first()
    assert (order.status, float(order.total_amount)) == ("DELIVERED", 12.5)
    codes = sorted({r.error_code for r in spark.read.parquet(out + "/rejected").collect()})
    assert codes == ["ERR_DUPLICATE_KEY", "ERR_SCHEMA_VALIDATION"]


def test_entity_files_round_trip(spark, tmp_path):
    supplier = spark.createDataFrame(
        [("S1", 'a "quoted", name', None)], "supplier_id string, name string, code string"
    )
    back = csv_files.roundtrip({"x": supplier}, spark, str(tmp_path))["x"]
    assert back.collect() == supplier.collect()
    assert csv_files.read_text_batch(spark, str(tmp_path / "absent.csv"), "seq") is None


def test_folder_of_entity_files_is_a_star(spark, tmp_path):
    for name, ddl in schema.ENTITY_FILES.items():
        (tmp_path / f"{name}.csv").write_text(",".join(schema.entity(name).names) + "\n")
        assert ddl
    (tmp_path / "purchase_orders.csv").write_text(
        ",".join(schema.entity("purchase_orders").names)
        + "\nPO-1,N-1,S-1,F-1,W-1,2026-03-01,2026-04-01,OVERDUE,12.30,USD,2026-03-01 00:00:00\n"
    )
    tables = csv_files.read_folder(spark, str(tmp_path))
    assert set(tables) == set(schema.STAR_TABLE.values())
    row = analytics.delayed_orders(tables, date(2026, 4, 15)).first()
    assert (row.days_overdue, str(row.total_amount)) == (14, "12.30")


def test_stored_marts_agree_with_direct_ones(spark, tmp_path):
    star = StarSchema(spark, FOLDER)
    loading.refresh_marts(star, spark, str(tmp_path), "1", AS_OF)
    stored = current(spark, str(tmp_path), "production_at_risk")
    direct = queries()["mart_production_at_risk"](spark, FOLDER)
    assert stored.agg(F.sum("total_network_stock"), F.count("*")).first() == direct.agg(
        F.sum("total_network_stock"), F.count("*")
    ).first()


FORBIDDEN = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
EAGER = {
    "risk_supplier_model", "risk_stockout_model", "eval_report", "snapshot_export", "refresh_marts",
    "source_csv_roundtrip", "ledger_range_stored", "rejected_records_stored", "dq_suite_stored",
}


@pytest.mark.parametrize("key", sorted(set(queries()) - EAGER))
def test_plans_hold_no_python_and_no_cartesian_product(spark, key):
    plan = plan_of(queries()[key](spark, FOLDER))
    assert not [node for node in FORBIDDEN if node in plan]


def test_rules_cover_the_suite():
    assert len(quality.RULES) == 7


def files_below(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_append_opens_and_writes_only_its_quarters(spark, tmp_path):
    star = StarSchema(spark, FOLDER)
    stored = Warehouse.load({LEDGER: star[LEDGER]}, spark, str(tmp_path), DECLARED)
    batch = spark.createDataFrame(
        [("N-1", 1, 1, 1, date(2000, 5, 2), "SCRAP", -1), ("N-2", 1, 1, 1, date(2000, 8, 9), "SCRAP", -2)],
        star[LEDGER].select("movement_id", "material_id", "warehouse_id", "factory_id", "movement_date", "movement_type", "quantity").schema,
    )
    fresh = new_movements(stored[LEDGER], batch, DECLARED)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line and QUARTER in line)
    assert "2000_q2" in filters and "2000_q3" in filters and "2000_q4" not in filters and "subquery" not in filters
    before = files_below(tmp_path / LEDGER)
    write_ledger(fresh, stored.path(LEDGER), DECLARED, mode="append")
    added = {f.split("/")[0] for f in set(files_below(tmp_path / LEDGER)) - set(before)}
    assert added == {f"{QUARTER}=2000_q2", f"{QUARTER}=2000_q3"}
    assert new_movements(stored[LEDGER], batch.limit(0), DECLARED).count() == 0


def test_order_merge_leaves_other_months_alone(spark, tmp_path):
    schema_of = "po_id string, po_number string, supplier_id string, warehouse_id string, factory_id string, order_date date, " \
        "promised_delivery_date date, status string, total_amount decimal(14,2), currency string, created_at date, updated_at date"

    def order(key, day, status="OPEN"):
        return (key, "N", "1", "1", "1", day, day, status, Decimal(1), "USD", date(2001, 1, 1), date(2001, 1, 1))

    days = [date(2000, 1, 3), date(2000, 2, 3), date(2000, 3, 3), None]
    target = spark.createDataFrame([order(f"{i}", d) for i, d in enumerate(days)], schema_of)
    root = str(tmp_path)
    assert loading.merge_orders(target, target.limit(0), root, date(2001, 5, 1)) == []
    before = files_below(tmp_path)
    # The batch names a known order under another date, and a new one.
    batch = spark.createDataFrame([order("1", date(2000, 3, 9), "DELIVERED"), order("9", date(2000, 4, 1))], schema_of)
    months = loading.merge_orders(current(spark, root, loading.ORDERS), batch, root, date(2001, 5, 1))
    assert months == ["2000_02", "2000_04"]
    after = files_below(tmp_path)
    kept = {f for f in before if before[f] == after.get(f)}
    assert {f.split(loading.ORDER_MONTH + "=")[1].split("/")[0] for f in kept if loading.ORDER_MONTH in f} == {"2000_01", "2000_03", "none"}
    rows = {r.po_id: r for r in current(spark, root, loading.ORDERS).collect()}
    assert (rows["1"].status, rows["1"].order_date, rows["9"].status) == ("DELIVERED", date(2000, 2, 3), "OPEN") and len(rows) == 5
    assert loading.merge_orders(current(spark, root, loading.ORDERS), batch.limit(0), root, date(2001, 5, 1)) == []


def test_movement_load_keeps_its_trail(spark, tmp_path):
    star = StarSchema(spark, FOLDER)
    stored = Warehouse.load({LEDGER: star[LEDGER]}, spark, str(tmp_path / "wh"), DECLARED)
    missing = loading.load_movements(spark, str(tmp_path / "none.csv"), stored, "r1", "B", AT).first()
    (tmp_path / "bad.csv").write_text(",".join(schema.entity("inventory_movements").names) + "\nM-1,1,1,1,no date,SCRAP,1,X,1\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        loading.load_movements(spark, str(tmp_path / "bad.csv"), stored, "r2", "B", AT)
    runs = {r.run_id: r for r in loading.stored_runs(spark, str(tmp_path / "wh")).collect()}
    assert missing.status == "FAILED" and runs["r1"].error_message == "File not found"
    assert runs["r2"].status == "FAILED" and runs["r2"].error_message and runs["r2"].end_time is not None
    states = spark.read.parquet(f"{tmp_path}/wh/{loading.AUDIT_LOG}").where("run_id = 'r2'").select("status").collect()
    assert sorted(r.status for r in states) == ["FAILED", "RUNNING"]


def test_totals_of_closed_quarters_replace_their_scan(spark, tmp_path):
    star = StarSchema(spark, FOLDER)
    stored = Warehouse.load({LEDGER: star[LEDGER]}, spark, str(tmp_path), DECLARED)
    cells = lambda t: sorted(map(str, ledger_flows(t, date(2001, 2, 1)).groupBy("material_id", "warehouse_id").agg(
        F.sum("quantity"), F.sum("outflow"), F.sum("recent")).collect()))
    expected = cells(star)
    assert stored.summed_quarters() == [] and cells(stored) == expected
    assert stored.refresh_totals() == sorted(quarters_between(date(1990, 1, 1), None, DECLARED)) and stored.refresh_totals() == []
    assert cells(stored) == expected
    scans = [line for line in plan_of(ledger_flows(stored, date(2001, 2, 1))).splitlines() if "PartitionFilters" in line]
    ledger = next(line for line in scans if "movement_date" in line)
    assert "NOT" in ledger and "2000_q4" in ledger and "2001_q1" not in ledger
    # A late row: its quarter is scanned again, then summed up again; the others stay.
    late = star[LEDGER].where("movement_date = date'2000-02-29'").limit(1)
    write_ledger(late, stored.path(LEDGER), DECLARED, mode="append")
    stored.refresh(LEDGER)
    assert "2000_q1" not in stored.summed_quarters() and len(stored.summed_quarters()) == 6
    again = cells({LEDGER: stored[LEDGER]})
    assert cells(stored) == again != expected
    before = files_below(tmp_path / TOTALS)
    assert stored.refresh_totals() == ["2000_q1"] and cells(stored) == again
    changed = set(files_below(tmp_path / TOTALS)) ^ set(before)
    assert {f.split("/")[0] for f in changed} == {f"{QUARTER}=2000_q1"}


def test_roundtrip_packs_its_files(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id", "concat('PO-', id, ' \\'a\\', \"b\"') as name", "if(id % 3 = 0, null, date'2001-05-15') as day")
    back = csv_files.roundtrip({"x": rows}, spark, str(tmp_path / "packed"))["x"]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    csv_files.write_csv({"x": rows}, str(tmp_path / "plain"))
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / name / "x.csv").glob("part-*"))
    assert size("packed") * 3 < size("plain")
