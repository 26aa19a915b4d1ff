from datetime import date, datetime
from decimal import Decimal

import pytest

from plantline.operators.merge import insert_absent, new_movements, upsert
from plantline.plans import incidents, loading

DAY = date(2001, 5, 15)


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


ORDERS = (
    "po_id int, status string, total_amount decimal(14,2), promised_delivery_date date, warehouse_id int,"
    " updated_at date"
)


def orders(spark, *rows):
    return table(spark, [(k, s, Decimal(a), DAY, w, None) for k, s, a, w in rows], ORDERS)


def test_order_upsert_touches_three_columns_only(spark):
    target = orders(spark, (1, "PENDING", 10, 5), (2, "PENDING", 20, 6))
    batch = orders(spark, (2, "DELIVERED", 21, 99), (3, "PENDING", 30, 7)).drop("updated_at")
    got = {r.po_id: r for r in loading.upsert_purchase_orders(target, batch, DAY).collect()}
    assert (got[2].status, float(got[2].total_amount), got[2].warehouse_id, got[2].updated_at) == (
        "DELIVERED", 21.0, 6, DAY
    )
    assert got[1].updated_at is None and got[3].warehouse_id == 7


def test_upsert_twice_equals_once(spark):
    target, batch = orders(spark, (1, "PENDING", 10, 5)), orders(spark, (1, "X", 1, 1), (2, "Y", 2, 2))
    once = loading.upsert_purchase_orders(target, batch, DAY)
    twice = loading.upsert_purchase_orders(once, batch, DAY)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_upsert_can_set_null(spark):
    schema = "id int, a string"
    got = upsert(table(spark, [(1, "x")], schema), table(spark, [(1, None)], schema), ["id"], ["a"])
    assert got.first().a is None


def test_key_given_twice_fails(spark):
    schema = "id int, a string"
    merged = upsert(
        table(spark, [(1, "x")], schema), table(spark, [(2, "y"), (2, "z")], schema), ["id"], ["a"]
    )
    with pytest.raises(Exception, match="key given twice"):
        merged.collect()


def test_insert_absent_keeps_known_rows(spark):
    schema = "alert_id string, status string"
    target = table(spark, [("A", "RESOLVED")], schema)
    batch = table(spark, [("A", "ACTIVE"), ("B", "ACTIVE")], schema)
    once = insert_absent(target, batch, ["alert_id"])
    assert {tuple(r) for r in once.collect()} == {("A", "RESOLVED"), ("B", "ACTIVE")}
    assert sorted(insert_absent(once, batch, ["alert_id"]).collect()) == sorted(once.collect())


def test_new_movements_by_id_and_date(spark):
    schema = "movement_id string, movement_date date, quantity int"
    d1, d2 = date(2001, 1, 1), date(2001, 1, 2)
    ledger = table(spark, [("a", d1, 1), ("b", d1, 1)], schema)
    batch = table(spark, [("a", d1, 9), ("a", d2, 5), ("c", d2, 2), ("c", d2, 1)], schema)
    got = {tuple(r) for r in new_movements(ledger, batch).select("movement_id", "movement_date", "quantity").collect()}
    assert got == {("a", d2, 5), ("c", d2, 1)}


NOW = datetime(2001, 5, 15, 12)
ACTION = "action_id string, status string, resolution_notes string, updated_at timestamp_ntz, resolved_at timestamp_ntz"


def test_action_resolved_once(spark):
    first = datetime(2001, 1, 1)
    target = table(spark, [("CA-1", "OPEN", None, first, None), ("CA-2", "RESOLVED", "old", first, first)], ACTION)
    updates = table(
        spark, [("CA-1", "RESOLVED", None), ("CA-2", "RESOLVED", "new"), ("CA-9", "OPEN", None)],
        "action_id string, status string, resolution_notes string",
    )
    got = {r.action_id: r for r in incidents.apply_action_updates(target, updates, NOW).collect()}
    assert set(got) == {"CA-1", "CA-2"}
    assert (got["CA-1"].resolved_at, got["CA-2"].resolved_at) == (NOW, first)
    assert (got["CA-1"].resolution_notes, got["CA-2"].resolution_notes) == (None, "new")


def test_alert_resolved_each_time(spark):
    schema = "alert_id string, status string, resolved_at timestamp_ntz"
    target = table(spark, [("A", "RESOLVED", datetime(2001, 1, 1)), ("B", "ACTIVE", None)], schema)
    updates = table(spark, [("A", "RESOLVED"), ("B", "DISMISSED")], "alert_id string, status string")
    got = {r.alert_id: (r.status, r.resolved_at) for r in incidents.apply_alert_updates(target, updates, NOW).collect()}
    assert got == {"A": ("RESOLVED", NOW), "B": ("DISMISSED", None)}


def test_created_actions_are_numbered_on(spark):
    actions = table(spark, [(f"CA-2026-{i:04d}",) for i in range(1, 4)], "action_id string")
    requests = table(
        spark, [(2, "b", "d", "x", None), (1, "a", "d", "x", "LOW")],
        "request_id int, title string, description string, assigned_to string, priority string",
    )
    got = [(r.action_id, r.title, r.priority, r.status) for r in
           incidents.create_actions(actions, requests, NOW).orderBy("action_id").collect()]
    assert got == [("CA-2026-0004", "a", "LOW", "OPEN"), ("CA-2026-0005", "b", "HIGH", "OPEN")]


def test_audit_duration(spark):
    start, end = datetime(2001, 5, 15, 6), datetime(2001, 5, 15, 6, 0, 1, 250_000)
    audit = loading.audit_start(spark, "r", "JOB", "B", start)
    done = loading.audit_finish(audit, spark.createDataFrame([("r", end, "SUCCESS", 5, 4, 1, None)],
                                                             loading.schema.RUN_RESULT)).first()
    assert (float(done.duration_seconds), done.status, done.rows_loaded) == (1.25, "SUCCESS", 4)
    unknown = loading.audit_finish(audit, spark.createDataFrame([("z", end, "SUCCESS", 5, 4, 1, None)],
                                                                loading.schema.RUN_RESULT)).first()
    assert unknown.status == "RUNNING" and unknown.end_time is None
