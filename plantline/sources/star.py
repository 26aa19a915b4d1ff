"""Star schema over the TPC-H-like input tables (mapping of FIXTURES.md).

``StarSchema`` behaves like a dict of DataFrames. Every table is a lazy plan
over the parquet inputs, so filters and column pruning reach the scans. A
deployment with a stored warehouse passes ``sources.warehouse.Warehouse``
instead; the plans only need the mapping.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2001, 5, 15)

_LINE_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


class StarSchema(Mapping[str, DataFrame]):
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _BUILDERS[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(_BUILDERS)

    def __len__(self) -> int:
        return len(_BUILDERS)

    def supplier_count(self):
        """Scalar subquery; a count over parquet reads no column."""
        return self.raw("supplier").agg(F.count(F.lit(1))).scalar()


def _site_of(orders: DataFrame, star: StarSchema) -> DataFrame:
    """Add warehouse_id and factory_id, both decided by the order key."""
    sites = star.raw("nation").where("n_nationkey < 8")
    return orders.withColumn("warehouse_id", F.expr("cast(o_orderkey % 8 as int)")).join(
        sites.select(F.col("n_nationkey").alias("warehouse_id"), F.col("n_regionkey").alias("factory_id")),
        "warehouse_id",
    )


def _dim_factory(star: StarSchema) -> DataFrame:
    return star.raw("region").selectExpr("r_regionkey as factory_id", "r_name as name")


def _dim_warehouse(star: StarSchema) -> DataFrame:
    return star.raw("nation").where("n_nationkey < 8").selectExpr(
        "n_nationkey as warehouse_id",
        "n_regionkey as factory_id",
        "n_name as name",
        "if(n_nationkey % 2 = 0, 'RAW_MATERIALS', 'FINISHED_GOODS') as warehouse_type",
    )


def _dim_supplier(star: StarSchema) -> DataFrame:
    nation = star.raw("nation").selectExpr("n_nationkey as s_nationkey", "n_name as country")
    return star.raw("supplier").join(nation, "s_nationkey").selectExpr(
        "s_suppkey as supplier_id",
        "concat('VND-', s_suppkey) as code",
        "s_name as name",
        "concat('CAT_', s_suppkey % 5) as category",
        "country",
        "concat('CITY_', s_nationkey) as city",
        "case when s_suppkey % 20 < 3 then 'TIER_3' when s_suppkey % 20 < 16 then 'TIER_2' else 'TIER_1' end as tier",
        "cast(45 + (s_suppkey * 37) % 55 as double) as reliability_rating",
        "cast(30 + (s_suppkey * 53) % 70 as double) as financial_health_score",
        "cast(7 + s_suppkey % 30 as int) as baseline_lead_time_days",
        "'NET30' as payment_terms",
        "s_suppkey % 4 <> 0 as iso_certified",
        "s_suppkey % 11 <> 10 as is_active",
    )


def _dim_material(star: StarSchema) -> DataFrame:
    count = star.supplier_count()
    part = F.col("p_partkey")
    return star.raw("part").select(
        part.alias("material_id"),
        F.expr("concat('SKU-', p_partkey)").alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.lit("PCS").alias("unit_of_measure"),
        F.expr("cast(p_retailprice as decimal(12,2))").alias("standard_cost"),
        F.expr("cast(p_retailprice as decimal(12,2))").alias("current_unit_price"),
        F.col("p_size").alias("safety_stock_level"),
        F.expr("p_size * 3").alias("reorder_point"),
        F.expr("p_size * 6").alias("target_stock_level"),
        F.lit(10).alias("min_order_qty"),
        F.expr("cast(7 + p_partkey % 39 as int)").alias("lead_time_days"),
        F.expr("p_partkey % 8 = 0").alias("is_critical"),
        (part % count).alias("primary_supplier_id"),
        F.when(part % 16 != 0, (part * 7 + 1) % count).alias("secondary_supplier_id"),
    )


def _dim_defect_type(star: StarSchema) -> DataFrame:
    # The defect codes the inspections can carry; one per residue of six.
    return star.raw("nation").where("n_nationkey < 6").selectExpr(
        "concat('DEF_', n_nationkey) as defect_type_code",
        "concat('Defect class ', n_nationkey) as name",
        "if(n_nationkey < 2, 'CRITICAL', 'MAJOR') as severity",
        "if(n_nationkey % 2 = 0, 'DIMENSIONAL', 'SURFACE') as category",
    )


def _purchase_orders(star: StarSchema) -> DataFrame:
    count = star.supplier_count()
    orders = star.raw("orders").withColumn("order_date", F.expr("cast(o_orderdate as date)"))
    return _site_of(orders, star).select(
        F.col("o_orderkey").alias("po_id"),
        F.expr("concat('PO-', o_orderkey)").alias("po_number"),
        (F.col("o_custkey") % (count - 2)).alias("supplier_id"),
        "warehouse_id",
        "factory_id",
        "order_date",
        F.expr("date_add(order_date, cast(14 + o_orderkey % 30 as int))").alias("promised_delivery_date"),
        F.expr(
            "case when order_date >= date'2001-04-01' then if(o_orderkey % 3 = 0, 'PENDING', 'IN_TRANSIT')"
            " when o_orderkey % 50 < 43 then 'DELIVERED'"
            " when o_orderkey % 50 < 47 then 'OVERDUE' else 'CANCELLED' end"
        ).alias("status"),
        F.expr("cast(o_totalprice as decimal(14,2))").alias("total_amount"),
        F.lit("USD").alias("currency"),
    )


def _purchase_order_lines(star: StarSchema) -> DataFrame:
    return star.raw("lineitem").selectExpr(
        f"{_LINE_KEY} as po_line_id",
        "l_orderkey as po_id",
        "l_linenumber as line_number",
        "l_partkey as material_id",
        "cast(l_quantity as int) as quantity_ordered",
        "cast(l_extendedprice as decimal(14,2)) as line_total",
    )


def _goods_receipts(star: StarSchema) -> DataFrame:
    arrived = star["fact_purchase_orders"].where("status in ('DELIVERED', 'OVERDUE')").select(
        F.col("po_id").alias("l_orderkey"), "supplier_id", "warehouse_id", "factory_id", "order_date", "promised_delivery_date"
    )
    # Line ids are made after the join: the plain columns are shorter, and take the exchange that the allocations take.
    return (
        star.raw("lineitem")
        .join(arrived, "l_orderkey")
        .withColumns({
            "po_line_id": F.expr(_LINE_KEY),
            "po_id": F.col("l_orderkey"),
            "line_number": F.col("l_linenumber"),
            "material_id": F.col("l_partkey"),
            "quantity_ordered": F.expr("cast(l_quantity as int)"),
        })
        .withColumn(
            "delivery_variance_days",
            F.expr(
                "cast((po_id * 7 + line_number * 3 + material_id) % 17 - 10"
                " + if(supplier_id % 20 < 3, 9, month(order_date) % 4)"
                " - if(po_id % 997 = 0, 40, 0) as int)"
            ),
        )
        .withColumn(
            "quantity_rejected",
            F.expr(
                "if((po_id + material_id) % 4 = 0,"
                " cast(least(quantity_ordered, (po_id + material_id) % 5) as int), 0)"
            ),
        )
        .selectExpr(
            "concat('GR-', po_line_id) as receipt_id",
            "po_id",
            "po_line_id",
            "supplier_id",
            "material_id",
            "warehouse_id",
            "factory_id",
            "date_add(promised_delivery_date, delivery_variance_days) as receipt_date",
            "quantity_ordered as quantity_delivered",
            "quantity_ordered - quantity_rejected as quantity_accepted",
            "quantity_rejected",
            "delivery_variance_days",
            "quantity_rejected > 2 as damage_detected",
        )
    )


def _quality_inspections(star: StarSchema) -> DataFrame:
    return star["fact_goods_receipts"].selectExpr(
        "concat('QC-', receipt_id) as inspection_id",
        "receipt_id",
        "material_id",
        "supplier_id",
        "receipt_date as inspection_date",
        "quantity_delivered as sample_size",
        "quantity_rejected as defect_count",
        "cast((quantity_rejected * 1000000L) div quantity_delivered as int) as defect_ppm",
        "if(quantity_rejected > 0, concat('DEF_', (po_id + material_id) % 6), null) as defect_type_code",
        "case when quantity_rejected = 0 then 'ACCEPTED'"
        " when quantity_rejected * 25 < quantity_delivered then 'CONCESSION' else 'REJECTED' end as disposition",
    )


def _inventory_movements(star: StarSchema) -> DataFrame:
    sites = star["dim_warehouse"].select("warehouse_id", "factory_id")
    return (
        star.raw("lineitem")
        .selectExpr(
            f"{_LINE_KEY} as movement_id",
            "l_partkey as material_id",
            "cast(l_suppkey % 8 as int) as warehouse_id",
            "cast(l_shipdate as date) as movement_date",
            "case when l_returnflag = 'N' then 'GOODS_RECEIPT' when l_returnflag = 'A' then 'PRODUCTION_ISSUE'"
            " when l_linestatus = 'F' then 'SCRAP' else 'TRANSFER_IN' end as movement_type",
            "cast(l_quantity as int) as units",
        )
        .join(sites, "warehouse_id", "left")
        .selectExpr(
            "movement_id",
            "material_id",
            "warehouse_id",
            "factory_id",
            "movement_date",
            "movement_type",
            "case movement_type when 'GOODS_RECEIPT' then 3 * units when 'TRANSFER_IN' then units else -units end"
            " as quantity",
        )
    )


def _production_schedules(star: StarSchema) -> DataFrame:
    orders = star.raw("orders").withColumn("start_date", F.expr("cast(o_orderdate as date)"))
    return _site_of(orders, star).selectExpr(
        "o_orderkey as work_order_id",
        "concat('FG-', o_orderkey % 100) as product_sku",
        "factory_id",
        "case o_orderkey % 5 when 0 then 50 when 1 then 100 when 2 then 250 when 3 then 500 else 1000 end"
        " as planned_quantity",
        "start_date",
        "date_add(start_date, cast(3 + o_orderkey % 12 as int)) as end_date",
        f"{_WORK_ORDER_STATUS.format(key='o_orderkey')} as status",
        "case o_orderpriority when '1-URGENT' then 'CRITICAL' when '2-HIGH' then 'HIGH' else 'STANDARD' end"
        " as priority",
    )


_WORK_ORDER_STATUS = (
    "case when start_date < date'2001-05-01' then 'COMPLETED' when start_date < date'2001-05-15' then 'IN_PROGRESS'"
    " when {key} % 7 = 0 then 'BLOCKED_SHORTAGE' else 'PLANNED' end"
)


def _bom_allocations(star: StarSchema) -> DataFrame:
    orders = star.raw("orders").selectExpr("o_orderkey as l_orderkey", "cast(o_orderdate as date) as start_date")
    blocked = f"{_WORK_ORDER_STATUS.format(key='l_orderkey')} = 'BLOCKED_SHORTAGE'"
    return (
        star.raw("lineitem")
        .join(orders, "l_orderkey")
        .withColumn("required_quantity", F.expr("cast(l_quantity as int)"))
        .withColumn(
            "shortage_quantity",
            F.expr(f"if({blocked}, (required_quantity * 7 + 9) div 10, 0L)").cast("int"),
        )
        .selectExpr(
            f"concat('ALC-', {_LINE_KEY}) as allocation_id",
            "l_orderkey as work_order_id",
            "l_partkey as material_id",
            "required_quantity",
            "required_quantity - shortage_quantity as allocated_quantity",
            "shortage_quantity",
        )
    )


_BUILDERS: dict[str, Callable[[StarSchema], DataFrame]] = {
    "dim_factory": _dim_factory,
    "dim_warehouse": _dim_warehouse,
    "dim_supplier": _dim_supplier,
    "dim_material": _dim_material,
    "dim_defect_type": _dim_defect_type,
    "fact_purchase_orders": _purchase_orders,
    "fact_purchase_order_lines": _purchase_order_lines,
    "fact_goods_receipts": _goods_receipts,
    "fact_quality_inspections": _quality_inspections,
    "fact_inventory_movements": _inventory_movements,
    "fact_production_schedules": _production_schedules,
    "fact_bom_allocations": _bom_allocations,
}
