"""Monthly supplier trends: previous and next month, rolling means, rank in category."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantline.functions.exprs import quotient, ratio, real_ratio
from plantline.operators.ordered import dense_ranks
from plantline.plans.marts import Tables


def by_month():
    """One supplier has at most one row per calendar month, so this window stays short."""
    return Window.partitionBy("supplier_id").orderBy("delivery_month")


def last_three():
    return by_month().rowsBetween(-2, 0)


def monthly_deliveries(t: Tables) -> DataFrame:
    """Supplier x month: counts, punctuality in hundredths of a percent, slip and defect rate.

    Receipts are aggregated before the supplier attributes are joined on.
    """
    months = t["fact_goods_receipts"].groupBy(
        "supplier_id", F.trunc("receipt_date", "MM").alias("delivery_month")
    ).agg(
        F.count("receipt_id").alias("delivery_count"),
        F.count_if(F.col("delivery_variance_days") <= 0).alias("on_time_count"),
        F.sum("delivery_variance_days").alias("slip_sum"),
        F.sum("quantity_rejected").alias("rejected"),
        F.sum("quantity_delivered").alias("delivered"),
    )
    suppliers = t["dim_supplier"].select("supplier_id", F.col("name").alias("supplier_name"), "category")
    return months.join(suppliers, "supplier_id").select(
        "supplier_id",
        "supplier_name",
        "category",
        "delivery_month",
        "delivery_count",
        F.round(quotient(F.col("on_time_count"), F.col("delivery_count"), 10_000), 0).cast("bigint").alias("otd_points"),
        ratio(F.col("slip_sum"), F.col("delivery_count"), 2).alias("avg_variance_days"),
        (real_ratio(F.col("rejected"), F.col("delivered")) * 1_000_000.0).alias("defect_ppm"),
    )


def with_percent(points: str):
    return F.col(points) / 100.0


def lag_otd(t: Tables, as_of: date | None = None) -> DataFrame:
    prior = F.lag("otd_points", 1).over(by_month())
    return monthly_deliveries(t).withColumn("prior", prior).select(
        "supplier_id", "delivery_month", with_percent("otd_points").alias("monthly_otd_pct"),
        with_percent("prior").alias("prior_month_otd_pct"),
    )


def lead_variance(t: Tables, as_of: date | None = None) -> DataFrame:
    return monthly_deliveries(t).select(
        "supplier_id", "delivery_month", "avg_variance_days",
        F.lead("avg_variance_days", 1).over(by_month()).alias("next_month_variance_days"),
    )


def rolled(t: Tables) -> DataFrame:
    """Monthly rows with their three-row sums; all windows share one sort."""
    return monthly_deliveries(t).withColumns({
        "prior": F.lag("otd_points", 1).over(by_month()),
        "rolled_points": F.sum("otd_points").over(last_three()),
        "rolled_months": F.count("otd_points").over(last_three()),
        "rolled_ppm": F.avg("defect_ppm").over(last_three()),
    }).withColumns({
        "rolling_rank_value": real_ratio(F.col("rolled_points"), F.col("rolled_months") * 100),
        "rolling_3m_otd_pct": ratio(F.col("rolled_points"), F.col("rolled_months") * 100, 2),
        "rolling_3m_defect_ppm": F.round("rolled_ppm", 0),
    })


def rolling_3m(t: Tables, as_of: date | None = None) -> DataFrame:
    return rolled(t).select("supplier_id", "delivery_month", "rolling_3m_otd_pct", "rolling_3m_defect_ppm")


def ranked_months(t: Tables) -> DataFrame:
    """Rank by the unrounded rolling mean. A mean of at most three two-decimal
    percentages has under 61,000 values, which bounds each ranked group."""
    return dense_ranks(rolled(t), ["category", "delivery_month"], [("rolling_rank_value", False)], "category_rank")


def rank_monthly(t: Tables, as_of: date | None = None) -> DataFrame:
    return ranked_months(t).select(
        "supplier_id", "category", "delivery_month", "rolling_3m_otd_pct", "category_rank"
    )


def supplier_trajectory(t: Tables, as_of: date | None = None) -> DataFrame:
    change = F.col("otd_points") - F.col("prior")
    return ranked_months(t).select(
        "supplier_id",
        "supplier_name",
        "category",
        "delivery_month",
        with_percent("otd_points").alias("monthly_otd_pct"),
        with_percent("prior").alias("prior_month_otd_pct"),
        (change / 100.0).alias("otd_mom_change_pct"),
        "rolling_3m_otd_pct",
        "rolling_3m_defect_ppm",
        "category_rank",
        F.when(change < -1000, "SEVERE_DEGRADATION")
        .when(change < -500, "MODERATE_DEGRADATION")
        .when(change > 500, "SIGNIFICANT_IMPROVEMENT")
        .otherwise("STABLE").alias("performance_trajectory"),
    ).orderBy("category", F.desc("delivery_month"), "rolling_3m_otd_pct", "supplier_id")
