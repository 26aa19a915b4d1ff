"""Rule scores, factor attribution and prediction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.functions.exprs import clip, risk_tier, round_half_even


def _f(name: str) -> Column:
    return F.col(name).cast("double")


def supplier_rule_score() -> Column:
    """Sum of six capped penalties, kept within [5, 98]."""
    # Fixed values: (penalty, cap) in order of summation.
    penalties = (
        ((100.0 - _f("otd_rate_90d")) * 0.45, 45.0),
        (F.greatest(_f("avg_variance_days"), F.lit(0.0)) * 2.5 + _f("std_variance_days") * 2.0, 30.0),
        (_f("defect_ppm_90d") / 1000.0 * 1.2, 25.0),
        (_f("single_source_count") * 5.0, 15.0),
        (_f("financial_risk_score") * 0.15, 15.0),
        (_f("overdue_po_count") * 4.0, 15.0),
    )
    total = clip(penalties[0][0], 0.0, penalties[0][1])
    for penalty, cap in penalties[1:]:
        total = total + clip(penalty, 0.0, cap)
    return clip(total, 5.0, 98.0)


def _ladder(value: Column, steps: tuple[tuple[float, float], ...]) -> Column:
    """First points whose limit the value is below; 0 above all limits."""
    (limit, points), *rest = steps
    ladder = F.when(value < limit, points)
    for limit, points in rest:
        ladder = ladder.when(value < limit, points)
    return ladder.otherwise(0.0)


def stockout_rule_score() -> Column:
    # Points below each limit, critical-part factor.
    cover = _ladder(F.col("days_of_inventory"), ((5.0, 50.0), (14.0, 30.0), (30.0, 15.0)))
    safety = _ladder(F.col("safety_stock_ratio"), ((0.5, 30.0), (1.0, 15.0)))
    shortage = clip(_f("total_shortage_units") / 50.0 * 10.0, 0.0, 20.0)
    factor = F.when(F.col("is_critical"), 1.25).otherwise(1.0)
    return clip((cover + safety + shortage) * factor, 5.0, 99.0)


def supplier_weights() -> list[tuple[str, Column]]:
    # Attribution weights, in the order that decides ties.
    return [
        ("otd_rate_90d", (95.0 - _f("otd_rate_90d")) * 0.5),
        ("avg_variance_days", _f("avg_variance_days") * 3.0),
        ("std_variance_days", _f("std_variance_days") * 2.2),
        ("defect_ppm_90d", _f("defect_ppm_90d") / 1000.0 * 1.5),
        ("single_source_count", _f("single_source_count") * 6.0),
        ("overdue_po_count", _f("overdue_po_count") * 4.5),
        ("financial_risk_score", (_f("financial_risk_score") - 20.0) * 0.2),
    ]


def supplier_factors(df: DataFrame, top: int = 4) -> DataFrame:
    """Add ``top_contributing_factors``: at most four weighty factors, heaviest first.

    The array is built and sorted inside the row: by weight descending, then by
    declaration order.
    """
    weights = supplier_weights()
    weighed = df.withColumns({f"_w{i}": F.greatest(w, F.lit(0.0)) for i, (_, w) in enumerate(weights)})
    total = F.col("_w0")
    for i in range(1, len(weights)):
        total = total + F.col(f"_w{i}")
    ordered = F.array_sort(F.array(*[
        F.struct(
            (-F.col(f"_w{i}")).alias("neg"),
            F.lit(i).alias("place"),
            F.lit(name).alias("feature"),
            round_half_even(_f(name), 2).alias("raw"),
        )
        for i, (name, _) in enumerate(weights)
    ]))
    kept = F.slice(F.filter(ordered, lambda x: x["neg"] < 0), 1, top)
    factors = F.transform(
        kept,
        lambda x: F.struct(
            x["feature"].alias("feature"),
            round_half_even(-x["neg"] / F.col("_total") * 100.0, 1).alias("impact_percentage"),
            x["raw"].alias("raw_value"),
        ),
    )
    return (
        weighed.withColumn("_total", F.when(total == 0, 1.0).otherwise(total))
        .withColumn("top_contributing_factors", factors)
        .drop("_total", *[f"_w{i}" for i in range(len(weights))])
    )


def stockout_factors() -> Column:
    """Four fixed entries; the percentages are set by threshold and do not add up to 100."""

    def entry(feature: str, impact: Column, raw: Column) -> Column:
        return F.struct(
            F.lit(feature).alias("feature"), impact.alias("impact_percentage"), raw.cast("double").alias("raw_value")
        )

    def either(condition: Column, yes: float, no: float) -> Column:
        return F.when(condition, yes).otherwise(no)

    doi, safety, short = F.col("days_of_inventory"), F.col("safety_stock_ratio"), F.col("total_shortage_units")
    # Impact when the condition holds, and otherwise.
    return F.array(
        entry("days_of_inventory", either(doi < 14, 45.0, 15.0), doi),
        entry("safety_stock_ratio", either(safety < 1, 30.0, 10.0), safety),
        entry("is_critical", either(F.col("is_critical"), 20.0, 5.0), F.col("is_critical").cast("int")),
        entry("total_shortage_units", either(short > 0, 15.0, 0.0), short),
    )


def supplier_predictions(scored: DataFrame) -> DataFrame:
    """Prediction records from features with a raw ``score`` column."""
    score = round_half_even(clip(F.col("score"), 0.0, 100.0), 1)
    return supplier_factors(scored).withColumn("risk_score", score).select(
        "supplier_id",
        F.col("name").alias("supplier_name"),
        "risk_score",
        risk_tier(F.col("risk_score")).alias("risk_tier"),
        round_half_even(F.col("otd_rate_90d"), 1).alias("otd_rate_90d"),
        F.col("defect_ppm_90d").cast("bigint").alias("defect_ppm_90d"),
        round_half_even(F.col("avg_variance_days"), 1).alias("lead_time_variance_avg"),
        round_half_even(F.col("financial_risk_score"), 1).alias("financial_risk_score"),
        F.col("single_source_count").alias("single_source_material_count"),
        "top_contributing_factors",
    )


def stockout_predictions(scored: DataFrame) -> DataFrame:
    score = round_half_even(clip(F.col("score"), 0.0, 100.0), 1)
    return scored.withColumn("stockout_risk_score", score).select(
        "material_id",
        F.col("name").alias("material_name"),
        "sku",
        "stockout_risk_score",
        risk_tier(F.col("stockout_risk_score")).alias("risk_tier"),
        "current_stock",
        "days_of_inventory",
        "safety_stock_ratio",
        "is_critical",
        "total_shortage_units",
        stockout_factors().alias("top_contributing_factors"),
    )
