"""Regression and classification metrics of a score against its label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.functions.exprs import real_ratio, round_half_even
from plantline.operators.ordered import running_totals

THRESHOLD = 60.0


def _or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(real_ratio(num, den), F.lit(0.0))


def measured(df: DataFrame, label: str, prediction: str, threshold: float = THRESHOLD) -> DataFrame:
    """Error sums and the four classification counts, in one pass."""
    y, p = F.col(label), F.col(prediction)
    error = y - p
    yes, said = y >= threshold, p >= threshold
    return df.agg(
        F.count(F.lit(1)).alias("samples_evaluated"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("variance"),
        F.count_if(yes & said).alias("tp"),
        F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"),
        F.count_if(~yes & ~said).alias("tn"),
    )


def _r2() -> Column:
    mse, variance = F.col("mse"), F.col("variance")
    constant = F.when(mse == 0, 1.0).otherwise(0.0)
    return F.when(variance == 0, constant).otherwise(1.0 - mse / F.nullif(variance, F.lit(0.0)))


def regression(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return measured(df, label, prediction).select(
        "samples_evaluated",
        round_half_even(F.col("mae"), 3).alias("mae"),
        round_half_even(F.sqrt("mse"), 3).alias("rmse"),
        round_half_even(_r2(), 3).alias("r2_score"),
    )


def _classified(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision_at_60": round_half_even(_or_zero(tp, tp + fp), 3),
        "recall_at_60": round_half_even(_or_zero(tp, tp + fn), 3),
        "f1_at_60": round_half_even(_or_zero(2 * tp, 2 * tp + fp + fn), 3),
    })


def classification(df: DataFrame, label: str, prediction: str, threshold: float = THRESHOLD) -> DataFrame:
    return _classified(measured(df, label, prediction, threshold)).select(
        "precision_at_60", "recall_at_60", "f1_at_60", "tn", "fp", "fn", "tp"
    )


def roc_auc(df: DataFrame, label: str, prediction: str, threshold: float = THRESHOLD) -> DataFrame:
    """Exact area by rank sums, ties counted half; 1.0 when only one class occurs.

    Equal predictions are counted first; the counts are ordered in blocks of one
    hundredth of a point, so no task sees the whole table.
    """
    yes = F.col(label) >= threshold
    counts = df.groupBy(F.col(prediction).alias("_p")).agg(
        F.count_if(yes).alias("_pos"), F.count_if(~yes).alias("_neg")
    )
    ordered = running_totals(counts, [], F.floor(F.col("_p") * 100), [F.col("_p")], {"_below": F.col("_neg")})
    twice = F.col("_pos").cast("decimal(18,0)") * (2 * F.col("_below") - F.col("_neg")).cast("decimal(19,0)")
    sums = ordered.agg(
        F.sum(twice).alias("_area"), F.sum("_pos").alias("_p_all"), F.sum("_neg").alias("_n_all")
    )
    pairs = 2.0 * F.col("_p_all").cast("double") * F.col("_n_all").cast("double")
    return sums.select(
        round_half_even(F.coalesce(real_ratio(F.col("_area"), pairs), F.lit(1.0)), 3).alias("roc_auc")
    )


def report(df: DataFrame, label: str, prediction: str, model_type: str, with_matrix: bool) -> DataFrame:
    """One row of all metrics; the confusion matrix is [[tn, fp], [fn, tp]]."""
    matrix = F.concat(
        F.lit("[["), F.col("tn").cast("string"), F.lit(", "), F.col("fp").cast("string"), F.lit("], ["),
        F.col("fn").cast("string"), F.lit(", "), F.col("tp").cast("string"), F.lit("]]"),
    )
    return _classified(measured(df, label, prediction)).select(
        F.lit(model_type).alias("model_type"),
        "samples_evaluated",
        round_half_even(F.col("mae"), 3).alias("mae"),
        round_half_even(F.sqrt("mse"), 3).alias("rmse"),
        round_half_even(_r2(), 3).alias("r2_score"),
        roc_auc(df, label, prediction).scalar().alias("roc_auc"),
        "precision_at_60", "recall_at_60", "f1_at_60",
        (matrix if with_matrix else F.lit(None).cast("string")).alias("confusion_matrix"),
    )
