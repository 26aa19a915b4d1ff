"""Merging a batch into a table. Plain parquet has no MERGE, so the result is a new table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.sources.warehouse import QUARTER, touched_quarters


def unique_rows(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One struct column ``_row`` per key; a key given twice fails the job, as a repeated upsert target would."""
    rest = F.struct(*batch.columns)
    grouped = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(rest).alias("_row"))
    repeated = F.raise_error(F.concat_ws(" ", F.lit("key given twice in one batch:"), *keys))
    return grouped.select(*keys, F.when(F.col("_n") > 1, repeated).otherwise(F.col("_row")).alias("_row"))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    stamps: Mapping[str, Column] | None = None,
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys whole; for known keys overwrite ``update_cols`` only.

    ``stamps`` are set on every row touched, ``defaults`` on inserted rows only.
    """
    stamps, defaults = dict(stamps or {}), dict(defaults or {})
    known = target.withColumn("_known", F.lit(True))
    joined = known.join(unique_rows(batch, keys), list(keys), "full_outer")
    given, old = F.col("_row").isNotNull(), F.col("_known").isNotNull()

    def value(name: str) -> Column:
        kept = F.col(name)
        if name in keys:
            return kept
        kind = target.schema[name].dataType
        if name in stamps:
            return F.when(given, stamps[name]).otherwise(kept).cast(kind).alias(name)
        if name in batch.columns:
            offered = F.col(f"_row.{name}").cast(kind)
        else:
            offered = defaults.get(name, F.lit(None)).cast(kind)
        if name in update_cols:
            return F.when(given, offered).otherwise(kept).alias(name)
        return F.when(old, kept).otherwise(offered).alias(name)

    return joined.select(*[value(c) for c in target.columns])


def first_per_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key. Rows that differ beyond the key: the smallest, so reruns agree."""
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.distinct()
    return batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in batch.columns]
    )


def absent_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch rows whose key the target does not hold."""
    return first_per_key(batch, keys).join(target.select(*keys), list(keys), "left_anti")


def insert_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(absent_rows(target, batch, keys).select(*target.columns))


def new_movements(ledger: DataFrame, batch: DataFrame, declared: tuple[date, date] | None = None) -> DataFrame:
    """Batch movements not in the ledger yet, by (movement_id, movement_date).

    Only the part of the ledger inside the batch's date range is read. With
    ``declared`` and a partitioned ledger the dates and quarters of the batch are
    looked up first, so that they reach the scan as literals: partitions of other
    quarters are not opened, and row groups of other days are skipped. The batch
    is read for that too, so it should be stored.
    """
    keys = ["movement_id", "movement_date"]
    day = F.col("movement_date")
    if declared is None or QUARTER not in ledger.columns:
        span = batch.agg(F.min("movement_date").alias("low"), F.max("movement_date").alias("high"))
        return absent_rows(ledger.where(day.between(span.select("low").scalar(), span.select("high").scalar())), batch, keys)
    touched = touched_quarters(batch, declared)
    if touched is None:
        return first_per_key(batch, keys)
    low, high, quarters = touched
    return absent_rows(ledger.where(F.col(QUARTER).isin(*quarters) & day.between(F.lit(low), F.lit(high))), batch, keys)
