"""Pairing every row of one table with every row of a small one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_with_all(left: DataFrame, spread_by: str, right: DataFrame, copies: int | None = None) -> DataFrame:
    """All (left, right) pairs, as an equi-join on a slot number.

    Each left row gets a slot by hash and ``right`` is repeated once per slot;
    both sides are shuffled by slot, which spreads the work evenly over
    ``copies`` slots, by default one per shuffle partition. A broadcast is ruled
    out, as size estimates do not count the repetition.
    """
    copies = copies or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    slotted = left.withColumn("_slot", F.pmod(F.hash(spread_by), F.lit(copies)))
    repeated = right.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return slotted.join(repeated.hint("merge"), "_slot").drop("_slot")
