"""Running totals, ranks and order statistics that never put a whole group into one task.

A window partitioned by a coarse key (a category, one busy material, nothing at
all) sorts the complete group in a single task. The functions here cut each
group into *blocks* that follow the sort order. Rows are windowed per block, and
each block starts from the total of the blocks before it. Only the block totals
are windowed over the whole group, and the caller picks a block expression with
a bounded number of values (days, score hundredths, grid cells).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = "_block"


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[Column],
    measures: Mapping[str, Column],
) -> DataFrame:
    """Add for each measure its sum over all rows of the group up to and including this one.

    ``block`` must be a non-decreasing function of the sort order.
    """
    names = list(measures)
    blocked = df.withColumns({_BLOCK: block, **{f"_m_{n}": measures[n] for n in names}})
    group = [*keys, _BLOCK]
    before = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy(*group)
        .agg(*[F.sum(f"_m_{n}").alias(f"_t_{n}") for n in names])
        .select(*group, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in names])
    )
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.withColumns({f"_r_{n}": F.sum(f"_m_{n}").over(inside) for n in names})
    # Null keys form a group, as in a window.
    starts = starts.withColumnsRenamed({c: f"_k_{c}" for c in group})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in group])
    return local.join(starts, same).select(
        *df.columns,
        *[(F.col(f"_s_{n}") + F.coalesce(F.col(f"_r_{n}"), F.lit(0))).alias(n) for n in names],
    )


def _never_null(df: DataFrame, key: str) -> Column:
    """The key with a stand-in for null, so that an ordinary join matches it."""
    kind = df.schema[key].dataType.simpleString()
    stand_in = {"string": F.lit(""), "date": F.lit("1970-01-01"), "boolean": F.lit(False)}.get(kind, F.lit(0))
    return F.coalesce(F.col(key), stand_in.cast(kind))


def running_totals_in_one_scan(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[Column],
    measures: Mapping[str, Column],
) -> DataFrame:
    """The same as ``running_totals``, for an input that is worth reading once only.

    Totals and rows take the same exchange by key and block, whole rows wide, where
    ``running_totals`` reads the input a second time for totals that are summed up
    before they are exchanged. Keys are numbers, text, dates or booleans.
    """
    names = list(measures)
    # Rows, totals and windows share one exchange by plain columns; ``_nulls`` keeps null keys apart from their stand-ins.
    held = [f"_k{i}" for i in range(len(keys))]
    nulls = sum((F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)), F.lit(0))
    dealt = df.withColumns({
        _BLOCK: block, "_nulls": nulls, **{h: _never_null(df, k) for h, k in zip(held, keys, strict=True)}
    }).withColumn(_BLOCK, F.struct(F.col(_BLOCK).alias("at")))
    group = [*held, "_nulls", _BLOCK]
    dealt = dealt.repartition(*group)
    # Column pruning would give each use an exchange of its own; naming every column keeps them the same.
    every = F.xxhash64(*[F.col(c) for c in dealt.columns]).bitwiseAND(F.lit(0))
    before = Window.partitionBy(*held, "_nulls").orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*group)
        .agg(*[F.sum(F.when(every == 0, measures[n])).alias(f"_t_{n}") for n in names])
        .select(*group, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in names])
    )
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({f"_r_{n}": F.sum(measures[n]).over(inside) for n in names})
    return local.join(starts, group).select(
        *df.columns,
        *[(F.col(f"_s_{n}") + F.coalesce(F.col(f"_r_{n}"), F.lit(0))).alias(n) for n in names],
    )


def trailing_sums(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    rows: int,
    measures: Mapping[str, Column],
    chunk: int = 1 << 20,
) -> DataFrame:
    """Sums over the last ``rows`` rows including the current one, by 1-based ``position``.

    Groups are cut into chunks of consecutive positions; the last ``rows - 1``
    rows of a chunk are copied into the next one, so every frame is complete.
    """
    if chunk < rows:
        raise ValueError("chunk must hold a whole frame")
    index = F.col(position) - 1
    own = F.floor(index / F.lit(chunk))
    edge = (index % F.lit(chunk)) >= F.lit(chunk - rows + 1)
    spread = df.withColumn("_own", own).withColumn(
        "_chunk", F.explode(F.when(edge, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))
    )
    frame = Window.partitionBy(*keys, "_chunk").orderBy(position).rowsBetween(-(rows - 1), 0)
    return (
        spread.withColumns({name: F.sum(value).over(frame) for name, value in measures.items()})
        .where(F.col("_chunk") == F.col("_own"))
        .drop("_own", "_chunk")
    )


def dense_ranks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]],
    name: str,
    block: Column | None = None,
) -> DataFrame:
    """Add the dense rank of each row within ``keys``; ``order`` lists (column, ascending).

    Ties collapse first, so only distinct sort keys are ranked and then joined
    back. Without ``block`` the number of distinct sort keys per group must be
    bounded by their domain. Building the plan runs no job; ``df`` is used twice,
    with the same columns, so that both uses take the same exchanges below it.
    """
    columns = [c for c, _ in order]
    sort = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    # As above, naming every column keeps the exchanges the same for both uses.
    every = F.max(F.xxhash64(*df.columns).bitwiseAND(F.lit(0)))
    distinct = df.groupBy(*keys, *columns).agg(every.alias("_every")).where("_every = 0").drop("_every")
    if block is None:
        ranked = distinct.withColumn(name, F.dense_rank().over(Window.partitionBy(*keys).orderBy(*sort)))
    else:
        ranked = running_totals(distinct, keys, block, sort, {name: F.lit(1)})
    ranked = ranked.withColumn(name, F.col(name).cast("bigint"))
    return df.join(ranked, [*keys, *columns], "left").select(*df.columns, name)


def exact_median(df: DataFrame, value: str, block: Column) -> DataFrame:
    """One row, ``median``: interpolated between the two middle values, as a double.

    Equal values are counted first and only the counts are ordered.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ends = running_totals(counts, [], block, [F.col(value)], {"_end": F.col("_n")})
    total = counts.agg(F.sum("_n")).scalar()
    lower, upper = F.floor((total + 1) / 2), F.floor((total + 2) / 2)
    start = F.col("_end") - F.col("_n")
    covers = [(F.col("_end") >= rank) & (start < rank) for rank in (lower, upper)]
    return ends.agg(
        ((F.min(F.when(covers[0], F.col(value))) + F.max(F.when(covers[1], F.col(value)))) / 2.0).alias("median")
    )
