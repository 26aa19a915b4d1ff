"""Generic table checks. Each returns (constraint_name, target_table, constraint_type, violations) rows.

Checks are gathered into one plan: all checks of a table share a scan, and all
keys and references share one aggregation, so neither the number of scans nor of
shuffles grows with the number of checks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = ["constraint_name", "target_table", "constraint_type", "violations"]
#: Rules of a table that share a bit mask.
MASK_BITS = 60
#: References that are counted side by side in one row of a key.
SLOTS = 2


@dataclass(frozen=True)
class KeyCheck:
    table: str
    columns: tuple[str, ...]
    kind: str = "UNIQUE"

    @property
    def name(self) -> str:
        return f"uq_{self.table}_{'_'.join(self.columns)}"


@dataclass(frozen=True)
class Reference:
    table: str
    column: str
    parent: str
    key: str

    @property
    def name(self) -> str:
        return f"fk_{self.table}_{self.column}"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for one in frames[1:]:
        result = result.unionByName(one)
    return result


def row_rules(df: DataFrame, table: str, rules: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """``rules``: name -> (type, condition that marks a violation). One scan for all of them."""
    counted = df.agg(*[F.count_if(bad).alias(name) for name, (_, bad) in rules.items()])
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("constraint_name"), F.lit(table).alias("target_table"),
            F.lit(kind).alias("constraint_type"), F.col(name).alias("violations"),
        )
        for name, (kind, _) in rules.items()
    ])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def minimum_rows(df: DataFrame, table: str, least: int) -> DataFrame:
    """Number of rows missing to the required minimum."""
    return df.agg(F.greatest(F.lit(least) - F.count(F.lit(1)), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(f"min_rows_{table}").alias("constraint_name"), F.lit(table).alias("target_table"),
        F.lit("MIN_ROWS").alias("constraint_type"), "violations",
    )


def covers_years(df: DataFrame, table: str, day: str, years: Sequence[int]) -> DataFrame:
    """Number of the given years without a row."""
    seen = [F.max(F.year(day) == y).alias(f"y{y}") for y in years]
    missing = sum((F.when(F.col(f"y{y}"), 0).otherwise(1) for y in years), F.lit(0))
    return df.agg(*seen).select(
        F.lit(f"years_{table}_{day}").alias("constraint_name"), F.lit(table).alias("target_table"),
        F.lit("YEARS").alias("constraint_type"), missing.cast("bigint").alias("violations"),
    )


def _zero_rows(df: DataFrame, names: Sequence[tuple]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        list(names), "constraint_name string, target_table string, constraint_type string, _domain int, _slot int, _bit bigint"
    )


def _text(df: DataFrame, column: str) -> Column:
    """The value as text; a date as its day number, which is shorter."""
    value = F.col(column)
    return (F.unix_date(value) if isinstance(df.schema[column].dataType, T.DateType) else value).cast("string")


def _key(tables: Mapping[str, DataFrame], name: str, columns: tuple[str, ...], kind: type | None) -> tuple[Column, Column]:
    """(number, text) of a key, of which one is null; both are null if a column is."""
    df, no_number, no_text = tables[name], F.lit(None).cast("bigint"), F.lit(None).cast("string")
    if kind is not None:
        value = F.col(columns[0])
        return (F.unix_date(value) if kind is T.DateType else value).cast("bigint"), no_text
    if len(columns) == 1:
        return no_number, F.col(columns[0]).cast("string")
    parts = [_text(df, c) for c in columns]
    # Each part says how long it is, so that no two keys give the same text.
    return no_number, F.concat(*[piece for p in parts for piece in (F.length(p).cast("string"), F.lit(":"), p)])


def _number_kind(tables: Mapping[str, DataFrame], members: Sequence[tuple[str, tuple[str, ...]]]) -> type | None:
    """IntegralType or DateType if a key and all that refers to it are of that type and a single column."""
    kinds = {type(tables[name].schema[c].dataType) for name, columns in members for c in columns}
    if any(len(columns) > 1 for _, columns in members):
        return None
    if kinds == {T.DateType}:
        return T.DateType
    return T.IntegralType if all(issubclass(k, T.IntegralType) for k in kinds) else None


def table_checks(
    tables: Mapping[str, DataFrame],
    keys: Sequence[KeyCheck] = (),
    references: Sequence[Reference] = (),
    rules: Mapping[str, Mapping[str, tuple[str, Column]]] | None = None,
) -> DataFrame:
    """All checks in one plan that scans each table once and exchanges each key once.

    A key and the references to it are one domain. Every row gives its keys, the
    values of its references, and the broken rules of its table as one bit mask;
    they are counted by domain and value before and after a single exchange. A
    key that occurs n times has n - 1 surplus rows, and the references to a value
    that is no key are broken. Nulls clash with nothing and refer to nothing.
    """
    rules = rules or {}
    referring: dict[tuple[str, tuple[str, ...]], list[Reference]] = {(c.table, c.columns): [] for c in keys}
    for r in references:
        referring.setdefault((r.parent, (r.key,)), []).append(r)
    # Counters make exchanged rows wide, so a key with many references is several domains of a few each.
    domains = [
        (parent, columns, held[at : at + SLOTS]) for (parent, columns), held in referring.items() for at in range(0, max(len(held), 1), SLOTS)
    ]
    number = {(parent, columns): i for i, (parent, columns, _) in reversed(list(enumerate(domains)))}
    emitted: dict[str, list[Column]] = {}
    names: list[tuple] = [(c.name, c.table, c.kind, number[c.table, c.columns], 0, None) for c in keys]

    def emit(table: str, domain: int, slot: int, value: Column, text: Column) -> None:
        row = F.struct(
            F.lit(domain).alias("_domain"), F.lit(slot).alias("_slot"), value.alias("_number"), text.alias("_text")
        )
        emitted.setdefault(table, []).append(F.when(value.isNotNull() | text.isNotNull(), row))

    for domain, (parent, columns, held) in enumerate(domains):
        kind = _number_kind(tables, [(parent, columns), *[(r.table, (r.column,)) for r in held]])
        emit(parent, domain, 0, *_key(tables, parent, columns, kind))
        for slot, r in enumerate(held, 1):
            emit(r.table, domain, slot, *_key(tables, r.table, (r.column,), kind))
            names.append((r.name, r.table, "FOREIGN_KEY", domain, slot, None))
    domain = first_rule = len(domains)
    for table, held in rules.items():
        for at in range(0, len(held), MASK_BITS):
            some = list(held.items())[at : at + MASK_BITS]
            mask = sum((F.when(bad, F.lit(1 << bit)).otherwise(0) for bit, (_, (_, bad)) in enumerate(some)), F.lit(0).cast("bigint"))
            emit(table, domain, 0, F.nullif(mask, F.lit(0).cast("bigint")), F.lit(None).cast("string"))
            names += [(name, table, kind, domain, 0, 1 << bit) for bit, (name, (kind, _)) in enumerate(some)]
            domain += 1

    rows = union_all([tables[t].select(F.explode(F.array(*made)).alias("r")).select("r.*") for t, made in emitted.items()])
    slots = range(1 + max((len(held) for _, _, held in domains), default=0))
    counted = rows.where("_domain is not null").groupBy("_domain", "_number", "_text").agg(
        *[F.count_if(F.col("_slot") == k).alias(f"_n{k}") for k in slots]
    )
    # Rules are told by their masks, of which few occur; what is left of the other domains is one row each.
    is_rule = F.col("_domain") >= first_rule
    surplus = F.when(is_rule, F.col("_n0")).otherwise(F.greatest(F.col("_n0") - 1, F.lit(0)))
    found = counted.groupBy("_domain", F.when(is_rule, F.col("_number")).alias("_mask")).agg(
        F.array(
            F.sum(surplus), *[F.sum(F.when(F.col("_n0") == 0, F.col(f"_n{k}")).otherwise(0)) for k in slots if k]
        ).alias("_found")
    )
    every = _zero_rows(rows, names)
    told = F.col("_bit").isNull() | (F.col("_mask").bitwiseAND(F.col("_bit")) != 0)
    violations = F.when(told, F.get("_found", F.col("_slot")))
    return every.join(found, "_domain", "left").groupBy(*COLUMNS[:3]).agg(
        F.coalesce(F.sum(violations), F.lit(0)).cast("bigint").alias("violations")
    )


def duplicate_keys(tables: Mapping[str, DataFrame], checks: Sequence[KeyCheck]) -> DataFrame:
    """Surplus rows per key check. Null keys do not clash, as in SQL."""
    return table_checks(tables, keys=checks)


def broken_references(tables: Mapping[str, DataFrame], checks: Sequence[Reference]) -> DataFrame:
    """Child rows whose parent is missing; null references are allowed."""
    return table_checks(tables, references=checks)
