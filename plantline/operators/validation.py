"""Batch validation with a dead-letter split, as column expressions.

A row is a duplicate when an earlier row with its key was valid; that test comes
before the schema check, and invalid rows do not claim their key. The earliest
valid position per key is found with a plain aggregation (combined before the
shuffle) and joined back, so one key repeated in much of the batch does not end
up in a single window task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERR_SCHEMA = "ERR_SCHEMA_VALIDATION"
ERR_DUPLICATE = "ERR_DUPLICATE_KEY"
# Reserved for failures outside the declared rules; parsing here never raises.
ERR_UNEXPECTED = "ERR_UNEXPECTED"

# Message texts, accepted flag spellings, domains.
MISSING = "Field required"
NOT_A_NUMBER = "Input should be a valid number, unable to parse string as a number"
NOT_WHOLE = "Input should be a valid integer, unable to parse string as an integer"
NOT_A_FLAG = "Input should be a valid boolean, unable to interpret input"
BOUND_TEXT = {
    "gt": "Input should be greater than {}",
    "ge": "Input should be greater than or equal to {}",
    "le": "Input should be less than or equal to {}",
}
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")
TIERS = ("TIER_1", "TIER_2", "TIER_3")
MOVEMENT_TYPES = (
    "CYCLE_ADJUSTMENT", "GOODS_RECEIPT", "PRODUCTION_ISSUE", "SCRAP", "TRANSFER_IN", "TRANSFER_OUT",
)
DAY_FORMAT = "yyyy-M-d"
DAY_FORMAT_TEXT = "%Y-%m-%d"

TYPES = {"text": "string", "number": "double", "whole": "bigint", "flag": "boolean"}

Rule = Callable[["Values"], Column]


@dataclass(frozen=True)
class FieldSpec:
    name: str
    kind: str = "text"
    required: bool = True
    default: object = None
    bounds: tuple[tuple[str, int], ...] = ()
    rule: Rule | None = None
    after: tuple[str, ...] = ()  # fields whose validity the rule asks for


@dataclass(frozen=True)
class EntitySpec:
    key: str
    fields: tuple[FieldSpec, ...] = field(default_factory=tuple)


class Values:
    """Field values as seen by a rule: ``of`` is the parsed value, ``valid`` is null unless the field passed.

    Parsed values and errors are columns of the checked batch, so that each is
    computed once per row however many checks read it.
    """

    def __init__(self, spec: EntitySpec):
        self.specs = {f.name: f for f in spec.fields}

    def of(self, name: str) -> Column:
        return raw_text(name) if self.specs[name].kind == "text" else F.col(f"_v_{name}")

    def valid(self, name: str) -> Column:
        return F.when(F.col(f"_e_{name}").isNull(), self.of(name))


def raw_text(name: str) -> Column:
    return F.col(name).cast("string")


def parsed(spec: FieldSpec) -> Column:
    """Typed value, null when missing or unreadable; the default stands in for a missing value."""
    text = raw_text(spec.name)
    word = F.trim(text)
    if spec.kind == "number":
        # The cast alone would also take NaN, Infinity and the suffixes d and f.
        value = F.when(~word.rlike("[a-df-zA-DF-Z]"), word.try_cast("double"))
    elif spec.kind == "whole":
        # Text such as 14.0 is a whole number too; the pattern runs only where the cast fails.
        value = F.coalesce(
            word.try_cast("bigint"), F.regexp_extract(word, r"^([+-]?\d+)\.0*$", 1).try_cast("bigint")
        )
    elif spec.kind == "flag":
        lower = F.lower(word)
        value = F.when(lower.isin(*TRUE_WORDS), True).when(lower.isin(*FALSE_WORDS), False)
    else:
        value = text
    if spec.default is None:
        return value
    return F.when(text.isNull(), F.lit(spec.default)).otherwise(value)


def field_error(spec: FieldSpec, values: Values) -> Column:
    """Message of the first failed check of one field, or null."""
    missing = raw_text(spec.name).isNull()
    value = values.of(spec.name)
    checks: list[tuple[Column, Column]] = []
    if spec.required and spec.default is None:
        checks.append((missing, F.lit(MISSING)))
    unreadable = {"number": NOT_A_NUMBER, "whole": NOT_WHOLE, "flag": NOT_A_FLAG}.get(spec.kind)
    if unreadable:
        checks.append((~missing & value.isNull(), F.lit(unreadable)))
    for bound, limit in spec.bounds:
        broken = {"gt": value <= limit, "ge": value < limit, "le": value > limit}[bound]
        checks.append((broken, F.lit(BOUND_TEXT[bound].format(limit))))
    result = F.lit(None).cast("string")
    if spec.rule is not None:
        result = F.when(~missing, F.concat(F.lit("Value error, "), spec.rule(values)))
    for broken, message in reversed(checks):
        result = F.when(broken, message).otherwise(result)
    return result


def known_tier(values: Values) -> Column:
    tier = values.of("tier")
    allowed = "{" + ", ".join(f"'{t}'" for t in TIERS) + "}"
    return F.when(
        ~tier.isin(*TIERS), F.concat(F.lit("Invalid supplier tier: "), tier, F.lit(f". Expected one of {allowed}"))
    )


def reorder_covers_safety(values: Values) -> Column:
    reorder, safety = values.of("reorder_point"), values.valid("safety_stock_level")
    return F.when(
        reorder < safety,
        F.format_string("Reorder point (%d) must be greater than or equal to safety stock (%d)", reorder, safety),
    )


def promised_after_ordered(values: Values) -> Column:
    ordered, promised = values.of("order_date"), values.of("promised_delivery_date")

    def unreadable(text: Column) -> Column:
        return F.format_string(f"time data '%s' does not match format '{DAY_FORMAT_TEXT.replace('%', '%%')}'", text)

    start, end = F.try_to_date(ordered, DAY_FORMAT), F.try_to_date(promised, DAY_FORMAT)
    return F.when(
        ordered.isNotNull() & (ordered != ""),
        F.when(start.isNull(), unreadable(ordered))
        .when(end.isNull(), unreadable(promised))
        .when(
            end < start,
            F.format_string("Promised delivery date (%s) cannot be before order date (%s)", promised, ordered),
        ),
    )


def known_movement_type(values: Values) -> Column:
    kind = values.of("movement_type")
    allowed = "{" + ", ".join(f"'{t}'" for t in MOVEMENT_TYPES) + "}"
    return F.when(
        ~kind.isin(*MOVEMENT_TYPES), F.concat(F.lit("Invalid movement type '"), kind, F.lit(f"'. Allowed: {allowed}"))
    )


def quantity_sign(values: Values) -> Column:
    quantity, kind = values.of("quantity"), values.valid("movement_type")
    return F.when(
        (kind == "GOODS_RECEIPT") & (quantity <= 0), F.lit("GOODS_RECEIPT movements must have positive quantity.")
    ).when(
        kind.isin("PRODUCTION_ISSUE", "SCRAP") & (quantity > 0),
        F.concat(kind, F.lit(" movements must have negative quantity consumption.")),
    )


def _texts(*names: str) -> tuple[FieldSpec, ...]:
    return tuple(FieldSpec(n) for n in names)


SHARE = (("ge", 0), ("le", 100))
POSITIVE = (("gt", 0),)
NOT_NEGATIVE = (("ge", 0),)

ENTITIES: dict[str, EntitySpec] = {
    "suppliers": EntitySpec("supplier_id", (
        *_texts("supplier_id", "code", "name", "category", "country", "city"),
        FieldSpec("tier", rule=known_tier),
        FieldSpec("reliability_rating", "number", bounds=SHARE),
        FieldSpec("financial_health_score", "number", bounds=SHARE),
        FieldSpec("baseline_lead_time_days", "whole", bounds=POSITIVE),
        *_texts("payment_terms"),
        FieldSpec("iso_certified", "flag"),
        FieldSpec("is_active", "flag", default=True),
    )),
    "materials": EntitySpec("material_id", (
        *_texts("material_id", "sku", "name", "category", "unit_of_measure"),
        FieldSpec("standard_cost", "number", bounds=POSITIVE),
        FieldSpec("current_unit_price", "number", bounds=POSITIVE),
        FieldSpec("safety_stock_level", "whole", bounds=NOT_NEGATIVE),
        FieldSpec(
            "reorder_point", "whole", bounds=NOT_NEGATIVE, rule=reorder_covers_safety, after=("safety_stock_level",)
        ),
        FieldSpec("target_stock_level", "whole", bounds=NOT_NEGATIVE),
        FieldSpec("min_order_qty", "whole", bounds=POSITIVE),
        FieldSpec("lead_time_days", "whole", bounds=POSITIVE),
        FieldSpec("is_critical", "flag"),
        *_texts("primary_supplier_id"),
        FieldSpec("secondary_supplier_id", required=False),
    )),
    "purchase_orders": EntitySpec("po_id", (
        *_texts("po_id", "po_number", "supplier_id", "factory_id", "warehouse_id", "order_date"),
        FieldSpec("promised_delivery_date", rule=promised_after_ordered),
        *_texts("status"),
        FieldSpec("total_amount", "number", bounds=NOT_NEGATIVE),
        FieldSpec("currency", default="USD"),
    )),
    "inventory_movements": EntitySpec("movement_id", (
        *_texts("movement_id", "material_id", "warehouse_id", "factory_id", "movement_date"),
        FieldSpec("movement_type", rule=known_movement_type),
        FieldSpec("quantity", "whole", rule=quantity_sign, after=("movement_type",)),
        *_texts("reference_doc_type", "reference_doc_id"),
    )),
}


def with_all_fields(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """Fields the batch lacks count as missing values."""
    absent = {f.name: F.lit(None).cast("string") for f in spec.fields if f.name not in raw.columns}
    return raw.withColumns(absent) if absent else raw


def checked(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """Add ``_problem``: the errors of all fields in field order, empty for a row that passes."""
    values = Values(spec)
    typed = raw.withColumns({f"_v_{f.name}": parsed(f) for f in spec.fields if f.kind != "text"})
    first = typed.withColumns({f"_e_{f.name}": field_error(f, values) for f in spec.fields if not f.after})
    dependent = {f"_e_{f.name}": field_error(f, values) for f in spec.fields if f.after}
    judged = first.withColumns(dependent) if dependent else first
    lines = [F.concat(F.lit(f"{f.name}: "), F.col(f"_e_{f.name}")) for f in spec.fields]
    return judged.select(*raw.columns, F.concat_ws("; ", *lines).alias("_problem"))


def classify(entity: str, raw: DataFrame, seq: str) -> DataFrame:
    """The batch with ``error_code`` and ``error_reason``, both null for a valid row.

    ``seq`` gives the batch order and must be unique.
    """
    spec = ENTITIES[entity]
    batch = with_all_fields(raw, spec)
    rows = checked(batch, spec)
    # A key that occurs once is no duplicate of its own row: only the others are joined back.
    claimed = rows.groupBy(spec.key).agg(
        F.min(F.when(F.col("_problem") == "", F.col(seq))).alias("_claimed_at"), F.count(F.lit(1)).alias("_rows")
    ).where("_rows > 1 and _claimed_at is not null").drop("_rows")
    duplicate = F.col(seq) > F.col("_claimed_at")
    invalid = F.col("_problem") != ""
    return rows.join(claimed, spec.key, "left").select(
        *batch.columns,
        F.when(duplicate, ERR_DUPLICATE).when(invalid, ERR_SCHEMA).alias("error_code"),
        F.when(
            duplicate,
            F.concat(F.lit("Duplicate primary business key '"), raw_text(spec.key), F.lit("' detected in batch.")),
        ).when(invalid, F.col("_problem")).alias("error_reason"),
    )


def accepted(entity: str, classified: DataFrame) -> DataFrame:
    """Valid rows with the declared fields only, typed."""
    spec = ENTITIES[entity]
    return classified.where(F.col("error_code").isNull()).select(
        *[parsed(f).cast(TYPES[f.kind]).alias(f.name) for f in spec.fields]
    )


def rejected(
    entity: str, classified: DataFrame, seq: str, raw_columns: list[str], run_name: str, batch_id: str | None
) -> DataFrame:
    """Dead-letter rows; the payload is the raw row as JSON, nulls included."""
    payload = F.to_json(F.struct(*[c for c in raw_columns if c != seq]), {"ignoreNullFields": "false"})
    return classified.where(F.col("error_code").isNotNull()).select(
        F.lit(run_name).alias("pipeline_name"),
        F.lit(batch_id).cast("string").alias("batch_id"),
        F.lit(f"raw_{entity}").alias("source_table"),
        payload.alias("payload"),
        "error_code",
        "error_reason",
    )


def validate(
    entity: str, raw: DataFrame, seq: str, run_name: str, batch_id: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(accepted, rejected). An entity without declared rules passes through untouched."""
    if entity not in ENTITIES:
        return raw, None
    classified = classify(entity, raw, seq)
    return accepted(entity, classified), rejected(entity, classified, seq, raw.columns, run_name, batch_id)


def batch_counts(entity: str, classified: DataFrame) -> DataFrame:
    """One row: extracted, valid and rejected counts, in one pass."""
    return classified.agg(
        F.lit(entity).alias("entity"),
        F.count(F.lit(1)).alias("rows_extracted"),
        F.count_if(F.col("error_code").isNull()).alias("rows_loaded"),
        F.count_if(F.col("error_code").isNotNull()).alias("rows_rejected"),
        F.count_if(F.col("error_code") == ERR_SCHEMA).alias("schema_errors"),
        F.count_if(F.col("error_code") == ERR_DUPLICATE).alias("duplicate_keys"),
    )
