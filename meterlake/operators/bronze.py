"""Bronze: contract-typed rows with lineage, nothing of the source lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.contracts import RESCUED_COLUMN, Contract, union_all
from meterlake.functions.columns import canonical_value, holds, rescued_values
from meterlake.functions.months import month_of_name
from meterlake.sources.landing import SchemaGroup

# The parsed map lives under this name between two projections, so that JSON is
# parsed once per row and not once per contract column.
PARSED = "_rescued_values"


def physical_columns(schema: T.StructType) -> dict[str, tuple[str, T.DataType]]:
    return {f.name.lower(): (f.name, f.dataType) for f in schema.fields}


def canonical_columns(frame: DataFrame, contract: Contract, carry: list[str]) -> DataFrame:
    """Contract columns of a physical frame plus ``_rescued_data``; ``carry`` passes through.

    ``_rescued_data`` is the JSON of every source column the contract does not name and of
    every value its contract type cannot hold, which nothing else would preserve. A fraction
    in a whole-number column is cut in the column and kept whole here. Rescue text a file
    brought along comes first; a key of the file that this text already uses is stored as
    ``_column_<name>``, and rescue text that is no JSON object under its column's name.
    """
    source = T.StructType([f for f in frame.schema.fields if f.name not in carry])
    physical = physical_columns(source)
    has_rescue = RESCUED_COLUMN.name in physical
    parsed = frame
    if has_rescue:
        own = F.col(f"`{physical[RESCUED_COLUMN.name][0]}`").cast("string")
        parsed = frame.select("*", rescued_values(own).alias(PARSED))
    rescued = F.col(PARSED) if has_rescue else None

    values = [
        canonical_value(c.name, c.data_type, physical, rescued, contract.aliases.get(c.name, ()))
        for c in contract.columns
    ]
    leftovers = _leftovers(source, contract, physical)
    if not has_rescue:
        spilled = _as_json([raw.alias(name) for name, raw in leftovers])
    else:
        spilled = _with_own_rescue(F.col(f"`{physical[RESCUED_COLUMN.name][0]}`").cast("string"), leftovers)
    return parsed.select(*values, spilled.alias(RESCUED_COLUMN.name), *carry)


def _as_json(fields: list[Column]) -> Column:
    """JSON of the fields that are not null, or null where none is."""
    return F.nullif(F.to_json(F.struct(*fields)), F.lit("{}")) if fields else F.lit(None).cast("string")


def _with_own_rescue(own: Column, leftovers: list[tuple[str, Column]]) -> Column:
    """The file's own rescue text and the leftovers of the same row as one JSON object."""
    fields = []
    for name, raw in leftovers:
        taken = F.coalesce(F.map_contains_key(F.col(PARSED), F.lit(name)), F.lit(False))
        fields += [F.when(~taken, raw).alias(name), F.when(taken, raw).alias(f"_column_{name}")]
    spilled = _as_json(fields)
    inside = F.regexp_extract(own, r"(?s)^\s*\{(.*)\}\s*$", 1)
    both = F.when(F.trim(inside) == "", spilled).otherwise(
        F.concat(F.lit("{"), inside, F.lit(","), F.substring(spilled, F.lit(2), F.length(spilled)))
    )
    beside = _as_json([own.alias(RESCUED_COLUMN.name), *fields])
    is_object = F.col(PARSED).isNotNull() & own.rlike(r"(?s)^\s*\{.*\}\s*$")
    return F.when(own.isNull() | spilled.isNull(), F.coalesce(own, spilled)).when(is_object, both).otherwise(beside)


def _leftovers(source: T.StructType, contract: Contract, physical: dict) -> list[tuple[str, Column]]:
    """What the contract columns do not carry: undeclared columns and values that did not fit."""
    declared = {c.name.lower(): c for c in contract.columns}
    found = []
    for field in source.fields:
        column = declared.get(field.name.lower())
        raw = F.col(f"`{field.name}`")
        if field.name == physical.get(RESCUED_COLUMN.name, (None,))[0]:
            continue
        if column is None or physical[field.name.lower()][0] != field.name:
            found.append((field.name, raw))
        elif field.dataType != column.data_type and not _widens(field.dataType, column.data_type):
            found.append((field.name, F.when(~holds(field.name, field.dataType, column.data_type), raw)))
    return found


def _widens(kind: T.DataType, target: T.DataType) -> bool:
    """Casts that hold every value, so nothing can be left over."""
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    return (
        (isinstance(target, (T.LongType, T.DoubleType)) and isinstance(kind, whole))
        or (isinstance(target, T.DoubleType) and isinstance(kind, T.FloatType))
        or (isinstance(target, T.TimestampType) and isinstance(kind, T.TimestampNTZType))
        or isinstance(target, T.StringType)
    )


def bronze_group(frame: DataFrame, contract: Contract) -> DataFrame:
    """Bronze rows of files that share one schema; ``frame`` must be a file scan."""
    carry = ["_source_file", "_reference_month"]
    scanned = frame.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        month_of_name(F.col("_metadata.file_name")).alias("_reference_month"),
    )
    return with_lineage(canonical_columns(scanned, contract, carry), contract)


def with_lineage(canonical: DataFrame, contract: Contract) -> DataFrame:
    return canonical.select(
        *[c.name for c in contract.columns],
        RESCUED_COLUMN.name,
        "_source_file",
        F.current_timestamp().alias("_ingested_at"),
        F.lit(contract.dataset).alias("_service_type"),
        "_reference_month",
    )


def bronze_rows(spark: SparkSession, groups: list[SchemaGroup], contract: Contract) -> DataFrame:
    """One narrow branch per schema: scan, project, union. No shuffle."""
    return union_all([bronze_group(group.read(spark), contract) for group in groups])
