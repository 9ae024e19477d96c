"""Rule evaluation over the layers, run history and the promotion gate."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.contracts import LOGICAL_TYPES, union_all
from meterlake.functions.columns import canonical_value, local_date, required, sql_text
from meterlake.operators.rules import LAYERS

# The zone whose calendar day a run belongs to, and the note on each result.
FIXED_LOCAL_ZONE = "America/Sao_Paulo"
FIXED_DETAILS = "A condição versionada no catálogo define os registros contabilizados como violação."

CANONICAL_TYPES = {
    "vendor_id": "long",
    "passenger_count": "double",
    "total_amount": "double",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "reference_month": "string",
}

RESULT_COLUMNS = (
    ("execution_id", T.StringType(), False, "Identifier of the run"),
    ("executed_at", T.TimestampType(), False, "Instant of the evaluation"),
    ("rule_id", T.StringType(), False, "Rule evaluated"),
    ("layer", T.StringType(), False, "Layer evaluated"),
    ("table_name", T.StringType(), False, "Table or file set evaluated"),
    ("reference_start", T.DateType(), True, "First day of the reference window"),
    ("reference_end", T.DateType(), True, "Last day of the reference window"),
    ("total_rows", T.LongType(), False, "Rows evaluated"),
    ("violation_count", T.LongType(), False, "Rows that violate the rule"),
    ("violation_percentage", T.DoubleType(), False, "Share of violating rows in percent"),
    ("maximum_violation_percentage", T.DoubleType(), False, "Largest accepted share in percent"),
    ("status", T.StringType(), False, "OK, WARN or FAIL"),
    ("details", T.StringType(), True, "Remark on the evaluation"),
)
RESULT_SCHEMA = T.StructType(
    [T.StructField(name, kind, nullable, {"comment": text}) for name, kind, nullable, text in RESULT_COLUMNS]
)
RESULT_NAMES = [name for name, *_ in RESULT_COLUMNS]


@dataclass(frozen=True)
class Layer:
    """One thing to evaluate: where it sits, what it is called, its canonical rows."""

    name: str
    table_name: str
    frame: DataFrame


@dataclass(frozen=True)
class Run:
    execution_id: str
    executed_at: datetime
    reference_start: date | None
    reference_end: date | None


def canonical_projection(frame: DataFrame, **sources: str | None) -> DataFrame:
    """The six columns rules may use. A source of ``None`` yields a typed null."""
    found = {name: f"`{sources[name]}`" if sources.get(name) else "NULL" for name in CANONICAL_TYPES}
    return frame.selectExpr(*[f"CAST({found[name]} AS {kind}) AS {name}" for name, kind in CANONICAL_TYPES.items()])


def landing_projection(frame: DataFrame) -> DataFrame:
    """The columns rules may use, from raw files: whatever the spelling and type, never an error.

    A value that does not fit and a column a file lacks are null, as they are in bronze.
    """
    sources = {
        "vendor_id": "VendorID",
        "passenger_count": "passenger_count",
        "total_amount": "total_amount",
        "pickup_datetime": "tpep_pickup_datetime",
        "dropoff_datetime": "tpep_dropoff_datetime",
        "reference_month": "reference_month",
    }
    physical = {f.name.lower(): (f.name, f.dataType) for f in frame.schema.fields}
    return frame.select(
        *[
            canonical_value(sources[name], LOGICAL_TYPES[kind], physical, None).alias(name)
            for name, kind in CANONICAL_TYPES.items()
        ]
    )


def table_projection(frame: DataFrame, vendor_id: str, reference_month: str | None = "_reference_month") -> DataFrame:
    return canonical_projection(
        frame,
        vendor_id=vendor_id,
        passenger_count="passenger_count",
        total_amount="total_amount",
        pickup_datetime="tpep_pickup_datetime",
        dropoff_datetime="tpep_dropoff_datetime",
        reference_month=reference_month,
    )


def parse_layers(text: str) -> tuple[str, ...]:
    """Comma-separated layer names; unknown names and an empty list are errors."""
    names = tuple(part.strip() for part in text.split(",") if part.strip())
    unknown = sorted(set(names) - set(LAYERS))
    if unknown or not names:
        raise ValueError(f"unknown layers: {', '.join(unknown) or 'none given'}")
    return names


def load_rules(active: DataFrame) -> list[dict]:
    """Active rules on the driver: they are the text of the aggregation to come."""
    rules = [row.asDict(recursive=True) for row in active.collect()]
    if not rules:
        raise RuntimeError("the rule catalogue holds no active rule")
    return rules


def evaluate(layers: list[Layer], rules: list[dict], run: Run) -> DataFrame:
    """Results of every applicable rule on every layer, as one lazy frame.

    Each layer is scanned once, with all its rules as conditional counts of a global
    aggregate; tasks send one partial row. A layer without rows still yields its rules.
    """
    counted = [
        _count_violations(layer, applicable)
        for layer in layers
        if (applicable := [rule for rule in rules if layer.name in rule["layers"]])
    ]
    if not counted:
        return layers[0].frame.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return with_status(union_all(counted), run)


def _count_violations(layer: Layer, rules: list[dict]) -> DataFrame:
    # A rule that evaluates to null is not violated; count_if skips nulls the same way.
    counts = [F.expr(f"count_if(boolean({rule['expression']})) AS v{i}") for i, rule in enumerate(rules)]
    per_rule = ", ".join(
        f"struct({sql_text(rule['rule_id'])} AS rule_id, v{i} AS violation_count, "
        f"double({float(rule['maximum_violation_percentage'])!r}) AS maximum_violation_percentage, "
        f"{sql_text(rule['severity'].upper())} AS severity)"
        for i, rule in enumerate(rules)
    )
    return layer.frame.agg(F.count(F.lit(1)).alias("total_rows"), *counts).selectExpr(
        f"{sql_text(layer.name)} AS layer",
        f"{sql_text(layer.table_name)} AS table_name",
        "total_rows",
        f"inline(array({per_rule}))",
    )


def with_status(counted: DataFrame, run: Run) -> DataFrame:
    """Results from rows of layer, table, rule, counts, limit and severity."""

    def day(value: date | None) -> str:
        return f"DATE'{value.isoformat()}'" if value else "CAST(NULL AS DATE)"

    share = "CASE WHEN total_rows > 0 THEN double(100) * violation_count / total_rows ELSE double(0) END"
    constants = {
        "execution_id": sql_text(run.execution_id),
        "executed_at": f"CAST({sql_text(run.executed_at.isoformat())} AS TIMESTAMP)",
        "reference_start": day(run.reference_start),
        "reference_end": day(run.reference_end),
        "status": "CASE WHEN violation_percentage <= maximum_violation_percentage THEN 'OK' ELSE severity END",
        "details": sql_text(FIXED_DETAILS),
    }
    return counted.selectExpr("*", f"{share} AS violation_percentage").selectExpr(
        *[f"{constants[name]} AS {name}" if name in constants else name for name in RESULT_NAMES]
    )


def checked_results(results: DataFrame) -> DataFrame:
    """Results with their NOT NULL columns verified while they are written."""
    return results.select(*[F.col(n) if nullable else required(n) for n, _, nullable, _ in RESULT_COLUMNS])


def execution_date(executed_at: Column) -> Column:
    return local_date(executed_at, FIXED_LOCAL_ZONE)


class GateFailure(RuntimeError):
    """Raised after results were stored, when a rule failed and the gate is on."""


def enforce_gate(results: DataFrame) -> None:
    failed = results.filter(F.col("status") == "FAIL").select("layer", "rule_id").collect()
    if failed:
        names = ", ".join(sorted(f"{row['layer']}.{row['rule_id']}" for row in failed))
        raise GateFailure(f"{len(failed)} failed rule result(s) block the promotion to gold: {names}")
