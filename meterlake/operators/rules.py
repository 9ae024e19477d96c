"""The rule catalogue: fixed rules, defaults, loading and synchronisation."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.columns import required

LAYERS = ("landing", "bronze", "silver", "gold")

# --- Fixed values: the nine rules as published (id | name | dimension | description | predicate)
FIXED_CONTRACT_VERSION = 5
FIXED_DEFAULTS = {"severity": "WARN", "maximum_violation_percentage": 0.0, "active": True}
FIXED_RULES = """
vendor_id_null | Vendor não preenchido | completeness | Identifica viagens sem o identificador do provedor TPEP. | vendor_id IS NULL
passenger_count_null | Quantidade de passageiros não preenchida | completeness | Identifica viagens sem a quantidade de passageiros informada. | passenger_count IS NULL
total_amount_null | Valor total não preenchido | completeness | Identifica viagens sem o valor total informado. | total_amount IS NULL
passenger_count_non_positive | Quantidade de passageiros não positiva | validity | Identifica viagens com quantidade de passageiros menor ou igual a zero. | passenger_count <= 0
total_amount_non_positive | Valor total não positivo | validity | Identifica viagens com valor total menor ou igual a zero. | total_amount <= 0
invalid_trip_chronology | Cronologia inválida da viagem | validity | Identifica viagens cujo desembarque ocorreu antes do embarque. | dropoff_datetime < pickup_datetime
trip_duration_over_24_hours | Duração da viagem superior a 24 horas | validity | Identifica viagens cuja duração entre embarque e desembarque supera 24 horas. | dropoff_datetime > pickup_datetime + INTERVAL 24 HOURS
pickup_before_reference_month | Embarque anterior ao mês de referência | consistency | Identifica viagens cujo embarque ocorreu antes do primeiro dia do mês indicado pelo arquivo de origem. | pickup_datetime < try_to_timestamp(concat(reference_month, '-01'))
trip_datetime_after_reference_month | Data da viagem posterior ao mês de referência | consistency | Identifica viagens cujo embarque ou desembarque ocorreu a partir do primeiro dia do mês seguinte ao indicado pelo arquivo de origem. | pickup_datetime >= add_months(try_to_timestamp(concat(reference_month, '-01')), 1) OR dropoff_datetime >= add_months(try_to_timestamp(concat(reference_month, '-01')), 1)
"""
# --- End of fixed values. try_to_timestamp instead of to_timestamp: a file name without a
# month must not abort the evaluation of the others.

REQUIRED_KEYS = ("id", "name", "dimension", "description", "expression", "layers")

RULE_DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("rule_id", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("expression", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("maximum_violation_percentage", T.DoubleType()),
        T.StructField("layers", T.ArrayType(T.StringType(), False)),
        T.StructField("active", T.BooleanType()),
    ]
)

CATALOG_COMMENTS = {
    "rule_id": "Stable identifier of the rule",
    "rule_name": "Readable name",
    "dimension": "Quality dimension",
    "description": "What the rule detects",
    "expression": "Predicate a violating row satisfies",
    "severity": "Status given when the limit is exceeded",
    "maximum_violation_percentage": "Largest accepted share of violations in percent",
    "layers": "Layers the rule applies to",
    "active": "Whether the rule is evaluated",
    "contract_version": "Version of the rule contract",
    "created_at": "When the rule entered the catalogue",
    "updated_at": "When the rule was last synchronised",
}
CATALOG_TYPES = {
    **{f.name: f.dataType for f in RULE_DOCUMENT_SCHEMA.fields},
    "contract_version": T.IntegerType(),
    "created_at": T.TimestampType(),
    "updated_at": T.TimestampType(),
}
CATALOG_SCHEMA = T.StructType(
    [T.StructField(name, CATALOG_TYPES[name], False, {"comment": text}) for name, text in CATALOG_COMMENTS.items()]
)


def fixed_rule_document() -> dict:
    """The published rule contract in the shape a rules file has."""
    keys = ("id", "name", "dimension", "description", "expression")
    rules = [
        {**dict(zip(keys, (cell.strip() for cell in line.split("|", 4)), strict=True)), "layers": list(LAYERS)}
        for line in FIXED_RULES.strip().splitlines()
    ]
    return {"version": FIXED_CONTRACT_VERSION, "defaults": dict(FIXED_DEFAULTS), "rules": rules}


def load_rule_document(text: str) -> dict:
    """Parse a rules file: JSON, or YAML where PyYAML is installed."""
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("a YAML rules file needs PyYAML; JSON works without it") from missing
        return yaml.safe_load(text)


def validate_rule_document(document: dict) -> None:
    absent = FIXED_DEFAULTS.keys() - document.get("defaults", {}).keys()
    if absent:
        raise ValueError(f"rule defaults lack: {', '.join(sorted(absent))}")
    seen = set()
    for rule in document["rules"]:
        missing = [key for key in REQUIRED_KEYS if not rule.get(key)]
        if missing:
            raise ValueError(f"rule {rule.get('id')!r} lacks: {', '.join(missing)}")
        if rule["id"] in seen:
            raise ValueError(f"rule id used twice: {rule['id']}")
        seen.add(rule["id"])


def rule_frame(spark: SparkSession, document: dict) -> DataFrame:
    """The rules of a document as rows, with its defaults applied."""
    validate_rule_document(document)
    rows = [
        (
            rule["id"],
            rule["name"],
            rule["dimension"],
            rule["description"],
            rule["expression"],
            rule.get("severity"),
            None if rule.get("maximum_violation_percentage") is None else float(rule["maximum_violation_percentage"]),
            list(rule["layers"]),
            None if rule.get("active") is None else bool(rule["active"]),
        )
        for rule in document["rules"]
    ]
    return resolve_defaults(spark.createDataFrame(rows, RULE_DOCUMENT_SCHEMA), document["defaults"])


def resolve_defaults(rules: DataFrame, defaults: dict) -> DataFrame:
    """Severity, limit and activity of a rule, or the default where the rule is silent."""
    return rules.withColumns(
        {
            "severity": F.coalesce("severity", F.lit(defaults["severity"])),
            "maximum_violation_percentage": F.coalesce(
                "maximum_violation_percentage", F.lit(float(defaults["maximum_violation_percentage"]))
            ),
            "active": F.coalesce("active", F.lit(bool(defaults["active"]))),
        }
    )


def active_rules(catalog: DataFrame) -> DataFrame:
    return catalog.filter("active").select(
        "rule_id", "expression", "severity", "maximum_violation_percentage", "layers"
    )


def synchronised_catalog(catalog: DataFrame, rules: DataFrame, contract_version: int, now) -> DataFrame:
    """Catalogue after a synchronisation with ``rules``.

    Known rules take every field of the new version and keep their creation time, new
    rules are added, and rules that left the contract stay, inactive. A full outer join
    on the key says all three in one pass.
    """
    now = F.lit(now) if not hasattr(now, "alias") else now
    document = [f.name for f in RULE_DOCUMENT_SCHEMA.fields if f.name != "rule_id"]
    old = catalog.select("rule_id", F.struct(*[c for c in catalog.columns if c != "rule_id"]).alias("old"))
    new = rules.select("rule_id", F.struct(*document).alias("new"))
    retained = F.col("new").isNotNull()
    picked = {name: F.when(retained, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")) for name in document}
    picked["active"] = F.when(retained, F.col("new.active")).otherwise(F.lit(False))
    return old.join(new, "rule_id", "full_outer").select(
        "rule_id",
        *[picked[name].alias(name) for name in document],
        F.when(retained, F.lit(int(contract_version))).otherwise(F.col("old.contract_version")).alias("contract_version"),
        F.coalesce(F.col("old.created_at"), now).alias("created_at"),
        now.alias("updated_at"),
    )


def checked_catalog(catalog: DataFrame) -> DataFrame:
    """The catalogue with its NOT NULL columns verified while it is written."""
    return catalog.select(*[required(f.name) for f in CATALOG_SCHEMA.fields])
