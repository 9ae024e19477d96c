"""Contract coverage: which fields are documented, which are not, which never arrived.

Fields come from footers, from the schemas of stored tables, or from the values that rows really hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.contracts import RESCUED_COLUMN, TRIP_SERVICES
from meterlake.sources.landing import with_identity
from meterlake.sources.metadata import dictionary_url

DOCUMENTED = "DOCUMENTED"
UNDOCUMENTED = "UNDOCUMENTED"
MISSING_IN_SOURCE = "MISSING_IN_SOURCE"


def physical_fields(footers: DataFrame) -> DataFrame:
    """Distinct fields per service over all footers: (``dataset``, ``column_name``, ``actual_type``).

    Types of a field that drifted are listed together. The aggregation leaves one row per
    field, however many files there are.
    """
    return (
        with_identity(footers)
        .select(F.col("service").alias("dataset"), F.explode("fields").alias("field"))
        .groupBy("dataset", F.lower("field.name").alias("field_key"))
        .agg(
            F.max("field.name").alias("column_name"),
            F.concat_ws("|", F.sort_array(F.collect_set("field.type"))).alias("actual_type"),
        )
        .drop("field_key")
    )


def table_fields(spark, tables: dict[str, str]) -> DataFrame:
    """Fields of stored tables, from their schemas alone."""
    rows = [
        (dataset, field.name, field.dataType.simpleString())
        for dataset, table in tables.items()
        for field in spark.table(table).schema.fields
    ]
    return spark.createDataFrame(rows, "dataset string, column_name string, actual_type string")


def _kind_of_variant() -> str:
    """SQL: the logical type of a variant ``value``; whole numbers are long, others double, whatever their digits."""
    kind = "schema_of_variant(value)"
    return (
        f"CASE WHEN {kind} = 'BIGINT' THEN 'long' WHEN {kind} = 'DOUBLE' OR startswith({kind}, 'DECIMAL') THEN 'double' "
        f"ELSE lower(split({kind}, '<')[0]) END"
    )


def held_fields(rows: DataFrame, dataset: str, rescued: str = RESCUED_COLUMN.name) -> DataFrame:
    """Fields that any row holds a value of: (``dataset``, ``column_name``, ``actual_type``, ``held_rows``).

    Typed columns are counted in one pass, however many there are. Of the rescued JSON each key is a
    field, and its types are those of its values, row by row; text that is no JSON object has no fields. Names that
    differ in case only are one field. Both aggregates are reduced in the tasks, so one key in all rows is no hot key.
    """
    columns = [f for f in rows.schema.fields if f.name != rescued]
    counted = rows.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"held{i}") for i, f in enumerate(columns)])
    typed = [
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.typeName()).alias("type"), F.col(f"held{i}").alias("held"))
        for i, f in enumerate(columns)
    ]
    found = counted.select(F.explode(F.array(*typed)).alias("f")).select("f.name", "f.type", "f.held").filter(F.col("held") > 0)
    if rescued in rows.columns:
        pairs = rows.selectExpr(f"explode(try_variant_get(try_parse_json(`{rescued}`), '$', 'map<string,variant>')) AS (name, value)")
        keys = pairs.filter("NOT is_variant_null(value)").selectExpr("name", f"{_kind_of_variant()} AS type")
        found = found.unionByName(keys.groupBy("name", "type").agg(F.count(F.lit(1)).alias("held")))
    return (
        found.groupBy(F.lower("name").alias("field_key"))
        .agg(
            F.max("name").alias("column_name"),
            F.concat_ws("|", F.sort_array(F.collect_set("type"))).alias("actual_type"),
            F.sum("held").alias("held_rows"),
        )
        .select(F.lit(dataset).alias("dataset"), "column_name", "actual_type", "held_rows")
    )


def contract_coverage(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Full outer match of contract fields and source fields on the lower-cased name.

    ``expected`` comes from ``contracts.contract_fields``; ``actual`` has ``dataset``,
    ``column_name`` and ``actual_type``, and ``held_rows`` if values were counted.
    """
    counts = [c for c in actual.columns if c == "held_rows"]
    identity = expected.select("dataset", "table_name", "dictionary_slug").distinct()
    wanted = expected.select(
        "dataset",
        F.lower("column_name").alias("field_key"),
        F.col("column_name").alias("expected_name"),
        "expected_type",
        "description",
        "references",
    )
    found = actual.select(
        "dataset", F.lower("column_name").alias("field_key"), F.col("column_name").alias("actual_name"), "actual_type", *counts
    )
    status = (
        F.when(F.col("actual_name").isNull(), MISSING_IN_SOURCE)
        .when(F.col("expected_name").isNull(), UNDOCUMENTED)
        .otherwise(DOCUMENTED)
    )
    urls = F.create_map(*[F.lit(v) for s in TRIP_SERVICES for v in (s, dictionary_url(s))])
    return (
        wanted.join(found, ["dataset", "field_key"], "full_outer")
        .join(identity, "dataset", "inner")
        .select(
            "dataset",
            "table_name",
            F.coalesce("actual_name", "expected_name").alias("column_name"),
            "actual_type",
            "expected_type",
            "description",
            "references",
            status.alias("status"),
            "dictionary_slug",
            F.element_at(urls, F.col("dataset")).alias("dictionary_url"),
            *counts,
        )
    )
