"""Stored quality state: the rule catalogue, the result history and the views over both."""

from __future__ import annotations

from datetime import timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.quality import (
    FIXED_LOCAL_ZONE,
    RESULT_NAMES,
    RESULT_SCHEMA,
    Run,
    checked_results,
)
from meterlake.operators.rule_guard import check_rules
from meterlake.operators.rules import CATALOG_SCHEMA, checked_catalog, rule_frame, synchronised_catalog
from meterlake.plans import quality_views
from meterlake.sources.tables import Lake, TableSpec, ensure_table, replace_partition

VERSION = "catalog_version"
DAY = "execution_date"


def catalog_table(lake: Lake) -> str:
    return f"{lake.quality}.dq_rule_catalog_versions"


def results_table(lake: Lake) -> str:
    return f"{lake.quality}.dq_rule_results"


def table_specs(lake: Lake) -> list[TableSpec]:
    return [
        TableSpec(
            catalog_table(lake),
            T.StructType([*CATALOG_SCHEMA.fields, T.StructField(VERSION, T.LongType(), False)]),
            (VERSION,),
            "Quality rules; every synchronisation adds a version and the highest one counts",
        ),
        TableSpec(
            results_table(lake),
            T.StructType([*RESULT_SCHEMA.fields, T.StructField(DAY, T.StringType(), False)]),
            (DAY,),
            "Rule results by layer, one run kept per local day",
        ),
    ]


def setup(spark: SparkSession, lake: Lake) -> None:
    """Create the governed tables and register the views of this session."""
    lake.create_databases(spark)
    for spec in table_specs(lake):
        ensure_table(spark, lake, spec)
    register_views(spark, lake)


def current_catalog(spark: SparkSession, lake: Lake) -> DataFrame:
    versions = spark.table(catalog_table(lake))
    latest = versions.agg(F.max(VERSION).alias("latest")).first()["latest"]
    # The version is a partition, so only its own files are read.
    chosen = versions.filter(F.col(VERSION) == F.lit(latest if latest is not None else -1))
    return chosen.select(*[f.name for f in CATALOG_SCHEMA.fields])


def synchronise(spark: SparkSession, lake: Lake, document: dict) -> DataFrame:
    """Bring the catalogue in step with a rule document.

    The new state is written as a new version next to the old one. Nothing that is being
    read is overwritten, and a run that dies half way leaves the previous version in force.
    A document with a rule that cannot be evaluated changes nothing.
    """
    rules = rule_frame(spark, document)
    check_rules(spark, [row.asDict() for row in rules.select("rule_id", "expression").collect()])
    versions = spark.table(catalog_table(lake))
    latest = versions.agg(F.max(VERSION).alias("latest")).first()["latest"]
    merged = synchronised_catalog(
        current_catalog(spark, lake), rules, document["version"], F.current_timestamp()
    )
    (
        checked_catalog(merged)
        .withColumn(VERSION, F.lit((latest or 0) + 1).cast("long"))
        .select(*versions.columns)
        .write.mode("append")
        .insertInto(catalog_table(lake))
    )
    register_views(spark, lake)
    return current_catalog(spark, lake)


def local_day(run: Run) -> str:
    """Calendar day of the run in the zone of the history."""
    instant = run.executed_at
    instant = instant if instant.tzinfo else instant.replace(tzinfo=timezone.utc)
    return instant.astimezone(ZoneInfo(FIXED_LOCAL_ZONE)).date().isoformat()


def record(spark: SparkSession, lake: Lake, results: DataFrame, run: Run) -> DataFrame:
    """Store the results of a run and drop any other run of the same local day.

    The day is the partition, so storing and replacing are one overwrite. The stored rows
    are returned, which spares later steps a second evaluation.
    """
    replace_partition(checked_results(results), results_table(lake), DAY, local_day(run))
    return stored_run(spark, lake, run)


def history(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.table(results_table(lake)).select(*RESULT_NAMES)


def stored_run(spark: SparkSession, lake: Lake, run: Run) -> DataFrame:
    stored = spark.table(results_table(lake))
    return stored.filter((F.col(DAY) == local_day(run)) & (F.col("execution_id") == run.execution_id)).select(
        *RESULT_NAMES
    )


def register_views(spark: SparkSession, lake: Lake) -> None:
    """Views of this session under the names SQL users query."""
    results, catalog = history(spark, lake), current_catalog(spark, lake)
    dashboard = quality_views.dashboard_results(results, catalog)
    views = {
        "dq_rule_catalog": catalog,
        "dq_execution_summary": quality_views.execution_summary(results),
        "dq_dashboard_results": dashboard,
        "dq_dashboard_table_success": quality_views.table_success(dashboard),
        "dq_dashboard_dimension_success": quality_views.dimension_success(dashboard),
        "dq_dashboard_run_summary": quality_views.run_summary(dashboard),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
