"""Views over the rule results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.columns import percent_of, success_percent
from meterlake.operators.quality import RESULT_NAMES, execution_date

RUN_KEYS = ["execution_id", "executed_at", "execution_date"]
WINDOW_KEYS = ["reference_start", "reference_end"]


def execution_summary(results: DataFrame) -> DataFrame:
    """Latest result of each rule, layer and table.

    ``row_number() = 1`` lets Spark keep one row per key in every task before the
    shuffle, so a key with a long history does not gather in one place.
    """
    latest = Window.partitionBy("rule_id", "layer", "table_name").orderBy(
        F.desc("executed_at"), F.desc("execution_id")
    )
    return (
        results.select(*RESULT_NAMES)
        .withColumn("result_order", F.row_number().over(latest))
        .filter(F.col("result_order") == 1)
        .drop("result_order")
    )


def dashboard_results(results: DataFrame, catalog: DataFrame) -> DataFrame:
    """History with rule attributes and the local day of the run.

    The catalogue is small and Spark broadcasts it on its measured size; the join carries
    no hint, so a large one would be shuffled instead.
    """
    rules = catalog.select("rule_id", "rule_name", "dimension", "description", "severity")
    return results.join(rules, "rule_id", "inner").select(
        "execution_id",
        "executed_at",
        execution_date(F.col("executed_at")).alias("execution_date"),
        "rule_id",
        "rule_name",
        "dimension",
        "description",
        "severity",
        "layer",
        "table_name",
        "reference_start",
        "reference_end",
        "total_rows",
        "violation_count",
        "violation_percentage",
        "maximum_violation_percentage",
        "status",
        "details",
    )


def _success(dashboard: DataFrame, *keys: str) -> DataFrame:
    return dashboard.groupBy(*RUN_KEYS, "layer", "table_name", *keys, *WINDOW_KEYS).agg(
        F.count(F.lit(1)).alias("evaluated_rules"),
        F.sum("total_rows").alias("evaluated_checks"),
        F.sum("violation_count").alias("failed_checks"),
        success_percent(F.sum("violation_count"), F.sum("total_rows")).alias("success_percentage"),
    )


def table_success(dashboard: DataFrame) -> DataFrame:
    return _success(dashboard)


def dimension_success(dashboard: DataFrame) -> DataFrame:
    return _success(dashboard, "dimension")


def run_summary(dashboard: DataFrame) -> DataFrame:
    statuses = {f"{s.lower()}_results": F.count_if(F.col("status") == s) for s in ("OK", "WARN", "FAIL")}
    return dashboard.groupBy(*RUN_KEYS, *WINDOW_KEYS).agg(
        F.count(F.lit(1)).alias("evaluated_rules"),
        *[count.alias(name) for name, count in statuses.items()],
        # Layers form a closed set of four, so the set is a constant-size partial state
        # and the distinct count needs no second shuffle.
        F.size(F.collect_set("layer")).cast("long").alias("evaluated_layers"),
    )


def rule_flags(summary: DataFrame) -> DataFrame:
    """Latest flags of every rule on the yellow tables."""
    return (
        summary.filter(F.col("table_name").like("%yellow%"))
        .select(
            F.col("layer").alias("camada"),
            F.col("table_name").alias("tabela"),
            F.col("rule_id").alias("regra"),
            F.col("total_rows").alias("registros_avaliados"),
            F.col("violation_count").alias("registros_sinalizados"),
            F.round("violation_percentage", 6).alias("percentual_sinalizado"),
            "status",
        )
        .orderBy("camada", "tabela", "regra")
    )


def rule_flags_by_layer(summary: DataFrame) -> DataFrame:
    """Flags over row-rule pairs; a row may violate several rules."""
    return (
        summary.filter(F.col("table_name").like("%yellow%"))
        .groupBy(F.col("layer").alias("camada"), F.col("table_name").alias("tabela"))
        .agg(
            F.sum("total_rows").alias("verificacoes_executadas"),
            F.sum("violation_count").alias("sinalizacoes"),
            percent_of(F.sum("violation_count"), F.sum("total_rows"), 6).alias("percentual_sinalizacoes"),
        )
        .orderBy("camada", "tabela")
    )
