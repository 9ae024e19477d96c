"""Counts of rule violations that are kept by month, so that an evaluation scans only what changed.

A count of rows or of violations over a window is the sum of the counts of its months. The state table keeps one row per
layer, month and rule text, together with the state of the month it was counted from: a digest over path, size and
time of every file that holds rows of the month, and over what else decides the result (types of the columns, zone
of the session). An evaluation lists the files of its window, scans the months and texts that have no count of this very
state, all of a layer in one pass, and sums. A month that was rewritten, gained a file or lost one has another
state, so no count outlives its rows. A rule whose answer depends on the moment is never kept.

The table grows with months and rules, not with rows. It is published as a whole new version, so an evaluation that dies leaves
the counts before, and the next one counts what is missing.

Defined results: a layer without rows in the window gives zeros for all its rules; a file without rows counts as zero
rows; rows whose month is null or outside the months asked for are not counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.contracts import union_all
from meterlake.functions.columns import sql_text
from meterlake.operators.quality import CANONICAL_TYPES, Layer, Run, evaluate, with_status
from meterlake.operators.rule_guard import of_the_moment
from meterlake.sources.tables import Lake, TableSpec, committed, ensure_table, follow, publish

#: Changes whenever the projections change their results, so that no count from before is taken for one of now.
FORM = 1
FILE_COLUMNS = "month string, path string, size_bytes long, modified_at timestamp"
_KEYS = ["layer", "month", "rule_text"]


@dataclass(frozen=True)
class MonthlyLayer:
    """A layer by months: the files its rows lie in, and its canonical rows of some months.

    ``definition`` names what else than the files decides the rows.
    """

    name: str
    table_name: str
    files: DataFrame
    rows: Callable[[list[str]], DataFrame]
    definition: str
    may_be_empty: bool = True


def state_spec(lake: Lake) -> TableSpec:
    columns = (
        ("layer", T.StringType(), "Layer counted"),
        ("month", T.StringType(), "Reference month counted"),
        ("rule_text", T.StringType(), "SHA-256 of the predicate"),
        ("state", T.StringType(), "Digest of the files and settings the counts come from"),
        ("total_rows", T.LongType(), "Rows of the month"),
        ("violation_count", T.LongType(), "Rows of the month that satisfy the predicate"),
    )
    schema = T.StructType([T.StructField(name, kind, True, {"comment": text}) for name, kind, text in columns])
    return TableSpec(f"{lake.quality}.dq_month_counts", schema, (), "Violations by month, from which evaluations are summed")


def month_files(spark: SparkSession, lake: Lake, table: str, column: str, months: list[str]) -> DataFrame:
    """Files of a table partitioned by month, listed for some months only; none is opened."""
    _, folder = committed(spark, lake, table)
    pattern = f"{folder}/{column}={{{','.join(months)}}}"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], FILE_COLUMNS)
        raise
    return files.select(
        F.regexp_extract("path", f"/{column}=([^/]+)/", 1).alias("month"),
        "path",
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def month_states(layer: MonthlyLayer) -> DataFrame:
    """layer, month, state. The digests of files add up, so tasks send one row per month."""
    spark = layer.files.sparkSession
    settings = [spark.conf.get(f"spark.sql.{key}") for key in ("session.timeZone", "ansi.enabled")]
    definition = "\n".join([str(FORM), spark.version, *settings, str(sorted(CANONICAL_TYPES.items())), layer.table_name, layer.definition])
    file = F.xxhash64("path", "size_bytes", "modified_at")
    return (
        layer.files.groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("size_bytes").alias("bytes"),
            F.bit_xor(file).alias("mixed"),
            F.sum(file.cast("decimal(38,0)")).alias("added"),
        )
        .select(
            F.lit(layer.name).alias("layer"),
            "month",
            F.sha2(F.concat_ws(" ", F.lit(definition), "files", "bytes", "mixed", "added"), 256).alias("state"),
        )
    )


def text_digest(expression: str) -> str:
    return hashlib.sha256(expression.encode()).hexdigest()


def missing_counts(
    spark: SparkSession, lake: Lake, states: list[tuple[str, str, str]], texts: dict[str, set[str]]
) -> dict[str, tuple[list[str], set[str]]]:
    """By layer: the months and rule texts without a count of the current state.

    Both sides are as many rows as months times rules, a size the window and the catalogue set.
    """
    known = {tuple(row) for row in spark.table(state_spec(lake).name).select(*_KEYS, "state").collect()}
    missing: dict[str, tuple[list[str], set[str]]] = {}
    for layer, month, state in states:
        lacking = {text for text in texts[layer] if (layer, month, text, state) not in known}
        if lacking:
            months, found = missing.setdefault(layer, ([], set()))
            months.append(month)
            found |= lacking
    return missing


def _count_months(layer: MonthlyLayer, months: list[str], expressions: dict[str, str]) -> DataFrame:
    """layer, month, rule_text and counts; one scan, one partial row per task and month."""
    texts = sorted(expressions)
    counts = [F.expr(f"count_if(boolean({expressions[text]}))").alias(f"v{i}") for i, text in enumerate(texts)]
    pairs = ", ".join(f"struct({sql_text(text)} AS rule_text, v{i} AS violation_count)" for i, text in enumerate(texts))
    counted = layer.rows(months).groupBy("reference_month").agg(F.count(F.lit(1)).alias("total_rows"), *counts)
    return counted.selectExpr(
        f"{sql_text(layer.name)} AS layer", "reference_month AS month", "total_rows", f"inline(array({pairs}))"
    )


def evaluate_months(
    spark: SparkSession, lake: Lake, layers: list[MonthlyLayer], rules: list[dict], run: Run
) -> tuple[DataFrame, dict[str, list[str]]]:
    """Results of every applicable rule on every layer, and the months that were scanned for them by layer.

    The results equal those of ``quality.evaluate`` over the rows of all months.
    """
    spec = state_spec(lake)
    ensure_table(spark, lake, spec)
    follow(spark, lake, spec)
    applicable = {layer.name: [r for r in rules if layer.name in r["layers"]] for layer in layers}
    moving = {text for text in {r["expression"] for r in rules} if of_the_moment(spark, text)}
    expressions = {text_digest(r["expression"]): r["expression"] for r in rules if r["expression"] not in moving}
    texts = {name: {text_digest(r["expression"]) for r in found} & set(expressions) for name, found in applicable.items()}
    by_name = {layer.name: layer for layer in layers}

    # As many rows as the window has months in these layers.
    states = [tuple(row) for row in union_all([month_states(layer) for layer in layers]).collect()]
    months = {name: sorted(month for layer, month, _ in states if layer == name) for name in by_name}
    for layer in layers:
        if not months[layer.name] and not layer.may_be_empty:
            raise FileNotFoundError(f"no file of {layer.table_name} in the window")

    missing = missing_counts(spark, lake, states, texts)
    if missing:
        _publish_counts(spark, lake, spec, by_name, states, missing, expressions)

    results = [_summed(spark, spec, by_name, states, applicable, texts, run)] if expressions else []
    late = [r for r in rules if r["expression"] in moving]
    if late:
        whole = [Layer(layer.name, layer.table_name, layer.rows(months[layer.name])) for layer in layers]
        results.append(evaluate(whole, late, run))
    scanned = {name: sorted(found) for name, (found, _) in missing.items()}
    return union_all(results), scanned


def _publish_counts(spark, lake, spec, by_name, states, missing, expressions) -> None:
    """A new version of the state: counts that still hold, and the ones that were missing."""
    current = {(layer, month): state for layer, month, state in states}
    asked = [
        (name, month, text, current[name, month])
        for name, (months, texts) in missing.items()
        for month in months
        for text in sorted(texts)
    ]
    asked = spark.createDataFrame(asked, "layer string, month string, rule_text string, state string")
    counted = union_all(
        [
            _count_months(by_name[name], sorted(months), {text: expressions[text] for text in texts})
            for name, (months, texts) in missing.items()
        ]
    )
    fresh = asked.join(counted, _KEYS, "left").select(
        *_KEYS, "state", *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("total_rows", "violation_count")]
    )
    now = spark.createDataFrame(states, "layer string, month string, now string")
    held = spark.table(spec.name).join(now, ["layer", "month"], "left").filter("now IS NULL OR now = state").drop("now")
    held = held.join(asked, [*_KEYS, "state"], "left_anti")
    # A few rows per month and rule: one file.
    publish(spark, lake, spec, held.select(*fresh.columns).unionByName(fresh).repartition(1))


def _summed(spark, spec, by_name, states, applicable, texts, run: Run) -> DataFrame:
    """Results from the counts of the current states; a count that is not there is an error, never a zero."""
    wanted = {name: sum(1 for layer, *_ in states if layer == name) for name in by_name}
    asked = [
        (
            rule["rule_id"], layer, by_name[layer].table_name, text_digest(rule["expression"]),
            float(rule["maximum_violation_percentage"]), rule["severity"].upper(), wanted[layer],
        )
        for layer, found in applicable.items()
        for rule in found
        if text_digest(rule["expression"]) in texts[layer]
    ]
    asked = spark.createDataFrame(
        asked,
        "rule_id string, layer string, table_name string, rule_text string, maximum_violation_percentage double, "
        "severity string, months long",
    )
    current = spark.createDataFrame(states, "layer string, month string, state string")
    sums = (
        spark.table(spec.name)
        .join(current, ["layer", "month", "state"])
        .groupBy("layer", "rule_text")
        .agg(F.count(F.lit(1)).alias("found"), F.sum("total_rows").alias("t"), F.sum("violation_count").alias("v"))
    )
    whole = F.coalesce("found", F.lit(0)) == F.col("months")
    lost = F.raise_error(F.lit("counts of a month are gone: two evaluations at once?")).cast("long")
    summed = asked.join(sums, ["layer", "rule_text"], "left").withColumns(
        {
            "total_rows": F.when(whole, F.coalesce("t", F.lit(0))).otherwise(lost),
            "violation_count": F.coalesce("v", F.lit(0)),
        }
    )
    return with_status(summed, run)
