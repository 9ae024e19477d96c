"""Plan properties that decide how the queries behave on large and skewed data."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from meterlake.contracts import base_contract
from meterlake.operators import gold, quality
from meterlake.operators.silver import silver_trips
from meterlake.plans import quality_store, quality_views, registry
from meterlake.session import scratch_dir
from meterlake.sources import metadata
from meterlake.sources.tables import Lake, TableSpec, publish


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


STAGED = {"bronze_ingest", "dq_history"}


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - STAGED))
def test_no_cross_join_and_no_row_at_a_time_python(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


@pytest.mark.parametrize("name", ["eda_monthly_volume", "eda_pickup_vs_reference", "eda_vendor", "eda_duration_buckets"])
def test_global_windows_see_aggregated_rows_only(spark, sf_dir, name):
    """The single-partition exchange comes after an aggregation, never straight from a scan."""
    text = plan(registry.queries()[name](spark, sf_dir))
    tree = text.split("\n\n")[0]
    window = tree.index("Window")
    assert "HashAggregate" in tree[window:]
    assert tree.index("HashAggregate") > window


def test_trips_are_read_once_for_the_month_comparison(spark, sf_dir):
    text = plan(registry.queries()["eda_pickup_vs_reference"](spark, sf_dir))
    assert len(re.findall(r"Location: .*lineitem\.parquet", text)) == 1


def test_scans_are_pruned(spark, sf_dir):
    text = plan(registry.queries()["gold_passengers_by_hour"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in text
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(ts", text)


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    """Silver trips as a stored table."""
    lake = Lake(scratch_dir(spark, "plans"), "/nowhere", silver="silver_plans", quality="quality_plans")
    spark.sql(f"CREATE DATABASE {lake.silver} LOCATION '{lake.root}/silver_plans'")
    quality_store.setup(spark, lake)
    contract = base_contract("yellow")
    spec = TableSpec(f"{lake.silver}.trips", contract.silver_schema(), ("_reference_month",))
    publish(spark, lake, spec, registry.queries()["silver_trips"](spark, sf_dir))
    return lake, spark.table(spec.name)


def test_month_window_prunes_partitions_and_columns(spark, stored):
    _, silver = stored
    january = silver.filter(F.col("_reference_month").between("2024-01", "2024-01"))
    text = plan(quality.table_projection(january, "vendor_id").agg(F.sum("total_amount")))
    assert re.search(r"PartitionFilters: .*2024-01", text)
    assert "ReadSchema: struct<total_amount:double>" in text


def test_pickup_window_is_pushed_to_stored_trips(spark, stored):
    _, silver = stored
    green = silver.withColumnRenamed("tpep_pickup_datetime", "lpep_pickup_datetime")
    text = plan(gold.passengers_by_hour(silver, green, "2024-01"))
    assert len(re.findall(r"PushedFilters: .*GreaterThanOrEqual\([tl]pep_pickup_datetime", text)) == 2
    # One exchange of a row per task, hour, service and file, and one that folds those few rows.
    assert re.findall(r"Aggregate|Exchange", text.split("\n\n")[0]) == ["Aggregate", "Exchange", "Aggregate"] * 2


def test_silver_refresh_does_not_shuffle(spark, stored):
    _, silver = stored
    contract = base_contract("fhv")
    bronze = spark.createDataFrame([], contract.bronze_schema())
    assert "Exchange" not in plan(silver_trips(bronze, contract, "2023-12", "2024-01"))


def test_all_rules_share_one_scan_per_layer(spark, stored):
    _, silver = stored
    layer = quality.Layer("silver", "silver.trips", quality.table_projection(silver, "vendor_id"))
    run = registry.FIRST_RUN
    text = plan(quality.evaluate([layer], registry.published_rules(spark), run)).split("\n\n")[0]
    assert text.count("Scan parquet") == 1 and text.count("Exchange") == 1


def test_long_histories_are_reduced_before_the_shuffle(spark, stored):
    lake, _ = stored
    text = plan(quality_views.execution_summary(quality_store.history(spark, lake))).split("\n\n")[0]
    before, after = text.split("Exchange")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_a_hot_key_beyond_broadcast_size(spark):
    """A third of the trips at one location, a third nowhere, and no broadcast allowed."""
    trips = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 200).cast("long").alias("pu"),
        (F.col("id") % 50).alias("do"),
    )
    zones = spark.range(100).select(
        F.col("id").cast("int").alias("LocationID"),
        F.concat(F.lit("b"), F.col("id")).alias("Borough"),
        F.concat(F.lit("z"), F.col("id")).alias("Zone"),
        F.lit("s").alias("service_zone"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enriched = metadata.zone_enrichment(trips, zones, "pu", "do")
        assert "SortMergeJoin" in plan(enriched)
        rows = enriched.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) == 3000
    for r in rows:
        assert r["pickup_zone"] == (f"z{r['pu']}" if r["pu"] is not None and r["pu"] < 100 else None)
        assert r["dropoff_zone"] == f"z{r['do']}"


def test_one_hour_and_one_service_holding_most_trips(spark):
    def trips(prefix, service, n):
        return spark.range(n).selectExpr(
            "CASE WHEN id % 10 < 8 THEN TIMESTAMP '2024-01-05 07:30:00' ELSE TIMESTAMP '2024-01-06 09:00:00' END "
            f"AS {prefix}_pickup_datetime",
            "double(CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN 0 ELSE 2 END) AS passenger_count",
            f"'{service}' AS _service_type",
            f"'{service}.parquet' AS _source_file",
            "TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at",
        )

    rows = gold.passengers_by_hour(trips("tpep", "yellow", 10000), trips("lpep", "green", 100), "2024-01").collect()
    found = {r["hour_of_day"]: (r["trips_considered"], r["green_trips_considered"], r["trips_discarded"]) for r in rows}
    # ids repeat every 20: eight of ten fall into hour 7, half of all count passengers.
    considered = {h: sum(1 for n in (10000, 100) for i in range(n) if (i % 10 < 8) == (h == 7) and i % 4 > 1) for h in (7, 9)}
    green = {h: sum(1 for i in range(100) if (i % 10 < 8) == (h == 7) and i % 4 > 1) for h in (7, 9)}
    total = {7: 8080, 9: 2020}
    assert found == {h: (considered[h], green[h], total[h] - considered[h]) for h in (7, 9)}
    assert all(r["_source_files"] == ["green.parquet", "yellow.parquet"] for r in rows)
