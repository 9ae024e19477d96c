"""The complete run over staged landing files, at the smallest scale."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterlake.__main__ import main
from meterlake.operators import quality, rules
from meterlake.operators.silver import silver_trips
from meterlake.plans import job, quality_state, quality_store
from meterlake.plans.refresh import refresh_months
from meterlake.session import scratch_dir
from meterlake.sources import event_trips as fixtures
from meterlake.sources.tables import Lake

RUN = quality.Run("job-run", datetime(2024, 3, 1, 12), date(2023, 12, 1), date(2024, 1, 31))


@pytest.fixture(scope="module")
def config(spark, sf_dir):
    root = fixtures.stage_landing(fixtures.event_trips(spark, sf_dir), scratch_dir(spark, "landing"))
    zones = spark.createDataFrame([(1, "EWR", "Newark", "EWR"), (2, "Queens", "Jamaica", "Boro")], "a int, b string, c string, d string")
    zones.toDF("LocationID", "Borough", "Zone", "service_zone").coalesce(1).write.option("header", True).csv(
        f"{root}/_metadata/taxi_zone_lookup.csv"
    )
    lake = Lake(scratch_dir(spark, "lake"), root)
    return job.JobConfig(lake, "2023-12", "2024-01", "2024-01", services=("yellow", "green", "fhv"))


@pytest.fixture(scope="module")
def results(spark, config):
    return job.run_job(spark, config).collect()


def month_counts(spark) -> dict:
    counted = spark.table("silver.silver_yellow_trips").groupBy("_reference_month").count()
    return {r["_reference_month"]: r["count"] for r in counted.collect()}


def test_layers_agree(spark, config, results):
    assert {r["layer"] for r in results} == set(rules.LAYERS)
    by_rule = {}
    for r in results:
        by_rule.setdefault(r["rule_id"], set()).add((r["total_rows"], r["violation_count"]))
    assert len(by_rule) == 9
    assert all(len(seen) == 1 for seen in by_rule.values())
    assert any(count for seen in by_rule.values() for _, count in seen)


def test_silver_keeps_the_window(spark, config, results):
    bronze = spark.table("bronze.bronze_yellow_trips")
    silver = spark.table("silver.silver_yellow_trips")
    months = {r[0] for r in silver.select("_reference_month").distinct().collect()}
    assert months <= {"2023-12", "2024-01"}
    assert silver.count() == bronze.filter(F.col("_reference_month").between("2023-12", "2024-01")).count()
    assert silver.count() < bronze.count()


def test_hourly_product_balances(spark, config, results):
    hourly = spark.table("gold.gold_taxi_passengers_by_hour")
    silver = [
        spark.table(f"silver.silver_{s}_trips").select(F.hour(f"{p}_pickup_datetime").alias("hour_of_day"))
        for s, p in (("yellow", "tpep"), ("green", "lpep"))
    ]
    expected = {r["hour_of_day"]: r["count"] for r in silver[0].union(silver[1]).groupBy("hour_of_day").count().collect()}
    found = {r["hour_of_day"]: r["trips_considered"] + r["trips_discarded"] for r in hourly.collect()}
    assert found == expected
    assert all(
        r["trips_considered"] == r["yellow_trips_considered"] + r["green_trips_considered"] for r in hourly.collect()
    )


def test_metadata_is_inherited(spark, config, results):
    silver = spark.table("silver.silver_yellow_trips").schema["vendor_id"].metadata
    assert silver["source_column"] == "VendorID"
    assert silver["inherited_from"] == "bronze_yellow_trips"
    gold = spark.table("gold.gold_yellow_trips_consumption").schema["VendorID"].metadata
    assert gold["inherited_from"] == "silver_yellow_trips"
    assert gold["official_dictionary"] == "data_dictionary_trip_records_yellow.pdf"
    properties = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES bronze.bronze_yellow_trips").collect()}
    assert properties["tlc.metadata.dataset_slug"] == "yellow"


def test_rescue_column_is_the_undocumented_one(spark, config, results):
    columns = spark.table("bronze.bronze_metadata_columns")
    undocumented = columns.filter("status = 'UNDOCUMENTED'").groupBy("column_name").count().collect()
    assert {r["column_name"]: r["count"] for r in undocumented} == {"_rescued_data": 3, "_ingest_batch": 3}
    assert columns.filter("status = 'MISSING_IN_SOURCE'").count() == 0


def test_views_answer_sql(spark, config, results):
    assert spark.sql("SELECT count(*) FROM dq_execution_summary").first()[0] == 36
    run = spark.sql("SELECT * FROM dq_dashboard_run_summary").first()
    assert run["evaluated_rules"] == 36 and run["evaluated_layers"] == 4 and run["fail_results"] == 0


def test_second_run_adds_nothing(spark, config, results):
    before = {t: spark.table(t).count() for t in ("bronze.bronze_yellow_trips", "gold.gold_yellow_trips_consumption")}
    job.run_job(spark, config)
    assert {t: spark.table(t).count() for t in before} == before
    days = spark.table("quality.dq_rule_results").groupBy("execution_date").agg(F.countDistinct("execution_id")).collect()
    assert all(r[1] == 1 for r in days)


def test_only_touched_months_are_rewritten(spark, sf_dir, config, results):
    """A late file of one month: that month is rebuilt, the result equals a full rebuild."""
    assert job.refresh_silver(spark, config) == {"yellow": [], "green": [], "fhv": []}
    before = month_counts(spark)
    trips = fixtures.event_trips(spark, sf_dir)
    late = fixtures.drifted_files(trips)["yellow", "2023-12"]
    late.write.mode("append").option("mapreduce.output.basename", "yellow_tripdata_2023-12").parquet(
        f"{config.lake.landing_path}/yellow/2023/12"
    )
    job.refresh_bronze(spark, config)
    # Gold before silver: it must not take the late file for processed.
    job.refresh_gold(spark, config)
    assert job.refresh_silver(spark, config) == {"yellow": ["2023-12"], "green": [], "fhv": []}
    job.refresh_gold(spark, config)
    # Quality: only the late file's month is counted again, and the sums are those of a full count.
    active = quality.load_rules(rules.active_rules(quality_store.current_catalog(spark, config.lake)))
    layers = [job.quality_layer(spark, config, name) for name in rules.LAYERS]
    found, scanned = quality_state.evaluate_months(spark, config.lake, layers, active, RUN)
    assert scanned == {name: ["2023-12"] for name in rules.LAYERS}
    whole = [quality.Layer(layer.name, layer.table_name, layer.rows(["2023-12", "2024-01"])) for layer in layers]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, quality.evaluate(whole, active, RUN).collect()))
    after = month_counts(spark)
    assert after == {**before, "2023-12": 2 * before["2023-12"]}
    rebuilt = silver_trips(
        spark.table("bronze.bronze_yellow_trips"), config.contracts["yellow"], config.start_month, config.end_month
    )
    stored = spark.table("silver.silver_yellow_trips").select(*rebuilt.columns)
    assert stored.exceptAll(rebuilt).count() == 0 and rebuilt.exceptAll(stored).count() == 0
    assert spark.table("gold.gold_yellow_trips_consumption").count() == stored.count()


def test_another_window_rebuilds_everything(spark, config, results):
    wider = replace(config, end_month="2024-02")
    assert job.refresh_silver(spark, wider)["yellow"] is None
    months = {r[0] for r in spark.table("silver.silver_yellow_trips").select("_reference_month").distinct().collect()}
    assert months == {"2023-12", "2024-01", "2024-02"}
    assert job.refresh_silver(spark, config)["yellow"] is None


def test_a_failed_rebuild_is_not_taken_for_done(spark, config, results):
    wider = replace(config, end_month="2024-02")
    contract = config.contracts["yellow"]
    spec = job.table_specs(wider)["silver.silver_yellow_trips"]
    source = spark.table("bronze.bronze_yellow_trips")
    broken = silver_trips(source, contract, "2023-12", "2024-02").withColumn(
        "vendor_id", F.raise_error(F.lit("lost")).cast("long")
    )
    with pytest.raises(Exception, match="lost"):
        refresh_months(spark, config.lake, spec, broken, "bronze.bronze_yellow_trips", "2023-12..2024-02")
    assert job.refresh_silver(spark, config)["yellow"] is None
    expected = source.filter(F.col("_reference_month").between("2023-12", "2024-01")).count()
    assert spark.table("silver.silver_yellow_trips").count() == expected


def test_plain_sql_over_the_tables(spark, config, results):
    row = spark.sql(
        "SELECT count(*) AS n, percentile_approx(total_amount, 0.5) AS middle, "
        "count_if(timestampdiff(SECOND, tpep_pickup_datetime, tpep_dropoff_datetime) < 0) AS negative "
        "FROM gold.gold_yellow_trips_consumption WHERE _reference_month BETWEEN '2023-12' AND '2024-01'"
    ).first()
    assert row["n"] == spark.table("silver.silver_yellow_trips").count()
    assert row["middle"] > 0 and row["negative"] > 0


def test_gate_raises_after_storing(spark, config, results):
    document = rules.fixed_rule_document()
    for rule in document["rules"]:
        if rule["id"] == "passenger_count_null":
            rule["severity"] = "fail"
    strict = replace(config, rule_document=document)
    quality_store.synchronise(spark, config.lake, document)
    with pytest.raises(quality.GateFailure, match="silver.passenger_count_null"):
        job.evaluate_quality(spark, strict, "bronze, silver", gate=True, run=RUN)
    stored = quality_store.stored_run(spark, config.lake, RUN)
    assert stored.count() == 18
    assert stored.filter("status = 'FAIL'").count() == 2
    quality_store.synchronise(spark, config.lake, config.rule_document)


def test_tables_survive_a_new_catalogue(spark, config, results):
    count = spark.table("silver.silver_yellow_trips").count()
    hourly = spark.table("gold.gold_taxi_passengers_by_hour").count()
    for table in ("silver.silver_yellow_trips", "gold.gold_taxi_passengers_by_hour"):
        spark.sql(f"DROP TABLE {table}")
    job.register_tables(spark, config)
    assert spark.table("silver.silver_yellow_trips").count() == count
    assert spark.table("gold.gold_taxi_passengers_by_hour").count() == hourly


def test_incomplete_landing_stops_the_run(spark, config, results):
    job.check_landing(spark, config)
    # The last two months of a window may still be on their way, the ones before may not.
    job.check_landing(spark, replace(config, end_month="2024-04"))
    with pytest.raises(job.LandingProblem, match="fhv 2024-03: MISSING; green 2024-03: MISSING; yellow 2024-03"):
        job.check_landing(spark, replace(config, end_month="2024-05"))
    with pytest.raises(job.LandingProblem, match="fhvhv 2023-10: MISSING"):
        job.run_job(spark, replace(config, services=("yellow", "fhvhv"), start_month="2023-10"))


def test_command_line(spark, config, results):
    common = ["--root", config.lake.root, "--landing", config.lake.landing_path, "--start-month", "2023-12"]
    main(["quality", *common, "--end-month", "2024-01", "--layers", "silver,gold"])
    latest = spark.sql("SELECT max_by(execution_id, executed_at) FROM quality.dq_rule_results").first()[0]
    stored = spark.table("quality.dq_rule_results").filter(F.col("execution_id") == latest)
    assert {r["layer"] for r in stored.collect()} == {"silver", "gold"}
    with pytest.raises(ValueError, match="copper"):
        main(["quality", *common, "--end-month", "2024-01", "--layers", "copper"])
