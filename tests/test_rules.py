from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterlake.operators import quality, rules
from meterlake.plans import quality_store, quality_views
from meterlake.session import scratch_dir
from meterlake.sources.tables import Lake

RUN = quality.Run("r1", datetime(2024, 3, 1, 12), date(2024, 1, 1), date(2024, 1, 31))
SCHEMA = (
    "vendor_id long, passenger_count double, total_amount double, pickup_datetime timestamp, "
    "dropoff_datetime timestamp, reference_month string"
)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def evaluate(spark, rows, changes=None, layers=("landing",)):
    document = rules.fixed_rule_document()
    document["rules"] = [{**r, **(changes or {}).get(r["id"], {})} for r in document["rules"]]
    frame = spark.createDataFrame(rows, SCHEMA)
    active = quality.load_rules(rules.active_rules(rules.rule_frame(spark, document)))
    results = quality.evaluate([quality.Layer(name, f"{name}/yellow", frame) for name in layers], active, RUN)
    return {(r["layer"], r["rule_id"]): r for r in results.collect()}


def counts(results) -> dict:
    return {rule: r["violation_count"] for (_, rule), r in results.items() if r["violation_count"]}


def test_published_document():
    document = rules.fixed_rule_document()
    rules.validate_rule_document(document)
    assert len({r["id"] for r in document["rules"]}) == 9
    assert {r.get("severity", document["defaults"]["severity"]) for r in document["rules"]} == {"WARN"}
    assert all(r["layers"] == list(rules.LAYERS) for r in document["rules"])


@pytest.mark.parametrize("key", rules.REQUIRED_KEYS)
def test_incomplete_rules_are_errors(key):
    document = rules.fixed_rule_document()
    del document["rules"][3][key]
    with pytest.raises(ValueError, match=key):
        rules.validate_rule_document(document)


def test_defaults_must_be_complete_and_ids_unique():
    document = rules.fixed_rule_document()
    del document["defaults"]["severity"]
    with pytest.raises(ValueError, match="severity"):
        rules.validate_rule_document(document)
    document = rules.fixed_rule_document()
    document["rules"].append(dict(document["rules"][0]))
    with pytest.raises(ValueError, match="twice"):
        rules.validate_rule_document(document)


def test_layer_names_are_checked():
    assert quality.parse_layers(" landing, gold ,") == ("landing", "gold")
    with pytest.raises(ValueError, match="copper"):
        quality.parse_layers("gold,copper")
    with pytest.raises(ValueError, match="none given"):
        quality.parse_layers(" , ")


@pytest.mark.parametrize(
    "row,expected",
    [
        ((1, 1.0, 1.0, "2024-01-01 00:00:00", "2024-01-31 23:59:59", "2024-01"), {"trip_duration_over_24_hours": 1}),
        ((1, 1.0, 1.0, "2024-01-05 10:00:00", "2024-01-06 10:00:00", "2024-01"), {}),
        ((1, 1.0, 1.0, "2024-01-05 10:00:00", "2024-01-06 10:00:01", "2024-01"), {"trip_duration_over_24_hours": 1}),
        ((1, 1.0, 1.0, "2024-01-05 10:00:00.5", "2024-01-05 10:00:00", "2024-01"), {"invalid_trip_chronology": 1}),
        ((1, 1.0, 1.0, "2023-12-31 23:59:59", "2024-01-01 00:10:00", "2024-01"), {"pickup_before_reference_month": 1}),
        ((1, 1.0, 1.0, "2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-01"), {"trip_datetime_after_reference_month": 1}),
        ((1, 1.0, 1.0, "2024-02-01 00:00:00", None, "2024-01"), {"trip_datetime_after_reference_month": 1}),
        ((1, 0.0, -1.0, "2024-01-05 10:00:00", None, ""), {"passenger_count_non_positive": 1, "total_amount_non_positive": 1}),
        ((None, None, None, None, None, None), {"vendor_id_null": 1, "passenger_count_null": 1, "total_amount_null": 1}),
    ],
)
def test_predicates(spark, row, expected):
    values = tuple(ts(v) if i in (3, 4) and v else v for i, v in enumerate(row))
    assert counts(evaluate(spark, [values])) == expected


def test_empty_layer_is_ok(spark):
    results = evaluate(spark, [], layers=("bronze", "gold"))
    assert len(results) == 18
    assert all(
        (r["total_rows"], r["violation_count"], r["violation_percentage"], r["status"]) == (0, 0, 0.0, "OK")
        for r in results.values()
    )


def test_status_follows_limit_and_severity(spark):
    rows = [(None if i < 1 else 1, 1.0, 1.0, ts("2024-01-05"), ts("2024-01-05"), "2024-01") for i in range(4)]
    at_limit = evaluate(spark, rows, {"vendor_id_null": {"maximum_violation_percentage": 25.0}})
    assert at_limit["landing", "vendor_id_null"]["status"] == "OK"
    above = evaluate(spark, rows, {"vendor_id_null": {"maximum_violation_percentage": 24.9, "severity": "fail"}})
    assert above["landing", "vendor_id_null"]["status"] == "FAIL"
    assert above["landing", "vendor_id_null"]["violation_percentage"] == 25.0


def test_rules_apply_to_their_layers_only(spark):
    results = evaluate(spark, [], {"vendor_id_null": {"layers": ["gold"]}}, layers=("bronze", "gold"))
    assert ("gold", "vendor_id_null") in results and ("bronze", "vendor_id_null") not in results


def test_no_active_rule_is_an_error(spark):
    document = rules.fixed_rule_document()
    document["defaults"]["active"] = False
    with pytest.raises(RuntimeError, match="no active rule"):
        quality.load_rules(rules.active_rules(rules.rule_frame(spark, document)))


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lake(scratch_dir(spark, "rules"), "/nowhere", quality="quality_state")
    quality_store.setup(spark, lake)
    return lake


def test_synchronisation(spark, lake):
    document = rules.fixed_rule_document()
    first = {r["rule_id"]: r for r in quality_store.synchronise(spark, lake, document).collect()}
    assert len(first) == 9 and all(r["active"] and r["contract_version"] == 5 for r in first.values())

    again = {r["rule_id"]: r for r in quality_store.synchronise(spark, lake, document).collect()}
    for rule_id, row in again.items():
        assert row["updated_at"] > first[rule_id]["updated_at"]
        assert {**row.asDict(), "updated_at": None} == {**first[rule_id].asDict(), "updated_at": None}

    document["version"] = 6
    gone = document["rules"].pop(0)["id"]
    document["rules"][0]["name"] = "renamed"
    document["rules"].append({**document["rules"][1], "id": "brand_new"})
    last = {r["rule_id"]: r for r in quality_store.synchronise(spark, lake, document).collect()}
    assert len(last) == 10
    assert not last[gone]["active"] and last[gone]["contract_version"] == 5
    assert last[gone]["updated_at"] > again[gone]["updated_at"]
    assert last["passenger_count_null"]["rule_name"] == "renamed"
    assert last["passenger_count_null"]["created_at"] == first["passenger_count_null"]["created_at"]
    assert last["brand_new"]["contract_version"] == 6 and last["brand_new"]["created_at"] > again[gone]["updated_at"]
    assert spark.table("dq_rule_catalog").count() == 10


def result_rows(run, *specs):
    return [
        (run.execution_id, run.executed_at, rule, layer, f"{layer}.yellow", date(2024, 1, 1), date(2024, 1, 31), 10, n, 10.0 * n, 0.0, status, None)
        for rule, layer, n, status in specs
    ]


def test_one_run_per_local_day(spark, lake):
    """02:30 UTC still belongs to the day before in the zone of the history."""
    early = quality.Run("early", datetime(2024, 3, 1, 2, 30), None, None)
    noon = quality.Run("noon", datetime(2024, 3, 1, 12), None, None)
    evening = quality.Run("evening", datetime(2024, 3, 2, 2, 59), None, None)
    for run in (early, noon, evening):
        frame = spark.createDataFrame(result_rows(run, ("a", "bronze", 1, "WARN")), quality.RESULT_SCHEMA)
        quality_store.record(spark, lake, frame, run)
    runs = {r[0] for r in quality_store.history(spark, lake).select("execution_id").collect()}
    assert runs == {"early", "evening"}
    quality_store.record(spark, lake, spark.createDataFrame([], quality.RESULT_SCHEMA), noon)
    assert {r[0] for r in quality_store.history(spark, lake).select("execution_id").collect()} == {"early"}


def test_latest_result_and_summaries(spark):
    old = quality.Run("old", datetime(2024, 3, 1), None, None)
    new = quality.Run("new", datetime(2024, 3, 2), None, None)
    tie = quality.Run("tie", datetime(2024, 3, 2), None, None)
    rows = result_rows(old, ("a", "gold", 1, "WARN"), ("b", "gold", 0, "OK"))
    rows += result_rows(new, ("a", "gold", 2, "FAIL"), ("a", "silver", 0, "OK"))
    rows += result_rows(tie, ("a", "gold", 3, "WARN"))
    results = spark.createDataFrame(rows, quality.RESULT_SCHEMA)
    latest = {(r["rule_id"], r["layer"]): r["execution_id"] for r in quality_views.execution_summary(results).collect()}
    assert latest == {("a", "gold"): "tie", ("b", "gold"): "old", ("a", "silver"): "new"}

    catalog = spark.createDataFrame(
        [("a", "A", "validity", "d", "WARN")], "rule_id string, rule_name string, dimension string, description string, severity string"
    )
    dashboard = quality_views.dashboard_results(results, catalog)
    assert dashboard.count() == 4
    runs = {r["execution_id"]: r for r in quality_views.run_summary(dashboard).collect()}
    assert (runs["new"]["evaluated_rules"], runs["new"]["fail_results"], runs["new"]["evaluated_layers"]) == (2, 1, 2)
    tables = {(r["execution_id"], r["layer"]): r["success_percentage"] for r in quality_views.table_success(dashboard).collect()}
    assert tables["tie", "gold"] == 70.0
    empty = results.filter("rule_id = 'a'").withColumns({"total_rows": F.lit(0).cast("long"), "violation_count": F.lit(0).cast("long")})
    assert quality_views.table_success(quality_views.dashboard_results(empty, catalog)).first()["success_percentage"] is None
