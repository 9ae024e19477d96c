"""Counts kept by month, and the guard before rule texts."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterlake.operators import quality, rule_guard, rules
from meterlake.plans import quality_state, quality_store
from meterlake.sources.tables import Lake, TableSpec, ensure_table, publish, publish_months

RUN = quality.Run("r1", datetime(2024, 3, 1, 12), date(2024, 1, 1), date(2024, 2, 29))
COLUMNS = (
    "VendorID long, passenger_count double, total_amount double, tpep_pickup_datetime timestamp, "
    "tpep_dropoff_datetime timestamp, _reference_month string"
)
MONTHS = ["2024-01", "2024-02", "2024-03"]


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path), "unused", "s_bronze", "s_silver", "s_gold", "s_quality")
    lake.create_databases(spark)
    yield lake
    for database in (lake.bronze, lake.silver, lake.gold, lake.quality):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def trips(spark, month: str, n: int, without_vendor: int):
    day = datetime.fromisoformat(f"{month}-05")
    rows = [(None if i < without_vendor else 1, 1.0, float(i), day, day, month) for i in range(n)]
    return spark.createDataFrame(rows, COLUMNS)


def table_layer(spark, lake, spec, scans: list):
    def rows(months):
        scans.append(list(months))
        return quality.table_projection(spark.table(spec.name).filter(F.col("_reference_month").isin(months)), "VendorID")

    files = quality_state.month_files(spark, lake, spec.name, "_reference_month", MONTHS)
    return quality_state.MonthlyLayer("silver", spec.name, files, rows, spark.table(spec.name).schema.simpleString())


def active(spark, *extra):
    document = rules.fixed_rule_document()
    document["rules"] += extra
    return quality.load_rules(rules.active_rules(rules.rule_frame(spark, document)))


def results_of(frame):
    return sorted(map(tuple, frame.select("layer", "rule_id", "total_rows", "violation_count", "violation_percentage", "status").collect()))


def full(spark, layer, found):
    return results_of(quality.evaluate([quality.Layer(layer.name, layer.table_name, layer.rows(MONTHS))], found, RUN))


def test_only_changed_months_are_scanned(spark, lake):
    spec = TableSpec("s_silver.t", spark.createDataFrame([], COLUMNS).schema, ("_reference_month",))
    ensure_table(spark, lake, spec)
    found = active(spark)

    def run(rule_set):
        scans = []
        frame, scanned = quality_state.evaluate_months(spark, lake, [table_layer(spark, lake, spec, scans)], rule_set, RUN)
        got = results_of(frame)
        assert got == full(spark, table_layer(spark, lake, spec, []), rule_set)
        assert scans == ([scanned["silver"]] if scanned else [])
        return scanned.get("silver", []), {r[1]: r[2:4] for r in got}

    # No file at all: zeros, and nothing to remember.
    assert run(found) == ([], {r["rule_id"]: (0, 0) for r in found})

    publish(spark, lake, spec, trips(spark, "2024-01", 10, 2).union(trips(spark, "2024-02", 20, 3)))
    scanned, got = run(found)
    assert scanned == ["2024-01", "2024-02"] and got["vendor_id_null"] == (30, 5)
    assert run(found)[0] == []

    # A new month, then an old one rewritten with as many rows: only these are read.
    publish_months(spark, lake, spec, trips(spark, "2024-03", 5, 1), "_reference_month", ["2024-03"])
    scanned, got = run(found)
    assert scanned == ["2024-03"] and got["vendor_id_null"] == (35, 6)
    publish_months(spark, lake, spec, trips(spark, "2024-01", 10, 9), "_reference_month", ["2024-01"])
    scanned, got = run(found)
    assert scanned == ["2024-01"] and got["vendor_id_null"] == (35, 13)

    # A new rule is counted everywhere once, another limit or severity needs no rows.
    extra = {"id": "large", "name": "n", "dimension": "validity", "description": "d", "expression": "total_amount > 8", "layers": ["silver"]}
    scanned, got = run(active(spark, extra))
    assert scanned == MONTHS and got["large"] == (35, 12)
    assert run(active(spark, {**extra, "severity": "fail", "maximum_violation_percentage": 50.0}))[0] == []

    # Another zone may move days, so nothing counted before stands.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert run(found)[0] == MONTHS
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)

    # The state holds one row for each month and text of the last states, not a history.
    kept = spark.table("s_quality.dq_month_counts")
    assert kept.count() == kept.select("layer", "month", "rule_text").distinct().count()


def test_rules_of_the_moment_are_never_kept(spark, lake):
    spec = TableSpec("s_silver.t", spark.createDataFrame([], COLUMNS).schema, ("_reference_month",))
    publish(spark, lake, spec, trips(spark, "2024-01", 4, 1))
    late = {"id": "late", "name": "n", "dimension": "validity", "description": "d", "expression": "pickup_datetime < current_timestamp()", "layers": ["silver"]}
    for _ in range(2):
        scans = []
        frame, _ = quality_state.evaluate_months(spark, lake, [table_layer(spark, lake, spec, scans)], active(spark, late), RUN)
        got = {r[1]: r[2:4] for r in results_of(frame)}
        assert got["late"] == (4, 4) and got["vendor_id_null"] == (4, 1)
        assert scans[-1] == ["2024-01"]
    assert spark.table("s_quality.dq_month_counts").select("rule_text").distinct().count() == 9


def test_a_lost_count_is_an_error(spark, lake):
    spec = TableSpec("s_silver.t", spark.createDataFrame([], COLUMNS).schema, ("_reference_month",))
    publish(spark, lake, spec, trips(spark, "2024-01", 4, 1))
    layer = table_layer(spark, lake, spec, [])
    frame, _ = quality_state.evaluate_months(spark, lake, [layer], active(spark), RUN)
    publish(spark, lake, quality_state.state_spec(lake), spark.table("s_quality.dq_month_counts").limit(0))
    states = [tuple(r) for r in quality_state.month_states(layer).collect()]
    texts = {"silver": {quality_state.text_digest(r["expression"]) for r in active(spark)}}
    again = quality_state._summed(
        spark, quality_state.state_spec(lake), {"silver": layer}, states, {"silver": active(spark)}, texts, RUN
    )
    with pytest.raises(Exception, match="counts of a month are gone"):
        again.collect()


def test_a_failing_count_leaves_the_state(spark, lake):
    spec = TableSpec("s_silver.t", spark.createDataFrame([], COLUMNS).schema, ("_reference_month",))
    publish(spark, lake, spec, trips(spark, "2024-01", 4, 1))
    quality_state.evaluate_months(spark, lake, [table_layer(spark, lake, spec, [])], active(spark), RUN)
    before = sorted(map(tuple, spark.table("s_quality.dq_month_counts").collect()))
    publish_months(spark, lake, spec, trips(spark, "2024-02", 4, 1), "_reference_month", ["2024-02"])
    failing = table_layer(spark, lake, spec, [])
    rows = failing.rows
    object.__setattr__(failing, "rows", lambda m: rows(m).withColumn("vendor_id", F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        quality_state.evaluate_months(spark, lake, [failing], active(spark), RUN)
    assert sorted(map(tuple, spark.table("s_quality.dq_month_counts").collect())) == before
    frame, scanned = quality_state.evaluate_months(spark, lake, [table_layer(spark, lake, spec, [])], active(spark), RUN)
    assert scanned == {"silver": ["2024-02"]} and results_of(frame) == full(spark, table_layer(spark, lake, spec, []), active(spark))


@pytest.mark.parametrize(
    "expression,problem",
    [
        ("vendor_id IS NULL", None),
        ("passenger_count <= 0 OR try_to_timestamp(concat(reference_month, '-01')) > pickup_datetime", None),
        ("pickup_datetime > current_timestamp()", None),
        ("vendor_id IS", "PARSE_SYNTAX_ERROR"),
        ("vendor = 1", "UNRESOLVED_COLUMN"),
        ("vendor_id + 1", "bigint, not boolean"),
        ("vendor_id IS NULL) OR (true", "PARSE_SYNTAX_ERROR"),
        ("vendor_id IS NULL -- for now", "PARSE_SYNTAX_ERROR"),
        ("vendor_id > (SELECT max(id) FROM range(3))", "subquery"),
        ("vendor_id IN (SELECT id FROM range(3))", "subquery"),
        ("sum(vendor_id) > 1", "."),
        ("row_number() OVER (ORDER BY vendor_id) > 1", "."),
        ("explode(array(true))", "."),
        ("rand() < 0.5", "deterministic"),
        ("guarded_python(vendor_id)", "user code"),
    ],
)
def test_rule_texts(spark, expression, problem):
    spark.udf.register("guarded_python", lambda x: x == 1, "boolean")
    found = rule_guard.rule_problem(spark, expression)
    assert found is None if problem is None else found and problem in found


def test_rules_of_the_moment(spark):
    moving = ["pickup_datetime > now()", "to_date(pickup_datetime) = current_date", "pickup_datetime < timestamp'today'", "current_user() = 'a'"]
    assert all(rule_guard.of_the_moment(spark, text) for text in moving)
    assert not any(rule_guard.of_the_moment(spark, r["expression"]) for r in rules.fixed_rule_document()["rules"])


def test_a_bad_document_changes_nothing(spark, lake):
    quality_store.setup(spark, lake)
    document = rules.fixed_rule_document()
    quality_store.synchronise(spark, lake, document)
    before = quality_store.current_catalog(spark, lake).collect()
    document["rules"][0]["expression"] = "vendor IS NULL"
    document["rules"][1]["expression"] = "total_amount"
    with pytest.raises(rule_guard.RuleProblem, match="passenger_count_null: is double.*vendor_id_null: .*UNRESOLVED_COLUMN"):
        quality_store.synchronise(spark, lake, document)
    assert quality_store.current_catalog(spark, lake).collect() == before
