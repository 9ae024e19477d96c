"""Every named result as a function of (session, folder of the benchmark tables).

The tables stand in for trip files through ``sources.event_trips``; each query reads them
whole. Where an operator works on files (landing, bronze, lookups), Spark first derives
those files from the tables below the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.contracts import Contract, base_contract, base_contracts, contract_fields, union_all
from meterlake.functions.columns import lenient_cast, rescued_values
from meterlake.functions.months import month_label, month_of_name, month_sequence, month_start
from meterlake.operators import coverage as field_coverage
from meterlake.operators import dictionary, gold, quality, rules
from meterlake.operators.bronze import bronze_rows
from meterlake.operators.silver import silver_trips
from meterlake.plans import answers, exploration, quality_state, quality_store, quality_views
from meterlake.session import scratch_dir
from meterlake.sources import event_trips as fixtures
from meterlake.sources import landing, metadata
from meterlake.sources.tables import Lake, TableSpec, publish, publish_months
from meterlake.streaming.ingest import ingest_services

Query = Callable[[SparkSession, str], DataFrame]

START_MONTH, END_MONTH = "2023-12", "2024-01"
PASSENGER_MONTH = "2024-01"
SHIPMENT_START, SHIPMENT_END = datetime(1995, 1, 1), datetime(2002, 1, 1)
FIELD_NAMES = ("doc_id", "lang", "source", "text")
FIELD_TYPES = ("long", "string", "string", "string")

FIRST_RUN = quality.Run("run-1", datetime(2024, 3, 1, 2, 30), date(2023, 12, 1), date(2024, 1, 31))
REPLACED_RUN = quality.Run("run-2", datetime(2024, 3, 1, 12, 0), date(2023, 12, 1), date(2024, 1, 31))
LAST_RUN = quality.Run("run-3", datetime(2024, 3, 1, 18, 0), date(2023, 12, 1), date(2024, 2, 29))
RUN_MONTHS = {"run-1": "2024-01", "run-2": "2024-01", "run-3": "2024-02"}


def comparable(frame: DataFrame) -> DataFrame:
    """Zone-free timestamps and flat lists, so that results compare across engines."""
    columns = []
    for f in frame.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            column = F.concat_ws(",", column)
        columns.append(column.alias(f.name))
    return frame.select(*columns)


# ---------------------------------------------------------------- layers over the tables


def _bronze(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    return fixtures.bronze_trips(fixtures.event_trips(spark, sf_dir), base_contract(service))


def _silver(spark: SparkSession, sf_dir: str, service: str, end: str = END_MONTH) -> DataFrame:
    return silver_trips(_bronze(spark, sf_dir, service), base_contract(service), START_MONTH, end)


def _consumption(spark: SparkSession, sf_dir: str, end: str = END_MONTH) -> DataFrame:
    return gold.gold_consumption(_silver(spark, sf_dir, "yellow", end))


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.trips_with_duration(_consumption(spark, sf_dir), START_MONTH, END_MONTH)


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    consumption = fixtures.shipment_consumption(spark, sf_dir)
    return exploration.trips_with_duration(consumption, "1995-01", "2001-12")


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.passengers_by_hour(
        _silver(spark, sf_dir, "yellow"), _silver(spark, sf_dir, "green"), PASSENGER_MONTH
    )


_STAGED: dict[tuple[str, str], str] = {}


def staged_landing(spark: SparkSession, sf_dir: str) -> str:
    """Landing files derived from the events, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        trips = fixtures.event_trips(spark, sf_dir)
        _STAGED[key] = fixtures.stage_landing(trips, scratch_dir(spark, "landing"))
    return _STAGED[key]


# ---------------------------------------------------------------- landing and bronze


def landing_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All staged months; the last one holds amounts that are no numbers."""
    root = staged_landing(spark, sf_dir)
    return landing.landing_canonical(
        spark, root, "yellow", fixtures.REFERENCE_MONTHS[0], fixtures.REFERENCE_MONTHS[-1], quality.landing_projection
    )


def landing_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = landing.list_files(spark, staged_landing(spark, sf_dir))
    verdicts = landing.landing_integrity(landing.read_footers(files))
    return verdicts.groupBy("service", "reference_month", "status").agg(F.sum("footer_rows").alias("trip_rows"))


def landing_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    service = (
        F.when(priority == "1-URGENT", "yellow")
        .when(priority == "2-HIGH", "green")
        .when(priority == "3-MEDIUM", "fhv")
        .otherwise("other")
    )
    present = (
        fixtures.table(spark, sf_dir, "orders")
        .select(service.alias("service"), month_start(F.col("o_orderdate")).alias("month"))
        .distinct()
        .select("service", month_label(F.col("month")).alias("reference_month"))
    )
    return landing.landing_gaps(present, ["yellow", "green", "fhv", "fhvhv"], "1994-10", "2001-10")


def bronze_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = landing.list_files(spark, f"{staged_landing(spark, sf_dir)}/yellow")
    groups = landing.schema_groups(spark, landing.read_footers(files), files)
    return bronze_rows(spark, groups, base_contract("yellow")).drop("_source_file", "_ingested_at")


def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = landing.list_files(spark, f"{staged_landing(spark, sf_dir)}/green")
    groups = landing.schema_groups(spark, landing.read_footers(files), files)
    rows = bronze_rows(spark, groups, base_contract("green"))
    name = landing.file_name(F.col("_source_file"))
    return rows.groupBy(
        "_service_type",
        "_reference_month",
        landing.service_of_name(name).alias("file_service"),
        month_of_name(name).alias("file_month"),
    ).agg(F.count(F.lit(1)).alias("trip_rows"))


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _scratch_lake(spark, staged_landing(spark, sf_dir))
    shapes = {
        "yellow": ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "total_amount"),
        "green": ("VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "passenger_count", "total_amount"),
        "fhv": ("SR_Flag", "pickup_datetime", "dropOff_datetime", None, None),
        "fhvhv": (None, "pickup_datetime", "dropoff_datetime", None, "driver_pay"),
    }
    names = ("vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "total_amount")
    kinds = ("long", "timestamp", "timestamp", "double", "double")
    tables = ingest_services(spark, lake, [base_contract(service) for service in shapes])
    frames = []
    for service, sources in shapes.items():
        stored = spark.table(tables[service])
        values = [
            (F.col(source) if source else F.lit(None).cast(kind)).alias(name)
            for source, name, kind in zip(sources, names, kinds, strict=True)
        ]
        frames.append(stored.select(*values, "_rescued_data", "_service_type", "_reference_month"))
    return union_all(frames)


def _scratch_lake(spark: SparkSession, landing_path: str = "") -> Lake:
    root = scratch_dir(spark, "lake")
    suffix = root.rsplit("-", 1)[-1][:12]
    lake = Lake(
        root, landing_path, *[f"{layer}_{suffix}" for layer in ("bronze", "silver", "gold", "quality")]
    )
    lake.create_databases(spark)
    return lake


def rescued_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.table(spark, sf_dir, "events").select(
        "event_id", "props", rescued_values(F.col("props")).alias("rescued")
    )
    value = F.element_at("rescued", F.lit("k"))
    return events.select(
        "event_id",
        value.alias("rescued_text"),
        lenient_cast(value, T.LongType()).alias("rescued_long"),
        F.element_at("rescued", F.lit("K")).alias("other_spelling"),
    )


# ---------------------------------------------------------------- metadata products


def zone_files(spark: SparkSession, sf_dir: str) -> str:
    """A zone lookup CSV derived from the suppliers and where they sit."""
    path = f"{scratch_dir(spark, 'zones')}/taxi_zone_lookup.csv"
    suppliers, nations, regions = (fixtures.table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("int").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("s_name").alias("Zone"),
            F.col("n_name").alias("service_zone"),
        )
        .write.option("header", True)
        .csv(path)
    )
    return path


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.zone_lookup(spark, zone_files(spark, sf_dir)).drop("_source_file", "_ingested_at")


def zone_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixtures.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
    )
    zones = metadata.zone_lookup(spark, zone_files(spark, sf_dir))
    return metadata.zone_enrichment(trips, zones, "PULocationID", "DOLocationID")


def _artifact_name() -> Column:
    names = F.array(*[F.lit(name) for name in metadata.ARTIFACTS])
    text_file = F.concat(F.lit("document_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return F.coalesce(F.get(names, (F.col("doc_id") % 10).cast("int")), text_file)


def artifact_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fixtures.table(spark, sf_dir, "documents").select(
        F.concat_ws("/", F.lit("/landing/_metadata"), F.col("source"), F.col("doc_id"), _artifact_name()).alias("path"),
        F.octet_length("text").cast("long").alias("size_bytes"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.col("doc_id") * F.expr("interval 1 second")).alias(
            "modified_at"
        ),
    )
    return metadata.artifact_inventory(files)


def artifact_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    artifacts = fixtures.table(spark, sf_dir, "documents").select(
        F.format_string("/landing/_metadata/document_%d.txt", "doc_id").alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )
    return metadata.artifact_sha256(artifacts)


def dictionary_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data dictionary per document, the whole text included.

    Dictionaries of French documents lack a field heading, those of Spanish ones leave a
    description empty, German ones have no marker: every status occurs.
    """
    lang = F.col("lang")
    heading = F.when(lang == "de", "Fields\n").otherwise("Field\tName\n  Description\n")
    source = F.when(lang == "fr", "").when(lang == "es", "source ").otherwise(F.concat(F.lit("source "), "source", F.lit("\n")))
    text = F.concat(
        F.lit("Data Dictionary – Trip Records  Page 1 of 2\nThis data dictionary describes documents of "),
        F.col("source"),
        F.lit(". As of 2024 it is current.\n"),
        heading,
        F.lit("doc_id "),
        F.col("doc_id").cast("string"),
        F.lit("\nlang "),
        lang,
        F.lit("\nDATA DICTIONARY - continued Page 2 of 2\n"),
        source,
        F.lit("text "),
        F.col("text"),
    )
    return fixtures.table(spark, sf_dir, "documents").select(
        "doc_id",
        text.alias("text"),
        F.array(*[F.lit(name) for name in FIELD_NAMES]).alias("field_names"),
    )


def contract_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = dictionary.extract_dictionaries(dictionary_texts(spark, sf_dir))
    return dictionary.field_descriptions(extracted, "doc_id")


def contract_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = dictionary_texts(spark, sf_dir).withColumns(
        {
            "dataset": F.col("doc_id").cast("string"),
            "table": F.concat(F.lit("bronze_"), F.col("doc_id").cast("string")),
            "dictionary_slug": F.lit("documents"),
            "source_file": F.format_string("document_%d.txt", "doc_id"),
            "source_sha256": F.sha2("text", 256),
            "field_types": F.array(*[F.lit(kind) for kind in FIELD_TYPES]),
            "governance_note": F.lit(None).cast("string"),
        }
    )
    return dictionary.build_contracts(dictionary.extract_dictionaries(texts)).withColumnRenamed("value", "contract")


def contract_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts against the values that the rows of every service hold."""
    contracts: list[Contract] = [c for c in base_contracts().values() if c.dictionary_slug]
    held = union_all([field_coverage.held_fields(_bronze(spark, sf_dir, c.dataset), c.dataset) for c in contracts])
    return field_coverage.contract_coverage(contract_fields(spark, contracts), held).drop("dictionary_url")


# ---------------------------------------------------------------- gold


def gold_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consumption(spark, sf_dir)


def pickup_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    consumption = fixtures.shipment_consumption(spark, sf_dir)
    return gold.pickup_window(consumption, "1999-12", "tpep_pickup_datetime")


def union_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.union_services(_silver(spark, sf_dir, "yellow"), _silver(spark, sf_dir, "green"))


# ---------------------------------------------------------------- quality


def published_rules(spark: SparkSession) -> list[dict]:
    catalog = rules.rule_frame(spark, rules.fixed_rule_document())
    return quality.load_rules(rules.active_rules(catalog))


def graded_document() -> dict:
    """The published rules with one that fails, one that tolerates some and one switched off."""
    document = rules.fixed_rule_document()
    changes = {
        "invalid_trip_chronology": {"severity": "fail"},
        "passenger_count_null": {"maximum_violation_percentage": 5.0},
        "vendor_id_null": {"active": False},
    }
    document["rules"] = [{**rule, **changes.get(rule["id"], {})} for rule in document["rules"]]
    return document


def quality_layers(spark: SparkSession, sf_dir: str, end: str = END_MONTH) -> list[quality.Layer]:
    trips, contract = fixtures.event_trips(spark, sf_dir), base_contract("yellow")
    bronze = fixtures.bronze_trips(trips, contract)
    silver = silver_trips(bronze, contract, START_MONTH, end)
    files = fixtures.service_trips(trips, "yellow").filter(F.col("reference_month").between(START_MONTH, end))
    return [
        quality.Layer(
            "landing",
            "landing/yellow",
            quality.canonical_projection(files, **{name: name for name in quality.CANONICAL_TYPES}),
        ),
        quality.Layer(
            "bronze",
            "bronze.bronze_yellow_trips",
            quality.table_projection(bronze.filter(F.col("_reference_month").between(START_MONTH, end)), "VendorID"),
        ),
        quality.Layer("silver", "silver.silver_yellow_trips", quality.table_projection(silver, "vendor_id")),
        quality.Layer(
            "gold",
            "gold.gold_yellow_trips_consumption",
            quality.table_projection(gold.gold_consumption(silver), "VendorID"),
        ),
    ]


def dq_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _bronze(spark, sf_dir, "yellow").filter(F.col("_reference_month").between(START_MONTH, END_MONTH))
    return quality.table_projection(bronze, "VendorID")


def dq_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.evaluate(quality_layers(spark, sf_dir), published_rules(spark), FIRST_RUN)


def dq_evaluate_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver evaluated twice from its counts by month; the second time one month has come and only it is scanned."""
    lake, month = _scratch_lake(spark), "_reference_month"
    trips = _silver(spark, sf_dir, "yellow", RUN_MONTHS[LAST_RUN.execution_id])
    spec = TableSpec(f"{lake.silver}.silver_yellow_trips", trips.schema, (month,))
    publish(spark, lake, spec, trips.filter(F.col(month) <= END_MONTH))

    def evaluated(run: quality.Run) -> DataFrame:
        months = month_sequence(START_MONTH, RUN_MONTHS[run.execution_id])
        layer = quality_state.MonthlyLayer(
            "silver",
            "silver.silver_yellow_trips",
            quality_state.month_files(spark, lake, spec.name, month, months),
            lambda some: quality.table_projection(spark.table(spec.name).filter(F.col(month).isin(some)), "vendor_id"),
            trips.schema.simpleString(),
        )
        return quality_state.evaluate_months(spark, lake, [layer], published_rules(spark), run)[0]

    evaluated(FIRST_RUN)
    publish_months(spark, lake, spec, trips, month, [RUN_MONTHS[LAST_RUN.execution_id]])
    return evaluated(LAST_RUN)


def _graded_catalog(spark: SparkSession) -> DataFrame:
    return rules.rule_frame(spark, graded_document())


def _graded_run(spark: SparkSession, sf_dir: str, run: quality.Run) -> DataFrame:
    active = quality.load_rules(rules.active_rules(_graded_catalog(spark)))
    return quality.evaluate(quality_layers(spark, sf_dir, RUN_MONTHS[run.execution_id]), active, run)


_RECORDED: dict[tuple[str, str], Lake] = {}


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, evaluated and stored once per application; whatever looks at them reads the stored rows.

    The second run shares its local day with the third and gives way.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RECORDED:
        lake = _scratch_lake(spark)
        quality_store.setup(spark, lake)
        for run in (FIRST_RUN, REPLACED_RUN, LAST_RUN):
            quality_store.record(spark, lake, _graded_run(spark, sf_dir, run), run)
        _RECORDED[key] = lake
    return quality_store.history(spark, _RECORDED[key])


def _dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_views.dashboard_results(_history(spark, sf_dir), _graded_catalog(spark))


def part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per part, silent about severity, limit or activity for some."""
    size = F.col("p_size")
    return fixtures.table(spark, sf_dir, "part").select(
        F.concat(F.lit("r"), F.col("p_partkey").cast("string")).alias("rule_id"),
        F.col("p_name").alias("rule_name"),
        F.col("p_type").alias("dimension"),
        F.col("p_brand").alias("description"),
        F.concat(F.lit("p_size > "), size.cast("string")).alias("expression"),
        F.when(size % 3 != 0, "FAIL").alias("severity"),
        F.when(size % 4 != 0, size.cast("double")).alias("maximum_violation_percentage"),
        F.array(F.lit("bronze"), F.lit("silver")).alias("layers"),
        F.when(size % 5 != 0, size % 5 != 1).alias("active"),
    )


def dq_rules_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.resolve_defaults(part_rules(spark, sf_dir), rules.FIXED_DEFAULTS)


def dq_active_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.active_rules(dq_rules_resolved(spark, sf_dir))


def dq_catalog_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the parts meet rules of the suppliers' deliveries under overlapping ids."""
    created = F.lit("2024-01-01 00:00:00").cast("timestamp")
    catalog = dq_rules_resolved(spark, sf_dir).withColumns(
        {"contract_version": F.lit(1), "created_at": created, "updated_at": created}
    )
    delivered = fixtures.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("deliveries"), F.max("l_quantity").alias("largest")
    )
    source = delivered.select(
        F.concat(F.lit("r"), (F.col("l_partkey") + 50).cast("string")).alias("rule_id"),
        F.concat(F.col("deliveries").cast("string"), F.lit(" deliveries")).alias("rule_name"),
        F.lit("validity").alias("dimension"),
        F.lit("synchronised").alias("description"),
        F.concat(F.lit("quantity <= "), F.col("largest").cast("int").cast("string")).alias("expression"),
        F.lit("WARN").alias("severity"),
        F.col("largest").alias("maximum_violation_percentage"),
        F.array(F.lit("gold")).alias("layers"),
        F.lit(True).alias("active"),
    )
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return rules.synchronised_catalog(catalog, source, 2, now)


# ---------------------------------------------------------------- the registry


def _over(result: Callable[[DataFrame], DataFrame], source: Query) -> Query:
    return lambda spark, sf_dir: result(source(spark, sf_dir))


def _registered() -> dict[str, Query]:
    summary = _over(quality_views.execution_summary, _history)
    return {
        # landing and bronze
        "landing_canonical": landing_canonical,
        "landing_integrity": landing_integrity,
        "landing_gaps": landing_gaps,
        "bronze_canonical": bronze_canonical,
        "bronze_lineage": bronze_lineage,
        "bronze_ingest": bronze_ingest,
        "rescued_map": rescued_map,
        # metadata products
        "zone_lookup": zone_lookup,
        "zone_enrichment": zone_enrichment,
        "artifact_inventory": artifact_inventory,
        "artifact_sha256": artifact_sha256,
        "contract_extract": contract_extract,
        "contract_build": contract_build,
        "contract_coverage": contract_coverage,
        # silver and gold
        "silver_trips": lambda spark, sf_dir: _silver(spark, sf_dir, "yellow"),
        "gold_consumption": gold_consumption,
        "union_services": union_services,
        "pickup_window": pickup_window,
        "gold_passengers_by_hour": _hourly,
        # answers
        "coverage": _over(lambda f: answers.coverage(f, datetime(2024, 1, 1), datetime(2024, 2, 1)), _consumption),
        "monthly_avg_amount": _over(
            lambda f: answers.monthly_average_amount(f, SHIPMENT_START, SHIPMENT_END), fixtures.shipment_consumption
        ),
        "answer_passengers_by_hour": _over(answers.passengers_by_hour, _hourly),
        # exploration
        "trips_with_duration": _trips,
        "eda_monthly_volume": _over(exploration.monthly_volume, _shipments),
        "eda_pickup_vs_reference": _over(
            lambda f: exploration.pickup_versus_reference(f, SHIPMENT_START, SHIPMENT_END), _shipments
        ),
        "eda_revenue": _over(exploration.revenue, _trips),
        "eda_revenue_sensitivity": _over(exploration.revenue_sensitivity, _shipments),
        "eda_vendor": _over(exploration.vendors, _trips),
        "eda_vendor_sensitivity": _over(exploration.vendor_sensitivity, _trips),
        "eda_passengers": _over(exploration.passengers, _trips),
        "eda_duration_buckets": _over(exploration.duration_buckets, _trips),
        "eda_correlation": _over(exploration.correlation, _trips),
        "eda_duration_amount_buckets": _over(exploration.duration_amount_buckets, _trips),
        "eda_rule_flags": _over(quality_views.rule_flags, summary),
        "eda_rule_flags_by_layer": _over(quality_views.rule_flags_by_layer, summary),
        # quality
        "dq_projection": dq_projection,
        "dq_rules_resolved": dq_rules_resolved,
        "dq_active_rules": dq_active_rules,
        "dq_catalog_sync": dq_catalog_sync,
        "dq_evaluate": dq_evaluate,
        "dq_evaluate_months": dq_evaluate_months,
        "dq_history": _history,
        "dq_execution_summary": summary,
        "dq_dashboard_results": _dashboard,
        "dq_table_success": _over(quality_views.table_success, _dashboard),
        "dq_dimension_success": _over(quality_views.dimension_success, _dashboard),
        "dq_run_summary": _over(quality_views.run_summary, _dashboard),
    }


def queries() -> dict[str, Query]:
    return {name: _over(comparable, query) for name, query in _registered().items()}
