"""The complete run: ingest, refine, check, promote, check again.

Steps hand over stored tables only, so a run that stops can be started again: ingestion
continues at its checkpoint and every other step rebuilds its own output.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.contracts import (
    TRIP_SERVICES,
    ZONE_DATASET,
    Contract,
    base_contracts,
    contract_fields,
    read_contracts,
    union_all,
)
from meterlake.functions.months import month_sequence, window_dates
from meterlake.operators import coverage, dictionary, gold, quality, rules
from meterlake.operators.silver import silver_trips
from meterlake.plans import quality_state, quality_store
from meterlake.plans.refresh import refresh_months
from meterlake.sources import landing, manifest, metadata
from meterlake.sources.tables import Lake, TableSpec, ensure_table, path_exists, publish
from meterlake.streaming.ingest import bronze_spec, bronze_table, ingest_services, service_properties, start_over

MONTH = "_reference_month"


@dataclass(frozen=True)
class JobConfig:
    lake: Lake
    start_month: str
    end_month: str
    passenger_month: str
    contracts: dict[str, Contract] = field(default_factory=base_contracts)
    rule_document: dict = field(default_factory=rules.fixed_rule_document)
    services: tuple[str, ...] = TRIP_SERVICES


def silver_table(config: JobConfig, dataset: str) -> str:
    return f"{config.lake.silver}.{config.contracts[dataset].table.replace('bronze_', 'silver_', 1)}"


def consumption_table(config: JobConfig) -> str:
    return f"{config.lake.gold}.gold_yellow_trips_consumption"


def hourly_table(config: JobConfig) -> str:
    return f"{config.lake.gold}.gold_taxi_passengers_by_hour"


def build_contracts(spark: SparkSession, lake: Lake, texts: DataFrame) -> None:
    """Contracts of all datasets; trip datasets take descriptions from (``dataset``, ``text``).

    The checksum is that of the stored dictionary file. A dataset whose text is missing or
    has a problem stops the run before anything is written.
    """
    rows = [
        (
            c.dataset,
            c.table,
            c.dictionary_slug,
            c.source_file,
            [column.name for column in c.columns],
            [column.logical_type for column in c.columns],
            c.governance_note,
            c.description,
            [(column.name, column.description, dictionary.OK) for column in c.columns],
        )
        for c in base_contracts().values()
    ]
    known = spark.createDataFrame(
        rows,
        "dataset string, table string, dictionary_slug string, source_file string, field_names array<string>, "
        "field_types array<string>, governance_note string, known_description string, "
        "known_fields array<struct<name:string,description:string,status:string>>",
    )
    checksums = metadata.artifact_sha256(metadata.read_artifacts(spark, lake.metadata_path)).withColumnRenamed(
        "file_name", "source_file"
    )
    known = known.join(checksums, "source_file", "left")
    has_dictionary = F.col("dictionary_slug").isNotNull()
    extracted = dictionary.extract_dictionaries(known.filter(has_dictionary).join(texts, "dataset", "left"))
    lookups = known.filter(~has_dictionary).withColumns(
        {
            "dataset_description": F.col("known_description"),
            "fields": F.col("known_fields"),
            "status": F.lit(dictionary.OK),
        }
    )
    problems = extracted.filter(F.col("status") != dictionary.OK).select("dataset", "status").collect()
    if problems:
        raise ValueError("dictionary problems: " + ", ".join(f"{p['dataset']}: {p['status']}" for p in problems))
    documents = dictionary.build_contracts(extracted.unionByName(lookups))
    dictionary.write_contracts(documents, lake.contracts_path)


def with_contracts(spark: SparkSession, config: JobConfig, texts: DataFrame) -> JobConfig:
    """The first step of a run: contracts from dictionary texts, stored and read back."""
    build_contracts(spark, config.lake, texts)
    return replace(config, contracts=read_contracts(spark, config.lake.contracts_path))


def table_specs(config: JobConfig) -> dict[str, TableSpec]:
    """Every table of the medallion layers by name."""
    lake, contracts = config.lake, config.contracts
    trips = [contracts[service] for service in config.services]
    specs = [bronze_spec(lake, contract, _service_properties(contract)) for contract in trips]
    specs += [_zone_spec(config), *_metadata_specs(lake)]
    specs += [_silver_spec(config, contract) for contract in (*trips, contracts[ZONE_DATASET])]
    specs += _gold_specs(config)
    return {spec.name: spec for spec in specs}


def register_tables(spark: SparkSession, config: JobConfig) -> None:
    """Make stored tables known to a catalogue that has not seen them."""
    config.lake.create_databases(spark)
    for spec in table_specs(config).values():
        ensure_table(spark, config.lake, spec)
    quality_store.setup(spark, config.lake)


def _service_properties(contract: Contract) -> dict[str, str]:
    guide, note = (metadata.ARTIFACTS[n][3] for n in ("trip_record_user_guide.pdf", "working_parquet_format.pdf"))
    return service_properties(contract, guide, metadata.dictionary_url(contract.dataset), note)


def _zone_spec(config: JobConfig) -> TableSpec:
    contract = config.contracts[ZONE_DATASET]
    lineage = [
        T.StructField("_source_file", T.StringType(), False, {"comment": "Lookup file in landing."}),
        T.StructField("_ingested_at", T.TimestampType(), False, {"comment": "When the lookup was read."}),
    ]
    columns = [T.StructField(c.name, c.data_type, True, contract.bronze_metadata(c)) for c in contract.columns]
    return TableSpec(
        bronze_table(config.lake, contract),
        T.StructType(columns + lineage),
        (),
        contract.description,
        # How the lookup declares its keys and origin.
        {
            "tlc.metadata.join_keys": "PULocationID,DOLocationID -> LocationID",
            "tlc.metadata.source": "NYC TLC taxi_zone_lookup.csv",
        },
    )


def _metadata_specs(lake: Lake) -> list[TableSpec]:
    inventory = (
        "file_name string, artifact_type string, dataset_slug string, source_slug string, source_url string, "
        "landing_path string, size_bytes bigint, modified_at timestamp, governance_note string"
    )
    columns = (
        "dataset string, table_name string, column_name string, actual_type string, expected_type string, "
        "description string, references string, status string, dictionary_slug string, dictionary_url string"
    )
    return [
        TableSpec(
            f"{lake.bronze}.bronze_metadata_artifacts",
            T.StructType.fromDDL(inventory),
            (),
            "Documents and lookups stored next to the trip files",
        ),
        TableSpec(
            f"{lake.bronze}.bronze_metadata_columns",
            T.StructType.fromDDL(columns),
            (),
            "Which source columns the contracts document",
        ),
    ]


def _silver_spec(config: JobConfig, contract: Contract) -> TableSpec:
    name = silver_table(config, contract.dataset)
    if contract.dataset == ZONE_DATASET:
        return TableSpec(name, contract.silver_schema(), (), "Zone lookup")
    properties = None
    if contract.dictionary_slug != contract.dataset:
        properties = {
            "tlc.metadata.dictionary_slug": contract.dictionary_slug,
            "tlc.metadata.dataset_slug": contract.dataset,
            "tlc.metadata.slug_mapping": f"{contract.dictionary_slug} -> {contract.dataset}",
        }
    window = f"from {config.start_month} through {config.end_month}"
    return TableSpec(name, contract.silver_schema(), (MONTH,), f"{contract.dataset} trips {window}", properties)


def _gold_specs(config: JobConfig) -> list[TableSpec]:
    yellow, green = config.contracts["yellow"], config.contracts["green"]
    # The names of the published table properties.
    return [
        TableSpec(
            consumption_table(config),
            gold.consumption_schema(yellow),
            (MONTH,),
            f"Yellow trips for consumption from {config.start_month} through {config.end_month}",
            {
                "quality": "gold",
                "tlc.metadata.source_layer": "silver",
                "tlc.metadata.contract_language": "en",
                "tlc.metadata.contract_sha256": yellow.source_sha256,
            },
        ),
        TableSpec(
            hourly_table(config),
            gold.HOURLY_SCHEMA,
            (),
            f"Mean passengers per pickup hour of yellow and green trips in {config.passenger_month}",
            {
                "quality": "gold",
                "tlc.metadata.source_layer": "silver",
                "tlc.metadata.service_scope": "yellow,green",
                "tlc.metadata.passenger_filter": "passenger_count > 0",
                "tlc.metadata.reference_month": config.passenger_month,
                "tlc.metadata.yellow_contract_sha256": yellow.source_sha256,
                "tlc.metadata.green_contract_sha256": green.source_sha256,
            },
        ),
    ]


def _landing_files(spark: SparkSession, config: JobConfig, service: str) -> DataFrame:
    """Manifest rows of a service's files; none if it has no folder yet."""
    if not path_exists(spark, f"{config.lake.landing_path}/{service}"):
        return spark.createDataFrame([], manifest.MANIFEST_COLUMNS)
    return manifest.present_files(spark, config.lake, service)


class LandingProblem(RuntimeError):
    """Landing files of the window are missing or damaged."""


def check_landing(spark: SparkSession, config: JobConfig) -> None:
    """Stop unless the window is complete: every file intact, no month missing before its end.

    Only files that the manifest does not know yet are opened, and of each only its first bytes and footer.
    """
    in_window = F.col("reference_month").between(config.start_month, config.end_month)
    relevant = F.col("service").isin(*config.services) & (in_window | (F.col("reference_month") == ""))
    files = union_all([_landing_files(spark, config, service) for service in config.services]).filter(relevant)
    empty = landing.with_identity(landing.empty_files(spark, config.lake.landing_path)).filter(relevant)
    damaged = files.filter(F.col("status") != "INTACT").select(landing.file_name(F.col("path")).alias("file_name"), "status")
    damaged = damaged.unionByName(empty.select("file_name", F.lit("EMPTY").alias("status")))
    gaps = landing.landing_gaps(files, list(config.services), config.start_month, config.end_month)
    problems = damaged.select(F.col("file_name").alias("subject"), "status").unionByName(
        gaps.filter(~F.col("tolerated")).select(
            F.concat_ws(" ", "service", "reference_month").alias("subject"), F.lit("MISSING").alias("status")
        )
    )
    # The message names a few; the two reports hold all of them.
    shown = problems.orderBy("subject").take(10)
    if shown:
        raise LandingProblem("; ".join(f"{row['subject']}: {row['status']}" for row in shown))


def refresh_bronze(spark: SparkSession, config: JobConfig) -> None:
    contracts = [config.contracts[service] for service in config.services]
    ingest_services(spark, config.lake, contracts, {c.dataset: _service_properties(c) for c in contracts})


def rebuild_bronze(spark: SparkSession, config: JobConfig, services: tuple[str, ...]) -> None:
    """Full refresh: forget what was ingested of some services and read their landing files again.

    The way to take in a month that was published anew under its old name. Silver and gold
    notice the new stream and rebuild as well.
    """
    unknown = sorted(set(services) - set(config.services))
    if unknown:
        raise ValueError(f"unknown services: {', '.join(unknown)}")
    for service in services:
        contract = config.contracts[service]
        start_over(spark, config.lake, contract, _service_properties(contract))
    refresh_bronze(spark, config)


def refresh_metadata(spark: SparkSession, config: JobConfig) -> None:
    """Zone lookup, artifact inventory and contract coverage."""
    lake, specs = config.lake, table_specs(config)
    zones = metadata.zone_lookup(spark, f"{lake.metadata_path}/taxi_zone_lookup.csv")
    publish(spark, lake, specs[bronze_table(lake, config.contracts[ZONE_DATASET])], zones)

    inventory = metadata.artifact_inventory(metadata.list_artifacts(spark, lake.metadata_path))
    publish(spark, lake, specs[f"{lake.bronze}.bronze_metadata_artifacts"], inventory)

    tables = {service: bronze_table(lake, config.contracts[service]) for service in config.services}
    expected = contract_fields(spark, [config.contracts[s] for s in config.services])
    covered = coverage.contract_coverage(expected, coverage.table_fields(spark, tables))
    publish(spark, lake, specs[f"{lake.bronze}.bronze_metadata_columns"], covered)


def refresh_silver(spark: SparkSession, config: JobConfig) -> dict[str, list[str] | None]:
    """Silver tables; returns the months rewritten per service, None standing for all."""
    lake, specs, months = config.lake, table_specs(config), {}
    for service in config.services:
        contract = config.contracts[service]
        bronze = bronze_table(lake, contract)
        rows = silver_trips(spark.table(bronze), contract, config.start_month, config.end_month)
        spec = specs[silver_table(config, service)]
        months[service] = refresh_months(spark, lake, spec, rows, bronze, _window(config))
    zones = config.contracts[ZONE_DATASET]
    lookup = silver_trips(spark.table(bronze_table(lake, zones)), zones, config.start_month, config.end_month)
    publish(spark, lake, specs[silver_table(config, ZONE_DATASET)], lookup)
    return months


def refresh_gold(spark: SparkSession, config: JobConfig) -> None:
    specs = table_specs(config)
    yellow, green = (spark.table(silver_table(config, service)) for service in ("yellow", "green"))
    refresh_months(
        spark,
        config.lake,
        specs[consumption_table(config)],
        gold.gold_consumption(yellow),
        bronze_table(config.lake, config.contracts["yellow"]),
        _window(config),
        silver_table(config, "yellow"),
    )
    hourly = gold.passengers_by_hour(yellow, green, config.passenger_month)
    publish(spark, config.lake, specs[hourly_table(config)], hourly)


def _window(config: JobConfig) -> str:
    return f"{config.start_month}..{config.end_month}"


def new_run(config: JobConfig) -> quality.Run:
    return quality.Run(
        str(uuid.uuid4()), datetime.now(timezone.utc), *window_dates(config.start_month, config.end_month)
    )


def evaluate_quality(
    spark: SparkSession,
    config: JobConfig,
    layers: str = ",".join(rules.LAYERS),
    gate: bool = False,
    run: quality.Run | None = None,
    recount: bool = False,
) -> DataFrame:
    """Evaluate the active rules, store the results, and only then let the gate speak.

    Months whose files and rules were counted before are not scanned again, unless ``recount`` asks for it.
    """
    names = quality.parse_layers(layers)
    lake = config.lake
    run = run or new_run(config)
    active = quality.load_rules(rules.active_rules(quality_store.current_catalog(spark, lake)))
    chosen = [quality_layer(spark, config, name) for name in rules.LAYERS if name in names]
    if recount:
        months = month_sequence(config.start_month, config.end_month)
        whole = [quality.Layer(layer.name, layer.table_name, layer.rows(months)) for layer in chosen]
        results = quality.evaluate(whole, active, run)
    else:
        results, _ = quality_state.evaluate_months(spark, lake, chosen, active, run)
    stored = quality_store.record(spark, lake, results, run)
    if gate:
        quality.enforce_gate(stored)
    return stored


def quality_layer(spark: SparkSession, config: JobConfig, name: str) -> quality_state.MonthlyLayer:
    """One of the layers of yellow trips within the window, by months."""
    lake, yellow = config.lake, config.contracts["yellow"]
    window = month_sequence(config.start_month, config.end_month)
    if name == "landing":
        present = _landing_files(spark, config, "yellow")
        files = present.filter(F.col("reference_month").isin(window)).select(
            F.col("reference_month").alias("month"), "path", "size_bytes", "modified_at"
        )

        def landing_rows(months: list[str]) -> DataFrame:
            return landing.landing_canonical(
                spark, lake.landing_path, "yellow", config.start_month, config.end_month, quality.landing_projection,
                present, months,
            )

        return quality_state.MonthlyLayer(name, f"{lake.landing_path}/yellow", files, landing_rows, "files", False)

    table, vendor = {
        "bronze": (bronze_table(lake, yellow), "VendorID"),
        "silver": (silver_table(config, "yellow"), "vendor_id"),
        "gold": (consumption_table(config), "VendorID"),
    }[name]
    stored = spark.table(table)

    def table_rows(months: list[str]) -> DataFrame:
        return quality.table_projection(stored.filter(F.col(MONTH).isin(months)), vendor)

    files = quality_state.month_files(spark, lake, table, MONTH, window)
    return quality_state.MonthlyLayer(name, table, files, table_rows, stored.schema.simpleString())


def run_job(spark: SparkSession, config: JobConfig, texts: DataFrame | None = None) -> DataFrame:
    """Landing check, contracts, bronze and silver, gate, gold, consolidated evaluation.

    Contracts are built where dictionary texts (``dataset``, ``text``) are given. Returns the
    last results.
    """
    check_landing(spark, config)
    if texts is not None:
        config = with_contracts(spark, config, texts)
    register_tables(spark, config)
    refresh_bronze(spark, config)
    refresh_metadata(spark, config)
    refresh_silver(spark, config)
    quality_store.synchronise(spark, config.lake, config.rule_document)
    evaluate_quality(spark, config, "landing,bronze,silver", gate=True)
    refresh_gold(spark, config)
    stored = evaluate_quality(spark, config)
    quality_store.register_views(spark, config.lake)
    return stored
