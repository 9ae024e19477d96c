"""Column contracts of the trip datasets and the schemas built from them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.columns import snake_case

TRIP_SERVICES = ("yellow", "green", "fhv", "fhvhv")
ZONE_DATASET = "taxi_zones"
EXTRACTOR_VERSION = "1.0.0"

LOGICAL_TYPES: dict[str, T.DataType] = {
    "double": T.DoubleType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}

# --- Fixed values: field names and logical types of the published files -------
FIXED_COLUMNS: dict[str, str] = {
    "yellow": """
        VendorID long, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,
        passenger_count double, trip_distance double, RatecodeID double,
        store_and_fwd_flag string, PULocationID long, DOLocationID long,
        payment_type long, fare_amount double, extra double, mta_tax double,
        tip_amount double, tolls_amount double, improvement_surcharge double,
        total_amount double, congestion_surcharge double, airport_fee double,
        cbd_congestion_fee double
    """,
    "green": """
        VendorID long, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp,
        store_and_fwd_flag string, RatecodeID double, PULocationID long,
        DOLocationID long, passenger_count double, trip_distance double,
        fare_amount double, extra double, mta_tax double, tip_amount double,
        tolls_amount double, improvement_surcharge double, total_amount double,
        payment_type long, trip_type double, congestion_surcharge double,
        cbd_congestion_fee double
    """,
    "fhv": """
        dispatching_base_num string, pickup_datetime timestamp, dropOff_datetime timestamp,
        PUlocationID long, DOlocationID long, SR_Flag long, Affiliated_base_number string
    """,
    "fhvhv": """
        hvfhs_license_num string, dispatching_base_num string, originating_base_num string,
        request_datetime timestamp, on_scene_datetime timestamp, pickup_datetime timestamp,
        dropoff_datetime timestamp, PULocationID long, DOLocationID long,
        trip_miles double, trip_time long, base_passenger_fare double, tolls double,
        bcf double, sales_tax double, congestion_surcharge double, airport_fee double,
        tips double, driver_pay double, shared_request_flag string,
        shared_match_flag string, access_a_ride_flag string, wav_request_flag string,
        wav_match_flag string, cbd_congestion_fee double
    """,
    "taxi_zones": """
        LocationID integer, Borough string, Zone string, service_zone string
    """,
}
FIXED_DICTIONARY_FILES = {
    "yellow": "data_dictionary_trip_records_yellow.pdf",
    "green": "data_dictionary_trip_records_green.pdf",
    "fhv": "data_dictionary_trip_records_fhv.pdf",
    "fhvhv": "data_dictionary_trip_records_hvfhs.pdf",
    "taxi_zones": "taxi_zone_lookup.csv",
}
FIXED_BRONZE_TABLES = {
    "yellow": "bronze_yellow_trips",
    "green": "bronze_green_trips",
    "fhv": "bronze_fhv_trips",
    "fhvhv": "bronze_fhvhv_trips",
    "taxi_zones": "bronze_taxi_zone_lookup",
}
# The dictionary of the high-volume service carries another slug than its files.
FIXED_DICTIONARY_SLUGS = {"yellow": "yellow", "green": "green", "fhv": "fhv", "fhvhv": "hvfhs"}
FIXED_ZONE_DESCRIPTIONS = {
    "LocationID": "Location identifier used by trip records.",
    "Borough": "New York City borough.",
    "Zone": "NYC TLC taxi zone name.",
    "service_zone": "NYC TLC service zone classification.",
}
FIXED_GOVERNANCE_NOTES = {
    "fhvhv": "The official dictionary uses hvfhs; the monthly dataset uses fhvhv.",
}
# Spellings under which a field was published in some months.
FIXED_COLUMN_ALIASES: dict[str, tuple[str, ...]] = {"airport_fee": ("Airport_fee",)}
# --- End of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class ContractColumn:
    name: str
    logical_type: str
    description: str = ""
    references: str | None = None

    @property
    def data_type(self) -> T.DataType:
        return LOGICAL_TYPES[self.logical_type]


TECHNICAL_COLUMNS = (
    ContractColumn("_source_file", "string", "Landing file the row was read from."),
    ContractColumn("_ingested_at", "timestamp", "Instant the row was stored in bronze."),
    ContractColumn("_service_type", "string", "Service category of the trip."),
    ContractColumn("_reference_month", "string", "Month named by the source file."),
)
RESCUED_COLUMN = ContractColumn(
    "_rescued_data", "string", "Source values that no contract column could hold, as JSON."
)


@dataclass(frozen=True)
class Contract:
    """What one dataset promises: its table, its columns and where they are documented."""

    dataset: str
    table: str
    columns: tuple[ContractColumn, ...]
    description: str = ""
    dictionary_slug: str | None = None
    source_file: str = ""
    source_sha256: str = ""
    extractor_version: str = EXTRACTOR_VERSION
    governance_note: str | None = None
    aliases: dict[str, tuple[str, ...]] = field(default_factory=lambda: FIXED_COLUMN_ALIASES)

    def bronze_columns(self) -> tuple[ContractColumn, ...]:
        return (*self.columns, RESCUED_COLUMN, *TECHNICAL_COLUMNS)

    def silver_columns(self) -> tuple[ContractColumn, ...]:
        if self.dataset == ZONE_DATASET:
            return self.columns
        return (*self.columns, *TECHNICAL_COLUMNS)

    def bronze_metadata(self, column: ContractColumn) -> dict[str, str]:
        return {
            "comment": column.description,
            "contract_source": self.source_file,
            "contract_sha256": self.source_sha256,
            "extractor_version": self.extractor_version,
        }

    def silver_metadata(self, column: ContractColumn) -> dict[str, str]:
        metadata = {
            "comment": column.description,
            "source_column": column.name,
            "inherited_from": self.table,
        }
        if column.references:
            metadata["references"] = column.references
        return metadata

    def bronze_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.data_type, True, self.bronze_metadata(c)) for c in self.bronze_columns()]
        )

    def silver_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(snake_case(c.name), c.data_type, True, self.silver_metadata(c))
                for c in self.silver_columns()
            ]
        )


def _parse_columns(dataset: str) -> tuple[ContractColumn, ...]:
    described = FIXED_ZONE_DESCRIPTIONS if dataset == ZONE_DATASET else {}
    pairs = (item.split() for item in FIXED_COLUMNS[dataset].split(","))
    return tuple(ContractColumn(name, kind, described.get(name, "")) for name, kind in pairs)


def base_contract(dataset: str) -> Contract:
    """The contract as far as it is fixed, before descriptions are read from a dictionary."""
    return Contract(
        dataset=dataset,
        table=FIXED_BRONZE_TABLES[dataset],
        columns=_parse_columns(dataset),
        description="Official NYC TLC taxi zone lookup." if dataset == ZONE_DATASET else "",
        dictionary_slug=FIXED_DICTIONARY_SLUGS.get(dataset),
        source_file=FIXED_DICTIONARY_FILES[dataset],
        governance_note=FIXED_GOVERNANCE_NOTES.get(dataset),
    )


def base_contracts() -> dict[str, Contract]:
    return {name: base_contract(name) for name in (*TRIP_SERVICES, ZONE_DATASET)}


CONTRACT_FILE_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("dictionary_slug", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_sha256", T.StringType()),
        T.StructField("extractor_version", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField(
            "columns",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("description", T.StringType()),
                        T.StructField("type", T.StringType()),
                        T.StructField("references", T.StringType()),
                    ]
                ),
            ),
        ),
        T.StructField("governance_note", T.StringType()),
    ]
)


def read_contracts(spark: SparkSession, path: str) -> dict[str, Contract]:
    """Contract documents (JSON text, one per dataset) as ``Contract`` objects.

    A contract decides the schema of later plans, so it has to be on the driver;
    there is one row per dataset.
    """
    documents = (
        spark.read.schema(CONTRACT_FILE_SCHEMA)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
        # As entries, because a collected map does not keep the order of its keys.
        .withColumn("columns", F.map_entries("columns"))
    )
    contracts = {}
    for row in documents.collect():
        contracts[row["dataset"]] = Contract(
            dataset=row["dataset"],
            table=row["table"],
            columns=tuple(
                ContractColumn(name, spec["type"], spec["description"] or "", spec["references"])
                for name, spec in row["columns"]
            ),
            description=row["description"] or "",
            dictionary_slug=row["dictionary_slug"],
            source_file=row["source_file"] or "",
            source_sha256=row["source_sha256"] or "",
            extractor_version=row["extractor_version"] or EXTRACTOR_VERSION,
            governance_note=row["governance_note"],
        )
    missing = {*TRIP_SERVICES, ZONE_DATASET} - contracts.keys()
    if missing:
        raise ValueError(f"no contract for: {', '.join(sorted(missing))}")
    return contracts


def contract_fields(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    """The expected fields as rows, for comparison with what files really hold."""
    rows = [
        (c.dataset, c.table, c.dictionary_slug, column.name, column.logical_type, column.description, column.references)
        for c in contracts
        for column in (*c.columns, *TECHNICAL_COLUMNS)
    ]
    return spark.createDataFrame(
        rows,
        "dataset string, table_name string, dictionary_slug string, column_name string, "
        "expected_type string, description string, references string",
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)
