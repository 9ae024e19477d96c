"""Trip-shaped frames over the generic benchmark tables.

The trip files themselves are not part of this repository. These deterministic mappings
give every operator whole tables to work on, with the nulls, zeros, negatives and late
files that real months contain: ``events`` become trips of four services, ``lineitem``
joined to ``orders`` becomes yellow trips over eighty months.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.contracts import Contract

SERVICE_EVENTS = {"yellow": ("click", "view", "error"), "green": ("purchase",), "fhv": ("signup",)}
#: Trips of dispatch platforms are those of the other for-hire service once more, in files of their own shape.
FILED_EVENTS = {**SERVICE_EVENTS, "fhvhv": ("signup",)}
REFERENCE_MONTHS = ("2023-12", "2024-01", "2024-02")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event."""
    services = " ".join(
        f"WHEN event_type IN ({', '.join(repr(kind) for kind in kinds)}) THEN '{name}'"
        for name, kinds in SERVICE_EVENTS.items()
    )
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "event_id AS trip_id",
            "user_id",
            "event_type",
            "CASE WHEN user_id % 29 = 0 THEN NULL ELSE user_id % 3 END AS vendor_id",
            f"CASE {services} END AS service_type",
            "CAST(CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 0 ELSE 1 + event_id % 4 END"
            " AS DOUBLE) AS passenger_count",
            "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 41 = 0 THEN -value ELSE value END AS total_amount",
            "CAST(ts AS TIMESTAMP) AS pickup_datetime",
            "CAST(CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 53 = 0 THEN -90"
            " WHEN event_id % 499 = 0 THEN 90000 ELSE floor(value * 60) END AS BIGINT) AS duration_seconds",
            "CASE WHEN event_id % 211 = 0 THEN '2024-02' WHEN event_id % 223 = 0 THEN '2023-12' ELSE '2024-01' END"
            " AS reference_month",
            "props AS rescued_data",
        )
        .selectExpr(
            "*",
            "pickup_datetime + duration_seconds * INTERVAL '1' SECOND AS dropoff_datetime",
            "concat(service_type, '_tripdata_', reference_month, '.parquet') AS source_file",
            "pickup_datetime + INTERVAL '40' DAY AS ingested_at",
        )
    )


def _trip_values(dataset: str) -> dict[str, str]:
    """Contract column to expression over a trip; contract columns without an entry are null."""
    if dataset == "fhv":
        return {
            "dispatching_base_num": "concat('B', user_id)",
            "pickup_datetime": "pickup_datetime",
            "dropOff_datetime": "dropoff_datetime",
            "PUlocationID": "user_id",
            "SR_Flag": "vendor_id",
        }
    if dataset == "fhvhv":
        return {
            "hvfhs_license_num": "concat('HV', user_id % 4)",
            "request_datetime": "pickup_datetime - INTERVAL '5' MINUTE",
            "pickup_datetime": "pickup_datetime",
            "dropoff_datetime": "dropoff_datetime",
            "PULocationID": "user_id",
            "trip_time": "duration_seconds",
            "driver_pay": "total_amount",
        }
    prefix = {"yellow": "tpep", "green": "lpep"}[dataset]
    return {
        "VendorID": "vendor_id",
        "passenger_count": "passenger_count",
        "total_amount": "total_amount",
        f"{prefix}_pickup_datetime": "pickup_datetime",
        f"{prefix}_dropoff_datetime": "dropoff_datetime",
        "PULocationID": "user_id",
        "fare_amount": "abs(total_amount)",
    }


def service_trips(trips: DataFrame, dataset: str) -> DataFrame:
    """Trips of one service; the filter is on the scanned column, so it is pushed down."""
    return trips.filter(F.col("event_type").isin(*FILED_EVENTS[dataset]))


def bronze_trips(trips: DataFrame, contract: Contract) -> DataFrame:
    """Event trips of one service in the bronze shape of its contract."""
    values = _trip_values(contract.dataset)
    return service_trips(trips, contract.dataset).selectExpr(
        *[
            f"CAST({values.get(c.name, 'NULL')} AS {c.data_type.simpleString()}) AS `{c.name}`"
            for c in contract.columns
        ],
        "rescued_data AS _rescued_data",
        "source_file AS _source_file",
        "ingested_at AS _ingested_at",
        "service_type AS _service_type",
        "reference_month AS _reference_month",
    )


def shipment_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yellow consumption rows from shipments: file month is the order's, pickup the shipment.

    Both sides are shuffled on the order key once; a hot key is split by adaptive execution.
    """
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey % 3 AS VendorID", "date_format(o_orderdate, 'yyyy-MM') AS _reference_month"
    )
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_quantity AS passenger_count",
        "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS total_amount",
        "CAST(l_shipdate AS TIMESTAMP) AS tpep_pickup_datetime",
        "CAST(l_shipdate AS TIMESTAMP) + INTERVAL '1' HOUR AS tpep_dropoff_datetime",
    )
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "VendorID",
        "passenger_count",
        "total_amount",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "_reference_month",
    )


def drifted_files(trips: DataFrame) -> dict[tuple[str, str], DataFrame]:
    """Physical frames per service and month, with the type and name drift of real files."""
    files: dict[tuple[str, str], DataFrame] = {}
    for service in FILED_EVENTS:
        for month in REFERENCE_MONTHS:
            month_trips = service_trips(trips, service).filter(F.col("reference_month") == month)
            files[service, month] = month_trips.selectExpr(
                *[f"{expression} AS `{name}`" for name, expression in _physical(service, month).items()]
            )
    return files


def _physical(service: str, month: str) -> dict[str, str]:
    columns = {
        name: f"CAST({value} AS TIMESTAMP_NTZ)" if name.lower().endswith("datetime") else value
        for name, value in _trip_values(service).items()
    }
    fee = "abs(total_amount) / 10"
    drift: dict[tuple[str, str], dict[str, str]] = {
        ("yellow", "2023-12"): {
            "VendorID": "CAST(vendor_id AS INT)",
            "passenger_count": "CAST(passenger_count AS BIGINT)",
            "Airport_fee": fee,
        },
        ("yellow", "2024-01"): {"airport_fee": fee},
        ("yellow", "2024-02"): {
            "VendorID": "vendor_id + CASE WHEN user_id % 7 = 0 THEN 0.5D ELSE 0D END",
            "total_amount": "CASE WHEN user_id % 11 = 0 THEN 'n/a' ELSE CAST(total_amount AS STRING) END",
            "airport_fee": fee,
            "meter_note": "rescued_data",
            "_rescued_data": """CASE WHEN user_id % 5 = 0 THEN concat('{"trip_note":"', user_id, '"}') END""",
        },
        ("green", "2023-12"): {"passenger_count": "CAST(passenger_count AS STRING)", "ehail_fee": "user_id"},
        ("fhv", "2024-02"): {"SR_Flag": "CAST(vendor_id AS INT)"},
        ("fhvhv", "2023-12"): {"driver_pay": "CAST(total_amount AS STRING)", "base_note": "rescued_data"},
    }
    return {**columns, **drift.get((service, month), {})}


def stage_landing(trips: DataFrame, root: str) -> str:
    """Write the drifted files below ``root`` under their published names."""

    def write(item: tuple[tuple[str, str], DataFrame]) -> None:
        (service, month), frame = item
        (
            frame.write.mode("overwrite")
            .option("mapreduce.output.basename", f"{service}_tripdata_{month}")
            .parquet(f"{root}/{service}/{month[:4]}/{month[5:]}")
        )

    # Small independent jobs; submitting them together keeps the executors busy.
    with ThreadPoolExecutor(len(REFERENCE_MONTHS)) as pool:
        list(pool.map(write, drifted_files(trips).items()))
    return root
