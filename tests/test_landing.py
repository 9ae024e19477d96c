from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from meterlake.contracts import ContractColumn, base_contract
from meterlake.operators import quality
from meterlake.sources import landing, metadata
from meterlake.sources.tables import Lake
from meterlake.streaming.ingest import ingest_services, start_over

PICKUP, DROPOFF = datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 11)


def write(root: Path, month: str, columns: dict, name: str | None = None) -> Path:
    folder = root / "yellow" / month[:4] / month[5:]
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / (name or f"yellow_tripdata_{month}.parquet")
    times = {"tpep_pickup_datetime": pa.array([PICKUP] * 2), "tpep_dropoff_datetime": pa.array([DROPOFF] * 2)}
    pq.write_table(pa.table({**columns, **times}), path)
    return path


def plain(vendor=pa.int64(), passengers=pa.float64()):
    return {
        "VendorID": pa.array([1, 2], vendor),
        "passenger_count": pa.array([1, None], passengers),
        "total_amount": pa.array([10.5, -3.0]),
    }


def ingest(spark, lake) -> str:
    return ingest_services(spark, lake, [base_contract("yellow")])["yellow"]


@pytest.fixture
def lake(spark, tmp_path):
    suffix = tmp_path.name.replace("-", "_")
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "landing"), bronze=f"bronze_{suffix}")
    spark.sql(f"CREATE DATABASE {lake.bronze} LOCATION '{tmp_path}/lake/bronze'")
    return lake


def test_integrity(spark, tmp_path):
    write(tmp_path, "2024-01", plain())
    write(tmp_path, "2024-02", plain(), "yellow_tripdata.parquet")
    folder = tmp_path / "yellow" / "2024" / "01"
    (folder / "yellow_tripdata_2024-03.parquet").write_bytes(b"PAR1")
    (folder / "yellow_tripdata_2024-04.parquet").write_bytes(b"<html>not found</html>")
    whole = (folder / "yellow_tripdata_2024-01.parquet").read_bytes()
    (folder / "yellow_tripdata_2024-05.parquet").write_bytes(whole[:-20])
    (folder / "yellow_tripdata_2024-06.parquet").write_bytes(whole[:40] + b"PAR1")
    (folder / "yellow_tripdata_2024-07.parquet").write_bytes(b"")
    listed = landing.list_files(spark, str(tmp_path)).select("path", "size_bytes")
    footers = landing.read_footers(listed.unionByName(landing.empty_files(spark, str(tmp_path))))
    found = {r["file_name"]: r["status"] for r in landing.landing_integrity(footers).collect()}
    assert found == {
        "yellow_tripdata_2024-01.parquet": "INTACT",
        "yellow_tripdata.parquet": "NO_MONTH",
        "yellow_tripdata_2024-03.parquet": "TOO_SHORT",
        "yellow_tripdata_2024-04.parquet": "NOT_PARQUET",
        "yellow_tripdata_2024-05.parquet": "NOT_PARQUET",
        "yellow_tripdata_2024-06.parquet": "UNREADABLE_FOOTER",
        "yellow_tripdata_2024-07.parquet": "EMPTY",
    }


def test_an_empty_file_is_a_gap(spark, tmp_path):
    """Spark lists no file without bytes, so its month counts as missing."""
    write(tmp_path, "2024-01", plain())
    (tmp_path / "yellow" / "2024" / "01" / "yellow_tripdata_2024-02.parquet").write_bytes(b"")
    files = landing.with_identity(landing.list_files(spark, str(tmp_path)))
    rows = landing.landing_gaps(files, ["yellow"], "2024-01", "2024-02").collect()
    assert [r["reference_month"] for r in rows] == ["2024-02"]


def test_gaps_are_tolerated_at_the_recent_end(spark):
    present = spark.createDataFrame([("yellow", "2023-11"), ("yellow", "2024-01")], "service string, reference_month string")
    rows = landing.landing_gaps(present, ["yellow"], "2023-10", "2024-03").collect()
    assert {(r["reference_month"], r["tolerated"]) for r in rows} == {
        ("2023-10", False),
        ("2023-12", False),
        ("2024-02", True),
        ("2024-03", True),
    }


def test_drifted_months_read_as_one(spark, tmp_path):
    write(tmp_path, "2023-12", plain(pa.int32(), pa.int64()))
    write(tmp_path, "2024-01", plain())
    write(tmp_path, "2024-02", plain(pa.float64()) | {"passenger_count": pa.array(["1.0", "x"])})
    write(tmp_path, "2024-03", plain())
    footers = landing.read_footers(landing.list_files(spark, f"{tmp_path}/yellow"))
    assert sorted(len(g.paths) for g in landing.schema_groups(spark, footers)) == [1, 1, 2]
    frame = landing.landing_canonical(
        spark, str(tmp_path), "yellow", "2023-12", "2024-01", quality.landing_projection
    )
    assert dict(frame.dtypes)["vendor_id"] == "bigint"
    found = {(r["reference_month"], r["vendor_id"], r["passenger_count"]) for r in frame.collect()}
    assert found == {("2023-12", 1, 1.0), ("2023-12", 2, None), ("2024-01", 1, 1.0), ("2024-01", 2, None)}


def test_missing_window_is_an_error(spark, tmp_path):
    write(tmp_path, "2024-01", plain())
    with pytest.raises(FileNotFoundError):
        landing.landing_canonical(spark, str(tmp_path), "yellow", "2022-01", "2022-02", quality.landing_projection)


def test_ingestion_is_incremental_and_lossless(spark, lake):
    root = Path(lake.landing_path)
    fee = pa.array([1.25, 2.5])
    write(root, "2023-12", plain(pa.int32(), pa.int64()) | {"Airport_fee": fee})
    write(root, "2024-01", plain() | {"airport_fee": fee, "note": pa.array(["a", None])})
    table = ingest(spark, lake)
    rows = {
        (r["_reference_month"], r["VendorID"]): (r["airport_fee"], r["_rescued_data"]) for r in spark.table(table).collect()
    }
    assert rows == {
        ("2023-12", 1): (1.25, None),
        ("2023-12", 2): (2.5, None),
        ("2024-01", 1): (1.25, '{"note":"a"}'),
        ("2024-01", 2): (2.5, None),
    }
    stamps = {r[0] for r in spark.table(table).select("_ingested_at").collect()}

    ingest(spark, lake)
    assert spark.table(table).count() == 4

    # A second file of a known month, and one that brings its own rescue column.
    write(root, "2023-12", plain(), "yellow_tripdata_2023-12_part2.parquet")
    rescued = pa.array(['{"total_amount": "7.5", "Airport_fee": "0.5"}', None])
    late = plain() | {"total_amount": pa.array([None, 4.0], pa.float64()), "_rescued_data": rescued}
    write(root, "2024-02", late)
    ingest(spark, lake)
    stored = spark.table(table)
    assert stored.count() == 8
    assert stored.filter("_reference_month = '2023-12'").count() == 4
    assert {r[0] for r in stored.filter("_ingest_batch = 0").select("_ingested_at").collect()} == stamps
    february = {r["VendorID"]: r for r in stored.filter("_reference_month = '2024-02'").collect()}
    assert february[1]["total_amount"] == 7.5 and february[1]["airport_fee"] == 0.5
    assert february[2]["total_amount"] == 4.0


def test_a_longer_contract_widens_the_table(spark, lake):
    root, contract = Path(lake.landing_path), base_contract("yellow")
    write(root, "2024-01", plain() | {"meter_note": pa.array(["a", "b"])})
    table = ingest(spark, lake)
    longer = replace(contract, columns=(*contract.columns, ContractColumn("meter_note", "string", "Driver's note")))
    write(root, "2024-02", plain() | {"meter_note": pa.array(["c", "d"])})
    ingest_services(spark, lake, [longer])
    rows = {(r["_reference_month"], r["meter_note"], r["_rescued_data"]) for r in spark.table(table).collect()}
    assert rows == {
        ("2024-01", None, '{"meter_note":"a"}'),
        ("2024-01", None, '{"meter_note":"b"}'),
        ("2024-02", "c", None),
        ("2024-02", "d", None),
    }


def test_both_spellings_in_one_file(spark, lake):
    """The last spelling feeds the contract column, the other one is kept as rescued data."""
    columns = plain() | {"airport_fee": pa.array([1.0, 2.0]), "Airport_fee": pa.array([3.0, 4.0])}
    write(Path(lake.landing_path), "2024-01", columns)
    table = ingest(spark, lake)
    rows = {r["VendorID"]: (r["airport_fee"], r["_rescued_data"]) for r in spark.table(table).collect()}
    assert rows == {1: (3.0, '{"airport_fee":1.0}'), 2: (4.0, '{"airport_fee":2.0}')}


def test_a_replayed_batch_replaces_itself(spark, lake):
    """Losing the commit of a batch makes the stream run it again."""
    write(Path(lake.landing_path), "2024-01", plain())
    table = ingest(spark, lake)
    commits = Path(lake.checkpoint(table)) / "commits"
    for entry in [*commits.glob("0"), *commits.glob(".0.crc")]:
        entry.unlink()
    ingest(spark, lake)
    assert spark.table(table).count() == 2


def test_an_unreadable_file_is_not_lost(spark, lake):
    """Its batch stops, and goes through once the file is repaired under the same name."""
    root = Path(lake.landing_path)
    write(root, "2024-01", plain())
    broken = root / "yellow" / "2024" / "02" / "yellow_tripdata_2024-02.parquet"
    broken.parent.mkdir(parents=True)
    broken.write_bytes(b"<html></html>")
    with pytest.raises(StreamingQueryException, match="yellow_tripdata_2024-02"):
        ingest(spark, lake)
    assert spark.table(f"{lake.bronze}.bronze_yellow_trips").count() == 0
    write(root, "2024-02", plain())
    table = ingest(spark, lake)
    counted = spark.table(table).groupBy("_reference_month").count().collect()
    assert {r["_reference_month"]: r["count"] for r in counted} == {"2024-01": 2, "2024-02": 2}


def test_artifacts(spark, tmp_path):
    (tmp_path / "data_dictionary_trip_records_hvfhs.pdf").write_bytes(b"dictionary")
    (tmp_path / "notes.txt").write_bytes(b"abc")
    (tmp_path / "contracts").mkdir()
    (tmp_path / "contracts" / "yellow.yml").write_text("{}")
    rows = {r["file_name"]: r for r in metadata.artifact_inventory(metadata.list_artifacts(spark, str(tmp_path))).collect()}
    known = rows["data_dictionary_trip_records_hvfhs.pdf"]
    assert (known["dataset_slug"], known["source_slug"], known["size_bytes"]) == ("fhvhv", "hvfhs", 10)
    assert known["governance_note"].startswith("The official dictionary")
    assert rows["notes.txt"]["artifact_type"] is None and rows["notes.txt"]["governance_note"] is None
    sums = metadata.artifact_sha256(metadata.read_artifacts(spark, str(tmp_path)))
    digest = sums.filter(F.col("file_name") == "notes.txt").first()["source_sha256"]
    assert digest == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_a_backfilled_file_with_an_old_timestamp_is_read(spark, tmp_path):
    import os
    import time

    from meterlake.streaming.ingest import file_stream

    landing_root, seen = tmp_path / "landing", []
    for month, days in (("2024-01", 0), ("2023-12", 30)):
        path = str(landing_root / f"yellow_tripdata_{month}.parquet")
        spark.range(1).coalesce(1).write.parquet(path)
        for part in (landing_root / f"yellow_tripdata_{month}.parquet").glob("*.parquet"):
            then = time.time() - days * 86_400
            os.utime(part, (then, then))
        stream = file_stream(spark, str(landing_root)).writeStream.option("checkpointLocation", str(tmp_path / "state"))
        stream.trigger(availableNow=True).foreachBatch(lambda b, _: seen.extend(r["path"] for r in b.collect())).start().awaitTermination()
    assert {month for month in ("2024-01", "2023-12") if any(month in p for p in seen)} == {"2024-01", "2023-12"}


def test_an_empty_file_is_read_once_it_is_filled(spark, lake):
    """A file without bytes is an upload under way; the stream counts it as seen, the manifest does not."""
    root = Path(lake.landing_path)
    write(root, "2024-01", plain())
    waiting = root / "yellow" / "2024" / "02" / "yellow_tripdata_2024-02.parquet"
    waiting.parent.mkdir(parents=True)
    waiting.write_bytes(b"")
    assert spark.table(ingest(spark, lake)).count() == 2
    write(root, "2024-02", plain())
    counted = spark.table(ingest(spark, lake)).groupBy("_reference_month").count().collect()
    assert {r["_reference_month"]: r["count"] for r in counted} == {"2024-01": 2, "2024-02": 2}


def test_landing_rows_never_fail(spark, tmp_path):
    """Amounts that are no numbers, an absent column and two spellings read as they do in bronze."""
    write(tmp_path, "2024-01", plain() | {"total_amount": pa.array(["n/a", "7.5"])})
    short = plain()
    del short["passenger_count"]
    write(tmp_path, "2024-02", short)
    write(tmp_path, "2024-03", plain() | {"airport_fee": pa.array([1.0, 2.0]), "Airport_fee": pa.array([3.0, 4.0])})
    frame = landing.landing_canonical(spark, str(tmp_path), "yellow", "2024-01", "2024-03", quality.landing_projection)
    found = {(r["reference_month"], r["vendor_id"]): (r["passenger_count"], r["total_amount"]) for r in frame.collect()}
    assert found == {
        ("2024-01", 1): (1.0, None),
        ("2024-01", 2): (None, 7.5),
        ("2024-02", 1): (None, 10.5),
        ("2024-02", 2): (None, -3.0),
        ("2024-03", 1): (1.0, 10.5),
        ("2024-03", 2): (None, -3.0),
    }


def test_the_order_of_columns_makes_no_schema(spark, tmp_path):
    write(tmp_path, "2024-01", plain())
    write(tmp_path, "2024-02", dict(reversed(plain().items())))
    groups = landing.schema_groups(spark, landing.read_footers(landing.list_files(spark, str(tmp_path))))
    assert [len(g.paths) for g in groups] == [2]
    assert {r["VendorID"] for r in groups[0].read(spark).collect()} == {1, 2}


def test_starting_over_takes_in_a_republished_month(spark, lake):
    root = Path(lake.landing_path)
    write(root, "2024-01", plain())
    write(root, "2024-02", plain())
    table = ingest(spark, lake)
    write(root, "2024-01", plain() | {"total_amount": pa.array([99.0, 98.0])})
    ingest(spark, lake)
    assert spark.table(table).count() == 4
    for _ in range(2):
        start_over(spark, lake, base_contract("yellow"))
        ingest(spark, lake)
        rows = sorted((r["_reference_month"], r["total_amount"]) for r in spark.table(table).collect())
        assert rows == [("2024-01", 98.0), ("2024-01", 99.0), ("2024-02", -3.0), ("2024-02", 10.5)]
