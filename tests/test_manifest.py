"""The file manifest, and bronze held against it."""

from __future__ import annotations

import shutil
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterlake.contracts import base_contract
from meterlake.plans.refresh import latest_batches
from meterlake.sources import landing, manifest
from meterlake.sources.tables import Lake
from meterlake.streaming import ingest as ingestion
from test_landing import ingest, plain, write

YELLOW = base_contract("yellow")


@pytest.fixture
def lake(spark, tmp_path):
    suffix = tmp_path.name.replace("-", "_")
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "landing"), bronze=f"bronze_m_{suffix}")
    spark.sql(f"CREATE DATABASE {lake.bronze} LOCATION '{tmp_path}/lake/bronze'")
    return lake


def counts(spark, table) -> dict:
    spark.catalog.refreshTable(table)
    return {r["_reference_month"]: r["count"] for r in spark.table(table).groupBy("_reference_month").count().collect()}


def test_each_footer_is_read_once(spark, lake, monkeypatch):
    root = Path(lake.landing_path)
    write(root, "2024-01", plain())
    write(root, "2024-02", plain())
    ingest(spark, lake)
    known = manifest.known_files(spark, lake, "yellow")
    assert sorted((r["reference_month"], r["status"], r["footer_rows"]) for r in known.collect()) == [("2024-01", "INTACT", 2), ("2024-02", "INTACT", 2)]
    opened = []
    real = manifest.read_footers

    def counted(files):
        opened.extend(r["path"].rsplit("/", 1)[-1] for r in files.select("path").collect())
        return real(files)

    monkeypatch.setattr(manifest, "read_footers", counted)
    ingest(spark, lake)
    assert manifest.present_files(spark, lake, "yellow").count() == 2 and opened == []
    write(root, "2024-03", plain())
    ingest(spark, lake)
    assert opened == ["yellow_tripdata_2024-03.parquet"]


def test_a_file_filled_after_the_listing_is_found(spark, lake, monkeypatch):
    """The stream lists a file without bytes, counts it as seen, and it is filled while the batch is stored."""
    root = Path(lake.landing_path)
    write(root, "2024-01", plain())
    late = root / "yellow" / "2024" / "02" / "yellow_tripdata_2024-02.parquet"
    late.parent.mkdir(parents=True)
    late.write_bytes(b"")
    real = ingestion.store_batch

    def fill_then_store(*args):
        if not late.stat().st_size:
            write(root, "2024-02", plain())
        real(*args)

    monkeypatch.setattr(ingestion, "store_batch", fill_then_store)
    table = ingest(spark, lake)
    assert counts(spark, table) == {"2024-01": 2, "2024-02": 2}
    ingest(spark, lake)
    assert counts(spark, table) == {"2024-01": 2, "2024-02": 2}


def test_rows_lost_or_stored_twice_are_mended(spark, lake):
    root = Path(lake.landing_path)
    write(root, "2024-01", plain())
    write(root, "2024-01", plain(), "yellow_tripdata_2024-01_b.parquet")
    write(root, "2024-02", plain())
    write(root, "2024-03", plain())
    ingestion.start_ingest(spark, lake, YELLOW).awaitTermination()
    table = ingestion.bronze_table(lake, YELLOW)
    before = latest_batches(spark, table)
    location = Path(lake.location(table).removeprefix("file:"))
    [copied] = (location / "_reference_month=2024-02" / "_ingest_batch=0").glob("*.parquet")
    shutil.copy(copied, copied.with_name("again.parquet"))
    for lost in (location / "_reference_month=2024-03" / "_ingest_batch=0").glob("*.parquet"):
        lost.unlink()
    # One of two files of a month stands in the table twice.
    twice = location / "_reference_month=2024-01" / "_ingest_batch=0"
    half = spark.read.parquet(str(twice)).filter(F.col("_source_file").endswith("_b.parquet")).collect()
    schema = spark.read.parquet(str(twice)).schema
    spark.createDataFrame(half, schema).coalesce(1).write.mode("append").parquet(str(twice))
    spark.catalog.refreshTable(table)
    open_files = manifest.unconfirmed_files(spark, lake, "yellow")
    states = ingestion.file_ledger(spark, lake, YELLOW, open_files).select("reference_month", "state").collect()
    assert sorted(map(tuple, states)) == [("2024-01", "COMPLETE"), ("2024-01", "EXCESS"), ("2024-02", "EXCESS"), ("2024-03", "MISSING")]
    assert ingestion.reconcile(spark, lake, YELLOW) == 3
    assert counts(spark, table) == {"2024-01": 4, "2024-02": 2, "2024-03": 2}
    after = latest_batches(spark, table)
    assert all(after[month] > before.get(month, -1) for month in ("2024-01", "2024-02", "2024-03"))
    assert ingestion.reconcile(spark, lake, YELLOW) == 0
    assert manifest.unconfirmed_files(spark, lake, "yellow").isEmpty()
    # The next batch of the stream comes after the ones read again.
    write(root, "2024-04", plain())
    ingest(spark, lake)
    assert latest_batches(spark, table)["2024-04"] > max(after.values())


def test_what_reaches_the_driver_grows_with_folders(spark):
    """100,000 files in 24 folders of one schema, and one folder with two."""
    month = F.format_string("%02d", F.col("id") % 12 + 1)
    folder = F.concat(F.lit("file:/landing/yellow/"), F.when(F.col("id") % 24 < 12, "2023/").otherwise("2024/"), month)
    files = spark.range(100_000).select(
        F.concat(folder, F.lit("/yellow_tripdata_"), F.col("id"), F.lit(".parquet")).alias("path"),
        F.array(F.struct(F.lit("VendorID").alias("name"), F.when(F.col("id") == 5, "int32").otherwise("int64").alias("type"))).alias("fields"),
    )
    rows = landing.group_places(files, files.select("path")).collect()
    patterns = [r for r in rows if r["places"][0].endswith("/*.parquet")]
    assert len(rows) == 25 and len(patterns) == 23 and all(len(r["places"]) == 1 for r in patterns)
    mixed = [len(r["places"]) for r in rows if r not in patterns]
    assert sorted(mixed) == sorted([1, 100_000 // 24 + (5 < 100_000 % 24) - 1])


def test_whole_folders_are_read_by_pattern(spark, tmp_path):
    write(tmp_path, "2024-01", plain())
    write(tmp_path, "2024-01", plain(), "yellow_tripdata_2024-01_b.parquet")
    write(tmp_path, "2024-02", plain())
    write(tmp_path, "2024-02", plain(pa.int32()), "yellow_tripdata_2024-02_b.parquet")
    (tmp_path / "yellow" / "2024" / "01" / "yellow_tripdata_2024-01_c.parquet").write_bytes(b"")
    files = landing.list_files(spark, str(tmp_path))
    groups = landing.schema_groups(spark, landing.read_footers(files), files)
    assert sorted(p.rsplit("/", 1)[-1] for g in groups for p in g.paths) == ["*.parquet", "yellow_tripdata_2024-02.parquet", "yellow_tripdata_2024-02_b.parquet"]
    assert sum(g.read(spark).count() for g in groups) == 8
