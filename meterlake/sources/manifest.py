"""The file manifest: what is known of every landing file, kept with the lake.

One row per version of a file (path, size, time): month, integrity status, row count, fields and a fingerprint of its schema.
A listing is joined with the manifest, and only files it does not know yet are opened, so each footer is read once,
whichever step asks first. A second, like table lists the files whose rows bronze has been seen to hold in full.

Every scan writes a folder of its own, so services are scanned side by side and a scan that dies leaves nothing behind.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.sources.landing import fingerprint, landing_integrity, list_files, read_footers
from meterlake.sources.tables import Lake, path_exists

VERSION = ["path", "size_bytes", "modified_at"]
MANIFEST_COLUMNS = (
    "path string, size_bytes long, modified_at timestamp, service string, reference_month string, status string, "
    "footer_rows long, fingerprint string, fields array<struct<name:string,type:string>>"
)
CONFIRMED_COLUMNS = "path string, size_bytes long, modified_at timestamp, footer_rows long"
READABLE = ("INTACT", "NO_MONTH")


def manifest_path(lake: Lake, service: str) -> str:
    return f"{lake.root}/_manifest/{service}"


def confirmed_path(lake: Lake, service: str) -> str:
    return f"{lake.root}/_manifest_confirmed/{service}"


def _rows(spark: SparkSession, path: str, columns: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).option("recursiveFileLookup", True).parquet(path)


def _append(frame: DataFrame, path: str) -> None:
    frame.write.parquet(f"{path}/scan-{uuid.uuid4().hex}")


def known_files(spark: SparkSession, lake: Lake, service: str) -> DataFrame:
    """Every version of every file that was ever scanned."""
    return _rows(spark, manifest_path(lake, service), MANIFEST_COLUMNS)


def comparable_path(path: Column) -> Column:
    """A path with one slash after the scheme; listings and scans spell local paths differently."""
    return F.regexp_replace(path, r"^([a-z0-9]+):/+", "$1:/")


def described(spark: SparkSession, lake: Lake, service: str, files: DataFrame) -> DataFrame:
    """Manifest rows of ``files`` (path, size_bytes, modified_at). Files not known yet are opened and added first.

    A version scanned by two steps at once stands twice in the manifest and once in the result.
    """
    new = files.select(*VERSION).join(known_files(spark, lake, service).select(*VERSION), VERSION, "left_anti")
    if not new.isEmpty():
        judged = landing_integrity(read_footers(new), keep=["fields"]).withColumn("fingerprint", fingerprint())
        scanned = new.join(judged, ["path", "size_bytes"])
        _append(scanned.select(*[c.split()[0] for c in MANIFEST_COLUMNS.split(", ")]), manifest_path(lake, service))
    return files.select(*VERSION).join(known_files(spark, lake, service).dropDuplicates(VERSION), VERSION)


def present_files(spark: SparkSession, lake: Lake, service: str) -> DataFrame:
    """Manifest rows of the files that are in landing now."""
    return described(spark, lake, service, list_files(spark, f"{lake.landing_path}/{service}"))


def unconfirmed_files(spark: SparkSession, lake: Lake, service: str) -> DataFrame:
    """Readable files in landing whose rows have not been counted in bronze yet."""
    confirmed = _rows(spark, confirmed_path(lake, service), CONFIRMED_COLUMNS)
    present = present_files(spark, lake, service).filter(F.col("status").isin(*READABLE))
    return present.join(confirmed.select(*VERSION), VERSION, "left_anti")


def confirm(lake: Lake, service: str, files: DataFrame) -> None:
    _append(files.select(*[c.split()[0] for c in CONFIRMED_COLUMNS.split(", ")]), confirmed_path(lake, service))
