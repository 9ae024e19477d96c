"""Stored tables: Parquet in a shared folder, registered in the session catalogue."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.columns import sql_text

#: Table property: the committed version that the catalogue entry points at.
VERSION = "meterlake.version"
_COMMITS = "number bigint, path string"


@dataclass(frozen=True)
class Lake:
    """Where the layers live and what their databases are called."""

    root: str
    landing_path: str
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    quality: str = "quality"

    @property
    def metadata_path(self) -> str:
        return f"{self.landing_path}/_metadata"

    @property
    def contracts_path(self) -> str:
        return f"{self.metadata_path}/contracts"

    def location(self, table: str) -> str:
        database, name = table.split(".")
        return f"{self.root}/{database}/{name}"

    def versions(self, table: str) -> str:
        database, name = table.split(".")
        return f"{self.root}/_versions/{database}/{name}"

    def commits(self, table: str) -> str:
        database, name = table.split(".")
        return f"{self.root}/_commits/{database}/{name}"

    def checkpoint(self, table: str) -> str:
        database, name = table.split(".")
        return f"{self.root}/_checkpoints/{database}/{name}"

    def create_databases(self, spark: SparkSession) -> None:
        for database in (self.bronze, self.silver, self.gold, self.quality):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/{database}'")


@dataclass(frozen=True)
class TableSpec:
    """What a stored table is: name, schema with column metadata, layout, documentation."""

    name: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    comment: str = ""
    properties: dict[str, str] | None = None


def ensure_table(spark: SparkSession, lake: Lake, spec: TableSpec) -> None:
    """Register the table if this catalogue lacks it; data already at its place is kept.

    The columns keep their whole metadata, not only the comment. A catalogue that lives as
    long as the session finds earlier partitions again through the repair. A table from an
    older contract gains the columns it lacks; rows stored before read null there.
    """
    if spark.catalog.tableExists(spec.name):
        stored_names = {name.lower() for name in spark.table(spec.name).columns}
        added = [f for f in spec.schema.fields if f.name.lower() not in stored_names]
        if added:
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()} COMMENT {sql_text(f.metadata.get('comment', ''))}" for f in added
            )
            spark.sql(f"ALTER TABLE {spec.name} ADD COLUMNS ({columns})")
    else:
        number, location = committed(spark, lake, spec.name)
        if spec.partition_by:
            stored = T.StructType(
                [f for f in spec.schema.fields if f.name not in spec.partition_by]
                + [spec.schema[name] for name in spec.partition_by]
            )
            # Creating a table from a frame clears its folder. Where there is one already, the
            # table is created elsewhere, pointed at it, and its partitions looked up there.
            found = path_exists(spark, location)
            (
                spark.createDataFrame([], stored)
                .write.format("parquet")
                .option("path", f"{lake.root}/_registered/{uuid.uuid4().hex}" if found else location)
                .partitionBy(*spec.partition_by)
                .saveAsTable(spec.name)
            )
            if found:
                spark.sql(f"ALTER TABLE {spec.name} SET LOCATION {sql_text(location)}")
                spark.sql(f"MSCK REPAIR TABLE {spec.name}")
        else:
            spark.catalog.createTable(spec.name, location, "parquet", spec.schema)
        spark.sql(f"ALTER TABLE {spec.name} SET TBLPROPERTIES ('{VERSION}' = '{number}')")
    if spec.comment:
        spark.sql(f"COMMENT ON TABLE {spec.name} IS {sql_text(spec.comment)}")
    if spec.properties:
        pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in spec.properties.items())
        spark.sql(f"ALTER TABLE {spec.name} SET TBLPROPERTIES ({pairs})")


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def publish(spark: SparkSession, lake: Lake, spec: TableSpec, frame: DataFrame) -> None:
    """Full refresh of a derived table, without a shuffle, as a new version.

    Tasks write straight into the partitions of their rows, in a folder of the version's own. One appended row of the
    commit log then makes the version the table's current one, and the catalogue entry follows. A refresh that
    fails before leaves the old version in force; readers that planned on it keep its files until the
    refresh after next.
    """
    ensure_table(spark, lake, spec)
    number, _ = committed(spark, lake, spec.name)
    target = f"{lake.versions(spec.name)}/{number + 1:09d}-{uuid.uuid4().hex}"
    try:
        frame.to(spark.table(spec.name).schema).write.partitionBy(*spec.partition_by).parquet(target)
    except Exception:
        _delete(spark, target)
        raise
    entry = spark.createDataFrame([(number + 1, target)], _COMMITS)
    entry.coalesce(1).write.mode("append").parquet(lake.commits(spec.name))
    follow(spark, lake, spec)
    _expire(spark, lake, spec.name, number)


def committed(spark: SparkSession, lake: Lake, table: str) -> tuple[int, str]:
    """Number and folder of the table's current version; 0 and its first folder before any full refresh."""
    log = lake.commits(table)
    if not path_exists(spark, log):
        return 0, lake.location(table)
    newest = spark.read.schema(_COMMITS).parquet(log).orderBy(F.col("number").desc(), "path").first()
    return (newest["number"], newest["path"]) if newest else (0, lake.location(table))


def follow(spark: SparkSession, lake: Lake, spec: TableSpec) -> None:
    """Point the catalogue entry at the current version, if another session or a refresh moved it on.

    A table without partitions moves in one step. A partitioned one moves partition by partition, each of them whole.
    """
    number, location = committed(spark, lake, spec.name)
    if int(table_properties(spark, spec.name).get(VERSION, 0)) == number:
        return
    before = _partitions(spark, spec)
    spark.sql(f"ALTER TABLE {spec.name} SET LOCATION {sql_text(location)}")
    if spec.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {spec.name}")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in spec.partition_by])
        found = spark.read.schema(spark.table(spec.name).schema).parquet(location).select(*schema.names).distinct()
        now = {tuple(row) for row in found.collect()}
        for values in before:
            pairs = list(zip(spec.partition_by, values, strict=True))
            which = ", ".join(f"`{name}` = {'null' if value is None else sql_text(value)}" for name, value in pairs)
            if values in now:
                folder = "/".join(f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}" for name, value in pairs)
                spark.sql(f"ALTER TABLE {spec.name} PARTITION ({which}) SET LOCATION {sql_text(f'{location}/{folder}')}")
            else:
                spark.sql(f"ALTER TABLE {spec.name} DROP IF EXISTS PARTITION ({which})")
    spark.sql(f"ALTER TABLE {spec.name} SET TBLPROPERTIES ('{VERSION}' = '{number}')")
    spark.catalog.refreshTable(spec.name)


def _partitions(spark: SparkSession, spec: TableSpec) -> list[tuple[str | None, ...]]:
    if not spec.partition_by:
        return []
    parts = partition_values(spark, spec.name)
    return [tuple(None if p[c] in ("__HIVE_DEFAULT_PARTITION__", "null") else p[c] for c in spec.partition_by) for p in parts]


def _expire(spark: SparkSession, lake: Lake, table: str, oldest: int) -> None:
    """Delete the folder of the version before ``oldest``; the commit log keeps its rows."""
    log = spark.read.schema(_COMMITS).parquet(lake.commits(table))
    for row in log.where(F.col("number") == oldest - 1).collect():
        _delete(spark, row["path"])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def publish_months(
    spark: SparkSession, lake: Lake, spec: TableSpec, frame: DataFrame, column: str, values: list[str]
) -> None:
    """Rewrite the named partitions of a derived table and leave the others alone.

    ``frame`` is the whole definition of the table; the filter prunes its source.
    """
    ensure_table(spark, lake, spec)
    if not values:
        return
    follow(spark, lake, spec)
    ordered = spark.table(spec.name).columns
    wanted = frame.filter(F.col(column).isin(values)).select(*[F.col(f"`{c}`") for c in ordered])
    with dynamic_overwrite(spark):
        wanted.write.mode("overwrite").insertInto(spec.name)


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only partitions that receive rows, for the writes inside the block."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def partition_values(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Partitions as the catalogue knows them; no file is touched."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [dict(part.split("=", 1) for part in row["partition"].split("/")) for row in rows]


def replace_partition(frame: DataFrame, table: str, column: str, value: str) -> None:
    """Overwrite one partition, also when the new content is empty."""
    spark = frame.sparkSession
    ordered = [c for c in spark.table(table).columns if c != column]
    view = f"replacement_of_{table.replace('.', '_')}"
    frame.select(*[F.col(f"`{c}`") for c in ordered]).createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (`{column}` = {sql_text(value)}) SELECT * FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)
