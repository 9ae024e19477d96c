"""Incremental bronze ingestion with Structured Streaming.

The stream lists files; it does not read them. Each micro-batch groups its new files by
footer schema and reads them with the batch code of ``operators.bronze``, because a
streaming Parquet read would need one schema for all months.

Every file is processed once: the checkpoint remembers it, and after each run the manifest is held against the
rows that bronze holds of each file. A file that the stream passed over, say because it had no byte when it was listed, and a file that
bronze holds in part or twice are read again as a batch of their own. A file that cannot be read stops its batch
before anything is stored, and the batch is tried again on the next run. A batch that is replayed after
a failure overwrites exactly the partitions it wrote before, because the batch number is
part of the partition, so a month may also arrive in several files over several batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake.contracts import Contract
from meterlake.functions.columns import sql_text
from meterlake.operators.bronze import bronze_rows
from meterlake.session import scratch_dir
from meterlake.sources import manifest
from meterlake.sources.landing import FILE_LISTING_SCHEMA, schema_groups
from meterlake.sources.tables import (
    Lake,
    TableSpec,
    dynamic_overwrite,
    ensure_table,
    partition_values,
    path_exists,
    publish,
)

BATCH_COLUMN = "_ingest_batch"
STREAM_PROPERTY = "meterlake.stream_id"
BRONZE_PARTITIONS = ("_reference_month", BATCH_COLUMN)
MAX_FILES_PER_BATCH = 10_000
#: Numbers from one batch of the stream to the next; those between are batches of files read again.
BATCH_STEP = 1_000


#: Spark's default of seven days would pass over a backfilled file whose timestamp is older than the newest one's.
LONGEST_FILE_AGE = "36500d"


def bronze_table(lake: Lake, contract: Contract) -> str:
    return f"{lake.bronze}.{contract.table}"


def bronze_spec(lake: Lake, contract: Contract, properties: dict[str, str] | None = None) -> TableSpec:
    batch = T.StructField(BATCH_COLUMN, T.LongType(), True, {"comment": "Micro-batch that stored the row."})
    return TableSpec(
        bronze_table(lake, contract),
        T.StructType([*contract.bronze_schema().fields, batch]),
        BRONZE_PARTITIONS,
        contract.description,
        properties,
    )


def service_properties(contract: Contract, user_guide: str, dictionary: str, parquet_format: str) -> dict[str, str]:
    # The property names under which lineage is published.
    properties = {
        "tlc.metadata.user_guide": user_guide,
        "tlc.metadata.data_dictionary": dictionary,
        "tlc.metadata.parquet_format": parquet_format,
        "tlc.metadata.dataset_slug": contract.dataset,
    }
    if contract.dictionary_slug != contract.dataset:
        properties["tlc.metadata.dictionary_slug"] = contract.dictionary_slug
        properties["tlc.metadata.slug_mapping"] = f"{contract.dictionary_slug} -> {contract.dataset}"
    return properties


def file_stream(spark: SparkSession, path: str, max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    """New Parquet files below ``path``, those already there included."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", LONGEST_FILE_AGE)
        .load(path)
        .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"))
    )


def current_checkpoint(spark: SparkSession, lake: Lake, table: str) -> tuple[str, int]:
    """Checkpoint in force and how often the table was started over.

    The checkpoints themselves tell: each start has a folder of its own next to the others.
    """
    first, starts = lake.checkpoint(table), 0
    while path_exists(spark, f"{first}-{starts + 1}"):
        starts += 1
    return (f"{first}-{starts}" if starts else first), starts


def start_over(
    spark: SparkSession, lake: Lake, contract: Contract, properties: dict[str, str] | None = None
) -> None:
    """Empty a bronze table and give it a stream that has seen no file.

    The rows go first. Should this die before the new stream exists, the old one still knows
    every file, so nothing is read twice, and starting over again completes it.
    """
    ensure_table(spark, lake, bronze_spec(lake, contract, properties))
    table = bronze_table(lake, contract)
    spec = bronze_spec(lake, contract, properties)
    _, starts = current_checkpoint(spark, lake, table)
    empty = T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema.fields])
    publish(spark, lake, spec, spark.createDataFrame([], empty))
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    # The marker brings the folder of the new checkpoint into being.
    spark.range(1).coalesce(1).write.parquet(f"{lake.checkpoint(table)}-{starts + 1}/started")


def store_batch(session: SparkSession, lake: Lake, contract: Contract, files: DataFrame, number: int) -> None:
    """Write the rows of ``files`` (manifest rows) as one batch; the session overwrites only partitions that receive rows."""
    groups = schema_groups(session, files)
    if groups:
        table = bronze_table(lake, contract)
        rows = bronze_rows(session, groups, contract).withColumn(BATCH_COLUMN, F.lit(number).cast("long"))
        rows.select(*session.table(table).columns).write.mode("overwrite").insertInto(table)


def file_ledger(spark: SparkSession, lake: Lake, contract: Contract, files: DataFrame) -> DataFrame:
    """``files`` (manifest rows) with the rows that bronze holds of each, and whether that is all.

    Only partitions of months that occur among the files are read, and of them one column.
    """
    months = [row["reference_month"] for row in files.select("reference_month").distinct().collect()]
    month = F.col("_reference_month")
    of_months = month.isin([m for m in months if m]) | (month.isNull() | (month == "") if "" in months else F.lit(False))
    path = manifest.comparable_path(F.col("_source_file")).alias("path_key")
    stored = spark.table(bronze_table(lake, contract)).filter(of_months).groupBy(path).agg(F.count(F.lit(1)).alias("stored_rows"))
    joined = files.withColumn("path_key", manifest.comparable_path(F.col("path"))).join(stored, "path_key", "left")
    rows = F.coalesce("stored_rows", F.lit(0))
    state = (
        F.when(rows == F.col("footer_rows"), "COMPLETE").when(rows == 0, "MISSING").when(rows < F.col("footer_rows"), "SHORT").otherwise("EXCESS")
    )
    return joined.withColumn("stored_rows", rows).withColumn("state", state)


def reconcile(spark: SparkSession, lake: Lake, contract: Contract) -> int:
    """Have bronze hold each landing file exactly once; returns how many files were read again.

    Files counted complete are confirmed in the manifest and not counted any more. A run that dies in between is
    mended by the next one: rows stored twice are as wrong as rows that lack.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.caseSensitive", "true")
    open_files = manifest.unconfirmed_files(session, lake, contract.dataset)
    ledger = _kept(session, file_ledger(session, lake, contract, open_files), "ledger")
    wrong = ledger.filter(F.col("state") != "COMPLETE")
    count = wrong.count()
    if count:
        with dynamic_overwrite(session):
            _take_out(session, lake, contract, wrong.filter(F.col("state") != "MISSING"))
            numbers = [int(p[BATCH_COLUMN]) for p in partition_values(session, bronze_table(lake, contract))]
            number = max(numbers, default=0) + 1
            if number % BATCH_STEP == 0:
                raise RuntimeError(f"{BATCH_STEP - 1} batches of files read again since the last new file: start over")
            store_batch(session, lake, contract, wrong, number)
        spark.catalog.refreshTable(bronze_table(lake, contract))
        ledger = file_ledger(session, lake, contract, ledger.drop("path_key", "stored_rows", "state"))
    manifest.confirm(lake, contract.dataset, ledger.filter(F.col("state") == "COMPLETE"))
    return count


def _kept(spark: SparkSession, frame: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _take_out(spark: SparkSession, lake: Lake, contract: Contract, files: DataFrame) -> None:
    """Remove the rows of ``files`` from bronze, partition by partition."""
    table = bronze_table(lake, contract)
    stored = spark.table(table).withColumn("path_key", manifest.comparable_path(F.col("_source_file")))
    keys = files.select("path_key")
    touched = stored.join(keys, "path_key", "left_semi").select(*BRONZE_PARTITIONS).distinct()
    partitions = touched.collect()  # months times batches of the files taken out
    if not partitions:
        return
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in BRONZE_PARTITIONS]
    rest = stored.alias("r").join(touched.alias("t"), same, "left_semi").join(keys, "path_key", "left_anti")
    rest = _kept(spark, rest.select(*spark.table(table).columns), "rest")
    filled = {tuple(row) for row in rest.select(*BRONZE_PARTITIONS).distinct().collect()}
    rest.write.mode("overwrite").insertInto(table)
    emptied = {tuple(row) for row in partitions} - filled
    rest.drop(*BRONZE_PARTITIONS).limit(0).createOrReplaceTempView("no_rows_of_bronze")
    for month, batch in emptied:
        value = "NULL" if month is None else sql_text(month)
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (_reference_month = {value}, {BATCH_COLUMN} = {batch}) "
            "SELECT * FROM no_rows_of_bronze"
        )
    spark.catalog.dropTempView("no_rows_of_bronze")


def start_ingest(
    spark: SparkSession,
    lake: Lake,
    contract: Contract,
    properties: dict[str, str] | None = None,
    max_files: int = MAX_FILES_PER_BATCH,
) -> StreamingQuery:
    """Start bringing the bronze table of one service up to date."""
    table = bronze_table(lake, contract)
    ensure_table(spark, lake, bronze_spec(lake, contract, properties))

    def store(batch: DataFrame, batch_id: int) -> None:
        # The batch runs in a session of its own, so these settings stay local to it:
        # exact spelling of physical names, and overwriting only this batch's partitions.
        session = batch.sparkSession
        session.conf.set("spark.sql.caseSensitive", "true")
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # A file without bytes yields no row; it is read again once it has some.
        files = manifest.described(session, lake, contract.dataset, batch.filter(F.col("size_bytes") > 0))
        store_batch(session, lake, contract, files, batch_id * BATCH_STEP)

    return (
        file_stream(spark, f"{lake.landing_path}/{contract.dataset}", max_files)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", current_checkpoint(spark, lake, table)[0])
        .trigger(availableNow=True)
        .queryName(f"ingest_{contract.dataset}")
        .start()
    )


def ingest_services(
    spark: SparkSession,
    lake: Lake,
    contracts: list[Contract],
    properties: dict[str, dict[str, str]] | None = None,
    max_files: int = MAX_FILES_PER_BATCH,
) -> dict[str, str]:
    """Bring the bronze tables of several services up to date, side by side.

    Returns the table name of each dataset.
    """
    properties = properties or {}
    running = {
        contract.dataset: start_ingest(spark, lake, contract, properties.get(contract.dataset), max_files)
        for contract in contracts
    }
    try:
        for query in running.values():
            query.awaitTermination()
    finally:
        for query in running.values():
            query.stop()
    for contract in contracts:
        spark.catalog.refreshTable(bronze_table(lake, contract))
        reconcile(spark, lake, contract)
    tables = {contract.dataset: bronze_table(lake, contract) for contract in contracts}
    for dataset, table in tables.items():
        spark.catalog.refreshTable(table)
        # Tells refreshes of derived tables whose batch numbers they look at.
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{STREAM_PROPERTY}' = '{running[dataset].id}')")
    return tables
