"""Landing files: inventory, footers, integrity, gaps, and drift-proof reading.

Monthly files change physical types and capitalisation over the years, and one
Parquet read cannot bridge that (a double does not narrow to a bigint). Files are
therefore grouped by the schema in their footer: a plan branches once per distinct
schema, not once per file.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.contracts import union_all
from meterlake.functions.months import month_of_name, month_sequence

# When a late month is tolerated and how short a Parquet file can be.
FIXED_TOLERATED_MONTHS = 2
FIXED_MINIMUM_BYTES = 8

FILE_LISTING_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
FOOTER_COLUMNS = (
    "path string, size_bytes long, magic_at_head boolean, magic_at_tail boolean, "
    "footer_rows long, fields array<struct<name:string,type:string>>"
)


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file below ``root`` that holds any byte; empty files are not listed.

    File contents are never selected, so never read.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"))
    )


def empty_files(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files below ``root`` without a single byte, which Spark leaves out of a listing."""

    open_filesystem = filesystem_opener()

    def walk(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for folder in batch.column("root").to_pylist():
                filesystem, inner = open_filesystem(folder)
                selector = fs.FileSelector(inner, recursive=True, allow_not_found=True)
                found = [
                    folder.rstrip("/") + info.path[len(inner.rstrip("/")) :]
                    for info in filesystem.get_file_info(selector)
                    if info.is_file and info.size == 0 and info.extension == "parquet"
                ]
                yield pa.record_batch(
                    [pa.array(found, pa.string()), pa.array([0] * len(found), pa.int64())], ["path", "size_bytes"]
                )

    return spark.createDataFrame([(root,)], "root string").mapInArrow(walk, "path string, size_bytes long")


def filesystem_opener():
    """A function from a path to Arrow's file system and the path within it.

    It is made anew here so that it travels to the tasks by value; they need not import this package.
    """

    def open_filesystem(path: str):
        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        # Hadoop spells the object store scheme differently.
        return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)

    return open_filesystem


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def service_of_name(name: Column) -> Column:
    """Service prefix of a trip file name, or an empty string."""
    return F.regexp_extract(name, r"^([A-Za-z]+)_tripdata_", 1)


def with_identity(files: DataFrame) -> DataFrame:
    name = file_name(F.col("path"))
    return files.select(
        "*",
        name.alias("file_name"),
        service_of_name(name).alias("service"),
        month_of_name(name).alias("reference_month"),
    )


def read_footers(files: DataFrame) -> DataFrame:
    """Magic bytes, row count and field list of each file.

    Tasks open the files themselves and read the first four bytes and the footer, so
    the work is the same for a 1 MB and a 100 GB file. Spark's own binary source would
    load whole contents.
    """
    open_filesystem = filesystem_opener()

    def probe(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        def open_file(path: str):
            filesystem, inner = open_filesystem(path)
            return filesystem.open_input_file(inner)

        def describe(path: str, size: int) -> dict:
            row = {
                "path": path,
                "size_bytes": size,
                "magic_at_head": False,
                "magic_at_tail": False,
                "footer_rows": None,
                "fields": None,
            }
            if size < 8:
                return row
            with open_file(path) as source:
                row["magic_at_head"] = source.read(4) == b"PAR1"
                source.seek(size - 4)
                row["magic_at_tail"] = source.read(4) == b"PAR1"
                if not (row["magic_at_head"] and row["magic_at_tail"]):
                    return row
                source.seek(0)
                try:
                    footer = pq.ParquetFile(source)
                except pa.ArrowInvalid:
                    return row
                row["footer_rows"] = footer.metadata.num_rows
                row["fields"] = [{"name": f.name, "type": str(f.type)} for f in footer.schema_arrow]
            return row

        field = pa.struct([("name", pa.string()), ("type", pa.string())])
        schema = pa.schema(
            [
                ("path", pa.string()),
                ("size_bytes", pa.int64()),
                ("magic_at_head", pa.bool_()),
                ("magic_at_tail", pa.bool_()),
                ("footer_rows", pa.int64()),
                ("fields", pa.list_(field)),
            ]
        )
        for batch in batches:
            rows = [describe(f["path"], f["size_bytes"]) for f in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("path", "size_bytes").mapInArrow(probe, FOOTER_COLUMNS)


def landing_integrity(footers: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A verdict per file, with the columns ``keep``: empty, too short, wrong magic bytes, unreadable footer, nameless month, or intact."""
    named = with_identity(footers)
    status = (
        F.when(F.col("size_bytes") == 0, "EMPTY")
        .when(F.col("size_bytes") < FIXED_MINIMUM_BYTES, "TOO_SHORT")
        .when(~F.col("magic_at_head") | ~F.col("magic_at_tail"), "NOT_PARQUET")
        .when(F.col("fields").isNull(), "UNREADABLE_FOOTER")
        .when(F.col("reference_month") == "", "NO_MONTH")
        .otherwise("INTACT")
    )
    return named.select(
        "path", "file_name", "service", "reference_month", "size_bytes", "footer_rows", status.alias("status"), *keep
    )


def landing_gaps(
    present: DataFrame,
    services: list[str],
    start_month: str,
    end_month: str,
    tolerated: int = FIXED_TOLERATED_MONTHS,
) -> DataFrame:
    """Months of the window that have no file, per service.

    ``present`` needs ``service`` and ``reference_month``. A missing month is tolerated
    only at the recent end of the window, where publication may simply be late.
    """
    months = month_sequence(start_month, end_month)
    spark = present.sparkSession
    first, last = (F.lit(f"{m}-01").cast("date") for m in (months[0], months[-1]))
    expected = (
        spark.createDataFrame([(s,) for s in services], "service string")
        .select("service", F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month_start"))
        .select("service", F.date_format("month_start", "yyyy-MM").alias("reference_month"), "month_start")
    )
    # Few rows remain after the distinct, however many files or rows lie behind it.
    seen = present.select("service", "reference_month").distinct()
    behind = F.months_between(last, F.col("month_start")).cast("int")
    return expected.join(seen, ["service", "reference_month"], "left_anti").select(
        "service",
        "reference_month",
        behind.between(0, tolerated - 1).alias("tolerated"),
    )


@dataclass(frozen=True)
class SchemaGroup:
    """Files that share one physical schema: patterns of whole folders, and single files of others."""

    schema: T.StructType
    paths: tuple[str, ...]

    @property
    def physical(self) -> dict[str, tuple[str, T.DataType]]:
        """Lower-cased name to the spelling and type in the files; the last spelling wins."""
        return {f.name.lower(): (f.name, f.dataType) for f in self.schema.fields}

    def read(self, spark: SparkSession) -> DataFrame:
        """The files as one frame. A session that ignores case sees one spelling per name, the last."""
        if spark.conf.get("spark.sql.caseSensitive") == "true":
            schema = self.schema
        else:
            kept = {spelling for spelling, _ in self.physical.values()}
            schema = T.StructType([f for f in self.schema.fields if f.name in kept])
        return spark.read.schema(schema).parquet(*self.paths)


class UnreadableFiles(RuntimeError):
    """Landing files whose footers cannot be read."""


def fingerprint() -> Column:
    """A digest of ``fields`` that the order of columns does not change; null for an unreadable file."""
    return F.sha2(F.to_json(F.array_sort("fields")), 256)


def folder_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def group_places(footers: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """fingerprint, one file as example, and the places to read: one row per schema and folder.

    With ``listing``, all files of these folders, a folder whose every file has the same schema and is wanted is a
    single pattern. So what leaves the tasks grows with folders, not with files.
    """
    wanted = footers.select("path", folder_of(F.col("path")).alias("folder"), fingerprint().alias("fingerprint"))
    each = wanted.groupBy("fingerprint", "folder").agg(
        F.count(F.lit(1)).alias("files"), F.min("path").alias("example"), F.sort_array(F.collect_list("path")).alias("paths")
    )
    if listing is None:
        return each.select("fingerprint", "example", F.col("paths").alias("places"))
    there = listing.groupBy(folder_of(F.col("path")).alias("folder")).agg(F.count(F.lit(1)).alias("present"))
    pattern = F.array(F.concat("folder", F.lit("/*.parquet")))
    places = F.when(F.col("files") == F.col("present"), pattern).otherwise(F.col("paths"))
    return each.join(there, "folder", "left").select("fingerprint", "example", places.alias("places"))


def schema_groups(spark: SparkSession, footers: DataFrame, listing: DataFrame | None = None) -> list[SchemaGroup]:
    """The files of ``footers`` (path and fields) by physical schema.

    A streaming batch names its files one by one, as many as ``maxFilesPerTrigger`` lets in; a read of whole
    folders gives their ``listing``. A file that is not readable Parquet is an error: leaving it out would lose its month unnoticed.
    """
    unreadable = footers.filter(F.col("fields").isNull())
    shown = [row["path"] for row in unreadable.select("path").orderBy("path").take(5)]
    if shown:
        raise UnreadableFiles(f"{unreadable.count()} landing file(s) are not readable Parquet, among them {', '.join(shown)}")
    examples: dict[str, str] = {}
    places: dict[str, list[str]] = {}
    for row in group_places(footers, listing).collect():
        examples[row["fingerprint"]] = min(row["example"], examples.get(row["fingerprint"], row["example"]))
        places.setdefault(row["fingerprint"], []).extend(row["places"])
    # Names that differ in case only are two columns here, whatever the session makes of them.
    exact = spark.newSession()
    exact.conf.set("spark.sql.caseSensitive", "true")
    return [
        SchemaGroup(exact.read.parquet(examples[key]).schema, tuple(sorted(paths))) for key, paths in sorted(places.items())
    ]


def landing_canonical(
    spark: SparkSession,
    root: str,
    service: str,
    start_month: str,
    end_month: str,
    project,
    manifest: DataFrame | None = None,
    months: list[str] | None = None,
) -> DataFrame:
    """Landing files of a month window in one shape, month taken from the file name.

    ``project`` maps a physical frame to the wanted columns; ``reference_month`` is added. With
    ``manifest``, the manifest rows of the service's files, no footer is read here. ``months`` narrows the window further.
    """
    files = list_files(spark, f"{root}/{service}") if manifest is None else manifest
    window = F.col("reference_month").between(start_month, end_month)
    if months is not None:
        window &= F.col("reference_month").isin(months)
    if manifest is None:
        described = read_footers(with_identity(files).filter(window))
    else:
        described = manifest.filter(window)
    groups = schema_groups(spark, described, files)
    if not groups:
        raise FileNotFoundError(f"no {service} file between {start_month} and {end_month} below {root}")
    return union_all(
        [
            project(
                group.read(spark).withColumn(
                    "reference_month", month_of_name(F.col("_metadata.file_name"))
                )
            )
            for group in groups
        ]
    )
