"""Monthly refresh of row-wise derived tables.

Silver and the consumption table map bronze rows one to one and keep the month partition.
So a month can only change when bronze received a batch for it, and rewriting the touched
months gives the same table as rewriting all of them. A table remembers, in its
properties, up to which bronze batch it was built and from what definition; without that
memory, or when the definition changed, everything is rebuilt.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from meterlake.functions.columns import sql_text
from meterlake.sources.tables import (
    Lake,
    TableSpec,
    ensure_table,
    partition_values,
    publish,
    publish_months,
    table_properties,
)
from meterlake.streaming.ingest import BATCH_COLUMN, STREAM_PROPERTY

MONTH = "_reference_month"
DEFINITION = "meterlake.definition"
THROUGH = "meterlake.through_batch"


def latest_batches(spark: SparkSession, bronze: str) -> dict[str, int]:
    """Latest batch that brought rows of a month."""
    latest: dict[str, int] = {}
    for partition in partition_values(spark, bronze):
        month, batch = partition[MONTH], int(partition[BATCH_COLUMN])
        latest[month] = max(batch, latest.get(month, -1))
    return latest


def refresh_months(
    spark: SparkSession,
    lake: Lake,
    spec: TableSpec,
    frame: DataFrame,
    bronze: str,
    window: str,
    upstream: str | None = None,
) -> list[str] | None:
    """Bring ``spec`` up to date with ``bronze``; returns the months rewritten, or None for all.

    The batches are looked up before any row is read: a batch that arrives meanwhile is
    at worst processed again by the next refresh. With ``upstream``, the table between
    bronze and this one, nothing counts as seen that the table in between has not seen.
    """
    ensure_table(spark, lake, spec)
    latest = latest_batches(spark, bronze)
    source = table_properties(spark, upstream or bronze)
    origin = source.get(DEFINITION if upstream else STREAM_PROPERTY)
    reached = int(source.get(THROUGH, -1)) if upstream else max(latest.values(), default=-1)
    schema = hashlib.sha256(spec.schema.json().encode()).hexdigest()
    definition = f"{origin} {window} {schema}"
    known = table_properties(spark, spec.name)
    months: list[str] | None = None
    if origin and known.get(DEFINITION) == definition:
        through = int(known[THROUGH])
        months = sorted(month for month, batch in latest.items() if batch > through)
        publish_months(spark, lake, spec, frame, MONTH, months)
    else:
        # A rebuild that dies half way must not be taken for the state remembered before.
        spark.sql(f"ALTER TABLE {spec.name} UNSET TBLPROPERTIES IF EXISTS ('{DEFINITION}', '{THROUGH}')")
        publish(spark, lake, spec, frame)
    spark.sql(
        f"ALTER TABLE {spec.name} SET TBLPROPERTIES "
        f"({sql_text(DEFINITION)} = {sql_text(definition)}, {sql_text(THROUGH)} = '{reached}')"
    )
    return months
