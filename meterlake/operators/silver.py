"""Silver: typed, renamed, bounded by reference month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.contracts import ZONE_DATASET, Contract
from meterlake.functions.columns import snake_case


def silver_trips(bronze: DataFrame, contract: Contract, start_month: str, end_month: str) -> DataFrame:
    """The window filters the stored month column, so it prunes bronze partitions.

    What a column inherits (comment, source column, table) belongs to the stored schema,
    ``Contract.silver_schema``.
    """
    if contract.dataset != ZONE_DATASET:
        bronze = bronze.filter(F.col("_reference_month").between(start_month, end_month))
    return bronze.selectExpr(
        *[
            f"CAST(`{c.name}` AS {c.data_type.simpleString()}) AS `{snake_case(c.name)}`"
            for c in contract.silver_columns()
        ]
    )
