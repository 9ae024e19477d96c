"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once with that speaker as assistant and
the others as named users; only the assistant's segments are trained on. The result is one row per segment, with its
place in the rendering, so a conversation of any length never has to fit one row or one task; joining a
rendering's segments in order gives its text.

Order: turn (null last), role, text, equal rows in any order. The role ``system`` is no participant and stays system.
Defined results: a null role is the speaker ``unknown``; a null text is empty; a null conv_id is a conversation of its
own; a conversation without participants has no rendering; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import shuffle_partitions, stored

SYSTEM = "system"
UNKNOWN = "unknown"
HEADER, FOOTER = "<|im_start|>", "<|im_end|>\n"


def running_sums(spark: SparkSession, rows: DataFrame, group: list[str], order: list[str], **values: str) -> DataFrame:
    """``rows`` with, for each name in ``values``, the sum of that column over the rows before in the group.

    Rows are range-partitioned by group and order, so a large group spreads over partitions; sums of whole partitions
    give each partition its offset, and windows run within a partition only.
    """
    ranged = rows.repartitionByRange(shuffle_partitions(spark), *group, *order).withColumn("__part", F.spark_partition_id())
    ranged = stored(spark, ranged, "ranges")
    per_part = ranged.groupBy("__part", *group).agg(*[F.sum(v).alias(f"__{n}") for n, v in values.items()])
    parts = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("__part", *group, *[F.coalesce(F.sum(f"__{n}").over(parts), F.lit(0)).alias(f"__{n}") for n in values])
    same = F.col("r.__part") == F.col("o.__part")
    for g in group:
        same = same & F.col(f"r.{g}").eqNullSafe(F.col(f"o.{g}"))
    joined = ranged.alias("r").join(offsets.alias("o"), same).select("r.*", *[f"o.__{n}" for n in values])
    inside = Window.partitionBy("__part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = [(F.col(f"__{n}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(n) for n, v in values.items()]
    return joined.select(*rows.columns, *out)


def rendered(speaker: Column, perspective: Column, text: Column) -> tuple[Column, Column]:
    """The role and the whole segment."""
    role = F.when(speaker == SYSTEM, SYSTEM).when(speaker == perspective, "assistant").otherwise("user")
    name = F.when(role == "user", F.concat(F.lit(" name="), speaker)).otherwise("")
    return role, F.concat(F.lit(HEADER), role, name, F.lit("\n"), text, F.lit(FOOTER))


def rotations(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """conv_id, perspective, position, turn, speaker, role, segment, start, end and trained of every segment."""
    rows = conversations.select(
        F.monotonically_increasing_id().alias("row"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = stored(spark, rows, "turns")
    participants = rows.where(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    each = rows.alias("t").join(participants.alias("p"), F.col("t.conv_id").eqNullSafe(F.col("p.conv_id"))).select("t.*", "perspective")
    role, segment = rendered(F.col("speaker"), F.col("perspective"), F.col("text"))
    each = each.withColumn("role", role).withColumn("segment", segment)
    each = each.withColumn("length", F.char_length("segment").cast("long")).withColumn("one", F.lit(1).cast("long"))
    each = each.withColumn("late", F.col("turn").isNull())
    order = ["late", "turn", "speaker", "text", "row"]
    placed = running_sums(spark, each, ["conv_id", "perspective"], order, position="one", start="length")
    return placed.select(
        "conv_id", "perspective", "position", "turn", "speaker", "role", "segment", "start",
        (F.col("start") + F.col("length")).alias("end"), (F.col("role") == "assistant").alias("trained"),
    )
