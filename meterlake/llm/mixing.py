"""Mixing sources to target weights.

Documents of a source are ordered by a hash of their id. Ranges of the hash are the buckets of a
range sort; sums of words per bucket give prefix sums, which say in which bucket the budget of a
source ends. Only that bucket is sorted row by row to find the exact cut. The plan of the mix is
therefore one row per source, and applying it moves no text.

Defined results: a null source is a source of its own, the last; a null text has no words; a null
doc_id is ordered first. Rows with the same doc_id and size at the cut share the words left there,
rounded down. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import WORD, shuffle_partitions, stored, whole_text

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = 20240607
BUCKETS_PER_PARTITION = 4
_LOWEST = -(2**63)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def order_key() -> Column:
    """63 hash bits of the id; a smaller key comes earlier in the mix."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("doc_id")), 1)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and key of every row."""
    return docs.select("doc_id", "source", word_count(whole_text()).alias("size"), order_key().alias("key"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size and target of every source.

    Targets are ``least(most * size, level * weight)``. Sources in order of size by weight fill
    up one after the other; the level is what is left, by weight, at the first that does not.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1)
    every = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = Window.orderBy("ratio", "place")
    sources = (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(every) - 1)
        .withColumn("weight", weight)
        .withColumn("ratio", most * F.col("source_size") / F.col("weight"))
    )
    levels = (
        sources.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("full", F.coalesce(F.sum(most * F.col("source_size")).over(ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
        .withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "place", "level"))).over(Window.partitionBy())["level"])
    )
    filled = F.when(F.col("ratio") < F.col("level"), (most * F.col("source_size")).cast("double"))
    return levels.select("source", "source_size", F.coalesce(filled, F.col("level") * F.col("weight")).alias("target"))


def mix_plan(spark: SparkSession, rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Per source: target, whole passes, and the key, id and size at which the last pass ends."""
    goal = stored(spark, targets(rows, weights, most), "mix-targets")
    budget = F.round("target").cast("long")
    passes = (
        goal.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", budget - F.col("passes") * F.col("source_size"))
    )
    n = BUCKETS_PER_PARTITION * shuffle_partitions(spark)
    bucket = F.floor(F.col("key") / F.lit(2.0**63 / n)).cast("long")
    keyed = rows.withColumn("bucket", bucket)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(before))
    ends = (
        sums.alias("b")
        .join(passes.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
        .where("rest > upto - words AND rest <= upto")
        .select("p.source", "bucket", (F.col("rest") - F.col("upto") + F.col("words")).alias("words_left"))
    )
    inside = (
        keyed.alias("r")
        .join(ends.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.bucket") == F.col("e.bucket")))
        .select("e.source", "key", F.coalesce("doc_id", F.lit(_LOWEST)).alias("id"), "size", "words_left")
        .groupBy("source", "key", "id", "size", "words_left")
        .agg(F.count("*").alias("copies"))
    )
    order = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        inside.withColumn("upto", F.sum(F.col("size") * F.col("copies")).over(order))
        .where("words_left > upto - size * copies AND words_left <= upto")
        .select(
            F.col("source").alias("cut_source"),
            F.struct("key", "id", "size").alias("cut"),
            F.expr("(words_left - upto + size * copies) DIV copies").alias("cut_words"),
        )
    )
    plan = passes.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    plan = plan.select(F.col("source").alias("plan_source"), "source_size", "target", "passes", "cut", "cut_words")
    return stored(spark, plan, "mix-plan")


def apply_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, size, key and others) with source_size, target, passes and last_words."""
    here = F.struct("key", F.coalesce("doc_id", F.lit(_LOWEST)).alias("id"), "size")
    last = F.when(F.col("cut").isNull() | (here > F.col("cut")), 0).when(here < F.col("cut"), F.col("size"))
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    return joined.withColumn("last_words", last.otherwise(F.col("cut_words")).cast("long")).drop("plan_source", "cut", "cut_words")


def mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row."""
    rows = stored(spark, sized(docs), "mix-sizes")
    out = apply_plan(rows, mix_plan(spark, rows))
    taken = F.col("passes") * F.col("size") + F.col("last_words")
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken.

    The document at a source's cut ends after the words left there; its ``n_chars``, if there is such a column, follows.
    """
    plan = mix_plan(spark, stored(spark, sized(docs), "mix-sizes"))
    names = docs.columns
    rows = docs.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), "doc_id", "source", "text")
    rows = rows.withColumn("size", word_count(whole_text())).withColumn("key", order_key())
    turns = F.filter(
        F.array_append(F.array_repeat(F.col("size"), F.col("passes").cast("int")), F.col("last_words")), lambda w: w > 0
    )
    out = apply_plan(rows, plan).select("row", "text", "size", F.explode(turns).alias("words"))
    head = F.expr(r"regexp_extract(text, concat('^(?:[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++){', words, '}+'), 0)")
    cut = F.col("words") < F.col("size")
    out = out.withColumn("text", F.when(cut, head).otherwise(F.col("text")))
    changed = {"text": F.col("text")}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(cut, F.char_length("text").cast(kind)).otherwise(F.col("row")["n_chars"])
    return out.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in names])
