"""Secret scans with an incremental ledger of blobs.

A blob is a text, addressed by its SHA-256. The ledger keeps, per version of the rules (its partition) and blob,
where something was found: kind, place and a digest, never the secret itself. A run scans a blob only if the ledger lacks that pair; then every path that ever held the blob
gets the findings by a join. All of it is built-in functions.

Defined results: a null text is the empty blob; rows repeated under one path give a row each; a null path is
kept as null; an empty table gives no rows and leaves the ledger as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import stored, whole_text
from meterlake.llm.spans import found, labelled, listing, located
from meterlake.session import scratch_dir

RULES_VERSION = "1"

# The rules, as (kind, pattern, condition on a match s, cheap test of the text).
BASE_RULES = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""",
        r"""char_length(regexp_extract(s.hit, '[:=]\\x20*+["\']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 8""",
        "text rlike '[:=]'",
    ),
    ("access", r"AKIA[A-Z0-9]+", "char_length(s.hit) >= 16", "contains(text, 'AKIA')"),
    ("hex", r"[0-9a-f]{32,}+", "true", "true"),
]
ADDED_RULES = [
    ("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "true", "contains(text, 'PRIVATE KEY-----')"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", "true", "contains(text, '.eyJ')"),
    ("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}+", "true", "contains(text, 'gh')"),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}+", "true", "contains(text, 'xox')"),
]


def findings(blobs: DataFrame) -> DataFrame:
    """blob and the spans (start, rank, end, kind, digest of what was found) in its text, by start, then rule."""
    rules = [*BASE_RULES, *ADDED_RULES]
    out = blobs.select("blob", "text", *[found("text", regex, quick).alias(f"hits_{kind}") for kind, regex, _, quick in rules])
    out = out.select("blob", *[located("text", f"hits_{kind}", regex).alias(kind) for kind, regex, _, _ in rules])
    every = ", ".join(labelled(kind, i, kind, keep) for i, (kind, _, keep, _) in enumerate(rules))
    spans = f"array_sort(transform(concat({every}), s -> struct(s.start, s.rank, s.end, s.kind, sha2(s.hit, 256) AS digest)))"
    return out.select("blob", F.expr(spans).alias("spans"))


def scan(
    spark: SparkSession, versions: DataFrame, ledger: str, rules_version: str = RULES_VERSION
) -> DataFrame:
    """path, blob and spans of every row of ``versions`` (path, text), by way of the ledger stored in ``ledger``."""
    texts = versions.select("path", whole_text().alias("text")).withColumn("blob", F.sha2("text", 256))
    paths = stored(spark, texts.select("path", "blob"), "blob-paths")
    wanted = paths.groupBy("blob").agg(F.min("path").alias("first_path"))
    schema = "blob string, spans array<struct<start:bigint,rank:int,end:bigint,kind:string,digest:string>>, rules string"

    def known() -> DataFrame:
        return spark.read.schema(schema).parquet(ledger).where(F.col("rules") == rules_version)

    spark.createDataFrame([], schema).write.mode("append").partitionBy("rules").parquet(ledger)
    unseen = wanted.join(known().select("blob"), "blob", "left_anti").withColumnRenamed("blob", "new_blob")
    same = (F.col("blob") == F.col("new_blob")) & F.col("path").eqNullSafe(F.col("first_path"))
    fresh = findings(texts.join(unseen, same, "left_semi")).dropDuplicates(["blob"])
    fresh.withColumn("rules", F.lit(rules_version)).write.mode("append").partitionBy("rules").parquet(ledger)
    return paths.join(known().dropDuplicates(["blob"]).select("blob", "spans"), "blob")


def secret_spans(spark: SparkSession, docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans and all spans; a ledger of its own by default."""
    ledger = ledger or scratch_dir(spark, "llm-ledger")
    rows = scan(spark, docs.select(F.col("doc_id").alias("path"), "text"), ledger)
    rows = rows.withColumn("base", F.expr(f"filter(spans, s -> s.rank < {len(BASE_RULES)})"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k, *_ in BASE_RULES]
    return rows.select(
        F.col("path").alias("doc_id"),
        *counts,
        F.sha2(F.expr(listing("base")), 256).alias("base_sha256"),
        F.expr(listing("spans")).alias("spans"),
    )
