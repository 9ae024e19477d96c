"""Personal data: fixed base patterns, and spans that a boosted model of candidates adds.

High-recall generators propose overlapping spans. Each candidate gets numbers for its format and
its surroundings. A candidate counts as right if it is a base span, or if its normal form or its surroundings say so
(``EVIDENCE``). All candidates of all documents are counted by their numbers, so that what is learnt from is one weighted row for each
distinct set of numbers. Boosted trees are trained on all of it. For the thresholds the texts are dealt into two halves, each scored by trees trained on the other. The
trees become one SQL expression, so scoring is built-in functions on each row without a shuffle. A candidate enters the
result if it passes its kind's threshold and overlaps no base span of that kind; of overlapping ones the
earliest, then longest, stays.

Defined results: a null text counts as empty; rows with a null doc_id or repeated give a row each and are learnt from; a half
is scored if the other one has right and wrong candidates, and if neither is, nothing is added; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import stored, whole_text
from meterlake.llm.spans import found, labelled, listing, located, luhn, quoted

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, BINS = 8, 3, 16
#: A threshold is the lowest at which this share of the accepted calibration candidates is right.
PRECISION = 0.9
#: Code points before a candidate in which words of context are looked for.
CONTEXT = 32

_DIGITS = "regexp_replace(s.hit, '[^0-9]', '')"
# Base patterns, as (kind, pattern, condition on a match s, cheap test of the text).
# A match can only begin where a run begins or the previous match ended; saying so keeps long runs linear.
BASE = [
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", "contains(text, '@')"),
    (
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "forall(split(s.hit, '[.]'), p -> char_length(ltrim('0', p)) <= 3 AND CAST(right(concat('000', p), 3) AS int) <= 255)",
        "text rlike '[0-9][.][0-9]'",
    ),
    (
        "card",
        r"[0-9]++(?:[\x20-][0-9]++)*+",
        f"(char_length({_DIGITS}) BETWEEN 16 AND 19) AND {luhn(_DIGITS)}",
        r"text rlike '[0-9](?:[\\x20-]?[0-9]){15}'",
    ),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"char_length({_DIGITS}) BETWEEN 8 AND 15", "contains(text, '+')"),
]
# Generators: (kind, pattern, cheap test of the text).
GENERATORS = [
    ("email", r"(?:\G|(?<![\w.%+-]))[\w.%+-]{1,64}+\x20?(?:@|\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}+){1,8}", "contains(text, '@') OR contains(text, 'at')"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])", "text rlike '[0-9][.][0-9]'"),
    ("card", r"(?<![0-9])(?:[0-9]{13,19}+|[0-9]{4}(?:[\x20.-][0-9]{4}){3}|[0-9]{4}[\x20.-][0-9]{6}[\x20.-][0-9]{5})(?![0-9])", "text rlike '[0-9]{4}'"),
    ("phone", r"(?<![0-9+])(?:\+|00)?[0-9]{0,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])", "text rlike '[0-9][\\\\x20.-][0-9]{3}'"),
]
_FEATURES = [
    *[f"CAST(c.kind = '{k}' AS double)" for k in KINDS],
    "CAST(char_length(c.hit) AS double)",
    "CAST(char_length(c.digits) AS double)",
    "CAST(char_length(regexp_replace(c.hit, '[^.]', '')) AS double)",
    "CAST(char_length(regexp_replace(c.hit, '[0-9A-Za-z]', '')) AS double)",
    "CAST(startswith(c.hit, '+') AS double)",
    "CAST(contains(c.hit, '@') AS double)",
    f"CASE WHEN char_length(c.digits) BETWEEN 12 AND 19 AND {luhn('c.digits')} THEN 1D ELSE 0D END",
    "CASE WHEN c.kind = 'ip' AND forall(split(c.hit, '[.]'), p -> CAST(p AS int) <= 255) THEN 1D ELSE 0D END",
    "CAST(char_length(regexp_extract(c.hit, '[A-Za-z]*$', 0)) AS double)",
    "CAST(c.before rlike '[A-Za-z0-9]$' AS double)",
    "CAST(c.after rlike '^[A-Za-z0-9]' AS double)",
    "CAST(lower(c.before) rlike 'mail|contact' AS double)",
    "CAST(lower(c.before) rlike 'tel|phone|call|fax|mobil' AS double)",
    "CAST(lower(c.before) rlike 'card|visa|konto|iban|pay' AS double)",
    "CAST(lower(c.before) rlike 'host|server|addr|version|v[0-9. ]*$' AS double)",
]
#: What makes a candidate right that the base patterns do not decide: its normal form by the base rule, with words of its context where digits alone say little.
_NORMAL = r"regexp_replace(regexp_replace(c.hit, '\\x20?(?:@|\\[at\\]|\\(at\\)|\\x20at\\x20)\\x20?', '@'), '\\x20?(?:\\[dot\\]|\\(dot\\)|\\x20dot\\x20)\\x20?', '.')"
_WHOLE_EMAIL = r"rlike '^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+$'"
_SIGN = quoted(r"@|\[at\]|\(at\)")
EVIDENCE = (
    f"CASE c.kind WHEN 'email' THEN {_NORMAL} {_WHOLE_EMAIL} AND (c.hit rlike {_SIGN} OR lower(c.before) rlike 'mail|contact') "
    "WHEN 'ip' THEN c.f[11] = 1 AND c.f[18] = 0 "
    "WHEN 'card' THEN c.f[10] = 1 AND (c.f[5] BETWEEN 16 AND 19 OR c.f[17] = 1) "
    "ELSE c.f[5] BETWEEN 8 AND 15 AND (c.f[8] = 1 OR c.f[16] = 1) END"
)


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``base``: the base spans of all kinds, by kind, then start."""
    out = docs.select("*", *[found("text", regex, quick).alias(f"hits_{kind}") for kind, regex, _, quick in BASE])
    out = out.select("doc_id", "text", *[located("text", f"hits_{kind}", regex).alias(kind) for kind, regex, _, _ in BASE])
    each = ", ".join(labelled(kind, i, kind, keep) for i, (kind, _, keep, _) in enumerate(BASE))
    return out.select("doc_id", "text", F.expr(f"concat({each})").alias("base"))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``cands``: proposed spans with their features ``f``."""
    names = [c for c in docs.columns]
    out = docs.select("*", *[found("text", regex, quick).alias(f"g_{kind}") for kind, regex, quick in GENERATORS])
    out = out.select(*names, *[located("text", f"g_{kind}", regex).alias(f"p_{kind}") for kind, regex, _ in GENERATORS])
    each = ", ".join(labelled(kind, i, f"p_{kind}") for i, (kind, _, _) in enumerate(GENERATORS))
    out = out.select(*names, F.expr(f"concat({each})").alias("proposed"))
    near = (
        "transform(proposed, s -> named_struct('start', s.start, 'rank', s.rank, 'end', s.end, 'kind', s.kind, 'hit', s.hit, "
        f"'digits', {_DIGITS}, "
        f"'before', substring(text, CAST(greatest(s.start - {CONTEXT}, 0) AS int) + 1, CAST(least(s.start, {CONTEXT}) AS int)), "
        "'after', substring(text, CAST(s.end AS int) + 1, 1)))"
    )
    out = out.select(*names, F.expr(f"CASE WHEN size(proposed) > 0 THEN {near} END").alias("near"))
    numbers = f"transform(near, c -> named_struct('start', c.start, 'rank', c.rank, 'end', c.end, 'kind', c.kind, 'hit', c.hit, 'before', c.before, 'f', array({', '.join(_FEATURES)})))"
    return out.select(*names, F.expr(numbers).alias("cands"))


def _tree_sql(lines: list[str]) -> str:
    """One tree, as Spark prints it, as nested CASE expressions over ``c.f``."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return f"{float(line.split(':')[1])!r}D"
    m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
    yes = _tree_sql(lines)
    lines.pop(0)
    return f"CASE WHEN c.f[{m[1]}] <= {float(m[2])!r}D THEN {yes} ELSE {_tree_sql(lines)} END"


def counted(docs: DataFrame) -> DataFrame:
    """How many candidates (``n``) of all ``docs`` have each kind, features, label and half of the texts."""
    rows = candidates(base_spans(docs.select("doc_id", whole_text().alias("text"))).withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2))))
    # An outer explode, because Spark would extract twice to test for empty lists before a plain one.
    rows = rows.select("base", "half", F.explode_outer("cands").alias("c")).where("c IS NOT NULL")
    right = F.expr(f"CAST(exists(base, b -> b.kind = c.kind AND b.start = c.start AND b.end = c.end) OR coalesce({EVIDENCE}, false) AS double)")
    rows = rows.select("half", F.col("c.kind"), F.col("c.f"), right.alias("label"))
    return rows.groupBy("kind", "f", "label", "half").agg(F.count("*").cast("double").alias("n"))


def _score(rows: DataFrame) -> str | None:
    """SQL for a candidate's probability by trees trained on all of ``rows``; None if they have no two classes."""
    classes, distinct = rows.agg(F.count_distinct("label"), F.count("*")).first()
    if classes < 2:
        return None
    # Spark chooses where trees may cut from a sample of max(10000, maxBins * maxBins) rows; so many bins make that all rows.
    bins = max(BINS, math.isqrt(distinct) + 1)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=bins, stepSize=0.3, seed=4, weightCol="n").fit(rows.withColumn("features", array_to_vector("f")))
    trees = [_tree_sql(tree.toDebugString.strip().splitlines()[1:]) for tree in model.trees]
    margin = " + ".join(f"({w!r}D * {t})" for w, t in zip(model.treeWeights, trees, strict=True))
    return f"(1D / (1D + exp(-2D * ({margin}))))"


def fit(spark: SparkSession, docs: DataFrame) -> tuple[str, dict[str, float]] | None:
    """SQL for a candidate's probability, and the thresholds by kind; None if no kind has one."""
    rows = stored(spark, counted(docs).sortWithinPartitions("kind", "f", "label", "half"), "pii-counts")
    held = []
    for half in (0, 1):
        score = _score(rows.where(F.col("half") != half))
        if score:
            held.append(rows.where(F.col("half") == half).select("kind", "label", "n", F.struct("f").alias("c")).select("kind", "label", "n", F.expr(score).alias("score")))
    if not held:
        return None
    steps = reduce(DataFrame.union, held).groupBy("kind", F.floor(F.col("score") * 100).alias("step")).agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n"))
    by_score = sorted(steps.collect(), key=lambda r: -r["step"])  # at most 101 of a kind
    thresholds: dict[str, float] = {}
    for kind in KINDS:
        right_so_far = n_so_far = 0.0
        for r in by_score:
            if r["kind"] == kind:
                right_so_far, n_so_far = right_so_far + r["right"], n_so_far + r["n"]
                if r["step"] >= 50 and right_so_far >= PRECISION * n_so_far:
                    thresholds[kind] = r["step"] / 100
    return (_score(rows), thresholds) if thresholds else None


def personal_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, counts of base kinds, digest of the base spans, all spans as text and as rows (``found``)."""
    model = fit(spark, docs)
    rows = base_spans(docs.select("doc_id", whole_text().alias("text")))
    empty = "filter(base, b -> false)"
    if model:
        score, thresholds = model
        rows = candidates(rows)
        limit = "CASE c.kind " + " ".join(f"WHEN '{k}' THEN {t!r}D" for k, t in thresholds.items()) + " ELSE 2D END"
        free = "NOT exists(base, b -> b.kind = c.kind AND b.start < c.end AND c.start < b.end)"
        added = F.expr(f"filter(cands, c -> {free} AND {score} >= {limit})")
        rows = rows.select("doc_id", "base", F.when(F.size("cands") > 0, added).alias("more"))
        single = (
            "aggregate(array_sort(transform(more, c -> named_struct('rank', c.rank, 'start', c.start, 'last', -c.end, 'end', c.end, 'kind', c.kind, 'hit', c.hit))), "
            f"{empty}, (a, c) -> CASE WHEN size(a) > 0 AND element_at(a, -1).rank = c.rank AND element_at(a, -1).end > c.start THEN a "
            "ELSE array_append(a, named_struct('start', c.start, 'rank', c.rank, 'end', c.end, 'kind', c.kind, 'hit', c.hit)) END)"
        )
        rows = rows.select("doc_id", "base", F.expr(f"CASE WHEN size(more) > 0 THEN {single} ELSE {empty} END").alias("extra"))
    else:
        rows = rows.select("doc_id", "base", F.expr(empty).alias("extra"))
    by_kind = "array_sort(concat(base, extra), (x, y) -> CASE WHEN x.rank <> y.rank THEN x.rank - y.rank WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1 WHEN x.end < y.end THEN -1 WHEN x.end > y.end THEN 1 ELSE 0 END)"
    rows = rows.select("doc_id", "base", F.expr(f"CASE WHEN size(extra) > 0 THEN {by_kind} ELSE base END").alias("found"))
    counts = [F.expr(f"CAST(size(filter(base, b -> b.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(F.expr(listing("base")), 256).alias("base_sha256"), F.expr(listing("found")).alias("spans"), "found")
