"""Which rule texts may be evaluated: one boolean over the canonical columns, decided row by row.

A rule is text that becomes part of an aggregation. It is analysed here against a frame without rows, so what is
wrong with it is said when the catalogue is synchronised and not in the middle of an evaluation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.quality import CANONICAL_TYPES

_SUBQUERIES = {"ScalarSubquery", "Exists", "ListQuery", "InSubquery", "LateralSubquery"}
_USER_CODE = {"PythonUDF", "PythonUDAF", "ScalaUDF", "HiveSimpleUDF", "HiveGenericUDF", "CallMethodViaReflection"}
_OF_THE_MOMENT = re.compile(r"^(Current\w+|Now|LocalTimestamp\w*|InputFile\w+)$")
#: Words that a typed literal replaces by an instant when it is parsed.
_MOVING_LITERAL = re.compile(r"""['"]\s*(now|today|tomorrow|yesterday)\b""", re.IGNORECASE)


class RuleProblem(ValueError):
    """Rules whose text cannot be evaluated."""


def rule_problem(spark: SparkSession, expression: str) -> str | None:
    """What keeps ``expression`` from being a rule, or None."""
    try:
        frame = _analysed(spark, expression)
        # The text also has to hold where an evaluation puts it: an open comment would swallow what follows.
        _empty(spark).selectExpr(f"count_if(boolean({expression})) AS counted")
    except AnalysisException as bad:
        return str(bad).strip().splitlines()[0]
    kind = frame.schema["violated"].dataType
    if not isinstance(kind, T.BooleanType):
        return f"is {kind.simpleString()}, not boolean"
    plan = frame._jdf.queryExecution().analyzed()
    if plan.nodeName() != "Project" or plan.children().apply(0).children().size():
        return "needs more than the row it judges"
    for node in _expressions(plan.expressions()):
        name = _name(node)
        if name in _SUBQUERIES:
            return "holds a subquery"
        if name in _USER_CODE:
            return "calls user code"
        if not node.deterministic():
            return f"is not deterministic ({name})"
    return None


def of_the_moment(spark: SparkSession, expression: str) -> bool:
    """Whether the same rows may be judged differently later: the rule asks for the time, the user or the file."""
    if _MOVING_LITERAL.search(expression):
        return True
    plan = _analysed(spark, expression)._jdf.queryExecution().analyzed()
    return any(_OF_THE_MOMENT.match(_name(node)) for node in _expressions(plan.expressions()))


def check_rules(spark: SparkSession, rules: list[dict]) -> None:
    """Raise unless every rule (rule_id, expression) can be evaluated; all that cannot are named."""
    problems = {rule["rule_id"]: rule_problem(spark, rule["expression"]) for rule in rules}
    bad = sorted(f"{rule}: {problem}" for rule, problem in problems.items() if problem)
    if bad:
        raise RuleProblem("; ".join(bad))


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{name} {kind}" for name, kind in CANONICAL_TYPES.items()))


def _analysed(spark: SparkSession, expression: str) -> DataFrame:
    return _empty(spark).select(F.expr(expression).alias("violated"))


def _name(expression) -> str:
    return expression.getClass().getName().rsplit(".", 1)[-1].rsplit("$", 1)[-1]


def _expressions(found) -> Iterator:
    """Every expression of a Scala sequence, the ones inside included."""
    for i in range(found.size()):
        node = found.apply(i)
        yield node
        yield from _expressions(node.children())
