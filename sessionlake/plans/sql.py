"""Free read-only SQL over the analytics tables."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from sessionlake.plans.presets import Tables

TABLES = ("envelope_facts", "event_facts", "command_rollups", "session_rollups")
_READS = {"Project", "Aggregate", "Sort", "GlobalLimit", "LocalLimit", "Filter", "Distinct", "Union", "Intersect", "Except", "UnresolvedWith", "With",
          "UnresolvedHaving", "WithWindowDefinition", "Join", "SubqueryAlias", "UnresolvedRelation", "OneRowRelation", "UnresolvedInlineTable",
          "Generate", "Window", "Pivot", "Unpivot", "Offset", "GroupingSets", "UnresolvedSubqueryColumnAliases", "Tail", "Sample", "UnresolvedHint",
          "LateralJoin", "Deduplicate", "UnresolvedOrdinal", "LocalRelation"}
#: Built-in functions that run foreign code or read what is no table.
_FORBIDDEN = {"reflect", "java_method", "try_reflect", "input_file_name", "input_file_block_start", "input_file_block_length", "from_avro", "to_avro",
              "from_protobuf", "to_protobuf"}


def _items(seq: JavaObject) -> Iterator[JavaObject]:
    for i in range(seq.size()):
        yield seq.apply(i)


def _called(node: JavaObject, kind: str) -> list[str] | None:
    """The name of a function call, in parts."""
    if kind == "UnresolvedFunction":
        return list(_items(node.nameParts()))
    return node.name().unquotedString().split(".") if kind == "UnresolvedGenerator" else None


def _check(spark: SparkSession, plan: JavaObject, named: frozenset[str]) -> None:
    """Refuses all of a parsed plan that reads anything but the tables in ``named``; subqueries and definitions included."""
    kind = plan.getClass().getSimpleName()
    if kind not in _READS:
        raise ValueError(f"only SELECT and WITH queries are allowed, not {kind}")
    if kind == "UnresolvedRelation":
        parts = list(_items(plan.multipartIdentifier()))
        if len(parts) != 1 or parts[0].lower() not in named:
            raise ValueError(f"no such table: {'.'.join(parts)}")
    if kind == "UnresolvedWith":
        for definition in _items(plan.cteRelations()):
            # A definition sees those before it; a recursive one also itself.
            name = frozenset({definition._1().lower()})
            _check(spark, definition._2(), named | name if plan.allowRecursion() else named)
            named = named | name
        _check(spark, plan.child(), named)
        return
    if kind == "WithWindowDefinition":
        for definition in _items(plan.windowDefinitions().values().toSeq()):
            _check_expression(spark, definition, named)
    for expression in _items(plan.expressions()):
        _check_expression(spark, expression, named)
    for child in _items(plan.children()):
        _check(spark, child, named)


def _check_expression(spark: SparkSession, node: JavaObject, named: frozenset[str]) -> None:
    kind = node.getClass().getSimpleName()
    name = _called(node, kind)
    if name is not None:
        own = name[-1].lower()
        known = len(name) == 1 or [x.lower() for x in name[:-1]] in (["builtin"], ["system", "builtin"])
        if not known or own in _FORBIDDEN or not _built_in(spark, own):
            raise ValueError(f"function is not allowed: {'.'.join(name)}")
    if kind in ("ScalarSubquery", "ListQuery", "Exists", "LateralSubquery"):
        _check(spark, node.plan(), named)
    elif "Subquery" in kind and kind != "InSubquery":  # its query is a child
        raise ValueError(f"this kind of subquery is not allowed: {kind}")
    for child in _items(node.children()):
        _check_expression(spark, child, named)


def _built_in(spark: SparkSession, name: str) -> bool:
    registry = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin()
    identifier = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name)
    return registry.functionExists(identifier)


def check_read_only(spark: SparkSession, query: str) -> None:
    """Accepts one SELECT or WITH over the tables, with built-in functions.

    Spark's parser decides what a statement is; every node of its plan and every
    expression is looked at, before anything is analysed or run.
    """
    _check(spark, spark._jsparkSession.sessionState().sqlParser().parsePlan(query), frozenset(TABLES))


def run(spark: SparkSession, t: Tables, query: str, previews: bool = False) -> DataFrame:
    if previews:
        raise ValueError("previews cannot be combined with own SQL")
    check_read_only(spark, query)
    for name in TABLES:
        getattr(t, name).createOrReplaceTempView(name)
    return spark.sql(query)
