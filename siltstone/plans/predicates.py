"""Simple predicates out of conditions, and their test against row-group statistics."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import SparkSession

from ..sources.footer import RowGroup, lower

_FLIP = {"<": ">", "<=": ">=", ">": "<", ">=": "<=", "=": "="}
_CLASSES = {"LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "EqualTo": "="}


@dataclass(frozen=True)
class Predicate:
    """column op value; op `has_key` asks for a key of a map."""

    column: str
    op: str
    value: object


def _literal(node):
    """Value of a JVM literal; raises ValueError for others."""
    name = node.getClass().getSimpleName()
    if name in ("Cast", "UnresolvedCast") and node.children().size() == 1:
        return _literal(node.children().apply(0))
    if name == "UnaryMinus":
        return -_literal(node.children().apply(0))
    if name != "Literal" or node.value() is None:
        raise ValueError(name)
    kind, value = node.dataType().simpleString(), node.value()
    if kind == "date":
        return dt.date(1970, 1, 1) + dt.timedelta(days=value)
    if kind.startswith("timestamp"):
        return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=value)
    if kind.startswith("decimal"):
        return Decimal(value.toString())
    if kind in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double"):
        return value
    if kind.startswith(("string", "char", "varchar")):
        return value.toString()
    raise ValueError(kind)


def _column(node) -> str | None:
    kind = node.getClass().getSimpleName()
    if kind == "UnresolvedAttribute":
        parts = node.nameParts()
        return parts.apply(parts.size() - 1)
    return node.name() if kind == "AttributeReference" else None


def extract(spark: SparkSession, condition) -> list[Predicate]:
    """Predicates that all hold where condition holds: comparisons of a column with a constant, boolean columns and map
    keys, joined by AND. Other parts are left out. condition: SQL text, Predicates, (column, op, value), or None."""
    if condition is None:
        return []
    if not isinstance(condition, str):
        return [p if isinstance(p, Predicate) else Predicate(*p) for p in condition]
    return conjuncts(spark._jsparkSession.sessionState().sqlParser().parseExpression(condition))


def conjuncts(condition) -> list[Predicate]:
    """Predicates of a JVM expression, parsed or resolved."""
    out: list[Predicate] = []

    def walk(node) -> None:
        name, kids = node.getClass().getSimpleName(), node.children()
        child = lambda i: kids.apply(i)
        if name == "And":
            walk(child(0))
            walk(child(1))
        elif name in _CLASSES:
            for a, b, op in ((child(0), child(1), _CLASSES[name]), (child(1), child(0), _FLIP[_CLASSES[name]])):
                if column := _column(a):
                    try:
                        out.append(Predicate(column, op, _literal(b)))
                    except ValueError:
                        pass
                    return
        elif name in ("UnresolvedAttribute", "AttributeReference"):
            out.append(Predicate(_column(node), "=", True))
        elif name == "Not" and (column := _column(child(0))):
            out.append(Predicate(column, "=", False))
        elif name in ("Between", "UnresolvedBetween") or (name == "UnresolvedFunction" and node.nameParts().apply(0) == "between"):
            if column := _column(child(0)):
                for k, op in ((1, ">="), (2, "<=")):
                    try:
                        out.append(Predicate(column, op, _literal(child(k))))
                    except ValueError:
                        pass
        elif name == "UnresolvedFunction" and node.nameParts().apply(0).lower() == "map_contains_key":
            if column := _column(child(0)):
                try:
                    out.append(Predicate(column, "has_key", _literal(child(1))))
                except ValueError:
                    pass

    walk(condition)
    return out


def scans(plan) -> list[tuple[list[str], list[Predicate]]]:
    """Of an optimised JVM plan, subqueries included: the root paths of each file scan, and what its filter asks for."""
    out: list[tuple[list[str], list[Predicate]]] = []

    def seq(x) -> list:
        return [x.apply(i) for i in range(x.size())]

    def walk(node, above: list[Predicate]) -> None:
        name = node.getClass().getSimpleName()
        if name == "LogicalRelation" and node.relation().getClass().getSimpleName() == "HadoopFsRelation":
            out.append(([p.toString() for p in seq(node.relation().location().rootPaths())], above))
        for sub in seq(node.subqueries()):
            walk(sub, [])
        for child in seq(node.children()):
            walk(child, conjuncts(node.condition()) if name == "Filter" else [])

    walk(plan, [])
    return out


def _comparable(value, sample):
    """value in the type of the statistics; raises ValueError or TypeError where that has no sense."""
    if isinstance(sample, bool):
        if isinstance(value, bool):
            return value
        raise TypeError
    if isinstance(sample, (int, float, Decimal)):
        if isinstance(value, bool):
            raise TypeError
        if isinstance(value, str):
            return Decimal(value.strip())
        if isinstance(value, (int, float, Decimal)):
            return value
        raise TypeError
    if isinstance(sample, dt.datetime):
        if isinstance(value, str):
            value = dt.datetime.fromisoformat(value.strip())
        elif isinstance(value, dt.date) and not isinstance(value, dt.datetime):
            value = dt.datetime(value.year, value.month, value.day)
        if isinstance(value, dt.datetime):
            return value
        raise TypeError
    if isinstance(sample, dt.date):
        if isinstance(value, str):
            value = dt.datetime.fromisoformat(value.strip())
            return value.date() if value.time() == dt.time() else value
        if isinstance(value, dt.date):
            return value
        raise TypeError
    if isinstance(sample, str):
        return value.encode() if isinstance(value, str) else str(value).encode()
    if isinstance(sample, bytes):
        return value if isinstance(value, bytes) else str(value).encode()
    raise TypeError


def _plain(x):
    if isinstance(x, str):
        return x.encode()
    if isinstance(x, dt.datetime) and x.tzinfo is not None:
        return x.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return x


def may_match(group: RowGroup, p: Predicate) -> bool:
    """False only if no row of the group can satisfy p. No statistics, no such column, odd types: True."""
    name = lower(p.column)
    if p.op == "has_key":
        stats = next((s for k, s in group.stats.items() if k.startswith(name + ".") and k.endswith(".key")), None)
    else:
        stats = group.stats.get(name)
    if stats is None:
        return True
    least, most = _plain(stats.least), _plain(stats.most)
    try:
        value = _comparable(p.value, stats.least)
        if isinstance(value, dt.datetime) and not isinstance(least, dt.datetime):
            least, most = (dt.datetime(x.year, x.month, x.day) for x in (least, most))
        if any(isinstance(x, float) and math.isnan(x) for x in (least, most, value)):
            return True
        if p.op == "<":
            return least < value
        if p.op == "<=":
            return least <= value
        if isinstance(most, float) and p.op in (">", ">="):
            return True if math.isinf(most) else (most > value if p.op == ">" else most >= value)
        if p.op == ">":
            return most > value
        if p.op == ">=":
            return most >= value
        return least <= value <= most
    except (TypeError, ValueError, ArithmeticError):
        return True
