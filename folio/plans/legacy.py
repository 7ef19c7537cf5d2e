"""The older query model, translated into the present one."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum
from typing import Any

from pyspark.sql import types as T

from folio.plans import ast as A


class LegacyOp(Enum):
    AND = "AND"
    OR = "OR"
    EQ = "EQ"
    NEQ = "NEQ"
    GT = "GT"
    LT = "LT"
    GTE = "GTE"
    LTE = "LTE"
    IN = "IN"
    CONTAINS = "CONTAINS"
    EXISTS = "EXISTS"
    NOT_EXISTS = "NOT_EXISTS"
    LIKE = "LIKE"
    NOT_IN = "NOT_IN"
    NOT_CONTAINS = "NOT_CONTAINS"


@dataclass(frozen=True)
class LegacyFilter:
    op: LegacyOp
    name: str | None = None
    value: Any = None
    children: tuple[LegacyFilter, ...] = ()

    def and_(self, *others: LegacyFilter) -> LegacyFilter:
        return LegacyFilter(LegacyOp.AND, children=(self, *others))

    def or_(self, *others: LegacyFilter) -> LegacyFilter:
        return LegacyFilter(LegacyOp.OR, children=(self, *others))


@dataclass(frozen=True)
class LegacyOrder:
    name: str
    ascending: bool = True


@dataclass(frozen=True)
class LegacyQuery:
    selections: tuple[str, ...] = ()
    filter: LegacyFilter | None = None
    order_by: tuple[LegacyOrder, ...] = field(default=())
    offset: int | None = None
    limit: int | None = None


def _json_type(value: Any) -> A.JsonType:
    many = isinstance(value, (list, tuple, set))
    one = next(iter(value), None) if many else value
    if isinstance(one, bool):
        return A.JsonType.BOOLEAN
    if isinstance(one, (int, float)):
        return A.JsonType.NUMBER
    return A.JsonType.STRING if one is None or isinstance(one, str) else A.JsonType.UNSPECIFIED


def legacy_field(name: str, schema: T.StructType | None, value: Any = None, array: bool = False) -> A.Expr:
    """A column of that name; else a path in the JSON column with the shortest fitting prefix; else a plain name."""
    if schema is None or name in schema.fieldNames():
        return A.Ident(name)
    parts = name.split(".")
    for n in range(1, len(parts)):
        prefix = ".".join(parts[:n])
        if prefix in schema.fieldNames() and isinstance(schema[prefix].dataType, (T.VariantType, T.StringType)):
            kind = _json_type(value)
            if array and kind.value in ("string", "double", "boolean"):
                kind = A.JsonType(f"array<{kind.value}>")
            return A.JsonIdent(prefix, kind, *parts[n:])
    return A.Ident(name)


def translate_filter(f: LegacyFilter, schema: T.StructType | None = None) -> A.Predicate | None:
    """NEQ keeps rows without the field here, unlike in the present model; groups of one are their member."""
    if f.op in (LegacyOp.AND, LegacyOp.OR):
        parts = [p for c in f.children if (p := translate_filter(c, schema)) is not None]
        if len(parts) < 2:
            return parts[0] if parts else None
        return (A.And if f.op is LegacyOp.AND else A.Or)(*parts)
    many = f.op in (LegacyOp.CONTAINS, LegacyOp.NOT_CONTAINS)
    value = list(f.value) if isinstance(f.value, (list, tuple, set)) else f.value
    left = legacy_field(f.name or "", schema, value, many)
    if f.op in (LegacyOp.IN, LegacyOp.NOT_IN) and value == []:
        never = A.And(A.Rel(left, A.Op.EXISTS, True), A.Rel(left, A.Op.NOT_EXISTS, True))
        return never if f.op is LegacyOp.IN else A.Or(A.Rel(left, A.Op.EXISTS, True), A.Rel(left, A.Op.NOT_EXISTS, True))
    if f.op in (LegacyOp.EXISTS, LegacyOp.NOT_EXISTS):
        return A.Rel(left, A.Op[f.op.name], True)
    rel = A.Rel(left, A.Op[f.op.name], A.DocConst.of(value) if isinstance(value, dict) else value)
    if f.op is LegacyOp.NEQ and value is not None:
        return A.Or(A.Rel(left, A.Op.NOT_EXISTS, True), rel)
    return rel


def translate(query: LegacyQuery, schema: T.StructType | None = None) -> A.Query:
    """An offset counts only together with a limit."""
    return A.Query(
        select=tuple(A.Select(legacy_field(s, schema)) for s in query.selections),
        where=translate_filter(query.filter, schema) if query.filter else None,
        order_by=tuple(A.SortKey(legacy_field(o.name, schema), A.Order.ASC if o.ascending else A.Order.DESC) for o in query.order_by),
        page=A.Page(query.limit, query.offset or 0) if query.limit is not None else None,
    )
