"""Field references to Columns, by document type and scope."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.plans import ast as A


def json_path(parts: tuple[str, ...] | list[str]) -> str:
    return "$" + "".join(f'["{p}"]' for p in parts)


def kind_of(value: Any) -> str | None:
    """Spark type by which a value's left side is read from untyped JSON."""
    if isinstance(value, (tuple, list)):
        value = value[0] if value else None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "double"
    if isinstance(value, (dt.datetime, dt.date)):
        return "timestamp"
    return "string" if isinstance(value, str) else None


def canonical(variant: Column) -> Column:
    """The text of a JSON value, equal numbers alike; null for a missing or null one."""
    number = _is_number(variant)
    double = F.try_variant_get(variant, "$", "double")
    whole = F.try_variant_get(variant, "$", "bigint")
    text = F.when(number & (double == whole), whole.cast("string")).when(number, double.cast("string")).otherwise(F.to_json(variant))
    return F.when(~F.is_variant_null(variant), text)


def _is_number(variant: Column) -> Column:
    return F.schema_of_variant(variant).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")


def ranked(variant: Column) -> Column:
    """A struct that orders JSON values: numbers by value, then text, then others; ``json`` is the value's text."""
    text = F.schema_of_variant(variant) == "STRING"
    rank = F.when(_is_number(variant), 1).when(text, 2).otherwise(3)
    number = F.when(rank == 1, F.try_variant_get(variant, "$", "double"))
    said = F.when(text, F.try_variant_get(variant, "$", "string"))
    json = canonical(variant)
    return F.when(json.isNotNull(), F.struct(rank.alias("rank"), number.alias("number"), said.alias("said"), json.alias("json")))


@dataclass(frozen=True)
class Value:
    """A resolved field: ``typed(kind)`` reads it as a Spark type; ``type`` is None for a raw variant."""

    column: Column
    type: T.DataType | None

    @property
    def is_array(self) -> bool:
        return isinstance(self.type, T.ArrayType)

    def typed(self, kind: str | None) -> Column:
        if self.type is not None or kind is None:
            return self.column
        return F.try_variant_get(self.column, "$", kind)

    def below(self, parts: tuple[str, ...]) -> Value:
        if not parts:
            return self
        if self.type is None:
            return Value(F.try_variant_get(self.column, json_path(parts), "variant"), None)
        if isinstance(self.type, T.StructType) and parts[0] in self.type.fieldNames():
            return as_value(self.column.getField(parts[0]), self.type[parts[0]].dataType).below(parts[1:])
        if isinstance(self.type, T.StringType):  # JSON as text
            return Value(F.try_parse_json(self.column), None).below(parts)
        raise ValueError(f"no field {'.'.join(parts)}")


def as_value(column: Column, kind: T.DataType) -> Value:
    return Value(column, None if isinstance(kind, T.VariantType) else kind)


@dataclass(frozen=True)
class Scope:
    """What names mean: the collection's columns, unnested fields, an array element, or aliases."""

    schema: T.StructType
    nested: bool
    key: str
    unnested: dict[tuple[str, ...], tuple[str, T.DataType]] = field(default_factory=dict)
    element: Value | None = None
    element_name: str | None = None
    aliases: dict[str, Value] = field(default_factory=dict)
    joined: dict[str, T.StructType] = field(default_factory=dict)
    prefix: str = ""

    def col(self, name: str) -> Column:
        return F.col(f"{self.prefix}`{name}`")

    def inside(self, element: Value, name: str | None) -> Scope:
        return replace(self, element=element, element_name=name)

    def _column(self, name: str) -> Value:
        return as_value(self.col(name), self.schema[name].dataType)

    def is_unnested(self, expr: A.Expr) -> bool:
        return isinstance(expr, (A.Ident, A.JsonIdent)) and tuple(expr.name.split(".")) in self.unnested

    def resolve(self, expr: A.Expr, whole: bool = False) -> Value:
        """``whole`` asks for an array itself where its field has been unnested."""
        if isinstance(expr, A.AliasedIdent):
            kind = self.joined[expr.context][expr.name].dataType
            return as_value(F.col(f"{expr.context}.`{expr.name}`"), kind)
        if isinstance(expr, A.JsonIdent):
            if self.nested:
                raise ValueError("a JSON column path needs a flat collection")
            found = self._find((expr.column, *expr.path), whole)
            value = found if found else self._column(expr.column).below(expr.path)
            if value.type is None and expr.type.value not in (None, "variant"):
                got = F.try_variant_get(value.column, "$", expr.type.value)
                return Value(got, T.ArrayType(T.VariantType()) if expr.type is A.JsonType.OBJECT_ARRAY else T._parse_datatype_string(expr.type.value))
            return value
        if not isinstance(expr, A.Ident):
            raise ValueError(f"not a field: {expr}")
        if self.element is not None:
            if self.element_name is not None:
                return self.element
            return self._hinted(self.element.below(tuple(expr.name.split("."))), expr)
        if expr.name in self.aliases:
            return self.aliases[expr.name]
        found = self._find(tuple(expr.name.split(".")), whole)
        if found:
            return self._hinted(found, expr)
        if self.nested:
            if expr.name in ("id", "created_at", "updated_at"):
                return self._column(expr.name)
            return self._hinted(Value(F.try_variant_get(self.col("document"), json_path(expr.name.split(".")), "variant"), None), expr)
        if expr.name in self.schema.fieldNames():
            return self._column(expr.name)
        parts = tuple(expr.name.split("."))
        for n in range(len(parts) - 1, 0, -1):
            if ".".join(parts[:n]) in self.schema.fieldNames():
                return self._hinted(self._column(".".join(parts[:n])).below(parts[n:]), expr)
        raise ValueError(f"no column {expr.name}")

    def _find(self, parts: tuple[str, ...], whole: bool) -> Value | None:
        """The longest unnested field that the path begins with."""
        for n in range(len(parts) - whole, 0, -1):
            if parts[:n] in self.unnested:
                name, kind = self.unnested[parts[:n]]
                return as_value(self.col(name), kind).below(parts[n:])
        return None

    def _hinted(self, value: Value, expr: A.Ident) -> Value:
        """Types that the query states read untyped JSON."""
        if value.type is not None or expr.type.value in (None, "variant"):
            if value.type is None and isinstance(expr, A.ArrayIdent):
                return Value(F.try_variant_get(value.column, "$", "array<variant>"), T.ArrayType(T.VariantType()))
            return value
        if isinstance(expr, A.ArrayIdent):
            kind = f"array<{expr.type.value}>"
            return Value(F.try_variant_get(value.column, "$", kind), T._parse_datatype_string(kind))
        return Value(F.try_variant_get(value.column, "$", expr.type.value), T._parse_datatype_string(expr.type.value))
