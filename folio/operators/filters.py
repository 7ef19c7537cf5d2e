"""Predicates to boolean Columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.scalar import scalar
from folio.operators.fields import Scope, Value, kind_of
from folio.plans import ast as A

_COMPARE: dict[A.Op, Callable[[Column, Column], Column]] = {
    A.Op.EQ: lambda a, b: a == b,
    A.Op.NEQ: lambda a, b: a != b,
    A.Op.GT: lambda a, b: a > b,
    A.Op.LT: lambda a, b: a < b,
    A.Op.GTE: lambda a, b: a >= b,
    A.Op.LTE: lambda a, b: a <= b,
}


def predicate(p: A.Predicate, scope: Scope, having: bool = False) -> Column:
    if isinstance(p, A.And):
        return reduce(lambda a, b: a & b, [predicate(x, scope, having) for x in p.parts])
    if isinstance(p, A.Or):
        return reduce(lambda a, b: a | b, [predicate(x, scope, having) for x in p.parts])
    if isinstance(p, A.Not):
        return ~predicate(p.part, scope, having)
    if isinstance(p, A.Keys):
        if having:
            raise ValueError("a key filter cannot stand in HAVING")
        return scope.col(scope.key).cast("string").isin(list(p.keys))
    if isinstance(p, A.AnyOf):
        return _any(p, scope, lambda v: scope.inside(v, _name(p.source)))
    if isinstance(p, A.AnyDoc):
        return _any(p, scope, lambda v: scope.inside(v, None))
    return _relation(p, scope)


def _name(expr: A.Expr) -> str:
    return getattr(expr, "name", "element")


def _any(p: A.AnyOf | A.AnyDoc, scope: Scope, inner: Callable[[Value], Scope]) -> Column:
    """Two-valued: a missing, empty or non-array field has no element."""
    source = scope.resolve(p.source, whole=True)
    if source.type is None:
        array, item = F.try_variant_get(source.column, "$", "array<variant>"), None
    elif source.is_array:
        array, item = source.column, source.type.elementType
    else:
        return F.lit(False)
    element = None if isinstance(item, T.VariantType) else item
    return F.coalesce(F.exists(array, lambda x: F.coalesce(predicate(p.filter, inner(Value(x, element))), F.lit(False))), F.lit(False))


def _relation(p: A.Rel, scope: Scope) -> Column:
    op, field = p.op, isinstance(p.lhs, (A.Ident, A.JsonIdent, A.AliasedIdent))
    if op in (A.Op.IN, A.Op.NOT_IN) and isinstance(p.lhs, A.JsonIdent) and not scope.is_unnested(p.lhs) and p.lhs.type in (A.JsonType.UNSPECIFIED, A.JsonType.OBJECT):
        raise ValueError(f"{op.value} on {p.lhs} needs the type of the JSON field")
    left = scope.resolve(p.lhs) if field else Value(scalar(p.lhs, scope), T.NullType())
    if isinstance(p.rhs, A.DocConst):
        return _document(left, p)
    if not isinstance(p.rhs, A.Const):  # another field or a function of fields
        right = scope.resolve(p.rhs) if isinstance(p.rhs, (A.Ident, A.JsonIdent, A.AliasedIdent)) else Value(scalar(p.rhs, scope), T.NullType())
        kind = "string" if left.type is None and right.type is None else None
        a = left.typed(kind or (right.type.simpleString() if right.type and not isinstance(right.type, T.NullType) else "double"))
        b = right.typed(kind or (left.type.simpleString() if left.type and not isinstance(left.type, T.NullType) else "double"))
        return _COMPARE[op](a, b)
    value = p.rhs.value
    element = scope.is_unnested(p.lhs)
    if op in (A.Op.EXISTS, A.Op.NOT_EXISTS):
        present = _present(left, element)
        return present if (value is not False) == (op is A.Op.EXISTS) else ~present
    if op is A.Op.IN:
        return _in(left, value, element)
    if op is A.Op.NOT_IN:
        return left.column.isNull() | ~_in(left, value, element)
    if op is A.Op.CONTAINS:
        return _contains(left, value, element)
    if op is A.Op.NOT_CONTAINS:
        return left.column.isNull() | ~F.coalesce(_contains(left, value, element), F.lit(False))
    if op is A.Op.LIKE:
        return left.typed("string").rlike("(?i)" + str(value))
    if op is A.Op.STARTS_WITH:
        return F.startswith(left.typed("string"), F.lit(str(value)))
    if value is None:
        if op is A.Op.EQ:
            return left.typed("string").isNull()
        if op is A.Op.NEQ:
            return left.typed("string").isNotNull()
        raise ValueError(f"{op.value} has no meaning for null")
    if left.is_array and op in (A.Op.EQ, A.Op.NEQ):
        if isinstance(value, tuple):
            return _COMPARE[op](_plain(left, value), _array(left, value))
        return _contains(left, value, False) if op is A.Op.EQ else left.column.isNull() | ~F.coalesce(_contains(left, value, False), F.lit(False))
    if isinstance(value, tuple):
        kind = f"array<{kind_of(value)}>"
        return _COMPARE[op](left.typed(kind), F.array(*map(F.lit, value)).cast(kind))
    return _COMPARE[op](left.typed(kind_of(value)), F.lit(value))


def _plain(left: Value, value: object) -> Column:
    """The array with its elements read like ``value``."""
    if isinstance(left.type.elementType, T.VariantType):
        kind = kind_of(value)
        return F.transform(left.column, lambda x: F.try_variant_get(x, "$", kind))
    return left.column


def _array(left: Value, value: tuple) -> Column:
    out = F.array(*map(F.lit, value))
    return out.cast(f"array<{kind_of(value)}>") if isinstance(left.type.elementType, T.VariantType) else out.cast(left.type)


def _in(left: Value, value: object, element: bool) -> Column:
    items = value if isinstance(value, tuple) else (value,)
    if left.is_array and not element:
        return F.coalesce(F.arrays_overlap(_plain(left, items), _array(left, items)), F.lit(False))
    kind = kind_of(items)
    among = left.typed(kind).isin(list(items))
    if left.type is not None or element:
        return among
    elements = F.try_variant_get(left.column, "$", "array<variant>")
    overlap = F.exists(elements, lambda x: F.try_variant_get(x, "$", kind).isin(list(items)))
    return F.coalesce(among, F.lit(False)) | F.coalesce(overlap, F.lit(False))


def _contains(left: Value, value: object, element: bool) -> Column:
    items = value if isinstance(value, tuple) else (value,)
    if element and not left.is_array:
        return _in(left, items, True)
    if left.type is None:
        left = Value(F.try_variant_get(left.column, "$", "array<variant>"), T.ArrayType(T.VariantType()))
    if not left.is_array:
        return left.column.isin(list(items))
    return F.size(F.array_except(_array(left, items), _plain(left, items))) == 0


def _present(left: Value, element: bool) -> Column:
    if left.is_array and not element:
        return F.coalesce(F.size(left.column), F.lit(0)) > 0
    return left.typed("string").isNotNull()


def _document(left: Value, p: A.Rel) -> Column:
    """Containment of, or equality with, a JSON document."""
    import json

    wanted = json.loads(p.rhs.json)

    def holds(v: Column, part: object) -> Column:
        if isinstance(part, dict):
            tests = [holds(F.try_variant_get(v, f'$["{k}"]', "variant"), x) for k, x in part.items()]
            return reduce(lambda a, b: a & b, tests, F.lit(True))
        if isinstance(part, list):
            items = F.try_variant_get(v, "$", "array<variant>")
            tests = [F.coalesce(_some(items, x, holds), F.lit(False)) for x in part]
            return reduce(lambda a, b: a & b, tests, F.lit(True))
        if part is None:
            return F.coalesce(F.is_variant_null(v), F.lit(False))
        return F.coalesce(F.try_variant_get(v, "$", kind_of(part)) == F.lit(part), F.lit(False))

    column = left.column if left.type is None or isinstance(left.type, T.ArrayType) else F.to_variant_object(left.column)
    if p.op in (A.Op.CONTAINS, A.Op.NOT_CONTAINS):
        items = column if left.is_array else F.try_variant_get(column, "$", "array<variant>")
        if left.is_array and not isinstance(left.type.elementType, T.VariantType):
            items = F.transform(items, F.to_variant_object)
        test = F.coalesce(_some(items, wanted, holds), F.lit(False))
        return test if p.op is A.Op.CONTAINS else ~test
    if p.op not in (A.Op.EQ, A.Op.NEQ):
        raise ValueError(f"{p.op.value} has no meaning for a document")
    return _COMPARE[p.op](F.to_json(column), F.to_json(F.parse_json(F.lit(p.rhs.json))))


def _some(items: Column, part: object, holds: Callable[[Column, object], Column]) -> Column:
    return F.exists(items, lambda e: holds(e, part))
