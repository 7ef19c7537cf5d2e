"""Scalar functions as Columns."""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.plans import ast as A

if TYPE_CHECKING:
    from folio.operators.fields import Scope


def scalar(expr: A.Expr, scope: Scope, kind: str | None = "double") -> Column:
    """``kind`` is how untyped JSON operands are read."""
    if isinstance(expr, A.Const):
        return F.lit(expr.value) if not isinstance(expr.value, tuple) else F.array(*map(F.lit, expr.value))
    if isinstance(expr, A.DocConst):
        return F.parse_json(F.lit(expr.json))
    if not isinstance(expr, A.Func):
        return scope.resolve(expr).typed(kind)
    op = expr.op
    if op is A.Function.LENGTH:
        v = scope.resolve(expr.args[0], whole=True) if isinstance(expr.args[0], (A.Ident, A.JsonIdent)) else None
        array = scalar(expr.args[0], scope, None) if v is None else v.typed("array<variant>")
        return F.coalesce(F.size(array), F.lit(0))
    if op is A.Function.TO_LOWER_CASE:
        return F.lower(scalar(expr.args[0], scope, "string"))
    args = [scalar(a, scope) for a in expr.args]
    if op is A.Function.ABS:
        return F.abs(args[0])
    if op is A.Function.FLOOR:
        return F.floor(args[0]).cast("double")
    if op is A.Function.ADD:
        return reduce(lambda a, b: a + b, args)
    if op is A.Function.SUBTRACT:
        return reduce(lambda a, b: a - b, args)
    if op is A.Function.MULTIPLY:
        return reduce(lambda a, b: a * b, args)
    return reduce(lambda a, b: F.try_divide(a.cast("double"), b.cast("double")), args)  # a zero divisor gives null
