"""Aggregates as Columns."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.scalar import scalar
from folio.operators.fields import canonical, ranked
from folio.plans import ast as A

if TYPE_CHECKING:
    from folio.operators.fields import Scope


def aggregate(agg: A.Agg, scope: Scope) -> Column:
    """Nulls count for nothing. LAST is the value in the row with the largest ``order_by`` (else key).

    Untyped JSON is compared by value, numbers before text, and keeps its type.
    """
    op = agg.op
    if isinstance(agg.arg, (A.Ident, A.JsonIdent, A.AliasedIdent)):
        value = scope.resolve(agg.arg)
        if value.type is None and op not in (A.Aggregate.SUM, A.Aggregate.AVG):
            return _of_json(agg, value.column, scope)
    if op in (A.Aggregate.SUM, A.Aggregate.AVG):
        kind = "double"
    else:
        kind = "string"
    if op in (A.Aggregate.MIN, A.Aggregate.MAX) and isinstance(agg.arg, A.Func):
        kind = "double"
    arg = scalar(agg.arg, scope, kind)
    if op is A.Aggregate.COUNT:
        return F.count(arg)
    if op is A.Aggregate.SUM:
        return F.sum(arg)
    if op is A.Aggregate.AVG:
        return F.avg(arg)
    if op is A.Aggregate.MIN:
        return F.min(arg)
    if op is A.Aggregate.MAX:
        return F.max(arg)
    if op is A.Aggregate.DISTINCT_COUNT:
        return F.count_distinct(arg)
    if op is A.Aggregate.LAST:
        return F.max_by(arg, _latest(agg, scope))
    return F.array_sort(F.collect_set(arg))


def _latest(agg: A.Agg, scope: Scope) -> Column:
    if not agg.order_by:
        return scope.col(scope.key)
    by = scope.resolve(agg.order_by)
    return ranked(by.column) if by.type is None else by.column


def _of_json(agg: A.Agg, variant: Column, scope: Scope) -> Column:
    op = agg.op
    if op is A.Aggregate.COUNT:
        return F.count(canonical(variant))
    if op is A.Aggregate.DISTINCT_COUNT:
        return F.count_distinct(canonical(variant))
    if op is A.Aggregate.LAST:
        return F.max_by(variant, _latest(agg, scope))
    if op in (A.Aggregate.MIN, A.Aggregate.MAX):
        best = F.min(ranked(variant)) if op is A.Aggregate.MIN else F.max(ranked(variant))
        return F.try_parse_json(best["json"])
    return F.transform(F.array_sort(F.collect_set(ranked(variant))), lambda x: F.try_parse_json(x["json"]))
