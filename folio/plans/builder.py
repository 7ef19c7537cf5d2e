"""Fluent construction of queries."""

from __future__ import annotations

from dataclasses import replace
from typing import Any

from folio.plans import ast as A


def _expr(x: A.Expr | str) -> A.Expr:
    return A.Ident(x) if isinstance(x, str) else x


class QueryBuilder:
    """``set_*`` replaces a clause (an empty list clears it), ``add_*`` appends to it."""

    def __init__(self) -> None:
        self._query = A.Query()

    def _with(self, **parts: Any) -> QueryBuilder:
        self._query = replace(self._query, **parts)
        return self

    def set_selections(self, selections: list[A.Select]) -> QueryBuilder:
        return self._with(select=tuple(selections))

    def add_selection(self, expr: A.Expr | str, alias: str | None = None) -> QueryBuilder:
        return self._with(select=(*self._query.select, A.Select(_expr(expr), alias)))

    def set_filter(self, predicate: A.Predicate | None) -> QueryBuilder:
        return self._with(where=predicate)

    def set_aggregations(self, keys: list[A.Expr | str]) -> QueryBuilder:
        return self._with(group_by=tuple(map(_expr, keys)))

    def add_aggregation(self, key: A.Expr | str) -> QueryBuilder:
        return self._with(group_by=(*self._query.group_by, _expr(key)))

    def set_aggregation_filter(self, predicate: A.Predicate | None) -> QueryBuilder:
        return self._with(having=predicate)

    def set_sorts(self, keys: list[A.SortKey]) -> QueryBuilder:
        return self._with(order_by=tuple(keys))

    def add_sort(self, expr: A.Expr | str, order: A.Order = A.Order.ASC) -> QueryBuilder:
        return self._with(order_by=(*self._query.order_by, A.SortKey(_expr(expr), order)))

    def set_pagination(self, limit: int, offset: int = 0) -> QueryBuilder:
        return self._with(page=A.Page(limit, offset))

    def set_from_clauses(self, parts: list[A.Unnest | A.SelfJoin]) -> QueryBuilder:
        return self._with(source=tuple(parts))

    def add_from_clause(self, part: A.Unnest | A.SelfJoin) -> QueryBuilder:
        return self._with(source=(*self._query.source, part))

    def build(self) -> A.Query:
        return self._query
