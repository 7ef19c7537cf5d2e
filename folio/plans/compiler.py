"""Queries folded clause by clause into a DataFrame; Catalyst does the planning.

Order: scan, joins and unnests with their filters, WHERE, group keys, aggregation, HAVING, sort
(before projection where rows keep their fields), offset and limit, projection.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.aggregates import aggregate
from folio.functions.scalar import scalar
from folio.operators.fields import Scope, Value, as_value, canonical, ranked
from folio.operators.filters import predicate
from folio.plans import ast as A


@dataclass(frozen=True)
class Source:
    """A collection's rows: NESTED has ``id``, ``document`` (variant) and times, FLAT any columns."""

    df: DataFrame
    nested: bool = False
    key: str = "id"

    def scope(self) -> Scope:
        return Scope(self.df.schema, self.nested, self.key)


def compile_query(query: A.Query, source: Source) -> DataFrame:
    """The rows of ``query`` over ``source``, lazily."""
    selections = _selections(query)
    df, scope, where = _from(query, source)
    if where is not None:
        df = df.filter(predicate(where, scope))
    grouped = query.group_by or any(isinstance(s.expr, A.Agg) for s in selections)
    return _grouped(df, scope, query, selections) if grouped else _plain(df, scope, query, selections)


def count_query(query: A.Query, source: Source) -> DataFrame:
    """The number of rows of ``query`` as one row ``count``."""
    return compile_query(query, source).agg(F.count(F.lit(1)).alias("count"))


def _selections(query: A.Query) -> list[A.Select]:
    """Equal selections once; two different ones of one name are refused."""
    out: dict[str, A.Select] = {}
    for s in query.select:
        old = out.setdefault(s.name, s)
        if old.expr != s.expr:
            raise ValueError(f"{s.name} names two different selections")
    return list(out.values())


# ---- FROM ----------------------------------------------------------------------------------------


def _from(query: A.Query, source: Source) -> tuple[DataFrame, Scope, A.Predicate | None]:
    df, scope, where = source.df, source.scope(), query.where
    joins = [s for s in query.source if isinstance(s, A.SelfJoin)]
    if joins:
        df = df.alias("_base")
        scope = replace(scope, prefix="_base.")
    for join in joins:
        sub = compile_query(join.query, source)
        inner = replace(scope, joined={**scope.joined, join.alias: sub.schema})
        df = df.join(sub.alias(join.alias), predicate(join.condition, inner), "inner").select("_base.*").alias("_base")
    if joins:  # rows are base rows again
        df, scope = df.select("_base.*"), replace(scope, prefix="")
    for k, part in enumerate(s for s in query.source if isinstance(s, A.Unnest)):
        df, scope = _unnest(df, scope, part, k)
    return df, scope, where


def _unnest(df: DataFrame, scope: Scope, part: A.Unnest, k: int) -> tuple[DataFrame, Scope]:
    """The field becomes its element; missing, empty and non-array fields give no row, or one null."""
    value = scope.resolve(part.field)
    if value.type is None:
        array, kind = F.try_variant_get(value.column, "$", "array<variant>"), T.VariantType()
    elif value.is_array:
        array, kind = value.column, value.type.elementType
    else:
        array, kind = F.lit(None).cast(T.ArrayType(value.type)), value.type
    name = f"_u{k}"
    df = df.withColumn(name, F.explode_outer(array) if part.preserve_empty else F.explode(array))
    path = tuple(part.field.name.split("."))
    scope = replace(scope, schema=df.schema, unnested={**scope.unnested, path: (name, kind)})
    if part.filter is not None:
        df = df.filter(predicate(part.filter, scope))
    return df, scope


# ---- rows without grouping -----------------------------------------------------------------------


def _is_field(expr: A.Expr) -> bool:
    return isinstance(expr, (A.Ident, A.JsonIdent, A.AliasedIdent))


def _column(expr: A.Expr, scope: Scope) -> Column:
    return scope.resolve(expr).column if _is_field(expr) else scalar(expr, scope)


def _ordered(columns: list[tuple[Value | Column, A.Order]]) -> list[Column]:
    """Nulls first when rising, last when falling; untyped JSON sorts numbers before text."""
    out = []
    for value, order in columns:
        if isinstance(value, Value) and value.type is None:
            key = ranked(value.column)
            cols = [key[part] for part in ("rank", "number", "said", "json")]
        else:
            cols = [value.column if isinstance(value, Value) else value]
        out += [c.asc_nulls_first() if order is A.Order.ASC else c.desc_nulls_last() for c in cols]
    return out


def _sort_keys(query: A.Query) -> list[A.SortKey]:
    seen: dict[str, A.SortKey] = {}
    for k in query.order_by:
        seen.setdefault(str(k.expr), k)
    return list(seen.values())


def _paged(df: DataFrame, page: A.Page | None) -> DataFrame:
    if page is None:
        return df
    return (df.offset(page.offset) if page.offset else df).limit(page.limit)


def _plain(df: DataFrame, scope: Scope, query: A.Query, selections: list[A.Select]) -> DataFrame:
    if query.having is not None:
        raise ValueError("HAVING needs a grouping or an aggregate")
    # computed selections, so that others, sorts and functions can name them
    named = {}
    for s in selections:
        if s.alias and not _is_field(s.expr):
            named[s.name] = s.expr
    resolved = scope
    for name, expr in named.items():
        column = scalar(expr, resolved)
        kind = df.select(column.alias(name)).schema[0].dataType
        resolved = replace(resolved, aliases={**resolved.aliases, name: as_value(column, kind)})
    by_alias = {s.name: s.expr for s in selections}
    keys: list[tuple[Value | Column, A.Order]] = []
    for k in _sort_keys(query):
        expr = k.expr
        if isinstance(expr, A.Ident) and expr.name.replace(".", "_dot_") in by_alias:
            expr = by_alias[expr.name.replace(".", "_dot_")]
        keys.append((scope.resolve(expr) if _is_field(expr) else scalar(expr, resolved), k.order))
    if keys:
        df = df.orderBy(*_ordered(keys))
    df = _paged(df, query.page)
    if not selections:
        hidden = [name for name, _ in scope.unnested.values()]
        if not scope.nested:  # an unnested column is its element
            for path, (name, _) in scope.unnested.items():
                if ".".join(path) in df.columns:
                    df = df.withColumn(".".join(path), F.col(name))
        return df.drop(*hidden)
    return df.select(*[_column(s.expr, scope if _is_field(s.expr) else resolved).alias(s.name) for s in selections])


# ---- grouping ------------------------------------------------------------------------------------


def _key(value: Value) -> tuple[Column, bool]:
    """A column to group by, and whether it is the text of untyped JSON (numbers in one form)."""
    if value.type is not None:
        return value.column, False
    return canonical(value.column), True


def _grouped(df: DataFrame, scope: Scope, query: A.Query, selections: list[A.Select]) -> DataFrame:
    computed = {s.name: s.expr for s in selections if not _is_field(s.expr) and not isinstance(s.expr, A.Agg)}
    fields = {s.name: s.expr for s in selections if _is_field(s.expr)}
    keys: dict[str, tuple[str, bool]] = {}  # expression as text -> (column, is JSON text)
    columns: list[Column] = []
    for expr in query.group_by:
        target = expr
        if isinstance(expr, A.Ident) and expr.name in computed:
            target = computed[expr.name]  # the alias of a selected function
        elif isinstance(expr, A.Ident) and expr.name in fields:
            target = fields[expr.name]
        if str(target) in keys:
            keys[str(expr)] = keys[str(target)]
            continue
        column, text = _key(scope.resolve(target)) if _is_field(target) else (scalar(target, scope), False)
        name = f"_k{len(columns)}"
        columns.append(column.alias(name))
        keys[str(target)] = keys[str(expr)] = (name, text)
    aggregates: dict[str, tuple[str, Column]] = {}

    def hold(agg: A.Agg) -> str:
        if str(agg) not in aggregates:
            aggregates[str(agg)] = (f"_a{len(aggregates)}", aggregate(agg, scope))
        return aggregates[str(agg)][0]

    for s in selections:
        if isinstance(s.expr, A.Agg):
            hold(s.expr)
    aliases = {s.name: s.expr for s in selections}

    def after(expr: A.Expr) -> str | None:
        """The grouped frame's column for a selection alias, key or aggregate."""
        if isinstance(expr, A.Ident) and expr.name in aliases and str(expr) not in keys:
            return after(aliases[expr.name]) if aliases[expr.name] != expr else None
        if isinstance(expr, A.Agg):
            return hold(expr)
        return keys[str(expr)][0] if str(expr) in keys else None

    for part in _names(query.having):
        if isinstance(part, A.Agg):
            hold(part)
    for k in query.order_by:
        if isinstance(k.expr, A.Agg):
            hold(k.expr)
    made = [c.alias(n) for n, c in aggregates.values()]
    if columns:
        out = df.groupBy(*columns).agg(*made) if made else df.select(*columns).distinct()
    else:
        out = df.agg(*made)
    if query.having is not None:
        seen = {}
        for part in _names(query.having):
            name = after(part)
            if name is None:
                raise ValueError(f"{part} is neither grouped nor aggregated")
            seen[str(part)] = as_value(F.col(name), out.schema[name].dataType)
        out = out.filter(predicate(_renamed(query.having, seen), _Grouped(out.schema, False, scope.key, aliases=seen), having=True))
    order: list[tuple[Value | Column, A.Order]] = []
    for k in _sort_keys(query):
        name = after(k.expr)
        if name is None:
            raise ValueError(f"cannot sort by {k.expr}: it is neither grouped nor aggregated")
        order.append((as_value(F.col(name), out.schema[name].dataType), k.order))
    if order:
        out = out.orderBy(*_ordered(order))
    out = _paged(out, query.page)
    final = []
    if not selections:
        for expr in query.group_by:
            name, text = keys[str(expr)]
            final.append((F.try_parse_json(F.col(name)) if text else F.col(name)).alias(getattr(expr, "name", str(expr)).replace(".", "_dot_")))
        return out.select(*final)
    for s in selections:
        name = after(s.expr)
        if name is None and isinstance(s.expr, A.Const):
            final.append(F.lit(s.expr.value).alias(s.name))
        elif name is not None:  # others cannot be told for a group, and are left out
            text = str(s.expr) in keys and keys[str(s.expr)][1]
            final.append((F.try_parse_json(F.col(name)) if text else F.col(name)).alias(s.name))
    return out.select(*final)


@dataclass(frozen=True)
class _Grouped(Scope):
    """Names of a grouped frame."""

    def resolve(self, expr: A.Expr, whole: bool = False) -> Value:
        return self.aliases[str(expr)]


def _names(p: A.Predicate | None) -> list[A.Expr]:
    """Fields and aggregates that a HAVING names."""
    if p is None:
        return []
    if isinstance(p, (A.And, A.Or)):
        return [n for x in p.parts for n in _names(x)]
    if isinstance(p, A.Not):
        return _names(p.part)
    if isinstance(p, A.Keys):
        raise ValueError("a key filter cannot stand in HAVING")
    if isinstance(p, (A.AnyOf, A.AnyDoc)):
        return [p.source]
    return [x for e in (p.lhs, p.rhs) for x in _leaves(e)]


def _leaves(e: A.Expr) -> list[A.Expr]:
    if isinstance(e, A.Func):
        return [x for a in e.args for x in _leaves(a)]
    return [e] if _is_field(e) or isinstance(e, A.Agg) else []


def _renamed(p: A.Predicate, seen: dict[str, Value]) -> A.Predicate:
    """Aggregates in a HAVING read like fields."""
    if isinstance(p, (A.And, A.Or)):
        return type(p)(*[_renamed(x, seen) for x in p.parts])
    if isinstance(p, A.Not):
        return A.Not(_renamed(p.part, seen))
    if isinstance(p, A.Rel) and isinstance(p.lhs, A.Agg):
        name = f"agg_{len(seen)}"
        seen[name] = seen[str(p.lhs)]
        return A.Rel(A.Ident(name), p.op, p.rhs)
    return p


# ---- documents -----------------------------------------------------------------------------------


def documents(df: DataFrame) -> DataFrame:
    """One JSON text ``document`` per row: nulls left out, dotted names nested again.

    A whole row of a nested collection is its document without ``_id``, with its times.
    """
    if {"id", "document", "created_at", "updated_at"} == set(df.columns):
        inner = F.coalesce(F.try_variant_get("document", "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
        times = F.create_map(*[x for c in ("created_at", "updated_at") for x in (F.lit(c), F.to_variant_object(F.array(F.col(c).cast("string"))))])
        one = F.transform_values(times, lambda k, v: F.try_variant_get(v, "$[0]", "variant"))
        return df.select(F.to_json(F.to_variant_object(F.map_concat(F.map_filter(inner, lambda k, v: k != "_id"), one))).alias("document"))
    tree: dict = {}
    for name in df.columns:
        at = tree
        *above, last = name.replace("_dot_", ".").split(".")
        for part in above:
            at = at.setdefault(part, {})
            if not isinstance(at, dict):
                raise ValueError(f"{name} lies inside another column")
        at[last] = F.col(f"`{name}`")

    def struct(node: dict) -> Column:
        parts = [(struct(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()]
        full = F.struct(*parts)
        below = [c for v in node.values() for c in _flat(v)]
        some = below[0].isNotNull()
        for c in below[1:]:
            some = some | c.isNotNull()
        return F.when(some, full)

    return df.select(F.coalesce(F.to_json(struct(tree)), F.lit("{}")).alias("document"))


def _flat(v: dict | Column) -> list[Column]:
    return [c for x in v.values() for c in _flat(x)] if isinstance(v, dict) else [v]
