"""Sub-document updates as Columns, on typed columns and on JSON documents alike."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from enum import Enum
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators.fields import json_path

# Paths of sub-documents, and fields that only the store writes.
_PATH = re.compile(r"^[A-Za-z0-9_][A-Za-z0-9_-]*(\.[A-Za-z0-9_][A-Za-z0-9_-]*)*$")
_OWN = ("createdTime", "lastUpdatedTime")


class UpdateOp(Enum):
    SET = "SET"
    UNSET = "UNSET"
    ADD = "ADD"
    APPEND_TO_LIST = "APPEND_TO_LIST"
    ADD_TO_LIST_IF_ABSENT = "ADD_TO_LIST_IF_ABSENT"
    REMOVE_ALL_FROM_LIST = "REMOVE_ALL_FROM_LIST"


@dataclass(frozen=True)
class Update:
    path: str
    op: UpdateOp
    value: Any = None

    def __post_init__(self) -> None:
        if not _PATH.match(self.path or "") or self.path.split(".")[0] in _OWN:
            raise ValueError(f"not a path that can be updated: {self.path!r}")
        if self.op is UpdateOp.ADD and (isinstance(self.value, bool) or not isinstance(self.value, (int, float))):
            raise TypeError("ADD takes a number")
        if self.op in (UpdateOp.APPEND_TO_LIST, UpdateOp.ADD_TO_LIST_IF_ABSENT, UpdateOp.REMOVE_ALL_FROM_LIST) and not isinstance(self.value, (list, tuple)):
            raise TypeError(f"{self.op.value} takes a list")


def validate(updates: list[Update]) -> None:
    if not updates:
        raise ValueError("no updates given")
    paths = sorted(u.path.split(".") for u in updates)
    for a, b in zip(paths, paths[1:], strict=False):
        if b[: len(a)] == a:
            raise ValueError(f"updates of one hierarchy: {'.'.join(a)} and {'.'.join(b)}")


def _variant(value: Any) -> Column:
    return F.parse_json(F.lit(json.dumps(value)))


def _on_variant(old: Column, u: Update) -> Column:
    """The new variant at the path's end; null means that the field goes."""
    if u.op is UpdateOp.SET:
        return _variant(u.value)
    if u.op is UpdateOp.UNSET:
        return F.lit(None).cast("variant")
    if u.op is UpdateOp.ADD:
        whole = F.try_variant_get(old, "$", "bigint")
        double = F.try_variant_get(old, "$", "double")
        total = F.coalesce(double, F.lit(0.0)) + float(u.value)
        if isinstance(u.value, int):
            integral = F.when(double.isNull() | (double == whole), F.coalesce(whole, F.lit(0)) + u.value)
            return F.when(integral.isNotNull(), integral.cast("variant")).otherwise(total.cast("variant"))
        return total.cast("variant")
    items = F.try_variant_get(old, "$", "array<variant>")
    known = F.coalesce(items, F.array().cast("array<variant>"))
    wanted = F.array(*[_variant(v) for v in u.value]) if u.value else F.array().cast("array<variant>")
    texts = [json.dumps(v, separators=(",", ":")) for v in u.value]
    # equality of JSON values goes by their canonical text
    canon = lambda c: F.to_json(c)
    if u.op is UpdateOp.APPEND_TO_LIST:
        return F.to_variant_object(F.concat(known, wanted))
    if u.op is UpdateOp.ADD_TO_LIST_IF_ABSENT:
        seen = F.transform(known, canon)
        fresh = [v for i, v in enumerate(u.value) if texts[i] not in texts[:i]]
        missing = F.filter(F.array(*[_variant(v) for v in fresh]) if fresh else wanted, lambda x: ~F.array_contains(seen, canon(x)))
        return F.to_variant_object(F.concat(known, missing))
    gone = F.transform(wanted, canon)
    left = F.to_variant_object(F.filter(items, lambda x: ~F.array_contains(gone, canon(x))))
    return F.when(items.isNotNull(), left).otherwise(old)


def update_variant(document: Column, updates: list[tuple[tuple[str, ...], Update]]) -> Column:
    """The document with all updates, each at its path; parents are made where they lack.

    The paths form one tree and every object on them is rebuilt once, so the expression grows with
    the number of path parts.
    """
    tree: dict = {}
    for path, u in updates:
        at = tree
        for part in path[:-1]:
            at = at.setdefault(part, {})
        at[path[-1]] = u
    return _rebuilt(document, (), tree)[0]


def _rebuilt(document: Column, path: tuple[str, ...], tree: dict) -> tuple[Column, Column]:
    """The value at ``path`` with the updates of ``tree`` below it, and whether any of them has anything to do."""
    at = lambda p: F.try_variant_get(document, json_path(p), "variant") if p else document
    entries, acts = [], []
    for head, u in tree.items():
        own = (*path, head)
        if isinstance(u, Update):
            new = _on_variant(at(own), u)
            # nothing there, nothing to take away
            acts.append(at(own).isNotNull() if u.op in (UpdateOp.UNSET, UpdateOp.REMOVE_ALL_FROM_LIST) else F.lit(True))
        else:
            new, act = _rebuilt(document, own, u)
            acts.append(act)
        entries.append(F.struct(F.lit(head).alias("key"), new.alias("value")))
    fields = F.coalesce(F.try_variant_get(document, json_path(path), "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    others = F.map_filter(fields, lambda k, v: ~k.isin(list(tree)))
    made = F.map_from_entries(F.filter(F.array(*entries), lambda x: x["value"].isNotNull()))
    acts_any = reduce(Column.__or__, acts)
    return F.when(acts_any, F.to_variant_object(F.map_concat(others, made))).otherwise(at(path)), acts_any


def _on_column(old: Column, kind: T.DataType, u: Update) -> Column:
    if u.op is UpdateOp.SET:
        return F.lit(u.value).cast(kind) if not isinstance(u.value, (list, tuple, dict)) else F.from_json(F.lit(json.dumps(u.value)), kind)
    if u.op is UpdateOp.UNSET:
        return F.lit(None).cast(kind)
    if u.op is UpdateOp.ADD:
        if not isinstance(kind, T.NumericType):
            raise TypeError(f"ADD on a column of type {kind.simpleString()}")
        return (F.coalesce(old, F.lit(0)) + F.lit(u.value)).cast(kind)
    if not isinstance(kind, T.ArrayType):
        raise TypeError(f"{u.op.value} on a column of type {kind.simpleString()}")
    values = F.array(*map(F.lit, u.value)).cast(kind)
    known = F.coalesce(old, F.array().cast(kind))
    if u.op is UpdateOp.APPEND_TO_LIST:
        return F.concat(known, values)
    if u.op is UpdateOp.ADD_TO_LIST_IF_ABSENT:
        return F.concat(known, F.array_except(F.array_distinct(values), known))
    return F.filter(old, lambda x: ~F.array_contains(values, x))


def _on_struct(column: Column, kind: T.StructType, path: tuple[str, ...], u: Update) -> Column:
    head, rest = path[0], path[1:]
    if head not in kind.fieldNames():
        raise ValueError(f"no field {head}")
    inner = kind[head].dataType
    whole = F.coalesce(column, F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields]))
    if not rest:
        return whole.withField(f"`{head}`", _on_column(column.getField(head), inner, u))
    return whole.withField(f"`{head}`", _on_struct(column.getField(head), inner, rest, u))


def updated_columns(schema: T.StructType, updates: list[Update], nested: bool) -> dict[str, Column]:
    """New values of the columns that the updates touch."""
    validate(updates)
    if nested:
        return {"document": update_variant(F.col("document"), [(tuple(u.path.split(".")), u) for u in updates])}
    out: dict[str, Column] = {}
    inside: dict[str, list[tuple[tuple[str, ...], Update]]] = {}
    for u in updates:
        if u.path in schema.fieldNames():
            out[u.path] = _on_column(F.col(f"`{u.path}`"), schema[u.path].dataType, u) if not isinstance(schema[u.path].dataType, T.VariantType) else _on_variant(F.col(f"`{u.path}`"), u)
            continue
        column, *rest = u.path.split(".")
        if column not in schema.fieldNames():
            raise ValueError(f"no column {column}")
        kind, old = schema[column].dataType, out.get(column, F.col(f"`{column}`"))
        if isinstance(kind, T.VariantType):
            inside.setdefault(column, []).append((tuple(rest), u))
        elif isinstance(kind, T.StructType):
            out[column] = _on_struct(old, kind, tuple(rest), u)
        else:
            raise ValueError(f"{column} has no fields")
    return out | {c: update_variant(F.col(f"`{c}`"), own) for c, own in inside.items()}


def apply_updates(df: DataFrame, updates: list[Update], condition: Column | None = None, nested: bool = False) -> DataFrame:
    """All rows, with the updates applied where ``condition`` holds (null counts as no)."""
    changed = updated_columns(df.schema, updates, nested)
    if condition is not None:
        hit = F.coalesce(condition, F.lit(False))
        changed = {c: F.when(hit, v).otherwise(F.col(f"`{c}`")) for c, v in changed.items()}
    return df.withColumns(changed)
