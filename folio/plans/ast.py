"""The query model: immutable nodes that check themselves when they are made."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field
from enum import Enum
from typing import Any

# What identifiers may look like and how long they may be.
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_\[\]-]*(\.[A-Za-z0-9_][A-Za-z0-9_\[\]-]*)*$")
_MAX_NAME, _MAX_FIELD, _MAX_DEPTH = 63, 100, 10


class DataType(Enum):
    """Canonical types and the Spark types they read as."""

    UNSPECIFIED = None
    STRING = "string"
    INTEGER = "int"
    LONG = "bigint"
    FLOAT = "float"
    DOUBLE = "double"
    BOOLEAN = "boolean"
    JSON = "variant"
    TIMESTAMPTZ = "timestamp"
    DATE = "date"


class JsonType(Enum):
    """Types of a field inside a JSON column."""

    STRING = "string"
    NUMBER = "double"
    BOOLEAN = "boolean"
    STRING_ARRAY = "array<string>"
    NUMBER_ARRAY = "array<double>"
    BOOLEAN_ARRAY = "array<boolean>"
    OBJECT_ARRAY = "array<variant>"
    OBJECT = "variant"
    UNSPECIFIED = None

    @property
    def is_array(self) -> bool:
        return bool(self.value) and self.value.startswith("array")


class Op(Enum):
    EQ = "="
    NEQ = "!="
    GT = ">"
    LT = "<"
    GTE = ">="
    LTE = "<="
    IN = "IN"
    NOT_IN = "NOT IN"
    CONTAINS = "CONTAINS"
    NOT_CONTAINS = "NOT CONTAINS"
    EXISTS = "EXISTS"
    NOT_EXISTS = "NOT EXISTS"
    LIKE = "LIKE"
    STARTS_WITH = "STARTS WITH"


class Aggregate(Enum):
    COUNT = "COUNT"
    SUM = "SUM"
    AVG = "AVG"
    MIN = "MIN"
    MAX = "MAX"
    DISTINCT_COUNT = "DISTINCT_COUNT"
    DISTINCT_ARRAY = "DISTINCT_ARRAY"
    DISTINCT = "DISTINCT"
    LAST = "LAST"


class Function(Enum):
    ADD = "ADD"
    SUBTRACT = "SUBTRACT"
    MULTIPLY = "MULTIPLY"
    DIVIDE = "DIVIDE"
    ABS = "ABS"
    FLOOR = "FLOOR"
    LENGTH = "LENGTH"
    TO_LOWER_CASE = "TO_LOWER_CASE"


class Order(Enum):
    ASC = "ASC"
    DESC = "DESC"


def check_name(name: str) -> str:
    if not isinstance(name, str) or not name.strip():
        raise ValueError("identifier is blank")
    if len(name) > _MAX_NAME or not _NAME.match(name):
        raise ValueError(f"not a valid identifier: {name!r}")
    return name


class Expr:
    """Any node that yields a value."""


class Predicate:
    """Any node that yields true, false or null."""


@dataclass(frozen=True)
class Ident(Expr):
    """A field: a dotted path in a nested collection, a column in a flat one."""

    name: str
    type: DataType = DataType.UNSPECIFIED

    def __post_init__(self) -> None:
        check_name(self.name)

    def __str__(self) -> str:
        return self.name


@dataclass(frozen=True)
class ArrayIdent(Ident):
    """A field known to hold an array of ``type``."""


@dataclass(frozen=True)
class JsonIdent(Expr):
    """A path inside a JSON column of a flat collection."""

    column: str
    type: JsonType
    path: tuple[str, ...]

    def __init__(self, column: str, type: JsonType | None, *path: str):  # noqa: A002
        check_name(column)
        if not path or len(path) > _MAX_DEPTH:
            raise ValueError(f"a JSON path has 1 to {_MAX_DEPTH} parts")
        for p in path:
            if not isinstance(p, str) or not p.strip() or len(p) > _MAX_FIELD or not re.match(r"^[A-Za-z0-9_][A-Za-z0-9_ -]*$", p):
                raise ValueError(f"not a valid JSON field: {p!r}")
        object.__setattr__(self, "column", column)
        object.__setattr__(self, "type", type or JsonType.UNSPECIFIED)
        object.__setattr__(self, "path", tuple(path))

    @property
    def name(self) -> str:
        return ".".join((self.column, *self.path))

    def __str__(self) -> str:
        return self.name


@dataclass(frozen=True)
class AliasedIdent(Expr):
    """A column of a joined sub-query, by the sub-query's alias."""

    name: str
    context: str

    def __post_init__(self) -> None:
        check_name(self.name)
        check_name(self.context)

    def __str__(self) -> str:
        return f"{self.context}.{self.name}"


@dataclass(frozen=True)
class Const(Expr):
    """A string, number, boolean, date, None, or a non-empty list of one of these kinds."""

    value: Any

    def __post_init__(self) -> None:
        v = self.value
        if isinstance(v, (list, tuple, set, frozenset)):
            items = tuple(v)
            if not items:
                raise ValueError("a constant list must not be empty")
            kinds = {bool if isinstance(x, bool) else float if isinstance(x, (int, float)) else type(x) for x in items}
            if len(kinds) > 1 or not kinds <= {bool, float, str, dt.date, dt.datetime}:
                raise ValueError("a constant list holds strings, numbers or booleans of one kind")
            object.__setattr__(self, "value", items)
        elif not (v is None or isinstance(v, (str, int, float, bool, dt.date, dt.datetime))):
            raise ValueError(f"not a constant: {v!r}")

    def __str__(self) -> str:
        return repr(self.value)


@dataclass(frozen=True)
class DocConst(Expr):
    """A JSON document as a constant."""

    json: str

    @staticmethod
    def of(value: dict) -> DocConst:
        import json

        return DocConst(json.dumps(value))


@dataclass(frozen=True)
class Agg(Expr):
    """``order_by`` matters to LAST alone: the field whose largest value marks the last row."""

    op: Aggregate
    arg: Expr
    order_by: Ident | None = None

    def __post_init__(self) -> None:
        if isinstance(self.arg, Agg):
            raise ValueError("an aggregate of an aggregate is not allowed")

    def __str__(self) -> str:
        return f"{self.op.value}({self.arg})"


@dataclass(frozen=True)
class Func(Expr):
    op: Function
    args: tuple[Expr, ...]

    def __init__(self, op: Function, *args: Expr):
        single = op in (Function.ABS, Function.FLOOR, Function.LENGTH, Function.TO_LOWER_CASE)
        if (single and len(args) != 1) or (not single and len(args) < 2):
            raise ValueError(f"{op.value} got {len(args)} operands")
        object.__setattr__(self, "op", op)
        object.__setattr__(self, "args", tuple(args))

    def __str__(self) -> str:
        return f"{self.op.value}({', '.join(map(str, self.args))})"


@dataclass(frozen=True)
class Rel(Predicate):
    lhs: Expr
    op: Op
    rhs: Expr

    def __init__(self, lhs: Expr | str, op: Op, rhs: Any):
        object.__setattr__(self, "lhs", Ident(lhs) if isinstance(lhs, str) else lhs)
        object.__setattr__(self, "op", op)
        object.__setattr__(self, "rhs", rhs if isinstance(rhs, Expr) else Const(rhs))

    def __str__(self) -> str:
        return f"{self.lhs} {self.op.value} {self.rhs}"


@dataclass(frozen=True)
class And(Predicate):
    parts: tuple[Predicate, ...]

    def __init__(self, *parts: Predicate):
        if len(parts) < 2:
            raise ValueError("AND takes at least two operands")
        object.__setattr__(self, "parts", tuple(parts))

    def __str__(self) -> str:
        return "(" + " AND ".join(map(str, self.parts)) + ")"


@dataclass(frozen=True)
class Or(Predicate):
    parts: tuple[Predicate, ...]

    def __init__(self, *parts: Predicate):
        if len(parts) < 2:
            raise ValueError("OR takes at least two operands")
        object.__setattr__(self, "parts", tuple(parts))

    def __str__(self) -> str:
        return "(" + " OR ".join(map(str, self.parts)) + ")"


@dataclass(frozen=True)
class Not(Predicate):
    part: Predicate

    def __str__(self) -> str:
        return f"NOT ({self.part})"


@dataclass(frozen=True)
class Keys(Predicate):
    """Rows whose primary key is one of ``keys``."""

    keys: tuple[str, ...]

    def __init__(self, *keys: Any):
        if not keys:
            raise ValueError("a key filter needs a key")
        object.__setattr__(self, "keys", tuple(str(k) for k in keys))


@dataclass(frozen=True)
class AnyOf(Predicate):
    """Some element of a primitive array satisfies ``filter``; the array's own name means the element."""

    source: Expr
    filter: Predicate


@dataclass(frozen=True)
class AnyDoc(Predicate):
    """Some element of an array of documents satisfies ``filter``, whose names are fields of the element."""

    source: Expr
    filter: Predicate


@dataclass(frozen=True)
class Unnest:
    field: Expr
    preserve_empty: bool = False
    filter: Predicate | None = None

    def __post_init__(self) -> None:
        if not isinstance(self.field, (Ident, JsonIdent)):
            raise ValueError("only fields can be unnested")


@dataclass(frozen=True)
class SelfJoin:
    """Inner join of the collection with a sub-query over itself."""

    query: Query
    alias: str
    condition: Predicate

    def __post_init__(self) -> None:
        check_name(self.alias)


@dataclass(frozen=True)
class Select:
    expr: Expr
    alias: str | None = None

    def __post_init__(self) -> None:
        if self.alias is not None:
            check_name(self.alias)
        elif not isinstance(self.expr, (Ident, JsonIdent, AliasedIdent)):
            raise ValueError(f"{self.expr} needs an alias")

    @property
    def name(self) -> str:
        return (self.alias or self.expr.name).replace(".", "_dot_")


@dataclass(frozen=True)
class SortKey:
    expr: Expr
    order: Order = Order.ASC


@dataclass(frozen=True)
class Page:
    limit: int
    offset: int = 0

    def __post_init__(self) -> None:
        if self.limit is None or self.offset is None or self.limit < 0 or self.offset < 0:
            raise ValueError("limit and offset must be 0 or more")


@dataclass(frozen=True)
class Query:
    select: tuple[Select, ...] = ()
    where: Predicate | None = None
    group_by: tuple[Expr, ...] = ()
    having: Predicate | None = None
    order_by: tuple[SortKey, ...] = ()
    page: Page | None = None
    source: tuple[Unnest | SelfJoin, ...] = field(default=())

    def __str__(self) -> str:
        out = ["SELECT " + (", ".join(f"{s.expr} AS {s.name}" for s in self.select) or "*")]
        if self.source:
            out.append("FROM " + ", ".join(type(s).__name__ for s in self.source))
        for word, part in (("WHERE", self.where), ("GROUP BY", ", ".join(map(str, self.group_by))), ("HAVING", self.having)):
            if part:
                out.append(f"{word} {part}")
        if self.order_by:
            out.append("ORDER BY " + ", ".join(f"{k.expr} {k.order.value}" for k in self.order_by))
        if self.page:
            out.append(f"OFFSET {self.page.offset} LIMIT {self.page.limit}")
        return " ".join(out)
