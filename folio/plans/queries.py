"""Registered queries: each operator of the query model over the test tables, with SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.metrics import custom_metric
from folio.operators.updates import Update, UpdateOp, apply_updates
from folio.plans.ast import (
    Agg,
    Aggregate,
    AliasedIdent,
    And,
    AnyDoc,
    AnyOf,
    ArrayIdent,
    Const,
    DataType,
    DocConst,
    Func,
    Function,
    Ident,
    JsonIdent,
    JsonType,
    Keys,
    Not,
    Op,
    Or,
    Order,
    Page,
    Query,
    Rel,
    Select,
    SelfJoin,
    SortKey,
    Unnest,
)
from folio.plans.compiler import Source, compile_query, count_query, documents
from folio.plans.legacy import LegacyFilter, LegacyOp, LegacyOrder, LegacyQuery, translate

KEYS = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "nation": "n_nationkey", "region": "r_regionkey", "supplier": "s_suppkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id"}
I = Ident  # noqa: E741
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def flat(spark: SparkSession, sf_dir: str, name: str) -> Source:
    return Source(spark.read.parquet(f"{sf_dir}/{name}.parquet"), key=KEYS.get(name, "id"))


def order_items(spark: SparkSession, sf_dir: str) -> Source:
    """Orders with their lines as an array of structs and the return flags as an array of strings; orders without lines have none."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", F.struct("l_linenumber", "l_quantity", "l_returnflag", "l_shipdate").alias("item"))
    items = line.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("item")).alias("items"), F.array_sort(F.collect_set("item.l_returnflag")).alias("flags"))
    return Source(orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey"), key="o_orderkey")


def nested_orders(spark: SparkSession, sf_dir: str) -> Source:
    """The same as schemaless documents."""
    flat_rows = order_items(spark, sf_dir).df
    doc = F.parse_json(F.to_json(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.struct(F.col("o_totalprice").alias("total"), F.col("o_custkey").alias("cust")).alias("money"), F.transform("items", lambda x: F.struct(x["l_linenumber"].alias("no"), x["l_quantity"].alias("qty"), x["l_returnflag"].alias("flag"))).alias("items"), "flags")))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return Source(flat_rows.select(F.col("o_orderkey").cast("string").alias("id"), doc.alias("document"), now.alias("created_at"), now.alias("updated_at")), nested=True)


def register(name: str, source: str | Callable[[SparkSession, str], Source], query: Query, sql: str, shape: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = flat(spark, sf_dir, source) if isinstance(source, str) else source(spark, sf_dir)
        return shape(compile_query(query, src))

    QUERIES[name], ORACLES[name] = run, sql


def cols(*names: str) -> tuple[Select, ...]:
    return tuple(Select(I(n)) for n in names)


def agg(op: Aggregate, arg: str | object, alias: str, **kw: object) -> Select:
    return Select(Agg(op, I(arg) if isinstance(arg, str) else arg, **kw), alias)


def rounded(*names: str, digits: int = 2) -> Callable[[DataFrame], DataFrame]:
    return lambda d: d.withColumns({n: F.round(F.col(n), digits) for n in names})


# ---- flagship ------------------------------------------------------------------------------------

REVENUE = Func(Function.MULTIPLY, I("l_extendedprice"), I("l_discount"))
FLAGSHIP = Query(
    select=(*cols("l_returnflag", "l_linestatus"), agg(Aggregate.SUM, REVENUE, "discounts"), agg(Aggregate.SUM, "l_quantity", "quantity"), agg(Aggregate.AVG, "l_extendedprice", "avg_price"), agg(Aggregate.COUNT, Const(1), "lines")),
    where=Rel("l_quantity", Op.GT, 5),
    group_by=(I("l_returnflag"), I("l_linestatus")),
    having=Rel("lines", Op.GT, 10),
    order_by=(SortKey(I("l_returnflag")), SortKey(I("l_linestatus"))),
)
register(
    "flagship_discounts", "lineitem", FLAGSHIP,
    "SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice * l_discount), 2) AS discounts, round(sum(l_quantity), 2) AS quantity, round(avg(l_extendedprice), 2) AS avg_price, count(*) AS lines FROM lineitem WHERE l_quantity > 5 GROUP BY 1, 2 HAVING count(*) > 10",
    rounded("discounts", "quantity", "avg_price"),
)

# ---- projection ----------------------------------------------------------------------------------

register("select_all", "nation", Query(), "SELECT * FROM nation")
register("select_alias", "nation", Query(select=(Select(I("n_name"), "name"), Select(I("n_regionkey"), "region"), Select(I("n_name"), "name"))), "SELECT n_name AS name, n_regionkey AS region FROM nation")
register("select_constant", "region", Query(select=(*cols("r_name"), Select(Const("x"), "mark"), Select(Const(7), "seven"))), "SELECT r_name, 'x' AS mark, CAST(7 AS INTEGER) AS seven FROM region")
register("select_group_key_only", "orders", Query(select=(*cols("o_orderstatus", "o_orderkey"), agg(Aggregate.COUNT, "o_orderkey", "n")), group_by=(I("o_orderstatus"),)), "SELECT o_orderstatus, count(o_orderkey) AS n FROM orders GROUP BY 1")
register("select_nested_documents", "supplier", Query(select=(Select(I("s_suppkey"), "supplier.key"), Select(I("s_name"), "supplier.name"), Select(I("s_nationkey"), "nation"))), "SELECT '{\"supplier\":{\"key\":' || s_suppkey || ',\"name\":\"' || s_name || '\"},\"nation\":' || s_nationkey || '}' AS document FROM supplier", documents)

# ---- filters -------------------------------------------------------------------------------------

_ORDER = cols("o_orderkey", "o_totalprice")
for _name, _op, _sql in (("eq", Op.EQ, "="), ("neq", Op.NEQ, "<>"), ("gt", Op.GT, ">"), ("lt", Op.LT, "<"), ("gte", Op.GTE, ">="), ("lte", Op.LTE, "<=")):
    register(f"flt_{_name}", "part", Query(select=cols("p_partkey", "p_size"), where=Rel("p_size", _op, 20)), f"SELECT p_partkey, p_size FROM part WHERE p_size {_sql} 20")
register("flt_in", "orders", Query(select=_ORDER, where=Rel("o_orderstatus", Op.IN, ["F", "P"])), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P')")
register("flt_not_in", "orders", Query(select=_ORDER, where=Rel("o_orderstatus", Op.NOT_IN, ["F", "P"])), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IS NULL OR NOT o_orderstatus IN ('F', 'P')")
register("flt_key", "orders", Query(select=_ORDER, where=Keys(1, 7, 32)), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 7, 32)")
register("flt_like", "part", Query(select=cols("p_partkey", "p_name"), where=Rel("p_name", Op.LIKE, "A.*E")), "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'A.*E', 'i')")
register("flt_starts_with", "part", Query(select=cols("p_partkey", "p_type"), where=Rel("p_type", Op.STARTS_WITH, "S")), "SELECT p_partkey, p_type FROM part WHERE starts_with(p_type, 'S')")
register(
    "flt_and_or_not", "lineitem",
    Query(select=cols("l_orderkey", "l_linenumber"), where=And(Or(Rel("l_returnflag", Op.EQ, "R"), Rel("l_quantity", Op.LT, 10)), Not(Rel("l_linestatus", Op.EQ, "O")))),
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_returnflag = 'R' OR l_quantity < 10) AND NOT (l_linestatus = 'O')",
)
register("flt_func_lhs", "lineitem", Query(select=cols("l_orderkey", "l_linenumber"), where=Rel(Func(Function.MULTIPLY, I("l_extendedprice"), I("l_discount")), Op.GT, 3000)), "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_extendedprice * l_discount > 3000")
register("flt_field_to_field", "lineitem", Query(select=cols("l_orderkey", "l_linenumber"), where=Rel("l_discount", Op.GT, I("l_tax"))), "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > l_tax")
register("flt_null_eq", order_items, Query(select=cols("o_orderkey"), where=Rel("items", Op.EQ, None)), "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
register("flt_null_neq", order_items, Query(select=cols("o_orderkey"), where=Rel("items", Op.NEQ, None)), "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
_PROPS = JsonIdent("props", JsonType.NUMBER, "k")
register("flt_exists", "events", Query(select=cols("event_id"), where=Rel(_PROPS, Op.EXISTS, True)), "SELECT event_id FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
register("flt_not_exists", "events", Query(select=cols("event_id"), where=Rel(JsonIdent("props", JsonType.STRING, "none"), Op.NOT_EXISTS, True)), "SELECT event_id FROM events WHERE json_extract_string(props, '$.none') IS NULL")
register("flt_date", "orders", Query(select=cols("o_orderkey"), where=Rel("o_orderdate", Op.GTE, __import__("datetime").datetime(1996, 1, 1))), "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'")

# ---- arrays --------------------------------------------------------------------------------------

_FLAGS = "(SELECT o_orderkey, (SELECT list(DISTINCT l_returnflag ORDER BY l_returnflag) FROM lineitem WHERE l_orderkey = o_orderkey) AS flags FROM orders)"
_KEY = cols("o_orderkey")
register("arr_in", order_items, Query(select=_KEY, where=Rel(ArrayIdent("flags", DataType.STRING), Op.IN, ["A", "R"])), f"SELECT o_orderkey FROM {_FLAGS} WHERE list_has_any(flags, ['A', 'R'])")
register("arr_not_in", order_items, Query(select=_KEY, where=Rel("flags", Op.NOT_IN, ["A", "R"])), f"SELECT o_orderkey FROM {_FLAGS} WHERE flags IS NULL OR NOT list_has_any(flags, ['A', 'R'])")
register("arr_contains", order_items, Query(select=_KEY, where=Rel("flags", Op.CONTAINS, ["A", "N"])), f"SELECT o_orderkey FROM {_FLAGS} WHERE list_has_all(flags, ['A', 'N'])")
register("arr_not_contains", order_items, Query(select=_KEY, where=Rel("flags", Op.NOT_CONTAINS, "A")), f"SELECT o_orderkey FROM {_FLAGS} WHERE flags IS NULL OR NOT list_contains(flags, 'A')")
register("arr_eq_element", order_items, Query(select=_KEY, where=Rel("flags", Op.EQ, "R")), f"SELECT o_orderkey FROM {_FLAGS} WHERE list_contains(flags, 'R')")
register("arr_eq", order_items, Query(select=_KEY, where=Rel("flags", Op.EQ, ["A", "R"])), f"SELECT o_orderkey FROM {_FLAGS} WHERE flags = ['A', 'R']")
register("arr_exists", order_items, Query(select=_KEY, where=Rel("flags", Op.EXISTS, True)), f"SELECT o_orderkey FROM {_FLAGS} WHERE coalesce(len(flags), 0) > 0")
register("arr_any_primitive", order_items, Query(select=_KEY, where=AnyOf(I("flags"), Rel("flags", Op.GT, "N"))), "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag > 'N')")
register(
    "arr_any_document", order_items,
    Query(select=_KEY, where=AnyDoc(I("items"), And(Rel("l_quantity", Op.GT, 45), Rel("l_returnflag", Op.EQ, "R")))),
    "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45 AND l_returnflag = 'R')",
)
register(
    "arr_all_idiom", order_items,
    Query(select=_KEY, where=Not(AnyDoc(I("items"), Not(Rel("l_quantity", Op.GTE, 10))))),
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND NOT l_quantity >= 10)",
)

# ---- functions -----------------------------------------------------------------------------------

_L = cols("l_orderkey", "l_linenumber")


def _fn(name: str, op: Function, args: tuple, sql: str, source: object = "lineitem", keys: tuple = _L, keysql: str = "l_orderkey, l_linenumber", table: str = "lineitem", shape: Callable = rounded("v", digits=4)) -> None:
    register(name, source, Query(select=(*keys, Select(Func(op, *args), "v"))), f"SELECT {keysql}, {sql} AS v FROM {table}", shape)


_fn("fn_add", Function.ADD, (I("l_quantity"), I("l_tax"), Const(1)), "round(l_quantity + l_tax + 1, 4)")
_fn("fn_subtract", Function.SUBTRACT, (I("l_quantity"), I("l_tax")), "round(l_quantity - l_tax, 4)")
_fn("fn_multiply", Function.MULTIPLY, (I("l_quantity"), I("l_tax")), "round(l_quantity * l_tax, 4)")
_fn("fn_divide", Function.DIVIDE, (I("l_extendedprice"), I("l_tax")), "round(CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice / l_tax END, 4)")
_fn("fn_abs", Function.ABS, (Func(Function.SUBTRACT, I("l_tax"), I("l_discount")),), "round(abs(l_tax - l_discount), 4)")
_fn("fn_floor", Function.FLOOR, (I("l_extendedprice"),), "floor(l_extendedprice)")
register("fn_length", order_items, Query(select=(*_KEY, Select(Func(Function.LENGTH, I("items")), "v"))), "SELECT o_orderkey, CAST((SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS INTEGER) AS v FROM orders")
register("fn_lower", "part", Query(select=(*cols("p_partkey"), Select(Func(Function.TO_LOWER_CASE, I("p_name")), "v"))), "SELECT p_partkey, lower(p_name) AS v FROM part")
register("fn_of_alias", "lineitem", Query(select=(*_L, Select(Func(Function.ADD, I("l_quantity"), Const(1)), "more"), Select(Func(Function.MULTIPLY, I("more"), Const(2)), "twice")), page=None), "SELECT l_orderkey, l_linenumber, l_quantity + 1 AS more, (l_quantity + 1) * 2 AS twice FROM lineitem")

# ---- aggregates ----------------------------------------------------------------------------------


def _ag(name: str, select: Select, sql: str, shape: Callable = lambda d: d) -> None:
    register(name, "lineitem", Query(select=(*cols("l_returnflag"), select), group_by=(I("l_returnflag"),)), f"SELECT l_returnflag, {sql} AS v FROM lineitem GROUP BY 1", shape)


_ag("agg_count", agg(Aggregate.COUNT, "l_orderkey", "v"), "count(l_orderkey)")
_ag("agg_sum", agg(Aggregate.SUM, "l_extendedprice", "v"), "round(sum(l_extendedprice), 1)", rounded("v", digits=1))
_ag("agg_avg", agg(Aggregate.AVG, "l_extendedprice", "v"), "round(avg(l_extendedprice), 3)", rounded("v", digits=3))
_ag("agg_min", agg(Aggregate.MIN, "l_shipdate", "v"), "min(l_shipdate)")
_ag("agg_max", agg(Aggregate.MAX, "l_extendedprice", "v"), "max(l_extendedprice)")
_ag("agg_distinct_count", agg(Aggregate.DISTINCT_COUNT, "l_suppkey", "v"), "count(DISTINCT l_suppkey)")
_ag("agg_distinct_array", agg(Aggregate.DISTINCT_ARRAY, "l_linenumber", "v"), "list_sort(list(DISTINCT l_linenumber))")
_ag("agg_distinct", agg(Aggregate.DISTINCT, "l_linestatus", "v"), "list_sort(list(DISTINCT l_linestatus))")
register("agg_last", "orders", Query(select=(*cols("o_custkey"), agg(Aggregate.LAST, "o_totalprice", "v")), group_by=(I("o_custkey"),)), "SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS v FROM orders GROUP BY 1")
register("agg_global", "orders", Query(select=(agg(Aggregate.COUNT, Const(1), "n"), agg(Aggregate.MAX, "o_orderkey", "top"))), "SELECT count(*) AS n, max(o_orderkey) AS top FROM orders")
register("agg_global_empty", "orders", Query(select=(agg(Aggregate.COUNT, Const(1), "n"), agg(Aggregate.SUM, "o_totalprice", "s")), where=Rel("o_orderkey", Op.LT, 0)), "SELECT count(*) AS n, sum(o_totalprice) AS s FROM orders WHERE o_orderkey < 0")
register("agg_group_only", "lineitem", Query(select=cols("l_returnflag", "l_linestatus"), group_by=(I("l_returnflag"), I("l_linestatus"))), "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
register("agg_multi_key", "lineitem", Query(select=(*cols("l_returnflag", "l_linenumber"), agg(Aggregate.COUNT, Const(1), "n")), group_by=(I("l_returnflag"), I("l_linenumber"), I("l_returnflag"))), "SELECT l_returnflag, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2")
register("agg_having", "orders", Query(select=(*cols("o_custkey"), agg(Aggregate.COUNT, Const(1), "n")), group_by=(I("o_custkey"),), having=And(Rel("n", Op.GTE, 12), Rel(Agg(Aggregate.MIN, I("o_totalprice")), Op.GT, 1000))), "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12 AND min(o_totalprice) > 1000")
register("agg_func_operand", "lineitem", Query(select=(*cols("l_returnflag"), agg(Aggregate.SUM, REVENUE, "v")), group_by=(I("l_returnflag"),)), "SELECT l_returnflag, round(sum(l_extendedprice * l_discount), 1) AS v FROM lineitem GROUP BY 1", rounded("v", digits=1))
register("agg_func_group", "orders", Query(select=(Select(Func(Function.FLOOR, Func(Function.DIVIDE, I("o_totalprice"), Const(50000))), "band"), agg(Aggregate.COUNT, Const(1), "n")), group_by=(I("band"),)), "SELECT floor(o_totalprice / 50000) AS band, count(*) AS n FROM orders GROUP BY 1")
register("agg_array_key", order_items, Query(select=(*cols("flags"), agg(Aggregate.COUNT, Const(1), "n")), group_by=(I("flags"),)), f"SELECT flags, count(*) AS n FROM {_FLAGS} GROUP BY 1")

# ---- sort and page -------------------------------------------------------------------------------

register("sort_nulls", order_items, Query(select=_KEY, order_by=(SortKey(I("flags")), SortKey(I("o_orderkey"))), page=Page(40)), f"SELECT o_orderkey FROM {_FLAGS} ORDER BY flags NULLS FIRST, o_orderkey LIMIT 40")
register("sort_not_selected", "customer", Query(select=cols("c_name"), order_by=(SortKey(I("c_acctbal"), Order.DESC), SortKey(I("c_custkey"))), page=Page(25)), "SELECT c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25")
register("page_offset", "customer", Query(select=cols("c_custkey", "c_name"), order_by=(SortKey(I("c_custkey")),), page=Page(10, 20)), "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10 OFFSET 20")
register("page_zero", "customer", Query(select=cols("c_custkey"), page=Page(0)), "SELECT c_custkey FROM customer LIMIT 0")
register("topk", "orders", Query(select=(*cols("o_custkey"), agg(Aggregate.SUM, "o_totalprice", "total")), group_by=(I("o_custkey"),), order_by=(SortKey(I("total"), Order.DESC), SortKey(I("o_custkey"))), page=Page(15)), "SELECT o_custkey, round(sum(o_totalprice), 1) AS total FROM orders GROUP BY 1 ORDER BY sum(o_totalprice) DESC, 1 LIMIT 15", rounded("total", digits=1))

# ---- unnest and join -----------------------------------------------------------------------------

_ITEM = (*_KEY, Select(I("items.l_linenumber"), "no"), Select(I("items.l_quantity"), "qty"))
register("unnest_drop", order_items, Query(select=_ITEM, source=(Unnest(I("items")),)), "SELECT o_orderkey, l_linenumber AS no, l_quantity AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
register("unnest_preserve", order_items, Query(select=_ITEM, source=(Unnest(I("items"), True),)), "SELECT o_orderkey, l_linenumber AS no, l_quantity AS qty FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
register("unnest_filter", order_items, Query(select=_ITEM, source=(Unnest(I("items"), filter=Rel("items.l_quantity", Op.GT, 40)),)), "SELECT o_orderkey, l_linenumber AS no, l_quantity AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_quantity > 40")
register("unnest_where", order_items, Query(select=_ITEM, source=(Unnest(I("items")),), where=And(Rel("o_totalprice", Op.GT, 100000), Rel("items.l_quantity", Op.LTE, 5))), "SELECT o_orderkey, l_linenumber AS no, l_quantity AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_totalprice > 100000 AND l_quantity <= 5")
register("unnest_group", order_items, Query(select=(Select(I("flags"), "flag"), agg(Aggregate.COUNT, Const(1), "n")), source=(Unnest(I("flags")),), group_by=(I("flags"),)), "SELECT flag, count(*) AS n FROM (SELECT DISTINCT o_orderkey, l_returnflag AS flag FROM orders JOIN lineitem ON o_orderkey = l_orderkey) GROUP BY 1")
register("unnest_element_ops", order_items, Query(select=(*_KEY, Select(I("flags"), "flag")), source=(Unnest(I("flags")),), where=And(Rel("flags", Op.IN, ["A", "N"]), Rel("flags", Op.CONTAINS, "A"), Rel("flags", Op.EXISTS, True))), "SELECT DISTINCT o_orderkey, l_returnflag AS flag FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'A'")


def _by_customer(spark: SparkSession, sf_dir: str) -> Source:
    """Customers with an array of orders, each with an array of line quantities."""
    o = order_items(spark, sf_dir).df.select("o_custkey", F.struct("o_orderkey", F.transform("items", lambda x: x["l_quantity"]).alias("quantities")).alias("o"))
    return Source(o.groupBy("o_custkey").agg(F.collect_list("o").alias("orders")), key="o_custkey")


register("unnest_multi", _by_customer, Query(select=(*cols("o_custkey"), Select(I("orders.o_orderkey"), "order_key"), Select(I("orders.quantities"), "qty")), source=(Unnest(I("orders")), Unnest(I("orders.quantities"), True))), "SELECT o_custkey, o_orderkey AS order_key, l_quantity AS qty FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
register(
    "self_join_latest", "orders",
    Query(select=cols("o_custkey", "o_orderkey"), source=(SelfJoin(Query(select=(*cols("o_custkey"), agg(Aggregate.MAX, "o_orderkey", "latest")), group_by=(I("o_custkey"),)), "l", And(Rel("o_custkey", Op.EQ, AliasedIdent("o_custkey", "l")), Rel("o_orderkey", Op.EQ, AliasedIdent("latest", "l")))),)),
    "SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1",
)

# ---- JSON columns and nested collections ---------------------------------------------------------

register("json_path_filter", "events", Query(select=(*cols("event_id"), Select(_PROPS, "k")), where=And(Rel(_PROPS, Op.GTE, 50), Rel(_PROPS, Op.NOT_IN, [60, 70]))), "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS DOUBLE) >= 50 AND CAST(json_extract(props, '$.k') AS DOUBLE) NOT IN (60, 70)")
register("json_path_group", "events", Query(select=(Select(_PROPS, "k"), agg(Aggregate.COUNT, Const(1), "n")), group_by=(_PROPS,)), "SELECT CAST(json_extract(props, '$.k') AS DOUBLE) AS k, count(*) AS n FROM events GROUP BY 1")
register("nested_filter", nested_orders, Query(select=(Select(Ident("key", DataType.LONG), "k"), Select(Ident("money.total", DataType.DOUBLE), "total")), where=And(Rel("money.total", Op.GT, 200000), Rel("status", Op.EQ, "F"))), "SELECT o_orderkey AS k, o_totalprice AS total FROM orders WHERE o_totalprice > 200000 AND o_orderstatus = 'F'")
register("nested_group", nested_orders, Query(select=(Select(Ident("status", DataType.STRING), "status"), agg(Aggregate.AVG, "money.total", "v")), group_by=(Ident("status", DataType.STRING),)), "SELECT o_orderstatus AS status, round(avg(o_totalprice), 2) AS v FROM orders GROUP BY 1", rounded("v"))
register("nested_unnest", nested_orders, Query(select=(Select(Ident("key", DataType.LONG), "k"), Select(Ident("items.qty", DataType.DOUBLE), "qty")), source=(Unnest(I("items")),), where=Rel("items.flag", Op.EQ, "R")), "SELECT o_orderkey AS k, CAST(l_quantity AS DOUBLE) AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'")
register("nested_any", nested_orders, Query(select=(Select(Ident("key", DataType.LONG), "k"),), where=And(AnyDoc(I("items"), Rel("qty", Op.GT, 48)), Rel("flags", Op.CONTAINS, "A"))), "SELECT o_orderkey AS k FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48) AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A')")
register("nested_contains_document", nested_orders, Query(select=(Select(Ident("key", DataType.LONG), "k"),), where=Rel("items", Op.CONTAINS, DocConst.of({"no": 7, "flag": "N"}))), "SELECT o_orderkey AS k FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 7 AND l_returnflag = 'N')")
register("nested_sort", nested_orders, Query(select=(Select(Ident("key", DataType.LONG), "k"),), order_by=(SortKey(I("money.total"), Order.DESC), SortKey(I("key"))), page=Page(20)), "SELECT o_orderkey AS k FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")


# numbers of different length and kind, compared by value
for _name, _op, _sql in (("min", Aggregate.MIN, "min(o_totalprice)"), ("max", Aggregate.MAX, "max(o_totalprice)")):
    register(f"nested_{_name}", nested_orders, Query(select=(Select(Ident("status", DataType.STRING), "status"), agg(_op, "money.total", "v")), group_by=(Ident("status", DataType.STRING),)), f"SELECT o_orderstatus AS status, {_sql} AS v FROM orders GROUP BY 1", lambda d: d.withColumn("v", F.try_variant_get("v", "$", "double")))
register("nested_last", nested_orders, Query(select=(Select(Ident("status", DataType.STRING), "status"), agg(Aggregate.LAST, "key", "v", order_by=I("money.total"))), group_by=(Ident("status", DataType.STRING),)), "SELECT o_orderstatus AS status, arg_max(o_orderkey, o_totalprice) AS v FROM orders GROUP BY 1", lambda d: d.withColumn("v", F.try_variant_get("v", "$", "bigint")))
register("nested_distinct_array", nested_orders, Query(select=(Select(Ident("status", DataType.STRING), "status"), agg(Aggregate.DISTINCT_ARRAY, "money.cust", "v")), group_by=(Ident("status", DataType.STRING),)), "SELECT o_orderstatus AS status, list_sort(list(DISTINCT o_custkey)) AS v FROM orders GROUP BY 1", lambda d: d.withColumn("v", F.transform("v", lambda x: F.try_variant_get(x, "$", "bigint"))))
register("nested_distinct_count", nested_orders, Query(select=(agg(Aggregate.DISTINCT_COUNT, "money.cust", "v"), agg(Aggregate.COUNT, "money.cust", "n"))), "SELECT count(DISTINCT o_custkey) AS v, count(o_custkey) AS n FROM orders")
register("agg_direct_func_key", "orders", Query(select=(agg(Aggregate.COUNT, Const(1), "n"),), group_by=(Func(Function.FLOOR, Func(Function.DIVIDE, I("o_totalprice"), Const(50000))),)), "SELECT count(*) AS n FROM orders GROUP BY floor(o_totalprice / 50000)")
register("sort_function", "customer", Query(select=cols("c_custkey"), order_by=(SortKey(Func(Function.ABS, I("c_acctbal")), Order.DESC), SortKey(I("c_custkey"))), page=Page(30)), "SELECT c_custkey FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 30")
register("sort_aggregate", "orders", Query(select=cols("o_custkey"), group_by=(I("o_custkey"),), order_by=(SortKey(Agg(Aggregate.MAX, I("o_totalprice")), Order.DESC), SortKey(I("o_custkey"))), page=Page(12)), "SELECT o_custkey FROM orders GROUP BY 1 ORDER BY max(o_totalprice) DESC, 1 LIMIT 12")
register("sort_repeated_key", "customer", Query(select=cols("c_custkey"), order_by=(SortKey(I("c_nationkey")), SortKey(I("c_nationkey"), Order.DESC), SortKey(I("c_custkey"))), page=Page(30)), "SELECT c_custkey FROM customer ORDER BY c_nationkey, c_custkey LIMIT 30")


def _with_json(spark: SparkSession, sf_dir: str) -> Source:
    """Orders with their flags as a JSON array in a column."""
    df = order_items(spark, sf_dir).df
    return Source(df.select("o_orderkey", F.parse_json(F.to_json(F.struct(F.col("flags").alias("marks")))).alias("props")), key="o_orderkey")


register("unnest_json_array", _with_json, Query(select=(*_KEY, Select(JsonIdent("props", JsonType.STRING, "marks"), "flag")), source=(Unnest(JsonIdent("props", JsonType.STRING_ARRAY, "marks")),)), "SELECT DISTINCT o_orderkey, l_returnflag AS flag FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
_updated_json = "SELECT o_orderkey AS k, array_to_string(CASE WHEN flags IS NULL THEN {absent} ELSE {there} END, '+') AS flags FROM " + _FLAGS


def _count_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_query(Query(select=(*cols("o_custkey"), agg(Aggregate.COUNT, Const(1), "n")), group_by=(I("o_custkey"),)), flat(spark, sf_dir, "orders"))


QUERIES["count_of_query"], ORACLES["count_of_query"] = _count_of, "SELECT count(*) AS count FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)"


def _legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = flat(spark, sf_dir, "orders")
    f = LegacyFilter(LegacyOp.GT, "o_totalprice", 150000).and_(LegacyFilter(LegacyOp.NEQ, "o_orderstatus", "F"), LegacyFilter(LegacyOp.LIKE, "o_orderpriority", "URGENT|HIGH"))
    return compile_query(translate(LegacyQuery(("o_orderkey", "o_totalprice"), f, (LegacyOrder("o_totalprice", False), LegacyOrder("o_orderkey")), 5, 50), src.df.schema), src)


QUERIES["legacy_search"] = _legacy
ORACLES["legacy_search"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 150000 AND (o_orderstatus IS NULL OR o_orderstatus <> 'F') AND regexp_matches(o_orderpriority, 'URGENT|HIGH', 'i') ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 5"


def _legacy_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = flat(spark, sf_dir, "events")
    f = LegacyFilter(LegacyOp.LT, "props.k", 10).or_(LegacyFilter(LegacyOp.IN, "event_type", ["click"]))
    return compile_query(translate(LegacyQuery(("event_id", "event_type"), f), src.df.schema), src)


QUERIES["legacy_json_path"] = _legacy_json
ORACLES["legacy_json_path"] = "SELECT event_id, event_type FROM events WHERE CAST(json_extract(props, '$.k') AS DOUBLE) < 10 OR event_type IN ('click')"

# ---- updates and merges --------------------------------------------------------------------------


def _updated(name: str, source: Callable, updates: list[Update], sql: str, columns: list[str], where: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = flat(spark, sf_dir, source) if isinstance(source, str) else source(spark, sf_dir)
        return apply_updates(src.df, updates, F.expr(where) if where else None, src.nested).selectExpr(*columns)

    QUERIES[name], ORACLES[name] = run, sql


_updated("upd_set", "orders", [Update("o_orderstatus", UpdateOp.SET, "Z")], "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus FROM orders", ["o_orderkey", "o_orderstatus"], "o_totalprice > 100000")
_updated("upd_unset", "orders", [Update("o_orderpriority", UpdateOp.UNSET)], "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders", ["o_orderkey", "o_orderpriority"], "o_orderstatus = 'F'")
_updated("upd_add", "part", [Update("p_size", UpdateOp.ADD, 5)], "SELECT p_partkey, CAST(CASE WHEN p_size < 10 THEN p_size + 5 ELSE p_size END AS INTEGER) AS p_size FROM part", ["p_partkey", "p_size"], "p_size < 10")
_updated("upd_append", order_items, [Update("flags", UpdateOp.APPEND_TO_LIST, ["A", "Z"])], f"SELECT o_orderkey, list_concat(coalesce(flags, []), ['A', 'Z']) AS flags FROM {_FLAGS}", ["o_orderkey", "flags"])
_updated("upd_add_if_absent", order_items, [Update("flags", UpdateOp.ADD_TO_LIST_IF_ABSENT, ["A", "Z"])], f"SELECT o_orderkey, CASE WHEN flags IS NULL THEN ['A', 'Z'] WHEN list_contains(flags, 'A') THEN list_concat(flags, ['Z']) ELSE list_concat(flags, ['A', 'Z']) END AS flags FROM {_FLAGS}", ["o_orderkey", "flags"])
_updated("upd_remove_all", order_items, [Update("flags", UpdateOp.REMOVE_ALL_FROM_LIST, ["A", "N"])], f"SELECT o_orderkey, list_filter(flags, lambda x: x NOT IN ('A', 'N')) AS flags FROM {_FLAGS}", ["o_orderkey", "flags"])
_updated(
    "upd_nested", nested_orders,
    [Update("money.total", UpdateOp.ADD, 1), Update("new.deep.mark", UpdateOp.SET, "x"), Update("flags", UpdateOp.APPEND_TO_LIST, ["Q"]), Update("status", UpdateOp.UNSET)],
    f"SELECT o_orderkey AS k, round(o_totalprice + 1, 2) AS total, 'x' AS mark, list_concat(coalesce(flags, []), ['Q']) AS flags, CAST(NULL AS VARCHAR) AS status FROM {_FLAGS} JOIN (SELECT o_orderkey, o_totalprice FROM orders) USING (o_orderkey)",
    ["try_variant_get(document, '$.key', 'bigint') AS k", "round(try_variant_get(document, '$.money.total', 'double'), 2) AS total", "try_variant_get(document, '$.new.deep.mark', 'string') AS mark", "try_variant_get(document, '$.flags', 'array<string>') AS flags", "try_variant_get(document, '$.status', 'string') AS status"],
)


_TEXT = ["try_variant_get(document, '$.key', 'bigint') AS k", "array_join(try_variant_get(document, '$.flags', 'array<string>'), '+') AS flags"]
_updated("upd_nested_if_absent", nested_orders, [Update("flags", UpdateOp.ADD_TO_LIST_IF_ABSENT, ["A", "Z"])], _updated_json.format(absent="['A', 'Z']", there="CASE WHEN list_contains(flags, 'A') THEN list_concat(flags, ['Z']) ELSE list_concat(flags, ['A', 'Z']) END"), _TEXT)
_updated("upd_nested_remove_all", nested_orders, [Update("flags", UpdateOp.REMOVE_ALL_FROM_LIST, ["A", "N"])], _updated_json.format(absent="NULL", there="list_filter(flags, lambda x: x NOT IN ('A', 'N'))"), _TEXT)


def _merge(replace_rows: bool) -> Callable[[SparkSession, str], DataFrame]:
    from folio.sources.merge import merge_rows

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = spark.read.parquet(f"{sf_dir}/supplier.parquet")
        new = base.filter("s_suppkey % 3 = 0").select((F.col("s_suppkey") * 2).alias("s_suppkey"), F.lit("new").alias("s_name"), F.lit(None).cast("int").alias("s_nationkey"), F.col("s_acctbal"))
        return merge_rows(base, new, "s_suppkey", keep_missing=not replace_rows)

    return run


_NEW = "(SELECT s_suppkey * 2 AS k, 'new' AS n, s_acctbal AS a FROM supplier WHERE s_suppkey % 3 = 0)"
QUERIES["bulk_upsert_merge"] = _merge(False)
ORACLES["bulk_upsert_merge"] = f"SELECT coalesce(k, s_suppkey) AS s_suppkey, coalesce(n, s_name) AS s_name, s_nationkey, coalesce(a, s_acctbal) AS s_acctbal FROM supplier FULL JOIN {_NEW} ON s_suppkey = k"
QUERIES["create_or_replace"] = _merge(True)
ORACLES["create_or_replace"] = f"SELECT coalesce(k, s_suppkey) AS s_suppkey, CASE WHEN k IS NULL THEN s_name ELSE n END AS s_name, CASE WHEN k IS NULL THEN s_nationkey END AS s_nationkey, CASE WHEN k IS NULL THEN s_acctbal ELSE a END AS s_acctbal FROM supplier FULL JOIN {_NEW} ON s_suppkey = k"


def _deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.sources.merge import delete_rows

    return delete_rows(flat(spark, sf_dir, "part"), Or(Rel("p_size", Op.GT, 40), Rel("p_brand", Op.LIKE, "#1")))


QUERIES["delete_by_filter"] = _deleted
ORACLES["delete_by_filter"] = "SELECT * FROM part WHERE NOT coalesce(p_size > 40 OR regexp_matches(p_brand, '#1', 'i'), false)"


def _metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = Query(select=(agg(Aggregate.COUNT, Const(1), "metric_value"), Select(I("event_type"), "type")), group_by=(I("event_type"),))
    return custom_metric("events_by_type", q, flat(spark, sf_dir, "events")).select("name", "value", F.col("labels")["type"].alias("type"))


QUERIES["metric_rows"] = _metric
ORACLES["metric_rows"] = "SELECT 'events_by_type' AS name, CAST(count(*) AS DOUBLE) AS value, event_type AS type FROM events GROUP BY event_type"
