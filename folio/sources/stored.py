"""Registered queries that open stored collections: every catalogue call, read and write verb, with SQL for its result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.updates import Update, UpdateOp
from folio.plans.ast import Agg, Aggregate, Const, DataType, Ident, Keys, Op, Order, Page, Query, Rel, Select, SortKey
from folio.plans.legacy import LegacyFilter, LegacyOp, LegacyQuery
from folio.sources.collection import Collection, Datastore, DocumentType, MissingDocumentStrategy, ReturnDocument, UpdateOptions, UpdateRequest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def fresh_store(spark: SparkSession) -> Datastore:
    """An empty store below the warehouse, which all executors share."""
    return Datastore(spark, f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/folio-{uuid.uuid4().hex}")


def suppliers(spark: SparkSession, sf_dir: str, name: str = "suppliers") -> Collection:
    """The suppliers as a flat collection."""
    df, store = spark.read.parquet(f"{sf_dir}/supplier.parquet"), fresh_store(spark)
    store.create_collection(name, DocumentType.FLAT, df.schema, "s_suppkey")
    out = store.collection(name)
    out.load(df)
    return out


def customers(spark: SparkSession, sf_dir: str) -> Collection:
    """The customers as documents: name, money (balance), segments (an array), home (nation)."""
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    doc = F.parse_json(F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("money"), F.array("c_mktsegment", F.lit("ALL")).alias("segments"), F.struct(F.col("c_nationkey").alias("nation")).alias("home"))))
    now, out = F.lit("2024-01-01 00:00:00").cast("timestamp"), fresh_store(spark).collection("customers")
    out.load(df.select(F.col("c_custkey").cast("string").alias("id"), doc.alias("document"), now.alias("created_at"), now.alias("updated_at")))
    return out


def fields(df: DataFrame) -> DataFrame:
    """Customer documents as columns, arrays as text."""
    get = lambda path, kind: F.try_variant_get("document", path, kind)
    return df.select("id", get("$.name", "string").alias("name"), F.round(get("$.money", "double"), 2).alias("money"), F.array_join(get("$.segments", "array<string>"), "+").alias("segments"), get("$.home.nation", "bigint").alias("nation"), get("$.mark", "string").alias("mark"))


def told(spark: SparkSession, *facts: tuple[str, object]) -> DataFrame:
    return spark.createDataFrame([(k, str(v)) for k, v in facts], "fact string, value string")


_SUPPLIER = "s_suppkey, s_name, s_nationkey, s_acctbal"
_CUSTOMER = "CAST(c_custkey AS VARCHAR) AS id, c_name AS name, round(c_acctbal, 2) AS money, c_mktsegment || '+ALL' AS segments, CAST(c_nationkey AS BIGINT) AS nation, CAST(NULL AS VARCHAR) AS mark"


def flat_query(name: str, sql: str) -> Callable:
    """Registers a function of a supplier collection; what it returns, or else the content afterwards, is the result."""

    def add(act: Callable[[Collection], DataFrame | None]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            c = suppliers(spark, sf_dir)
            out = act(c)
            return out if isinstance(out, DataFrame) else c.dataframe()

        QUERIES[name], ORACLES[name] = run, sql
        return act

    return add


def nested_query(name: str, sql: str) -> Callable:
    """The same for the customer documents."""

    def add(act: Callable[[Collection], DataFrame | None]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            c = customers(spark, sf_dir)
            out = act(c)
            return fields(c.dataframe()) if not isinstance(out, DataFrame) else fields(out) if "document" in out.columns else out

        QUERIES[name], ORACLES[name] = run, sql
        return act

    return add


# ---- catalogue and reads


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fresh_store(spark)
    made = store.create_collection("first") and store.create_collection("first")
    store.create_collection("area.second")
    store.collection("third")
    listed = "+".join(store.list_collections())
    typed = store.collection_for_type("area.second", DocumentType.NESTED).type.value
    dropped = store.delete_collection("third")
    return told(spark, ("made", made), ("listed", listed), ("typed", typed), ("dropped", dropped), ("left", "+".join(store.list_collections())), ("healthy", store.healthy()))


QUERIES["store_catalogue"] = _catalogue
ORACLES["store_catalogue"] = "SELECT * FROM (VALUES ('made', 'True'), ('listed', 'area.second+first+third'), ('typed', 'NESTED'), ('dropped', 'True'), ('left', 'area.second+first'), ('healthy', 'True')) t(fact, value)"


def _schema_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suppliers(spark, sf_dir, "trade.suppliers").query(Query(where=Rel("s_acctbal", Op.GT, 0)))


QUERIES["store_schema_name"], ORACLES["store_schema_name"] = _schema_name, f"SELECT {_SUPPLIER} FROM supplier WHERE s_acctbal > 0"


@nested_query("store_documents", "SELECT c_custkey AS key, c_name AS name FROM customer WHERE c_acctbal > 5000 ORDER BY c_custkey LIMIT 50")
def _documents(c: Collection) -> DataFrame:
    q = Query(select=(Select(Ident("id"), "key"), Select(Ident("name"))), where=Rel("money", Op.GT, 5000))
    rows = sorted((int(d["key"]), d["name"]) for d in c.iterate(q))[:50]  # every document comes through the iterator
    return c.spark.createDataFrame(rows, "key long, name string")


@nested_query("store_counts", "SELECT (SELECT count(*) FROM customer) AS n, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS some, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS total")
def _counts(c: Collection) -> DataFrame:
    old = LegacyQuery(("name",), LegacyFilter(LegacyOp.LT, "money", 0), (), 3, 1)
    return c.spark.createDataFrame([(c.count(), c.count(Query(where=Rel("money", Op.LT, 0))), c.total(old))], "n long, some long, total long")


@nested_query("store_search", "SELECT c_name AS name FROM customer WHERE c_acctbal < 0")
def _search(c: Collection) -> DataFrame:
    return c.search(LegacyQuery(("name",), LegacyFilter(LegacyOp.LT, "money", 0))).select(F.try_variant_get("name", "$", "string").alias("name"))


@nested_query("store_get", f"SELECT {_CUSTOMER} FROM customer WHERE c_custkey IN (3, 5, 8)")
def _get(c: Collection) -> DataFrame:
    return c.get("3", "5", "8", "none")


@nested_query("store_any_guard", "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE false")
def _any_guard(c: Collection) -> DataFrame:
    from folio.plans.ast import AnyOf

    return c.query(Query(select=(Select(Ident("id")),), where=AnyOf(Ident("name"), Rel("name", Op.EQ, "ALL"))))


@nested_query("store_metrics", "SELECT CAST(count(*) AS DOUBLE) AS value, CAST(c_nationkey AS VARCHAR) AS nation FROM customer GROUP BY c_nationkey")
def _metrics(c: Collection) -> DataFrame:
    q = Query(select=(Select(Agg(Aggregate.COUNT, Const(1)), "metric_value"), Select(Ident("home.nation", DataType.LONG), "nation")), group_by=(Ident("home.nation", DataType.LONG),))
    return c.metrics("by_nation", q).select("value", F.col("labels")["nation"].alias("nation"))


# ---- keyed writes


@flat_query("store_create", f"SELECT {_SUPPLIER} FROM supplier UNION ALL SELECT 900001, 'made', 3, 1.5")
def _create(c: Collection) -> None:
    c.create("900001", {"s_name": "made", "s_nationkey": 3, "s_acctbal": 1.5})


@flat_query("store_create_or_replace", f"SELECT {_SUPPLIER} FROM supplier WHERE s_suppkey <> 4 UNION ALL SELECT 4, 'four', NULL, NULL UNION ALL SELECT 900002, 'new', NULL, 2.0")
def _replace(c: Collection) -> None:
    c.create_or_replace("4", {"s_name": "four"})
    c.create_or_replace("900002", {"s_name": "new", "s_acctbal": 2})


@flat_query("store_create_or_replace_and_return", "SELECT CAST(4 AS BIGINT) AS s_suppkey, 'four' AS s_name, CAST(NULL AS INTEGER) AS s_nationkey, CAST(NULL AS DOUBLE) AS s_acctbal")
def _replace_return(c: Collection) -> DataFrame:
    return c.create_or_replace_and_return("4", {"s_name": "four"})


@nested_query("store_upsert", f"SELECT * REPLACE (CASE WHEN id = '6' THEN 'seen' END AS mark) FROM (SELECT {_CUSTOMER} FROM customer)")
def _upsert(c: Collection) -> None:
    c.upsert("6", {"mark": "seen"})


@nested_query("store_upsert_and_return", f"SELECT * REPLACE ('seen' AS mark, CAST(7 AS DOUBLE) AS money) FROM (SELECT {_CUSTOMER} FROM customer WHERE c_custkey = 6)")
def _upsert_return(c: Collection) -> DataFrame:
    return c.upsert_and_return("6", {"mark": "seen", "money": 7})


@nested_query("store_bulk_upsert", f"SELECT * REPLACE (CASE WHEN id IN ('1', '2') THEN 'bulk' END AS mark) FROM (SELECT {_CUSTOMER} FROM customer) UNION ALL SELECT 'x', NULL, NULL, NULL, NULL, 'bulk'")
def _bulk_upsert(c: Collection) -> None:
    c.bulk_upsert({k: {"mark": "bulk"} for k in ("1", "2", "x")})


@nested_query("store_bulk_upsert_older", f"SELECT {_CUSTOMER} FROM customer WHERE c_custkey IN (1, 2)")
def _bulk_upsert_older(c: Collection) -> DataFrame:
    return c.bulk_upsert_and_return_older({k: {"mark": "bulk"} for k in ("1", "2", "x")})


@flat_query("store_bulk_create_or_replace", f"SELECT {_SUPPLIER} FROM supplier WHERE s_suppkey NOT IN (2, 3) UNION ALL SELECT 2, 'two', NULL, NULL UNION ALL SELECT 3, 'three', NULL, NULL")
def _bulk_replace(c: Collection) -> None:
    c.bulk_create_or_replace({"2": {"s_name": "two"}, "3": {"s_name": "three"}})


@flat_query("store_bulk_create_or_replace_older", f"SELECT {_SUPPLIER} FROM supplier WHERE s_suppkey IN (2, 3)")
def _bulk_replace_older(c: Collection) -> DataFrame:
    return c.bulk_create_or_replace_and_return_older({"2": {"s_name": "two"}, "3": {"s_name": "three"}, "900003": {"s_name": "no"}})


@flat_query("store_update_document", f"SELECT * REPLACE (CASE WHEN s_suppkey = 7 AND s_acctbal > -100000 THEN 'seven' ELSE s_name END AS s_name) FROM (SELECT {_SUPPLIER} FROM supplier)")
def _update_document(c: Collection) -> None:
    c.update_document("7", {"s_name": "seven"}, Rel("s_acctbal", Op.GT, -100000))
    c.update_document("8", {"s_name": "eight"}, LegacyFilter(LegacyOp.LT, "s_acctbal", -100000))


@flat_query("store_bulk_update_documents", f"SELECT * REPLACE (CASE WHEN s_suppkey IN (1, 2) THEN 'some' ELSE s_name END AS s_name) FROM (SELECT {_SUPPLIER} FROM supplier)")
def _bulk_update_documents(c: Collection) -> None:
    hold, fail = Rel("s_acctbal", Op.LT, 1e9), Rel("s_acctbal", Op.GT, 1e9)
    out = c.bulk_update_documents([UpdateRequest(k, {"s_name": "some"}, t) for k, t in (("1", hold), ("2", None), ("3", fail), ("900004", hold))])
    assert (out.updated, set(out.failed_keys)) == (2, {"3", "900004"})


# ---- sub-document updates


@nested_query("store_update_first", f"SELECT * REPLACE (money + 5 AS money, 'top' AS mark) FROM (SELECT {_CUSTOMER} FROM customer ORDER BY c_acctbal DESC, CAST(c_custkey AS VARCHAR) LIMIT 1)")
def _update_first(c: Collection) -> DataFrame:
    return c.update(Query(order_by=(SortKey(Ident("money"), Order.DESC),)), [Update("money", UpdateOp.ADD, 5), Update("mark", UpdateOp.SET, "top")])


@nested_query("store_update_creates", "SELECT 'none' AS id, 'new' AS name, CAST(NULL AS DOUBLE) AS money, CAST(NULL AS VARCHAR) AS segments, CAST(NULL AS BIGINT) AS nation, CAST(NULL AS VARCHAR) AS mark")
def _update_creates(c: Collection) -> DataFrame:
    return c.update(Query(where=Keys("none")), [Update("name", UpdateOp.SET, "new")], UpdateOptions(missing=MissingDocumentStrategy.CREATE_USING_UPDATES))


@nested_query("store_bulk_update", f"SELECT * REPLACE (CASE WHEN money < 0 THEN 'owes' END AS mark, CASE WHEN money < 0 THEN segments || '+DEBT' ELSE segments END AS segments) FROM (SELECT {_CUSTOMER} FROM customer)")
def _bulk_update(c: Collection) -> None:
    c.bulk_update(Query(where=Rel("money", Op.LT, 0)), [Update("mark", UpdateOp.SET, "owes"), Update("segments", UpdateOp.APPEND_TO_LIST, ["DEBT"])], UpdateOptions(ReturnDocument.NONE))


@nested_query("store_bulk_update_before", f"SELECT {_CUSTOMER} FROM customer WHERE c_acctbal < 0")
def _bulk_update_before(c: Collection) -> DataFrame:
    return c.bulk_update(Query(where=Rel("money", Op.LT, 0)), [Update("money", UpdateOp.SET, 0)], UpdateOptions(ReturnDocument.BEFORE))


@nested_query("store_bulk_update_by_key", f"SELECT * REPLACE (CASE WHEN id = '1' THEN money + 1 ELSE money END AS money, CASE WHEN id = '2' THEN NULL ELSE name END AS name) FROM (SELECT {_CUSTOMER} FROM customer)")
def _bulk_update_by_key(c: Collection) -> None:
    c.bulk_update_by_key({"1": [Update("money", UpdateOp.ADD, 1)], "2": [Update("name", UpdateOp.UNSET)], "none": [Update("name", UpdateOp.UNSET)]})


@nested_query("store_update_sub_doc", f"SELECT * REPLACE (CASE WHEN id = '3' THEN 99 WHEN id = '5' THEN 98 ELSE nation END AS nation, CASE WHEN id = '5' THEN 'five' END AS mark) FROM (SELECT {_CUSTOMER} FROM customer)")
def _update_sub_doc(c: Collection) -> None:
    c.update_sub_doc("3", "home.nation", 99)
    c.bulk_update_sub_docs({"5": {"home.nation": 98, "mark": "five"}})


@nested_query("store_array_operations", f"SELECT * REPLACE (CASE WHEN id = '1' THEN segments || '+X' WHEN id = '2' THEN split_part(segments, '+', 1) WHEN id = '3' THEN 'P+Q' ELSE segments END AS segments) FROM (SELECT {_CUSTOMER} FROM customer)")
def _array_operations(c: Collection) -> None:
    c.bulk_operation_on_array(["1"], "segments", "ADD", ["ALL", "X"])
    c.bulk_operation_on_array(["2"], "segments", "REMOVE", ["ALL"])
    c.bulk_operation_on_array(["3"], "segments", "SET", ["P", "Q"])


@nested_query("store_delete_sub_doc", f"SELECT * REPLACE (CASE WHEN id <> '4' THEN nation END AS nation) FROM (SELECT {_CUSTOMER} FROM customer)")
def _delete_sub_doc(c: Collection) -> None:
    c.delete_sub_doc("4", "home.nation")


# ---- deletes


@flat_query("store_delete", f"SELECT {_SUPPLIER} FROM supplier WHERE s_suppkey NOT IN (1, 5) AND NOT coalesce(s_acctbal < 0, false)")
def _delete(c: Collection) -> None:
    c.delete("1", "5", "900005")
    c.delete_where(Rel("s_acctbal", Op.LT, 0))


@flat_query("store_delete_all", "SELECT CAST(count(*) AS BIGINT) AS n FROM supplier WHERE false")
def _delete_all(c: Collection) -> DataFrame:
    c.delete_all()
    return c.dataframe().agg(F.count(F.lit(1)).alias("n"))


@flat_query("store_page", f"SELECT {_SUPPLIER} FROM supplier ORDER BY s_suppkey LIMIT 5 OFFSET 2")
def _page(c: Collection) -> DataFrame:
    return c.find(Query(order_by=(SortKey(Ident("s_suppkey")),), page=Page(5, 2)))
