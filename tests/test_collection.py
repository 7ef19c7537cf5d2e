"""Write verbs on stored collections, before and after images, conflicts."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators.updates import Update, UpdateOp, validate
from folio.plans import ast as A
from folio.plans.legacy import LegacyFilter, LegacyOp, LegacyOrder, LegacyQuery
from folio.sources import collection as C


@pytest.fixture
def store(spark, tmp_path):
    return C.Datastore(spark, f"file://{tmp_path}/db")


def docs(df):
    return {r[0]: json.loads(r[1]) for r in df.select("id", F.to_json("document")).collect()}


def test_catalog(store):
    assert store.healthy() and store.list_collections() == []
    assert store.create_collection("a") and store.create_collection("a")
    store.collection("b")
    assert store.list_collections() == ["a", "b"]
    with pytest.raises(ValueError):
        store.collection_for_type("a", C.DocumentType.FLAT)
    store.collection("b").drop()
    assert store.list_collections() == ["a"]


def test_nested_keyed_writes(store):
    c = store.collection("t")
    assert c.create("k1", {"a": 1, "t": {}}).status is C.CreateStatus.SUCCESS
    with pytest.raises(C.DuplicateDocumentError):
        c.create("k1", {"a": 2})
    assert c.upsert("k1", {"b": [1, True]}) is False
    assert docs(c.dataframe()) == {"k1": {"a": 1, "b": [1, True], "t": {}}}
    assert c.create_or_replace("k1", {"z": 1}) is False and c.create_or_replace("k2", {"z": 2}) is True
    older = c.bulk_upsert_and_return_older({"k2": {"y": 1}, "k3": {"y": 2}})
    assert docs(older) == {"k2": {"z": 2}}
    assert docs(c.dataframe()) == {"k1": {"z": 1}, "k2": {"y": 1, "z": 2}, "k3": {"y": 2}}
    assert c.update_document("k2", {"y": 9}, A.Rel("z", A.Op.EQ, 3)) is False
    assert c.update_document("k2", {"y": 9}, LegacyFilter(LegacyOp.EQ, "z", 2)) is True
    assert c.delete("k1") and c.count() == 2
    with pytest.raises(ValueError):
        c.delete_where(None)
    assert c.delete_where(A.Rel("y", A.Op.EQ, 9)) == 1
    assert c.delete_all() and c.count() == 0
    c.vacuum()
    assert c.count() == 0


def test_sub_document_updates(store):
    c = store.collection("t")
    c.bulk_upsert({"1": {"n": 1, "l": ["a", "b", "a"], "p": {"q": 1}}, "2": {"n": 5}})
    q = A.Query(order_by=(A.SortKey(A.Ident("n"), A.Order.DESC),))
    before = c.update(q, [Update("n", UpdateOp.ADD, 2), Update("new.deep", UpdateOp.SET, {"x": [1]})], C.UpdateOptions(C.ReturnDocument.BEFORE))
    assert docs(before) == {"2": {"n": 5}}
    assert docs(c.get("2")) == {"2": {"n": 7, "new": {"deep": {"x": [1]}}}}
    c.bulk_update_by_key({"1": [Update("l", UpdateOp.ADD_TO_LIST_IF_ABSENT, ["a", "c", "c"]), Update("p.q", UpdateOp.UNSET)]})
    assert docs(c.get("1"))["1"] == {"n": 1, "l": ["a", "b", "a", "c"], "p": {}}
    c.bulk_update(A.Query(where=A.Rel("n", A.Op.LT, 5)), [Update("l", UpdateOp.REMOVE_ALL_FROM_LIST, ["a"])])
    assert docs(c.get("1"))["1"]["l"] == ["b", "c"]
    after = c.bulk_update(A.Query(where=A.Rel("n", A.Op.EQ, 1)), [Update("n", UpdateOp.SET, 3)])
    assert after.count() == 0
    c.bulk_operation_on_array(["1"], "tags.x", "ADD", ["t"])
    assert docs(c.get("1"))["1"]["tags"] == {"x": ["t"]}
    assert c.delete_sub_doc("1", "tags") and "tags" not in docs(c.get("1"))["1"]
    assert c.update_sub_doc("1", "a.b", 1) and docs(c.get("1"))["1"]["a"] == {"b": 1}
    assert c.bulk_update_by_key({"9": [Update("a", UpdateOp.SET, 1)]}).failed_keys == ("9",)
    assert c.update(A.Query(where=A.Keys("7")), [Update("a", UpdateOp.SET, 1)]) is None
    made = c.update(A.Query(where=A.Keys("7")), [Update("a", UpdateOp.SET, 1)], C.UpdateOptions(missing=C.MissingDocumentStrategy.CREATE_USING_UPDATES))
    assert docs(made) == {"7": {"a": 1}}


SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("id", T.StringType()), ("item", T.StringType()), ("price", T.IntegerType()), ("tags", T.ArrayType(T.StringType())), ("props", T.VariantType()), ("at", T.TimestampType()), ("changed", T.TimestampType()))])


def test_flat_writes(store):
    store.create_collection("f", C.DocumentType.FLAT, SCHEMA, updated_column="changed")
    c = store.collection("f")
    assert c.create("1", {"item": "x", "price": 3, "tags": "one", "props": {"a": 1}, "at": 1000, "odd": 1}) == C.CreateResult(C.CreateStatus.PARTIAL, ("odd",))
    row = c.dataframe().first()
    assert (row["item"], row["tags"], row["at"].second) == ("x", ["one"], 1) and row["changed"]
    c.bulk_upsert({"1": {"price": 4}, "2": {"item": "y", "at": "2024-01-02T03:04:05Z"}})
    assert [(r["id"], r["item"], r["price"]) for r in c.dataframe().orderBy("id").collect()] == [("1", "x", 4), ("2", "y", None)]
    c.bulk_create_or_replace({"1": {"price": 5}})
    assert c.get("1").first()["item"] is None
    c.bulk_update_by_key({"1": [Update("price", UpdateOp.ADD, 2), Update("tags", UpdateOp.APPEND_TO_LIST, ["p"]), Update("props.b.c", UpdateOp.SET, 7)]})
    r = c.get("1").select("price", "tags", F.to_json("props")).first()
    assert tuple(r) == (7, ["p"], '{"b":{"c":7}}')
    with pytest.raises(TypeError):
        c.bulk_update_by_key({"1": [Update("item", UpdateOp.APPEND_TO_LIST, ["p"])]})
    with pytest.raises(TypeError):
        c.bulk_update_by_key({"1": [Update("item", UpdateOp.ADD, 1)]})


def test_strategies_and_conflicts(store):
    for name, s in (("a", C.MissingColumnStrategy.THROW), ("b", C.MissingColumnStrategy.IGNORE_DOCUMENT)):
        store.create_collection(name, C.DocumentType.FLAT, SCHEMA, strategy=s)
    with pytest.raises(C.SchemaMismatchError):
        store.collection("a").create("1", {"odd": 1})
    assert store.collection("b").create("1", {"odd": 1}).status is C.CreateStatus.IGNORED and store.collection("b").count() == 0
    c = store.collection("a")
    stale = c.version()
    c.create("1", {"item": "x"})
    with pytest.raises(C.ConcurrentWriteError):
        c._commit(c.dataframe(), stale)


def test_legacy_reads_and_queries(store):
    c = store.collection("t")
    c.bulk_upsert({str(i): {"n": i, "s": "ab"[i % 2]} for i in range(6)})
    q = LegacyQuery(("n",), LegacyFilter(LegacyOp.NEQ, "s", "a"), (LegacyOrder("n", False),), 1, 1)
    assert [r[0] for r in c.search(q).select(F.try_variant_get("n", "$", "int")).collect()] == [3] and c.total(q) == 3
    assert c.count(A.Query(where=A.Rel("n", A.Op.GTE, 4))) == 2
    assert c.documents(A.Query(select=(A.Select(A.Ident("n")),), where=A.Keys("2"))) == [{"n": 2}]
    m = c.metrics("m", A.Query(select=(A.Select(A.Agg(A.Aggregate.COUNT, A.Const(1)), "metric_value"), A.Select(A.Ident("s", A.DataType.STRING), "s")), group_by=(A.Ident("s", A.DataType.STRING),)))
    assert sorted((r["value"], r["labels"]["s"]) for r in m.collect()) == [(3.0, "a"), (3.0, "b")]


def test_update_validation():
    with pytest.raises(ValueError):
        validate([])
    with pytest.raises(ValueError):
        validate([Update("a", UpdateOp.UNSET), Update("a.b", UpdateOp.SET, 1)])
    with pytest.raises(ValueError):
        Update("createdTime", UpdateOp.SET, 1)
    with pytest.raises(TypeError):
        Update("a", UpdateOp.ADD, "x")
    with pytest.raises(TypeError):
        Update("a", UpdateOp.APPEND_TO_LIST, "x")


def test_writes_touch_the_buckets_of_their_keys(store):
    c = store.collection("t")
    c.bulk_upsert({str(k): {"n": k} for k in range(200)})
    before = c._parts(c.version())
    c.upsert("7", {"n": -7})
    c.update_sub_doc("7", "m", 1)
    after = c._parts(c.version())
    assert len(before) == c.buckets and sum(before[b] != after[b] for b in before) == 1
    assert docs(c.get("7")) == {"7": {"n": -7, "m": 1}} and c.count() == 200
    c.vacuum()
    assert c.count() == 200 and c.delete("7", "8") and c.count() == 198


def test_a_lost_commit_is_tried_again(store, monkeypatch):
    c = store.collection("t")
    c.create("1", {"n": 1})
    real, lost = C.Collection._commit, []

    def first_loses(self, df, base=0, touched=None):
        if len(lost) < 2:
            lost.append(base)
            raise C.ConcurrentWriteError(self.name)
        return real(self, df, base, touched)

    monkeypatch.setattr(C.Collection, "_commit", first_loses)
    assert c.upsert("1", {"m": 2}) is False and docs(c.dataframe()) == {"1": {"n": 1, "m": 2}}
    monkeypatch.setattr(C.Collection, "_commit", lambda *a: (_ for _ in ()).throw(C.ConcurrentWriteError("t")))
    with pytest.raises(C.ConcurrentWriteError):
        c.upsert("1", {"m": 3})


def test_commit_files_have_all_their_content_or_are_not_there(store):
    c = store.collection("t")
    assert store._store.create("t/commit-9", "{}") and not store._store.create("t/commit-9", '{"0": "x"}')
    assert store._store.read("t/commit-9") == "{}" and not [n for n in store._store.names("t") if n.endswith(".tmp")]
    assert c.version() == 9


def test_names_in_a_schema(store):
    assert store.create_collection("area.t") and store.list_collections() == ["area.t"]
    store.collection("area.t").create("1", {"n": 1})
    assert store.collection("area.t").count() == 1 and store.delete_collection("area.t") and store.list_collections() == []
    for bad in ("a.b.c", "a b", ""):
        with pytest.raises(ValueError):
            store.create_collection(bad)


def test_documents_come_one_by_one_within_their_time(store):
    c = store.collection("t")
    c.bulk_upsert({str(k): {"n": k} for k in range(20)})
    q = A.Query(select=(A.Select(A.Ident("n")),))
    assert sorted(d["n"] for d in c.iterate(q)) == list(range(20))
    with pytest.raises(TimeoutError):
        list(c.iterate(q, C.QueryOptions(timeout_seconds=0)))
    assert set(C.as_document("{oops")) == {"errorMessage"} and C.as_document('{"a":1}') == {"a": 1}
