"""Semantics on schemaless documents: missing fields, mixed types, unnesting, arrays of documents."""

import json

import pytest
from pyspark.sql import functions as F

from folio.operators.updates import Update, UpdateOp, updated_columns
from folio.plans import ast as A
from folio.plans.compiler import Source, compile_query, count_query, documents

I, Op, G = A.Ident, A.Op, A.Aggregate  # noqa: E741
TRAILS = [
    {"_id": 11, "trail": "Karst Loop", "climb": 640, "days": 3, "traits": {"marks": ["lake", "cave", "scree"], "keeper": "Ilva", "map-no": "K7", "hut": {"valley": "Soren"}}, "legs": [{"land": "north", "camps": [{"kind": "tent", "beds": 14}]}, {"land": "ridge", "camps": [{"kind": "cabin", "beds": 6}, {"kind": "tent", "beds": 9}]}, {"land": "south"}]},
    {"_id": 12, "trail": "Moss Path", "climb": 85.5, "days": 1, "traits": {"marks": ["bog"], "keeper": "Oren"}},
    {"_id": 13, "trail": "Kiln Way", "climb": 1210, "days": None, "legs": []},
    {"_id": 14, "trail": "Fen Track", "climb": 85.5, "days": 2, "traits": None, "legs": [{"land": "ridge", "camps": []}]},
    {"_id": 15, "trail": "Karst Loop", "climb": "steep", "days": 4, "traits": {"marks": [], "keeper": "Ilva", "length": "XL"}, "legs": [{"land": "delta", "camps": [{"kind": "cabin", "beds": 2}]}]},
    {"_id": 16, "trail": "kiln ascent", "days": 2, "traits": {"marks": ["cave", "lake"]}},
]


def nested(spark, texts):
    t = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = spark.createDataFrame(texts, "id string, t string").select("id", F.parse_json("t").alias("document"), t.alias("created_at"), t.alias("updated_at"))
    return Source(df, nested=True)


@pytest.fixture(scope="module")
def trails(spark):
    return nested(spark, [(str(d["_id"]), json.dumps(d)) for d in TRAILS])


def ids(source, where):
    return sorted(int(r["id"]) for r in compile_query(A.Query(select=(A.Select(I("id")),), where=where), source).collect())


@pytest.mark.parametrize(
    ("where", "want"),
    [
        (A.Rel("climb", Op.EQ, 85.5), [12, 14]),
        (A.Rel("climb", Op.GT, 100), [11, 13]),
        (A.Rel("trail", Op.NEQ, "Karst Loop"), [12, 13, 14, 16]),
        (A.Rel("traits.keeper", Op.NEQ, "Ilva"), [12]),
        (A.Rel("traits.keeper", Op.NOT_IN, ["Ilva"]), [12, 13, 14, 16]),
        (A.Rel("days", Op.EQ, None), [13]),
        (A.Rel("traits.keeper", Op.EXISTS, True), [11, 12, 15]),
        (A.Rel("traits.keeper", Op.EXISTS, False), [13, 14, 16]),
        (A.Rel("traits.keeper", Op.NOT_EXISTS, True), [13, 14, 16]),
        (A.Rel(A.ArrayIdent("traits.marks"), Op.EXISTS, True), [11, 12, 16]),
        (A.Rel("traits.marks", Op.CONTAINS, "cave"), [11, 16]),
        (A.Rel("traits.marks", Op.NOT_CONTAINS, "cave"), [12, 13, 14, 15]),
        (A.Rel("traits.marks", Op.IN, ["bog", "scree"]), [11, 12]),
        (A.Rel(A.ArrayIdent("traits.marks", A.DataType.STRING), Op.EQ, "bog"), [12]),
        (A.Rel(A.ArrayIdent("traits.marks", A.DataType.STRING), Op.EQ, ["cave", "lake"]), [16]),
        (A.Rel("trail", Op.LIKE, "^k"), [11, 13, 15, 16]),
        (A.Rel("trail", Op.STARTS_WITH, "k"), [16]),
        (A.Rel("trail", Op.STARTS_WITH, "K"), [11, 13, 15]),
        (A.Rel("traits.map-no", Op.EQ, "K7"), [11]),
        (A.Rel("trail", Op.GT, 1), []),
        (A.Keys("12", "99"), [12]),
        (A.AnyOf(I("traits.marks"), A.Rel("traits.marks", Op.STARTS_WITH, "la")), [11, 16]),
        (A.AnyDoc(I("legs"), A.AnyDoc(I("camps"), A.And(A.Rel("kind", Op.EQ, "cabin"), A.Rel("beds", Op.LT, 5)))), [15]),
        (A.Not(A.AnyDoc(I("legs"), A.Rel("land", Op.EQ, "ridge"))), [12, 13, 15, 16]),
        (A.Rel("legs", Op.CONTAINS, A.DocConst.of({"land": "delta"})), [15]),
        (A.Rel("legs", Op.CONTAINS, A.DocConst.of({"camps": [{"kind": "cabin"}]})), [11, 15]),
        (A.Rel(A.Func(A.Function.LENGTH, I("legs")), Op.EQ, 1), [14, 15]),
    ],
)
def test_filters(trails, where, want):
    assert ids(trails, where) == want


def test_unnest_levels(trails):
    def n(keep):
        return count_query(A.Query(source=(A.Unnest(I("legs"), keep), A.Unnest(I("legs.camps"), keep))), trails).first()[0]

    assert n(False) == 4 and n(True) == 9


def test_unnest_filter_and_group(trails):
    q = A.Query(
        select=(A.Select(I("legs.land"), "land"), A.Select(A.Agg(G.SUM, I("legs.camps.beds")), "beds")),
        source=(A.Unnest(I("legs"), True), A.Unnest(I("legs.camps"), True)),
        where=A.Rel("legs.camps.kind", Op.EQ, "tent"),
        group_by=(I("legs.land"),),
        order_by=(A.SortKey(I("beds"), A.Order.DESC),),
    )
    assert [json.loads(r["document"]) for r in documents(compile_query(q, trails)).collect()] == [{"land": "north", "beds": 14.0}, {"land": "ridge", "beds": 9.0}]


def test_untyped_keys_treat_equal_numbers_alike(spark):
    source = nested(spark, [("a", '{"k":250}'), ("b", '{"k":250.0}'), ("c", '{"k":2.5e2}'), ("d", '{"k":"250"}'), ("e", "{}"), ("f", '{"k":null}')])
    q = A.Query(select=(A.Select(I("k")), A.Select(A.Agg(G.COUNT, A.Const(1)), "n")), group_by=(I("k"),))
    got = {r[0]: r[1] for r in compile_query(q, source).select(F.to_json("k"), "n").collect()}
    assert got == {"250": 3, '"250"': 1, None: 2}


def test_sort_numbers_before_text_and_nulls_first(spark):
    source = nested(spark, [("p", '{"k":"moor"}'), ("q", '{"k":7}'), ("r", "{}"), ("s", '{"k":61.5}'), ("t", '{"k":"fen"}'), ("u", '{"k":"100"}')])
    q = A.Query(select=(A.Select(I("id")),), order_by=(A.SortKey(I("k")),))
    assert [r[0] for r in compile_query(q, source).collect()] == ["r", "q", "s", "u", "t", "p"]


def test_aggregates_go_by_value(spark):
    texts = ['{"g":1,"v":9,"w":"i"}', '{"g":1,"v":10,"w":"j"}', '{"g":1,"v":100.5,"w":"k"}', '{"g":1,"v":10.0}', '{"g":2,"v":"late","w":"m"}', '{"g":2,"v":3000}', '{"g":3}', '{"g":3,"v":null}']
    picks = [A.Select(A.Agg(op, I("v")), op.name) for op in (G.MIN, G.MAX, G.COUNT, G.DISTINCT_COUNT, G.DISTINCT_ARRAY)]
    q = A.Query(select=(A.Select(I("g")), *picks, A.Select(A.Agg(G.LAST, I("w"), order_by=I("v")), "LAST")), group_by=(I("g"),), order_by=(A.SortKey(I("g")),))
    got = [json.loads(r[0]) for r in documents(compile_query(q, nested(spark, list(zip("abcdefgh", texts, strict=True))))).collect()]
    assert got[0] == {"g": 1, "MIN": 9, "MAX": 100.5, "COUNT": 4, "DISTINCT_COUNT": 3, "DISTINCT_ARRAY": [9, 10, 100.5], "LAST": "k"}
    assert got[1] == {"g": 2, "MIN": 3000, "MAX": "late", "COUNT": 2, "DISTINCT_COUNT": 2, "DISTINCT_ARRAY": [3000, "late"], "LAST": "m"}
    assert got[2] == {"g": 3, "COUNT": 0, "DISTINCT_COUNT": 0, "DISTINCT_ARRAY": []}


def test_updates_grow_linearly(spark):
    schema = nested(spark, [("a", "{}")]).df.schema

    def size(n):
        return len(updated_columns(schema, [Update(f"camp{k}.beds.free", UpdateOp.SET, k) for k in range(n)], True)["document"]._jc.toString())

    steps = [size(n + 1) - size(n) for n in range(1, 12)]
    assert max(steps) < 1.5 * min(steps)


def test_updates_below_one_parent(spark):
    source = nested(spark, [("a", '{"p":{"x":1,"y":2,"l":["u","v"]},"s":5}'), ("b", '{"p":7}'), ("c", "{}")])
    ups = [Update("p.x", UpdateOp.ADD, 2), Update("p.y", UpdateOp.UNSET), Update("p.l", UpdateOp.REMOVE_ALL_FROM_LIST, ["u"]), Update("q.r", UpdateOp.UNSET), Update("s.t", UpdateOp.UNSET)]
    got = {r[0]: json.loads(r[1]) for r in source.df.select("id", F.to_json(updated_columns(source.df.schema, ups, True)["document"])).collect()}
    assert got == {"a": {"p": {"x": 3, "l": ["v"]}, "s": 5}, "b": {"p": {"x": 2}}, "c": {"p": {"x": 2}}}


def test_nested_output_and_missing_fields(trails):
    q = A.Query(select=(A.Select(I("trail")), A.Select(I("traits.keeper")), A.Select(I("traits.hut.valley"))), order_by=(A.SortKey(I("trail")), A.SortKey(I("_id"))))
    got = [json.loads(r[0]) for r in documents(compile_query(q, trails)).collect()]
    assert got[0] == {"trail": "Fen Track"} and got[1] == {"trail": "Karst Loop", "traits": {"keeper": "Ilva", "hut": {"valley": "Soren"}}}


def test_whole_documents_lose_their_inner_id(trails):
    got = [json.loads(r[0]) for r in documents(compile_query(A.Query(where=A.Keys("13")), trails)).collect()]
    assert got[0]["trail"] == "Kiln Way" and "_id" not in got[0] and got[0]["created_at"].startswith("2024-01-01")


def test_conflicting_aliases_and_having(trails):
    with pytest.raises(ValueError):
        compile_query(A.Query(select=(A.Select(I("trail"), "same"), A.Select(I("climb"), "same"))), trails)
    with pytest.raises(ValueError):
        compile_query(A.Query(select=(A.Select(A.Agg(G.COUNT, A.Const(1)), "n"),), group_by=(I("trail"),), having=A.Keys("11")), trails)


def test_json_identifier_needs_a_flat_collection_and_a_type(spark, trails):
    with pytest.raises(ValueError):
        compile_query(A.Query(where=A.Rel(A.JsonIdent("document", A.JsonType.STRING, "trail"), Op.EQ, "Moss Path")), trails)
    flat = Source(spark.sql("select 4 id, parse_json('{\"spots\":[31,32]}') notes"))
    with pytest.raises(ValueError):
        compile_query(A.Query(where=A.Rel(A.JsonIdent("notes", None, "spots"), Op.IN, [31])), flat)
    assert compile_query(A.Query(where=A.Rel(A.JsonIdent("notes", A.JsonType.NUMBER_ARRAY, "spots"), Op.IN, [32, 90])), flat).count() == 1
