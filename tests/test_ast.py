import pytest

from folio.plans import ast as A
from folio.plans.builder import QueryBuilder


@pytest.mark.parametrize(
    "make",
    [
        lambda: A.Const([]),
        lambda: A.Const([1, "a"]),
        lambda: A.Ident(" "),
        lambda: A.Ident("a b"),
        lambda: A.Ident("x" * 64),
        lambda: A.And(A.Rel("a", A.Op.EQ, 1)),
        lambda: A.Or(A.Rel("a", A.Op.EQ, 1)),
        lambda: A.Page(-1),
        lambda: A.Page(1, -1),
        lambda: A.Select(A.Agg(A.Aggregate.COUNT, A.Const(1))),
        lambda: A.Agg(A.Aggregate.SUM, A.Agg(A.Aggregate.SUM, A.Ident("a"))),
        lambda: A.Func(A.Function.ABS, A.Ident("a"), A.Ident("b")),
        lambda: A.Func(A.Function.ADD, A.Ident("a")),
        lambda: A.JsonIdent("c", A.JsonType.STRING),
        lambda: A.JsonIdent("c", A.JsonType.STRING, *["a"] * 11),
        lambda: A.JsonIdent("c", A.JsonType.STRING, "a';--"),
        lambda: A.Keys(),
    ],
)
def test_bad_nodes_are_refused(make):
    with pytest.raises(ValueError):
        make()


def test_builder_sets_and_adds():
    b = QueryBuilder().add_selection("a").add_selection(A.Ident("b"), "c").set_filter(A.Rel("a", A.Op.GT, 1)).add_aggregation("a").add_sort("a", A.Order.DESC).set_pagination(3, 1)
    q = b.build()
    assert [s.name for s in q.select] == ["a", "c"] and q.page == A.Page(3, 1)
    assert b.set_selections([]).build().select == ()
    assert "WHERE a > 1" in str(q) and "GROUP BY a" in str(q) and "OFFSET 1 LIMIT 3" in str(q)


def test_hyphens_and_dots_are_names():
    assert A.Ident("props.source-loc").name == "props.source-loc"
    assert A.Select(A.Ident("props.size")).name == "props_dot_size"
