"""Operators on embeddings against brute force."""

import numpy as np
import pytest

from folio.llm import capfilter, topk

SCHEMA = "vec_id long, embedding array<float>, label int, n long"


def table(spark, m, labels, odd=()):
    rows = [(i, [float(x) for x in v], None if labels[i] is None else int(labels[i]), 1) for i, v in enumerate(m.astype(np.float32))]
    return spark.createDataFrame([*rows, *odd], SCHEMA)


@pytest.mark.parametrize(("n", "k"), [(300, 20), (12, 20), (41, 3)])
def test_topk_is_exact(spark, monkeypatch, n, k):
    monkeypatch.setattr(topk, "SEED_ROWS", 16)
    monkeypatch.setattr(topk, "CHUNK", 32)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(n)
    m = rng.normal(size=(n, 12)) * rng.gamma(1, 1, size=(n, 1))
    m[1::7] = m[0]
    odd = [(1000, None, 1, 1), (1020, [float("nan")] * 12, 1, 1), (1040, [None] * 12, 1, 1), (1060, [float("inf")] * 12, 1, 1), (None, [1.0] * 12, 1, 1)]
    got = {}
    for r in topk.exact_topk(table(spark, m, [0] * n, odd), k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    q = np.floor(64 * m.astype(np.float32).astype(float)).astype(int)
    assert sorted(got) == list(range(0, n, 20))
    for i in got:
        s = q @ q[i]
        order = sorted((j for j in range(n) if j != i), key=lambda j: (-s[j], j))[:k]
        assert sorted(got[i]) == [(r + 1, j, s[j]) for r, j in enumerate(order)]


def test_topk_keeps_repeated_rows_apart(spark):
    rng = np.random.default_rng(8)
    m = np.round(rng.normal(size=(40, 6)), 2)
    ids = [*range(38), 20, 20]
    m[38] = m[20]
    rows = [(i, [float(x) for x in v], "a", 1, 2, 3) for i, v in zip(ids, m, strict=True)]
    got = topk.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rid string, rank int, query int, norm int"), 7).collect()
    q = np.floor(64 * m.astype(np.float32).astype(float)).astype(int)
    want = []
    for i in (r for r in range(40) if ids[r] % 20 == 0):
        s = q @ q[i]
        order = sorted((j for j in range(40) if j != i), key=lambda j: (-s[j], ids[j]))[:7]
        want += [(ids[i], r + 1, ids[j], s[j]) for r, j in enumerate(order)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_topk_of_nothing(spark):
    assert topk.exact_topk(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("piece", [1024, 9])
def test_near_duplicates(spark, monkeypatch, piece):
    monkeypatch.setattr(capfilter, "PIECE", piece)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 64))
    m = np.concatenate([np.repeat(centres, 12, 0) + 0.19 * rng.normal(size=(144, 64)), rng.normal(size=(200, 64)), np.repeat(centres[:1], 20, 0)])
    labels = [int(x) for x in rng.integers(0, 2, len(m))]
    labels[3] = None
    odd = [(5000, None, 0, 1), (5001, [0.0] * 64, 0, 1), (5002, [float("nan")] * 64, 0, 1), (5003, [None] * 64, 0, 1), (5004, [1.0, 2.0], 0, 1), (5005, [2.0, 4.0], 0, 1)]
    got = {r["vec_id"]: r for r in capfilter.near_duplicates(table(spark, m, labels, odd)).collect()}
    f = m.astype(np.float32).astype(float)
    u = f / np.linalg.norm(f, axis=1, keepdims=True)
    link = (u @ u.T >= 0.93) & np.array([[a is not None and a == b for b in labels] for a in labels])
    np.fill_diagonal(link, False)
    root = np.arange(len(m))
    while True:
        nxt = np.array([min(root[i], root[link[i]].min(initial=root[i])) for i in range(len(m))])
        if (nxt == root).all():
            break
        root = nxt
    for i in range(len(m)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (link[i].sum(), root[i], root[i] == i), i
    for i in (5000, 5001, 5002, 5003):
        assert (got[i]["n_links"], got[i]["component_id"]) == (0, i)
    assert got[5005]["component_id"] == 5004 and got[5004]["n_links"] == 1


def test_near_duplicates_of_nothing(spark):
    assert capfilter.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_filters_follow_the_rows():
    assert capfilter.scale_for(0) == capfilter.scale_for(50_000) == (22, 3.1)
    codes, level = capfilter.scale_for(5_000_000)
    assert level > 4 and 20 * (22 / codes) ** 3 < 0.25


@pytest.mark.parametrize("rows", [50_000, 5_000_000])
def test_recall_at_the_threshold(rows):
    size, level = capfilter.scale_for(rows)
    rng = np.random.default_rng(2)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.931 * a + np.sqrt(1 - 0.931**2) * z
    met = np.zeros(len(a), bool)
    for t in range(capfilter.TABLES):
        code = capfilter.ProductCode(64, codes=size, seed=7 + t, level=level)
        (wa, ca), (wb, cb) = code.decode(a), code.decode(b)
        met |= np.isin(np.arange(len(a)), np.intersect1d(wa * 10**9 + ca, wb * 10**9 + cb) // 10**9)
    assert met.mean() > 0.99


def test_links_do_not_depend_on_the_other_rows(spark, monkeypatch):
    """Pairs over the threshold link alike alone and among many rows; a limit under the rows stands for a large table."""
    rng = np.random.default_rng(21)
    a = rng.normal(size=(600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    few = np.concatenate([a, 0.9302 * a + np.sqrt(1 - 0.9302**2) * z])
    many = np.concatenate([few, rng.normal(size=(1500, 64))])
    monkeypatch.setattr(capfilter, "FOR_ROWS", 10)
    links = []
    for m in (few, many):
        got = capfilter.near_duplicates(table(spark, m, [0] * len(m))).collect()
        links.append({(r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] < len(few)})
    assert links[0] == links[1]


def test_filters_of_short_vectors_stay_few():
    for width in (20, 24, 30, 36, 48):
        codes, level = capfilter.layout(width)
        code = capfilter.ProductCode(width, codes=codes, level=level)
        unit = np.random.default_rng(width).normal(size=(300, width))
        who, _ = code.decode(unit / np.linalg.norm(unit, axis=1, keepdims=True))
        assert capfilter.FEWEST <= len(who) / 300 < 40
    assert capfilter.layout(64) == capfilter.scale_for(capfilter.LAID_OUT_FOR)
