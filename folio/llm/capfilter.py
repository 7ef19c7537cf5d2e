"""Embedding near-duplicates by spherical-cap filters.

A filter direction is a concatenation of one random unit vector per block of dimensions (a random
product code), so a vector finds every filter it exceeds by list decoding block scores instead of
scoring all directions. Vectors meet only in filters they share; every met pair is verified exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import connected_components, materialize

THRESHOLD = 0.93
#: Independent product codes, blocks of each, directions per block at least, and the least score
#: for a filter in standard deviations of a random direction's score.
TABLES, BLOCKS, CODES, LEVEL = 3, 3, 22, 3.1
#: Vectors of one label that these are for; more raise the level, so that a filter keeps about as
#: many members, and the directions, so that a vector keeps about as many filters.
FOR_ROWS = 50_000
#: Vectors of one label that every input's filters are laid out for, whatever its size: two vectors
#: meet or not by themselves alone, never by how many others there are.
LAID_OUT_FOR = 5_000_000
#: The highest cap, as a cosine, of short vectors.
CAP = 0.7
#: Filters that each vector has in each code at least, as far as lower levels give them.
FEWEST = 6
#: Members of a filter compared in one piece; larger filters are split into pairs of pieces.
PIECE = 1024
#: Members of the filters that are sent to Python together, besides those of one.
BUNDLE = 4096
#: Columns of the marks that tell whether a pair met in an earlier filter, multiplied at a time.
STRIP = 2048


def _tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def scale_for(rows: int) -> tuple[int, float]:
    """(directions per block, level) for so many vectors of one label."""
    share = _tail(LEVEL) * min(1.0, FOR_ROWS / max(rows, 1))
    low, high = LEVEL, 9.0
    while high - low > 1e-3:
        mid = (low + high) / 2
        low, high = (mid, high) if _tail(mid) > share else (low, mid)
    level = LEVEL if rows <= FOR_ROWS else low
    return math.ceil(CODES * (_tail(LEVEL) / share) ** (1 / BLOCKS) - 1e-9), level


def layout(width: int) -> tuple[int, float]:
    """(directions per block, level) of the filters of vectors of this width; nothing else decides them."""
    codes, level = scale_for(LAID_OUT_FOR)
    most = max(LEVEL, CAP * math.sqrt(width))
    if level > most:  # as many filters a vector under a lower cap
        level = most
        codes = math.ceil(CODES * (_tail(LEVEL) / _tail(level)) ** (1 / BLOCKS) - 1e-9)
    return codes, level


class ProductCode:
    """``codes ** blocks`` directions in a seeded random basis."""

    def __init__(self, width: int, blocks: int = BLOCKS, codes: int = CODES, seed: int = 7, level: float = LEVEL):
        rng = np.random.default_rng(seed)
        self.blocks = max(1, min(blocks, width))
        self.turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
        self.cuts = np.linspace(0, width, self.blocks + 1).astype(int)
        self.books = []
        for a, b in zip(self.cuts, self.cuts[1:], strict=False):
            book = rng.normal(size=(codes, b - a))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True) * np.sqrt((b - a) / width))
        self.level = min(level / np.sqrt(width), CAP)

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, filter) of every filter at or over the level, in order of vector, then filter.

        A vector whose energy lies badly for the blocks has few filters; its level falls step by
        step until it has ``FEWEST``, so its neighbours, which lie alike, still meet it.
        """
        level = self.level
        who, code = self._decode(unit, level)
        for _ in range(6):
            few = np.flatnonzero(np.bincount(who, minlength=len(unit)) < FEWEST)
            if not len(few):
                break
            level -= 0.25 / np.sqrt(unit.shape[1])
            keep = ~np.isin(who, few)
            w, c = self._decode(unit[few], level)
            who, code = np.concatenate([who[keep], few[w]]), np.concatenate([code[keep], c])
        order = np.lexsort((code, who))
        return who[order], code[order]

    def _decode(self, unit: np.ndarray, level: float) -> tuple[np.ndarray, np.ndarray]:
        """Partial sums that the best remaining blocks cannot lift to the level are dropped at once."""
        x = unit @ self.turn
        scores = [x[:, a:b] @ book.T for (a, b), book in zip(zip(self.cuts, self.cuts[1:], strict=False), self.books, strict=True)]
        rest = np.zeros(len(x))
        bounds = [rest]
        for s in scores[:0:-1]:
            rest = rest + s.max(1)
            bounds.append(rest)
        bounds.reverse()
        who, code, part = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
        for s, bound in zip(scores, bounds, strict=True):
            total = part[:, None] + s[who]
            i, j = np.nonzero(total + bound[who][:, None] >= level)
            who, code, part = who[i], code[i] * s.shape[1] + j, total[i, j]
        return who, code


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision from the table's own floats or doubles."""
    m = np.frombuffer(b"".join(raw), kind).astype(np.float64).reshape(len(raw), -1)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _fresh(a: np.ndarray, b: np.ndarray, earlier: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (place on the left, on the right) that share none of the earlier filters."""
    names, column = np.unique(np.concatenate([np.zeros(0, np.int32), *earlier[0], *earlier[1]]), return_inverse=True)
    size = [np.array([len(x) for x in side]) for side in earlier]
    owner = [np.repeat(np.arange(len(n)), n) for n in size]
    own = np.split(column, [size[0].sum()])
    shared = np.zeros((len(size[0]), len(size[1])), np.float32)
    for at in range(0, len(names), STRIP):
        marks = []
        for o, c, n in zip(owner, own, size, strict=True):
            here = (c >= at) & (c < at + STRIP)
            m = np.zeros((len(n), min(STRIP, len(names) - at)), np.float32)
            m[o[here], c[here] - at] = 1
            marks.append(m)
        shared += marks[0] @ marks[1].T
    new = shared[a, b] == 0
    return a[new], b[new]


def _compare(left: pd.DataFrame, right: pd.DataFrame, filt: int, same: bool, kind: str) -> pd.DataFrame | None:
    """Links between two pieces of a filter: summed partners per class, and a star per linked group.

    A pair is counted only in the smallest filter that its two vectors share.
    """
    cos = _unit(left["raw"].tolist(), kind) @ _unit(right["raw"].tolist(), kind).T >= THRESHOLD
    a, b = np.nonzero(np.triu(cos, 1) if same else cos)
    if not len(a):
        return None
    if not same:  # rows without a link need no marks
        rows, a = np.unique(a, return_inverse=True)
        columns, b = np.unique(b, return_inverse=True)
        left, right = left.iloc[rows], right.iloc[columns]
    a, b = _fresh(a, b, [[x[x < filt] for x in side["filters"]] for side in (left, right)])
    if not len(a):
        return None
    nl, nr = len(left), len(right)
    partners = np.zeros(nl + nr, np.int64)
    np.add.at(partners, a, right["n"].to_numpy()[b])
    np.add.at(partners, nl + b, left["n"].to_numpy()[a])
    ids = np.concatenate([left["id"].to_numpy(), right["id"].to_numpy()])
    # smallest reachable id inside the piece, by repeated minima over the links
    low = ids.copy()
    while True:
        m = np.minimum(low[a], low[nl + b])
        nxt = low.copy()
        np.minimum.at(nxt, a, m)
        np.minimum.at(nxt, nl + b, m)
        if same:
            both = np.minimum(nxt[:nl], nxt[nl:])
            nxt = np.concatenate([both, both])
        if (nxt == low).all():
            break
        low = nxt
    hit = (partners > 0) | (low != ids)
    return pd.DataFrame({"id": ids[hit], "partners": partners[hit], "root": low[hit]})


def _bundle(pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    for (label, filt, x, y), g in pdf.groupby(["label", "filter", "x", "y"], sort=False):
        kind = label[:3]
        if x == y:
            if len(g) > 1:
                out.append(_compare(g, g, filt, True, kind))
        else:
            left, right = g[g["own"] == x], g[g["own"] == y]
            if len(left) and len(right):
                out.append(_compare(left, right, filt, False, kind))
    found = [o for o in out if o is not None]
    return pd.concat(found) if found else pd.DataFrame({"id": [], "partners": [], "root": []}).astype("int64")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row.

    Rows link when labels are equal and not null and the cosine of their vectors, in double
    precision, is at least ``THRESHOLD``; null or zero vectors and those with null, NaN or infinite
    components link with nothing. Whether a link is found depends on its two vectors alone, not on
    the other rows. Equal vectors of one label form a class that is compared once and counted as
    often as it has rows. Rows that link with nothing are their own component; repeated
    rows of one id are separate rows with that id. An empty table gives no rows.
    """
    x = F.col("embedding")
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0) & F.col("label").isNotNull()
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.transform(x, lambda v: v.cast("double")).alias("v"), F.coalesce(fine, F.lit(False)).alias("fine"))
    # one class per label and vector
    rows = materialize(src.withColumn("key", F.when(F.col("fine"), F.sha2(F.concat_ws(",", F.col("label"), F.col("v").cast("string")), 256))))
    classes = materialize(rows.filter("fine").groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v")).filter("id is not null"))

    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, list[ProductCode]] = {}
        for big in batches:
            for at in range(0, big.num_rows, 2000):
                b = big.slice(at, 2000)
                label, vs = b.column(2).to_pylist(), b.column(3).to_pylist()
                for width in sorted({len(v) for v in vs}):
                    pick = [i for i, v in enumerate(vs) if len(v) == width]
                    size, level = layout(width)
                    if width not in codes:
                        codes[width] = [ProductCode(width, codes=size, seed=7 + t, level=level) for t in range(TABLES)]
                    raw = [np.array(vs[i], kind).tobytes() for i in pick]
                    unit = _unit(raw, kind)
                    met = [c.decode(unit) for c in codes[width]]
                    who = np.concatenate([w for w, _ in met])
                    order = np.argsort(who, kind="stable")
                    code = np.concatenate([c + t * size**BLOCKS for t, (_, c) in enumerate(met)])[order].astype(np.int32)
                    own = np.searchsorted(who[order], np.arange(len(pick) + 1)).astype(np.int32)
                    name = pa.array([f"{kind}:{width}:{label[i]}" for i in pick], pa.string())
                    lists = pa.ListArray.from_arrays(pa.array(own), pa.array(code))
                    yield pa.RecordBatch.from_arrays([name, b.column(0).take(pa.array(pick)), b.column(1).take(pa.array(pick)), pa.array(raw, pa.binary()), lists], names=["label", "id", "n", "raw", "filters"])

    decoded = materialize(classes.select("id", "n", "label", "v").mapInArrow(decode, "label string, id long, n long, raw binary, filters array<int>"))
    met = decoded.select("label", F.explode("filters").alias("filter"), "id", "n", "raw", "filters")
    names = met.select("label", "filter")
    # bundles of neighbouring filters with a bounded number of members; one row per filter meets in the window
    before = F.sum("size").over(Window.partitionBy("label").orderBy("filter").rowsBetween(Window.unboundedPreceding, -1))
    sizes = names.groupBy("label", "filter").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = materialize(sizes.withColumn("bundle", F.floor(F.coalesce(before, F.lit(0)) / BUNDLE)))
    pieces = F.ceil(F.col("size") / PIECE).cast("int")
    placed = met.join(sizes, ["label", "filter"]).withColumn("pieces", pieces).withColumn("own", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    sent = spread.select("label", "filter", "id", "n", "raw", "filters", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "bundle")
    links = materialize(sent.groupBy("label", "bundle", "x", "y").applyInPandas(_bundle, "id long, partners long, root long"))
    partners = links.groupBy("id").agg(F.sum("partners").alias("partners"))
    parts = connected_components(links.filter("id <> root"), "id", "root")
    named = classes.select("key", "id", "n").join(partners, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("key", (F.col("n") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.select("vec_id", "key").join(named, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
