"""Exact top-k inner products: norm-sorted vectors, SVD-rotated partial sums, Cauchy-Schwarz bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import discard, materialize

#: Queries of one pass over the candidates: what is broadcast is bounded by it, not by the table.
QUERY_BLOCK = 8192
#: Longest vectors that give every query its first bound.
SEED_ROWS = 2048
CHUNK = 1024


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", factor: float = 64.0) -> DataFrame:
    """``vec_id``, ``q`` (``floor(factor * x)`` as longs), ``norm`` (squared, exact) of the usable vectors.

    Null vectors, null ids and vectors with null, NaN or infinite components take no part.
    """
    x = F.col(vec_col)
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * factor).cast("long"))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), q.alias("q"))
    return rows.withColumn("norm", F.aggregate("q", F.lit(0).cast("long"), lambda a, v: a + v * v))


def _matrix(col: pa.ListArray | pa.ChunkedArray, width: int) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, width) if width else np.zeros((len(col), 0))


def search_chunk(qi, qr, qn, c, cr, cn, lead: int, floor: np.ndarray) -> np.ndarray:
    """Mask of (query, candidate) pairs that a bound below ``floor`` does not exclude."""
    out = np.zeros((len(qi), len(c)), bool)
    live = np.flatnonzero(qn * cn.max(initial=0) >= floor - 1e-6)  # longest of the chunk
    if len(live):
        part = qr[live, :lead] @ cr[:, :lead].T
        rest = np.sqrt(np.maximum((qr[live, lead:] ** 2).sum(1), 0))[:, None] * np.sqrt(np.maximum((cr[:, lead:] ** 2).sum(1), 0))[None, :]
        out[live] = part + rest + 1e-6 * (1 + qn[live][:, None] * cn[None, :]) >= floor[live][:, None]
    return out


def exact_topk(vectors: DataFrame, k: int = 20, modulo: int = 20) -> DataFrame:
    """The ``k`` highest integer inner products of every query with all other rows.

    Queries are the rows whose id is divisible by ``modulo``. ``query_id``, ``rank`` from 1,
    ``vec_id``, ``score``; ties go to the smaller id, then to the row that is met first. A query's own
    row is no candidate of it; other rows are, those with its id too, and a repeated query row has
    its own ranks. Candidates run through each task in order of falling length; a chunk or pair
    whose Cauchy-Schwarz bound stays below the query's k-th best score so far is never scored, and
    the task ends once no query can gain. Vectors of another length than the most common one take
    no part; other columns are ignored. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = materialize(quantised(vectors).withColumn("width", F.size("q")).withColumn("rid", F.monotonically_increasing_id()))
    mode = rows.groupBy("width").count().orderBy(F.col("count").desc(), "width").first()
    schema = "query long, query_id long, rid long, vec_id long, score long"
    if mode is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = mode["width"]
    longest = [F.col("norm").desc(), F.col("vec_id"), F.col("rid")]
    ranged = materialize(rows.filter(F.col("width") == width).select("rid", "vec_id", "q", "norm").repartitionByRange(max(1, -(-mode["count"] // 16384)), *longest).sortWithinPartitions(*longest))
    discard(rows)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((width, width))
        for b in batches:
            m = _matrix(b.column(0), width)
            g += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(g.ravel())], names=["cell", "v"])

    # summed on the executors: width x width cells reach the driver, however many tasks there are
    cells = ranged.select("q").mapInArrow(gram, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    total = np.zeros(width * width)
    total[cells["cell"].to_numpy()] = cells["v"].to_numpy()
    total = total.reshape(width, width)
    turn = np.linalg.eigh(total)[1][:, ::-1].copy()  # right singular vectors of all rows, strongest first
    lead = max(1, width // 4)
    seed = ranged.orderBy(*longest).limit(SEED_ROWS).toArrow()
    seed_rids, seed_q = seed["rid"].to_numpy(), _matrix(seed["q"].combine_chunks(), width)
    queries = ranged.filter(F.col("vec_id") % modulo == 0)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    keyed = materialize(queries.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)))) if blocks > 1 else queries.withColumn("block", F.lit(0))
    found = None
    for i in range(blocks):  # one block's queries are on the driver and in a broadcast at a time
        got = keyed.filter(F.col("block") == i).select("rid", "vec_id", "q").toArrow()
        rids, ids, qi = got["rid"].to_numpy(), got["vec_id"].to_numpy(), _matrix(got["q"].combine_chunks(), width)
        first = qi @ seed_q.T
        first[rids[:, None] == seed_rids[None, :]] = -np.inf
        floor = np.sort(first, axis=1)[:, -k] if first.shape[1] > k else np.full(len(ids), -np.inf)
        shared = spark.sparkContext.broadcast((rids, ids, qi, qi @ turn, np.sqrt((qi * qi).sum(1)), floor, turn))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            rids, ids, qi, qr, qn, floor, turn = shared.value
            floor = floor.copy()
            none = np.zeros(0, np.int64)
            top: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0), none, none)] * len(ids)

            def scan(part: pa.RecordBatch) -> bool:
                """False once no query can gain from this chunk, nor from the shorter ones behind it."""
                crid, cid, c = part.column(0).to_numpy(), part.column(1).to_numpy(), _matrix(part.column(2), width)
                cn = np.sqrt((c * c).sum(1))
                if not (qn * cn.max(initial=0) >= floor - 1e-6).any():
                    return False
                keep = search_chunk(qi, qr, qn, c, c @ turn, cn, lead, floor)
                for q in np.flatnonzero(keep.any(1)):
                    pos = np.flatnonzero(keep[q])
                    s = c[pos] @ qi[q]
                    own = (crid[pos] != rids[q]) & (s >= floor[q])
                    if own.any():
                        scores, near, at = (np.concatenate([x, y]) for x, y in zip(top[q], (s[own], cid[pos][own], crid[pos][own]), strict=True))
                        best = np.lexsort((at, near, -scores))[:k]
                        top[q] = scores[best], near[best], at[best]
                        if len(best) == k:
                            floor[q] = max(floor[q], scores[best[-1]])
                return True

            if len(ids):
                for b in batches:
                    if not all(scan(b.slice(at, CHUNK)) for at in range(0, b.num_rows, CHUNK)):
                        break
            sizes = [len(t[0]) for t in top]
            if sum(sizes):
                near = [np.concatenate([t[j] for t in top]) for j in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rids, sizes)), pa.array(np.repeat(ids, sizes)), pa.array(near[2]), pa.array(near[1]), pa.array(near[0].astype(np.int64))], names=["query", "query_id", "rid", "vec_id", "score"])

        hits = ranged.select("rid", "vec_id", "q").mapInArrow(search, schema)
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "rid"))
        best = hits.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if blocks > 1:
            best = materialize(best)
            shared.destroy()
        found = best if found is None else found.unionByName(best)
    return found
