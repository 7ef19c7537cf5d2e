"""Sharding by extendible hashing under a byte limit.

A directory maps hash prefixes to shards. Only a bucket over the limit splits on its next bit, so a
leaf is the shortest prefix whose documents fit. Sums come from a histogram over hash prefixes whose
resolution follows the number of shards, never from one task per bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import identified, materialize, running_sum

LIMIT = 8 << 20


def _prefix(h: Column, skip: int, bits: int) -> Column:
    """``bits`` bits of the hash after its first ``skip``."""
    if not bits:
        return F.lit(0).cast("long")
    return F.shiftrightunsigned(F.shiftleft(h, skip) if skip else h, 64 - bits)


def shard(docs: DataFrame, limit: int = LIMIT, *keep: str) -> DataFrame:
    """``doc_id``, ``bytes``, ``depth``, ``prefix`` (bits as text), ``page``, ``shard_bytes`` and ``keep``.

    The key hashed is (id, text). A bucket whose rows all have one hash (the same row repeated)
    cannot split; it gets overflow pages of whole rows. A single document over the limit has a
    shard of its own. Null text counts 0 bytes; a null id is a value like any other; columns not in
    ``keep`` are ignored. An empty table gives no rows.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = materialize(docs.select("doc_id", size.alias("bytes"), F.xxhash64("doc_id", "text").alias("h"), *keep))
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bits = min(20, max(0, math.ceil(math.log2(max(total, 1) / limit))) + 4)
    open_rows, known, parts = rows.withColumn("head", F.lit("")), 0, []
    while True:
        step = min(bits, 64 - known)
        cells = materialize(
            open_rows.groupBy("head", _prefix(F.col("h"), known, step).alias("cell")).agg(F.sum("bytes").alias("b"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        )
        levels = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(step))).alias("d")).withColumn("p", F.expr(f"shiftrightunsigned(cell, {step} - d)"))
        sums = levels.groupBy("head", "d", "p").agg(F.sum("b").alias("s"), (F.min("lo") == F.max("hi")).alias("one"))
        # at the last bit of the hash nothing is left to split on
        fits = (F.col("s") <= limit) | F.col("one") | (F.col("d") + known == 64)
        leaf = levels.join(sums, ["head", "d", "p"]).filter(fits).groupBy("head", "cell").agg(F.min(F.struct("d", "p", "s")).alias("leaf"))
        leaves = materialize(cells.select("head", "cell").join(leaf, ["head", "cell"], "left"))
        placed = open_rows.withColumn("cell", _prefix(F.col("h"), known, step)).join(leaves, ["head", "cell"])
        text = F.concat("head", F.when(F.col("leaf.d") > 0, F.expr("lpad(bin(leaf.p), leaf.d, '0')")).otherwise(""))
        done = placed.filter("leaf is not null").select("doc_id", "bytes", "h", (F.col("leaf.d") + known).alias("depth"), text.alias("prefix"), F.col("leaf.s").alias("s"), *keep)
        parts.append(done)
        if not leaves.filter("leaf is null").limit(1).count():
            break
        rest = placed.filter("leaf is null").withColumn("head", F.concat("head", F.lpad(F.bin("cell"), step, "0"))).drop("cell", "leaf")
        open_rows, known = materialize(rest), known + step
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    full = F.col("s") > limit
    crowded = materialize(out.filter(full))
    fine = out.filter(~full).select("doc_id", "bytes", "depth", "prefix", F.lit(0).cast("long").alias("page"), F.col("s").alias("shard_bytes"), *keep)
    if crowded.isEmpty():
        return fine
    ranked = running_sum(crowded.withColumn("one", F.lit(1).cast("long")), [F.col("prefix"), F.col("h"), F.col("doc_id")], "one", "place")
    start = ranked.groupBy("prefix").agg(F.min("place").alias("start"), F.max("bytes").alias("most"))
    paged = ranked.join(start, "prefix").withColumn("page", F.floor((F.col("place") - F.col("start")) / F.greatest(F.floor(F.lit(limit) / F.greatest("most", F.lit(1))), F.lit(1))))
    sums = paged.groupBy("prefix", "page").agg(F.sum("bytes").alias("shard_bytes"))
    return fine.unionByName(paged.join(sums, ["prefix", "page"]).select("doc_id", "bytes", "depth", "prefix", "page", "shard_bytes", *keep))


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """The documents as Parquet, one folder per shard (``shard=<prefix>-<page>``)."""
    rows = identified(docs)
    named = shard(rows.select("_file", "_at", "_row.doc_id", "_row.text"), limit, "_file", "_at").select("_file", "_at", F.concat_ws("-", F.concat(F.lit("s"), "prefix"), "page").alias("shard"))
    named.join(rows, ["_file", "_at"]).select("_row.*", "shard").repartition("shard").write.partitionBy("shard").parquet(path)
