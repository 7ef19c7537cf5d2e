"""Mixing sources to target weights by entropy balancing.

Rates minimise the relative entropy to "every document once" under one token constraint per
source and the bound of ``cap`` uses a document. The optimum is the exponential tilt
``min(cap, exp(lambda_source * size))``; its convex dual is solved by safeguarded Newton steps
whose gradient and curvature are sums over the (source, size) histogram of all documents.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import discard, group_key, identified, materialize, running_sum

#: Rates are rounded to this share before exact integer sums, so results do not depend on partitions.
UNIT = 1 << 20
WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """``src``, ``source_size``, ``n`` (documents with words), ``target`` per source.

    ``sized`` has ``src`` (``group_key`` of the source) and ``size``. Sources by code point, null
    last, take the weights in turn and share ``share`` of all words; none gets over ``cap`` times
    its own size, and the excess goes to the others by weight until none is above.
    """
    stats = sized.groupBy("src").agg(F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("n"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    # one row per source meets in this window, never one per document
    place = F.row_number().over(Window.orderBy(F.col("src") == "n", "src")) - 1
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    stats = materialize(stats.withColumn("weight", turn))
    words, weight = stats.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    level, known = share * words / weight if weight else 0.0, -1
    while True:  # ends: the set of full sources only grows
        full = F.col("source_size") * cap <= F.lit(level) * F.col("weight")
        count, held, free = stats.agg(F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("source_size") * cap)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if count == known or not free:
            break
        known, level = count, (share * words - held) / free
    target = F.when(F.lit(level) * F.col("weight") >= F.col("source_size") * cap, (F.col("source_size") * cap).cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return materialize(stats.select("src", "source_size", "n", "least", target.alias("target")))


def tilts(sized: DataFrame, targets: DataFrame, cap: int = 2, rounds: int = 80) -> DataFrame:
    """``src``, ``scale``, ``tilt``: the Newton solution, for sources that have words."""
    cells = materialize(sized.filter("size > 0").groupBy("src", "size").agg(F.count("*").alias("n")))
    mean = F.col("source_size") / F.col("n")
    ratio = F.col("target") / F.col("source_size")
    low = F.when(ratio < 1, F.log(F.greatest(ratio, F.lit(1e-300))) * mean / F.col("least")).otherwise(0.0)
    high = F.when(ratio > 1, F.lit(math.log(cap)) * mean / F.col("least")).otherwise(0.0)
    state = materialize(targets.filter("source_size > 0").select("src", "target", mean.alias("scale"), F.least(F.greatest(F.log(F.greatest(ratio, F.lit(1e-300))), low), high).alias("tilt"), low.alias("low"), high.alias("high")))
    for _ in range(rounds):
        x = F.col("size") / F.col("scale")
        up = F.col("tilt") * x
        rate = F.when(up >= math.log(cap), F.lit(float(cap))).otherwise(F.exp(up))
        mass = (F.col("n") * F.col("size")).cast("decimal(38,0)")
        slope = F.when(up < math.log(cap), x * rate).otherwise(0.0)
        # whole numbers are summed, so the order of rows cannot change a digit
        exact = lambda v: (F.sum(mass * F.round(v * UNIT).cast("long")) / UNIT).cast("double")
        sums = cells.join(state, "src").groupBy("src").agg(exact(rate).alias("got"), exact(slope).alias("slope"))
        g = F.col("got") - F.col("target")
        nxt = state.join(sums, "src").withColumn("low", F.when(g < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn("high", F.when(g > 0, F.col("tilt")).otherwise(F.col("high")))
        step = F.col("tilt") - g / F.when(F.col("slope") > 0, F.col("slope"))
        safe = F.when((step > F.col("low")) & (step < F.col("high")), step).otherwise((F.col("low") + F.col("high")) / 2)
        small = F.abs(g) <= F.greatest(F.lit(0.25), F.col("target") * 1e-6)
        unsettled = ~small & (F.col("high") - F.col("low") > 1e-13)
        state, old = materialize(nxt.select("src", "target", "scale", F.when(small, F.col("tilt")).otherwise(safe).alias("tilt"), "low", "high", unsettled.alias("open"))), state
        discard(old)
        if state.filter("open").isEmpty():
            break
    return state.select("src", "scale", "tilt")


def mix(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: int = 2, repairs: int = 8) -> DataFrame:
    """Whole copies of each document: adds ``source_size``, ``target`` and ``copies`` (0 to ``cap``).

    ``sized`` is a materialised narrow table with ``src``, ``size`` and ``doc_id``; other columns
    are carried along. Rates become copies by systematic sampling along documents ordered by
    source and falling size, which misses a source's words by at most its longest document; then
    up to ``repairs`` single copies per source are added or taken back where that brings the source
    nearer to its target. Documents without words get 0 words however often they are copied.
    Repeated rows, null ids and null sources are ordinary rows; an empty table gives no rows.
    """
    targets = source_targets(sized, weights, share, cap)
    lam = tilts(sized, targets, cap)
    up = F.col("tilt") * F.col("size") / F.col("scale")
    rate = F.when(F.col("target") >= F.col("source_size") * cap, F.lit(float(cap))).when(up >= math.log(cap), F.lit(float(cap))).otherwise(F.exp(up))
    rated = sized.join(targets.join(lam, "src", "left").drop("n", "least"), "src").withColumn("rate", F.coalesce(F.round(rate * UNIT).cast("long"), F.lit(0))).drop("scale", "tilt")
    order = [F.col("src"), F.col("size").desc(), F.xxhash64("doc_id"), F.col("doc_id")]
    placed = running_sum(materialize(rated), order, "rate", "upto")
    half = UNIT // 2
    copies = F.floor((F.col("upto") + half) / UNIT) - F.floor((F.col("upto") - F.col("rate") + half) / UNIT)
    drawn = materialize(placed.withColumn("copies", copies.cast("int")).drop("rate", "upto"))
    at = F.struct("_pid", "_idx")
    cells = materialize(drawn.filter("size > 0").groupBy("src", "size", "copies").agg(F.min(at).alias("at"), F.count("*").alias("n")))
    got = cells.groupBy("src").agg(F.sum(F.col("n") * F.col("size") * F.col("copies")).alias("got"))
    miss = materialize(targets.join(got, "src", "left").select("src", (F.col("target") - F.coalesce("got", F.lit(0))).alias("miss")))
    fixes = None
    for _ in range(repairs):
        sign = F.when(F.col("miss") > 0, 1).otherwise(-1)
        left = F.abs(F.col("miss") - sign * F.col("size"))
        best = (
            cells.join(miss, "src").withColumn("change", sign).withColumn("left", left)
            .filter((F.col("left") < F.abs("miss")) & (F.col("copies") + F.col("change")).between(0, cap))
            .groupBy("src").agg(F.min(F.struct("left", "size", "copies", "at", "change")).alias("b"))
        )
        best = materialize(best.select("src", "b.*"))
        if best.isEmpty():
            break
        fixes = best if fixes is None else fixes.unionByName(best)
        cells = cells.join(best.select("src", "size", "copies"), ["src", "size", "copies"], "left_anti")
        miss = materialize(miss.join(best.select("src", "size", "change"), "src", "left").select("src", (F.col("miss") - F.coalesce(F.col("size") * F.col("change"), F.lit(0))).alias("miss")))
    if fixes is not None:
        moves = fixes.select(F.col("at._pid").alias("_pid"), F.col("at._idx").alias("_idx"), "change")
        drawn = drawn.join(moves, ["_pid", "_idx"], "left").withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0))).drop("change")
    return drawn.drop("_pid", "_idx")


def sized_documents(docs: DataFrame, *keep: str) -> DataFrame:
    """Materialised ``doc_id``, ``src``, ``size`` (words; null text: 0) and the columns in ``keep``."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORDS)), F.lit(0)).cast("long")
    return materialize(docs.select(F.col("doc_id"), group_key(F.col("source")).alias("src"), size.alias("size"), *keep))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents themselves, each as often as the mix takes it; their columns only.

    Null texts and texts without words have size 0 and come once or as often as their source's mix
    takes them; null sources are a source; repeated rows are drawn one by one; other columns are
    carried along, whatever their names; an empty table gives no rows.
    """
    rows = identified(docs)
    copies = mix(sized_documents(rows.select("_file", "_at", "_row.doc_id", "_row.text", "_row.source"), "_file", "_at"))
    # joined alike at every size: what is taken grows with the corpus
    taken = rows.join(copies.filter("copies > 0").select("_file", "_at", F.col("copies").alias("_copies")).hint("merge"), ["_file", "_at"])
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
