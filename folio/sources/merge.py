"""Set-based merges and deletes of keyed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.filters import predicate
from folio.plans.ast import Predicate
from folio.plans.compiler import Source


def merge_rows(base: DataFrame, new: DataFrame, key: str, keep_missing: bool) -> DataFrame:
    """``base`` with ``new`` merged in by ``key``; of several new rows of one key the caller sends one.

    With ``keep_missing`` a null in a new row keeps the old value, else the new row replaces all.
    """
    old = base.select(F.col(f"`{key}`").alias("_key"), F.struct("*").alias("_old"))
    got = new.select(F.col(f"`{key}`").alias("_key"), F.struct(*[F.col(f"`{c}`").cast(base.schema[c].dataType).alias(c) if c in new.columns else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in base.columns]).alias("_new"))
    both = old.join(got, "_key", "full")
    out = []
    for c in base.columns:
        a, b = F.col("_old").getField(c), F.col("_new").getField(c)
        value = F.col("_key") if c == key else F.coalesce(b, a) if keep_missing else F.when(F.col("_new").isNotNull(), b).otherwise(a)
        out.append(value.alias(c))
    return both.select(*out)


def delete_rows(source: Source, condition: Predicate) -> DataFrame:
    """The rows for which ``condition`` is not true."""
    return source.df.filter(~F.coalesce(predicate(condition, source.scope()), F.lit(False)))
