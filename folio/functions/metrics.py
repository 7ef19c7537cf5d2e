"""Metrics from queries: rows of name, value and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.plans import ast as A
from folio.plans.compiler import Source, compile_query

VALUE = "metric_value"


def custom_metric(name: str, query: A.Query, source: Source) -> DataFrame:
    """One metric row per result row: its ``metric_value``, the other selections as labels.

    Every selection needs an alias; rows without a value are left out; a null label reads ``<null>``.
    """
    if not query.select or any(s.alias is None for s in query.select):
        raise ValueError("every selection of a metric needs an alias")
    if VALUE not in [s.alias for s in query.select]:
        raise ValueError(f"a metric selects {VALUE}")
    rows = compile_query(query, source).filter(F.col(VALUE).isNotNull())
    labels = [x for c in rows.columns if c != VALUE for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("<null>")))]
    tags = F.create_map(*labels) if labels else F.create_map().cast("map<string,string>")
    return rows.select(F.lit(name).alias("name"), F.col(VALUE).cast("double").alias("value"), tags.alias("labels"))
