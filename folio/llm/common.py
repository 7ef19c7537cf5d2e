"""Shared pieces: materialised tables, distributed prefix sums, connected components."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; one of its own only in local mode, where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="folio-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Delete every table that ``materialize`` wrote in this application; results that still read one are lost."""
    _remove(spark, f"{checkpoint_root(spark)}/folio/{spark.sparkContext.applicationId}")


_released_at_exit: set[str] = set()


def _release_at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        release(spark)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage, survives lost executors, and gives later plans exact sizes. ``discard`` deletes
    such a table, ``release`` all of an application, which also happens when Python exits.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _released_at_exit:
        _released_at_exit.add(app)
        atexit.register(_release_at_exit, spark)
    path = f"{checkpoint_root(spark)}/folio/{app}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folio_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that ``materialize`` returned and no later plan reads."""
    for t in tables:
        if path := getattr(t, "_folio_path", None):
            _remove(t.sparkSession, path)


def identified(docs: DataFrame) -> DataFrame:
    """``_file``, ``_at`` and ``_row`` (all columns): every row with an identity that each scan repeats.

    Rows of Parquet files, selected and filtered or not, are known by their file (a 64-bit hash of its
    path) and place in it, so nothing is copied. Any other input is written once and numbered.
    """
    row, plan = F.struct("*").alias("_row"), docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias") and plan.deterministic():
        plan = plan.children().apply(0)
    if plan.children().isEmpty() and "_metadata" not in docs.columns:
        with contextlib.suppress(AnalysisException):
            return docs.select(F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"), row)
    return materialize(docs.select(F.lit(0).cast("long").alias("_file"), F.monotonically_increasing_id().alias("_at"), row))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bits of ``bit_filter``: 2 MB, whatever the input.
FILTER_BITS = 1 << 24


def bit_filter(df: DataFrame, *hashes: str) -> Callable[..., np.ndarray]:
    """A broadcast test that marks all rows of ``df`` and few others by their long columns ``hashes``.

    Its size is fixed: past its capacity it lets more rows through, it never drops one of ``df``.
    """
    bit = F.explode(F.array(*[F.pmod(F.col(c), F.lit(FILTER_BITS)) for c in hashes]))
    words = df.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("v"))
    got = words.toArrow()  # at most FILTER_BITS / 64 rows
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[got["w"].to_numpy()] = got["v"].to_numpy()
    seen = df.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    def test(*columns: np.ndarray) -> np.ndarray:
        h = np.stack(columns, 1) % FILTER_BITS
        return ((seen.value[h >> 3] >> (h & 7).astype(np.uint8)) & 1).all(1)

    return test


def group_key(col: Column) -> Column:
    """A string that is never null: ``v`` + value, or ``n`` for null."""
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), col.cast("string")))


def partitions_for(df: DataFrame, rows_each: int = 200_000) -> int:
    """Partition count that follows the row count of a materialised table."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_each))


def running_sum(df: DataFrame, order: list[Column], weight: str, total: str) -> DataFrame:
    """Exact inclusive running sum of the long column ``weight`` in the total order ``order``.

    Rows are range-partitioned, so no task holds a whole group; each task sums its own range
    and only one subtotal per partition meets in a single window. Adds ``_pid``, ``_idx`` (place
    in the partition) and ``total``. ``df`` should be a materialised, narrow table.
    """
    n = partitions_for(df)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = T.StructType([*ranged.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField("_idx", T.LongType()), T.StructField("_part", T.LongType())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, at, carry = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            sums = carry + np.cumsum(b.column(b.schema.get_field_index(weight)).to_numpy(zero_copy_only=False).astype(np.int64))
            extra = [pa.array(np.full(b.num_rows, pid, np.int32)), pa.array(at + np.arange(b.num_rows, dtype=np.int64)), pa.array(sums)]
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=[*b.schema.names, "_pid", "_idx", "_part"])
            at, carry = at + b.num_rows, int(sums[-1])

    placed = materialize(ranged.mapInArrow(local, schema))
    ends = placed.groupBy("_pid").agg(F.max("_part").alias("_end"))
    before = F.coalesce(F.sum("_end").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ends.select("_pid", before.alias("_before"))
    return placed.join(offsets, "_pid").withColumn(total, F.col("_part") + F.col("_before")).drop("_part", "_before")


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id per node: columns ``node`` and ``component``.

    Large-star / small-star rounds. Each round only joins edges to one row per node (a skewed hub
    is split by adaptive execution) and pre-aggregates minima before the shuffle. Stops when a
    round changes no edge. Nodes without edges are not listed.
    """
    e = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    )
    mark = None
    for _ in range(max_rounds):
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        # a table of its own, so that the edges of a hub can be split in the join
        low = materialize(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")))
        large = both.filter("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e, old = materialize(small), e
        discard(old, low)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = e.groupBy("u").agg(F.min("v").alias("c"))
    roots = e.select(F.col("v").alias("u"), F.col("v").alias("c")).distinct()
    return nodes.unionByName(roots).groupBy("u").agg(F.min("c").alias("component")).withColumnRenamed("u", "node")
