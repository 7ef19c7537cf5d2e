"""Stored collections: immutable files in key buckets, one atomic commit file per version, set-based write verbs.

Rows are bucketed by a hash of their key. A commit file lists the folder of every bucket; a write
that knows its keys rewrites the buckets of these keys only and lists the other folders again.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from enum import Enum
from functools import wraps
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.metrics import custom_metric
from folio.operators.filters import predicate
from folio.operators.updates import Update, UpdateOp, apply_updates, validate
from folio.plans import ast as A
from folio.plans.compiler import Source, compile_query, count_query, documents
from folio.plans.legacy import LegacyFilter, LegacyQuery, translate, translate_filter
from folio.sources.merge import delete_rows, merge_rows


class DuplicateDocumentError(ValueError):
    """The key exists already."""


class SchemaMismatchError(ValueError):
    """A document has a field that the collection lacks."""


class ConcurrentWriteError(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


class DocumentType(Enum):
    NESTED = "NESTED"
    FLAT = "FLAT"


class MissingColumnStrategy(Enum):
    SKIP = "SKIP"
    THROW = "THROW"
    IGNORE_DOCUMENT = "IGNORE_DOCUMENT"


class ReturnDocument(Enum):
    BEFORE = "BEFORE"
    AFTER = "AFTER"
    NONE = "NONE"


class MissingDocumentStrategy(Enum):
    SKIP_UPDATES = "SKIP_UPDATES"
    CREATE_USING_UPDATES = "CREATE_USING_UPDATES"


class DataFreshness(Enum):
    """Accepted and without effect: every read sees one committed snapshot."""

    SYSTEM_DEFAULT = "SYSTEM_DEFAULT"
    REALTIME_FRESHNESS = "REALTIME_FRESHNESS"
    NEAR_REALTIME_FRESHNESS = "NEAR_REALTIME_FRESHNESS"


class CreateStatus(Enum):
    SUCCESS = "SUCCESS"
    PARTIAL = "PARTIAL"
    IGNORED = "IGNORED"
    FAILED = "FAILED"


@dataclass(frozen=True)
class CreateResult:
    status: CreateStatus
    skipped: tuple[str, ...] = ()


@dataclass(frozen=True)
class QueryOptions:
    timeout_seconds: float = 20 * 60
    freshness: DataFreshness = DataFreshness.SYSTEM_DEFAULT


@dataclass(frozen=True)
class UpdateOptions:
    returns: ReturnDocument = ReturnDocument.AFTER
    missing: MissingDocumentStrategy = MissingDocumentStrategy.SKIP_UPDATES


@dataclass(frozen=True)
class UpdateRequest:
    key: str
    document: Mapping[str, Any]
    condition: LegacyFilter | A.Predicate | None = None


@dataclass(frozen=True)
class BulkResult:
    updated: int
    failed_keys: tuple[str, ...] = field(default=())


NESTED_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("document", T.VariantType()), T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())])


def as_document(text: str) -> dict:
    """A result's JSON text as a document; what cannot be read becomes a document that says why."""
    try:
        return json.loads(text)
    except (TypeError, ValueError) as e:
        return {"errorMessage": str(e)}


def _retried(verb: Callable) -> Callable:
    """A lost commit is tried again on the new version, twice and 10 ms apart."""

    @wraps(verb)
    def run(self: Collection, *args: Any, **kw: Any) -> Any:
        for left in (2, 1, 0):
            try:
                return verb(self, *args, **kw)
            except ConcurrentWriteError:
                if not left:
                    raise
                time.sleep(0.01)

    return run


def tenant_key(tenant: str, value: Any) -> str:
    return f"{tenant}:{value}"


class _Store:
    """Files through the file system that Spark itself uses for the path."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.conf, self.base = spark._jvm, spark._jsc.hadoopConfiguration(), base.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)
        gateway = spark.sparkContext._gateway
        self.none = gateway.new_array(self.jvm.java.lang.String, 0)
        self.careful = gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        self.careful[0] = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").NONE

    def path(self, rest: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{rest}" if rest else self.base)

    def names(self, rest: str) -> list[str]:
        p = self.path(rest)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, rest: str) -> str:
        stream = self.fs.open(self.path(rest))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, rest: str, text: str) -> bool:
        """Whether this call made the file, which is seen with all its content or not at all; it never overwrites one.

        The content is written aside first. Local files get their name by a hard link, others by a
        rename without overwriting, which is atomic where the file system's rename is (HDFS and
        alike; object stores need a connector that offers it).
        """
        aside, target = self.path(f"{rest}.{uuid.uuid4().hex}.tmp"), self.path(rest)
        stream = self.fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if self.fs.getUri().getScheme() == "file":
                at = lambda p: self.jvm.java.nio.file.Path.of(p.toUri().getPath(), self.none)
                self.jvm.java.nio.file.Files.createLink(at(target), at(aside))
            else:
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(aside, target, self.careful)
            return True
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        finally:
            self.fs.delete(aside, False)

    def delete(self, rest: str) -> bool:
        return self.fs.delete(self.path(rest), True)


class Datastore:
    """Named collections below one folder."""

    def __init__(self, spark: SparkSession, base_path: str):
        self.spark, self.base = spark, base_path.rstrip("/")
        self._store = _Store(spark, base_path)

    def list_collections(self) -> list[str]:
        """Names, those in a schema as ``schema.name``."""
        out = []
        for n in self._store.names(""):
            inner = self._store.names(n)
            out += [n] if "_meta.json" in inner else [f"{n}.{m}" for m in inner if "_meta.json" in self._store.names(f"{n}/{m}")]
        return out

    @staticmethod
    def folder(name: str) -> str:
        """The folder of ``name`` or ``schema.name``."""
        parts = name.split(".")
        if len(parts) > 2:
            raise ValueError(f"not a collection name: {name!r}")
        for part in parts:
            A.check_name(part)
        return "/".join(parts)

    def create_collection(self, name: str, doc_type: DocumentType = DocumentType.NESTED, schema: T.StructType | None = None, key: str = "id", updated_column: str | None = None, strategy: MissingColumnStrategy = MissingColumnStrategy.SKIP, buckets: int = 16) -> bool:
        """True when the collection exists afterwards; ``buckets`` should follow the size it will have."""
        folder = self.folder(name)
        if name in self.list_collections():
            return True
        if doc_type is DocumentType.FLAT and (schema is None or key not in schema.fieldNames()):
            raise ValueError("a flat collection needs a schema with its key")
        meta = {"type": doc_type.value, "key": key if doc_type is DocumentType.FLAT else "id", "updated": updated_column, "strategy": strategy.value, "buckets": buckets, "schema": (schema or NESTED_SCHEMA).json()}
        made = self._store.create(f"{folder}/_meta.json", json.dumps(meta))
        self._store.create(f"{folder}/commit-1", "{}")
        return made

    def delete_collection(self, name: str) -> bool:
        return self._store.delete(self.folder(name))

    def collection(self, name: str) -> Collection:
        """A missing one is created as NESTED."""
        if name not in self.list_collections():
            self.create_collection(name)
        return Collection(self, name)

    def collection_for_type(self, name: str, doc_type: DocumentType) -> Collection:
        out = self.collection(name)
        if out.type is not doc_type:
            raise ValueError(f"{name} is {out.type.value}")
        return out

    def healthy(self) -> bool:
        return self.spark.sql("SELECT 1").first()[0] == 1


class Collection:
    """One keyed collection. Reads see the last commit; each write verb makes the next snapshot."""

    def __init__(self, store: Datastore, name: str):
        self.store, self.name, self.spark = store, name, store.spark
        self.folder = store.folder(name)
        meta = json.loads(store._store.read(f"{self.folder}/_meta.json"))
        self.buckets = meta["buckets"]
        self.type, self.key = DocumentType(meta["type"]), meta["key"]
        self.updated_column, self.strategy = meta["updated"], MissingColumnStrategy(meta["strategy"])
        self.schema = T.StructType.fromJson(json.loads(meta["schema"]))

    # ---- snapshots

    def version(self) -> int:
        return max((int(n.removeprefix("commit-")) for n in self.store._store.names(self.folder) if n.startswith("commit-") and not n.endswith(".tmp")), default=0)

    def _parts(self, version: int) -> dict[str, str]:
        """Folder by bucket."""
        return json.loads(self.store._store.read(f"{self.folder}/commit-{version}")) if version else {}

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def _buckets_of(self, rows: DataFrame) -> set[str]:
        """Buckets of the rows' keys: at most as many as there are."""
        return {str(r[0]) for r in rows.select(self._bucket(F.col(self.key))).distinct().collect()}

    def _keys(self, keys: Any) -> DataFrame:
        """Keys as a table, to join with instead of a long list."""
        return self.spark.createDataFrame([(str(k),) for k in keys], f"`{self.key}` string")

    def _commit(self, df: DataFrame, base: int = 0, touched: set[str] | None = None) -> None:
        """``df`` becomes the content of the ``touched`` buckets, of all if none are named."""
        snap = f"snap-{base + 1}-{uuid.uuid4().hex[:8]}"
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema.fields]).withColumn("_bucket", self._bucket(F.col(f"`{self.key}`")))
        rows.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.store.base}/{self.folder}/{snap}")
        kept = {} if touched is None else {b: p for b, p in self._parts(base).items() if b not in touched}
        made = {n.removeprefix("_bucket="): f"{snap}/{n}" for n in self.store._store.names(f"{self.folder}/{snap}") if n.startswith("_bucket=")}
        if not self.store._store.create(f"{self.folder}/commit-{base + 1}", json.dumps(kept | made)):
            self.store._store.delete(f"{self.folder}/{snap}")
            raise ConcurrentWriteError(self.name)

    def dataframe(self, version: int | None = None, buckets: set[str] | None = None) -> DataFrame:
        parts = self._parts(self.version() if version is None else version)
        paths = [f"{self.store.base}/{self.folder}/{p}" for b, p in sorted(parts.items()) if buckets is None or b in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def load(self, df: DataFrame) -> None:
        """Replace the content by the rows of ``df``, which have the collection's columns and one row a key."""
        self._commit(df, self.version())

    def vacuum(self) -> None:
        """Drop all commits but the last, and the folders that it does not list."""
        keep = self.version()
        used = {p.split("/")[0] for p in self._parts(keep).values()}
        for n in self.store._store.names(self.folder):
            if (n.startswith("commit-") and n != f"commit-{keep}") or (n.startswith("snap-") and n not in used):
                self.store._store.delete(f"{self.folder}/{n}")

    def source(self, df: DataFrame | None = None) -> Source:
        return Source(self.dataframe() if df is None else df, self.nested, self.key)

    @property
    def nested(self) -> bool:
        return self.type is DocumentType.NESTED

    # ---- reads

    def query(self, query: A.Query, options: QueryOptions | None = None) -> DataFrame:
        return compile_query(query, self.source())

    aggregate = find = query

    def documents(self, query: A.Query, options: QueryOptions | None = None) -> list[dict]:
        """Result documents; a query that outlives its timeout is cancelled."""
        return list(self.iterate(query, options))

    def iterate(self, query: A.Query, options: QueryOptions | None = None) -> Iterator[dict]:
        """Result documents as they come, one partition on the driver at a time.

        A text that cannot be read comes as ``{"errorMessage": ...}``.
        """
        options = options or QueryOptions()
        until = time.monotonic() + options.timeout_seconds
        with self._limited(options):
            for row in documents(self.query(query)).toLocalIterator():
                if time.monotonic() > until:
                    raise TimeoutError(f"{self.name}: over {options.timeout_seconds} s")
                yield as_document(row["document"])

    @contextmanager
    def _limited(self, options: QueryOptions) -> Iterator[None]:
        """Cancels the jobs inside when the time is over."""
        tag = f"folio-{uuid.uuid4().hex}"
        self.spark.addTag(tag)
        timer = threading.Timer(options.timeout_seconds, lambda: self.spark.interruptTag(tag))
        timer.daemon = True
        timer.start()
        try:
            yield
        finally:
            timer.cancel()
            self.spark.removeTag(tag)

    def _timed(self, df: DataFrame, options: QueryOptions | None) -> list[Row]:
        with self._limited(options or QueryOptions()):
            return df.collect()

    def search(self, query: LegacyQuery) -> DataFrame:
        return compile_query(translate(query, None if self.nested else self.schema), self.source())

    def count(self, query: A.Query | None = None, options: QueryOptions | None = None) -> int:
        return self._timed(count_query(query or A.Query(), self.source()), options)[0][0]

    def total(self, query: LegacyQuery, options: QueryOptions | None = None) -> int:
        """Rows that the older query matches, whatever its limit and offset."""
        return self._timed(self.search(LegacyQuery(filter=query.filter)).agg(F.count(F.lit(1))), options)[0][0]

    def metrics(self, name: str, query: A.Query) -> DataFrame:
        return custom_metric(name, query, self.source())

    def get(self, *keys: str) -> DataFrame:
        """The rows of these keys, read from their buckets alone."""
        wanted = self._keys(keys)
        return self._among(self.dataframe(None, self._buckets_of(wanted)), wanted)

    def _among(self, df: DataFrame, rows: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key is among those of ``rows``."""
        mine = rows.select(F.col(f"`{self.key}`").cast("string").alias("_wanted")).distinct()
        return df.join(mine, F.col(f"`{self.key}`").cast("string") == F.col("_wanted"), "left_semi")

    # ---- documents to rows

    def _rows(self, docs: Mapping[str, Mapping[str, Any]]) -> tuple[DataFrame, dict[str, CreateResult]]:
        """Rows of the collection's schema, and what became of each document."""
        results, kept = {}, []
        for key, doc in docs.items():
            unknown = () if self.nested else tuple(f for f in doc if f not in self.schema.fieldNames())
            if unknown and self.strategy is MissingColumnStrategy.THROW:
                raise SchemaMismatchError(f"no columns {', '.join(unknown)}")
            ignored = unknown and self.strategy is MissingColumnStrategy.IGNORE_DOCUMENT
            results[key] = CreateResult(CreateStatus.IGNORED if ignored else CreateStatus.PARTIAL if unknown else CreateStatus.SUCCESS, unknown)
            if not ignored:
                kept.append((str(key), json.dumps(doc)))
        raw = self.spark.createDataFrame(kept, "_key string, _text string").withColumn("_doc", F.parse_json("_text"))
        now = F.current_timestamp()
        if self.nested:
            return raw.select(F.col("_key").alias("id"), F.col("_doc").alias("document"), now.alias("created_at"), now.alias("updated_at")), results
        cols = [self._read_field(f) for f in self.schema.fields]
        return raw.select(*cols), results

    def _read_field(self, f: T.StructField) -> Column:
        if f.name == self.key:
            return F.col("_key").cast(f.dataType).alias(f.name)
        if f.name == self.updated_column:
            return F.current_timestamp().cast(f.dataType).alias(f.name)
        v = F.try_variant_get(F.col("_doc"), f'$["{f.name}"]', "variant")

        def one(kind: T.DataType) -> Column:
            if isinstance(kind, T.VariantType):
                return v
            if isinstance(kind, T.TimestampType):  # ISO text or epoch milliseconds
                return F.coalesce(F.timestamp_millis(F.try_variant_get(v, "$", "bigint")), F.try_variant_get(v, "$", "string").try_cast("timestamp"))
            return F.try_variant_get(v, "$", kind.simpleString())

        if isinstance(f.dataType, T.ArrayType):  # a scalar becomes an array of one
            single = one(f.dataType.elementType)
            value = F.coalesce(F.try_variant_get(v, "$", f.dataType.simpleString()), F.when(single.isNotNull(), F.array(single)))
        else:
            value = one(f.dataType)
        return value.cast(f.dataType).alias(f.name)

    def _known(self, df: DataFrame, rows: DataFrame) -> set[str]:
        """Keys of ``rows``, which a request holds, that ``df`` has."""
        return {r[0] for r in self._among(df, rows).select(F.col(f"`{self.key}`").cast("string")).collect()}

    # ---- keyed writes

    @_retried
    def create(self, key: str, doc: Mapping[str, Any]) -> CreateResult:
        v = self.version()
        rows, results = self._rows({key: doc})
        touched = self._buckets_of(self._keys([key]))
        base = self.dataframe(v, touched)
        if self._known(base, self._keys([key])):
            raise DuplicateDocumentError(key)
        if results[key].status is not CreateStatus.IGNORED:
            self._commit(base.unionByName(rows), v, touched)
        return results[key]

    @_retried
    def _write(self, docs: Mapping[str, Mapping[str, Any]], replace: bool) -> tuple[int, set[str]]:
        """Merge all documents in one commit; the version before, and the keys that were there."""
        v = self.version()
        rows, _ = self._rows(docs)
        touched = self._buckets_of(self._keys(docs))
        base = self.dataframe(v, touched)
        known = self._known(base, self._keys(docs))
        if not self.nested:
            self._commit(merge_rows(base, rows, self.key, keep_missing=not replace), v, touched)
            return v, known
        new = rows.select("id", F.col("document").alias("_new"), F.col("updated_at").alias("_now"))
        both = base.join(new, "id", "full")
        fields = lambda c: F.coalesce(F.try_variant_get(c, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
        old_map, new_map = fields(F.col("document")), fields(F.col("_new"))
        merged = F.to_variant_object(F.map_concat(F.map_filter(old_map, lambda k, x: ~F.map_contains_key(new_map, k)), new_map))
        doc = F.when(F.col("_new").isNull(), F.col("document")).when(F.lit(replace) | F.col("document").isNull(), F.col("_new")).otherwise(merged)
        self._commit(both.select("id", doc.alias("document"), F.coalesce("created_at", "_now").alias("created_at"), F.coalesce("_now", "updated_at").alias("updated_at")), v, touched)
        return v, known

    def create_or_replace(self, key: str, doc: Mapping[str, Any]) -> bool:
        """Whether the document is new."""
        return str(key) not in self._write({key: doc}, True)[1]

    def create_or_replace_and_return(self, key: str, doc: Mapping[str, Any]) -> DataFrame:
        self._write({key: doc}, True)
        return self.get(key)

    def upsert(self, key: str, doc: Mapping[str, Any]) -> bool:
        return str(key) not in self._write({key: doc}, False)[1]

    def upsert_and_return(self, key: str, doc: Mapping[str, Any]) -> DataFrame:
        self._write({key: doc}, False)
        return self.get(key)

    def bulk_upsert(self, docs: Mapping[str, Mapping[str, Any]]) -> bool:
        self._write(docs, False)
        return True

    def bulk_upsert_and_return_older(self, docs: Mapping[str, Mapping[str, Any]]) -> DataFrame:
        v, _ = self._write(docs, False)
        return self._older(v, docs)

    def bulk_create_or_replace(self, docs: Mapping[str, Mapping[str, Any]]) -> bool:
        self._write(docs, True)
        return True

    def bulk_create_or_replace_and_return_older(self, docs: Mapping[str, Mapping[str, Any]]) -> DataFrame:
        v, _ = self._write(docs, True)
        return self._older(v, docs)

    def _older(self, version: int, keys: Mapping[str, Any]) -> DataFrame:
        wanted = self._keys(keys)
        return self._among(self.dataframe(version, self._buckets_of(wanted)), wanted)

    def _condition(self, c: LegacyFilter | A.Predicate | None) -> A.Predicate | None:
        return translate_filter(c, None if self.nested else self.schema) if isinstance(c, LegacyFilter) else c

    def update_document(self, key: str, doc: Mapping[str, Any], condition: LegacyFilter | A.Predicate | None = None) -> bool:
        """Merge ``doc`` where the key exists and the condition holds; whether it did."""
        return self.bulk_update_documents([UpdateRequest(key, doc, condition)]).updated == 1

    def bulk_update_documents(self, requests: list[UpdateRequest]) -> BulkResult:
        """Merge each request's document where its key exists and its condition holds; all are tested in one pass."""
        conditions: dict[str, tuple[int, A.Predicate | None]] = {}
        asked = []
        for r in requests:
            test = self._condition(r.condition)
            asked.append((str(r.key), conditions.setdefault(repr(test), (len(conditions), test))[0]))
        wanted = self.spark.createDataFrame(asked, f"`{self.key}` string, _test int")
        base = self.dataframe(None, self._buckets_of(wanted))
        scope = self.source(base).scope()
        met = base.join(wanted.withColumnRenamed(self.key, "_wanted"), F.col(f"`{self.key}`").cast("string") == F.col("_wanted"))
        holds = F.lit(False)
        for n, test in conditions.values():
            holds = holds | ((F.col("_test") == n) & (F.lit(True) if test is None else F.coalesce(predicate(test, scope), F.lit(False))))
        found = {r[0] for r in met.filter(holds).select("_wanted").collect()}
        ready = {r.key: r.document for r in requests if str(r.key) in found}
        if ready:
            self._write(ready, False)
        return BulkResult(len(ready), tuple(r.key for r in requests if str(r.key) not in found))

    # ---- sub-document updates

    def _touched(self, df: DataFrame, hit: Column) -> DataFrame:
        column = "updated_at" if self.nested else self.updated_column
        if not column:
            return df
        return df.withColumn(column, F.when(F.coalesce(hit, F.lit(False)), F.current_timestamp().cast(df.schema[column].dataType)).otherwise(F.col(column)))

    def _apply(self, base: DataFrame, hit: Column, updates: list[Update], version: int, touched: set[str] | None = None) -> None:
        marked = base.withColumn("_hit", F.coalesce(hit, F.lit(False)))
        self._commit(self._touched(apply_updates(marked, updates, F.col("_hit"), self.nested), F.col("_hit")), version, touched)

    @_retried
    def update(self, query: A.Query, updates: list[Update], options: UpdateOptions | None = None) -> DataFrame | None:
        """Update the first row of the query, by its sort and then by key; the row before or after, or None."""
        validate(updates)
        options = options or UpdateOptions()
        v = self.version()
        base = self.dataframe(v)
        pick = A.Query(select=(A.Select(A.Ident(self.key), "found"),), where=query.where, order_by=(*query.order_by, A.SortKey(A.Ident(self.key))), page=A.Page(1))
        found = compile_query(pick, Source(base, self.nested, self.key)).first()
        if found is None:
            if options.missing is MissingDocumentStrategy.CREATE_USING_UPDATES:
                return self._create_from(query, updates, options, v)
            return None
        hit = F.col(self.key) == F.lit(found["found"])
        touched = self._buckets_of(self._keys([found["found"]]))
        self._apply(self.dataframe(v, touched), hit, updates, v, touched)
        if options.returns is ReturnDocument.NONE:
            return None
        return (base if options.returns is ReturnDocument.BEFORE else self.dataframe()).filter(hit)

    def _create_from(self, query: A.Query, updates: list[Update], options: UpdateOptions, version: int) -> DataFrame | None:
        if not isinstance(query.where, A.Keys) or len(query.where.keys) != 1:
            raise ValueError("creating by updates needs a filter on one key")
        key = query.where.keys[0]
        fresh, _ = self._rows({key: {}})
        touched = self._buckets_of(self._keys([key]))
        self._commit(self.dataframe(version, touched).unionByName(apply_updates(fresh, updates, None, self.nested).select(*self.schema.fieldNames())), version, touched)
        return self.get(key) if options.returns is ReturnDocument.AFTER else None

    @_retried
    def bulk_update(self, query: A.Query, updates: list[Update], options: UpdateOptions | None = None) -> DataFrame | None:
        """Update every row that the filter matches; the rows before, those matching after, or None."""
        validate(updates)
        options = options or UpdateOptions()
        v = self.version()
        src = self.source(self.dataframe(v))
        hit = predicate(query.where, src.scope()) if query.where else F.lit(True)
        self._apply(src.df, hit, updates, v)
        if options.returns is ReturnDocument.NONE:
            return None
        return self.query(query) if options.returns is ReturnDocument.AFTER else compile_query(query, src)

    @_retried
    def bulk_update_by_key(self, updates: Mapping[str, list[Update]]) -> BulkResult:
        """Each key's own updates, in one commit; keys that are not there are reported."""
        v = self.version()
        groups: dict[str, tuple[int, list[Update]]] = {}
        asked = []
        for key, own in updates.items():
            validate(own)
            asked.append((str(key), groups.setdefault(repr(own), (len(groups), own))[0]))
        wanted = self.spark.createDataFrame(asked, f"`{self.key}` string, _group int")
        touched = self._buckets_of(wanted)
        base = self.dataframe(v, touched)
        known = self._known(base, wanted)
        if known:
            df = base.join(wanted.withColumnRenamed(self.key, "_wanted"), F.col(f"`{self.key}`").cast("string") == F.col("_wanted"), "left")
            for n, own in groups.values():
                df = apply_updates(df, own, F.col("_group") == n, self.nested)
            self._commit(self._touched(df, F.col("_group").isNotNull()), v, touched)
        return BulkResult(len(known), tuple(str(k) for k in updates if str(k) not in known))

    def update_sub_doc(self, key: str, path: str, value: Any) -> bool:
        return self.bulk_update_by_key({key: [Update(path, UpdateOp.SET, value)]}).updated == 1

    def bulk_update_sub_docs(self, updates: Mapping[str, Mapping[str, Any]]) -> BulkResult:
        return self.bulk_update_by_key({k: [Update(p, UpdateOp.SET, v) for p, v in doc.items()] for k, doc in updates.items()})

    def bulk_operation_on_array(self, keys: list[str], path: str, op: str, values: list[Any]) -> BulkResult:
        """ADD (what is absent), REMOVE or SET the values of an array."""
        kinds = {"ADD": UpdateOp.ADD_TO_LIST_IF_ABSENT, "REMOVE": UpdateOp.REMOVE_ALL_FROM_LIST, "SET": UpdateOp.SET}
        return self.bulk_update_by_key({k: [Update(path, kinds[op], list(values))] for k in keys})

    def delete_sub_doc(self, key: str, path: str) -> bool:
        return self.bulk_update_by_key({key: [Update(path, UpdateOp.UNSET)]}).updated == 1

    # ---- deletes

    def delete(self, *keys: str) -> bool:
        return self.delete_where(A.Keys(*keys)) > 0

    @_retried
    def delete_where(self, condition: LegacyFilter | A.Predicate | None) -> int:
        """Number of rows deleted; a missing condition is refused. Keys alone touch their buckets only."""
        if condition is None:
            raise ValueError("a delete needs a filter; delete_all empties the collection")
        test, v = self._condition(condition), self.version()
        touched = self._buckets_of(self._keys(test.keys)) if isinstance(test, A.Keys) else None
        src = self.source(self.dataframe(v, touched))
        gone = src.df.filter(predicate(test, src.scope())).count()
        if gone:
            self._commit(delete_rows(src, test), v, touched)
        return gone

    @_retried
    def delete_all(self) -> bool:
        self._commit(self.spark.createDataFrame([], self.schema), self.version())
        return True

    def drop(self) -> None:
        self.store.delete_collection(self.name)
