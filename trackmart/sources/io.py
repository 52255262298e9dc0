"""Sources and sinks (SC-*, SK-*): CSV, Parquet, catalog tables, JDBC,
typed writes with a row-count check, and a versioned checkpoint store.

Reads always use an explicit schema where one is known; writes cast to the
target schema first, so the stored types never depend on inference.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.functions.columns import na_tokens_to_null, nan_to_null
from trackmart.schemas import INDEX_COLUMNS, PANDAS_NA
from trackmart.sources.publish import EmptyInput, swap_path, swap_table


# --- reads -----------------------------------------------------------------------

def read_table(spark: SparkSession, path_or_name: str, fmt: str | None = None) -> DataFrame:
    """Parquet file/folder, or a catalog table when no path separator is given (SC-04)."""
    if fmt is None:
        fmt = "parquet" if ("/" in path_or_name or path_or_name.endswith(".parquet")) else "table"
    if fmt == "table":
        return spark.table(path_or_name)
    return spark.read.format(fmt).load(path_or_name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             na_tokens: Iterable[str] | None = PANDAS_NA, multiline: bool = False) -> DataFrame:
    """Header CSV with pandas-compatible parsing (SC-01, SC-02).

    * quotes are escaped by doubling (``""``); ``multiline=True`` accepts
      quoted values spanning lines, but makes each file a single task, so it
      is off by default (files are split into many tasks);
    * every column is read as text first, the NA tokens become NULL, then
      the text is cast to ``schema`` with ``try_cast`` (bad values -> NULL);
    * an exported index column (blank header) is dropped;
    * floating ``NaN`` becomes NULL.
    Splitting the input is Spark's file partitioning (SC-03): no chunk loop.
    """
    raw = (spark.read.option("header", True).option("escape", '"').option("quote", '"')
           .option("multiLine", multiline).option("inferSchema", False)
           .csv(path))
    raw = raw.drop(*[c for c in raw.columns if c in INDEX_COLUMNS or c.strip() == ""])
    cols = []
    for name in raw.columns:
        c = F.col(f"`{name}`")
        if na_tokens is not None:
            c = na_tokens_to_null(c, na_tokens)
        cols.append(c.alias(name))
    df = raw.select(*cols)
    if schema is None:
        return df
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            raise KeyError(f"column {f.name!r} missing in {path}")
        v = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            v = F.when(v.isin("True", "true", "TRUE", "1"), True).when(v.isin("False", "false", "FALSE", "0"), False)
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)):
            v = v.try_cast("double").try_cast(f.dataType)
        elif not isinstance(f.dataType, T.StringType):
            v = v.try_cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            v = nan_to_null(v)
        out.append(v.alias(f.name))
    return df.select(*out)


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: dict | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Database table or query (SC-04..SC-06). Filters and projections applied
    to the result are pushed to the database; a numeric ``partition_column``
    splits the read into parallel range queries."""
    r = spark.read.format("jdbc").option("url", url)
    if table:
        r = r.option("dbtable", table)
    if query:
        r = r.option("query", query)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def literal_table(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A small literal table with an explicit schema (SC-09), e.g. fixtures."""
    return spark.createDataFrame(rows, schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the file system its scheme names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  required: str | None = None) -> DataFrame:
    """A stored table, or an empty one if nothing was stored yet (SC-07).

    Only a missing path (or a table without ``required``, as the reference
    starts over there) means empty; a store that is there and can't be read
    raises, as history must not be dropped silently."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(path)
    if required and required not in df.columns:
        return spark.createDataFrame([], schema)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in df.columns
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


# --- writes ------------------------------------------------------------------------

def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema`` in its order with its types (SK-01 dtype map)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise KeyError(f"columns missing for the target schema: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_table(df: DataFrame, target: str, schema: T.StructType | None = None, mode: str = "overwrite",
                fmt: str = "parquet", allow_empty: bool = False, strict: bool = False,
                partition_by: Iterable[str] | None = None, jdbc: dict | None = None,
                empty_check: str = "after") -> DataFrame:
    """Typed write plus the post-load row-count check (SK-01..SK-05, SK-07, SK-08).

    The number of rows written is observed during the write itself
    (``Observation``), so the data is not computed twice; the stored table is
    then counted from storage. Returns one row
    ``(target, rows_written, rows_stored, ok)``; ``strict`` raises on a
    mismatch; an append must add exactly the rows written to those that were
    there before. An empty input raises ``EmptyInput`` unless ``allow_empty``:
    by default the observed count decides after the write, so the plan runs
    once; with ``empty_check="before"`` nothing is written (a ``limit 1``
    probe, which for a plan ending in a shuffle computes that shuffle).

    A folder or catalog table that is overwritten is written and checked
    beside the old one, which stays as it was if the load fails, dies or is
    empty, and then swapped in (``sources.publish``; its ``PublishedTable``
    swaps in one step). A database's old table stays in those cases only with
    ``empty_check="before"``, as its writer replaces in place.
    """
    spark = df.sparkSession
    if schema is not None:
        df = conform(df, schema)
    if not allow_empty and empty_check == "before" and df.isEmpty():
        raise EmptyInput(f"nothing to write to {target}")
    before = 0
    if mode == "append":
        if jdbc is not None:  # makes the table if there is none yet
            df.limit(0).write.mode("append").format("jdbc").options(dbtable=target, **jdbc).save()
        before = _stored_rows(spark, target, fmt, jdbc)
    obs = Observation(f"load_check_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    staged = jdbc is None and mode == "overwrite"
    place = f"{target.rstrip('/')}__staged_{uuid.uuid4().hex[:8]}" if staged else target
    try:
        if jdbc is not None:
            props = dict(jdbc)
            url = props.pop("url")
            w = observed.write.mode(mode).format("jdbc").option("url", url).option("dbtable", target)
            for k, v in props.items():
                w = w.option(k, v)
            w.save()
        else:
            w = observed.write.mode("errorifexists" if staged else mode)
            if partition_by:
                w = w.partitionBy(*partition_by)
            if fmt == "table":
                w.saveAsTable(place)
            else:
                w.format(fmt).save(place)
        written = obs.get.get("rows", 0)
        if written == 0 and not allow_empty:
            raise EmptyInput(f"nothing was written to {target}")
        rows_stored = _stored_rows(spark, place, fmt, jdbc)
        ok = rows_stored == before + written
        if strict and not ok:
            raise RuntimeError(f"{target}: wrote {written} rows, found {rows_stored}")
        if staged:
            (swap_table if fmt == "table" else swap_path)(spark, place, target)
    except Exception:
        if staged:
            _drop(spark, place, fmt)
        raise
    return spark.createDataFrame([(target, int(written), int(rows_stored), bool(ok))],
                                 "target string, rows_written bigint, rows_stored bigint, ok boolean")


def _drop(spark: SparkSession, place: str, fmt: str) -> None:
    """Remove a staged folder or table that will not be swapped in."""
    if fmt == "table":
        spark.sql(f"DROP TABLE IF EXISTS {place}")
    else:
        at = spark._jvm.org.apache.hadoop.fs.Path(place)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _stored_rows(spark: SparkSession, target: str, fmt: str, jdbc: dict | None) -> int:
    """Rows of a target now; 0 if there is none yet. A database counts them
    itself (``SELECT COUNT(*)``), rows are not read back."""
    if jdbc is not None:
        keep = {k: v for k, v in jdbc.items() if k in ("driver", "user", "password")}
        return int(read_jdbc(spark, jdbc["url"], query=f"SELECT COUNT(*) AS n FROM {target}", properties=keep).first()[0])
    if fmt == "table":
        return spark.table(target).count() if spark.catalog.tableExists(target) else 0
    return spark.read.format(fmt).load(target).count() if path_exists(spark, target) else 0


def create_database(spark: SparkSession, name: str) -> None:
    """Create the target database if absent (SK-09)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


# --- batch log (checkpoint of finished lookups, SK-06) --------------------------------

class BatchLog:
    """A keyed table stored as one Parquet folder per batch.

    Writing batch N replaces only ``batch_id=N`` (an empty batch leaves it
    empty), so re-running a failed batch is idempotent and the folders other
    jobs read are never rewritten. Reading resolves the upsert: the latest
    batch wins per key (D-06).
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str]):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self._rows = T.StructType([f for f in schema.fields if f.name != "batch_id"])

    def read_all(self) -> DataFrame:
        """Every stored row; without a batch, none."""
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], self.schema)
        return conform(self.spark.read.schema(self.schema).parquet(self.root), self.schema)

    def read_latest(self) -> DataFrame:
        from trackmart.operators.relational import latest_per_key
        return latest_per_key(self.read_all(), self.keys, [F.col("batch_id").desc()])

    def earlier(self, batch_id: int, wanted: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """Rows of the batches before ``batch_id``. (``KeyedStore`` reads those
        near the keys in ``wanted`` only.)"""
        return self.read_all().filter(F.col("batch_id") < int(batch_id))

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        conform(df, self._rows).write.mode("overwrite").parquet(f"{self.root}/batch_id={int(batch_id)}")


__all__ = ["EmptyInput", "read_table", "read_csv", "read_jdbc", "read_or_empty", "path_exists", "conform",
           "write_table", "create_database", "BatchLog", "literal_table"]
