"""Aggregates answered at the source: by a database (SC-05, SC-06, SK-07) and
by Parquet footers (A-01, A-08).

``read_database`` reads a table through Spark's V2 JDBC catalog, which pushes
filters, DISTINCT, grouping, counts, sums, extremes and limits into the
database's own query; the plain ``read_jdbc`` pushes filters and columns only.
``footer_stats`` takes counts and extremes from the footers of Parquet files
and reads column data only where footers can't tell.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.functions.columns import nan_to_null
from trackmart.sources.io import read_jdbc

_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


def database_catalog(spark: SparkSession, url: str, properties: dict | None = None) -> str:
    """Register the database of ``url`` as a catalog of this session; its name."""
    own = {"url": url, **(properties or {})}
    name = "db_" + hashlib.sha256(repr(sorted(own.items())).encode()).hexdigest()[:12]
    if spark.conf.get(f"spark.sql.catalog.{name}", None) is None:
        for k, v in own.items():
            spark.conf.set(f"spark.sql.catalog.{name}.{k}", v)
        spark.conf.set(f"spark.sql.catalog.{name}", _CATALOG)
    return name


def read_database(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """A database table (``SCHEMA.TABLE``) whose DISTINCT and aggregates run in
    the database. What a dialect can't do runs in Spark, with the same rows."""
    return spark.read.table(f"{database_catalog(spark, url, properties)}.{table}")


def distinct_in_database(spark: SparkSession, url: str, table: str, column: str, alias: str | None = None,
                         exclude: Sequence[str] = (), properties: dict | None = None) -> DataFrame:
    """The distinct values of a column without NULL and ``exclude``, selected by
    the database's own query (SC-05, SC-06), so each is shipped once whatever
    the plan does with them: filters that a database can't take are moved below
    an aggregate that ``read_database`` would else push down."""
    for name in (*table.split("."), column):
        if not re.fullmatch(r"[A-Za-z_][\w$]*", name):
            raise ValueError(f"not a plain name: {name!r}")
    conditions = [f"{column} IS NOT NULL"] + [f"{column} <> '" + v.replace("'", "''") + "'" for v in exclude]
    query = f"SELECT DISTINCT {column} FROM {table} WHERE {' AND '.join(conditions)}"
    found = read_jdbc(spark, url, query=query, properties=properties)
    return found.select(F.col(found.columns[0]).alias(alias or column))


_IN_FOOTERS = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def _text(c: str, kind: T.DataType):
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.col(c).cast("string")


def _floating(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def footer_stats(spark: SparkSession, path: str, columns: Sequence[str] | None = None, report: dict | None = None) -> DataFrame:
    """``(column, rows, nulls, min_num, max_num, min_text, max_text)`` of a
    Parquet table, extremes as number or text by type.

    Counts and the extremes of numbers, dates and booleans come from the
    footers; those of other types from a scan of these columns. Files without
    statistics (or with NaN, which footers leave out) make that aggregate a scan
    too: ``report["footers"]`` tells. NaN is no extreme, and counts as missing
    where the scan decides. Nested columns have counts only.
    """
    own = spark.newSession()  # so that the caller's settings stay as they are
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.parquet(path)
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    flat = [f for f in fields if isinstance(f.dataType, T.AtomicType)]
    easy = [f for f in flat if isinstance(f.dataType, _IN_FOOTERS)]
    hard = [f for f in flat if f not in easy]

    def wanted(some: list, floats_plain: bool) -> list:
        out = []
        for f in some:
            x = F.col(f"`{f.name}`")
            x = x if floats_plain or not _floating(f.dataType) else nan_to_null(x)
            out += [F.min(x).alias(f"min:{f.name}"), F.max(x).alias(f"max:{f.name}")]
        return out

    counts = [F.count(F.lit(1)).alias("rows")]
    quick = df.agg(*counts, *[F.count(F.col(f"`{f.name}`")).alias(f"n:{f.name}") for f in flat], *wanted(easy, True))
    plan = quick._jdf.queryExecution().optimizedPlan().toString()
    row, used = None, "RelationV2[count(*)" in plan
    if used:
        try:
            row = quick.first().asDict()
        except Exception as e:  # a file without the statistics that the plan counts on
            if "aggregatePushdown" not in str(e):
                raise
    if row is None:
        used = False
        own.conf.set("spark.sql.parquet.aggregatePushdown", "false")
        plain = own.read.parquet(path)
        row = plain.agg(*counts, *[F.count(nan_to_null(F.col(f"`{f.name}`")) if _floating(f.dataType) else F.col(f"`{f.name}`")).alias(f"n:{f.name}") for f in flat],
                        *wanted(easy, False)).first().asDict()
    nested = [f for f in fields if f not in flat]
    if hard or nested:
        scan = [e for f in hard for e in (F.min(f"`{f.name}`").alias(f"min:{f.name}"), F.max(f"`{f.name}`").alias(f"max:{f.name}"))]
        texts = own.read.parquet(path).agg(*scan, *[F.count(f"`{f.name}`").alias(f"n:{f.name}") for f in nested])
        row |= texts.select(*[_text(f"`{e}:{f.name}`", f.dataType).alias(f"{e}:{f.name}") for f in hard for e in ("min", "max")],
                            *[F.col(f"`n:{f.name}`") for f in nested]).first().asDict()
    if report is not None:
        report["footers"] = used
    out = []
    for f in fields:
        number = isinstance(f.dataType, T.NumericType)
        low, high = row.get(f"min:{f.name}"), row.get(f"max:{f.name}")
        as_num = [float(v) if number and v is not None else None for v in (low, high)]
        as_text = [str(v).lower() if isinstance(v, bool) else str(v) if v is not None and not number else None for v in (low, high)]
        out.append((f.name, row["rows"], row["rows"] - row[f"n:{f.name}"], *as_num, *as_text))
    return spark.createDataFrame(out, "column string, rows bigint, nulls bigint, min_num double, max_num double, min_text string, max_text string")
