"""Left join that a hot key does not hold up (J-02).

Keys with more rows than half a mean partition are found exactly
(``heavy.heavy_keys``); there are fewer than twice as many of them as
partitions. Their left rows are dealt to salts, and their right rows copied to
each salt; all other keys take salt 0. So one join does both, and no partition
gets a whole hot key, whatever side, size or adaptive settings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.operators.heavy import heavy_keys
from trackmart.operators.relational import left_enrich

PIECES = 16  # salts of a key that fills a partition


def hot_keys(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """``(keys, salts)`` of the keys with more rows than half a mean partition;
    a local table of fewer than ``2 * partitions`` rows."""
    report: dict = {}
    heavy = heavy_keys(df, keys, max(2, df.count() // (2 * partitions) + 1), "__n", report=report)
    rows = [tuple(r) for r in heavy.collect()]
    piece = max(1, report["rows"] // (partitions * PIECES))
    kind = T.StructType([*[T.StructField(f"__h{i}", df.schema[k].dataType) for i, k in enumerate(keys)], T.StructField("__salts", T.IntegerType())])
    return df.sparkSession.createDataFrame([(*r[:-1], -(-r[-1] // piece)) for r in rows], kind)


def _marked(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    cond: Column = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__h{i}"))
    joined = df.join(F.broadcast(hot), cond, "left")  # bounded by hot_keys
    return joined.withColumn("__salts", F.coalesce("__salts", F.lit(1))).drop(*[f"__h{i}" for i in range(len(keys))])


def skew_left_enrich(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str], suffix: str = "_r",
                     fills: Mapping[str, object] | None = None, null_safe: bool = False, partitions: int | None = None) -> DataFrame:
    """``left_enrich`` with hot left keys salted; same rows. ``partitions``:
    those of the join, the session's shuffle partitions by default. The left
    side is read three times (count, hash slots, hot keys) before the join."""
    partitions = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, left_on, partitions)
    if hot.isEmpty():
        return left_enrich(left, right, left_on, right_on, suffix, fills, null_safe)
    dealt = _marked(left, left_on, hot).withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.col("__salts")).cast("int")).drop("__salts")
    copies = _marked(right, right_on, hot).withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
    return left_enrich(dealt, copies, [*left_on, "__salt"], [*right_on, "__salt_r"], suffix, fills, null_safe).drop("__salt")
