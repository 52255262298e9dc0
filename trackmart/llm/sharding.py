"""Sharding by a minimax contiguous partition.

Equal texts are atomic. Texts are ordered by a 16-bit prefix of their hash,
so the ordered atomic sizes are at most ``UNITS`` sums (a unit is one or more
whole groups of equal texts), whatever the number of rows; only these
sums reach the driver. The least capacity that ``shards`` contiguous runs can
keep is found by binary search with a greedy check and the cuts lie under it,
as near to equal sizes as it allows. A unit too large for an equal share gets a shard
alone first.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackmart.llm.common import prepare, stored, table

SHARDS = 16
UNITS = 65_536
CELL_ROWS = 10_000  # rows of a unit numbered in one group


def _runs(ends: np.ndarray, capacity: int, start: int = 0) -> int:
    """Greedy count of runs from unit ``start``; ``ends`` are running sums."""
    n, used, at = 0, int(ends[start - 1]) if start else 0, start
    while at < len(ends):
        at = int(np.searchsorted(ends, used + capacity, "right"))
        used = int(ends[at - 1])
        n += 1
    return n


def least_capacity(sizes: np.ndarray, shards: int) -> int:
    """The least capacity under which ``shards`` contiguous runs hold all."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return 0
    low = max(int(sizes.max()), -(-int(ends[-1]) // shards))
    high = low + int(sizes.max())
    while low < high:
        mid = (low + high) // 2
        if _runs(ends, mid) <= shards:
            high = mid
        else:
            low = mid + 1
    return low


def partition(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unit (shards in order of units, but for units that
    exceed an equal share of what is left: those come first, largest first)."""
    shard = np.zeros(len(sizes), np.int64)
    rest, taken = np.arange(len(sizes)), 0
    while len(rest) > 1 and shards - taken > 1:
        top = int(sizes[rest].argmax())
        if int(sizes[rest][top]) * (shards - taken) < int(sizes[rest].sum()):
            break
        shard[rest[top]] = taken
        rest, taken = np.delete(rest, top), taken + 1
    ends, left = np.cumsum(sizes[rest]), shards - taken
    capacity, at, used = least_capacity(sizes[rest], left), 0, 0
    while at < len(rest):
        most = int(np.searchsorted(ends, used + capacity, "right"))
        share = used + (int(ends[-1]) - used) / left
        even = int(np.searchsorted(ends, share, "left")) + 1  # first end at or over the share
        if even - 1 > at and share - ends[even - 2] < ends[min(even, len(ends)) - 1] - share:
            even -= 1
        cut = max(at + 1, min(even, most))
        if left == 1 or _runs(ends, capacity, cut) > left - 1:
            cut = most
        shard[rest[at:cut]] = shards - left
        at, used, left = cut, int(ends[cut - 1]), left - 1
    return shard


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    ``size`` is the text's bytes and one more; null and empty texts count as
    the same text. Repeated rows each have a slot; null ids are rows like
    others; other columns are ignored, whatever their names; no row gives no row.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 48).cast("int").alias("unit"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "shard-rows")
    units = rows.groupBy("unit").agg(F.sum("size").alias("size"), F.count("*").alias("n")).orderBy("unit").toArrow()  # at most UNITS rows
    unit, size, n = (units[c].to_numpy() for c in ("unit", "size", "n"))
    shard = partition(size, shards)
    salts = -(-n // max(CELL_ROWS, int(n.sum()) // UNITS))  # at most UNITS more than there are units

    plan = spark.createDataFrame(list(zip(unit.tolist(), shard.tolist(), salts.tolist(), strict=True)), "unit int, shard int, salts int")
    rows = rows.join(F.broadcast(plan), "unit").withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")).cast("int"))
    cells = rows.groupBy("shard", "unit", "salt").agg(F.count("*").alias("n")).orderBy("shard", "unit", "salt").toArrow()
    of, counts = cells["shard"].to_numpy(), cells["n"].to_numpy()
    before = np.cumsum(counts) - counts
    base = before - before[np.searchsorted(of, of)] if len(of) else before
    bases = spark.createDataFrame(
        list(zip(cells["unit"].to_pylist(), cells["salt"].to_pylist(), base.tolist(), strict=True)), "unit int, salt int, base long")
    place = F.row_number().over(Window.partitionBy("unit", "salt").orderBy("doc_id", "row")) - 1
    return rows.withColumn("place", place).join(F.broadcast(bases), ["unit", "salt"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents in sixteen shards of near equal bytes."""
    prepare(spark)
    return shard_documents(table(spark, sf_dir, "documents"))
