"""Helpers shared by the operators: scratch tables, Arrow text buffers and
vectorised word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.session import scratch_path

# Rows per Arrow batch handed to a Python worker: documents are a few kB, so a
# batch stays at a few MB. A property of the transfer, not of the result.
ARROW_ROWS = "512"
CHUNK_BYTES = 1 << 21  # bytes of text that the numpy steps look at together


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage at a table that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> int:
    """Reduce-side partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The id of a row; where it is null, a number from 2 ** 62 on that its text
    gives, so that rows without an id are told apart by their texts."""
    own = F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(1 << 61))
    return F.coalesce(F.col(doc_id).cast("long"), own + F.lit(1 << 62))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows
    (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    buffers = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows ``(first, end, bytes, offsets)`` of about ``limit``
    bytes; a longer row comes alone and whole."""
    n, first = len(offsets) - 1, 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + 1
_LOWER[0x41:0x5B] += 32
SOLID = ~_SPACE  # white space parts words
PLAIN = np.zeros(256, bool)  # letters and digits: so does punctuation
for _range in (range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100)):
    PLAIN[list(_range)] = True
_POWERS = np.ones(1, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            more = np.full(max(n, 64), _BASE, np.uint64)
            more[0] = 1
            _POWERS = np.multiply.accumulate(more)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row, runs of bytes of a ``kind`` (``SOLID``, ``PLAIN``):
    ``(starts, ends, row, hash)``; the hash is of the word with A-Z lower-cased."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    solid = kind[data]
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(solid)
    after[-1], after[:-1] = False, solid[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    if not len(starts):
        return starts, ends, row, np.zeros(0, np.uint64)
    gaps = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, gaps)
    longest = int(gaps.max())
    with np.errstate(over="ignore"):
        hashed = np.add.reduceat(np.where(solid, _LOWER[data], np.uint64(0))[starts[0]:] * _powers(longest)[place], starts - starts[0])
    return starts, ends, row, mix(hashed)


_SALT = mix(np.arange(1, 65, dtype=np.uint64) * _BASE) | np.uint64(1)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct ``n``-word shingles of one row's word hashes; a shorter
    sequence is one shingle, no word none."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    width = min(n, len(hashes))
    with np.errstate(over="ignore"):
        total = np.full(len(hashes) - width + 1, np.uint64(width) * _SALT[63], np.uint64)
        for k in range(width):
            total += hashes[k:len(hashes) - width + 1 + k] * _SALT[k]
    return np.unique(mix(total))


WORD = r"[^\x20\x09-\x0D]+"  # a word, as a pattern

# DuckDB SQL of the crc32 of a decimal id: its bytes, each followed by eight shifts, folded one after another.
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(CAST({0} AS VARCHAR), ''), lambda c: list_prepend(ascii(c)::BIGINT, [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
        lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, 3988292384 * (r & 1)) END), 4294967295::BIGINT)"""
