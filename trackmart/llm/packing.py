"""Best-fit packing of tokenised documents with certified bin counts.

Pieces are dealt to cells of a bounded number of pieces. Each cell runs
best-fit decreasing and compares its bin count with a lower bound from dual
feasible functions over its length histogram. A cell that meets the bound is
certified. Cells with a gap give up the pieces of their unfilled bins, and
every cell gives up its emptiest bin, so that the remainders of all cells meet; those
pieces are dealt anew and packed again, until no gap is left, one cell holds
all that is exchanged, or an exchange saves no bin (then the packing before it
stands).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import prepare, stored, table, text_bytes
from trackmart.llm.tokens import encoder, vocabulary

CAPACITY = 2048
END_ID = 0
CELL_PIECES = 16_384
FAMILY = 12  # rounding functions of the bound

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int):
    ready = encoder(path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ready()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode.ids(data, offsets), strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    out.append((row, doc, piece, start, len(part), zlib.crc32(part.tobytes())))
                    row += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*out, strict=True) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             names=[x.split()[0] for x in PIECES.split(", ")])
    return cut


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that pieces of ``counts[length]`` need at least: the best of the
    dual feasible functions "forget lengths under e, round lengths over
    capacity - e up" followed by "round down to steps of 1 / k"."""
    sizes = np.flatnonzero(counts)
    if not len(sizes):
        return 0
    n = counts[sizes].astype(np.int64)
    best = -(-int((sizes * n).sum()) // capacity)
    steps = []
    for k in range(1, FAMILY + 1):  # scaled by k * capacity
        whole = (k + 1) * np.arange(capacity + 1) % capacity == 0
        steps.append((k, np.where(whole, k * np.arange(capacity + 1), (k + 1) * np.arange(capacity + 1) // capacity * capacity)))
    for e in [0, *sizes[sizes <= capacity // 2] + 1]:
        kept = np.where(sizes > capacity - e, capacity, np.where(sizes < e, 0, sizes))
        best = max(best, -(-int((kept * n).sum()) // capacity), *(-(-int((f[kept] * n).sum()) // (k * capacity)) for k, f in steps))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each piece's bin and offset, and the bins' loads."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left: list[int] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    mask = 0
    for place in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[place])
        fitting = mask >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                mask &= ~(1 << room)
        else:
            room, at = capacity, len(left)
            left.append(capacity)
        bins[place], offsets[place] = at, capacity - room
        left[at] = room - need
        if room > need:
            free[room - need].append(at)
            mask |= 1 << room - need
    return bins, offsets, capacity - np.array(left, np.int64)


PLACED = PIECES + ", cell long, bin long, offset long, load long, emptiest boolean, bins long, bound long"


def _packer(capacity: int):
    def pack(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("row", ignore_index=True)  # the same result however rows arrive
        bins, offsets, loads = best_fit(cell["length"].to_numpy(), capacity)
        bound = lower_bound(np.bincount(cell["length"], minlength=capacity + 1), capacity)
        return cell.assign(bin=bins, offset=offsets, load=loads[bins], emptiest=bins == int(loads.argmin()), bins=len(loads), bound=bound)
    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Columns of ``PIECES`` and ``sequence_id, offset, certified``."""
    whole = pieces.where(F.col("length") == capacity).withColumns(
        {"sequence_id": F.col("row"), "offset": F.lit(0).cast("long"), "certified": F.lit(True)})
    todo = pieces.where(F.col("length") < capacity)
    finished, before, turn = [whole], None, 0
    while True:
        n = todo.count()
        if not n:
            break
        cells = -(-n // CELL_PIECES)
        dealt = todo.withColumn("cell", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(cells)))
        placed = stored(dealt.groupBy("cell").applyInPandas(_packer(capacity), PLACED), f"packing-{turn}")
        per_cell = placed.groupBy("cell").agg(F.first("bins").alias("bins"), F.first("bound").alias("bound"))
        bins, gap = per_cell.agg(F.sum("bins"), F.sum(F.col("bins") - F.col("bound"))).first()
        number = -1 - ((F.lit(turn).cast("long") * (1 << 28) + F.col("cell")) * (1 << 24) + F.col("bin"))
        result = placed.withColumns({"sequence_id": number, "certified": F.col("bins") == F.col("bound")})
        if before is not None and bins >= before[0]:
            finished.append(before[1])  # this exchange saved nothing
            break
        released = (F.col("load") < capacity) & ((F.col("bins") > F.col("bound")) | F.col("emptiest"))
        if cells == 1:
            finished.append(result)
            break
        finished.append(result.where(~released))
        todo = result.where(released).select(*pieces.columns)
        again = result.where(released)
        before = (again.select("cell", "bin").distinct().count(), again)
        if not before[0]:
            break
        turn += 1
    names = [*pieces.columns, "sequence_id", "offset", "certified"]
    every = finished[0].select(*names)
    for part in finished[1:]:
        every = every.unionByName(part.select(*names))
    return every


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every row's ids and an end id, at most ``capacity`` long.

    Null and empty texts are one piece with the end id alone; repeated rows
    are packed as often as they come; a null id stays null; other columns are
    ignored, whatever their names; no row gives no piece.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(_pieces(path, capacity), PIECES), "pieces")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset, certified`` (cases: see ``token_pieces``)."""
    return pack(token_pieces(docs, path or vocabulary(), capacity=capacity), capacity).drop("row")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents in sequences of 2048 tokens."""
    prepare(spark)
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the packed pieces of all documents it is given.
    Null and empty texts are one piece each, repeated rows are packed as often
    as they come, null ids stay null, other columns are dropped; no row gives
    no piece."""
    prepare(spark)
    return pack_documents(docs)
