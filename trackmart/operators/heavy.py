"""Heavy hitters with bounded memory (T-02, T-03) and their proof.

Every value is hashed to one slot in each of ``ROWS`` tables of ``SLOTS``
slots, and slots are counted: a mergeable aggregate of ``ROWS * SLOTS`` rows
whatever the number of distinct values. A value is in no slot that counts less
than it, so values with a slot under a threshold can't reach it; only the
others are counted exactly. Results are exact always; where the slots rule out
too little, all values are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart.operators.relational import top_k_rows

SLOTS = 1 << 13
ROWS = 2
MOSTLY = 0.5  # from this share of the rows on, all values are counted


def _slot(keys: Sequence[Column], row: int, slots: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), *keys), F.lit(slots)).cast("int")


def slot_counts(df: DataFrame, keys: Sequence[str], slots: int = SLOTS, rows: int = ROWS) -> DataFrame:
    """``(row, slot, n)``: an additive state; states of several batches add up
    to the state of all."""
    cols = [F.col(k) for k in keys]
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("row"), _slot(cols, r, slots).alias("slot")) for r in range(rows)]))
    return df.select(each.alias("s")).groupBy("s.row", "s.slot").agg(F.count(F.lit(1)).alias("n"))


def _counted(df: DataFrame, keys: Sequence[str], slots: int, rows: int) -> list[dict[int, int]]:
    """Slot counts in the driver: ``rows * slots`` numbers at most."""
    out: list[dict[int, int]] = [{} for _ in range(rows)]
    for r in slot_counts(df, keys, slots, rows).collect():
        out[r["row"]][r["slot"]] = r["n"]
    return out


def _within(keys: Sequence[str], allowed: list[list[int]], slots: int) -> Column:
    """Whether the slots of a row's value are among those allowed, in each table."""
    names, cond = [F.col(k) for k in keys], F.lit(True)
    for row, own in enumerate(allowed):
        if len(own) < slots:
            cond = cond & (_slot(names, row, slots).isin(own) if own else F.lit(False))
    return cond


def _count(df: DataFrame, keys: Sequence[str], count_col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def heavy_keys(df: DataFrame, keys: Sequence[str], least: int, count_col: str = "count",
               slots: int = SLOTS, rows: int = ROWS, report: dict | None = None) -> DataFrame:
    """All keys with ``least`` rows or more and their exact counts. NULL is a
    key like others. Rows of keys that the slots rule out are not shuffled."""
    state = _counted(df.select(*keys), keys, slots, rows)
    allowed = [[s for s, n in table.items() if n >= least] for table in state]
    total = sum(state[0].values())
    open_ = min((sum(table[s] for s in own) for table, own in zip(state, allowed, strict=True)), default=0)
    full = open_ > MOSTLY * total
    if report is not None:
        report.update(rows=total, open_rows=open_, full=full)
    source = df.select(*keys)
    if not full:
        source = source.filter(_within(keys, allowed, slots))
    return _count(source, keys, count_col).filter(F.col(count_col) >= least)


def top_k_heavy(df: DataFrame, column: str, k: int, dropna: bool = True, count_col: str = "count",
                slots: int = SLOTS, rows: int = ROWS, report: dict | None = None) -> DataFrame:
    """The ``k`` most frequent values with exact counts, ties by value: what
    ``top_k_categories`` gives.

    The values in the fullest slots are counted first; the ``k``-th of these
    counts bounds the wanted ones from below, so only values whose slots all
    reach it are counted. If that is most rows, all are. ``report`` gets the
    bound and the rows that were counted.
    """
    if k < 1:
        raise ValueError("k must be positive")
    values = df.select(column)
    if dropna:
        values = values.filter(F.col(column).isNotNull())
    state = _counted(values, [column], slots, rows)
    total = sum(state[0].values())
    probe = sorted(state[0], key=lambda s: (-state[0][s], s))[:4 * k]
    best = top_k_rows(_count(values.filter(_within([column], [probe], slots)), [column], count_col), k, [F.col(count_col).desc()]).collect()
    bound = best[-1][count_col] if len(best) == k else 1
    allowed = [[s for s, n in table.items() if n >= bound] for table in state]
    open_ = min((sum(table[s] for s in own) for table, own in zip(state, allowed, strict=True)), default=0)
    full = open_ > MOSTLY * total
    if report is not None:
        report.update(rows=total, bound=bound, open_rows=open_, full=full)
    source = values if full else values.filter(_within([column], allowed, slots))
    return top_k_rows(_count(source, [column], count_col), k, [F.col(count_col).desc(), F.col(column).asc_nulls_last()])
