"""Relational building blocks: projections, filters, joins, dedup, top-k.

Each function is ``DataFrame -> DataFrame`` and only adds logical plan
nodes; Spark chooses the physical strategy. Where the reference depends on
row order ("first", "last"), an explicit total order is required instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.functions.columns import col, is_match, py_strip
from trackmart.session import stored

OrderSpec = Sequence[str | Column]


# --- projections (P-*) ------------------------------------------------------

def select_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order (P-01)."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that are absent are ignored (P-02)."""
    present = set(df.columns)
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in present})


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns if present (P-03)."""
    return df.drop(*[n for n in names if n in df.columns])


def add_defaults(df: DataFrame, defaults: Mapping[str, tuple[object, T.DataType | str]],
                 overwrite: bool = False) -> DataFrame:
    """Add typed constant columns (P-04); existing columns are kept unless
    ``overwrite``."""
    new = {name: F.lit(value).cast(dtype) for name, (value, dtype) in defaults.items()
           if overwrite or name not in df.columns}
    return df.withColumns(new) if new else df


_KINDS = {
    "numeric": (T.NumericType,),
    "text": (T.StringType, T.VarcharType, T.CharType),
    "boolean": (T.BooleanType,),
    "temporal": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Column names by type class (P-05). Booleans are not numeric."""
    classes = _KINDS[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, classes)]


# --- filters (F-*) ----------------------------------------------------------

def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """``dropna(subset=…)`` (F-01); every column of ``subset`` must exist."""
    missing = [c for c in subset if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.na.drop(how="any", subset=list(subset))


def exclude_values(df: DataFrame, column: str, values: Iterable[str],
                   strip: bool = True) -> DataFrame:
    """Drop rows whose (trimmed) value is in ``values`` (F-04); NULLs dropped first."""
    c = F.col(column)
    probe = py_strip(c) if strip else c
    return df.filter(c.isNotNull() & ~probe.isin(list(values)))


# --- joins (J-*) ------------------------------------------------------------

def left_enrich(left: DataFrame, right: DataFrame, left_on: Sequence[str],
                right_on: Sequence[str], suffix: str = "_r",
                fills: Mapping[str, object] | None = None,
                null_safe: bool = False, drop_right_keys: bool = True) -> DataFrame:
    """Left outer equi-join with key columns of different names (J-01, J-02).

    Clashing non-key columns of the right side get ``suffix``; right-side
    NULLs are filled from ``fills`` (typed ``coalesce``); right keys are
    dropped afterwards (P-03). Join strategy is left to the planner: AQE turns
    the sort-merge join into a broadcast join when the measured right side is
    below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and splits skewed
    left partitions otherwise, so no unchecked broadcast hint is given.
    """
    if len(left_on) != len(right_on):
        raise ValueError("left_on and right_on differ in length")
    clashes = (set(right.columns) & set(left.columns)) - set(right_on)
    right = right.withColumnsRenamed({c: c + suffix for c in clashes})
    # rename the right keys so the join condition is unambiguous
    rkeys = {k: f"__rk{i}" for i, k in enumerate(right_on)}
    right = right.withColumnsRenamed(rkeys)
    cond = None
    for lk, rk in zip(left_on, right_on):
        lc, rc = F.col(lk), F.col(rkeys[rk])
        e = lc.eqNullSafe(rc) if null_safe else (lc == rc)
        cond = e if cond is None else (cond & e)
    out = left.join(right, cond, "left")
    if drop_right_keys:
        out = out.drop(*rkeys.values())
    else:
        out = out.withColumnsRenamed({v: k for k, v in rkeys.items() if k not in left.columns})
    if fills:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()
                               if c in out.columns})
    return out


def match_report(df: DataFrame, matched: Column, name: str = "join") -> DataFrame:
    """One-row report ``(join, matched_rows, total_rows)`` (J-08)."""
    return df.agg(F.sum(matched.cast("bigint")).alias("matched_rows"),
                  F.count(F.lit(1)).alias("total_rows")) \
             .select(F.lit(name).alias("join"), F.coalesce("matched_rows", F.lit(0)).alias("matched_rows"),
                     "total_rows")


def nonzero_match_report(df: DataFrame, column: str, name: str = "join") -> DataFrame:
    """Report rows whose ``column`` is present and non-zero (J-08 + F-06)."""
    return match_report(df, is_match(column), name)


def pending_keys(candidates: DataFrame, done: DataFrame, key: str,
                 done_key: str | None = None) -> DataFrame:
    """Candidates not yet processed (J-04): a left anti join.

    NULL keys in ``done`` never exclude anything, as a set difference would.
    """
    done_key = done_key or key
    # distinct combines map-side, so one key with very many rows does not meet in a task
    finished = done.select(F.col(done_key).alias("__done")).filter(F.col("__done").isNotNull()).distinct()
    return candidates.join(finished, candidates[key] == finished["__done"], "left_anti")


def reindex(domain: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Counts re-indexed to a full domain; absent members get NULL (J-06)."""
    return domain.join(counts, on=key, how="left")


# --- dedup and set operations (D-*, U-*) -------------------------------------

def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row dedup, NULLs equal (D-01)."""
    return df.dropDuplicates()


def duplicate_counts(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row: ``rows``, ``duplicate_rows`` (rows beyond the first of each
    group, D-02/D-03) and ``rows_in_shared_keys`` (all members of groups
    larger than one, D-04). The group-by pre-aggregates map-side, so hot keys
    are counted, not shuffled row by row."""
    keys = list(subset) if subset else df.columns
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.sum("__n").cast("bigint").alias("rows"),
        (F.sum("__n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"),
        F.sum(F.when(F.col("__n") > 1, F.col("__n")).otherwise(0)).cast("bigint").alias("rows_in_shared_keys"),
    ).select(*[F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
               for c in ["rows", "duplicate_rows", "rows_in_shared_keys"]])


def total_order(df: DataFrame, leading: OrderSpec, exclude: Iterable[str] = ()) -> list[Column]:
    """``leading`` followed by every other column ascending: a total order,
    so "first" is deterministic without a row index. Mixed directions and
    explicit NULL placement come from the leading Column specs (S-01)."""
    used = {c for c in leading if isinstance(c, str)} | set(exclude)
    lead = [F.col(c) if isinstance(c, str) else c for c in leading]
    rest = [F.col(c).asc_nulls_last() for c in sorted(df.columns)
            if c not in used and _orderable(df.schema[c].dataType)]
    return lead + rest


def _orderable(t: T.DataType) -> bool:
    return not isinstance(t, (T.MapType, T.BinaryType))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: OrderSpec,
                   complete_order: bool = True) -> DataFrame:
    """Keep the first row per key under ``order`` (D-05, W-02).

    ``row_number() = 1`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so each map task sends at most one row per key: a key
    holding a third of the rows does not reach one reducer whole.
    """
    spec = total_order(df, order, exclude=keys) if complete_order else list(order)
    w = Window.partitionBy(*keys).orderBy(*spec)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def top_n_per_group(df: DataFrame, group: Sequence[str], order: OrderSpec, n: int,
                    rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group (W-03); same partial-limit plan as above."""
    w = Window.partitionBy(*group).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    return out.withColumnRenamed("__rn", rank_col) if rank_col else out.drop("__rn")


def upsert_latest(prior: DataFrame | None, new: DataFrame, keys: Sequence[str],
                  order: OrderSpec) -> DataFrame:
    """Keyed upsert: prior ∪ new, the latest arrival wins (D-06, U-01).

    ``order`` must put the winning row first (e.g. ``batch_id desc``).
    """
    both = new if prior is None else prior.unionByName(new, allowMissingColumns=True)
    return latest_per_key(both, keys, order)


def distinct_values(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Distinct values of one column (D-07)."""
    return df.select(F.col(column).alias(alias or column)).distinct()


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name (U-01)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


# --- sorts and top-k (S-*, T-*) ----------------------------------------------

def top_k_rows(df: DataFrame, k: int, order: OrderSpec) -> DataFrame:
    """``nlargest``-style top-k (T-01): ``orderBy().limit()`` is planned as
    ``TakeOrderedAndProject`` (a bounded per-partition heap, no full sort)."""
    return df.orderBy(*[F.col(c) if isinstance(c, str) else c for c in order]).limit(k)


def head_tail(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First and last ``n`` rows under an explicit order of column names
    (S-04), tagged ``position`` 'head'/'tail'. Both ends are bounded top-k
    plans; a table without an order has no "first" rows."""
    first = df.orderBy(*[F.col(c).asc() for c in order]).limit(n).withColumn("position", F.lit("head"))
    last = df.orderBy(*[F.col(c).desc() for c in order]).limit(n).withColumn("position", F.lit("tail"))
    return first.unionByName(last)


def value_counts(df: DataFrame, column: str, dropna: bool = True,
                 count_col: str = "count") -> DataFrame:
    """``value_counts`` (A-04/A-05, the bar-chart counts of A-19): one row
    per value with its count; ``dropna`` drops the NULL group (F-02)."""
    src = df.select(column)
    if dropna:
        src = src.filter(F.col(column).isNotNull())
    return src.groupBy(column).agg(F.count(F.lit(1)).alias(count_col))


def top_k_categories(df: DataFrame, column: str, k: int, dropna: bool = True,
                     count_col: str = "count") -> DataFrame:
    """Most frequent ``k`` values, ties by value (T-02/T-03)."""
    counts = value_counts(df, column, dropna, count_col)
    return top_k_rows(counts, k, [F.col(count_col).desc(), F.col(column).asc_nulls_last()])


def running_total(counts: DataFrame, order_col: str, value_col: str,
                  out_col: str = "cumulative") -> DataFrame:
    """Running sum over an already aggregated, small table (W-01)."""
    w = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn(out_col, F.sum(value_col).over(w))


def running_totals(df: DataFrame, order: Sequence[str], totals: Mapping[str, str], count_col: str | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Running sums over a whole table of any size (W-01): ``totals`` maps a new
    column to the one it sums, ``count_col`` numbers the rows from 1.

    Rows are range-partitioned by ``order`` (columns, ascending, NULL first;
    ties by all other columns) and stored; every partition is summed on its own
    and starts from the sum of those before it, so no task sees more than one
    range. Only the sums per partition, a row each, meet in a window. Rows that
    are equal in ``order`` share a range. NULL adds nothing.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = stored(df.repartitionByRange(n, *keys).withColumn("__part", F.spark_partition_id()), "running")
    own = {name: F.col(f"`{c}`") for name, c in totals.items()} | ({count_col: F.lit(1).cast("bigint")} if count_col else {})
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__part").agg(*[F.sum(c).alias(name) for name, c in own.items()])
    starts = starts.select("__part", *[F.coalesce(F.sum(f"`{name}`").over(before), F.lit(0)).alias(f"__start_{i}") for i, name in enumerate(own)])
    rest = total_order(df, list(order))[len(order):]
    upto = Window.partitionBy("__part").orderBy(*keys, *rest).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumns({f"__own_{i}": F.coalesce(F.sum(c).over(upto), F.lit(0)) for i, c in enumerate(own.values())})
    out = local.join(F.broadcast(starts), "__part")  # one row a partition
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[(F.col(f"__own_{i}") + F.col(f"__start_{i}")).alias(name) for i, name in enumerate(own)])


DIGEST_BITS = 1 << 27  # of a table of repeated numbers: 16 MB, broadcast


def repeated_bits(values: DataFrame, column: str, bits: int = DIGEST_BITS) -> DataFrame | None:
    """A table of ``bits`` bits, as rows of 4 kB, in which the bit of every
    number (bigint) that ``values`` has more than once is set; its size is
    fixed, so it may be broadcast. None if more than a quarter would be set."""
    twice = stored(values.select(F.col(column).alias("__v")).groupBy("__v").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__v"), "repeated")
    if twice.count() > bits // 4:
        return None
    place = f"pmod(__v, {bits})"
    rows = twice.select(F.expr(f"bitmap_bucket_number({place})").alias("__b"), F.expr(f"bitmap_bit_position({place})").alias("__at"))
    return rows.groupBy("__b").agg(F.expr("bitmap_construct_agg(__at)").alias("__bits"))


def maybe_repeated(df: DataFrame, column: str, table: DataFrame, out: str, bits: int = DIGEST_BITS) -> DataFrame:
    """``df`` with ``out``: true for every number of ``column`` that is repeated,
    and for some others that share a bit with one."""
    place = F.pmod(F.col(column), F.lit(bits))
    df = df.withColumn("__p", place).withColumn("__b", F.expr("bitmap_bucket_number(__p)")).join(F.broadcast(table), "__b", "left")
    at = F.expr("bitmap_bit_position(__p)")
    byte = F.conv(F.hex(F.col("__bits").substr((at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return df.withColumn(out, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("__b", "__p", "__bits")


def dedup_rows_by_digest(df: DataFrame, bits: int = DIGEST_BITS, digest: Column | None = None) -> DataFrame:
    """Full-row dedup, NULLs equal (D-01), for wide rows that mostly differ.

    Digests of 64 bits are counted, the only thing that is shuffled for all
    rows. Those met twice set bits in a table of fixed size, which is broadcast.
    A row whose bit is not set is alone and stays as it is; only the others are
    shuffled whole and compared by value, so neither equal digests of different
    rows nor bits shared by several digests change the result. With more
    repeated digests than a quarter of the bits, all rows are.
    """
    rows = df.withColumn("__digest", digest if digest is not None else F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    table = repeated_bits(rows, "__digest", bits)
    if table is None:
        return dedup_rows(df)
    marked = maybe_repeated(rows, "__digest", table, "__maybe", bits)
    plain = [F.col(f"`{c}`") for c in df.columns]
    return marked.filter("NOT __maybe").select(*plain).unionByName(dedup_rows(marked.filter("__maybe").select(*plain)))
