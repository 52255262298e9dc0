"""Column profiling: counts, null profiles, describe, exact quantiles,
histograms, kernel density, value counts, group sizes.

Everything is computed by Spark aggregates; results are small tables.
Scalars are pulled to the driver only where a later plan needs them as
literals (histogram edges, density grid, quantile brackets), which also lets
them be pushed into scans.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.functions.columns import coerce_long, nan_to_null
from trackmart.operators.relational import columns_of_kind, top_k_rows

# Largest number of values an exact quantile may hold in one task; above it
# the bracket refinement below is used.
EXACT_QUANTILE_BOUND = 50_000
APPROX_ACCURACY = 10_000  # for approx=True


def missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN in a floating column: the reference has one missing marker."""
    col = F.col(f"`{c}`")
    return col.isNull() | F.isnan(col) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else col.isNull()


# --- counts (A-01..A-03, A-06..A-08) -----------------------------------------

def shape(df: DataFrame) -> DataFrame:
    """``(rows, columns)`` (A-01)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("bigint"))


def quality_report(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Report printed after a clean (E-11), as one long table
    ``(item, column, value)``: row and column counts, the type and NULL
    count of every column, and the duplicate rows left (full-row, or on
    ``key``). One aggregate for the counts and one grouped count for the
    duplicates."""
    from trackmart.operators.relational import duplicate_counts
    spark = df.sparkSession
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.sum(missing(df, c).cast("bigint")).alias(f"n{i}") for i, c in enumerate(cols)])
    dups = duplicate_counts(df, key)
    row_items = counts.select(F.explode(F.array(
        F.struct(F.lit("rows").alias("item"), F.lit(None).cast("string").alias("column"),
                 F.col("rows").cast("string").alias("value")),
        *[F.struct(F.lit("nulls").alias("item"), F.lit(c).alias("column"),
                   F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("string").alias("value")) for i, c in enumerate(cols)]
    )).alias("p")).select("p.*")
    dup_items = dups.select(F.lit("duplicate_rows").alias("item"),
                            F.lit(",".join(key) if key else None).cast("string").alias("column"),
                            F.col("duplicate_rows").cast("string").alias("value"))
    schema_items = spark.createDataFrame(
        [("columns", None, str(len(cols)))] + [("dtype", f.name, f.dataType.simpleString()) for f in df.schema.fields],
        "item string, column string, value string")
    return row_items.unionByName(dup_items).unionByName(schema_items)


def group_size(df: DataFrame, keys: Sequence[str], count_col: str = "count") -> DataFrame:
    """``groupby(k).size()`` (A-02); NULL keys dropped as pandas does."""
    cond = None
    for k in keys:
        e = F.col(k).isNotNull()
        cond = e if cond is None else cond & e
    return df.filter(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def group_nunique(df: DataFrame, keys: Sequence[str], column: str,
                  out_col: str = "n_unique") -> DataFrame:
    """``groupby(k)[c].nunique()`` (A-03); NULL keys dropped."""
    cond = None
    for k in keys:
        e = F.col(k).isNotNull()
        cond = e if cond is None else cond & e
    return df.filter(cond).groupBy(*keys).agg(F.count_distinct(column).alias(out_col))


def n_categories(df: DataFrame, column: str) -> DataFrame:
    """Number of categories including the NULL group (A-06)."""
    return df.agg((F.count_distinct(column)
                   + F.max(F.col(column).isNull().cast("bigint"))).cast("bigint").alias("n_categories"))


def safe_sum(df: DataFrame, keys: Sequence[str], column: str, out_col: str) -> DataFrame:
    """Sum of values parsed as integers; NULL / non-numeric skipped, an empty
    group sums to 0 (A-20)."""
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum(coerce_long(column)), F.lit(0).cast("bigint")).alias(out_col))


# --- null profile (A-09..A-11) -----------------------------------------------

def null_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Nulls per column, count and percentage (A-10, A-11); one aggregate,
    then an unpivot of the single result row."""
    cols = df.columns
    sums = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.sum(missing(df, c).cast("bigint")).alias(f"n{i}") for i, c in enumerate(cols)])
    long = sums.select("__rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"n{i}"), F.lit(0).cast("bigint")).alias("null_count"))
        for i, c in enumerate(cols)])).alias("p")).select(
        "p.column", "p.null_count",
        (F.col("p.null_count") / F.nullif(F.col("__rows"), F.lit(0)) * 100.0).alias("null_pct"))
    if only_missing:
        long = long.filter(F.col("null_count") > 0)
    return long.orderBy(F.col("null_count").desc(), F.col("column"))  # S-02, on a tiny result


def total_nulls(df: DataFrame) -> DataFrame:
    """All NULL cells of a table (A-09)."""
    return null_profile(df, only_missing=False).agg(
        F.coalesce(F.sum("null_count"), F.lit(0)).cast("bigint").alias("total_nulls"))


# --- exact quantiles (A-15) -------------------------------------------------

def _interpolate(values: dict[int, float], n: int, q: float) -> float | None:
    if n == 0:
        return None
    pos = q * (n - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    return values[lo] + (pos - lo) * (values[hi] - values[lo])


def _ranks(n: int, qs: Sequence[float]) -> list[int]:
    out = set()
    for q in qs:
        pos = q * (n - 1)
        out.update({math.floor(pos), math.ceil(pos)})
    return sorted(out)


SKETCH_ACCURACY = 2000  # a sketched rank is off by at most rows / SKETCH_ACCURACY
SPLITTERS = 64


def exact_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float],
                    bound: int = EXACT_QUANTILE_BOUND, buckets: int = SPLITTERS,
                    extra: Sequence[Column] = (), extra_out: dict | None = None,
                    materialize: bool = False) -> dict[tuple[str, float], float | None]:
    """Exact quantiles (linear interpolation between order statistics, as
    pandas ``quantile`` and Spark's ``percentile``) of any number of columns.

    Three scans, all columns at once:

    1. count, min, max (plus any ``extra`` aggregates over the columns named
       ``x0, x1, ...`` in their order) and a mergeable sketch that brackets
       every wanted rank;
    2. the exact count below and inside each bracket;
    3. the distinct values (with counts) inside the brackets; Spark runs the
       counts, the driver gets the value at each wanted rank only.

    A bracket that still holds more than ``bound`` values (billions of rows)
    is first narrowed by ``buckets`` sketched splitters of its inside, about
    twentyfold a round whatever the distribution; a round also settles its two end values, so every
    round makes progress and the loop ends when all brackets are small.

    ``materialize`` writes the projected columns once as a reliable
    checkpoint (``spark.checkpoint.dir``) when ``df`` is an expensive plan,
    so the later passes do not recompute it.
    """
    # Expressions are written as SQL text: one parse per expression instead
    # of a gateway round trip per Column operator.
    cols = list(columns)
    data = df.selectExpr(*[f"{_num_sql(c)} AS x{i}" for i, c in enumerate(cols)])
    if materialize:
        from trackmart.session import cut_lineage
        data = cut_lineage(data)
    slack = 2.0 / SKETCH_ACCURACY
    ends = [min(max(q + d, 0.0), 1.0) for q in qs for d in (-slack, slack)]
    first = data.agg(
        *[F.expr(f"{f}(x{i}) AS {a}{i}") for i in range(len(cols)) for f, a in (("count", "n"), ("min", "lo"), ("max", "hi"))],
        *[F.expr(f"percentile_approx(x{i}, array({', '.join(map(_dlit, ends))}), {SKETCH_ACCURACY}) AS s{i}") for i in range(len(cols))],
        *extra).first()
    if extra_out is not None:
        extra_out.update(first.asDict())
    n_of = {c: first[f"n{i}"] for i, c in enumerate(cols)}
    ix = {c: i for i, c in enumerate(cols)}
    # per (column, rank): a closed range of values that holds it
    wanted: dict[tuple[str, int], tuple[float, float]] = {}
    for i, c in enumerate(cols):
        n = n_of[c]
        for k, q in enumerate(qs if n else ()):
            # ends of the column are exact, a rank within the sketch's error of them takes them
            lo = first[f"lo{i}"] if q <= slack or n <= SKETCH_ACCURACY else first[f"s{i}"][2 * k]
            hi = first[f"hi{i}"] if q >= 1 - slack or n <= SKETCH_ACCURACY else first[f"s{i}"][2 * k + 1]
            for r in _ranks(n, [q]):
                a, b = wanted.get((c, r), (lo, hi))
                wanted[(c, r)] = (max(a, lo), min(b, hi))
    whole = {c: (first[f"lo{i}"], first[f"hi{i}"]) for i, c in enumerate(cols)}
    state = _counted(data, ix, wanted, {c: (0, n) for c, n in n_of.items()}, whole)
    while open_keys := [k for k, v in state.items() if v[3] > bound and v[0] != v[1]]:
        state |= _narrowed(data, ix, {k: state[k] for k in open_keys}, buckets)
    value_at = {k: v[0] for k, v in state.items() if v[0] == v[1]}
    value_at |= _values_at(data, ix, {k: v for k, v in state.items() if v[0] != v[1]})
    out = {}
    for c in cols:
        stats = {r: v for (cc, r), v in value_at.items() if cc == c}
        for q in qs:
            out[(c, q)] = _interpolate(stats, n_of[c], q)
    return out


def _counted(data: DataFrame, ix: dict, wanted: dict, base: dict, whole: dict) -> dict:
    """``(lo, hi, values below lo, values inside)`` for each wanted range of
    a rank, counted exactly; a range that misses its rank becomes ``whole``."""
    if not wanted:
        return {}
    ranges = sorted({(c, *v) for (c, _), v in wanted.items()}, key=str)
    got = data.agg(*[F.expr(f"count_if({cond}) AS c{j}_{t}") for j, (c, lo, hi) in enumerate(ranges)
                     for t, cond in (("b", f"x{ix[c]} < {_dlit(lo)}"), ("i", _sql_in_bracket(f"x{ix[c]}", lo, hi)))]).first()
    count = {rng: (got[f"c{j}_b"], got[f"c{j}_i"]) for j, rng in enumerate(ranges)}
    state = {}
    for (c, r), (lo, hi) in wanted.items():
        below, inside = count[(c, lo, hi)]
        state[(c, r)] = (lo, hi, below, inside) if below <= r < below + inside else (*whole[c], *base[c])
    return state


def _narrowed(data: DataFrame, ix: dict, state: dict, buckets: int) -> dict:
    """One round for ranges with too many values: ranks on an end value are
    settled, the others get a bracket between splitters of the inside."""
    ranges = sorted({(c, *v) for (c, _), v in state.items()}, key=str)
    points = ", ".join(_dlit(k / buckets) for k in range(buckets + 1))
    aggs = []
    for j, (c, lo, hi, _, _) in enumerate(ranges):
        x = f"x{ix[c]}"
        inner = f"CASE WHEN {x} > {_dlit(lo)} AND {x} < {_dlit(hi)} THEN {x} END"
        aggs += [f"count_if({x} = {_dlit(lo)}) AS a{j}", f"count({inner}) AS n{j}", f"min({inner}) AS lo{j}", f"max({inner}) AS hi{j}",
                 f"percentile_approx({inner}, array({points}), {SKETCH_ACCURACY}) AS s{j}"]
    got = data.agg(*map(F.expr, aggs)).first()
    place = {rng: j for j, rng in enumerate(ranges)}
    done, wanted, base, whole = {}, {}, {}, {}
    for (c, r), v in state.items():
        lo, hi, below, inside = v
        j = place[(c, *v)]
        low, n = got[f"a{j}"], got[f"n{j}"]
        if r < below + low:
            done[(c, r)] = (lo, lo, below, low)
        elif r >= below + low + n:
            done[(c, r)] = (hi, hi, below + low + n, inside - low - n)
        else:
            share = (r - below - low) / max(n - 1, 1) * buckets
            k = max(math.floor(share - 1), 0), min(math.ceil(share + 1), buckets)
            ends = (got[f"lo{j}"] if k[0] == 0 else got[f"s{j}"][k[0]], got[f"hi{j}"] if k[1] == buckets else got[f"s{j}"][k[1]])
            wanted[(c, r)] = ends
            base[(c, r)], whole[(c, r)] = (below + low, n), (got[f"lo{j}"], got[f"hi{j}"])
    counted = _counted(data, ix, wanted, {c: (-1, -1) for c, _ in wanted}, {c: (None, None) for c, _ in wanted})
    done |= {k: v if v[2] >= 0 else (*whole[k], *base[k]) for k, v in counted.items()}
    return done


def _values_at(data: DataFrame, ix: dict, state: dict) -> dict:
    """The value at each rank of ranges with few values."""
    if not state:
        return {}
    brackets = sorted({(c, v[0], v[1]) for (c, _), v in state.items()}, key=str)
    index = {b: j for j, b in enumerate(brackets)}
    keys = list(state)
    conds = [_sql_in_bracket(f"x{ix[c]}", lo, hi) for c, lo, hi in brackets]
    tags = ", ".join(f"CASE WHEN {cond} THEN named_struct('j', {j}, 'v', x{ix[c]}) END"
                     for j, ((c, _, _), cond) in enumerate(zip(brackets, conds)))
    tagged = (data.filter(" OR ".join(f"({cond})" for cond in conds))
              .selectExpr(f"explode(array({tags})) AS e").filter("e IS NOT NULL"))
    per_value = tagged.groupBy("e.j", "e.v").agg(F.count(F.lit(1)).alias("k"))
    targets = data.sparkSession.createDataFrame(
        [(t, index[(c, *state[(c, r)][:2])], r - state[(c, r)][2]) for t, (c, r) in enumerate(keys)],
        "t int, j int, off bigint")
    running = Window.partitionBy("j").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (per_value.withColumn("cum", F.sum("k").over(running)).join(targets, "j")
             .filter((F.col("cum") - F.col("k") <= F.col("off")) & (F.col("off") < F.col("cum")))
             .select("t", "v").collect())
    return {keys[row["t"]]: row["v"] for row in found}


def _dlit(v) -> str:
    """A double as SQL literal text."""
    v = float(v)
    if math.isnan(v):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(v):
        return f"CAST('{'' if v > 0 else '-'}Infinity' AS DOUBLE)"
    return f"{v!r}D" if v >= 0 else f"({v!r}D)"


def _sql_in_bracket(x: str, lo, hi) -> str:
    cond = f"{x} IS NOT NULL"
    if lo is not None:
        cond += f" AND {x} >= {_dlit(lo)}"
    if hi is not None:
        cond += f" AND {x} <= {_dlit(hi)}"
    return cond


def quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float],
              bound: int = EXACT_QUANTILE_BOUND, approx: bool = False,
              materialize: bool = False) -> DataFrame:
    """Quantiles in long form ``(column, q, value)``: exact by default
    (``exact_quantiles``), or Spark's ``percentile_approx`` with ``approx``."""
    spark = df.sparkSession
    qs = [float(q) for q in qs]
    if approx:
        agg = df.agg(*[F.percentile_approx(c, qs, APPROX_ACCURACY).alias(f"c{i}")
                       for i, c in enumerate(columns)])
        return _quantile_long(agg, columns, qs)
    got = exact_quantiles(df, columns, qs, bound, materialize=materialize)
    rows = [(c, q, got[(c, q)]) for c in columns for q in qs]
    return spark.createDataFrame(rows, "column string, q double, value double")


def _quantile_long(agg: DataFrame, columns: Sequence[str], qs: Sequence[float]) -> DataFrame:
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(q).alias("q"),
                 F.col(f"c{i}")[j].cast("double").alias("value"))
        for i, c in enumerate(columns) for j, q in enumerate(qs)])).alias("p")).select("p.*")


def quantile_value(df: DataFrame, column: str, q: float, approx: bool = False) -> float | None:
    """One quantile as a driver scalar (used as a literal by later plans)."""
    row = quantiles(df, [column], [q], approx=approx).first()
    return None if row is None else row["value"]


def cap_by_quantile(df: DataFrame, column: str, q: float, lower: float = 0.0,
                    approx: bool = False) -> DataFrame:
    """Rows within ``[lower, quantile(q)]`` (F-07). The cap is a literal, so
    the range filter reaches the Parquet scan."""
    cap = quantile_value(df, column, q, approx)
    return df.filter(F.col(column).between(F.lit(lower), F.lit(cap)))


# --- describe (A-12, A-13) ----------------------------------------------------

def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                     approx: bool = False, materialize: bool = False) -> DataFrame:
    """pandas-style numeric describe in long form: ``(column, count, mean,
    std, min, p25, p50, p75, max)``; std has ddof=1, quartiles interpolate.
    count/mean/std/min/max ride along the first quantile scan."""
    spark = df.sparkSession
    cols = list(columns) if columns else columns_of_kind(df, "numeric")
    xs = [F.col(f"x{i}") for i in range(len(cols))]
    stats = [e for i, x in enumerate(xs) for e in (
        F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"))]
    qs = [0.25, 0.5, 0.75]
    row: dict = {}
    if approx:
        agg = df.select(*[_num(c).alias(f"x{i}") for i, c in enumerate(cols)]).agg(
            *[F.count(x).alias(f"n{i}") for i, x in enumerate(xs)], *stats,
            *[F.percentile_approx(x, qs, APPROX_ACCURACY).alias(f"p{i}") for i, x in enumerate(xs)]).first()
        row = agg.asDict()
        got = {(c, q): (row[f"p{i}"] or [None] * 3)[k] for i, c in enumerate(cols) for k, q in enumerate(qs)}
    else:
        got = exact_quantiles(df, cols, qs, extra=stats, extra_out=row, materialize=materialize)
    rows = [(c, row[f"n{i}"], row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"], got[(c, 0.25)], got[(c, 0.5)],
             got[(c, 0.75)], row[f"hi{i}"]) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "column string, count bigint, mean double, std double, min double, "
                                       "p25 double, p50 double, p75 double, max double")


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unpivot to ``(column, value)`` with the value as text."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("p")).select("p.*")


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """pandas-style text describe: ``(column, count, unique, top, freq)``;
    ``top`` is the most frequent value, ties broken by the smaller value."""
    cols = list(columns) if columns else columns_of_kind(df, "text")
    counts = (_long_values(df, cols).filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq")))
    summary = counts.groupBy("column").agg(F.sum("freq").cast("bigint").alias("count"),
                                           F.count(F.lit(1)).alias("unique"))
    w = Window.partitionBy("column").orderBy(F.col("freq").desc(), F.col("value").asc())
    top = (counts.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
           .select("column", F.col("value").alias("top"), "freq"))
    return summary.join(top, "column").select("column", "count", "unique", "top", "freq")


# --- column profile (A-14) -----------------------------------------------------

SAMPLE_ALL_UP_TO = 50
SAMPLE_TRUNCATED = 20  # the channel notebook shows 10: pass truncated=10
SAMPLE_PROBE = 10_000  # rows that bound the sample from above before its distinct values are shuffled


def _shown(c: str, kind: T.DataType) -> tuple[str, str]:
    """A raw value as ``(number, text)`` SQL for display: numbers as double,
    timestamps with their microseconds, the rest as text."""
    if isinstance(kind, T.NumericType):
        return f"CAST({c} AS DOUBLE)", "CAST(NULL AS STRING)"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "CAST(NULL AS DOUBLE)", f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    return "CAST(NULL AS DOUBLE)", f"CAST({c} AS STRING)"


def _raw(df: DataFrame, c: str) -> Column:
    """A column's value with NaN as NULL; types without an order as text."""
    kind = df.schema[c].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`"))
    if isinstance(kind, (T.MapType, T.VariantType)):
        return F.col(f"`{c}`").cast("string")
    return F.col(f"`{c}`")


def _by_type(df: DataFrame, cols: Sequence[str]) -> list[tuple[T.DataType, DataFrame]]:
    """The table unpivoted to ``(pos, value)``, once for each type of its
    columns, so values keep their type; missing values left out."""
    raw = df.select(*[_raw(df, c).alias(f"v{i}") for i, c in enumerate(cols)])
    groups: dict[str, list[int]] = {}
    for i in range(len(cols)):
        groups.setdefault(raw.schema[i].dataType.simpleString(), []).append(i)
    return [(raw.schema[own[0]].dataType, raw.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.col(f"v{i}").alias("value")) for i in own])).alias("p")).select("p.*")
        .filter(F.col("value").isNotNull())) for own in groups.values()]


def _profile_rows(df: DataFrame, cols: list[str], unique) -> DataFrame:
    """Rows, NULLs, min and max of every column from one wide aggregate."""
    raw = df.select(*[_raw(df, c).alias(f"v{i}") for i, c in enumerate(cols)])
    agg = raw.agg(F.count(F.lit(1)).alias("rows"), *[e for i in range(len(cols)) for e in (
        F.count(f"v{i}").alias(f"n{i}"), F.min(f"v{i}").alias(f"a{i}"), F.max(f"v{i}").alias(f"b{i}"),
        *([unique(f"v{i}").alias(f"u{i}")] if unique else []))])
    long = agg.select("rows", F.explode(F.array(*[F.struct(
        F.lit(i).alias("pos"), F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
        F.col(f"n{i}").alias("non_null"), *([F.col(f"u{i}").alias("n_unique")] if unique else []),
        *[F.expr(x).alias(f"{f}_{t}") for f, v in (("min", f"a{i}"), ("max", f"b{i}"))
          for t, x in zip(("num", "text"), _shown(v, raw.schema[i].dataType))])
        for i, c in enumerate(cols)])).alias("p")).select("rows", "p.*")
    return long


def column_profile(df: DataFrame, columns: Sequence[str] | None = None,
                   truncated: int = SAMPLE_TRUNCATED, approx: bool = False, all_up_to: int = SAMPLE_ALL_UP_TO) -> DataFrame:
    """Column profile (A-07 distinct count, A-08 min/max, A-14 sample sizes).

    Per column: rows, nulls (NaN counts), distinct count, min and max (numeric
    in ``min_num``/``max_num``, others as text), and how many sorted distinct
    values the sample shows and how many remain. The reference prints all
    values of a column with up to 50, else the first 20: ``all_up_to`` and
    ``truncated``.

    Counts, min and max are one wide aggregate without a shuffle of values;
    only the exact distinct count groups values, raw and by type. With
    ``approx`` it is a HyperLogLog sketch (about 1 % relative error) in the
    wide aggregate too."""
    cols = list(columns) if columns else df.columns
    rows = _profile_rows(df, cols, (lambda v: F.approx_count_distinct(v, rsd=0.01)) if approx else None)
    if not approx:
        parts = [values.groupBy("pos", "value").agg(F.lit(1).alias("one")).groupBy("pos").agg(F.count("*").alias("n_unique"))
                 for _, values in _by_type(df, cols)]
        counts = parts[0]
        for part in parts[1:]:
            counts = counts.unionByName(part)
        rows = rows.join(counts, "pos", "left").withColumn("n_unique", F.coalesce("n_unique", F.lit(0)))
    shown = F.when(F.col("n_unique") <= all_up_to, F.col("n_unique")).otherwise(F.lit(truncated).cast("bigint"))
    return rows.select("pos", "column", "dtype", "rows", (F.col("rows") - F.col("non_null")).alias("nulls"), "n_unique",
                       "min_num", "max_num", "min_text", "max_text", shown.alias("n_shown"), (F.col("n_unique") - shown).alias("n_more"))


def column_samples(df: DataFrame, columns: Sequence[str] | None = None,
                   truncated: int = SAMPLE_TRUNCATED, all_up_to: int = SAMPLE_ALL_UP_TO) -> DataFrame:
    """The sorted distinct sample of each column, long form
    ``(column, rank, value_num, value_text)``: all distinct values up to
    ``all_up_to`` (50), else the first ``truncated`` (20), the reference's rule.

    The first ``all_up_to + 1`` distinct values of any rows bound the wanted
    ones from above, so a probe of some rows keeps nearly all larger values
    out of the shuffle; the result does not depend on which rows it saw."""
    cols = list(columns) if columns else df.columns
    names = F.array(*map(F.lit, cols))
    order = Window.partitionBy("pos").orderBy("value")
    parts = []
    probes = dict(enumerate(_by_type(df.limit(SAMPLE_PROBE), cols)))
    for k, (kind, values) in enumerate(_by_type(df, cols)):
        bounds = (probes[k][1].distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == all_up_to + 1)
                  .select("pos", F.col("value").alias("most")))  # a row per column at most
        kept = values.join(F.broadcast(bounds), "pos", "left").filter(F.col("most").isNull() | (F.col("value") <= F.col("most")))
        ranked = kept.select("pos", "value").distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= all_up_to + 1)
        # at most ``all_up_to + 1`` rows per column are left, already partitioned by column: no new exchange
        ranked = ranked.withColumn("k", F.max("rank").over(Window.partitionBy("pos")))
        number, text = _shown("value", kind)
        parts.append(ranked.filter(F.col("rank") <= F.when(F.col("k") <= all_up_to, F.col("k")).otherwise(F.lit(truncated)))
                     .select(F.get(names, F.col("pos")).alias("column"), F.col("rank").cast("bigint").alias("rank"),
                             F.expr(number).alias("value_num"), F.expr(text).alias("value_text")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


# --- histogram and density (A-16..A-18) ---------------------------------------

def _num(c: str) -> Column:
    """A column as double with NaN as missing (pandas has one missing marker)."""
    return nan_to_null(F.col(c).cast("double"))


def _num_sql(c: str) -> str:
    return f"nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE))"


def _finite(c: str) -> Column:
    x = _num(c)
    return F.when(F.abs(x) < float("inf"), x)


def _min_max_count(df: DataFrame, column: str):
    x = _finite(column)
    row = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"),
                 F.stddev_samp(x).alias("sd")).first()
    return row["lo"], row["hi"], row["n"], row["sd"]


def histogram(df: DataFrame, column: str, bins: int | None = None) -> DataFrame:
    """Equal-width histogram over ``[min, max]``; the last bin is closed on
    both sides, empty bins are listed with 0, and when all values are equal
    everything falls in bin 1. Infinite values have no bin. Result ``(bin, lower, upper, count)``.
    ``bins=None`` uses the data-dependent rule of ``auto_bins`` (A-17),
    computed in the same aggregate as the range."""
    spark = df.sparkSession
    x = _finite(column)
    row = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"),
                 *([] if bins else [(F.count_distinct(column) + F.max(F.col(column).isNull().cast("bigint")))
                                    .alias("k")])).first()
    lo, hi, n = row["lo"], row["hi"], row["n"]
    if not bins:
        bins = max(int(row["k"] or 0) // 2, 1)
    domain = spark.range(1, bins + 1).select(F.col("id").cast("bigint").alias("bin"))
    if n == 0:
        return domain.select("bin", F.lit(None).cast("double").alias("lower"),
                             F.lit(None).cast("double").alias("upper"), F.lit(0).cast("bigint").alias("count"))
    width = (hi - lo) / bins
    if width > 0:
        bucket = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("bigint") + 1, F.lit(bins).cast("bigint"))
    else:
        bucket = F.lit(1).cast("bigint")
    counts = df.filter(x.isNotNull()).groupBy(bucket.alias("bin")) \
               .agg(F.count(F.lit(1)).alias("count"))
    return domain.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        F.when(F.col("bin") == bins, F.lit(hi)).otherwise(F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))


def auto_bins(df: DataFrame, column: str) -> int:
    """Bins = distinct values (NULL counted, as ``unique()`` does) // 2 (A-17, X-04)."""
    row = n_categories(df, column).first()
    return max(int(row["n_categories"]) // 2, 1)


def density(df: DataFrame, column: str, gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an evenly spaced grid, Scott bandwidth
    ``std * n^(-1/5)``, grid from ``min - cut*bw`` to ``max + cut*bw`` (A-18).

    Exact: equal values are counted first, then each distinct value contributes
    to every grid point in its own task (explode over the grid index) and the
    contributions are summed by a partial aggregate with ``gridsize`` groups,
    so each task ships ``gridsize`` partial sums and no row pair is ever
    formed. Infinite values are left out.
    """
    spark = df.sparkSession
    lo, hi, n, sd = _min_max_count(df, column)
    if not n or n < 2 or not sd:
        return spark.createDataFrame([], "point bigint, x double, density double")
    bw = sd * n ** (-1.0 / 5.0)
    start, stop = lo - cut * bw, hi + cut * bw
    step = (stop - start) / (gridsize - 1)
    norm = 1.0 / (n * bw * math.sqrt(2.0 * math.pi))
    counts = df.select(_finite(column).alias("__x")).filter("__x IS NOT NULL").groupBy("__x").agg(F.count("*").alias("__n"))
    pts = counts.select("__x", "__n", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("point"))
    gx = F.lit(start) + F.col("point").cast("double") * F.lit(step)
    contrib = pts.select("point", (F.exp(F.lit(-0.5) * F.pow((gx - F.col("__x")) / F.lit(bw), 2)) * F.col("__n")).alias("k"))
    sums = contrib.groupBy("point").agg(F.sum("k").alias("s"))
    return sums.select(F.col("point").cast("bigint").alias("point"),
                       (F.lit(start) + F.col("point").cast("double") * F.lit(step)).alias("x"),
                       (F.col("s") * F.lit(norm)).alias("density"))


FINE = 64  # cells of the binned density in a bandwidth


def density_cells(df: DataFrame, column: str, start: float, cell: float) -> DataFrame:
    """``(cell, left, right)``: every value's weight, split linearly between the
    two edges of its cell. Additive: the cells of several batches on one grid
    add up."""
    at = (_finite(column) - F.lit(start)) / F.lit(cell)
    rows = df.select(at.alias("__at")).filter("__at IS NOT NULL").select(F.floor("__at").alias("cell"), (F.col("__at") - F.floor("__at")).alias("__w"))
    return rows.groupBy("cell").agg(F.sum(F.lit(1.0) - F.col("__w")).alias("left"), F.sum("__w").alias("right"))


def binned_density(df: DataFrame, column: str, gridsize: int = 200, cut: float = 3.0, fine: int = FINE) -> DataFrame:
    """``density`` from linearly binned values (A-18): values are split between
    the edges of cells of ``1 / fine`` bandwidths, so what is shuffled and
    convolved follows the range in bandwidths and not the distinct values. Within
    1e-4 of the exact density's peak at the default (tested; the error falls
    with the square of ``fine``). Infinite values are left out."""
    spark = df.sparkSession
    lo, hi, n, sd = _min_max_count(df, column)
    if not n or n < 2 or not sd:
        return spark.createDataFrame([], "point bigint, x double, density double")
    bw = sd * n ** (-1.0 / 5.0)
    start, stop = lo - cut * bw, hi + cut * bw
    step, cell = (stop - start) / (gridsize - 1), bw / fine
    norm = 1.0 / (n * bw * math.sqrt(2.0 * math.pi))
    cells = density_cells(df, column, start, cell)
    pts = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("point"))
    gx = F.lit(start) + F.col("point").cast("double") * F.lit(step)

    def kernel(edge: Column) -> Column:
        return F.exp(F.lit(-0.5) * F.pow((gx - (F.lit(start) + edge.cast("double") * F.lit(cell))) / F.lit(bw), 2))
    sums = pts.select("point", (F.col("left") * kernel(F.col("cell")) + F.col("right") * kernel(F.col("cell") + 1)).alias("k")).groupBy("point").agg(F.sum("k").alias("s"))
    return sums.select(F.col("point").cast("bigint").alias("point"),
                       (F.lit(start) + F.col("point").cast("double") * F.lit(step)).alias("x"), (F.col("s") * F.lit(norm)).alias("density"))


def top_k_frequent(df: DataFrame, column: str, k: int) -> DataFrame:
    """``value_counts().nlargest(k)`` (T-02) with a deterministic tie-break."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return top_k_rows(counts, k, [F.col("count").desc(), F.col(column).asc()])


def eda_report(df: DataFrame, categorical_max: int = 20, key: Sequence[str] | None = None,
               approx: bool = False) -> dict[str, DataFrame]:
    """The exploratory profile the notebooks print, as small DataFrames:
    shape, NULL profile, duplicates, numeric and text describe, the column
    profile, and value counts (NULLs included) of every column with fewer
    than ``categorical_max`` distinct values (the charts' gate). Which
    columns are categorical is decided from the column profile (one scalar
    pass); everything else stays lazy."""
    from trackmart.operators.relational import duplicate_counts, value_counts
    prof = column_profile(df, approx=approx)
    out = {"shape": shape(df), "nulls": null_profile(df), "duplicates": duplicate_counts(df, key),
           "column_profile": prof}
    if columns_of_kind(df, "numeric"):
        out["describe_numeric"] = describe_numeric(df, approx=approx)
    if columns_of_kind(df, "text"):
        out["describe_text"] = describe_text(df)
    small = [r["column"] for r in prof.filter(F.col("n_unique") < categorical_max).select("column").collect()]
    for c in small:
        out[f"value_counts:{c}"] = value_counts(df, c, dropna=False)
    return out
