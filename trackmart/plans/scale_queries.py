"""Registered queries of the operators whose state is kept, swapped or split:
the compacted store, atomic publish, skew-proof joins, heavy hitters, mergeable
profiles, distributed running totals. ``scale_sql`` holds their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from trackmart.operators import profile as P
from trackmart.operators import relational as R
from trackmart.operators import sketches as S
from trackmart.operators.heavy import heavy_keys, top_k_heavy
from trackmart.operators.skew import skew_left_enrich
from trackmart.plans import star_inputs as I
from trackmart.session import scratch_path
from trackmart.sources.io import EmptyInput, write_table
from trackmart.sources.keyed_store import KeyedStore
from trackmart.sources.publish import PublishedTable
from trackmart.sources.pushdown import footer_stats

T = I.table


# --- compacted keyed store (SK-06, SC-08, D-06) -----------------------------------------

EVENTS = T_.StructType([T_.StructField("user_id", T_.LongType()), T_.StructField("event_type", T_.StringType()),
                        T_.StructField("event_id", T_.LongType()), T_.StructField("value", T_.DoubleType()),
                        T_.StructField("batch_id", T_.LongType())])
BATCHES = 6


def _event_store(spark: SparkSession, sf: str) -> KeyedStore:
    """Events of six spans of days as batches of a store; batch 2 is first
    written in part and run again, and the first four are compacted."""
    store = KeyedStore(spark, scratch_path(spark, "event-store"), EVENTS, ["user_id", "event_type"], buckets=16)
    ev = T(spark, sf, "events").withColumn("batch", F.least(F.expr("(dayofmonth(ts) - 1) div 5 + 1"), F.lit(BATCHES)))
    for b in range(1, BATCHES + 1):
        rows = ev.filter(F.col("batch") == b)
        if b == 2:
            store.write_batch(rows.filter("event_id % 2 = 0"), b)
        store.write_batch(rows, b)
        if b == 4:
            store.compact(2)
    store.write_batch(ev.filter("event_id < 10"), 3)  # sealed by the compaction: no effect
    return store


def store_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The latest row per key over six batches, four of them compacted."""
    return _event_store(spark, sf).read_latest()


def store_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The latest rows of some keys; only their buckets are read."""
    asked = T(spark, sf, "customer").filter("c_custkey % 10 = 3").select("c_custkey", F.lit("click").alias("kind"))
    return _event_store(spark, sf).lookup(asked, ["c_custkey", "kind"])


def incremental_store(spark: SparkSession, sf: str) -> DataFrame:
    """``incremental_lookup`` on the compacted store: batch 1, compaction, batch 2."""
    from trackmart.streaming.incremental import LandedResponses, checkpoint_log, run_batch
    log = checkpoint_log(spark, scratch_path(spark, "lookup-store"), buckets=8)
    landed = LandedResponses(I.customer_channel_search(spark, sf), I.user_channel_stats(spark, sf),
                             I.event_videos(spark, sf), I.event_video_stats(spark, sf))
    universe, status = I.customer_artists(spark, sf), I.customer_lookup_status(spark, sf)
    run_batch(universe, log, landed, 1, status)
    log.compact(1)
    return run_batch(universe, log, landed, 2, status)


# --- atomic publish (SK-01, SK-02, SK-05) -----------------------------------------------

def publish_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of a table, and an empty load that leaves no trace:
    the rows each version reads, and those its manifest counts."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    table = PublishedTable(spark, scratch_path(spark, "published"))
    table.publish(o.filter("o_orderstatus = 'F'"))
    table.publish(o.filter("o_orderstatus = 'O'"), mode="append")
    try:
        table.publish(o.filter("o_orderkey < 0"))
    except EmptyInput:
        pass
    table.publish(o.filter("o_orderstatus = 'P'"))
    out = None
    for r in table.history().collect():  # three
        own = table.read(r["version"]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(r["version"]).cast("bigint").alias("version"), F.lit(r["rows"]).cast("bigint").alias("listed"), "o_orderstatus", "n")
        out = own if out is None else out.unionByName(own)
    return out


def load_keeps_old(spark: SparkSession, sf: str) -> DataFrame:
    """A plain folder loaded, then a load without rows, then another: the
    table read after each."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    target, out = scratch_path(spark, "replaced"), None
    for step, status in enumerate(("F", "none", "P")):
        try:
            write_table(o.filter(F.col("o_orderstatus") == status), target, strict=True)
            raised = False
        except EmptyInput:
            raised = True
        now = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).first()
        row = spark.range(1).select(F.lit(step).alias("step"), F.lit(raised).alias("raised"), F.lit(now["n"]).alias("n"), F.lit(now["keys"]).alias("keys"))
        out = row if out is None else out.unionByName(row)
    return out


# --- skew and heavy hitters (J-02, T-02, T-03) ------------------------------------------

def _hot_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines of which a third have one composite key."""
    hot = F.col("l_orderkey") % 3 == 0
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
                                           F.when(hot, 1).otherwise(F.col("l_partkey")).cast("bigint").alias("part"),
                                           F.when(hot, 1).otherwise(F.col("l_suppkey")).cast("bigint").alias("supp"))


def left_join_skewed(spark: SparkSession, sf: str) -> DataFrame:
    li = _hot_lines(spark, sf)
    returned = (li.filter("l_returnflag = 'R'").groupBy(F.col("part").alias("r_part"), F.col("supp").alias("r_supp"))
                .agg(F.count(F.lit(1)).alias("n_returned"), F.sum("l_quantity").alias("qty_returned")))
    return skew_left_enrich(li.drop("l_returnflag"), returned, ["part", "supp"], ["r_part", "r_supp"], fills={"n_returned": 0, "qty_returned": 0.0})


def _line_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Nearly one value a line, but for a third of the lines with few values."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    tag = (F.when(key % 3 == 0, F.concat(F.lit("hot"), F.col("l_suppkey") % 7)).when(key % 31 == 0, F.concat(F.lit("warm"), F.col("l_suppkey") % 40))
           .when(key % 29 == 0, None).otherwise(F.concat_ws("-", key, line)))
    return T(spark, sf, "lineitem").select(tag.alias("tag"))


def topk_heavy(spark: SparkSession, sf: str) -> DataFrame:
    return top_k_heavy(_line_tags(spark, sf), "tag", 12)


def heavy_tags(spark: SparkSession, sf: str) -> DataFrame:
    """All values with five lines or more, NULL too."""
    return heavy_keys(_line_tags(spark, sf), ["tag"], 5)


# --- mergeable profiles (A-03, A-06, A-07, A-12, A-15, A-18) ----------------------------

PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_partkey", "l_returnflag"]
QS = [0.01, 0.25, 0.5, 0.75, 0.99]


def profile_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A profile merged from the stored states of three batches, one of them
    run twice. Exact figures are returned; of the sketched ones, whether they
    are within their stated bounds of a full count."""
    li = T(spark, sf, "lineitem")
    log = S.ProfileLog(spark, scratch_path(spark, "profile"))
    for b in (0, 1, 2, 1):
        log.add(li.filter(F.col("l_orderkey") % 3 == b), b, PROFILED)
    out = log.profile(QS)
    sketched = {r["column"]: r for r in out.select("column", "quantiles", "distinct").collect()}  # a row a column
    exact = li.agg(*[F.count_distinct(c).alias(c) for c in PROFILED]).first()
    flags = []
    for c in PROFILED:
        r = sketched[c]
        ranks = r["quantiles"] is None or max(S.rank_errors(li, c, QS, r["quantiles"])) <= S.RANK_ERROR
        flags.append((c, ranks, abs(r["distinct"] - exact[c]) <= S.COUNT_ERROR * exact[c]))
    checked = spark.createDataFrame(flags, "column string, ranks_ok boolean, distinct_ok boolean")
    return out.join(F.broadcast(checked), "column").select(
        "column", "rows", "count", "nulls", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "max", "ranks_ok", "distinct_ok")


def yearly_unique_states(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers a year from the states of two batches, against the
    exact count."""
    o = T(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey", "o_orderkey")
    parts = [S.states(o.filter(F.col("o_orderkey") % 2 == b), ["o_custkey"], "year") for b in (0, 1)]
    est = S.profile(parts[0].unionByName(parts[1]))
    exact = o.groupBy(F.col("year").cast("string").alias("part")).agg(F.count_distinct("o_custkey").alias("n"))
    return est.join(exact, "part").select(F.col("part").cast("bigint").alias("year"), "rows", F.col("n").alias("n_customers"),
                                          (F.abs(F.col("distinct") - F.col("n")) <= S.COUNT_ERROR * F.col("n")).alias("distinct_ok"))


def density_binned(spark: SparkSession, sf: str) -> DataFrame:
    d = P.binned_density(T(spark, sf, "customer"), "c_acctbal")
    return d.select("point", F.round("x", 4).alias("x"), F.round("density", 12).alias("density"))


def footer_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, NULLs and extremes of every column, from Parquet footers where
    they have them (A-01, A-08)."""
    parts = [footer_stats(spark, f"{sf}/{t}.parquet").withColumn("table", F.lit(t)) for t in ("orders", "customer", "part")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- order and identity (W-01, D-01) ----------------------------------------------------

def running_by_key(spark: SparkSession, sf: str) -> DataFrame:
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return R.running_totals(li, ["l_orderkey", "l_linenumber"], {"quantity_so_far": "l_quantity"}, "position")


def dedup_by_digest(spark: SparkSession, sf: str) -> DataFrame:
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                         "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return R.dedup_rows_by_digest(li.unionByName(li.filter(F.col("l_orderkey") % 10 == 0)))


QUERIES = {f.__name__: f for f in (
    store_latest, store_lookup, incremental_store, publish_versions, load_keeps_old, left_join_skewed, topk_heavy, heavy_tags,
    profile_incremental, yearly_unique_states, density_binned, footer_profile, running_by_key, dedup_by_digest)}
