"""The registered queries: each runs one library operator (or composite)
over whole test tables. ``star_sql`` holds the matching DuckDB SQL.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame
(a few compute plan-build scalars first, e.g. histogram edges).
Doubles are rounded to 4 places and counts cast to bigint, identically in
the SQL, so both sides compare exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from trackmart.functions.columns import hidden_to_sentinel, json_long, label, percent, percent_text
from trackmart.operators import profile as P
from trackmart.operators import relational as R
from trackmart.plans import enrich as E
from trackmart.plans import star_inputs as I
from trackmart.plans.clean import clean_awards, clean_channels, clean_tracks, coercion_report
from trackmart.plans.merge import merge_all, merge_report
from trackmart.plans.scale_queries import QUERIES as SCALE
from trackmart.schemas import CHANNELS, KEY_NAMES, MODE_NAMES
from trackmart.session import scratch_path
from trackmart.sources.io import EmptyInput, literal_table, read_csv, write_table

T = I.table


def _r(c, n=4):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


# --- merge (E-04, J-01..J-03, D-04, D-05) ---------------------------------------------

def merge_latest(spark: SparkSession, sf: str) -> DataFrame:
    return merge_all(tracks=I.event_tracks(spark, sf), awards=I.order_awards(spark, sf),
                     channels=I.user_channels(spark, sf))


def merge_no_channels(spark, sf):
    return merge_all(tracks=I.event_tracks(spark, sf), awards=I.order_awards(spark, sf), channels=None)


def merge_no_awards(spark, sf):
    return merge_all(tracks=I.event_tracks(spark, sf), awards=None, channels=I.user_channels(spark, sf))


def merge_match_report(spark, sf):
    return merge_report(tracks=I.event_tracks(spark, sf), awards=I.order_awards(spark, sf),
                        channels=I.user_channels(spark, sf))


# --- cleaners (E-01..E-03, C-04, N-07) ----------------------------------------------

def clean_tracks_q(spark, sf):
    return clean_tracks(I.part_raw_tracks(spark, sf))


def clean_awards_q(spark, sf):
    df = clean_awards(I.order_raw_awards(spark, sf))
    return df.select("year", "title", F.unix_timestamp("published_at").alias("published_epoch"),
                     F.unix_timestamp("updated_at").alias("updated_epoch"),
                     "category", "nominee", "artist", "workers", "img", "winner")


def clean_channels_q(spark, sf):
    return clean_channels(I.supplier_raw_channels(spark, sf))


def coercion_report_q(spark, sf):
    return coercion_report(I.order_raw_awards(spark, sf))


# --- joins (J-01, J-02, J-04..J-08) ---------------------------------------------------

def left_join_single(spark, sf):
    cust = T(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    open_orders = (T(spark, sf, "orders").filter(F.col("o_orderstatus") == "O")
                   .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_open_orders"),
                                             _r(F.sum("o_totalprice"), 2).alias("open_value")))
    return R.left_enrich(cust, open_orders, ["c_custkey"], ["o_custkey"], fills={"n_open_orders": 0})


def left_join_composite(spark, sf):
    li = T(spark, sf, "lineitem")
    returned = (li.filter(F.col("l_returnflag") == "R").groupBy("l_partkey", "l_suppkey")
                .agg(F.count(F.lit(1)).alias("n_returned"), F.sum("l_quantity").alias("qty_returned"))
                .withColumnsRenamed({"l_partkey": "r_partkey", "l_suppkey": "r_suppkey"}))
    left = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return R.left_enrich(left, returned, ["l_partkey", "l_suppkey"], ["r_partkey", "r_suppkey"],
                         fills={"n_returned": 0, "qty_returned": 0.0})


def match_rate(spark, sf):
    per_user = T(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    joined = R.left_enrich(T(spark, sf, "customer").select("c_custkey"), per_user, ["c_custkey"], ["user_id"])
    return R.nonzero_match_report(joined, "n_events", "customers_events")


def label_lookup(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", label(F.col("p_size") % 13, KEY_NAMES).alias("key_name"),
                    label(F.col("p_size") % 2, MODE_NAMES).alias("mode_name"))


def domain_reindex(spark, sf):
    nation = T(spark, sf, "nation").select("n_nationkey", "n_name")
    rich = (T(spark, sf, "supplier").filter(F.col("s_acctbal") > 9000)
            .groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n_rich_suppliers")))
    return R.reindex(nation, rich, "n_nationkey")


def pending_keys(spark, sf):
    cust = T(spark, sf, "customer").select("c_custkey", "c_name")
    urgent = T(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return R.pending_keys(cust, urgent, "c_custkey", "o_custkey").orderBy("c_custkey")  # S-03


def entity_universe(spark, sf):
    c = T(spark, sf, "customer")
    k = F.col("c_custkey")
    planted = {0: "Various Artists", 1: "", 2: " Soundtrack ", 4: "(Various Artists)", 5: " "}
    name = F.when(k % 50 == 3, F.lit(None).cast("string"))
    for m, v in planted.items():
        name = name.when(k % 50 == m, F.lit(v))
    name = name.when(k % 3 == 0, F.concat(F.col("c_name"), F.lit(" "))).otherwise(F.col("c_name"))
    tracks = c.select(name.alias("artists"))
    s = T(spark, sf, "supplier")
    awards = s.select(F.when(F.col("s_suppkey") % 10 == 0, F.lit("No Especificado"))
                      .otherwise(F.col("s_name")).alias("artist"))
    return E.artist_universe(tracks, awards)


def two_tier_lookup_q(spark, sf):
    brands = T(spark, sf, "part").select(F.col("p_brand").alias("artist_query"))
    segments = T(spark, sf, "customer").select(F.col("c_mktsegment").alias("artist_query"))
    names = brands.unionByName(segments).distinct()
    return E.two_tier_lookup(names, I.search_table_from_parts(spark, sf))


# --- top-n, JSON, sums (W-03, E-05..E-08, X-08..X-10, A-20) -----------------------------

def topn_per_group(spark, sf):
    ev = T(spark, sf, "events").select("user_id", "event_id", "value")
    return R.top_n_per_group(ev, ["user_id"], [F.col("value").desc(), F.col("event_id").asc()], 10, "rank") \
            .withColumn("rank", F.col("rank").cast("bigint"))


def topn_with_fallback(spark, sf):
    return E.top_videos(I.event_videos(spark, sf)).withColumn("rank", F.col("rank").cast("bigint"))


def json_stats(spark, sf):
    ev = T(spark, sf, "events")
    k = F.col("event_id")
    props = (F.when(k % 13 == 0, F.lit('{"k": "abc"}')).when(k % 17 == 0, F.lit("{}"))
             .otherwise(F.col("props")))
    stats = ev.select("event_id", (F.col("user_id") % 5 == 0).alias("hidden"), props.alias("props"))
    return stats.select("event_id", hidden_to_sentinel("hidden", json_long("props", "k")).alias("subscriber_count"))


def safe_sum(spark, sf):
    ev = T(spark, sf, "events")
    k = F.col("event_id")
    likes = (F.when(k % 11 == 0, F.lit("n/a")).when(k % 11 == 1, F.lit(None).cast("string"))
             .otherwise(F.floor("value").cast("bigint").cast("string")))
    return P.safe_sum(ev.select("user_id", likes.alias("likes")), ["user_id"], "likes", "total_likes")


def assemble_lookup(spark, sf):
    return E.assemble_lookup(I.customer_artists(spark, sf), I.customer_channel_search(spark, sf),
                             I.user_channel_stats(spark, sf), I.event_videos(spark, sf),
                             I.event_video_stats(spark, sf))


def tag_errors(spark, sf):
    results = assemble_lookup(spark, sf)
    return E.tag_failures(results, I.customer_lookup_status(spark, sf))


# --- dedup, upsert (D-01..D-06, U-01) -------------------------------------------------

def _events_batches(spark, sf):
    ev = T(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    day = F.dayofmonth("ts")
    prior = ev.filter(day <= 15).withColumn("batch_id", F.lit(1).cast("bigint"))
    new = ev.filter(day > 15).withColumn("batch_id", F.lit(2).cast("bigint"))
    return prior, new


def upsert_latest(spark, sf):
    prior, new = _events_batches(spark, sf)
    out = R.upsert_latest(prior, new, ["user_id", "event_type"],
                          [F.col("batch_id").desc(), F.col("ts").desc(), F.col("event_id").desc()])
    return out.select("user_id", "event_type", "event_id", "value", "batch_id")


LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _lineitem_with_copies(spark, sf):
    li = T(spark, sf, "lineitem").select(*LINE_COLS)
    return li.unionByName(li.filter(F.col("l_orderkey") % 10 == 0))


def dedup_rows(spark, sf):
    return R.dedup_rows(_lineitem_with_copies(spark, sf))


def dup_counts(spark, sf):
    li = _lineitem_with_copies(spark, sf)
    whole = R.duplicate_counts(li).select(F.lit("all_columns").alias("subset"), "*")
    keyed = R.duplicate_counts(li, ["l_orderkey", "l_linenumber"]).select(
        F.lit("l_orderkey,l_linenumber").alias("subset"), "*")
    return whole.unionByName(keyed)


def latest_per_key(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    out = R.latest_per_key(o, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()])
    return out.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")


# --- profiling (A-*) ------------------------------------------------------------------

def _events_with_nulls(spark, sf):
    ev = T(spark, sf, "events")
    k = F.col("event_id")
    return ev.select("event_id", "ts", "user_id",
                     F.when(k % 25 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
                     F.when(k % 9 == 0, F.lit(None)).when(k % 31 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
                     F.when(k % 4 == 0, F.lit(None)).otherwise(F.col("props")).alias("props"))


def null_profile(spark, sf):
    out = P.null_profile(_events_with_nulls(spark, sf))
    return out.select("column", "null_count", _r("null_pct").alias("null_pct"))


def total_nulls(spark, sf):
    return P.total_nulls(_events_with_nulls(spark, sf))


def _orders_with_fine_values(spark, sf):
    """Orders with keys above 2^53 that a double can't tell apart, dates a
    tenth of a second apart, and NaN among the prices."""
    k = F.col("o_orderkey")
    return T(spark, sf, "orders").select(
        (k + F.lit(2**53 + 1)).alias("o_orderkey"), "o_custkey", "o_orderstatus",
        F.when(k % 29 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(k % 7).cast("decimal(18,6)") / 10)).alias("o_orderdate"), "o_orderpriority")


def column_profile(spark, sf):
    o = _orders_with_fine_values(spark, sf)
    return P.column_profile(o).drop("dtype").withColumn("pos", F.col("pos").cast("bigint"))


def column_samples(spark, sf):
    o = _orders_with_fine_values(spark, sf)
    return P.column_samples(o)


def describe_numeric(spark, sf):
    li = T(spark, sf, "lineitem")
    d = P.describe_numeric(li)
    return d.select("column", "count", *[_r(c).alias(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


def describe_text(spark, sf):
    return P.describe_text(T(spark, sf, "orders"))


def _flags_with_nulls(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select(F.when(F.col("l_orderkey") % 20 == 0, F.lit(None))
                     .otherwise(F.col("l_returnflag")).alias("l_returnflag"))


def value_counts(spark, sf):
    return R.value_counts(_flags_with_nulls(spark, sf), "l_returnflag", dropna=False)


def value_counts_topk(spark, sf):
    return P.top_k_frequent(T(spark, sf, "part"), "p_name", 15)


def category_total(spark, sf):
    return P.n_categories(_flags_with_nulls(spark, sf), "l_returnflag")


def topk_rows(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return R.top_k_rows(c, 10, [F.col("c_acctbal").desc(), F.col("c_custkey").asc()])


def _order_years(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(F.year("o_orderdate").cast("bigint").alias("year"), "o_custkey")


def yearly_counts(spark, sf):
    return P.group_size(_order_years(spark, sf), ["year"])


def yearly_unique(spark, sf):
    return P.group_nunique(_order_years(spark, sf), ["year"], "o_custkey", "n_customers")


def yearly_running(spark, sf):
    return R.running_total(P.group_size(_order_years(spark, sf), ["year"]), "year", "count")


QS = [0.25, 0.5, 0.75, 0.95, 0.98, 0.99]


def quantiles(spark, sf):
    li = T(spark, sf, "lineitem")
    return P.quantiles(li, ["l_extendedprice", "l_quantity"], QS).withColumn("value", _r("value"))


def quantile_cap(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return P.cap_by_quantile(li, "l_extendedprice", 0.99)


def histogram(spark, sf):
    h = P.histogram(T(spark, sf, "orders"), "o_totalprice", 50)
    return h.select("bin", _r("lower").alias("lower"), _r("upper").alias("upper"), "count")


def histogram_auto(spark, sf):
    years = _order_years(spark, sf)
    h = P.histogram(years, "year")  # bins = distinct years (NULL counted) // 2
    return h.select("bin", _r("lower").alias("lower"), _r("upper").alias("upper"), "count")


def density(spark, sf):
    d = P.density(T(spark, sf, "customer"), "c_acctbal")
    return d.select("point", _r("x").alias("x"), _r("density", 12).alias("density"))


def unit_percent(spark, sf):
    """Derived columns (P-06): a unit change by division (X-02), a threshold
    predicate (F-03), percentages (X-03) and their text form (X-06)."""
    li = T(spark, sf, "lineitem")
    agg = li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("l_discount") > 0.05).cast("bigint")).alias("n_discounted"),
        F.avg(F.col("l_extendedprice") / 1000).alias("avg_price_k"),
        F.sum((F.col("l_tax") != 0).cast("bigint")).alias("n_taxed"))
    return agg.select("l_returnflag", "n", "n_discounted", "n_taxed",
                      _r(percent("n_discounted", "n")).alias("pct_discounted"),
                      percent_text(percent("n_discounted", "n")).alias("pct_text"),
                      _r("avg_price_k").alias("avg_price_k"))


def project_rename(spark, sf):
    p = T(spark, sf, "part")
    p = R.select_present(p, ["p_partkey", "p_name", "p_brand", "p_type", "p_missing"])
    p = R.rename_present(p, {"p_name": "track_name", "p_brand": "artists", "p_absent": "x"})
    return R.drop_present(p, ["p_type", "p_missing"])


# --- sources and sinks (SC-01..SC-04, SK-01, SK-07) ------------------------------------

def _shared_dir(spark, name):
    """A fresh folder below ``spark.checkpoint.dir`` (shared storage on a cluster)."""
    return scratch_path(spark, name)


def load_check(spark, sf):
    clean = clean_channels(I.supplier_raw_channels(spark, sf))
    return write_table(clean, _shared_dir(spark, "channels_clean"), schema=CHANNELS, strict=True) \
        .select(F.lit("channels_clean").alias("target"), "rows_written", "rows_stored", "ok")


def _part_for_csv(spark, sf):
    p = T(spark, sf, "part")
    k = F.col("p_partkey")
    name = (F.when(k % 5 == 0, F.concat(F.lit('"'), F.col("p_name"), F.lit('" Cast')))
            .when(k % 5 == 1, F.concat(F.col("p_name"), F.lit(", deluxe")))
            .when(k % 5 == 2, F.lit("NA")).otherwise(F.col("p_name")))
    return p.select("p_partkey", name.alias("p_name"), "p_brand", "p_size", "p_retailprice")


def csv_roundtrip(spark, sf):
    src = _part_for_csv(spark, sf)
    path = _shared_dir(spark, "part_csv")
    (src.write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"')
     .option("quoteAll", True).csv(path))
    schema = T_.StructType([T_.StructField("p_partkey", T_.LongType()), T_.StructField("p_name", T_.StringType()),
                            T_.StructField("p_brand", T_.StringType()), T_.StructField("p_size", T_.IntegerType()),
                            T_.StructField("p_retailprice", T_.DoubleType())])
    return read_csv(spark, path, schema)


def _lookup_batches(spark, sf):
    from trackmart.streaming.incremental import LandedResponses, checkpoint_log, run_batch
    log = checkpoint_log(spark, _shared_dir(spark, "lookup_checkpoint"))
    landed = LandedResponses(I.customer_channel_search(spark, sf), I.user_channel_stats(spark, sf),
                             I.event_videos(spark, sf), I.event_video_stats(spark, sf))
    universe, status = I.customer_artists(spark, sf), I.customer_lookup_status(spark, sf)
    run_batch(universe, log, landed, 1, status)
    return log, run_batch(universe, log, landed, 2, status)


def incremental_lookup(spark, sf):
    """E-09 over two batches: batch 1 takes the artists whose answers landed
    for it (failures tagged), the others stay pending and land in batch 2; the
    result is the checkpoint's latest row per artist, normalised."""
    return _lookup_batches(spark, sf)[1]


def table_shape(spark, sf):
    return P.shape(T(spark, sf, "lineitem"))


def quality_report(spark, sf):
    return P.quality_report(clean_channels(I.supplier_raw_channels(spark, sf)), ["channel_id_found"])


def head_tail(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.head_tail(o, 5, ["o_orderkey"])


def merge_empty_awards(spark, sf):
    """J-03: awards without rows keep every track row, copies included."""
    return merge_all(tracks=I.event_tracks(spark, sf), awards=I.order_awards(spark, sf).limit(0),
                     channels=I.user_channels(spark, sf))


def pipeline_run(spark, sf):
    """E-10 end to end: three raw tables as files, cleaned, merged, loaded
    with the count check, and the stored table read back."""
    from trackmart.plans.pipeline import RunConfig, Source, run
    raw = {"tracks": I.part_full_tracks(spark, sf), "awards": I.part_raw_awards(spark, sf), "channels": I.brand_raw_channels(spark, sf)}
    sources = {}
    for name, df in raw.items():
        path = _shared_dir(spark, f"raw_{name}")
        df.write.parquet(path)
        sources[name] = Source(path)
    target = _shared_dir(spark, "merged")
    check = run(spark, RunConfig(output=target, strict_count=True, **sources)).first()
    stored = spark.read.parquet(target)
    return stored.select("track_id", "artists", "track_name", "popularity", "track_genre", "channel_id_found", "subscriber_count",
                         "view_count", "grammy_year", "grammy_category", "grammy_winner", F.lit(check["ok"]).alias("ok"))


def lookup_load(spark, sf):
    """SK-05: the lookup results of both batches loaded typed, and read back."""
    from trackmart.plans.pipeline import load_lookup_results
    log, _ = _lookup_batches(spark, sf)
    target = _shared_dir(spark, "lookup_results")
    check = load_lookup_results(log, target).first()
    return spark.read.parquet(target).withColumn("ok", F.lit(check["ok"]))


def raw_load_append(spark, sf):
    """SK-03, SK-04, SK-07: a raw overwrite, then an append, each counted."""
    from trackmart.plans.pipeline import Source, load_raw
    source, target = Source(f"{sf}/orders.parquet"), _shared_dir(spark, "raw_orders")
    checks = [load_raw(spark, source, target).withColumn("step", F.lit("overwrite")),
              load_raw(spark, source, target, mode="append").withColumn("step", F.lit("append"))]
    return checks[0].unionByName(checks[1]).select("step", "rows_written", "rows_stored", "ok")


def empty_input(spark, sf):
    """SK-08: an empty load raises, or writes an empty table where allowed."""
    none = T(spark, sf, "orders").filter("o_orderkey < 0").select("o_orderkey")
    try:
        write_table(none, _shared_dir(spark, "refused"))
        raised = False
    except EmptyInput:
        raised = True
    allowed = write_table(none, _shared_dir(spark, "allowed"), allow_empty=True)
    return allowed.select(F.lit(raised).alias("raised"), "rows_written", "rows_stored", "ok")


def literal_join(spark, sf):
    """SC-09: a literal table with an explicit schema, joined with a given table."""
    names = literal_table(spark, [("F", "finished"), ("O", "open"), ("P", None), (None, "none")],
                          T_.StructType([T_.StructField("status", T_.StringType()), T_.StructField("meaning", T_.StringType())]))
    counts = T(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, F.col("status") == F.col("o_orderstatus"), "left").select("status", "meaning", "n")


def topk_categories(spark, sf):
    """T-03: the most frequent categories and how many there are in all."""
    top = R.top_k_categories(T(spark, sf, "orders"), "o_custkey", 20)
    return top.crossJoin(F.broadcast(P.n_categories(T(spark, sf, "orders"), "o_custkey")))  # one row


def category_counts(spark, sf):
    """A-19: the counts behind a bar chart of categories, NULL as one of them."""
    return R.value_counts(_events_with_nulls(spark, sf), "event_type", dropna=False)


QUERIES = {
    "merge_latest": merge_latest,
    "merge_no_channels": merge_no_channels,
    "merge_no_awards": merge_no_awards,
    "merge_match_report": merge_match_report,
    "clean_tracks": clean_tracks_q,
    "clean_awards": clean_awards_q,
    "clean_channels": clean_channels_q,
    "coercion_report": coercion_report_q,
    "left_join_single": left_join_single,
    "left_join_composite": left_join_composite,
    "match_rate": match_rate,
    "label_lookup": label_lookup,
    "domain_reindex": domain_reindex,
    "pending_keys": pending_keys,
    "entity_universe": entity_universe,
    "two_tier_lookup": two_tier_lookup_q,
    "topn_per_group": topn_per_group,
    "topn_with_fallback": topn_with_fallback,
    "json_stats": json_stats,
    "safe_sum": safe_sum,
    "assemble_lookup": assemble_lookup,
    "tag_errors": tag_errors,
    "upsert_latest": upsert_latest,
    "dedup_rows": dedup_rows,
    "dup_counts": dup_counts,
    "latest_per_key": latest_per_key,
    "null_profile": null_profile,
    "total_nulls": total_nulls,
    "column_profile": column_profile,
    "column_samples": column_samples,
    "describe_numeric": describe_numeric,
    "describe_text": describe_text,
    "value_counts": value_counts,
    "value_counts_topk": value_counts_topk,
    "category_total": category_total,
    "topk_rows": topk_rows,
    "yearly_counts": yearly_counts,
    "yearly_unique": yearly_unique,
    "yearly_running": yearly_running,
    "quantiles": quantiles,
    "quantile_cap": quantile_cap,
    "histogram": histogram,
    "histogram_auto": histogram_auto,
    "density": density,
    "unit_percent": unit_percent,
    "project_rename": project_rename,
    "load_check": load_check,
    "csv_roundtrip": csv_roundtrip,
    "incremental_lookup": incremental_lookup,
    "table_shape": table_shape,
    "quality_report": quality_report,
    "head_tail": head_tail,
    "merge_empty_awards": merge_empty_awards,
    "pipeline_run": pipeline_run,
    "lookup_load": lookup_load,
    "raw_load_append": raw_load_append,
    "empty_input": empty_input,
    "literal_join": literal_join,
    "topk_categories": topk_categories,
    "category_counts": category_counts,
}

QUERIES |= SCALE
