"""Stand-in inputs derived from the star-schema test tables.

The library is about tracks, awards and channels; the test tables are
orders, events, parts and so on. Each builder here maps a test table onto
one of the library's inputs, planting dirty values (NULLs, padding,
duplicates, junk text) by rules on keys, so the whole table is processed and
the work grows with it. Every builder has a DuckDB twin in ``star_sql`` that
plants the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.sources.io import read_table

PRIORITY_TO_EVENT = {"1-URGENT": "purchase", "2-HIGH": "view", "3-MEDIUM": "click",
                     "4-NOT SPECIFIED": "signup"}
NBSP, IDEOGRAPHIC_SPACE, TAB = "\u00a0", "\u3000", "\t"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# --- merge inputs --------------------------------------------------------------

def event_tracks(spark, sf_dir) -> DataFrame:
    """Tracks = events; every tenth event also listed under a second genre."""
    ev = table(spark, sf_dir, "events")

    def shape(df, genre):
        return df.select(_s("event_id").alias("track_id"), _s("user_id").alias("artists"),
                         F.col("event_type").alias("track_name"),
                         F.floor("value").cast("int").alias("popularity"),
                         F.lit(genre).alias("track_genre"))
    return shape(ev, "main").unionByName(shape(ev.filter(F.col("event_id") % 10 == 0), "copy"))


def user_channels(spark, sf_dir) -> DataFrame:
    """Channel statistics = per-user event aggregates; users with
    ``user_id % 7 = 3`` have no channel."""
    ev = table(spark, sf_dir, "events").filter(F.col("user_id") % 7 != 3)
    agg = ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("subscriber_count"), F.sum("event_id").alias("view_count"),
        F.count_distinct("event_type").alias("video_count"),
        F.max("event_id").alias("total_top10_video_likes"))
    return agg.select(_s("user_id").alias("artist_query"),
                      F.concat(F.lit("ch"), _s("user_id")).alias("channel_id_found"),
                      F.concat(F.lit("Channel "), _s("user_id")).alias("channel_title_verified"),
                      "subscriber_count", "view_count", "video_count", "total_top10_video_likes")


def order_awards(spark, sf_dir) -> DataFrame:
    """Awards = orders re-keyed onto (user, event type)."""
    o = table(spark, sf_dir, "orders")
    nominee = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in PRIORITY_TO_EVENT.items() for x in kv]),
                                      F.col("o_orderpriority")), F.lit("error"))
    return o.select(_s(F.expr("o_custkey div 10")).alias("artist"), nominee.alias("nominee"),
                    F.year("o_orderdate").alias("year"),
                    F.concat_ws("-", "o_orderstatus", "o_orderpriority").alias("category"),
                    (F.col("o_orderstatus") == "F").alias("winner"))


# --- raw inputs of the cleaners ------------------------------------------------

def part_raw_tracks(spark, sf_dir) -> DataFrame:
    """Raw tracks from parts: missing artists, padded names, a NULL genre,
    exact duplicate rows and padded near-duplicates."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")

    def shape(df, name):
        return df.select(_s("p_partkey").alias("track_id"),
                         F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("artists"),
                         F.col("p_type").alias("album_name"), name.alias("track_name"),
                         F.col("p_size").alias("popularity"),
                         F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("track_genre"))
    padded = F.when(k % 7 == 0, F.concat(F.lit(TAB), F.col("p_name"), F.lit(NBSP))).otherwise(F.col("p_name"))
    base = shape(p, padded)
    dups = shape(p.filter(k % 10 == 0), padded)
    near = shape(p.filter(k % 10 == 1), F.concat(F.col("p_name"), F.lit(IDEOGRAPHIC_SPACE)))
    return base.unionByName(dups).unionByName(near)


def order_raw_awards(spark, sf_dir) -> DataFrame:
    """Raw awards from orders: dates as text in several forms (ISO with an
    offset, date only, junk, NULL), padded text, missing fields."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))
    published = (F.when(k % 9 == 0, F.lit(None).cast("string"))
                 .when(k % 9 == 1, F.lit("not a date"))
                 .when(k % 9 == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
                 .otherwise(iso))
    return o.select(
        F.year("o_orderdate").alias("year"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.concat(F.lit("Award "), F.col("o_orderpriority"))).alias("title"),
        published.alias("published_at"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
        F.concat(F.lit(NBSP), F.col("o_orderpriority")).alias("category"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.concat(F.lit("Order "), _s(k))).alias("nominee"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit(" cust"), _s("o_custkey"), F.lit(TAB))).alias("artist"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("workers"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.concat(F.lit("http://img/"), _s(k))).alias("img"),
        (F.col("o_orderstatus") == "F").alias("winner"))


def supplier_raw_channels(spark, sf_dir) -> DataFrame:
    """Raw channel statistics from suppliers: counts as text with junk, values
    above 2^53 and the hidden sentinel -1, NULL counts, padded and missing text."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    subs = (F.when(k % 9 == 0, F.lit("x")).when(k % 9 == 1, F.lit("-1"))
            .when(k % 9 == 2, F.lit(None).cast("string"))
            .when(k % 9 == 3, _s(F.lit(2**53 + 1).cast("bigint") + 2 * k))
            .otherwise(F.concat(_s(k * 100), F.lit(".0"))))
    return s.select(
        F.when(k % 10 == 0, F.concat(F.lit(IDEOGRAPHIC_SPACE), F.col("s_name")))
         .otherwise(F.concat(F.col("s_name"), F.lit(" "))).alias("artist_query"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(F.concat(F.lit("UC"), _s(k))).alias("channel_id_found"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(F.concat(F.lit(TAB + "Title "), _s("s_nationkey")))
         .alias("channel_title_verified"),
        subs.alias("subscriber_count"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.col("s_acctbal")).alias("view_count"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.col("s_nationkey").cast("double")).alias("video_count"),
        (k.cast("double") * 1.5).alias("total_top10_video_likes"))


def part_full_tracks(spark, sf_dir) -> DataFrame:
    """Raw tracks with every column of the track table, from parts."""
    from trackmart.schemas import TRACKS
    raw = part_raw_tracks(spark, sf_dir)
    return raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in TRACKS.fields])


def part_raw_awards(spark, sf_dir) -> DataFrame:
    """Nominations of every third part's name under its brand, two for every
    ninth part; some without a nominee."""
    p = table(spark, sf_dir, "part").filter("p_partkey % 3 = 0")
    k = F.col("p_partkey")

    def rows(df, shift):
        return df.select(
            (F.lit(2000) + (k + shift) % 20).cast("int").alias("year"), F.lit("Annual").alias("title"),
            F.lit("2020-01-01").alias("published_at"), F.lit(None).cast("string").alias("updated_at"),
            F.concat(F.lit("Cat "), _s(k % 5)).alias("category"),
            F.when(k % 15 == 0, F.lit(None)).otherwise(F.concat(F.col("p_name"), F.lit(" "))).alias("nominee"),
            F.col("p_brand").alias("artist"), F.lit(None).cast("string").alias("workers"),
            F.lit(None).cast("string").alias("img"), (k % 2 == 0).alias("winner"))
    return rows(p, 0).unionByName(rows(p.filter("p_partkey % 9 = 0"), 7))


def brand_raw_channels(spark, sf_dir) -> DataFrame:
    """Raw channel rows of the brands, but for those that end in 3."""
    b = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("v"))
    return b.filter("p_brand NOT LIKE '%3'").select(
        F.col("p_brand").alias("artist_query"), F.concat(F.lit("UC"), F.col("p_brand")).alias("channel_id_found"),
        F.col("p_brand").alias("channel_title_verified"),
        F.when(F.col("n") % 2 == 0, F.lit("-1")).otherwise(_s("n")).alias("subscriber_count"),
        _s(F.col("v") + F.lit(2**53)).alias("view_count"), F.lit("x").alias("video_count"), F.lit(None).cast("string").alias("total_top10_video_likes"))


# --- landed lookup responses ---------------------------------------------------

def customer_artists(spark, sf_dir) -> DataFrame:
    """Artist names to look up = customer names."""
    return table(spark, sf_dir, "customer").select(F.col("c_name").alias("artist_query"))


def customer_channel_search(spark, sf_dir) -> DataFrame:
    """Search results per query: for ``c_custkey % 4`` = 0 nothing, 1 only a
    Topic result, 2 only a plain result, 3 both (the plain one points to a
    different channel). Channels are users: ``'UC' || c_custkey div 10``."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    chan = F.concat(F.lit("UC"), _s(F.expr("c_custkey div 10")))
    topic = c.filter((k % 4 == 1) | (k % 4 == 3)).select(
        F.concat(F.col("c_name"), F.lit(" Topic")).alias("query"), F.lit(1).alias("rank"),
        chan.alias("channel_id"), F.concat(F.lit("Topic of "), F.col("c_name")).alias("title"))
    plain = c.filter((k % 4 == 2) | (k % 4 == 3)).select(
        F.col("c_name").alias("query"), F.lit(1).alias("rank"),
        F.when(k % 4 == 3, F.concat(F.lit("UCX"), _s(k))).otherwise(chan).alias("channel_id"),
        F.col("c_name").alias("title"))
    second = c.filter(k % 4 == 1).select(
        F.concat(F.col("c_name"), F.lit(" Topic")).alias("query"), F.lit(2).alias("rank"),
        F.concat(F.lit("UCY"), _s(k)).alias("channel_id"), F.lit("runner-up").alias("title"))
    return topic.unionByName(plain).unionByName(second)


def user_channel_stats(spark, sf_dir) -> DataFrame:
    """Channel statistics responses per user channel; users with
    ``user_id % 6 = 5`` have none; ``user_id % 5 = 0`` hide subscribers;
    ``user_id % 8 = 1`` answer junk text for the view count and
    ``user_id % 8 = 3`` one above 2^53."""
    ev = table(spark, sf_dir, "events").filter(F.col("user_id") % 6 != 5)
    agg = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("v"),
                                    F.count_distinct("event_type").alias("t"))
    u = F.col("user_id")
    return agg.select(
        F.concat(F.lit("UC"), _s(u)).alias("channel_id"), F.concat(F.lit("Channel "), _s(u)).alias("title"),
        _s("n").alias("subscriberCount"),
        F.when(u % 8 == 1, F.lit("n/a")).when(u % 8 == 3, _s(F.col("v") + F.lit(2**53 + 1)))
         .otherwise(_s("v")).alias("viewCount"),
        _s("t").alias("videoCount"), (u % 5 == 0).alias("hiddenSubscriberCount"))


def event_videos(spark, sf_dir) -> DataFrame:
    """Videos = events; ``view`` events are in the music category;
    channels with ``user_id % 7 = 0`` do not support the category filter."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("UC"), _s("user_id")).alias("channel_id"), _s("event_id").alias("video_id"),
        F.when(F.col("event_type") == "view", F.lit("10")).otherwise(F.lit("20")).alias("category_id"),
        F.floor(F.col("value") * 100).cast("bigint").alias("view_count"),
        (F.col("user_id") % 7 != 0).alias("category_supported"))


def event_video_stats(spark, sf_dir) -> DataFrame:
    """Like counts per video as text; every eleventh is junk."""
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return ev.select(_s(k).alias("video_id"),
                     F.when(k % 11 == 0, F.lit("n/a")).otherwise(_s(k % 1000)).alias("likeCount"))


def customer_lookup_status(spark, sf_dir) -> DataFrame:
    """Outcome of each lookup call: quota / http / other failures planted.
    Two thirds land in batch 1, the rest (``c_custkey % 3 = 0``) in batch 2;
    every tenth row lands twice."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    status = (F.when(k % 97 == 5, F.lit("quota")).when(k % 23 == 1, F.lit("http"))
              .when(k % 23 == 2, F.lit("other")).otherwise(F.lit("ok")))
    detail = (F.when(k % 97 == 5, F.lit("quotaExceeded")).when(k % 23 == 1, F.lit("403"))
              .when(k % 23 == 2, F.lit("TimeoutError")).otherwise(F.lit(None).cast("string")))
    rows = c.select(F.col("c_name").alias("artist_query"), F.when(k % 3 == 0, 2).otherwise(1).cast("bigint").alias("batch_id"),
                    status.alias("status"), detail.alias("detail"), (k % 10 == 0).alias("again"))
    return rows.unionByName(rows.filter("again")).drop("again")


def search_table_from_parts(spark, sf_dir) -> DataFrame:
    """A second landed search table: one result list per brand, every third
    part answering the brand's Topic query. Rank 1 is the smallest part key
    of a query (a map-side-combined aggregate, not a window over a whole
    brand); every part is also listed as rank 2."""
    p = table(spark, sf_dir, "part")
    q = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_brand"), F.lit(" Topic"))).otherwise(F.col("p_brand"))
    d = p.select(q.alias("query"), F.col("p_partkey"), F.col("p_name"))
    first = d.groupBy("query").agg(F.min("p_partkey").alias("k"), F.min_by("p_name", "p_partkey").alias("title"))
    first = first.select("query", F.lit(1).alias("rank"), F.concat(F.lit("UC"), _s("k")).alias("channel_id"), "title")
    rest = d.select("query", F.lit(2).alias("rank"), F.concat(F.lit("UC"), _s("p_partkey")).alias("channel_id"),
                    F.col("p_name").alias("title"))
    return first.unionByName(rest)
