"""Channel-statistics enrichment over landed lookup responses
(U-02, J-07, E-05..E-08).

The reference calls a web API once per artist in a single thread. Here
the API's answers are tables (``schemas.CHANNEL_SEARCH``, ``CHANNEL_STATS``,
``VIDEOS``, ``VIDEO_STATS``, ``LOOKUP_STATUS``) and each per-artist step
becomes a join, so all artists are enriched by one distributed plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.functions.columns import (coerce_long, error_tag, hidden_to_sentinel, json_long,
                                         py_strip, topic_query)
from trackmart.operators.relational import exclude_values, top_n_per_group
from trackmart.schemas import EXCLUDED_ARTISTS, MUSIC_CATEGORY, TOP_VIDEOS


def artist_universe(track_artists: DataFrame, award_artists: DataFrame,
                    excluded=EXCLUDED_ARTISTS, placeholder: str = "No Especificado",
                    strip: bool = True) -> DataFrame:
    """Distinct artist names to look up (U-02): ``DISTINCT artists`` of the
    tracks ∪ ``DISTINCT artist`` of the awards (NULLs and the placeholder
    removed at the source, SC-05/SC-06) -> distinct -> names whose trimmed
    form is in ``excluded`` dropped (F-04) -> trimmed -> distinct -> ''
    dropped (F-05).
    Inputs are one-column frames. ``strip=False`` with a shorter
    ``excluded`` list gives the notebook variant (no trimming)."""
    a = track_artists.select(F.col(track_artists.columns[0]).alias("artist_name"))
    a = a.filter(F.col("artist_name").isNotNull()).distinct()
    b = award_artists.select(F.col(award_artists.columns[0]).alias("artist_name"))
    b = b.filter(F.col("artist_name").isNotNull() & (F.col("artist_name") != placeholder)).distinct()
    names = a.unionByName(b).distinct()
    names = exclude_values(names, "artist_name", excluded, strip=strip)
    if strip:
        names = names.select(py_strip("artist_name").alias("artist_name")).distinct()
    return names.filter(F.col("artist_name") != "")


def first_results(search: DataFrame) -> DataFrame:
    """The first search result per query (``maxResults=1``), exactly one row
    per query even if the landed table repeats rank 1 (smallest channel id
    wins), so the lookup joins stay N:1. A map-side-combined aggregate."""
    return (search.filter(F.col("rank") == 1).groupBy("query")
            .agg(F.min("channel_id").alias("channel_id"), F.min_by("title", "channel_id").alias("title")))


def two_tier_lookup(names: DataFrame, search: DataFrame, name_col: str = "artist_query") -> DataFrame:
    """First result for ``"<name> Topic"``, else first result for
    ``"<name>"``, else NULL (J-07, X-07). Adds ``channel_id``,
    ``channel_title`` and ``matched_via`` ('topic' / 'plain' / NULL)."""
    first = first_results(search)
    topic = first.select(F.col("query").alias("__tq"), F.col("channel_id").alias("__tid"),
                         F.col("title").alias("__tt"))
    plain = first.select(F.col("query").alias("__pq"), F.col("channel_id").alias("__pid"),
                         F.col("title").alias("__pt"))
    n = F.col(name_col)
    out = (names.join(topic, topic_query(n) == F.col("__tq"), "left")
                .join(plain, n == F.col("__pq"), "left"))
    return out.select(
        *[c for c in names.columns],
        F.coalesce("__tid", "__pid").alias("channel_id"),
        F.when(F.col("__tid").isNotNull(), F.col("__tt")).otherwise(F.col("__pt")).alias("channel_title"),
        F.when(F.col("__tid").isNotNull(), F.lit("topic"))
         .when(F.col("__pid").isNotNull(), F.lit("plain")).alias("matched_via"))


def channel_record(stats: DataFrame) -> DataFrame:
    """Statistics record per channel (E-06, X-08, X-09): counts parsed with
    default 0, hidden subscriber count -> -1. One record per channel even if
    a replayed landing repeated a response."""
    others = [c for c in stats.columns if c != "channel_id"]
    stats = stats.groupBy("channel_id").agg(F.max(F.struct(*others)).alias("__r")).select("channel_id", "__r.*")
    return stats.select(
        "channel_id", F.col("title").alias("channel_title_verified"),
        hidden_to_sentinel("hiddenSubscriberCount", F.coalesce(coerce_long("subscriberCount"), F.lit(0).cast("bigint")))
        .alias("subscriber_count"),
        F.coalesce(coerce_long("viewCount"), F.lit(0).cast("bigint")).alias("view_count"),
        F.coalesce(coerce_long("videoCount"), F.lit(0).cast("bigint")).alias("video_count"))


def channel_record_from_json(stats_json: DataFrame, json_col: str = "statistics") -> DataFrame:
    """Same record from a JSON text column (``{"subscriberCount": "12", ...}``)."""
    j = F.col(json_col)
    return stats_json.select(
        "channel_id", "title",
        hidden_to_sentinel(F.get_json_object(j, "$.hiddenSubscriberCount").try_cast("boolean"),
                           json_long(j, "subscriberCount")).alias("subscriber_count"),
        json_long(j, "viewCount").alias("view_count"), json_long(j, "videoCount").alias("video_count"))


def top_videos(videos: DataFrame, n: int = TOP_VIDEOS, category: str = MUSIC_CATEGORY) -> DataFrame:
    """Most viewed ``n`` videos per channel in ``category``; channels where
    the category filter is not supported rank all their videos (E-05, W-03).
    A channel with no video in the category gets none (no fallback)."""
    eligible = videos.filter(~F.coalesce(F.col("category_supported"), F.lit(True)) |
                             (F.col("category_id") == category))
    return top_n_per_group(eligible, ["channel_id"],
                           [F.col("view_count").desc_nulls_last(), F.col("video_id").asc()], n, "rank")


def top_video_likes(videos: DataFrame, video_stats: DataFrame, n: int = TOP_VIDEOS) -> DataFrame:
    """Sum of like counts over each channel's top videos (A-20): NULL and
    non-numeric counts skipped; a channel without videos sums to 0 later."""
    top = top_videos(videos, n).select("channel_id", "video_id")
    likes = top.join(video_stats.select("video_id", "likeCount"), "video_id", "left")
    # one like count per top video even if a replayed landing repeated it;
    # grouped after the join, so only the top videos' rows are aggregated
    per_video = likes.groupBy("channel_id", "video_id").agg(F.max(coerce_long("likeCount")).alias("likes"))
    return per_video.groupBy("channel_id").agg(
        F.coalesce(F.sum("likes"), F.lit(0).cast("bigint")).alias("total_top10_video_likes"))


def assemble_lookup(names: DataFrame, search: DataFrame, stats: DataFrame, videos: DataFrame,
                    video_stats: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """One result row per artist (E-07) with the reference's NULL rules:
    no channel -> every field NULL; channel without statistics -> id kept,
    the five other fields NULL; otherwise all seven fields.

    A full run joins statistics and top videos directly. An incremental
    batch passes ``found`` (the two-tier result, stored once): only its
    channels' statistics and videos are then reduced."""
    if found is None:
        found = two_tier_lookup(names, search).select("artist_query", "channel_id")
    else:
        wanted = found.select("channel_id").filter(F.col("channel_id").isNotNull()).distinct()
        stats = stats.join(wanted, "channel_id", "left_semi")
        videos = videos.join(wanted, "channel_id", "left_semi")
    rec = channel_record(stats)
    likes = top_video_likes(videos, video_stats)
    out = (found.join(rec, "channel_id", "left")
                .join(likes, "channel_id", "left"))
    has_stats = F.col("channel_title_verified").isNotNull() | F.col("subscriber_count").isNotNull()
    return out.select(
        "artist_query", F.col("channel_id").alias("channel_id_found"), "channel_title_verified",
        "subscriber_count", "view_count", "video_count",
        F.when(has_stats, F.coalesce("total_top10_video_likes", F.lit(0).cast("bigint")))
         .alias("total_top10_video_likes"))


def one_status(status: DataFrame, batch_id: int | None = None) -> DataFrame:
    """One landed outcome per artist (of ``batch_id``, where given): a
    replayed row counts once, a failure wins over 'ok', then the greatest
    (status, detail, step)."""
    if batch_id is not None:
        status = status.filter(F.col("batch_id") == batch_id)
    step = F.col("step") if "step" in status.columns else F.lit("search")
    worst = F.max(F.struct((F.coalesce("status", F.lit("ok")) != "ok").alias("failed"), "status", "detail", step.alias("step")))
    return (status.filter(F.col("artist_query").isNotNull()).groupBy("artist_query").agg(worst.alias("__s"))
            .select("artist_query", "__s.status", "__s.detail", "__s.step"))


def tag_failures(results: DataFrame, status: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Apply landed call outcomes (E-08): a failed lookup keeps its row.
    ``step`` (optional column: search / stats / videos) says which call
    failed; fields filled before it are kept, the error text goes to
    ``channel_id_found`` only when the search itself failed, and the rest
    is NULL. Every artist keeps its own outcome; one artist's quota failure
    does not touch the others."""
    joined = results.join(one_status(status, batch_id), "artist_query", "left")
    failed = F.coalesce(F.col("status"), F.lit("ok")) != "ok"
    at = F.coalesce(F.col("step"), F.lit("search"))
    # fields filled before the failing call are kept (the reference's setdefault)
    lost_id = failed & (at == "search")
    lost_stats = failed & at.isin("search", "stats")
    stats_cols = ["channel_title_verified", "subscriber_count", "view_count", "video_count"]
    return joined.select(
        "artist_query",
        F.when(lost_id, error_tag("status", "detail")).otherwise(F.col("channel_id_found")).alias("channel_id_found"),
        *[F.when(lost_stats, F.lit(None)).otherwise(F.col(c)).alias(c) for c in stats_cols],
        F.when(failed, F.lit(None)).otherwise(F.col("total_top10_video_likes")).alias("total_top10_video_likes"))
