"""Explicit table schemas and the fixed value sets the cleaning rules use."""

from __future__ import annotations

import sys

from pyspark.sql import types as T

S, L, I, D, B, TS = (T.StringType(), T.LongType(), T.IntegerType(),
                     T.DoubleType(), T.BooleanType(), T.TimestampType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------------------
# Whitespace removed by Python's ``str.strip()`` (the reference trims with it).
# Built from a rule instead of a table: every code point Python calls space.
PY_WS: str = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results).
# Text read as NULL by the CSV reader by default (pandas' NA token list).
PANDAS_NA = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# Artist names never looked up (compared after trimming, case-sensitive).
EXCLUDED_ARTISTS = ["Various Artists", "(Various Artists)", "No Especificado", "", "Soundtrack"]
# Placeholders written into empty award fields.
AWARD_PLACEHOLDERS = {"artist": "No Especificado", "workers": "No Especificado", "img": "Sin URL"}
# Musical key number -> note name, mode number -> name.
KEY_NAMES = {0: "C", 1: "C#", 2: "D", 3: "D#", 4: "E", 5: "F", 6: "F#", 7: "G",
             8: "G#", 9: "A", 10: "A#", 11: "B"}
MODE_NAMES = {0: "Minor", 1: "Major"}
# Suffix of the preferred artist-channel search.
TOPIC_SUFFIX = " Topic"
# Video category searched first for an artist's top videos, and how many.
MUSIC_CATEGORY = "10"
TOP_VIDEOS = 10
# Text written into channel_id_found when a lookup failed.
ERROR_QUOTA = "Error: Quota Exceeded"
# Names of the exported index column dropped after a CSV read.
INDEX_COLUMNS = ["Unnamed: 0", "_c0"]
# ---------------------------------------------------------------------------

TRACK_TEXT = ["track_id", "artists", "album_name", "track_name", "track_genre"]
TRACK_KEYS_NOT_NULL = ["artists", "album_name", "track_name"]

TRACKS = _schema(
    ("track_id", S), ("artists", S), ("album_name", S), ("track_name", S),
    ("popularity", I), ("duration_ms", I), ("explicit", B), ("danceability", D),
    ("energy", D), ("key", I), ("loudness", D), ("mode", I), ("speechiness", D),
    ("acousticness", D), ("instrumentalness", D), ("liveness", D), ("valence", D),
    ("tempo", D), ("time_signature", I), ("track_genre", S),
)

AWARDS_RAW = _schema(
    ("year", I), ("title", S), ("published_at", S), ("updated_at", S),
    ("category", S), ("nominee", S), ("artist", S), ("workers", S), ("img", S),
    ("winner", B),
)
AWARDS = _schema(
    ("year", I), ("title", S), ("published_at", TS), ("updated_at", TS),
    ("category", S), ("nominee", S), ("artist", S), ("workers", S), ("img", S),
    ("winner", B),
)
AWARD_TEXT = ["title", "category", "nominee", "artist", "workers", "img"]
AWARD_DATES = ["published_at", "updated_at"]

CHANNEL_TEXT = ["artist_query", "channel_id_found", "channel_title_verified"]
CHANNEL_COUNTS = ["subscriber_count", "view_count", "video_count", "total_top10_video_likes"]
CHANNELS_RAW = _schema(
    ("artist_query", S), ("channel_id_found", S), ("channel_title_verified", S),
    ("subscriber_count", D), ("view_count", D), ("video_count", D),
    ("total_top10_video_likes", D),
)
CHANNELS = _schema(
    ("artist_query", S), ("channel_id_found", S), ("channel_title_verified", S),
    ("subscriber_count", L), ("view_count", L), ("video_count", L),
    ("total_top10_video_likes", L),
)

MERGED = T.StructType(
    list(TRACKS.fields)
    + [T.StructField(n, t, True) for n, t in [
        ("channel_id_found", S), ("channel_title_verified", S),
        ("subscriber_count", L), ("view_count", L), ("video_count", L),
        ("total_top10_video_likes", L), ("grammy_year", I),
        ("grammy_category", S), ("grammy_winner", B)]]
)

# Landed lookup responses (the web API is not called; its answers are tables).
CHANNEL_SEARCH = _schema(("query", S), ("rank", I), ("channel_id", S), ("title", S))
CHANNEL_STATS = _schema(("channel_id", S), ("title", S), ("subscriberCount", S),
                        ("viewCount", S), ("videoCount", S), ("hiddenSubscriberCount", B))
VIDEOS = _schema(("channel_id", S), ("video_id", S), ("category_id", S),
                 ("view_count", L), ("category_supported", B))
VIDEO_STATS = _schema(("video_id", S), ("likeCount", S))
LOOKUP_STATUS = _schema(("artist_query", S), ("batch_id", L), ("status", S), ("detail", S))
LOOKUP_STATUS_STEP = _schema(("artist_query", S), ("batch_id", L), ("status", S), ("detail", S), ("step", S))
# counts are bigint in the checkpoint: a double would lose digits above 2^53
CHECKPOINT = T.StructType(list(CHANNELS.fields) + [T.StructField("batch_id", L, True)])

# --- fixed values of the merge: columns, names and defaults of the enriched table ---
CHANNEL_DEFAULTS = {
    "channel_id_found": ("", "string"), "channel_title_verified": ("", "string"),
    "subscriber_count": (0, "bigint"), "view_count": (0, "bigint"),
    "video_count": (0, "bigint"), "total_top10_video_likes": (0, "bigint"),
}
AWARD_DEFAULTS = {
    "grammy_year": (None, "int"), "grammy_category": ("", "string"), "grammy_winner": (False, "boolean"),
}
AWARD_COLUMNS = ["artist", "nominee", "year", "category", "winner"]
AWARD_RENAMES = {"artist": "grammy_artist", "nominee": "grammy_nominee", "year": "grammy_year",
                 "category": "grammy_category", "winner": "grammy_winner"}
TRACK_AWARD_KEYS = ["artists", "track_name"]
AWARD_KEYS = ["grammy_artist", "grammy_nominee"]
