"""DuckDB SQL twins of ``star_queries``: the same inputs (same planted
values) and the reference's semantics written brute force (full 1:N
fan-out before dedup, window ranks, and so on), used as the correctness
oracle. Tables are the pre-registered views of the test data.
"""

from __future__ import annotations

from trackmart.plans.scale_sql import SQL as SCALE

# Spelled here again, not imported: an error in the library's lists must show.
# White space as Python trims it: 9-13, 28-32, 133, 160, 5760, 8192-8202, 8232, 8233, 8239, 8287, 12288.
WS = " || ".join(f"chr({c})" for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])
EXCLUDED_ARTISTS = ["Various Artists", "(Various Artists)", "No Especificado", "", "Soundtrack"]
KEY_NAMES = {0: "C", 1: "C#", 2: "D", 3: "D#", 4: "E", 5: "F", 6: "F#", 7: "G", 8: "G#", 9: "A", 10: "A#", 11: "B"}
MODE_NAMES = {0: "Minor", 1: "Major"}


def _trim(x: str) -> str:
    return f"trim({x}, {WS})"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


EXCL = ", ".join(_q(v) for v in EXCLUDED_ARTISTS)

# --- shared inputs -------------------------------------------------------------------

TRACKS = """
tracks AS (
  SELECT CAST(event_id AS VARCHAR) AS track_id, CAST(user_id AS VARCHAR) AS artists,
         event_type AS track_name, CAST(floor(value) AS INTEGER) AS popularity, 'main' AS track_genre
  FROM events
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type,
         CAST(floor(value) AS INTEGER), 'copy'
  FROM events WHERE event_id % 10 = 0)"""

CHANNELS = """
channels AS (
  SELECT CAST(user_id AS VARCHAR) AS artist_query, 'ch' || CAST(user_id AS VARCHAR) AS channel_id_found,
         'Channel ' || CAST(user_id AS VARCHAR) AS channel_title_verified,
         count(*) AS subscriber_count, CAST(sum(event_id) AS BIGINT) AS view_count,
         count(DISTINCT event_type) AS video_count, max(event_id) AS total_top10_video_likes
  FROM events WHERE user_id % 7 <> 3 GROUP BY user_id)"""

AWARDS = """
awards AS (
  SELECT CAST(o_custkey // 10 AS VARCHAR) AS artist,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'purchase' WHEN '2-HIGH' THEN 'view'
              WHEN '3-MEDIUM' THEN 'click' WHEN '4-NOT SPECIFIED' THEN 'signup' ELSE 'error' END AS nominee,
         CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus || '-' || o_orderpriority AS category,
         o_orderstatus = 'F' AS winner
  FROM orders)"""

J1 = """
j1 AS (
  SELECT t.*, coalesce(c.channel_id_found, '') AS channel_id_found,
         coalesce(c.channel_title_verified, '') AS channel_title_verified,
         coalesce(c.subscriber_count, 0) AS subscriber_count, coalesce(c.view_count, 0) AS view_count,
         coalesce(c.video_count, 0) AS video_count,
         coalesce(c.total_top10_video_likes, 0) AS total_top10_video_likes
  FROM tracks t LEFT JOIN channels c ON t.artists = c.artist_query)"""

J1_DEFAULTS = """
j1 AS (
  SELECT t.*, '' AS channel_id_found, '' AS channel_title_verified, CAST(0 AS BIGINT) AS subscriber_count,
         CAST(0 AS BIGINT) AS view_count, CAST(0 AS BIGINT) AS video_count,
         CAST(0 AS BIGINT) AS total_top10_video_likes
  FROM tracks t)"""

J2_DEDUP = """
j2 AS (
  SELECT j1.*, a.year AS grammy_year, coalesce(a.category, '') AS grammy_category,
         coalesce(a.winner, false) AS grammy_winner
  FROM j1 LEFT JOIN awards a ON j1.artists = a.artist AND j1.track_name = a.nominee),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY grammy_year DESC NULLS LAST,
         grammy_category ASC NULLS LAST, grammy_winner DESC NULLS LAST, track_genre ASC NULLS LAST) AS rn
  FROM j2)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1"""

RAW_TRACKS = f"""
raw AS (
  SELECT CAST(p_partkey AS VARCHAR) AS track_id,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS artists, p_type AS album_name,
         CASE WHEN p_partkey % 7 = 0 THEN chr(9) || p_name || chr(160) ELSE p_name END AS track_name,
         p_size AS popularity, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS track_genre
  FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END, p_type,
         CASE WHEN p_partkey % 7 = 0 THEN chr(9) || p_name || chr(160) ELSE p_name END,
         p_size, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END
  FROM part WHERE p_partkey % 10 = 0
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END, p_type,
         p_name || chr(12288), p_size, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END
  FROM part WHERE p_partkey % 10 = 1)"""

RAW_AWARDS = """
raw AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'Award ' || o_orderpriority END AS title,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 9 = 1 THEN 'not a date'
              WHEN o_orderkey % 9 = 2 THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+05:00' END AS published_at,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS updated_at,
         chr(160) || o_orderpriority AS category,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'Order ' || CAST(o_orderkey AS VARCHAR) END AS nominee,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE ' cust' || CAST(o_custkey AS VARCHAR) || chr(9) END AS artist,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS workers,
         CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'http://img/' || CAST(o_orderkey AS VARCHAR) END AS img,
         o_orderstatus = 'F' AS winner
  FROM orders)"""


def _epoch(x: str) -> str:
    return (f"CAST(CASE WHEN {x} LIKE '%+__:__' THEN epoch(try_cast({x} AS TIMESTAMPTZ)) "
            f"ELSE epoch(try_cast({x} AS TIMESTAMP)) END AS BIGINT)")


RAW_CHANNELS = """
raw AS (
  SELECT CASE WHEN s_suppkey % 10 = 0 THEN chr(12288) || s_name ELSE s_name || ' ' END AS artist_query,
         CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE 'UC' || CAST(s_suppkey AS VARCHAR) END AS channel_id_found,
         CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE chr(9) || 'Title ' || CAST(s_nationkey AS VARCHAR) END
           AS channel_title_verified,
         CASE WHEN s_suppkey % 9 = 0 THEN 'x' WHEN s_suppkey % 9 = 1 THEN '-1' WHEN s_suppkey % 9 = 2 THEN NULL
              WHEN s_suppkey % 9 = 3 THEN CAST(9007199254740993 + 2 * s_suppkey AS VARCHAR)
              ELSE CAST(s_suppkey * 100 AS VARCHAR) || '.0' END AS subscriber_count,
         CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_acctbal END AS view_count,
         CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) END AS video_count,
         CAST(s_suppkey AS DOUBLE) * 1.5 AS total_top10_video_likes
  FROM supplier)"""


def _long0(x: str) -> str:
    """Spark's double -> bigint truncation, NULL -> 0."""
    return f"coalesce(CAST(trunc({x}) AS BIGINT), 0)"


CLEAN_CHANNELS_SELECT = f"""
SELECT {_trim("coalesce(artist_query, '')")} AS artist_query,
       {_trim("coalesce(channel_id_found, '')")} AS channel_id_found,
       {_trim("coalesce(channel_title_verified, '')")} AS channel_title_verified,
       coalesce(nullif(CASE WHEN regexp_full_match(subscriber_count, '-?[0-9]+') THEN CAST(subscriber_count AS BIGINT)
                            ELSE CAST(trunc(try_cast(subscriber_count AS DOUBLE)) AS BIGINT) END, -1), 0) AS subscriber_count,
       {_long0("view_count")} AS view_count, {_long0("video_count")} AS video_count,
       {_long0("total_top10_video_likes")} AS total_top10_video_likes
FROM raw"""
CLEAN_CHANNELS = f"WITH {RAW_CHANNELS.strip()}{CLEAN_CHANNELS_SELECT}"

# landed lookup responses of the enrichment queries
LANDED = """
search AS (
  SELECT c_name || ' Topic' AS query, 1 AS rank, 'UC' || CAST(c_custkey // 10 AS VARCHAR) AS channel_id,
         'Topic of ' || c_name AS title
  FROM customer WHERE c_custkey % 4 = 1 OR c_custkey % 4 = 3
  UNION ALL
  SELECT c_name, 1, CASE WHEN c_custkey % 4 = 3 THEN 'UCX' || CAST(c_custkey AS VARCHAR)
                         ELSE 'UC' || CAST(c_custkey // 10 AS VARCHAR) END, c_name
  FROM customer WHERE c_custkey % 4 = 2 OR c_custkey % 4 = 3
  UNION ALL
  SELECT c_name || ' Topic', 2, 'UCY' || CAST(c_custkey AS VARCHAR), 'runner-up'
  FROM customer WHERE c_custkey % 4 = 1),
stats AS (
  SELECT 'UC' || CAST(user_id AS VARCHAR) AS channel_id, 'Channel ' || CAST(user_id AS VARCHAR) AS title,
         CAST(count(*) AS VARCHAR) AS subscriberCount,
         CASE WHEN user_id % 8 = 1 THEN 'n/a' WHEN user_id % 8 = 3 THEN CAST(sum(event_id) + 9007199254740993 AS VARCHAR)
              ELSE CAST(sum(event_id) AS VARCHAR) END AS viewCount,
         CAST(count(DISTINCT event_type) AS VARCHAR) AS videoCount, user_id % 5 = 0 AS hidden
  FROM events WHERE user_id % 6 <> 5 GROUP BY user_id),
videos AS (
  SELECT 'UC' || CAST(user_id AS VARCHAR) AS channel_id, CAST(event_id AS VARCHAR) AS video_id,
         CASE WHEN event_type = 'view' THEN '10' ELSE '20' END AS category_id,
         CAST(floor(value * 100) AS BIGINT) AS view_count, user_id % 7 <> 0 AS category_supported
  FROM events),
video_stats AS (
  SELECT CAST(event_id AS VARCHAR) AS video_id,
         CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE CAST(event_id % 1000 AS VARCHAR) END AS likeCount
  FROM events),
topv AS (
  SELECT channel_id, video_id FROM (
    SELECT channel_id, video_id, row_number() OVER (PARTITION BY channel_id
           ORDER BY view_count DESC NULLS LAST, video_id) AS rn
    FROM videos WHERE NOT category_supported OR category_id = '10') WHERE rn <= 10),
likes AS (
  SELECT t.channel_id, CAST(coalesce(sum(CAST(trunc(try_cast(s.likeCount AS DOUBLE)) AS BIGINT)), 0) AS BIGINT)
         AS total_top10_video_likes
  FROM topv t LEFT JOIN video_stats s ON t.video_id = s.video_id GROUP BY t.channel_id),
found AS (
  SELECT c.c_name AS artist_query, coalesce(t.channel_id, p.channel_id) AS channel_id
  FROM customer c
  LEFT JOIN (SELECT * FROM search WHERE rank = 1) t ON c.c_name || ' Topic' = t.query
  LEFT JOIN (SELECT * FROM search WHERE rank = 1) p ON c.c_name = p.query),
assembled AS (
  SELECT f.artist_query, f.channel_id AS channel_id_found, s.title AS channel_title_verified,
         CASE WHEN s.channel_id IS NULL THEN NULL WHEN s.hidden THEN CAST(-1 AS BIGINT)
              ELSE coalesce(CAST(trunc(try_cast(s.subscriberCount AS DOUBLE)) AS BIGINT), 0) END AS subscriber_count,
         CASE WHEN s.channel_id IS NULL THEN NULL
              ELSE coalesce(try_cast(s.viewCount AS BIGINT), 0) END AS view_count,
         CASE WHEN s.channel_id IS NULL THEN NULL
              ELSE coalesce(CAST(trunc(try_cast(s.videoCount AS DOUBLE)) AS BIGINT), 0) END AS video_count,
         CASE WHEN s.channel_id IS NULL THEN NULL ELSE coalesce(l.total_top10_video_likes, 0) END
           AS total_top10_video_likes
  FROM found f LEFT JOIN stats s ON f.channel_id = s.channel_id
  LEFT JOIN likes l ON f.channel_id = l.channel_id)"""

STATUS = """
status AS (
  SELECT c_name AS artist_query,
         CASE WHEN c_custkey % 97 = 5 THEN 'quota' WHEN c_custkey % 23 = 1 THEN 'http'
              WHEN c_custkey % 23 = 2 THEN 'other' ELSE 'ok' END AS status,
         CASE WHEN c_custkey % 97 = 5 THEN 'quotaExceeded' WHEN c_custkey % 23 = 1 THEN '403'
              WHEN c_custkey % 23 = 2 THEN 'TimeoutError' END AS detail
  FROM customer)"""

LINE_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
             "l_discount, l_tax, l_returnflag, l_linestatus")
LINE_COPIES = f"""
li AS (
  SELECT {LINE_COLS} FROM lineitem
  UNION ALL
  SELECT {LINE_COLS} FROM lineitem WHERE l_orderkey % 10 = 0)"""

EVENTS_NULLS = """
ev AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_id % 25 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 9 = 0 OR event_id % 31 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE props END AS props
  FROM events)"""

FLAGS = "flags AS (SELECT CASE WHEN l_orderkey % 20 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem)"

YEARS = "yrs AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_custkey FROM orders)"

QS = [0.25, 0.5, 0.75, 0.95, 0.98, 0.99]

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_NUM = {"o_orderkey", "o_custkey", "o_totalprice"}


def _order_typed(c: str) -> tuple[str, str]:
    if c in ORDER_NUM:
        return f"CAST({c} AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    if c == "o_orderdate":
        return "CAST(NULL AS DOUBLE)", f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
    return "CAST(NULL AS DOUBLE)", f"CAST({c} AS VARCHAR)"


# NaN counts as missing, so it is NULL here.
FINE_ORDERS = """(SELECT o_orderkey + 9007199254740993 AS o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
  CAST(o_orderdate AS TIMESTAMP) + to_microseconds(CAST(o_orderkey % 7 * 100000 AS BIGINT)) AS o_orderdate, o_orderpriority FROM orders)"""


def _column_profile_sql() -> str:
    parts = []
    for i, c in enumerate(ORDER_COLS):
        num, txt = _order_typed(c)
        parts.append(f"""
  SELECT CAST({i} AS BIGINT) AS pos, '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls,
         count(DISTINCT {c}) AS n_unique, min({num}) AS min_num, max({num}) AS max_num,
         min({txt}) AS min_text, max({txt}) AS max_text,
         CASE WHEN count(DISTINCT {c}) <= 50 THEN count(DISTINCT {c}) ELSE 20 END AS n_shown,
         count(DISTINCT {c}) - CASE WHEN count(DISTINCT {c}) <= 50 THEN count(DISTINCT {c}) ELSE 20 END AS n_more
  FROM {FINE_ORDERS}""")
    return "\nUNION ALL".join(parts)


def _column_samples_sql() -> str:
    parts = []
    for c in ORDER_COLS:
        num, txt = _order_typed(c)
        parts.append(f"""
SELECT '{c}' AS "column", CAST(rank AS BIGINT) AS rank, {num} AS value_num, {txt} AS value_text
FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS rank, count(*) OVER () AS k
      FROM (SELECT DISTINCT {c} FROM {FINE_ORDERS} WHERE {c} IS NOT NULL))
WHERE rank <= CASE WHEN k <= 50 THEN k ELSE 20 END""")
    return "\nUNION ALL".join(parts)


LINE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax"]


def _describe_numeric_sql() -> str:
    parts = [f"""
  SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
         round(CAST(min({c}) AS DOUBLE), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25,
         round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
         round(CAST(max({c}) AS DOUBLE), 4) AS max
  FROM lineitem""" for c in LINE_NUMERIC]
    return "\nUNION ALL".join(parts)


def _describe_text_sql() -> str:
    parts = []
    for c in ["o_orderstatus", "o_orderpriority"]:
        parts.append(f"""
  SELECT '{c}' AS "column", sum(freq) AS count, count(*) AS "unique",
         arg_min(value, (-freq, value)) AS top, max(freq) AS freq
  FROM (SELECT {c} AS value, count(*) AS freq FROM orders WHERE {c} IS NOT NULL GROUP BY {c})""")
    body = "\nUNION ALL".join(parts)
    return f"SELECT \"column\", CAST(count AS BIGINT) AS count, \"unique\", top, freq FROM ({body})"


def _quantiles_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", CAST({q} AS DOUBLE) AS q, round(quantile_cont({c}, {q}), 4) AS value "
             f"FROM lineitem"
             for c in ["l_extendedprice", "l_quantity"] for q in QS]
    return "\nUNION ALL ".join(parts)


def _histogram_sql(src: str, x: str, bins: str) -> str:
    return f"""
WITH {src},
mm AS (SELECT min(CAST({x} AS DOUBLE)) AS lo, max(CAST({x} AS DOUBLE)) AS hi, {bins} AS n FROM data),
w AS (SELECT lo, hi, n, (hi - lo) / n AS width FROM mm),
b AS (SELECT CASE WHEN w.width > 0 THEN least(CAST(floor((CAST({x} AS DOUBLE) - w.lo) / w.width) AS BIGINT) + 1, w.n)
                  ELSE 1 END AS bin
      FROM data, w WHERE {x} IS NOT NULL),
c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin),
dom AS (SELECT CAST(range AS BIGINT) AS bin FROM w, range(1, w.n + 1))
SELECT dom.bin, round(w.lo + (dom.bin - 1) * w.width, 4) AS lower,
       round(CASE WHEN dom.bin = w.n THEN w.hi ELSE w.lo + dom.bin * w.width END, 4) AS upper,
       coalesce(c.count, 0) AS count
FROM dom CROSS JOIN w LEFT JOIN c ON dom.bin = c.bin"""


DENSITY = """
WITH data AS (SELECT CAST(c_acctbal AS DOUBLE) AS x FROM customer WHERE c_acctbal IS NOT NULL),
s AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n, stddev_samp(x) AS sd FROM data),
b AS (SELECT lo, hi, n, sd * pow(n, -1.0 / 5.0) AS bw FROM s),
g AS (SELECT lo - 3.0 * bw AS start, ((hi + 3.0 * bw) - (lo - 3.0 * bw)) / 199 AS step, bw, n FROM b),
grid AS (SELECT CAST(range AS BIGINT) AS point, start + range * step AS gx, bw, n FROM g, range(0, 200))
SELECT point, round(gx, 4) AS x,
       round(sum(exp(-0.5 * pow((gx - data.x) / bw, 2))) * (1.0 / (n * bw * sqrt(2.0 * pi()))), 12) AS density
FROM grid, data GROUP BY point, gx, bw, n"""


def _label_case(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


CSV_PART = """
SELECT p_partkey,
       CASE WHEN p_partkey % 5 = 0 THEN '"' || p_name || '" Cast' WHEN p_partkey % 5 = 1 THEN p_name || ', deluxe'
            WHEN p_partkey % 5 = 2 THEN NULL ELSE p_name END AS p_name,
       p_brand, p_size, p_retailprice
FROM part"""


INCREMENTAL = f"""WITH {LANDED.strip()},{STATUS},
tagged AS (
  SELECT a.artist_query,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.channel_id_found
              WHEN s.status = 'quota' THEN 'Error: Quota Exceeded'
              WHEN s.status = 'http' THEN 'Error: HTTP ' || s.detail
              WHEN s.status = 'other' THEN 'Error: ' || s.detail END AS channel_id_found,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.channel_title_verified END AS channel_title_verified,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.subscriber_count END AS subscriber_count,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.view_count END AS view_count,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.video_count END AS video_count,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.total_top10_video_likes END AS total_top10_video_likes
  FROM assembled a JOIN status s ON a.artist_query = s.artist_query),
u AS (SELECT * FROM tagged)
SELECT artist_query, coalesce(channel_id_found, '') AS channel_id_found,
       coalesce(channel_title_verified, '') AS channel_title_verified,
       coalesce(nullif(subscriber_count, -1), 0) AS subscriber_count, coalesce(view_count, 0) AS view_count,
       coalesce(video_count, 0) AS video_count, coalesce(total_top10_video_likes, 0) AS total_top10_video_likes
FROM u"""

SQL = {
    "merge_latest": f"WITH {TRACKS.strip()},{CHANNELS},{AWARDS},{J1},{J2_DEDUP}",
    "merge_no_channels": f"WITH {TRACKS.strip()},{AWARDS},{J1_DEFAULTS},{J2_DEDUP}",
    "merge_no_awards": f"""WITH {TRACKS.strip()},{CHANNELS},{J1}
SELECT *, CAST(NULL AS INTEGER) AS grammy_year, '' AS grammy_category, false AS grammy_winner FROM j1""",
    "merge_match_report": f"""WITH {TRACKS.strip()},{CHANNELS},{AWARDS},{J1}
SELECT 'channels' AS "join", CAST(coalesce(sum(CASE WHEN subscriber_count IS NOT NULL AND subscriber_count <> 0
       THEN 1 ELSE 0 END), 0) AS BIGINT) AS matched_rows, count(*) AS total_rows FROM j1
UNION ALL
SELECT 'awards', CAST(sum(CASE WHEN a.year IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT), count(*)
FROM j1 LEFT JOIN awards a ON j1.artists = a.artist AND j1.track_name = a.nominee
UNION ALL
SELECT 'shared_track_id', CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT), CAST(sum(n) AS BIGINT)
FROM (SELECT track_id, count(*) AS n FROM j1 LEFT JOIN awards a ON j1.artists = a.artist AND j1.track_name = a.nominee
      GROUP BY track_id)""",
    "clean_tracks": f"""WITH {RAW_TRACKS.strip()}
SELECT {_trim("coalesce(track_id, '')")} AS track_id, {_trim("coalesce(artists, '')")} AS artists,
       {_trim("coalesce(album_name, '')")} AS album_name, {_trim("coalesce(track_name, '')")} AS track_name,
       popularity, {_trim("coalesce(track_genre, '')")} AS track_genre
FROM (SELECT DISTINCT * FROM raw)
WHERE artists IS NOT NULL AND album_name IS NOT NULL AND track_name IS NOT NULL""",
    "clean_awards": f"""WITH {RAW_AWARDS.strip()}
SELECT year, {_trim("title")} AS title, {_epoch("published_at")} AS published_epoch,
       {_epoch("updated_at")} AS updated_epoch, {_trim("category")} AS category, {_trim("nominee")} AS nominee,
       {_trim("coalesce(artist, 'No Especificado')")} AS artist,
       {_trim("coalesce(workers, 'No Especificado')")} AS workers,
       {_trim("coalesce(img, 'Sin URL')")} AS img, winner
FROM raw WHERE nominee IS NOT NULL""",
    "clean_channels": CLEAN_CHANNELS,
    "coercion_report": f"""WITH {RAW_AWARDS.strip()},
p AS (SELECT published_at, updated_at, {_epoch("published_at")} AS pub, {_epoch("updated_at")} AS upd, nominee FROM raw)
SELECT count(*) AS rows, count(published_at) AS published_at_before, count(pub) AS published_at_after,
       CAST(sum(CASE WHEN published_at IS NOT NULL AND pub IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS published_at_coerced,
       count(updated_at) AS updated_at_before, count(upd) AS updated_at_after,
       CAST(sum(CASE WHEN updated_at IS NOT NULL AND upd IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS updated_at_coerced,
       CAST(sum(CASE WHEN nominee IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_missing_required
FROM p""",
    "left_join_single": """
SELECT c.c_custkey, c.c_name, c.c_mktsegment, coalesce(o.n_open_orders, 0) AS n_open_orders, o.open_value
FROM customer c LEFT JOIN (
  SELECT o_custkey, count(*) AS n_open_orders, round(sum(o_totalprice), 2) AS open_value
  FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""",
    "left_join_composite": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
       coalesce(r.n_returned, 0) AS n_returned, coalesce(r.qty_returned, 0.0) AS qty_returned
FROM lineitem l LEFT JOIN (
  SELECT l_partkey AS r_partkey, l_suppkey AS r_suppkey, count(*) AS n_returned, sum(l_quantity) AS qty_returned
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey, l_suppkey) r
  ON l.l_partkey = r.r_partkey AND l.l_suppkey = r.r_suppkey""",
    "match_rate": """
SELECT 'customers_events' AS "join",
       CAST(coalesce(sum(CASE WHEN e.n IS NOT NULL AND e.n <> 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS matched_rows,
       count(*) AS total_rows
FROM customer c LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) e ON c.c_custkey = e.user_id""",
    "label_lookup": f"""
SELECT p_partkey, {_label_case("p_size % 13", KEY_NAMES)} AS key_name,
       {_label_case("p_size % 2", MODE_NAMES)} AS mode_name FROM part""",
    "domain_reindex": """
SELECT n.n_nationkey, n.n_name, r.n_rich_suppliers
FROM nation n LEFT JOIN (SELECT s_nationkey, count(*) AS n_rich_suppliers FROM supplier
                         WHERE s_acctbal > 9000 GROUP BY s_nationkey) r ON n.n_nationkey = r.s_nationkey""",
    "pending_keys": """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey IS NOT NULL)
ORDER BY c_custkey""",
    "entity_universe": f"""
WITH a AS (
  SELECT CASE WHEN c_custkey % 50 = 3 THEN NULL WHEN c_custkey % 50 = 0 THEN 'Various Artists'
              WHEN c_custkey % 50 = 1 THEN '' WHEN c_custkey % 50 = 2 THEN ' Soundtrack '
              WHEN c_custkey % 50 = 4 THEN '(Various Artists)' WHEN c_custkey % 50 = 5 THEN chr(160)
              WHEN c_custkey % 3 = 0 THEN c_name || ' ' ELSE c_name END AS name FROM customer),
b AS (SELECT CASE WHEN s_suppkey % 10 = 0 THEN 'No Especificado' ELSE s_name END AS name FROM supplier),
u AS (SELECT DISTINCT name FROM a WHERE name IS NOT NULL
      UNION SELECT DISTINCT name FROM b WHERE name IS NOT NULL AND name <> 'No Especificado')
SELECT DISTINCT {_trim("name")} AS artist_name FROM u
WHERE {_trim("name")} NOT IN ({EXCL}) AND {_trim("name")} <> ''""",
    "two_tier_lookup": """
WITH search AS (
  SELECT CASE WHEN p_partkey % 3 = 0 THEN p_brand || ' Topic' ELSE p_brand END AS query, p_partkey, p_name FROM part),
first AS (SELECT query, 'UC' || CAST(min(p_partkey) AS VARCHAR) AS channel_id, arg_min(p_name, p_partkey) AS title
          FROM search GROUP BY query),
names AS (SELECT DISTINCT p_brand AS artist_query FROM part UNION SELECT DISTINCT c_mktsegment FROM customer)
SELECT n.artist_query, coalesce(t.channel_id, p.channel_id) AS channel_id,
       CASE WHEN t.channel_id IS NOT NULL THEN t.title ELSE p.title END AS channel_title,
       CASE WHEN t.channel_id IS NOT NULL THEN 'topic' WHEN p.channel_id IS NOT NULL THEN 'plain' END AS matched_via
FROM names n LEFT JOIN first t ON n.artist_query || ' Topic' = t.query
LEFT JOIN first p ON n.artist_query = p.query""",
    "topn_per_group": """
SELECT user_id, event_id, value, rank FROM (
  SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank
  FROM events) WHERE rank <= 10""",
    "topn_with_fallback": """WITH
videos AS (
  SELECT 'UC' || CAST(user_id AS VARCHAR) AS channel_id, CAST(event_id AS VARCHAR) AS video_id,
         CASE WHEN event_type = 'view' THEN '10' ELSE '20' END AS category_id,
         CAST(floor(value * 100) AS BIGINT) AS view_count, user_id % 7 <> 0 AS category_supported
  FROM events)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY view_count DESC NULLS LAST, video_id) AS rank
  FROM videos WHERE NOT category_supported OR category_id = '10') WHERE rank <= 10""",
    "json_stats": """
SELECT event_id,
       CASE WHEN user_id % 5 = 0 THEN CAST(-1 AS BIGINT)
            ELSE coalesce(CAST(trunc(try_cast(json_extract_string(
                 CASE WHEN event_id % 13 = 0 THEN '{"k": "abc"}' WHEN event_id % 17 = 0 THEN '{}' ELSE props END,
                 '$.k') AS DOUBLE)) AS BIGINT), 0) END AS subscriber_count
FROM events""",
    "safe_sum": """
SELECT user_id, CAST(coalesce(sum(CAST(trunc(try_cast(likes AS DOUBLE)) AS BIGINT)), 0) AS BIGINT) AS total_likes
FROM (SELECT user_id, CASE WHEN event_id % 11 = 0 THEN 'n/a' WHEN event_id % 11 = 1 THEN NULL
                           ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS likes FROM events)
GROUP BY user_id""",
    "assemble_lookup": f"WITH {LANDED.strip()}\nSELECT * FROM assembled",
    "tag_errors": f"""WITH {LANDED.strip()},{STATUS},
tagged AS (
  SELECT a.artist_query,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.channel_id_found
              WHEN s.status = 'quota' THEN 'Error: Quota Exceeded'
              WHEN s.status = 'http' THEN 'Error: HTTP ' || s.detail
              WHEN s.status = 'other' THEN 'Error: ' || s.detail END AS channel_id_found,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.channel_title_verified END AS channel_title_verified,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.subscriber_count END AS subscriber_count,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.view_count END AS view_count,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.video_count END AS video_count,
         CASE WHEN coalesce(s.status, 'ok') = 'ok' THEN a.total_top10_video_likes END AS total_top10_video_likes
  FROM assembled a LEFT JOIN status s ON a.artist_query = s.artist_query)
SELECT * FROM tagged""",
    "upsert_latest": """
WITH b AS (
  SELECT user_id, event_type, event_id, ts, value,
         CAST(CASE WHEN day(ts) <= 15 THEN 1 ELSE 2 END AS BIGINT) AS batch_id FROM events)
SELECT user_id, event_type, event_id, value, batch_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY batch_id DESC, ts DESC, event_id DESC) AS rn
  FROM b) WHERE rn = 1""",
    "dedup_rows": f"WITH {LINE_COPIES.strip()}\nSELECT DISTINCT * FROM li",
    "dup_counts": f"""WITH {LINE_COPIES.strip()},
g1 AS (SELECT count(*) AS n FROM li GROUP BY ALL_COLS),
g2 AS (SELECT count(*) AS n FROM li GROUP BY l_orderkey, l_linenumber)
SELECT 'all_columns' AS subset, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows,
       CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_in_shared_keys FROM g1
UNION ALL
SELECT 'l_orderkey,l_linenumber', CAST(sum(n) AS BIGINT), CAST(sum(n) - count(*) AS BIGINT),
       CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) FROM g2""".replace("ALL_COLS", LINE_COLS),
    "latest_per_key": """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""",
    "null_profile": f"""WITH {EVENTS_NULLS.strip()},
n AS (SELECT count(*) AS rows, count(*) - count(event_id) AS c0, count(*) - count(ts) AS c1,
             count(*) - count(user_id) AS c2, count(*) - count(event_type) AS c3, count(*) - count(value) AS c4,
             count(*) - count(props) AS c5 FROM ev),
l AS (SELECT 'event_id' AS "column", c0 AS null_count, rows FROM n UNION ALL SELECT 'ts', c1, rows FROM n
      UNION ALL SELECT 'user_id', c2, rows FROM n UNION ALL SELECT 'event_type', c3, rows FROM n
      UNION ALL SELECT 'value', c4, rows FROM n UNION ALL SELECT 'props', c5, rows FROM n)
SELECT "column", null_count, round(null_count / rows * 100.0, 4) AS null_pct FROM l WHERE null_count > 0""",
    "total_nulls": f"""WITH {EVENTS_NULLS.strip()}
SELECT CAST((count(*) - count(event_id)) + (count(*) - count(ts)) + (count(*) - count(user_id))
     + (count(*) - count(event_type)) + (count(*) - count(value)) + (count(*) - count(props)) AS BIGINT) AS total_nulls
FROM ev""",
    "column_profile": _column_profile_sql(),
    "column_samples": _column_samples_sql(),
    "describe_numeric": _describe_numeric_sql(),
    "describe_text": _describe_text_sql(),
    "value_counts": f"WITH {FLAGS}\nSELECT l_returnflag, count(*) AS count FROM flags GROUP BY l_returnflag",
    "value_counts_topk": """
SELECT p_name, count(*) AS count FROM part WHERE p_name IS NOT NULL GROUP BY p_name
ORDER BY count DESC, p_name LIMIT 15""",
    "category_total": f"""WITH {FLAGS}
SELECT CAST(count(DISTINCT l_returnflag) + max(CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END) AS BIGINT)
       AS n_categories FROM flags""",
    "topk_rows": "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
    "yearly_counts": f"WITH {YEARS}\nSELECT year, count(*) AS count FROM yrs WHERE year IS NOT NULL GROUP BY year",
    "yearly_unique": f"""WITH {YEARS}
SELECT year, count(DISTINCT o_custkey) AS n_customers FROM yrs WHERE year IS NOT NULL GROUP BY year""",
    "yearly_running": f"""WITH {YEARS},
c AS (SELECT year, count(*) AS count FROM yrs WHERE year IS NOT NULL GROUP BY year)
SELECT year, count, CAST(sum(count) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
       AS cumulative FROM c""",
    "quantiles": _quantiles_sql(),
    "quantile_cap": """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_extendedprice BETWEEN 0.0 AND (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem)""",
    "histogram": _histogram_sql("data AS (SELECT o_totalprice FROM orders)", "o_totalprice", "50"),
    "histogram_auto": _histogram_sql(
        f"{YEARS}, data AS (SELECT year FROM yrs)", "year",
        "GREATEST(CAST((count(DISTINCT year) + max(CASE WHEN year IS NULL THEN 1 ELSE 0 END)) // 2 AS BIGINT), 1)"),
    "density": DENSITY,
    "unit_percent": """
SELECT l_returnflag, n, n_discounted, n_taxed, round(n_discounted / n * 100.0, 4) AS pct_discounted,
       printf('%.2f%%', n_discounted / n * 100.0) AS pct_text, round(avg_price_k, 4) AS avg_price_k
FROM (SELECT l_returnflag, count(*) AS n, CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_discounted,
             avg(l_extendedprice / 1000) AS avg_price_k,
             CAST(sum(CASE WHEN l_tax <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_taxed
      FROM lineitem GROUP BY l_returnflag)""",
    "project_rename": "SELECT p_partkey, p_name AS track_name, p_brand AS artists FROM part",
    "load_check": """
SELECT 'channels_clean' AS target, count(*) AS rows_written, count(*) AS rows_stored, true AS ok FROM supplier""",
    "csv_roundtrip": CSV_PART,
    "table_shape": "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM lineitem",
    "quality_report": f"""WITH {RAW_CHANNELS.strip()}, clean AS ({CLEAN_CHANNELS_SELECT})
SELECT 'rows' AS item, CAST(NULL AS VARCHAR) AS "column", CAST(count(*) AS VARCHAR) AS value FROM clean
UNION ALL SELECT 'nulls', 'artist_query', CAST(count(*) - count(artist_query) AS VARCHAR) FROM clean
UNION ALL SELECT 'nulls', 'channel_id_found', CAST(count(*) - count(channel_id_found) AS VARCHAR) FROM clean
UNION ALL SELECT 'nulls', 'channel_title_verified', CAST(count(*) - count(channel_title_verified) AS VARCHAR) FROM clean
UNION ALL SELECT 'nulls', 'subscriber_count', CAST(count(*) - count(subscriber_count) AS VARCHAR) FROM clean
UNION ALL SELECT 'nulls', 'view_count', CAST(count(*) - count(view_count) AS VARCHAR) FROM clean
UNION ALL SELECT 'nulls', 'video_count', CAST(count(*) - count(video_count) AS VARCHAR) FROM clean
UNION ALL SELECT 'nulls', 'total_top10_video_likes', CAST(count(*) - count(total_top10_video_likes) AS VARCHAR) FROM clean
UNION ALL SELECT 'duplicate_rows', 'channel_id_found',
       CAST(count(*) - count(DISTINCT channel_id_found) AS VARCHAR) FROM clean
UNION ALL SELECT 'columns', NULL, '7'
UNION ALL SELECT 'dtype', 'artist_query', 'string' UNION ALL SELECT 'dtype', 'channel_id_found', 'string'
UNION ALL SELECT 'dtype', 'channel_title_verified', 'string' UNION ALL SELECT 'dtype', 'subscriber_count', 'bigint'
UNION ALL SELECT 'dtype', 'view_count', 'bigint' UNION ALL SELECT 'dtype', 'video_count', 'bigint'
UNION ALL SELECT 'dtype', 'total_top10_video_likes', 'bigint'""",
    "head_tail": """
(SELECT o_orderkey, o_custkey, o_totalprice, 'head' AS position FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL
(SELECT o_orderkey, o_custkey, o_totalprice, 'tail' AS position FROM orders ORDER BY o_orderkey DESC LIMIT 5)""",
    "incremental_lookup": INCREMENTAL,
    "merge_empty_awards": f"""WITH {TRACKS.strip()},{CHANNELS},{J1}
SELECT *, CAST(NULL AS INTEGER) AS grammy_year, '' AS grammy_category, false AS grammy_winner FROM j1""",
    "lookup_load": f"SELECT *, true AS ok FROM ({INCREMENTAL})",
    "raw_load_append": """
SELECT 'overwrite' AS step, count(*) AS rows_written, count(*) AS rows_stored, true AS ok FROM orders
UNION ALL SELECT 'append', count(*), 2 * count(*), true FROM orders""",
    "empty_input": "SELECT true AS raised, CAST(0 AS BIGINT) AS rows_written, CAST(0 AS BIGINT) AS rows_stored, true AS ok",
    "literal_join": """
WITH names(status, meaning) AS (VALUES ('F', 'finished'), ('O', 'open'), ('P', NULL), (NULL, 'none'))
SELECT status, meaning, n FROM names LEFT JOIN (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus)
  ON status = o_orderstatus""",
    "topk_categories": """
SELECT o_custkey, count, (SELECT count(DISTINCT o_custkey) FROM orders) AS n_categories
FROM (SELECT o_custkey, count(*) AS count FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey
      ORDER BY count DESC, o_custkey LIMIT 20)""",
    "category_counts": f"WITH {EVENTS_NULLS.strip()} SELECT event_type, count(*) AS count FROM ev GROUP BY event_type",
    "pipeline_run": f"""WITH {RAW_TRACKS.strip()},
t AS (SELECT {_trim("coalesce(track_id, '')")} AS track_id, {_trim("coalesce(artists, '')")} AS artists,
             {_trim("coalesce(album_name, '')")} AS album_name, {_trim("coalesce(track_name, '')")} AS track_name,
             popularity, {_trim("coalesce(track_genre, '')")} AS track_genre
      FROM (SELECT DISTINCT * FROM raw) WHERE artists IS NOT NULL AND album_name IS NOT NULL AND track_name IS NOT NULL),
c AS (SELECT p_brand AS artist_query, 'UC' || p_brand AS channel_id_found,
             CASE WHEN count(*) % 2 = 0 THEN 0 ELSE count(*) END AS subscriber_count,
             CAST(sum(p_partkey) + 9007199254740992 AS BIGINT) AS view_count
      FROM part WHERE p_brand NOT LIKE '%3' GROUP BY p_brand),
a AS (SELECT CAST(2000 + p_partkey % 20 AS INTEGER) AS year, 'Cat ' || CAST(p_partkey % 5 AS VARCHAR) AS category,
             p_name AS nominee, p_brand AS artist, p_partkey % 2 = 0 AS winner
      FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 15 <> 0
      UNION ALL
      SELECT CAST(2000 + (p_partkey + 7) % 20 AS INTEGER), 'Cat ' || CAST(p_partkey % 5 AS VARCHAR), p_name, p_brand, p_partkey % 2 = 0
      FROM part WHERE p_partkey % 9 = 0 AND p_partkey % 15 <> 0),
j AS (SELECT t.*, coalesce(c.channel_id_found, '') AS channel_id_found, coalesce(c.subscriber_count, 0) AS subscriber_count,
             coalesce(c.view_count, 0) AS view_count, a.year AS grammy_year, coalesce(a.category, '') AS grammy_category,
             coalesce(a.winner, false) AS grammy_winner
      FROM t LEFT JOIN c ON t.artists = c.artist_query
      LEFT JOIN a ON t.artists = a.artist AND t.track_name = {_trim("a.nominee")}),
r AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY grammy_year DESC NULLS LAST, grammy_category, grammy_winner DESC,
             track_genre, album_name, track_name, artists, popularity) AS rn FROM j)
SELECT track_id, artists, track_name, popularity, track_genre, channel_id_found, subscriber_count, view_count, grammy_year,
       grammy_category, grammy_winner, true AS ok FROM r WHERE rn = 1""",
}

# The same rows as another query's, made another way.
SQL |= {**SCALE, "incremental_store": SQL["incremental_lookup"], "dedup_by_digest": SQL["dedup_rows"]}
