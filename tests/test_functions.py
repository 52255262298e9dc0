"""Column helpers and small public building blocks."""

from pyspark.sql import functions as F

from trackmart.functions.columns import (error_tag, fill_map, is_match, is_quota_error, label, percent,
                                         percent_text, topic_query)
from trackmart.operators.relational import distinct_values, union_all
from trackmart.plans.enrich import channel_record_from_json
from trackmart.schemas import KEY_NAMES, VIDEO_STATS
from trackmart.sources.io import literal_table


def test_fill_map_only_present_columns(spark):
    df = spark.createDataFrame([(None, None)], "a string, b bigint")
    out = df.select(*[c.alias(n) for n, c in fill_map(df.columns, {"a": "", "b": 0, "zz": 1}).items()])
    assert tuple(out.first()) == ("", 0)


def test_text_helpers(spark):
    df = spark.createDataFrame([("Artist", 1, 3, 0), ("X", 2, 8, None)], "n string, p int, w int, z int")
    r = df.select(topic_query("n").alias("q"), percent("p", "w").alias("pct"),
                  percent_text(percent("p", "w")).alias("t"), is_match("z").alias("m"),
                  label(F.col("w") % 12, KEY_NAMES).alias("k")).collect()
    assert (r[0]["q"], r[0]["t"], r[0]["m"], r[0]["k"]) == ("Artist Topic", "33.33%", False, "D#")
    assert (r[1]["t"], r[1]["m"], r[1]["k"]) == ("25.00%", False, "G#")


def test_error_text(spark):
    df = spark.createDataFrame([("quota", "x"), ("http", "403"), ("other", "KeyError"), ("ok", None)],
                               "status string, detail string")
    got = [r[0] for r in df.select(error_tag("status", "detail")).collect()]
    assert got == ["Error: Quota Exceeded", "Error: HTTP 403", "Error: KeyError", None]
    msg = spark.createDataFrame([("<HttpError 403 ... quotaExceeded>",), ("boom",)], "m string")
    assert [r[0] for r in msg.select(is_quota_error("m")).collect()] == [True, False]


def test_stats_record_from_json(spark):
    df = spark.createDataFrame([
        ("c1", "T", '{"subscriberCount": "12", "viewCount": "7", "videoCount": "x"}'),
        ("c2", "U", '{"hiddenSubscriberCount": true, "subscriberCount": "5", "viewCount": "19400.0"}')],
        "channel_id string, title string, statistics string")
    got = {r["channel_id"]: (r["subscriber_count"], r["view_count"], r["video_count"])
           for r in channel_record_from_json(df).collect()}
    assert got == {"c1": (12, 7, 0), "c2": (-1, 19400, 0)}


def test_union_distinct_and_literal_table(spark):
    a = literal_table(spark, [("v1", "3")], VIDEO_STATS)
    b = spark.createDataFrame([("v2",)], "video_id string")
    u = union_all(a, b)
    assert u.count() == 2 and u.filter("video_id = 'v2'").first()["likeCount"] is None
    assert sorted(r[0] for r in distinct_values(union_all(a, a, b), "video_id", "v").collect()) == ["v1", "v2"]
