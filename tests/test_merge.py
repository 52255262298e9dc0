"""Golden G-merge (fixtures of the reference's in-file smoke run) and the
degraded paths of the merge."""

from pyspark.sql import functions as F

from trackmart.plans.merge import merge_all, merge_report

TRACKS = [("t1", "Artist A", "Song Alpha", 80), ("t2", "Artist B", "Song Beta", 70),
          ("t3", "Artist C;Artist D", "Song Gamma", 60), ("t4", "Artist A", "Song Other", 75),
          ("t5", "Artist E", "Song Delta", 50)]
AWARDS = [("Artist A", "Song Alpha", 2020, "Best Song", True),
          ("Artist C;Artist D", "Song Gamma", 2021, "Best Collab", False),
          ("Artist A", "Song Alpha", 2022, "Record Of Year", False),
          ("Artist Z", "Some Song", 2021, "Best New", False)]
CHANNELS = [("Artist A", "chA", "Artist A Verified", 1000, 100000, 10, 5000),
            ("Artist B", "chB", "Artist B Channel", 500, 20000, 5, 1000),
            ("Artist C;Artist D", "chCD", "C and D Music", 2000, 50000, 20, 3000),
            ("Artist E", "chE", "Artist E Official", 1500, 120000, 15, 6000)]


def frames(spark):
    t = spark.createDataFrame(TRACKS, "track_id string, artists string, track_name string, popularity int")
    a = spark.createDataFrame(AWARDS, "artist string, nominee string, year int, category string, winner boolean")
    c = spark.createDataFrame(CHANNELS, "artist_query string, channel_id_found string, "
                              "channel_title_verified string, subscriber_count bigint, view_count bigint, "
                              "video_count bigint, total_top10_video_likes bigint")
    return t, a, c


def test_golden_merge(spark):
    t, a, c = frames(spark)
    out = merge_all(tracks=t, awards=a, channels=c)
    rows = sorted(tuple(r) for r in out.select("track_id", "channel_id_found", "subscriber_count",
                                                "grammy_year", "grammy_category", "grammy_winner").collect())
    assert rows == [("t1", "chA", 1000, 2022, "Record Of Year", False),
                    ("t2", "chB", 500, None, "", False),
                    ("t3", "chCD", 2000, 2021, "Best Collab", False),
                    ("t4", "chA", 1000, None, "", False),
                    ("t5", "chE", 1500, None, "", False)]
    assert "artist_query" not in out.columns and "grammy_artist" not in out.columns


def test_match_report(spark):
    t, a, c = frames(spark)
    rep = {r["join"]: (r["matched_rows"], r["total_rows"]) for r in merge_report(tracks=t, awards=a, channels=c).collect()}
    assert rep == {"channels": (5, 5), "awards": (3, 6), "shared_track_id": (2, 6)}  # t1 has two nominations


def test_awards_without_rows_keep_every_track_row(spark):
    t, a, c = frames(spark)
    out = merge_all(tracks=t.unionByName(t.filter("track_id = 't1'")), awards=a.limit(0), channels=c)
    assert out.count() == 6 and out.filter("grammy_year IS NULL AND grammy_category = ''").count() == 6


def test_degraded_paths(spark):
    t, a, c = frames(spark)
    no_awards = merge_all(tracks=t, channels=c)
    assert no_awards.count() == 5
    r = no_awards.filter("track_id = 't1'").first()
    assert r["grammy_year"] is None and r["grammy_category"] == "" and r["grammy_winner"] is False
    no_channels = merge_all(tracks=t, awards=a)
    r = no_channels.filter("track_id = 't3'").first()
    assert r["channel_id_found"] == "" and r["subscriber_count"] == 0 and r["grammy_year"] == 2021


def test_swapped_inputs_take_degraded_path(spark):
    # G-swap: channels passed as tracks, tracks as awards, awards as channels
    t, a, c = frames(spark)
    out = merge_all(tracks=c, awards=t, channels=a)
    assert out.count() == 4
    assert set(out.columns) >= {"grammy_year", "grammy_category", "grammy_winner"}
    r = out.first()
    assert r["grammy_category"] == "" and r["grammy_winner"] is False


def test_genre_copies_collapse_to_one_row(spark):
    t = spark.createDataFrame([("x", "A", "S", "pop", "al"), ("x", "A", "S", "rock", "al")],
                              "track_id string, artists string, track_name string, track_genre string, album_name string")
    a = spark.createDataFrame([("A", "S", 2001, "c", True)],
                              "artist string, nominee string, year int, category string, winner boolean")
    out = merge_all(tracks=t, awards=a, channels=None)
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["track_genre"] == "pop" and rows[0]["grammy_year"] == 2001


def test_plan_has_partial_group_limit(spark):
    t, a, c = frames(spark)
    plan = merge_all(tracks=t, awards=a, channels=c)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_match_report_counts_rows_with_a_year(spark):
    t, a, c = frames(spark)
    a2 = a.unionByName(spark.createDataFrame([("Artist B", "Song Beta", None, "x", True)], a.schema))
    rep = {r["join"]: (r["matched_rows"], r["total_rows"]) for r in merge_report(tracks=t, awards=a2, channels=c).collect()}
    assert rep["awards"] == (3, 6)  # t2 joins a nomination without a year: a row, not a match
