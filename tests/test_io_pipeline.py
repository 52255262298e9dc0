"""Sources, sinks, the end-to-end run, the checkpoint log and the
incremental lookup (batch and Structured Streaming drivers)."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from trackmart.plans.pipeline import RunConfig, Source, build, report, run
from trackmart.schemas import AWARDS_RAW, CHANNELS, LOOKUP_STATUS, MERGED
from trackmart.sources.io import BatchLog, EmptyInput, read_jdbc, write_table
from trackmart.schemas import CHECKPOINT

TRACK_HEADER = ",track_id,artists,album_name,track_name,popularity,duration_ms,explicit,danceability,energy,key," \
               "loudness,mode,speechiness,acousticness,instrumentalness,liveness,valence,tempo,time_signature,track_genre"


def _track_row(i, tid, artists, name, genre):
    return f'{i},{tid},"{artists}",Album {tid},"{name}",50,200000,False,0.5,0.6,5,-6.0,1,0.05,0.1,0.0,0.1,0.5,120.0,4,{genre}'


@pytest.fixture()
def inputs(spark, tmp_path):
    tracks = tmp_path / "tracks.csv"
    tracks.write_text("\n".join([TRACK_HEADER,
                                 _track_row(0, "t1", "Artist A", "Song Alpha", "pop"),
                                 _track_row(1, "t1", "Artist A", "Song Alpha", "rock"),
                                 _track_row(2, "t2", "Artist B", "Song Beta", "pop"),
                                 _track_row(3, "t3", "Artist C;Artist D", "Song Gamma", "pop"),
                                 _track_row(4, "t3", "Artist C;Artist D", "Song Gamma", "pop"),
                                 _track_row(5, "t4", "NA", "Song X", "pop")]) + "\n", encoding="utf-8")
    awards = spark.createDataFrame([
        (2020, "t", "2020-01-01", None, "Best Song", "Song Alpha", "Artist A", None, None, True),
        (2022, "t", "2022-01-01", None, "Record Of Year", "Song Alpha", "Artist A", None, None, False),
        (2021, "t", "2021-01-01", None, "Best Collab", "Song Gamma", "Artist C;Artist D", None, None, False)],
        AWARDS_RAW)
    apath = str(tmp_path / "awards")
    awards.write.parquet(apath)
    channels = tmp_path / "channels.csv"
    channels.write_text("artist_query,channel_id_found,channel_title_verified,subscriber_count,view_count,"
                        "video_count,total_top10_video_likes\nArtist A,chA,A,-1,10.0,2.0,3.0\n"
                        "Artist B,chB,B,5.0,,1.0,\n", encoding="utf-8")
    return RunConfig(tracks=Source(str(tracks), "csv"), awards=Source(apath, "parquet"),
                     channels=Source(str(channels), "csv"), output=str(tmp_path / f"out-{uuid.uuid4().hex}"),
                     strict_count=True)


def test_end_to_end_run(spark, inputs):
    merged = build(spark, inputs)
    assert [(f.name, f.dataType) for f in merged.schema] == [(f.name, f.dataType) for f in MERGED]
    rows = {r["track_id"]: r for r in merged.collect()}
    assert set(rows) == {"t1", "t2", "t3"}  # t4 has no artist ("NA" token) and is dropped
    assert rows["t1"]["grammy_year"] == 2022 and rows["t1"]["track_genre"] == "pop"
    assert rows["t1"]["subscriber_count"] == 0 and rows["t1"]["view_count"] == 10  # hidden -> 0
    assert rows["t2"]["subscriber_count"] == 5 and rows["t2"]["total_top10_video_likes"] == 0
    assert rows["t3"]["channel_id_found"] == "" and rows["t3"]["grammy_category"] == "Best Collab"
    check = run(spark, inputs).first()
    assert (check["rows_written"], check["rows_stored"], check["ok"]) == (3, 3, True)
    rep = {r["join"]: (r["matched_rows"], r["total_rows"]) for r in report(spark, inputs).collect()}
    assert rep["awards"] == (5, 6)  # t1 in two genres x two nominations, t3 once; t2 unmatched


def test_empty_input_raises(spark, tmp_path):
    empty = spark.createDataFrame([], CHANNELS)
    with pytest.raises(EmptyInput):
        write_table(empty, str(tmp_path / "x"), schema=CHANNELS)
    ok = write_table(empty, str(tmp_path / "y"), schema=CHANNELS, allow_empty=True).first()
    assert ok["rows_written"] == 0 and ok["ok"]


def test_jdbc_round_trip_embedded_derby(spark):
    url = f"jdbc:derby:memory:tm{uuid.uuid4().hex[:8]};create=true"
    props = {"url": url, "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "artist string, n bigint")
    check = write_table(df, "ARTISTS", jdbc=props, strict=True).first()
    assert check["rows_written"] == 3 and check["rows_stored"] == 3
    back = read_jdbc(spark, url, table="ARTISTS", properties={"driver": props["driver"]})
    # the filter and the projection are pushed into the database query
    q = back.filter(F.col("N") > 1).select("ARTIST")
    assert sorted(r[0] for r in q.collect()) == ["b", "c"]


def test_batch_log_is_idempotent_per_batch(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "ckpt"), CHECKPOINT, ["artist_query"])
    assert log.read_all().count() == 0
    row = lambda a, c: (a, c, None, None, None, None, None)
    b1 = spark.createDataFrame([row("a", "x"), row("b", "y")], "artist_query string, channel_id_found string, "
                               "channel_title_verified string, subscriber_count double, view_count double, "
                               "video_count double, total_top10_video_likes double")
    log.write_batch(b1, 1)
    log.write_batch(b1, 1)  # re-run of the same batch replaces it
    b2 = spark.createDataFrame([row("a", "z")], b1.schema)
    log.write_batch(b2, 2)
    assert log.read_all().count() == 3
    latest = {r["artist_query"]: (r["channel_id_found"], r["batch_id"]) for r in log.read_latest().collect()}
    assert latest == {"a": ("z", 2), "b": ("y", 1)}


def test_incremental_lookup_stream_takes_artists_as_their_answers_land(spark, tmp_path):
    from trackmart.schemas import CHANNEL_SEARCH, CHANNEL_STATS, VIDEO_STATS, VIDEOS
    from trackmart.streaming.incremental import LandedPaths, checkpoint_log, current_results, start_landed_stream
    at = {n: str(tmp_path / n) for n in ("search", "stats", "videos", "video_stats", "universe", "status")}
    spark.createDataFrame([("A",), ("B",), ("C",)], "artist_query string").write.parquet(at["universe"])
    spark.createDataFrame([("A", 1, "UCa", "A")], CHANNEL_SEARCH).write.parquet(at["search"])
    spark.createDataFrame([("UCa", "A", "5", "6", "7", False)], CHANNEL_STATS).write.parquet(at["stats"])
    spark.createDataFrame([], VIDEOS).write.parquet(at["videos"])
    spark.createDataFrame([], VIDEO_STATS).write.parquet(at["video_stats"])
    spark.createDataFrame([("A", 1, "ok", None)], LOOKUP_STATUS).write.parquet(at["status"])
    log = checkpoint_log(spark, str(tmp_path / "lookups"))
    paths = LandedPaths(*[at[n] for n in ("search", "stats", "videos", "video_stats", "universe")])

    def run():
        start_landed_stream(spark, at["status"], paths, log, str(tmp_path / "stream-ckpt")).awaitTermination(300)
        return {r["artist_query"]: (r["channel_id_found"], r["subscriber_count"]) for r in current_results(log).collect()}

    assert run() == {"A": ("UCa", 5)}  # nothing landed for B and C: they stay pending
    assert run() == {"A": ("UCa", 5)}  # no new file, no new batch
    spark.createDataFrame([("B Topic", 1, "UCb", "B")], CHANNEL_SEARCH).write.mode("append").parquet(at["search"])
    spark.createDataFrame([("UCb", "B", "8", "9", "1", False)], CHANNEL_STATS).write.mode("append").parquet(at["stats"])
    spark.createDataFrame([("B", 2, "ok", None), ("C", 2, "http", "500"), ("C", 2, "http", "500")],
                          LOOKUP_STATUS).write.mode("append").parquet(at["status"])
    assert run() == {"A": ("UCa", 5), "B": ("UCb", 8), "C": ("Error: HTTP 500", 0)}


def test_batch_without_status_takes_artists_with_a_search_answer(spark, tmp_path):
    from trackmart.schemas import CHANNEL_SEARCH, CHANNEL_STATS, VIDEO_STATS, VIDEOS
    from trackmart.streaming.incremental import LandedResponses, checkpoint_log, run_batch
    universe = spark.createDataFrame([("A",), ("B",), ("C",)], "artist_query string")
    landed = LandedResponses(spark.createDataFrame([("A", 1, "x", "A"), ("B Topic", 1, "y", "B")], CHANNEL_SEARCH),
                             spark.createDataFrame([], CHANNEL_STATS), spark.createDataFrame([], VIDEOS),
                             spark.createDataFrame([], VIDEO_STATS))
    got = run_batch(universe, checkpoint_log(spark, str(tmp_path / "l")), landed, 1)
    assert {r["artist_query"]: r["channel_id_found"] for r in got.collect()} == {"A": "x", "B": "y"}


def test_raw_load_and_clean_load(spark, inputs, tmp_path):
    from trackmart.plans.pipeline import clean_and_load, load_raw
    raw = load_raw(spark, inputs.tracks, str(tmp_path / "raw_tracks")).first()
    assert raw["rows_written"] == 6 and raw["ok"]
    again = load_raw(spark, inputs.tracks, str(tmp_path / "raw_tracks"), mode="append").first()
    assert again["rows_stored"] == 12 and again["ok"]
    clean = clean_and_load(spark, "tracks", inputs.tracks, str(tmp_path / "clean_tracks")).first()
    assert clean["rows_written"] == 4  # one exact duplicate and one row without artist removed
    ch = clean_and_load(spark, "channels", inputs.channels, str(tmp_path / "clean_channels")).first()
    assert ch["rows_written"] == 2


def test_rerun_of_a_batch_is_idempotent(spark, tmp_path):
    from conftest import SF001
    from trackmart.plans import star_inputs as I
    from trackmart.streaming.incremental import LandedResponses, checkpoint_log, current_results, run_batch
    landed = LandedResponses(I.customer_channel_search(spark, SF001), I.user_channel_stats(spark, SF001),
                             I.event_videos(spark, SF001), I.event_video_stats(spark, SF001))
    universe = I.customer_artists(spark, SF001)
    status = I.customer_lookup_status(spark, SF001)
    log = checkpoint_log(spark, str(tmp_path / "lookups"))
    run_batch(universe, log, landed, 1, status)
    first = sorted(tuple(r) for r in log.read_all().collect())
    run_batch(universe, log, landed, 1, status)  # the same batch again (e.g. after a failure)
    assert sorted(tuple(r) for r in log.read_all().collect()) == first
    assert len(first) == status.filter("batch_id = 1").select("artist_query").distinct().count() < universe.count()
    run_batch(universe, log, landed, 2, status)
    assert current_results(log).count() == universe.count()


def test_failure_tagging_keeps_fields_filled_before_the_failing_call(spark):
    from trackmart.plans.enrich import tag_failures
    from trackmart.schemas import LOOKUP_STATUS_STEP
    res = spark.createDataFrame(
        [(a, f"ch{a}", f"T{a}", 1, 2, 3, 4) for a in ["a", "b", "c", "d"]],
        "artist_query string, channel_id_found string, channel_title_verified string, subscriber_count bigint, "
        "view_count bigint, video_count bigint, total_top10_video_likes bigint")
    st = spark.createDataFrame([("a", 1, "http", "500", "search"), ("b", 1, "other", "KeyError", "stats"),
                                ("c", 1, "http", "503", "videos")], LOOKUP_STATUS_STEP)
    got = {r["artist_query"]: tuple(r)[1:] for r in tag_failures(res, st).collect()}
    assert got["a"] == ("Error: HTTP 500", None, None, None, None, None)
    assert got["b"] == ("chb", None, None, None, None, None)
    assert got["c"] == ("chc", "Tc", 1, 2, 3, None)
    assert got["d"] == ("chd", "Td", 1, 2, 3, 4)


def test_status_counts_once_per_artist_and_batch(spark):
    from trackmart.plans.enrich import tag_failures
    res = spark.createDataFrame([(a, f"ch{a}", None, None, None, None, None) for a in "ab"], CHANNELS)
    st = spark.createDataFrame([("a", 1, "quota", "q"), ("a", 2, "ok", None), ("a", 2, "ok", None), ("b", 2, "http", "1")], LOOKUP_STATUS)
    got = sorted((r["artist_query"], r["channel_id_found"]) for r in tag_failures(res, st, batch_id=2).collect())
    assert got == [("a", "cha"), ("b", "Error: HTTP 1")]


def test_empty_rerun_clears_its_batch_and_damage_raises(spark, tmp_path):
    root = tmp_path / "ck"
    log = BatchLog(spark, str(root), CHECKPOINT, ["artist_query"])
    rows = spark.createDataFrame([("a", "1", None, 2**53 + 1, None, None, None)], CHANNELS)
    log.write_batch(rows, 1)
    log.write_batch(rows, 2)
    log.write_batch(rows.limit(0), 2)
    assert [(r["batch_id"], r["subscriber_count"]) for r in log.read_all().collect()] == [(1, 2**53 + 1)]
    for part in (root / "batch_id=1").glob("part-*.parquet"):
        part.write_bytes(b"damaged")
    with pytest.raises(Exception, match="(?i)parquet|corrupt|footer"):
        log.read_all().collect()


def test_read_or_empty_only_for_missing_paths(spark, tmp_path):
    from trackmart.sources.io import read_or_empty
    assert read_or_empty(spark, str(tmp_path / "none"), CHANNELS).count() == 0
    (tmp_path / "bad.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path / "bad.parquet"), CHANNELS).count()


def test_append_counts_exactly(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "x bigint")
    first = write_table(df, str(tmp_path / "t"), mode="append", strict=True).first()
    again = write_table(df.limit(1), str(tmp_path / "t"), mode="append", strict=True).first()
    assert (first["rows_stored"], again["rows_written"], again["rows_stored"], again["ok"]) == (2, 1, 3, True)


def test_shared_folder_rule(spark, monkeypatch):
    import trackmart.session as session

    class Conf:
        def __init__(self, value): self.value = value
        def get(self, *_): return self.value
        def set(self, *_): raise AssertionError("no folder may be set")

    class Context:
        master, applicationId = "spark://host:7077", "app-1"
        def getCheckpointDir(self): return None

    class Session:
        sparkContext = Context()
        def __init__(self, value): self.conf = Conf(value)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session(None))
    assert session.scratch_path(Session("viewfs://store/shared/"), "x").startswith("viewfs://store/shared/trackmart-app-1/x-")


def test_catalog_table_load(spark):
    from trackmart.sources.io import create_database, read_table
    db = f"tm_{uuid.uuid4().hex[:8]}"
    create_database(spark, db)
    df = spark.createDataFrame([("a", 1), ("b", 2)], "artist string, n bigint")
    check = write_table(df, f"{db}.artists", fmt="table", strict=True).first()
    assert (check["rows_written"], check["rows_stored"], check["ok"]) == (2, 2, True)
    assert read_table(spark, f"{db}.artists").count() == 2


def test_two_tier_lookup_prefers_topic_and_never_fans_out(spark):
    from trackmart.plans.enrich import two_tier_lookup
    names = spark.createDataFrame([("A",), ("B",), ("C",)], "artist_query string")
    search = spark.createDataFrame([("A Topic", 1, "t1", "A - Topic"), ("A", 1, "p1", "A"),
                                    ("B", 1, "p2", "B"), ("B", 1, "p0", "B dup"), ("B Topic", 2, "x", "late")],
                                   "query string, rank int, channel_id string, title string")
    got = {r["artist_query"]: (r["channel_id"], r["matched_via"]) for r in two_tier_lookup(names, search).collect()}
    assert got == {"A": ("t1", "topic"), "B": ("p0", "plain"), "C": (None, None)}


def test_replayed_landings_do_not_double_count(spark):
    from trackmart.plans.enrich import top_video_likes
    videos = spark.createDataFrame([("c", "v1", "10", 5, True), ("c", "v2", "10", 4, True)],
                                   "channel_id string, video_id string, category_id string, view_count bigint, "
                                   "category_supported boolean")
    stats = spark.createDataFrame([("v1", "7"), ("v1", "7"), ("v2", "x")], "video_id string, likeCount string")
    assert top_video_likes(videos, stats).first()["total_top10_video_likes"] == 7


def test_command_line_run(spark, inputs, capsys):
    import json as _json
    from trackmart.__main__ import main
    code = main(["run", "--tracks", f"csv:{inputs.tracks.location}", "--awards", f"parquet:{inputs.awards.location}",
                 "--channels", f"csv:{inputs.channels.location}", "--output", inputs.output + "-cli", "--strict"])
    row = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and row["rows_written"] == 3 and row["ok"] is True
