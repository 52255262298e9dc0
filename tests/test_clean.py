"""Semantics ledger cases (cleaning, casts, trimming, NA tokens) and
channel-table fixture rows."""

from pyspark.sql import functions as F

from trackmart.functions.columns import coerce_long, coerce_timestamp, py_strip
from trackmart.plans.clean import clean_awards, clean_channels, clean_tracks, coercion_report
from trackmart.schemas import AWARDS_RAW, CHANNELS_RAW, PY_WS
from trackmart.sources.io import read_csv

CHANNEL_CSV = '''artist_query,channel_id_found,channel_title_verified,subscriber_count,view_count,video_count,total_top10_video_likes
Blauhorn,UCinvented0001,"Blauhorn - Waltz, Écoute, and Noise",120.0,55001.0,12.0,340.0
Trio Nordlicht;Guests of the Harbour Choir,,,,,,
Velvet Kite;Juno Marsh;Okto,UCinvented0002,Velvet Kite - Topic,900.0,3000000017.0,77.0,81.0
Paper Lanterns,UCinvented0003,Paper Lanterns - Topic,0.0,0.0,0.0,0.0
Velvet Kite;LUMEN,UCinvented0002,Velvet Kite - Topic,900.0,3000000017.0,77.0,83.0
山本花;海野空,UCinvented0004,夜空工房,5.0,610.0,3.0,0.0
"""Tin Robots"" Band",Error: Quota Exceeded,,,,,
'''


def test_strip_set_is_pythons(spark):
    assert len(PY_WS) == 29 and "\x1c" in PY_WS and " " in PY_WS and "　" in PY_WS
    vals = ["\t a ", "　b\x1c", "c", None, "​d"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(py_strip("s")).collect()]
    assert got == [None if v is None else v.strip() for v in vals]  # U+200B is not whitespace


def test_tolerant_numeric_coercion(spark):
    df = spark.createDataFrame([("12",), ("19400.0",), ("x",), (None,), ("-1",), ("1.9",)], "s string")
    assert [r[0] for r in df.select(coerce_long("s")).collect()] == [12, 19400, None, None, -1, 1]


def test_timestamp_coercion_to_utc(spark):
    df = spark.createDataFrame([("2020-01-01T10:00:00+05:00",), ("2020-01-02",), ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(F.unix_timestamp(coerce_timestamp("s"))).collect()]
    assert got == [1577854800, 1577923200, None, None]


def test_csv_reader_na_tokens_quotes_and_index(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text(',name,n\n0,NA,1\n1,None,2\n2, N/A,3\n3,None ,4\n4,"say ""hi"", ok",5\n5,,6\n6,NaN,x\n',
                 encoding="utf-8")
    df = read_csv(spark, str(p), None)
    assert df.columns == ["name", "n"]
    names = [r[0] for r in df.collect()]
    assert names == [None, None, " N/A", "None ", 'say "hi", ok', None, None]
    from pyspark.sql import types as T
    typed = read_csv(spark, str(p), T.StructType([T.StructField("name", T.StringType()),
                                                    T.StructField("n", T.LongType())]))
    assert [r[1] for r in typed.collect()] == [1, 2, 3, 4, 5, 6, None]


def test_clean_tracks_dedups_before_trim(spark):
    rows = [("t1", "A", "al", "x"), ("t1", "A", "al", "x"), ("t1", "A", "al", "x "),
            ("t2", None, "al", "y"), ("", " B ", "al", "\tz")]
    df = spark.createDataFrame(rows, "track_id string, artists string, album_name string, track_name string")
    got = sorted(tuple(r) for r in clean_tracks(df).collect())
    assert got == [("", "B", "al", "z"), ("t1", "A", "al", "x"), ("t1", "A", "al", "x")]


def test_clean_awards(spark):
    rows = [(2020, " T ", "2020-01-01T00:00:00+00:00", "bad", " c ", " n ", None, None, None, True),
            (2021, None, None, None, None, None, "a", "w", "i", False)]
    out = clean_awards(spark.createDataFrame(rows, AWARDS_RAW)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["title"], r["category"], r["nominee"], r["artist"], r["workers"], r["img"]) == \
        ("T", "c", "n", "No Especificado", "No Especificado", "Sin URL")
    assert r["updated_at"] is None and r["published_at"] is not None
    rep = coercion_report(spark.createDataFrame(rows, AWARDS_RAW)).first()
    assert rep["updated_at_coerced"] == 1 and rep["published_at_coerced"] == 0 and rep["rows_missing_required"] == 1


def test_clean_channels_fixture_rows(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text(CHANNEL_CSV, encoding="utf-8")
    raw = read_csv(spark, str(p), CHANNELS_RAW)
    assert raw.filter(F.col("channel_id_found").isNull()).count() == 1
    clean = {r["artist_query"]: r for r in clean_channels(raw).collect()}
    assert len(clean) == 7
    assert clean['"Tin Robots" Band']["channel_id_found"] == "Error: Quota Exceeded"
    assert clean['"Tin Robots" Band']["subscriber_count"] == 0
    assert clean["Blauhorn"]["channel_title_verified"] == "Blauhorn - Waltz, Écoute, and Noise"
    assert clean["Velvet Kite;Juno Marsh;Okto"]["view_count"] == 3000000017
    assert clean["Trio Nordlicht;Guests of the Harbour Choir"]["channel_id_found"] == ""
    assert clean["山本花;海野空"]["channel_title_verified"] == "夜空工房"


def test_hidden_subscribers_become_zero(spark):
    df = spark.createDataFrame([("a", -1.0), ("b", None), ("c", 5.7)], "artist_query string, subscriber_count double")
    got = {r[0]: r[1] for r in clean_channels(df).collect()}
    assert got == {"a": 0, "b": 0, "c": 5}


def test_csv_multiline_quoted_values(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('name,n\n"two\nlines",1\nplain,2\n', encoding="utf-8")
    rows = read_csv(spark, str(p), None, multiline=True).collect()
    assert [tuple(r) for r in rows] == [("two\nlines", "1"), ("plain", "2")]


def test_whole_counts_stay_exact(spark):
    df = spark.createDataFrame([("9007199254740993",), ("-9007199254740995",), ("1e3",)], "s string")
    assert [r[0] for r in df.select(coerce_long("s")).collect()] == [9007199254740993, -9007199254740995, 1000]
