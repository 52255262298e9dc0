"""Aggregates answered by a database and by Parquet footers."""

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from trackmart.plans.enrich import artist_universe
from trackmart.sources.pushdown import distinct_in_database, footer_stats, read_database

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _database(spark):
    """A database in this process's memory with two small tables."""
    url = f"jdbc:derby:memory:tm{uuid.uuid4().hex[:8]};create=true"
    spark._jvm.java.lang.Class.forName(DERBY)
    con = spark._jvm.java.sql.DriverManager.getConnection(url)
    run = con.createStatement().executeUpdate
    run("CREATE TABLE AWARDS (ARTIST VARCHAR(80), N BIGINT)")
    run("CREATE TABLE TRACKS (ARTISTS VARCHAR(80))")
    for k, name in enumerate(["'Ann'", "'Ann'", "'Bob'", "NULL", "'No Especificado'", "' Ann '"]):
        run(f"INSERT INTO AWARDS VALUES ({name}, {k})")
    for name in ("'Bob'", "'Cyd'", "NULL", "'Cyd'"):
        run(f"INSERT INTO TRACKS VALUES ({name})")
    return url, con


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_filter_and_counts_run_in_the_database(spark):
    url, con = _database(spark)
    awards = read_database(spark, url, "APP.AWARDS", {"driver": DERBY})
    names = awards.where("ARTIST IS NOT NULL AND ARTIST <> 'No Especificado'").select(F.col("ARTIST").alias("artist_name")).distinct()
    assert "PushedGroupByExpressions: [ARTIST]" in _plan(names) and "HashAggregate" not in _plan(names)
    assert sorted(r[0] for r in names.collect()) == [" Ann ", "Ann", "Bob"]
    total = awards.agg(F.count("*").alias("n"), F.max("N").alias("m"))
    assert "PushedAggregates: [COUNT(*), MAX(N)]" in _plan(total) and tuple(total.first()) == (6, 5)
    of = lambda table, column, exclude=(): distinct_in_database(spark, url, table, column, "artist_name", exclude, {"driver": DERBY})
    assert sorted(r[0] for r in of("APP.AWARDS", "ARTIST", ["No Especificado", "it's"]).collect()) == [" Ann ", "Ann", "Bob"]
    universe = artist_universe(of("APP.TRACKS", "ARTISTS"), of("APP.AWARDS", "ARTIST"))
    assert universe._jdf.queryExecution().optimizedPlan().toString().count("SELECT DISTINCT") == 2
    assert sorted(r[0] for r in universe.collect()) == ["Ann", "Bob", "Cyd"]
    with pytest.raises(ValueError, match="plain name"):
        of("APP.AWARDS", "ARTIST FROM X; --")
    con.close()


def test_footers_answer_what_they_can(spark):
    report: dict = {}
    got = {r["column"]: r for r in footer_stats(spark, f"{SF01}/lineitem.parquet", report=report).collect()}
    assert report["footers"]
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    want = li.agg(F.count("*"), F.min("l_extendedprice"), F.max("l_extendedprice"), F.min("l_returnflag"), F.max("l_returnflag"),
                  F.date_format(F.max("l_shipdate"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()
    price, flag = got["l_extendedprice"], got["l_returnflag"]
    assert (price["rows"], price["min_num"], price["max_num"], flag["min_text"], flag["max_text"], got["l_shipdate"]["max_text"]) == tuple(want)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def test_files_without_statistics_are_scanned(spark, tmp_path):
    table = pa.table({"a": [3, None, 1], "x": [1.5, float("nan"), None], "t": ["b", None, "a"], "b": [True, None, False], "l": [[1], None, []]})
    want = {"a": (3, 1, 1.0, 3.0, None, None), "x": (3, 2, 1.5, 1.5, None, None), "t": (3, 1, None, None, "a", "b"),
            "b": (3, 1, None, None, "false", "true"), "l": (3, 1, None, None, None, None)}
    pq.write_table(table, str(tmp_path / "none.parquet"), write_statistics=False)
    report: dict = {}
    got = {r[0]: tuple(r)[1:] for r in footer_stats(spark, str(tmp_path / "none.parquet"), report=report).collect()}
    assert got == want and not report["footers"]
    pq.write_table(table.drop_columns(["x"]), str(tmp_path / "some.parquet"))
    got = {r[0]: tuple(r)[1:] for r in footer_stats(spark, str(tmp_path / "some.parquet"), ["a", "t", "b"], report).collect()}
    assert got == {c: want[c] for c in ("a", "t", "b")} and report["footers"]
    pq.write_table(table.slice(0, 0), str(tmp_path / "empty.parquet"))
    assert {r["rows"] for r in footer_stats(spark, str(tmp_path / "empty.parquet")).collect()} == {0}
