"""The compacted store, atomic publish and staged loads: what is visible when
a step fails, is repeated, or meets another writer."""

import os
import random
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.sources.io import BatchLog, EmptyInput, create_database, write_table
from trackmart.sources.keyed_store import KeyedStore
from trackmart.sources.manifest import CommitConflict, Manifest
from trackmart.sources.publish import PublishedTable

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("j", T.LongType()), T.StructField("v", T.LongType()), T.StructField("batch_id", T.LongType())])
ROWS = "k string, j bigint, v bigint"


def _batch(spark, rng, n=40):
    rows = {(rng.choice(["a", "b", None, "c"]), rng.randrange(30)): rng.randrange(1000) for _ in range(n)}
    return spark.createDataFrame([(k, j, v) for (k, j), v in rows.items()], ROWS)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _buckets(df):
    return {int(m[1]) for f in df.inputFiles() if (m := re.search(r"bucket=(\d+)", f))}


def test_store_equals_the_batch_log(spark, tmp_path):
    rng = random.Random(4)
    store = KeyedStore(spark, str(tmp_path / "store"), SCHEMA, ["k", "j"], buckets=8)
    log = BatchLog(spark, str(tmp_path / "log"), SCHEMA, ["k", "j"])
    assert store.read_latest().collect() == [] and store.compact() == 0
    batches = {}
    for b in range(1, 8):
        batches[b] = _batch(spark, rng)
        for target in (store, log):
            target.write_batch(batches[b], b)
        if b in (3, 6):
            assert store.compact(2) == 8
    assert _rows(store.read_latest()) == _rows(log.read_latest())
    assert not store.write_batch(batches[1].limit(1), 6)  # sealed
    assert store.write_batch(batches[2], 7) and log.write_batch(batches[2], 7) is None  # not sealed: replaced
    assert _rows(store.read_latest()) == _rows(log.read_latest())
    assert store.write_batch(batches[2].limit(0), 7)
    log.write_batch(batches[2].limit(0), 7)
    assert _rows(store.read_latest()) == _rows(log.read_latest())
    again = KeyedStore(spark, str(tmp_path / "store"), SCHEMA, ["k", "j"], buckets=99)
    assert again.buckets == 8 and _rows(again.read_latest()) == _rows(log.read_latest())
    assert store.vacuum(1) > 0 and _rows(store.read_latest()) == _rows(log.read_latest())
    with pytest.raises(ValueError, match="keyed by"):
        KeyedStore(spark, str(tmp_path / "store"), SCHEMA, ["k"])


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), SCHEMA, ["k", "j"], buckets=32)
    store.write_batch(spark.createDataFrame([("a", j, j) for j in range(400)], ROWS), 1)
    asked = spark.createDataFrame([("a", 5), ("a", 77), ("a", 5), ("z", 1)], "x string, y bigint")
    found = store.lookup(asked, ["x", "y"])
    assert _rows(found) == [("a", 5, 5, 1), ("a", 77, 77, 1)]
    assert _buckets(found) <= store.touched(asked, ["x", "y"]) and len(_buckets(found)) <= 3
    store.write_batch(spark.createDataFrame([("a", 5, 6)], ROWS), 2)
    assert sorted(store.deltas().values())[-1] == 2 and list(store.deltas().values()).count(2) == 1
    assert store.compact(2) == 1 and _rows(store.lookup(asked, ["x", "y"])) == [("a", 5, 6, 2), ("a", 77, 77, 1)]
    assert store.read_all().count() == 400
    assert _rows(store.earlier(2, asked, ["x", "y"]).where("j = 77")) == [("a", 77, 77, 1)]


def test_a_batch_that_dies_before_its_commit_is_not_there(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, str(tmp_path / "s"), SCHEMA, ["k"], buckets=2)
    store.write_batch(spark.createDataFrame([("a", 1, 1)], ROWS), 1)

    def die(*_):
        raise OSError("gone")
    with monkeypatch.context() as m:
        m.setattr(Manifest, "commit", die)
        with pytest.raises(OSError):
            store.write_batch(spark.createDataFrame([("a", 1, 9), ("b", 1, 9)], ROWS), 2)
    assert _rows(store.read_latest()) == [("a", 1, 1, 1)]
    store.write_batch(spark.createDataFrame([("a", 1, 2)], ROWS), 2)
    assert _rows(store.read_latest()) == [("a", 1, 2, 2)] and store.vacuum() == 1


def test_writers_that_meet(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    one, two = (KeyedStore(spark, root, SCHEMA, ["k"], buckets=2) for _ in range(2))
    one.write_batch(spark.createDataFrame([("a", 1, 1)], ROWS), 1)
    write, met = KeyedStore._write, []

    def meet(self, rows):
        done = write(self, rows)
        if not met:
            met.append(1)
            two.write_batch(spark.createDataFrame([("b", 1, 2)], ROWS), 2)
        return done
    monkeypatch.setattr(KeyedStore, "_write", meet)
    one.write_batch(spark.createDataFrame([("c", 1, 3)], ROWS), 3)
    assert _rows(one.read_latest()) == [("a", 1, 1, 1), ("b", 1, 2, 2), ("c", 1, 3, 3)]
    # A compaction whose batch is run again meanwhile gives up.
    met.clear()
    assert one.compact(1) == 0 and two.read_all().count() == 3
    with pytest.raises(CommitConflict):
        one.manifest.commit(1, {})


def test_lookups_on_the_store_follow_the_stream(spark, tmp_path):
    from trackmart.schemas import CHANNEL_SEARCH, CHANNEL_STATS, LOOKUP_STATUS, VIDEO_STATS, VIDEOS
    from trackmart.streaming.incremental import LandedPaths, checkpoint_log, current_results, start_landed_stream
    at = {n: str(tmp_path / n) for n in ("search", "stats", "videos", "video_stats", "universe", "status")}
    spark.createDataFrame([("A",), ("B",), ("C",)], "artist_query string").write.parquet(at["universe"])
    spark.createDataFrame([("A", 1, "UCa", "A"), ("B", 1, "UCb", "B")], CHANNEL_SEARCH).write.parquet(at["search"])
    spark.createDataFrame([("UCa", "A", "5", "6", "7", False), ("UCb", "B", "1", "2", "3", False)], CHANNEL_STATS).write.parquet(at["stats"])
    spark.createDataFrame([], VIDEOS).write.parquet(at["videos"])
    spark.createDataFrame([], VIDEO_STATS).write.parquet(at["video_stats"])
    log = checkpoint_log(spark, str(tmp_path / "lookups"), buckets=4)
    for artist in ("A", "B"):
        spark.createDataFrame([(artist, 1, "ok", None)], LOOKUP_STATUS).write.mode("append").parquet(at["status"])
        start_landed_stream(spark, at["status"], LandedPaths(*(at[n] for n in ("search", "stats", "videos", "video_stats", "universe"))), log).awaitTermination()
        log.compact(1)
    got = {r["artist_query"]: r["subscriber_count"] for r in current_results(log).collect()}
    assert got == {"A": 5, "B": 1}


# --- publish -----------------------------------------------------------------------------

def _failing(spark):
    return spark.range(1000, numPartitions=4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("id")).alias("id"))


def test_publish_shows_whole_versions_only(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.publish(spark.range(10)) == 1
    first = table.read()
    with pytest.raises(Exception, match="killed"):
        table.publish(_failing(spark))
    with pytest.raises(EmptyInput):
        table.publish(spark.range(0))
    assert table.read().count() == 10 and table.rows() == 10
    assert table.publish(spark.range(5), mode="append") == 2 and table.read().count() == 15
    assert table.publish(spark.range(3)) == 3 and first.count() == 10 and table.read(2).count() == 15
    assert _rows(table.history()) == [(1, 10, 1), (2, 15, 2), (3, 3, 1)]
    assert table.publish(spark.range(0), allow_empty=True) == 4 and table.read().count() == 0
    with pytest.raises(ValueError, match="other columns"):
        table.publish(spark.createDataFrame([("x",)], "id string"), mode="append")
    assert table.vacuum(1) == 3 and table.read().count() == 0 and len(os.listdir(tmp_path / "t" / "data")) == 1


def test_appends_that_meet_both_stay(spark, tmp_path, monkeypatch):
    table, other = (PublishedTable(spark, str(tmp_path / "t")) for _ in range(2))
    table.publish(spark.range(10))
    commit, met = Manifest.commit, []

    def meet(self, after, state):
        if not met:
            met.append(1)
            other.publish(spark.range(100, 105), mode="append")
        return commit(self, after, state)
    monkeypatch.setattr(Manifest, "commit", meet)
    table.publish(spark.range(200, 203), mode="append")
    assert table.read().count() == 18 and table.rows() == 18


def test_a_failed_load_keeps_the_old_folder_and_table(spark, tmp_path):
    target = str(tmp_path / "out")
    write_table(spark.range(10), target, strict=True)
    for broken, error in ((_failing(spark), "killed"), (spark.range(0), "nothing was written")):
        with pytest.raises(Exception, match=error):
            write_table(broken, target, strict=True)
        assert spark.read.parquet(target).count() == 10
    assert write_table(spark.range(4), target, strict=True).first()["rows_stored"] == 4
    assert spark.read.parquet(target).count() == 4 and os.listdir(tmp_path) == ["out"]
    create_database(spark, "tm_swap")
    write_table(spark.range(10), "tm_swap.t", fmt="table")
    with pytest.raises(Exception, match="killed"):
        write_table(_failing(spark), "tm_swap.t", fmt="table")
    assert spark.table("tm_swap.t").count() == 10
    write_table(spark.range(6).withColumn("x", F.lit(1)), "tm_swap.t", fmt="table", strict=True)
    assert spark.table("tm_swap.t").count() == 6 and [t.name for t in spark.catalog.listTables("tm_swap")] == ["t"]


def test_checkpoint_folder_without_the_setting(tmp_path):
    """A fresh session that has no spark.checkpoint.dir gets a local folder."""
    code = ("from trackmart.session import build_session, checkpoint_dir, stored\n"
            "s = build_session(master='local[1]')\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            "assert checkpoint_dir(s) == checkpoint_dir(s)\n"
            "assert stored(s.range(3), 'x').count() == 3\n"
            "print('FINE')\n")
    env = {k: v for k, v in os.environ.items() if k not in ("SPARK_CONF_DIR", "PYSPARK_SUBMIT_ARGS")} | {"SPARK_CONF_DIR": str(tmp_path)}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=180)
    assert "FINE" in done.stdout, done.stderr[-2000:]
