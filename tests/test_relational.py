"""Relational building blocks on tiny frames."""

from pyspark.sql import functions as F

from trackmart.operators import relational as R


def test_left_enrich_suffix_fill_and_key_drop(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "artists string, n int")
    right = spark.createDataFrame([("a", 10, "x"), (None, 30, "z")], "artist_query string, n int, tag string")
    out = R.left_enrich(left, right, ["artists"], ["artist_query"], suffix="_yt", fills={"tag": ""})
    assert out.columns == ["artists", "n", "n_yt", "tag"]
    got = sorted((r["artists"] or "", r["n_yt"], r["tag"]) for r in out.collect())
    assert got == [("", None, ""), ("a", 10, "x"), ("b", None, "")]  # NULL keys never match
    ns = R.left_enrich(left, right, ["artists"], ["artist_query"], null_safe=True)
    assert {r["n"]: r["tag"] for r in ns.collect()}[3] == "z"  # pandas-style NULL = NULL


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0)], "k int, s string, b boolean, d double")
    assert R.select_present(df, ["s", "missing", "k"]).columns == ["s", "k"]
    assert R.rename_present(df, {"s": "name", "absent": "x"}).columns == ["k", "name", "b", "d"]
    assert R.drop_present(df, ["b", "absent"]).columns == ["k", "s", "d"]
    added = R.add_defaults(df, {"s": ("zz", "string"), "new": (0, "bigint")})
    assert added.first()["s"] == "a" and added.schema["new"].dataType.simpleString() == "bigint"
    assert R.columns_of_kind(df, "numeric") == ["k", "d"] and R.columns_of_kind(df, "text") == ["s"]


def test_exclusions_and_pending(spark):
    names = spark.createDataFrame([(" Various Artists ",), ("various artists",), (None,), ("X",)], "n string")
    kept = [r[0] for r in R.exclude_values(names, "n", ["Various Artists"]).collect()]
    assert sorted(kept) == ["X", "various artists"]
    cand = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    done = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted(r[0] for r in R.pending_keys(cand, done, "k").collect()) == ["b", "c"]


def test_dedup_and_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None)], "k int, v string")
    assert R.dedup_rows(df).count() == 3
    full = R.duplicate_counts(df).first()
    assert (full["rows"], full["duplicate_rows"], full["rows_in_shared_keys"]) == (5, 2, 4)
    keyed = R.duplicate_counts(df, ["k"]).first()
    assert (keyed["duplicate_rows"], keyed["rows_in_shared_keys"]) == (3, 5)


def test_upsert_latest_arrival_wins(spark):
    prior = spark.createDataFrame([("a", "old", 1), ("b", "keep", 1)], "k string, v string, batch_id int")
    new = spark.createDataFrame([("a", "new", 2)], "k string, v string, batch_id int")
    got = {r["k"]: r["v"] for r in R.upsert_latest(prior, new, ["k"], [F.col("batch_id").desc()]).collect()}
    assert got == {"a": "new", "b": "keep"}


def test_latest_per_key_total_order(spark):
    df = spark.createDataFrame([("t", 2020, "b"), ("t", 2020, "a"), ("t", None, "0"), ("u", None, "z")],
                               "id string, year int, g string")
    got = {r["id"]: (r["year"], r["g"]) for r in
           R.latest_per_key(df, ["id"], [F.col("year").desc_nulls_last()]).collect()}
    assert got == {"t": (2020, "a"), "u": (None, "z")}


def test_top_k_head_tail_running_total(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(10)], "k int, v double")
    top = [r["k"] for r in R.top_k_rows(df, 3, [F.col("v").desc(), F.col("k")]).collect()]
    assert top == [3, 7, 2]
    ht = R.head_tail(df, 2, ["k"]).collect()
    assert sorted((r["position"], r["k"]) for r in ht) == [("head", 0), ("head", 1), ("tail", 8), ("tail", 9)]
    counts = spark.createDataFrame([(2001, 3), (2000, 1), (2002, 2)], "year int, count bigint")
    run = {r["year"]: r["cumulative"] for r in R.running_total(counts, "year", "count").collect()}
    assert run == {2000: 1, 2001: 4, 2002: 6}
    cats = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "c string")
    assert [tuple(r) for r in R.top_k_categories(cats, "c", 2).collect()] == [("a", 2), ("b", 2)]
    vc = {r["c"]: r["count"] for r in R.value_counts(cats, "c", dropna=False).collect()}
    assert vc[None] == 3
