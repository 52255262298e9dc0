"""Profiling operators on small frames and on whole test tables."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from trackmart.operators import profile as P


def test_bracketed_quantiles_equal_exact(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    exact = {(r["column"], r["q"]): r["value"] for r in P.quantiles(li, ["l_extendedprice", "l_quantity"], qs).collect()}
    # force several refinement levels with a tiny per-task bound
    forced = {(r["column"], r["q"]): r["value"]
              for r in P.quantiles(li, ["l_extendedprice", "l_quantity"], qs, bound=500).collect()}
    assert exact.keys() == forced.keys()
    for k in exact:
        assert math.isclose(exact[k], forced[k], rel_tol=1e-12), k


def test_quantile_linear_interpolation(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 10]], "x double")
    got = {r["q"]: r["value"] for r in P.quantiles(df, ["x"], [0.5, 0.9]).collect()}
    assert got[0.5] == 3.0 and math.isclose(got[0.9], 7.6)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,), (None,)], "x double")
    h = {r["bin"]: r["count"] for r in P.histogram(df, "x", 5).collect()}
    assert h == {1: 2, 2: 1, 3: 0, 4: 0, 5: 1}  # max falls in the last bin, NULL ignored
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    h = {r["bin"]: r["count"] for r in P.histogram(same, "x", 4).collect()}
    assert h == {1: 2, 2: 0, 3: 0, 4: 0}


def test_describe_numeric_matches_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 2.0, 5.0, None, 9.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = P.describe_numeric(df).collect()[0]
    ref = pd.Series(vals, dtype="float64").describe()
    assert r["count"] == ref["count"]
    for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                         ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert math.isclose(r[ours], ref[theirs]), ours


def test_describe_text_top_tie_breaks_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    r = P.describe_text(df).collect()[0]
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "a", 2)


def test_null_profile_only_missing(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r["column"]: (r["null_count"], r["null_pct"]) for r in P.null_profile(df).collect()}
    assert got["b"][0] == 2 and math.isclose(got["b"][1], 200 / 3)
    assert got["a"][0] == 1
    assert P.total_nulls(df).first()["total_nulls"] == 3


def test_density_matches_scipy_style_formula(spark):
    import numpy as np
    xs = [0.0, 1.0, 1.5, 4.0, 7.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = sorted(P.density(df, "x", gridsize=20).collect(), key=lambda r: r["point"])
    a = np.array(xs)
    bw = a.std(ddof=1) * len(a) ** (-0.2)
    grid = np.linspace(a.min() - 3 * bw, a.max() + 3 * bw, 20)
    ref = np.exp(-0.5 * ((grid[:, None] - a[None, :]) / bw) ** 2).sum(1) / (len(a) * bw * math.sqrt(2 * math.pi))
    for r, g, d in zip(rows, grid, ref):
        assert math.isclose(r["x"], g, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["density"], d, rel_tol=1e-9)


def test_column_profile_and_samples(spark):
    df = spark.createDataFrame([(i % 60, f"v{i % 3}") for i in range(100)], "n int, s string")
    prof = {r["column"]: r for r in P.column_profile(df).collect()}
    assert prof["n"]["n_unique"] == 60 and prof["n"]["n_shown"] == 20 and prof["n"]["n_more"] == 40
    assert prof["s"]["n_unique"] == 3 and prof["s"]["n_shown"] == 3 and prof["s"]["min_text"] == "v0"
    samples = P.column_samples(df)
    n_vals = [r["value_num"] for r in samples.filter("column = 'n'").orderBy("rank").collect()]
    assert n_vals == [float(i) for i in range(20)]


def test_auto_bins_counts_null(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "y int")
    assert P.auto_bins(df, "y") == 2


def test_exact_quantiles_with_a_hot_value_and_tiny_bound(spark):
    import numpy as np
    vals = [0.0] * 3000 + [float(i % 997) * 1.5 for i in range(6000)] + [1e9, -5.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    qs = [0.0, 0.1, 0.25, 0.33, 0.34, 0.5, 0.9, 0.999, 1.0]
    got = P.exact_quantiles(df, ["x"], qs, bound=50, buckets=16)
    ref = np.quantile(np.array(vals), qs)  # linear interpolation
    for q, r in zip(qs, ref):
        assert math.isclose(got[("x", q)], r, rel_tol=1e-12, abs_tol=1e-12), q


def test_exact_quantiles_all_nulls_and_constant(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 2.0)], "a double, b double")
    got = P.exact_quantiles(df, ["a", "b"], [0.5])
    assert got[("a", 0.5)] is None and got[("b", 0.5)] == 2.0


def test_column_profile_approx_close_to_exact(spark):
    from conftest import SF01
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    exact = {r["column"]: r for r in P.column_profile(o).collect()}
    approx = {r["column"]: r for r in P.column_profile(o, approx=True).collect()}
    for c, r in exact.items():
        a = approx[c]
        assert (a["rows"], a["nulls"], a["min_num"], a["max_num"], a["min_text"], a["max_text"]) == \
            (r["rows"], r["nulls"], r["min_num"], r["max_num"], r["min_text"], r["max_text"])
        assert abs(a["n_unique"] - r["n_unique"]) <= max(2, 0.05 * r["n_unique"])


def test_eda_report(spark):
    from conftest import SF01
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    rep = P.eda_report(o)
    assert {"shape", "nulls", "duplicates", "describe_numeric", "describe_text", "column_profile"} <= set(rep)
    assert "value_counts:o_orderstatus" in rep and "value_counts:o_orderkey" not in rep
    assert rep["shape"].first()["rows"] == 15000
    assert sum(r["count"] for r in rep["value_counts:o_orderpriority"].collect()) == 15000


def test_quantiles_with_materialized_input(spark):
    df = spark.range(0, 20000).selectExpr("CAST(id * 7 % 1009 AS DOUBLE) AS x")
    a = {r["q"]: r["value"] for r in P.quantiles(df, ["x"], [0.1, 0.5, 0.9], bound=100).collect()}
    b = {r["q"]: r["value"] for r in P.quantiles(df, ["x"], [0.1, 0.5, 0.9], bound=100, materialize=True).collect()}
    assert a == b


def test_nan_is_missing_in_numeric_profiles(spark):
    vals = [1.0, 2.0, float("nan"), 3.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = {r["q"]: r["value"] for r in P.quantiles(df, ["x"], [0.5, 1.0]).collect()}
    assert q == {0.5: 2.0, 1.0: 3.0}
    d = P.describe_numeric(df).first()
    assert d["count"] == 3 and d["max"] == 3.0 and math.isclose(d["mean"], 2.0)
    h = {r["bin"]: r["count"] for r in P.histogram(df, "x", 2).collect()}
    assert h == {1: 1, 2: 2}


def test_histogram_auto_bins_in_one_pass(spark):
    df = spark.createDataFrame([(y,) for y in [2000, 2001, 2002, 2003, None]], "year int")
    h = P.histogram(df, "year")  # 5 categories incl. NULL -> 2 bins
    assert sorted((r["bin"], r["count"]) for r in h.collect()) == [(1, 2), (2, 2)]


def test_exact_quantiles_with_infinities(spark):
    import numpy as np
    vals = [float("-inf"), 1.0, 2.0, 3.0, 4.0, float("inf")] * 3
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    qs = [0.0, 0.2, 0.5, 0.8, 1.0]
    got = P.exact_quantiles(df, ["x"], qs, bound=2, buckets=4)
    ref = np.quantile(np.array(vals), qs)
    for q, r in zip(qs, ref):
        assert got[("x", q)] == r or (math.isnan(got[("x", q)]) and math.isnan(r)), (q, got[("x", q)], r)


def test_profile_counts_raw_values(spark):
    import datetime as dt
    day = dt.datetime(2024, 1, 1)
    rows = [(2**53 + k, day + dt.timedelta(microseconds=100_000 * k), float("nan") if k == 0 else 1.5) for k in range(3)]
    df = spark.createDataFrame(rows, "n bigint, t timestamp, x double")
    for approx in (False, True):
        got = {r["column"]: r for r in P.column_profile(df, approx=approx).collect()}
        assert (got["n"]["n_unique"], got["t"]["n_unique"], got["x"]["n_unique"]) == (3, 3, 1)
        assert (got["x"]["nulls"], got["x"]["max_num"]) == (1, 1.5)
        assert got["t"]["max_text"].endswith("00:00:00.200000")
    assert {r["column"]: r["null_count"] for r in P.null_profile(df).collect()} == {"x": 1}
    assert P.total_nulls(df).first()["total_nulls"] == 1
    assert sorted((r["column"], r["rank"]) for r in P.column_samples(df).collect()) == [
        ("n", 1), ("n", 2), ("n", 3), ("t", 1), ("t", 2), ("t", 3), ("x", 1)]


def test_samples_are_the_smallest_values_whatever_the_probe(spark, monkeypatch):
    monkeypatch.setattr(P, "SAMPLE_PROBE", 200)
    df = spark.range(3000).selectExpr("(id * 7919) % 3000 AS a", "id % 7 AS b")
    got = [(r["column"], r["value_num"]) for r in P.column_samples(df).orderBy("column", "rank").collect()]
    assert got == [("a", float(k)) for k in range(20)] + [("b", float(k)) for k in range(7)]


def test_quantiles_of_a_log_uniform_column_named_like_the_working_ones(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = (10.0 ** rng.uniform(-200, 200, 5000)).tolist() + [1e-250] * 900
    df = spark.createDataFrame([(v, k) for k, v in enumerate(x)], "value double, x0 bigint")
    got = P.exact_quantiles(df, ["value"], [0.1, 0.5, 0.9], bound=5, buckets=8)
    for q in (0.1, 0.5, 0.9):
        assert got[("value", q)] == pytest.approx(float(np.quantile(x, q)), rel=1e-12)
    assert P.describe_numeric(df, ["value"]).first()["count"] == 5900


def test_histogram_and_density_leave_infinite_values_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("inf"),)], "x double")
    assert [r["count"] for r in P.histogram(df, "x", 2).orderBy("bin").collect()] == [1, 2]
    assert P.density(df, "x").count() == 200
