"""Skew, heavy hitters, mergeable profiles, running totals, dedup by digest and
binned density against plain versions."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from trackmart.operators import profile as P
from trackmart.operators import relational as R
from trackmart.operators import sketches as S
from trackmart.operators.heavy import heavy_keys, slot_counts, top_k_heavy
from trackmart.operators.skew import skew_left_enrich


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def plain_joins(spark):
    """No broadcast by size, nothing split or merged at run time."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "20"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- J-02 ----------------------------------------------------------------------------------

def test_no_partition_gets_a_hot_key(spark, plain_joins):
    hot = F.col("id") % 3 == 0
    left = spark.range(60_000).select("id", F.when(hot, 1).otherwise(F.col("id") % 5000).alias("a"), F.when(hot, "x").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("b"))
    right = left.select(F.col("a").alias("ra"), F.col("b").alias("rb")).distinct().withColumn("w", F.xxhash64("ra", "rb") % 100)
    plain = R.left_enrich(left, right, ["a", "b"], ["ra", "rb"])
    salted = skew_left_enrich(left, right, ["a", "b"], ["ra", "rb"])
    sizes = lambda df: [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("id").alias("n"), F.sum("w")).collect()]
    assert max(sizes(plain)) > 5 * median(sizes(plain))
    assert max(sizes(salted)) <= 2 * median(sizes(salted)) and len(sizes(salted)) == 20
    assert _rows(salted) == _rows(plain)


@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_rows(spark, null_safe):
    rng = random.Random(2)
    left = spark.createDataFrame([(k, rng.choice([None, "hot", "hot", f"s{rng.randrange(9)}"])) for k in range(900)], "id bigint, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3), ("s1", 4), ("s1", 5), ("none", 6)], "rk string, id int")
    fills = {"id_r": 0}
    want = R.left_enrich(left, right, ["k"], ["rk"], fills=fills, null_safe=null_safe)
    assert _rows(skew_left_enrich(left, right, ["k"], ["rk"], fills=fills, null_safe=null_safe)) == _rows(want)
    even = spark.range(50).select("id", (F.col("id") % 50).cast("string").alias("k"))
    assert _rows(skew_left_enrich(even, right, ["k"], ["rk"])) == _rows(R.left_enrich(even, right, ["k"], ["rk"]))
    assert skew_left_enrich(left.limit(0), right, ["k"], ["rk"]).count() == 0


# --- T-02, T-03 ----------------------------------------------------------------------------

def _skewed(spark, seed, n=4000):
    rng = random.Random(seed)
    return spark.createDataFrame([(rng.choice([None, f"h{rng.randrange(6)}", f"u{rng.randrange(10 ** 6)}", f"u{rng.randrange(10 ** 6)}"]),) for _ in range(n)], "v string")


@pytest.mark.parametrize("slots", [1, 16, 8192])
@pytest.mark.parametrize("k", [1, 6, 30])
def test_top_k_heavy_equals_full_counts(spark, slots, k):
    df = _skewed(spark, k)
    assert top_k_heavy(df, "v", k, slots=slots).collect() == R.top_k_categories(df, "v", k).collect()
    assert top_k_heavy(df, "v", k, dropna=False, slots=slots).collect() == R.top_k_categories(df, "v", k, dropna=False).collect()


def test_heavy_values_are_found_without_counting_the_others(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 70).otherwise(F.col("id") + 1000).alias("v"))
    report: dict = {}
    top = top_k_heavy(df, "v", 5, report=report)
    assert [r["count"] for r in top.collect()] == [2858, 2857, 2857, 2857, 2857] and not report["full"]
    assert report["open_rows"] < 0.15 * report["rows"]
    assert slot_counts(df, ["v"]).count() <= 2 * 8192
    heavy_report: dict = {}
    assert {r["v"] for r in heavy_keys(df, ["v"], 2800, "n", report=heavy_report).collect()} == set(range(0, 70, 10))
    assert heavy_report["open_rows"] < 0.15 * heavy_report["rows"]
    assert _rows(heavy_keys(df, ["v"], 2, "n")) == _rows(df.groupBy("v").agg(F.count("*").alias("n")).where("n >= 2"))


def test_heavy_keys_of_nothing_and_of_several_columns(spark):
    df = _skewed(spark, 1).withColumn("w", F.length("v"))
    assert _rows(heavy_keys(df, ["v", "w"], 20)) == _rows(df.groupBy("v", "w").count().where("count >= 20"))
    assert heavy_keys(df.limit(0), ["v"], 1).collect() == [] and top_k_heavy(df.limit(0), "v", 3).collect() == []


# --- A-03, A-06, A-07, A-12, A-15 -----------------------------------------------------------

def _numbers(spark):
    x = F.col("id")
    return spark.range(30_000).select("id", F.when(x % 11 == 0, None).when(x % 13 == 0, float("nan")).otherwise(F.exp(F.sin(x) * 4) + 1e6).alias("x"),
                                      (x * x % 977).alias("n"), F.concat(F.lit("t"), x % 4000).alias("t"), F.lit(None).cast("double").alias("none"),
                                      F.when(x % 5 != 0, x % 3).alias("g"))


def test_profile_of_batches_equals_one_over_all(spark, tmp_path):
    df, cols, qs = _numbers(spark), ["x", "n", "t", "none"], [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    log = S.ProfileLog(spark, str(tmp_path / "p"))
    for b in (0, 1, 2, 1):
        assert log.add(df.where(F.col("id") % 3 == b) if b < 2 else df.where("id % 3 = 2"), b, cols)
    got = {r["column"]: r for r in log.profile(qs).collect()}
    want = {r["column"]: r for r in P.describe_numeric(df, ["x", "n"]).collect()}
    for c in ("x", "n"):
        assert got[c]["rows"] == 30_000 and got[c]["count"] == want[c]["count"] and got[c]["nulls"] == 30_000 - want[c]["count"]
        assert (got[c]["min"], got[c]["max"]) == (want[c]["min"], want[c]["max"])
        assert got[c]["mean"] == pytest.approx(want[c]["mean"], rel=1e-12) and got[c]["std"] == pytest.approx(want[c]["std"], rel=1e-9)
        assert max(S.rank_errors(df, c, qs, got[c]["quantiles"])) <= S.RANK_ERROR
        exact = df.select(S.nan_to_null(F.col(c).cast("double")).alias("c")).agg(F.count_distinct("c")).first()[0]
        assert abs(got[c]["distinct"] - exact) <= S.COUNT_ERROR * exact
    assert abs(got["t"]["distinct"] - 4000) <= 80 and got["t"]["quantiles"] is None and got["t"]["count"] == 30_000
    assert (got["none"]["count"], got["none"]["distinct"], got["none"]["quantiles"], got["none"]["mean"]) == (0, 0, None, None)


def test_states_of_groups(spark):
    df = _numbers(spark)
    parts = [S.states(df.where(F.col("id") % 2 == b), ["n", "t"], "g") for b in (0, 1)]
    both = parts[0].unionByName(parts[1])
    got = {(r["column"], r["part"]): r for r in S.profile(both).collect()}
    assert {k[1] for k in got} == {"0", "1", "2", None}
    for r in df.groupBy("g").agg(F.count_distinct("n").alias("n"), F.count_distinct("t").alias("t"), F.count("*").alias("rows"), F.avg("n").alias("mean")).collect():
        part = None if r["g"] is None else str(r["g"])
        for c in ("n", "t"):
            assert abs(got[c, part]["distinct"] - r[c]) <= S.COUNT_ERROR * r[c] and got[c, part]["rows"] == r["rows"]
        assert got["n", part]["mean"] == pytest.approx(r["mean"], rel=1e-12)
    whole = {r["column"]: r for r in S.profile(both, by=False).collect()}
    assert whole["n"]["rows"] == 30_000 and abs(whole["t"]["distinct"] - 4000) <= 80
    assert S.profile(S.states(df.limit(0), ["n"])).collect() == []


# --- A-18 ------------------------------------------------------------------------------------

def test_binned_density_is_near_the_exact_one(spark):
    df = spark.range(20_000).select((F.sin("id") * 3 + F.when(F.col("id") % 4 == 0, 20).otherwise(0)).alias("x"))
    exact, binned = ({r["point"]: (r["x"], r["density"]) for r in f(df, "x").collect()} for f in (P.density, P.binned_density))
    peak = max(d for _, d in exact.values())
    assert exact.keys() == binned.keys() and all(binned[p][0] == pytest.approx(exact[p][0]) for p in exact)
    assert max(abs(binned[p][1] - exact[p][1]) for p in exact) < 1e-4 * peak
    assert P.density_cells(df, "x", -5.0, 0.1).count() < 400  # of 20,000 values
    odd = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (4.0,)], "x double")
    assert P.binned_density(odd, "x").count() == 200 and P.binned_density(odd.limit(1), "x").count() == 0


# --- W-01 ------------------------------------------------------------------------------------

def test_running_totals(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, *range(40)]), rng.randrange(5), rng.choice([None, 1, 2, 3])) for _ in range(3000)]
    df = spark.createDataFrame(data, "a bigint, b bigint, v bigint").repartition(5)
    out = R.running_totals(df, ["a"], {"sum v": "v"}, "position", partitions=7)
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] is None, r[2] or 0))
    want, total = [], 0
    for k, r in enumerate(order):
        total += r[2] or 0
        want.append((*r, total, k + 1))
    assert [tuple(r) for r in out.orderBy("position").collect()] == want
    assert R.running_totals(df.limit(0), ["a"], {"s": "v"}).collect() == []


# --- D-01 ------------------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["hash", "constant", "few bits", "too many"])
def test_dedup_by_digest(spark, kind):
    rng = random.Random(5)
    data = [(rng.randrange(400), rng.choice([None, "a", "b"]), rng.choice([None, 0.5, float("nan"), -0.0, 0.0])) for _ in range(900)]
    df = spark.createDataFrame(data, "id bigint, s string, x double").repartition(4)
    how = {"hash": {}, "constant": {"digest": F.lit(7).cast("bigint")}, "few bits": {"bits": 1 << 12}, "too many": {"bits": 8}}[kind]
    out = R.dedup_rows_by_digest(df, **how)
    same = lambda d: sorted(str((r[0], r[1], r[2] if r[2] is None else r[2] + 0.0)) for r in d.collect())  # noqa: E731  (-0.0 is 0.0)
    assert out.columns == df.columns and same(out) == same(R.dedup_rows(df))
    assert R.dedup_rows_by_digest(df.limit(0)).collect() == []


def test_rows_that_are_alone_are_not_shuffled(spark):
    df = spark.range(50_000).withColumn("s", F.concat(F.lit("x"), "id"))
    df = df.unionByName(df.where("id < 100"))
    out = R.dedup_rows_by_digest(df)
    assert out.count() == 50_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") >= 1 and "Union" in plan
