"""Property-based checks against plain Python/numpy (few examples: each one
runs Spark jobs)."""

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trackmart.functions.columns import py_strip
from trackmart.operators import profile as P

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(values=st.lists(st.one_of(st.integers(-5, 5).map(float),
                                 st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                       min_size=1, max_size=400),
       bound=st.integers(1, 50), buckets=st.integers(2, 64))
def test_exact_quantiles_match_numpy(spark, values, bound, buckets):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    qs = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = P.exact_quantiles(df, ["x"], qs, bound=bound, buckets=buckets)
    ref = np.quantile(np.array(values), qs)
    for q, r in zip(qs, ref):
        assert math.isclose(got[("x", q)], r, rel_tol=1e-9, abs_tol=1e-9), (q, got[("x", q)], r)


@SETTINGS
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list(" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85   "
                                                            "      　​ab~é"))),
                      min_size=1, max_size=30))
def test_trim_matches_python_strip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(py_strip("s")).collect()]
    assert got == [t.strip() for t in texts]
