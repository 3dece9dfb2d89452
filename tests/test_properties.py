"""Property tests (hypothesis) for the exact order statistics and the sample size rule."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from biasfit.operators.order_stats import exact_percentiles
from biasfit.operators.sampling import exact_stratified_sample

values = st.lists(st.one_of(st.integers(-5, 5).map(float),          # heavy ties
                            st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=120)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, bins=st.integers(2, 64), final_rows=st.integers(1, 50))
def test_percentiles_equal_numpy(spark, vals, bins, final_rows):
    df = spark.createDataFrame([(float(v),) for v in vals], "v DOUBLE")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_percentiles(df, "v", probs, bins=bins, final_rows=final_rows)[(0,)]
    want = np.quantile(np.array(vals, dtype=float), probs, method="linear")
    assert got == pytest.approx(list(want), rel=1e-12, abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ratings=st.lists(st.sampled_from([0.5, 1.0, 2.5, 3.0, 4.5, 5.0]), min_size=1, max_size=200),
       p=st.sampled_from([0.1, 0.25, 0.5]))
def test_sample_size_is_ceil_per_stratum(spark, ratings, p):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(ratings)], "id INT, rating DOUBLE")
    s = exact_stratified_sample(df, "rating", p, "9", ["id"], ["id"], keep_stratum=True, final_rows=5).collect()
    by = {}
    for r in s:
        n, k = by.get(r["_stratum"], (0, 0))
        by[r["_stratum"]] = (n + 1, k + int(r["sampled"]))
    for n, k in by.values():
        assert k == math.ceil(n * p)
