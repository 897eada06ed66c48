"""Infinite values in exact percentiles and outlier checks."""

import math

import numpy as np
import pytest

from millrace.operators import quality
from millrace.operators.quantiles import exact_quantiles

INF = math.inf


@pytest.mark.parametrize(
    "values",
    [[*range(10), INF], [*range(100), *[-INF] * 10], [INF, INF], [-INF, INF, 1.0], [-INF] * 3 + [2.0] * 3 + [INF] * 3],
)
def test_quantiles(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    ordered = sorted(values)
    for share in (0.0, 0.05, 0.5, 0.95, 1.0):
        at = share * (len(values) - 1)
        low, high, part = ordered[math.floor(at)], ordered[math.ceil(at)], at - math.floor(at)
        want = low if low == high or not part else low + (high - low) * part
        got = exact_quantiles(df, ["v"], [share])["v"][0]
        assert got == want or np.isclose(got, want) or (math.isnan(got) and math.isnan(want))


@pytest.mark.parametrize("extra", [INF, -INF])
def test_no_outliers_without_a_finite_mean(spark, extra):
    df = spark.createDataFrame([(float(v),) for v in [*range(10), extra]], "v double")
    assert [r["unexpected"] for r in quality.check_outliers(df, "t").collect()] == [0]
