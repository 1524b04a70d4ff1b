import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowgauge.operators import quantiles


@pytest.mark.parametrize("buffer", [0, 1_000_000])
def test_quantiles_match_numpy(spark, buffer):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.exponential(30, 900), np.full(300, 12.5), [1e9, -1e6]])
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(values)], "v double, i int")
    found = quantiles.exact_quantiles(df, {"v": [0.0, 0.1, 0.5, 0.8, 1.0], "i": [0.5]}, buffer_rows=buffer)
    for (name, p), value in found.items():
        expected = np.quantile(values if name == "v" else np.arange(len(values)), p)
        assert value == pytest.approx(expected, rel=1e-12)


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    for buffer in (0, 10):
        assert quantiles.medians(df, ["v"], buffer_rows=buffer) == {"v": None}


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "v double")
    assert quantiles.medians(df, ["v"]) == {"v": 3.0}
    assert quantiles.medians(df, ["v"], buffer_rows=0) == {"v": 3.0}
    assert quantiles.medians(df, ["v"], approx=True) == {"v": 2.0}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40), st.floats(0, 1))
def test_rank_search_is_exact(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    rank = int(p * (len(values) - 1))
    found = quantiles.values_at_ranks(df, {"v": F.col("v")}, [("v", rank)])
    assert found["v", rank] == sorted(values)[rank]


def test_two_passes_answer_all_ranks(spark, monkeypatch):
    """Brackets hold the ranks, and a rank outside its bracket is found as well."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 30_000), rng.integers(0, 5, 30_000).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").repartition(7)
    wanted = {"a": [0.0, 0.01, 0.5, 0.999, 1.0], "b": [0.5, 0.8]}
    whole = []
    search = quantiles.values_at_ranks
    monkeypatch.setattr(quantiles, "values_at_ranks", lambda df, *args: whole.append(df.count()) or search(df, *args))
    for accuracy in (10_000, 50, 10**9):  # the last one leaves brackets without room
        monkeypatch.setattr(quantiles, "_ACCURACY", min(accuracy, 2**31 - 1))
        found = quantiles.exact_quantiles(df, wanted, buffer_rows=0)
        assert all(found["a", p] == pytest.approx(np.quantile(a, p), rel=1e-12) for p in wanted["a"])
        assert all(found["b", p] == np.quantile(b, p) for p in wanted["b"])
    assert not whole  # every rank lay in its bracket
    lows = quantiles._between_brackets(df, {("a", 100): (5.0, 6.0)})
    assert lows == {}
