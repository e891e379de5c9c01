"""The numeric model on series with known answers."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lagwatch.functions import arima
from lagwatch.operators import forecast
from tables import at

SETTINGS = {"p": 3, "d": 1, "q": 2, "s": 12, "window": 100}


def test_warm_up_has_no_result():
    scores, predictions = arima.detect_series(np.arange(100.0), **SETTINGS)
    assert np.isnan(scores).all() and np.isnan(predictions).all()


def test_constant_series():
    scores, predictions = arima.detect_series(np.full(150, 7.0), **SETTINGS)
    assert (scores[100:] == 0).all()
    assert predictions[100:] == pytest.approx(7.0)


def test_step_after_constant():
    series = np.full(120, 7.0)
    series[110] = 9.0
    scores, _ = arima.detect_series(series, **SETTINGS)
    assert scores[110] == 1.0
    assert (scores[100:110] == 0).all()


def test_ramp_is_followed():
    scores, predictions = arima.detect_series(np.arange(150.0) * 3, **SETTINGS)
    assert predictions[120] == pytest.approx(360.0, rel=1e-6)
    assert (scores[100:] < 0.5).all()


def test_season_is_followed_and_break_is_found():
    rng = np.random.default_rng(1)
    t = np.arange(400)
    series = 50 + 10 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 0.5, 400)
    series[350] += 25
    scores, predictions = arima.detect_series(series, **SETTINGS)
    quiet = np.r_[100:350]
    assert scores[350] > 0.8
    assert np.mean(scores[quiet] > 0.5) < 0.02
    assert np.sqrt(np.mean((predictions[quiet] - series[quiet]) ** 2)) < 1.5


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32 - 1), st.floats(1e-3, 1e6), st.integers(0, 2))
def test_scores_stay_between_zero_and_one(seed, scale, d):
    series = np.random.default_rng(seed).normal(0, scale, 140)
    scores, predictions = arima.detect_series(series, 2, d, 1, 6, 80)
    assert np.isfinite(predictions[80:]).all()
    assert ((scores[80:] >= 0) & (scores[80:] <= 1)).all()


def test_no_moving_average_terms():
    rng = np.random.default_rng(2)
    scores, _ = arima.detect_series(rng.normal(0, 1, 200), 2, 0, 0, 0, 80)
    assert np.isfinite(scores[80:]).all()


@pytest.mark.parametrize(("p", "d", "rows"), [(3, 1, 100), (2, 1, 20), (2, 0, 30), (1, 1, 12)])
def test_window_regression_agrees_with_the_numpy_fit(spark, p, d, rows):
    rng = np.random.default_rng(p * 10 + d)
    series = {
        "noise": np.round(rng.normal(500, 40, 260), 2),
        "walk": np.round(5_000 + np.cumsum(rng.normal(0, 30, 260)), 2),
        "season": np.round(1_000 + 300 * np.sin(np.arange(260) / 3) + rng.normal(0, 5, 260), 2),
    }
    table = spark.createDataFrame(
        [("c", name, at(10 * i), float(v)) for name, values in series.items() for i, v in enumerate(values)],
        "cluster_id string, consumer_group string, event_time timestamp, v double",
    )
    found = forecast.forecast(
        table, "v", p=p, d=d, training_window=rows, threshold=0.2, algorithm="AR", chunk_rows=64
    )
    by_group = {}
    for r in found.orderBy("event_time").collect():
        by_group.setdefault(r.consumer_group, []).append(r.anomaly_data)
    for name, values in series.items():
        scores, ahead = arima.detect_series(values, p, d, 0, 0, rows)
        got = by_group[name]
        assert len(got) == len(values)
        assert all(g.prediction is None and g.anomaly_score is None and not g.is_anomaly for g in got[:rows])
        assert [g.prediction for g in got[rows:]] == pytest.approx(list(ahead[rows:]), rel=1e-5)
        assert [g.anomaly_score for g in got[rows:]] == pytest.approx(list(scores[rows:]), rel=1e-4, abs=1e-6)
        assert [g.is_anomaly for g in got[rows:]] == [g.anomaly_score > 0.2 for g in got[rows:]]


def test_window_regression_on_exact_series(spark):
    ramp, flat = np.arange(60.0) * 3, np.full(60, 7.0)
    flat[50] = 9.0
    rows = [("c", name, at(10 * i), float(v)) for name, s in (("ramp", ramp), ("flat", flat)) for i, v in enumerate(s)]
    table = spark.createDataFrame(rows, "cluster_id string, consumer_group string, event_time timestamp, v double")
    found = forecast.forecast(table, "v", p=2, d=1, training_window=20, algorithm="AR").collect()
    scores = {(r.consumer_group, r.event_time): r.anomaly_data for r in found}
    assert all(scores["ramp", at(10 * i)].anomaly_score == 0 for i in range(20, 60))
    assert scores["ramp", at(590)].prediction == pytest.approx(177)
    assert [scores["flat", at(10 * i)].anomaly_score for i in (20, 49, 50)] == [0, 0, 1]


def test_window_regression_refuses_what_it_cannot_fit(spark):
    table = spark.createDataFrame([], "cluster_id string, consumer_group string, event_time timestamp, v double")
    for settings_ in ({"d": 2}, {"p": 3, "training_window": 8}):
        with pytest.raises(ValueError, match="AR takes"):
            forecast.forecast(table, "v", algorithm="AR", **settings_)
    assert forecast.forecast(table, "v", algorithm="AR").isEmpty()


def test_zscore_agrees_with_brute_force(spark):
    rows, rng = 20, np.random.default_rng(3)
    values = [None if i % 17 == 0 else float(v) for i, v in enumerate(rng.normal(50, 9, 150).round(3))]
    table = spark.createDataFrame(
        [("c", "g", at(10 * i), v) for i, v in enumerate(values)], "cluster_id string, consumer_group string, event_time timestamp, v double"
    )
    found = forecast.forecast(table, "v", training_window=rows, threshold=0.2, algorithm="ZSCORE", chunk_rows=16)
    for i, row in enumerate(found.orderBy("event_time").collect()):
        got, window = row.anomaly_data, [v for v in values[max(i - rows, 0) : i] if v is not None]
        if i < rows or values[i] is None:
            assert got.anomaly_score is None and not got.is_anomaly
        else:
            score = min(abs(values[i] - np.mean(window)) / np.std(window, ddof=1) / arima.SIGMAS_AT_FULL_SCORE, 1)
            assert got.anomaly_score == pytest.approx(score) and got.is_anomaly == (score > 0.2)
        assert got.prediction == (pytest.approx(np.mean(window)) if i >= rows else None)


def test_zscore_of_an_unchanging_value(spark):
    """A hundred times 0.1, added up and divided, is not 0.1: the series was an anomaly in every row."""
    table = spark.createDataFrame(
        [("c", "g", at(10 * i), 0.1) for i in range(150)], "cluster_id string, consumer_group string, event_time timestamp, v double"
    )
    found = forecast.forecast(table, "v", algorithm="ZSCORE").orderBy("event_time").collect()
    assert [r.anomaly_data.prediction for r in found] == [None] * 100 + [0.1] * 50
    assert [r.anomaly_data.anomaly_score for r in found] == [None] * 100 + [0.0] * 50
    assert not any(r.anomaly_data.is_anomaly for r in found)


def test_zscore_adds_up_no_window_for_each_row(spark):
    table = spark.createDataFrame([("c", "g", at(0), 0.1)], "cluster_id string, consumer_group string, event_time timestamp, v double")
    plan = forecast.forecast(table, "v", algorithm="ZSCORE")._jdf.queryExecution().executedPlan().toString()
    assert "RowFrame, -100" not in plan
