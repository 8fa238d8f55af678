"""Regressions and forecasts."""

import datetime as dt

import pytest
from pyspark.ml.linalg import Vectors

import tripscope.operators as ops

from helpers import make_trips, ts


def test_closed_form_passenger_model_equals_linear_regression(trips_small):
    got = ops.demand_lr_passengers(trips_small).first()
    model = ops.fit_passenger_model(trips_small)
    assert got.coefficient == pytest.approx(model.coefficients[0], rel=1e-9, abs=1e-12)
    assert got.intercept == pytest.approx(model.intercept, rel=1e-9)
    assert got.r2 == pytest.approx(model.summary.r2, rel=1e-6, abs=1e-12)
    assert got.rmse == pytest.approx(model.summary.rootMeanSquaredError, rel=1e-9)
    assert got.n == trips_small.where("passenger_count IS NOT NULL").count()


def test_next_hour_model_prediction_at_the_query_point(trips_small):
    row = ops.demand_lr_next_hour(trips_small).first()
    assert (row.hour, row.day_of_week, row.month) == (18, 2, 7)
    expected = row.intercept + 18 * row.coef_hour + 2 * row.coef_day_of_week + 7 * row.coef_month
    assert row.prediction == pytest.approx(expected, rel=1e-9)


def test_forecast_horizons_and_features(trips_small):
    latest = ops.latest_trip(trips_small).first()["tpep_pickup_datetime"]
    model = ops.fit_hourly_total_model(trips_small)
    rows = {r.horizon: r for r in ops.demand_forecast(trips_small).collect()}
    assert set(rows) == {"hour", "day", "month"}
    offsets = {"hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1), "month": dt.timedelta(days=30)}
    for name, r in rows.items():
        target = latest + offsets[name]
        assert r.target_datetime == target
        # Spark's coding in training and prediction alike: 1 = Sunday.
        assert r.day_of_week == (target.isoweekday() % 7) + 1
        assert (r.hour, r.month) == (target.hour, target.month)
        features = Vectors.dense([r.hour, r.day_of_week, r.month])
        assert r.predicted_total_passengers == pytest.approx(model.predict(features), rel=1e-9)


def test_forecast_with_a_given_model_matches(trips_small):
    model = ops.fit_hourly_total_model(trips_small)
    a = sorted(tuple(r) for r in ops.demand_forecast(trips_small, model).collect())
    b = sorted(tuple(r) for r in ops.demand_forecast(trips_small).collect())
    assert [r[:-1] for r in a] == [r[:-1] for r in b]
    # Two solvers: equal but for rounding.
    assert [r[-1] for r in a] == pytest.approx([r[-1] for r in b], rel=1e-9)


def test_hourly_total_model_with_one_month_only(spark):
    # month is constant: the fit must still work (its coefficient is 0).
    rows = []
    for day in range(1, 29):
        for h in range(0, 24, 3):
            p = ts(2021, 2, day, h)
            rows.append({"tpep_pickup_datetime": p, "tpep_dropoff_datetime": p + dt.timedelta(minutes=9), "passenger_count": float((h + day) % 4)})
    row = ops.demand_lr_hourly_total(make_trips(spark, rows)).first()
    assert row.coef_month == 0.0
    assert row.r2 is not None
