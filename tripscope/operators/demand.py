"""Demand: hourly labels, linear regressions and forecasts.

Scale notes
-----------
* The per-trip regression (one feature) is ordinary least squares in closed
  form: ``regr_slope`` / ``regr_intercept`` / ``regr_r2`` are declarative
  aggregates, so the whole fit is one codegen'd partial/final aggregate over
  the trips -- the same numbers ``LinearRegression`` gives without
  regularisation, without shipping every trip through a vector column.
  ``fit_passenger_model`` returns the ``pyspark.ml`` model for callers who
  want the model object itself.
* The three-feature models are trained on *aggregated* tables (one row per
  hour bucket or per calendar cell), whose size is bounded by the time span
  and the calendar, not by the number of trips.  Their results come from sums
  of products (``functions.least_squares``): one more aggregate on top, solved
  by column expressions, so a model is one pass, with no driver step and no
  checkpoint.  ``fit_*`` return ``pyspark.ml`` models for callers who want the
  model object; those estimators make several passes, over a checkpoint.
* Next-hour labels: every hour count is sent to its own bucket and to the one
  before it, and a second aggregate puts the two together.  No join, no
  ``lead`` over a global window (one task, and it would skip gaps).
* ``demand_rolling_error`` judges the next-hour model out of sample, month by
  month: sums of products per month, added up over the months before, give the
  model of each origin and its error on the month that follows, without
  fitting or scanning again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripscope.functions import calendar_keys, least_squares, pickup
from tripscope.operators.ordering import sort_bounded
from tripscope.operators.trips import CALENDAR_KEYS
from tripscope.schema import PICKUP
from tripscope.session import materialize

# The point the next-hour model is asked about (hour of day,
# day of week, month), and the forecast horizons after the latest pickup.
NEXT_HOUR_QUERY_POINT = (18, 2, 7)
FORECAST_HORIZONS = (("hour", 0, 1), ("day", 1, 0), ("month", 30, 0))  # (name, days, hours)


# ---------------------------------------------------------------- helpers


def _fit(train: DataFrame, features: list[str], label: str) -> LinearRegressionModel | None:
    """Unregularised least squares with an intercept (the normal equations,
    one distributed pass; the tiny solve happens on the driver).  None when
    there is nothing to fit (no training rows)."""
    if train.isEmpty():
        return None
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(
        train.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("double"))
    )
    return LinearRegression(featuresCol="features", labelCol=label, solver="normal").fit(
        assembled
    )


# ---------------------------------------------------------------- per-trip


def _labelled(trips: DataFrame) -> DataFrame:
    # The ML estimators reject NULL; only rows with both values are used.
    return trips.select(
        calendar_keys()["hour"].alias("hour"), F.col("passenger_count")
    ).where(F.col("hour").isNotNull() & F.col("passenger_count").isNotNull())


def demand_lr_passengers(trips: DataFrame) -> DataFrame:
    """Per-trip ``passenger_count ~ hour``: coefficient, intercept, R^2, RMSE.

    RMSE is the training RMSE, ``sqrt(SS_res / n)`` with
    ``SS_res = S_yy * (1 - R^2)``.
    """
    t = _labelled(trips)
    y, x = F.col("passenger_count"), F.col("hour").cast("double")
    stats = t.agg(
        F.regr_slope(y, x).alias("coefficient"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_syy(y, x).alias("__syy"),
        F.regr_count(y, x).alias("n"),
    )
    return stats.select(
        "coefficient",
        "intercept",
        # R^2 of an exact fit can come out a rounding error above 1.
        F.when(F.col("r2") > 1, F.lit(1.0)).otherwise(F.col("r2")).alias("r2"),
        F.sqrt(
            F.try_divide(
                F.col("__syy") * F.when(F.col("r2") > 1, F.lit(0.0)).otherwise(1 - F.col("r2")),
                F.col("n"),
            )
        ).alias("rmse"),
        "n",
    )


def fit_passenger_model(trips: DataFrame) -> LinearRegressionModel | None:
    """The same per-trip regression as a fitted ``pyspark.ml`` model (None
    without usable rows).  The estimator makes several passes over the trips
    as vectors, uncached; ``demand_lr_passengers`` needs one aggregate."""
    return _fit(_labelled(trips), ["hour"], "passenger_count")


# ---------------------------------------------------------------- aggregates


def hourly_totals(trips: DataFrame) -> DataFrame:
    """Passengers carried and pickups per hour of day (24 rows)."""
    return (
        trips.groupBy(calendar_keys()["hour"].alias("hour"))
        .agg(
            F.sum("passenger_count").alias("total_passengers"),
            F.count(F.lit(1)).alias("pickups"),
        )
        .transform(sort_bounded, "hour")
    )


def calendar_totals(trips: DataFrame) -> DataFrame:
    """Passengers carried and pickups per hour x day of week x month cell:
    the training table of the hourly-total model.  Grouping by all three
    features makes them constant within a row."""
    return (
        trips.withColumns(calendar_keys())
        .groupBy(*CALENDAR_KEYS)
        .agg(
            F.sum("passenger_count").alias("total_passengers"),
            F.count(F.lit(1)).alias("pickups"),
        )
        .transform(sort_bounded, *CALENDAR_KEYS)
    )


# Most files that a second, filtered pass names; with ties over more files than
# this it reads them all.
LATEST_FILES = 1_000


def latest_trip(trips: DataFrame) -> DataFrame:
    """The whole row of the latest trip by pickup time.

    The latest pickup comes first, from the pickup column alone; then the rows
    of that instant, so whole rows are compared only among those.  For trips in
    several files the first step is taken file by file, and the second reads
    the files that hold the instant and no others (row groups are not skipped
    on a timestamp without time zone, files are).  A stream takes one
    aggregate.  Ties on the pickup, within and across files, are broken by the
    other columns (maximum of a struct led by the pickup), so the answer is
    deterministic, unlike ``max_by``.
    """
    found = trips.where(F.col(PICKUP).isNotNull())
    if trips.isStreaming:
        pass
    elif _from_files(trips):
        newest = found.groupBy(_file().alias("file")).agg(F.max(PICKUP).alias("latest"))
        top = newest.orderBy(F.desc("latest"), "file").limit(LATEST_FILES + 1).collect()
        files = [r.file for r in top if r.latest == top[0].latest]
        if files:
            found = found.where(F.col(PICKUP) == F.lit(top[0].latest))
        if 0 < len(files) <= LATEST_FILES:
            found = found.where(_file().isin(files))
    else:
        found = found.where(F.col(PICKUP) == trips.agg(F.max(PICKUP)).scalar())
    others = [c for c in trips.columns if c != PICKUP]
    row = F.max(F.struct(F.col(PICKUP), *[F.col(f"`{c}`") for c in others]))
    return found.agg(row.alias("latest")).select(*[F.col(f"latest.`{c}`").alias(c) for c in trips.columns])


def _file() -> Column:
    return F.col("_metadata.file_path")


def _from_files(trips: DataFrame) -> bool:
    """Whether the rows lie in several files and know which."""
    try:
        trips.select(_file())
    except AnalysisException:
        return False
    return len(trips.inputFiles()) > 1


def _hour_bucket(date: Column, hour: Column) -> Column:
    """Start of the clock hour, as wall-clock time (no time zone involved)."""
    return date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour, F.lit(0), F.lit(0))


def next_hour_labels(trips: DataFrame) -> DataFrame:
    """One row per hour bucket holding pickups: its calendar features, its
    pickups and the pickups of the following clock hour (0 when that hour has
    none).  The last bucket is dropped: its next hour lies beyond the data.
    Ordered by the bucket.
    """
    return _next_hour_table(trips).orderBy("hour_bucket")


def _next_hour_table(trips: DataFrame) -> DataFrame:
    """``next_hour_labels`` without the final ordering (the model does not
    need its training rows sorted)."""
    # The one pass over the trips, to one row an hour.  The key is the date and
    # the hour; the bucket's timestamp is made once per bucket, after the
    # aggregate, not once per trip.
    buckets = (
        trips.where(pickup().isNotNull())
        .groupBy(F.to_date(pickup()).alias("date"), F.hour(pickup()).alias("hour"))
        .agg(F.count(F.lit(1)).alias("pickups"))
        .select(_hour_bucket(F.col("date"), F.col("hour")).alias("hour_bucket"), "pickups")
    )
    # The last bucket comes from the same exchange (same columns, so Spark
    # reuses it): the trips are not scanned again.
    last = buckets.agg(F.max(F.struct("hour_bucket", "pickups")).alias("m")).select("m.hour_bucket").scalar()
    none = F.lit(None).cast("bigint")
    here = F.struct(F.col("hour_bucket"), F.col("pickups").alias("own"), none.alias("after"))
    before = F.struct(
        (F.col("hour_bucket") - F.expr("INTERVAL 1 HOUR")).alias("hour_bucket"), none.alias("own"), F.col("pickups").alias("after")
    )
    bucket = F.col("hour_bucket")
    return (
        buckets.select(F.inline(F.array(here, before)))
        .groupBy("hour_bucket")
        .agg(F.max("own").alias("pickups"), F.max("after").alias("after"))
        .where(F.col("pickups").isNotNull() & (bucket < last))
        .select(
            "hour_bucket",
            *[c.alias(k) for k, c in calendar_keys(bucket).items()],
            "pickups",
            F.coalesce("after", F.lit(0).cast("bigint")).alias("pickups_next_hour"),
        )
    )


# ---------------------------------------------------------------- models


N_FEATURES = len(CALENDAR_KEYS)


def _sums(label: str, prefix: str = "s") -> list[Column]:
    return least_squares.product_sums([F.col(c) for c in CALENDAR_KEYS], F.col(label), prefix)


def _solved(sums: DataFrame) -> DataFrame:
    """A row's coefficients, R^2 and training RMSE under their result names."""
    solved = least_squares.solve(sums, N_FEATURES)
    return solved.withColumns(
        {
            **{f"coef_{c}": F.col(f"beta_{p + 1}") for p, c in enumerate(CALENDAR_KEYS)},
            "intercept": F.col("beta_0"),
            "r2": least_squares.r_squared(),
            "rmse": F.sqrt("mse"),
        }
    )


MODEL_COLUMNS = (*[f"coef_{c}" for c in CALENDAR_KEYS], "intercept", "r2", "rmse")


def fit_next_hour_model(trips: DataFrame) -> LinearRegressionModel | None:
    """``pickups_next_hour ~ hour + day_of_week + month`` over hour buckets."""
    train = materialize(_next_hour_table(trips).drop("hour_bucket"))
    return _fit(train, list(CALENDAR_KEYS), "pickups_next_hour")


def demand_lr_next_hour(trips: DataFrame, point: tuple[int, int, int] = NEXT_HOUR_QUERY_POINT) -> DataFrame:
    """Next-hour pickup model: coefficients, intercept, R^2, RMSE and the
    prediction at ``point`` (hour, day of week, month)."""
    solved = _solved(_next_hour_table(trips).agg(*_sums("pickups_next_hour")))
    at = [F.lit(v) for v in point]
    return solved.select(
        *MODEL_COLUMNS,
        *[v.cast("int").alias(c) for c, v in zip(CALENDAR_KEYS, at)],
        least_squares.predict(at).alias("prediction"),
    )


def demand_rolling_error(trips: DataFrame) -> DataFrame:
    """The next-hour model out of sample, one row per month but the first:
    fitted on all hours before the month, judged on the hours of the month.

    ``train_hours``, ``test_hours``, ``rmse`` on the month, ``train_rmse`` and
    ``mean_rmse``, the error of always predicting the training mean.  Sums of
    products per month and their running totals are all it needs: the rows
    are aggregated once, and the running totals go over one row a month.
    """
    months = (
        _next_hour_table(trips)
        .groupBy(F.year("hour_bucket").alias("test_year"), F.month("hour_bucket").alias("test_month"))
        .agg(*_sums("pickups_next_hour", "t"))
    )
    before = Window.orderBy("test_year", "test_month").rowsBetween(Window.unboundedPreceding, -1)
    names = zip(least_squares.sum_names(N_FEATURES), least_squares.sum_names(N_FEATURES, "t"))
    sums = months.withColumns({s: F.sum(t).over(before) for s, t in names}).where(F.col("s_0_0") > 0)
    label = N_FEATURES + 1
    mean = F.try_divide(F.col(f"s_0_{label}"), F.col("s_0_0"))
    off = F.col(f"t_{label}_{label}") - 2 * mean * F.col(f"t_0_{label}") + mean * mean * F.col("t_0_0")
    return (
        _solved(sums)
        .select(
            "test_year",
            "test_month",
            F.col("s_0_0").cast("bigint").alias("train_hours"),
            F.col("t_0_0").cast("bigint").alias("test_hours"),
            F.sqrt(least_squares.mean_squared_error(N_FEATURES, "t")).alias("rmse"),
            F.col("rmse").alias("train_rmse"),
            F.sqrt(least_squares.not_negative(F.try_divide(off, F.col("t_0_0")))).alias("mean_rmse"),
        )
        .transform(sort_bounded, "test_year", "test_month")
    )


def _calendar_training(trips: DataFrame) -> DataFrame:
    """Training table of the hourly-total model: one row per calendar cell
    with its passengers and its latest pickup (so a forecast needs no second
    pass over the trips to find the latest one)."""
    # Trips without a pickup time have no calendar cell; the filter reaches
    # the scan.
    return (
        trips.where(pickup().isNotNull())
        .withColumns(calendar_keys())
        .groupBy(*CALENDAR_KEYS)
        .agg(
            F.sum("passenger_count").alias("total_passengers"),
            F.max(PICKUP).alias("latest_pickup"),
        )
    )


def fit_hourly_total_model(trips: DataFrame) -> LinearRegressionModel | None:
    """``total_passengers ~ hour + day_of_week + month`` over calendar cells."""
    train = materialize(_calendar_training(trips)).where(F.col("total_passengers").isNotNull())
    return _fit(train, list(CALENDAR_KEYS), "total_passengers")


def demand_lr_hourly_total(trips: DataFrame) -> DataFrame:
    """The hourly-total model: coefficients, intercept, R^2, RMSE."""
    return _solved(_calendar_training(trips).agg(*_sums("total_passengers"))).select(*MODEL_COLUMNS)


def demand_forecast(trips: DataFrame, model: LinearRegressionModel | None = None) -> DataFrame:
    """Predicted passengers for the hour after the latest pickup, the same
    time next day and 30 days on, from the hourly-total model (or a given one).

    One aggregate of the calendar cells yields the model and the latest
    pickup; the horizons and their calendar features (day of week coded as in
    training) are columns of its one row, so nothing passes through the driver.
    """
    latest = F.max("latest_pickup").alias("latest")
    horizons = F.array(
        *[
            F.struct(F.lit(name).alias("horizon"), F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(0), F.lit(0)).alias("ahead"))
            for name, days, hours in FORECAST_HORIZONS
        ]
    )
    if model is None:
        base = _solved(_calendar_training(trips).agg(latest, *_sums("total_passengers")))
    else:
        base = trips.agg(F.max(PICKUP).alias("latest"))
    points = base.select("*", F.inline(horizons)).withColumn("target_datetime", F.col("latest") + F.col("ahead"))
    points = points.withColumns(calendar_keys(F.col("target_datetime")))
    if model is None:
        points = points.withColumn("prediction", least_squares.predict([F.col(c) for c in CALENDAR_KEYS]))
    else:
        assembler = VectorAssembler(inputCols=list(CALENDAR_KEYS), outputCol="features")
        points = model.transform(assembler.transform(points))
    return points.select(
        "horizon",
        "target_datetime",
        *CALENDAR_KEYS,
        F.col("prediction").alias("predicted_total_passengers"),
    )
