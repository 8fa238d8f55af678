"""The SQL twin of every named analysis, for another engine (DuckDB).

The queries are written out separately, but fixed values (the mapping of the
test table, the holiday rules, the horizons, the digits) are imported from the
code under test, so those are not checked by the comparison.

Each query starts from the raw ``lineitem`` table, repeats the trip mapping
as a CTE and computes the result in plain SQL.  Engine differences handled
here: ``x / nullif(y, 0)`` for Spark's ``try_divide``; DuckDB's day of week
is 0 = Sunday, so 1 is added; DuckDB's calendar parts are BIGINT, cast to
INTEGER like Spark's.  Three-feature least squares is solved by Cramer's
rule over population covariances.  Double columns are rounded to the same
digits as ``catalog.round_doubles``.
"""

from __future__ import annotations

from tripscope.functions.calendar import US_FEDERAL_HOLIDAY_RULES
from tripscope.operators.demand import FORECAST_HORIZONS, NEXT_HOUR_QUERY_POINT
from tripscope.operators.seasons import SEASON_RULES
from tripscope.operators.speed import DISTANCE_BANDS
from tripscope.plans.catalog import DEFAULT_DIGITS, DIGITS
from tripscope.schema import TRIP_SCHEMA
from tripscope.sources.lineitem import (
    LINEITEM_TRIP_STAGE1,
    LINEITEM_TRIP_STAGE2,
    lineitem_trips_sql,
)


def _corr(x: str, y: str) -> str:
    """DuckDB's corr, NULL when either side of the non-NULL pairs is constant."""
    pairs = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    varies = [f"min({c}) {pairs} < max({c}) {pairs}" for c in (x, y)]
    return f"CASE WHEN {varies[0]} AND {varies[1]} THEN corr({x}, {y}) END"


def _r(expr: str, alias: str) -> str:
    return f"round({expr}, {DIGITS.get(alias, DEFAULT_DIGITS)}) AS {alias}"


_PREFIX = f"""WITH trips AS (
{lineitem_trips_sql()}
),
m AS (
  SELECT *,
    date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS trip_duration_s,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS day_of_week,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
    CAST(day(tpep_pickup_datetime) AS INTEGER) AS day_of_month,
    CAST(isoyear(tpep_pickup_datetime) AS INTEGER) AS iso_year,
    CAST(week(tpep_pickup_datetime) AS INTEGER) AS iso_week,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    trip_distance / nullif(passenger_count, 0) AS distance_per_passenger,
    tip_amount / nullif(total_amount, 0) * 100 AS tip_percentage,
    fare_amount / nullif(trip_distance, 0) AS fare_per_mile
  FROM trips
),
f AS (
  SELECT *,
    trip_duration_s / CAST(60.0 AS DOUBLE) AS trip_duration_min,
    trip_distance / nullif(trip_duration_s / CAST(3600.0 AS DOUBLE), 0) AS trip_speed_mph,
    CASE WHEN tip_percentage <= 100 THEN tip_percentage ELSE 0 END AS tip_percentage_clamped
  FROM m
)"""


def _q(body: str, ctes: str = "") -> str:
    return f"{_PREFIX}{ctes}\n{body}"


def _avg_by(key: str, measures: list[tuple[str, str]]) -> str:
    cols = ", ".join(_r(expr, alias) for expr, alias in measures)
    return _q(f"SELECT {key}, {cols} FROM f GROUP BY {key}")


_TRIP = [("avg(trip_duration_min)", "avg_duration_min"), ("avg(trip_distance)", "avg_distance")]
_TIP_PCT = [("avg(tip_percentage)", "avg_tip_percentage")]
_SPEED = [("avg(trip_speed_mph)", "avg_speed_mph")]


_MAPPED = {name for name, _ in LINEITEM_TRIP_STAGE1 + LINEITEM_TRIP_STAGE2}


def _source_profile() -> str:
    fields = [f for f in TRIP_SCHEMA.fields if f.name in _MAPPED]
    parts = [
        f"SELECT {i + 1} AS ordinal, '{f.name}' AS column_name, "
        f"'{f.dataType.simpleString()}' AS data_type, "
        f"count({f.name}) AS non_null_count, count(*) AS row_count FROM trips"
        for i, f in enumerate(fields)
    ]
    return _q("\nUNION ALL\n".join(parts))


def _holiday_case(d: str) -> str:
    whens = []
    for name, month, day, weekday, first, last, since in US_FEDERAL_HOLIDAY_RULES:
        cond = [f"month({d}) = {month}"]
        if day is not None:
            cond.append(f"day({d}) = {day}")
        else:
            cond.append(f"dayofweek({d}) + 1 = {weekday}")
            cond.append(f"day({d}) BETWEEN {first} AND {last}")
        if since is not None:
            cond.append(f"year({d}) >= {since}")
        quoted = name.replace("'", "''")
        whens.append(f"WHEN {' AND '.join(cond)} THEN '{quoted}'")
    return "CASE " + " ".join(whens) + " END"


def _ols3(train: str) -> str:
    """CTEs fitting y ~ x1 + x2 + x3 over CTE ``train``; ends in CTE ``p``
    with c1..c3, icpt, r2, rmse."""
    return f""",
s AS (
  SELECT avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my,
    covar_pop(x1, x1) AS a11, covar_pop(x1, x2) AS a12, covar_pop(x1, x3) AS a13,
    covar_pop(x2, x2) AS a22, covar_pop(x2, x3) AS a23, covar_pop(x3, x3) AS a33,
    covar_pop(x1, y) AS b1, covar_pop(x2, y) AS b2, covar_pop(x3, y) AS b3,
    var_pop(y) AS vy
  FROM {train}
),
d AS (
  SELECT *,
    a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13)
      + a13 * (a12 * a23 - a22 * a13) AS det,
    b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3)
      + a13 * (b2 * a23 - a22 * b3) AS det1,
    a11 * (b2 * a33 - b3 * a23) - b1 * (a12 * a33 - a23 * a13)
      + a13 * (a12 * b3 - b2 * a13) AS det2,
    a11 * (a22 * b3 - a23 * b2) - a12 * (a12 * b3 - b2 * a13)
      + b1 * (a12 * a23 - a22 * a13) AS det3
  FROM s
),
c AS (SELECT *, det1 / det AS c1, det2 / det AS c2, det3 / det AS c3 FROM d),
p AS (
  SELECT *, my - c1 * m1 - c2 * m2 - c3 * m3 AS icpt,
    1 - (vy - (c1 * b1 + c2 * b2 + c3 * b3)) / vy AS r2,
    sqrt(vy - (c1 * b1 + c2 * b2 + c3 * b3)) AS rmse
  FROM c
)"""


_MODEL_COLS = ", ".join(
    [
        _r("c1", "coef_hour"),
        _r("c2", "coef_day_of_week"),
        _r("c3", "coef_month"),
        _r("icpt", "intercept"),
        _r("r2", "r2"),
        _r("rmse", "rmse"),
    ]
)

_BUCKETS = """,
b AS (
  SELECT date_trunc('hour', tpep_pickup_datetime) AS hour_bucket, count(*) AS pickups
  FROM trips WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 1
),
labels AS (
  SELECT b.hour_bucket,
    CAST(hour(b.hour_bucket) AS INTEGER) AS hour,
    CAST(dayofweek(b.hour_bucket) + 1 AS INTEGER) AS day_of_week,
    CAST(month(b.hour_bucket) AS INTEGER) AS month,
    b.pickups,
    coalesce(n.pickups, 0) AS pickups_next_hour
  FROM b LEFT JOIN b AS n ON n.hour_bucket = b.hour_bucket + INTERVAL 1 HOUR
  WHERE b.hour_bucket < (SELECT max(hour_bucket) FROM b)
)"""

_CALENDAR_TRAIN = """,
train AS (
  SELECT hour AS x1, day_of_week AS x2, month AS x3, sum(passenger_count) AS y
  FROM f WHERE tpep_pickup_datetime IS NOT NULL GROUP BY hour, day_of_week, month
  HAVING sum(passenger_count) IS NOT NULL
)"""


def _next_hour_model() -> str:
    h, w, mo = NEXT_HOUR_QUERY_POINT
    ctes = (
        _BUCKETS
        + """,
train AS (SELECT hour AS x1, day_of_week AS x2, month AS x3, pickups_next_hour AS y FROM labels)"""
        + _ols3("train")
    )
    pred = f"icpt + c1 * {h} + c2 * {w} + c3 * {mo}"
    body = (
        f"SELECT {_MODEL_COLS}, {h} AS hour, {w} AS day_of_week, {mo} AS month, "
        f"{_r(pred, 'prediction')} FROM p"
    )
    return _q(body, ctes)


def _forecast() -> str:
    rows = ", ".join(f"('{n}', {d}, {hr})" for n, d, hr in FORECAST_HORIZONS)
    ctes = (
        _CALENDAR_TRAIN
        + _ols3("train")
        + f""",
hz AS (SELECT * FROM (VALUES {rows}) AS v(horizon, offset_days, offset_hours)),
pts AS (
  SELECT horizon,
    (SELECT max(tpep_pickup_datetime) FROM trips)
      + to_days(offset_days) + to_hours(offset_hours) AS target_datetime
  FROM hz
),
feat AS (
  SELECT horizon, target_datetime,
    CAST(hour(target_datetime) AS INTEGER) AS hour,
    CAST(dayofweek(target_datetime) + 1 AS INTEGER) AS day_of_week,
    CAST(month(target_datetime) AS INTEGER) AS month
  FROM pts
)"""
    )
    pred = (
        "(SELECT icpt FROM p) + (SELECT c1 FROM p) * hour"
        " + (SELECT c2 FROM p) * day_of_week + (SELECT c3 FROM p) * month"
    )
    body = (
        "SELECT horizon, target_datetime, hour, day_of_week, month, "
        f"{_r(pred, 'predicted_total_passengers')} FROM feat"
    )
    return _q(body, ctes)


def _latest_trip() -> str:
    fields = [f for f in TRIP_SCHEMA.fields if f.name in _MAPPED]
    cols = [f.name for f in fields]
    order = ["tpep_pickup_datetime"] + [c for c in cols if c != "tpep_pickup_datetime"]
    keys = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    out = ", ".join(_r(f.name, f.name) if f.dataType.typeName() == "double" else f.name for f in fields)
    return _q(f"SELECT {out} FROM (SELECT * FROM trips ORDER BY {keys} LIMIT 1) AS latest")


def _seasons(measures: list[tuple[str, str]]) -> str:
    """Days joined to the yearly ranges by their dates."""
    rules = ", ".join(f"('{n}', {a}, {b}, {c}, {d})" for n, a, b, c, d in SEASON_RULES)
    sums = ", ".join(f"sum({c}) AS s_{c}, count({c}) AS n_{c}" for c, _ in measures)
    ctes = f""",
days AS (
  SELECT pickup_date, count(*) AS n, {sums} FROM f WHERE pickup_date IS NOT NULL GROUP BY pickup_date
),
years AS (
  SELECT unnest(generate_series((SELECT min(year(pickup_date)) FROM days) - 1,
                                (SELECT max(year(pickup_date)) FROM days))) AS y
),
rules AS (SELECT * FROM (VALUES {rules}) AS v(season_name, m1, d1, m2, d2)),
ranges AS (
  SELECT season_name, make_date(y, m1, d1) AS first_day,
    make_date(y + CASE WHEN m2 * 100 + d2 < m1 * 100 + d1 THEN 1 ELSE 0 END, m2, d2) AS last_day
  FROM rules CROSS JOIN years
),
held AS (
  SELECT r.season_name, d.* FROM days d JOIN ranges r ON d.pickup_date BETWEEN r.first_day AND r.last_day
  UNION ALL
  SELECT CAST(NULL AS VARCHAR) AS season_name, d.* FROM days d
  WHERE NOT EXISTS (SELECT 1 FROM ranges r WHERE d.pickup_date BETWEEN r.first_day AND r.last_day)
)"""
    means = ", ".join(_r(f"sum(s_{c}) / nullif(sum(n_{c}), 0)", alias) for c, alias in measures)
    return _q(
        "SELECT season_name, count(*) AS days, CAST(sum(n) AS BIGINT) AS trips, "
        f"{means} FROM held GROUP BY season_name",
        ctes,
    )


def _speed_variance() -> str:
    """Within and between sums of squares from the groups' means."""
    band = " + ".join(f"CASE WHEN trip_distance >= {edge} THEN 1 ELSE 0 END" for edge in DISTANCE_BANDS)
    keys = "PULocationID, DOLocationID"
    same = "a.PULocationID IS NOT DISTINCT FROM b.PULocationID AND a.DOLocationID IS NOT DISTINCT FROM b.DOLocationID"
    ctes = f""",
v AS (SELECT {keys}, hour, {band} AS band, trip_speed_mph AS x FROM f WHERE trip_speed_mph IS NOT NULL),
cells AS (
  SELECT {keys}, hour, band, count(x) AS n, avg(x) AS mean, var_pop(x) * count(x) AS m2
  FROM v GROUP BY {keys}, hour, band
),
hours AS (SELECT {keys}, hour, count(x) AS n, avg(x) AS mean, var_pop(x) * count(x) AS m2 FROM v GROUP BY {keys}, hour),
hour_parts AS (SELECT {keys}, sum(m2) AS in_hours FROM hours GROUP BY {keys}),
cell_parts AS (SELECT {keys}, sum(m2) AS within FROM cells GROUP BY {keys}),
pairs AS (SELECT {keys}, count(x) AS n, avg(x) AS mean, var_pop(x) * count(x) AS m2 FROM v GROUP BY {keys}),
parts AS (
  SELECT a.*, b.in_hours, c.within FROM pairs a JOIN hour_parts b ON {same}
  JOIN cell_parts c ON {same.replace("b.", "c.")}
)"""
    part = "greatest({}, 0) / n"
    cols = [
        _r("mean", "avg_speed_mph"),
        _r(part.format("m2"), "var_total"),
        _r(part.format("m2 - in_hours"), "var_between_hours"),
        _r(part.format("in_hours - within"), "var_between_bands"),
        _r(part.format("within"), "var_within"),
        _r("CASE WHEN n > 1 THEN within / nullif(m2, 0) END", "similar_share"),
    ]
    return _q(f"SELECT {keys}, n AS trips, {', '.join(cols)} FROM parts", ctes)


def _elapsed() -> str:
    """New York clocks by the rules of 1987-2006 and since: the offset of a
    wall time, an hour more in summer.  The hour that the forward change skips
    (2 to 3) is read with the clocks not yet moved."""

    def first_sunday(month: int, least: int) -> str:
        day = f"make_date(y, {month}, {least})"
        return f"{day} + CAST((7 - dayofweek({day})) % 7 AS INTEGER)"

    ctes = f""",
years AS (
  SELECT unnest(generate_series((SELECT min(year(pickup_date)) FROM f) - 1,
                                (SELECT max(year(pickup_date)) FROM f) + 1)) AS y
),
changes AS (
  SELECT y,
    CAST(CASE WHEN y < 2007 THEN {first_sunday(4, 1)} ELSE {first_sunday(3, 8)} END AS TIMESTAMP)
      + INTERVAL 3 HOUR AS forward,
    CAST(CASE WHEN y < 2007 THEN {first_sunday(10, 25)} ELSE {first_sunday(11, 1)} END AS TIMESTAMP)
      + INTERVAL 2 HOUR AS back
  FROM years
),
e AS (
  SELECT f.month, f.trip_duration_s,
    f.trip_duration_s
      + 3600 * (CASE WHEN f.tpep_pickup_datetime >= p.forward AND f.tpep_pickup_datetime < p.back THEN 1 ELSE 0 END)
      - 3600 * (CASE WHEN f.tpep_dropoff_datetime >= d.forward AND f.tpep_dropoff_datetime < d.back THEN 1 ELSE 0 END)
      AS elapsed_s
  FROM f LEFT JOIN changes p ON p.y = year(f.tpep_pickup_datetime)
         LEFT JOIN changes d ON d.y = year(f.tpep_dropoff_datetime)
)"""
    return _q(
        "SELECT month, count(*) AS trips, count(*) FILTER (WHERE elapsed_s <> trip_duration_s) AS trips_over_change, "
        + _r("avg(trip_duration_s) / 60.0", "avg_wall_min")
        + ", "
        + _r("avg(elapsed_s) / 60.0", "avg_elapsed_min")
        + " FROM e GROUP BY month",
        ctes,
    )


def _rolling_error() -> str:
    """Running sums of products over the months, eliminated feature by feature."""
    k, x = 3, ["1.0", "hour", "day_of_week", "month", "pickups_next_hour"]
    pairs = [(i, j) for i in range(k + 2) for j in range(i, k + 2)]
    inner = [(i, j) for i, j in pairs if i > 0]
    sums = ", ".join(f"sum(CAST({x[i]} AS DOUBLE) * {x[j]}) AS t_{i}_{j}" for i, j in pairs)
    over = "OVER (ORDER BY y, mo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    running = ", ".join(f"sum(t_{i}_{j}) {over} AS s_{i}_{j}" for i, j in pairs)
    central = ", ".join(f"s_{i}_{j} / s_0_0 - (s_0_{i} / s_0_0) * (s_0_{j} / s_0_0) AS c_{i}_{j}" for i, j in inner)
    central += "".join(f", s_{i}_{i} / s_0_0 - (s_0_{i} / s_0_0) * (s_0_{i} / s_0_0) AS v_{i}" for i in range(1, k + 1))
    steps, last = [], "z0"
    for p in range(1, k + 1):
        keep = f"(v_{p} > 0 AND c_{p}_{p} > 1e-9 * v_{p})"

        def c(i: int, j: int) -> str:
            return f"c_{min(i, j)}_{max(i, j)}"

        new = []
        for i, j in inner:
            if i == p and j == p:
                value = f"-1 / nullif({c(p, p)}, 0)"
            elif p in (i, j):
                value = f"{c(i, j)} / nullif({c(p, p)}, 0)"
            else:
                value = f"{c(i, j)} - {c(i, p)} * {c(p, j)} / nullif({c(p, p)}, 0)"
            new.append(f"CASE WHEN {keep} THEN {value} ELSE {c(i, j)} END AS c_{i}_{j}")
        others = [f"t_{i}_{j}, s_{i}_{j}" for i, j in pairs] + [f"v_{i}" for i in range(1, k + 1)]
        others += [f"k_{q}" for q in range(1, p)] + [f"CASE WHEN {keep} THEN 1 ELSE 0 END AS k_{p}"]
        steps.append(f"z{p} AS (SELECT y, mo, {', '.join(others + new)} FROM {last})")
        last = f"z{p}"
    betas = ", ".join(f"CASE WHEN k_{p} = 1 THEN c_{p}_{k + 1} ELSE 0 END AS b_{p}" for p in range(1, k + 1))
    w = [f"(-(s_0_{k + 1} / s_0_0" + "".join(f" - b_{p} * s_0_{p} / s_0_0" for p in range(1, k + 1)) + "))"]
    w += [f"(-b_{p})" for p in range(1, k + 1)] + ["1"]
    squares = " + ".join(f"{w[i]} * {w[j]} * t_{i}_{j}" + (" * 2" if i != j else "") for i, j in pairs)
    mean = f"(s_0_{k + 1} / s_0_0)"
    off = f"t_{k + 1}_{k + 1} - 2 * {mean} * t_0_{k + 1} + {mean} * {mean} * t_0_0"
    ctes = (
        _BUCKETS
        + f""",
mo AS (
  SELECT CAST(year(hour_bucket) AS INTEGER) AS y, CAST(month(hour_bucket) AS INTEGER) AS mo, {sums}
  FROM labels GROUP BY 1, 2
),
r AS (SELECT *, {running} FROM mo),
z0 AS (SELECT *, {central} FROM r WHERE s_0_0 > 0),
{", ".join(steps)},
fit AS (SELECT *, {betas} FROM {last})"""
    )
    cols = [
        "y AS test_year",
        "mo AS test_month",
        "CAST(s_0_0 AS BIGINT) AS train_hours",
        "CAST(t_0_0 AS BIGINT) AS test_hours",
        _r(f"sqrt(greatest(({squares}) / t_0_0, 0))", "rmse"),
        _r(f"sqrt(greatest(c_{k + 1}_{k + 1}, 0))", "train_rmse"),
        _r(f"sqrt(greatest(({off}) / t_0_0, 0))", "mean_rmse"),
    ]
    return _q(f"SELECT {', '.join(cols)} FROM fit", ctes)


_R2 = "regr_r2(passenger_count, hour)"


def oracle_sql() -> dict[str, str]:
    """Key -> DuckDB SQL over the raw test tables, one per catalogue entry."""
    od = "PULocationID, DOLocationID"
    cal = "hour, day_of_week, month"
    q = {
        "source_profile": _source_profile(),
        "trip_by_hour": _avg_by("hour", _TRIP),
        "trip_by_day_of_week": _avg_by("day_of_week", _TRIP),
        "trip_by_month": _avg_by("month", _TRIP),
        "duration_by_day_of_month": _avg_by(
            "day_of_month", [("avg(trip_duration_min)", "avg_duration_min")]
        ),
        "elapsed_by_month": _elapsed(),
        "trip_by_season": _seasons([("trip_duration_min", "avg_duration_min"), ("trip_distance", "avg_distance")]),
        "tip_pct_by_season": _seasons([("tip_percentage", "avg_tip_percentage")]),
        "speed_variance_by_od": _speed_variance(),
        "demand_rolling_error": _rolling_error(),
        "trip_by_hour_dow_month": _q(
            f"SELECT {cal}, {_r('avg(trip_duration_s)', 'avg_duration_s')}, "
            f"{_r('avg(distance_per_passenger)', 'avg_distance_per_passenger')} "
            f"FROM f GROUP BY {cal}"
        ),
        "trip_calendar_sets": _q(
            "SELECT CASE WHEN grouping(hour) = 0 THEN 'hour' "
            "WHEN grouping(day_of_week) = 0 THEN 'day_of_week' ELSE 'month' END AS \"grouping\", "
            f"{cal}, {_r('avg(trip_duration_min)', 'avg_duration_min')}, "
            f"{_r('avg(trip_distance)', 'avg_distance')} "
            "FROM f GROUP BY GROUPING SETS ((hour), (day_of_week), (month))"
        ),
        "pickup_counts": _q(
            'SELECT PULocationID, count(*) AS "count" FROM trips GROUP BY PULocationID'
        ),
        "dropoff_counts": _q(
            'SELECT DOLocationID, count(*) AS "count" FROM trips GROUP BY DOLocationID'
        ),
        "top_pickups": _q(
            'SELECT PULocationID, count(*) AS "count" FROM trips GROUP BY PULocationID '
            'ORDER BY "count" DESC, PULocationID LIMIT 10'
        ),
        "top_dropoffs": _q(
            'SELECT DOLocationID, count(*) AS "count" FROM trips GROUP BY DOLocationID '
            'ORDER BY "count" DESC, DOLocationID LIMIT 10'
        ),
        "tip_pct_by_hour": _avg_by("hour", _TIP_PCT),
        "tip_pct_by_day_of_week": _avg_by("day_of_week", _TIP_PCT),
        "tip_pct_by_month": _avg_by("month", _TIP_PCT),
        "tip_ratio_by_pickup": _q(
            "SELECT PULocationID, "
            + _r("avg(tip_amount) / nullif(avg(total_amount), 0) * 100", "tip_percentage")
            + " FROM trips GROUP BY PULocationID"
        ),
        "tip_amount_by_hour": _avg_by("hour", [("avg(tip_amount)", "avg_tip_amount")]),
        "tip_amount_by_payment": _avg_by(
            "payment_type", [("avg(tip_amount)", "avg_tip_amount")]
        ),
        "tip_clamped_by_od": _q(
            f"SELECT {od}, {_r('avg(tip_percentage_clamped)', 'avg_tip_percentage')}, "
            f"{_r('avg(trip_distance)', 'avg_distance')} FROM f GROUP BY {od}"
        ),
        "tip_clamped_by_hour_dow_month": _q(
            f"SELECT {cal}, {_r('avg(tip_percentage_clamped)', 'avg_tip_percentage')}, "
            f"{_r('sum(tip_amount)', 'total_tip_amount')} FROM f GROUP BY {cal}"
        ),
        "tip_clamped_by_payment": _q(
            f"SELECT payment_type, {_r('avg(tip_percentage_clamped)', 'avg_tip_percentage')}, "
            f"{_r('avg(tip_amount)', 'avg_tip_amount')}, "
            f"{_r('sum(tip_amount)', 'total_tip_amount')} FROM f GROUP BY payment_type"
        ),
        "fare_by_od": _q(f"SELECT {od}, {_r('avg(fare_amount)', 'avg_fare')} FROM trips GROUP BY {od}"),
        "fare_by_passengers": _q(
            f"SELECT passenger_count, {_r('avg(fare_amount)', 'avg_fare')} "
            "FROM trips GROUP BY passenger_count"
        ),
        "fare_distance_corr": _q(
            f"SELECT {_r(_corr('fare_amount', 'trip_distance'), 'correlation')} FROM trips"
        ),
        "fare_per_mile_distance_corr": _q(
            f"SELECT {_r(_corr('fare_per_mile', 'trip_distance'), 'correlation')} FROM f"
        ),
        "speed_by_hour": _avg_by("hour", _SPEED),
        "speed_by_day_of_week": _avg_by("day_of_week", _SPEED),
        "speed_by_month": _avg_by("month", _SPEED),
        "speed_by_pickup_hour": _q(
            f"SELECT PULocationID, hour, {_r('avg(trip_speed_mph)', 'avg_speed_mph')} "
            "FROM f GROUP BY PULocationID, hour"
        ),
        "speed_by_od_hour_dow_month": _q(
            f"SELECT {od}, {cal}, {_r('avg(trip_speed_mph)', 'avg_speed_mph')} "
            f"FROM f GROUP BY {od}, {cal}"
        ),
        "tip_distance_corr": _q(
            f"SELECT {_r(_corr('tip_percentage', 'trip_distance'), 'correlation')} FROM f"
        ),
        "fare_passenger_corr": _q(
            f"SELECT {_r(_corr('passenger_count', 'fare_amount'), 'correlation')} FROM trips"
        ),
        "tip_pct_by_year_week": _q(
            "SELECT iso_year, iso_week, count(*) AS trips, "
            f"{_r('avg(tip_percentage)', 'avg_tip_percentage')} "
            "FROM f GROUP BY iso_year, iso_week"
        ),
        "trip_by_holiday": _q(
            "SELECT holiday_name, count(DISTINCT pickup_date) AS days, count(*) AS trips, "
            f"{_r('avg(trip_duration_min)', 'avg_duration_min')}, {_r('avg(trip_distance)', 'avg_distance')} "
            "FROM h GROUP BY holiday_name",
            f",\nh AS (SELECT *, {_holiday_case('pickup_date')} AS holiday_name FROM f "
            "WHERE pickup_date IS NOT NULL)",
        ),
        "tip_pct_by_holiday": _q(
            "SELECT holiday_name, count(DISTINCT pickup_date) AS days, count(*) AS trips, "
            f"{_r('avg(tip_percentage)', 'avg_tip_percentage')} FROM h GROUP BY holiday_name",
            f",\nh AS (SELECT *, {_holiday_case('pickup_date')} AS holiday_name FROM f "
            "WHERE pickup_date IS NOT NULL)",
        ),
        "speed_spread_by_od": _q(
            f"SELECT {od}, count(trip_speed_mph) AS trips, "
            f"{_r('avg(trip_speed_mph)', 'avg_speed_mph')}, "
            f"{_r('stddev_samp(trip_speed_mph)', 'stddev_speed_mph')}, "
            f"{_r('stddev_samp(trip_speed_mph) / nullif(avg(trip_speed_mph), 0)', 'speed_cv')} "
            f"FROM f GROUP BY {od}"
        ),
        "speed_by_od_week": _q(
            f"SELECT {od}, iso_week AS week_of_year, "
            f"{_r('avg(trip_speed_mph)', 'avg_speed_mph')} FROM f GROUP BY {od}, iso_week"
        ),
        "demand_lr_passengers": _q(
            "SELECT "
            + ", ".join(
                [
                    _r("regr_slope(passenger_count, hour)", "coefficient"),
                    _r("regr_intercept(passenger_count, hour)", "intercept"),
                    _r(f"CASE WHEN {_R2} > 1 THEN 1 ELSE {_R2} END", "r2"),
                    _r(
                        f"sqrt(regr_syy(passenger_count, hour) * CASE WHEN {_R2} > 1 THEN 0 ELSE 1 - {_R2} END"
                        " / regr_count(passenger_count, hour))",
                        "rmse",
                    ),
                    "CAST(regr_count(passenger_count, hour) AS BIGINT) AS n",
                ]
            )
            + " FROM f WHERE hour IS NOT NULL AND passenger_count IS NOT NULL"
        ),
        "next_hour_labels": _q("SELECT * FROM labels", _BUCKETS),
        "demand_lr_next_hour": _next_hour_model(),
        "hourly_totals": _q(
            "SELECT hour, "
            + _r("sum(passenger_count)", "total_passengers")
            + ", count(*) AS pickups FROM f GROUP BY hour"
        ),
        "calendar_totals": _q(
            f"SELECT {cal}, "
            + _r("sum(passenger_count)", "total_passengers")
            + f", count(*) AS pickups FROM f GROUP BY {cal}"
        ),
        "demand_lr_hourly_total": _q(f"SELECT {_MODEL_COLS} FROM p", _CALENDAR_TRAIN + _ols3("train")),
        "latest_trip": _latest_trip(),
        "demand_forecast": _forecast(),
    }
    return q
