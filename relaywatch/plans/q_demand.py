"""Registered demand queries: ``events`` as demand rows (item = event_type,
time = ts, quantity = props.k), receipts and lineitem at larger volume."""

from __future__ import annotations

from pyspark.sql import functions as F

from relaywatch.operators import demand as M
from relaywatch.plans.registry import register, rounded, table
from relaywatch.plans.sqlviews import RECEIPTS
from relaywatch.sources.orders import receipts

_EVENTS_SQL = """WITH
rows_ AS (SELECT event_type AS item, ts, TRY_CAST(json_extract(props, '$.k') AS INT) AS quantity
          FROM events),
series AS (SELECT item, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INT) AS hour,
                  CAST(sum(quantity) AS BIGINT) AS quantity
           FROM rows_ GROUP BY item, CAST(ts AS DATE), hour(ts))"""


def event_rows(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(F.col("event_type").alias("item"), "ts",
                     F.from_json("props", "k int")["k"].alias("quantity"))


def event_series(spark, sf):
    return M.hourly_demand(event_rows(spark, sf))


def _out(df):
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("a7_hourly_demand", _EVENTS_SQL + """
SELECT item, strftime(d, '%Y-%m-%d') AS date, hour, quantity FROM series""")
def a7_hourly_demand(spark, sf):
    return _out(event_series(spark, sf))


@register("x4_a7_receipt_demand", "WITH " + RECEIPTS + """
SELECT item_name AS item, strftime(CAST("timestamp" AS TIMESTAMP), '%Y-%m-%d') AS date,
       CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INT) AS hour,
       CAST(sum(quantity) AS BIGINT) AS quantity
FROM receipts GROUP BY 1, 2, 3""")
def x4_a7_receipt_demand(spark, sf):
    r = receipts(spark, sf).withColumn("ts", M.parse_time("timestamp"))
    return _out(M.hourly_demand(r, item_col="item_name"))


@register("a7_lineitem_demand", """
SELECT p_type AS item, strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS date,
       CAST(hour(l_shipdate) AS INT) AS hour, round(sum(l_quantity), 6) AS quantity
FROM lineitem JOIN part ON p_partkey = l_partkey
GROUP BY 1, 2, 3""")
def a7_lineitem_demand(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_shipdate")
    pt = table(spark, sf, "part").select("p_partkey", "p_type")
    j = li.join(pt, li.l_partkey == pt.p_partkey)
    return rounded(_out(M.hourly_demand(j, item_col="p_type", ts_col="l_shipdate",
                                        qty_col="l_quantity")))


@register("w5_min_series", _EVENTS_SQL + """
SELECT item, strftime(d, '%Y-%m-%d') AS date, hour, quantity, n_points
FROM (SELECT *, count(*) OVER (PARTITION BY item) AS n_points FROM series)
WHERE n_points >= 3""")
def w5_min_series(spark, sf):
    return _out(M.min_length(event_series(spark, sf)))


@register("l4_series_order", _EVENTS_SQL + """
SELECT item, strftime(d, '%Y-%m-%d') AS date, hour, quantity,
       CAST(row_number() OVER (PARTITION BY item ORDER BY d, hour) AS INTEGER) AS position
FROM series""")
def l4_series_order(spark, sf):
    return _out(M.ordered(event_series(spark, sf)))


@register("m2_lag_regression", _EVENTS_SQL + """
SELECT item, count(*) AS n_pairs,
       round(regr_slope(CAST(quantity AS DOUBLE), CAST(prev AS DOUBLE)), 6) AS slope,
       round(regr_intercept(CAST(quantity AS DOUBLE), CAST(prev AS DOUBLE)), 6) AS intercept
FROM (SELECT *, lag(quantity) OVER (PARTITION BY item ORDER BY d, hour) AS prev FROM series)
WHERE prev IS NOT NULL GROUP BY item""")
def m2_lag_regression(spark, sf):
    return rounded(M.lag_regression(event_series(spark, sf)))


@register("m1_demand_model", _EVENTS_SQL + """
SELECT item, count(*) AS n_points, true AS stationary, true AS finite, true AS converged,
       true AS not_above_lag
FROM series GROUP BY item HAVING count(*) >= 3""")
def m1_demand_model(spark, sf):
    """ARMA(1,1) by conditional least squares per item, by the checks that every
    fit meets: one model for each item with enough points, inside the stationary
    region, with finite estimates, converged, and with a residual sum of squares
    not above that of the lag regression (M2). ``m1_coefficients`` has the
    coefficients."""
    s = event_series(spark, sf)
    m = M.demand_models(s).join(M.lag_residuals(s), "item")
    finite = (~F.isnan("const")) & (~F.isnan("sigma2")) & (F.col("sigma2") >= 0)
    sse = F.col("sigma2") * (F.col("n_points") - 1)
    return m.select("item", F.col("n_points").cast("long").alias("n_points"),
                    ((F.abs("ar1") < 1) & (F.abs("ma1") < 1)).alias("stationary"),
                    finite.alias("finite"), "converged",
                    (sse <= F.col("lag_sse") * (1 + 1e-9) + 1e-9).alias("not_above_lag"))


@register("m1_coefficients")
def m1_coefficients(spark, sf):
    """The fitted coefficients of both estimators per item."""
    s = event_series(spark, sf)
    css = M.demand_models(s).withColumn("method", F.lit("conditional"))
    exact = M.exact_models(s).drop("mean", "loglik").withColumn("method", F.lit("exact"))
    return rounded(css.unionByName(exact))


@register("m1_exact_models")
def m1_exact_models(spark, sf):
    return rounded(M.exact_models(event_series(spark, sf)))


@register("m1_grid_likelihood", _EVENTS_SQL.replace("WITH", "WITH RECURSIVE", 1) + """,
pts AS (SELECT item, CAST(quantity AS DOUBLE) AS y,
               row_number() OVER (PARTITION BY item ORDER BY d, hour) AS t
        FROM series),
shifts AS (SELECT item, avg(y) AS shift, count(*) AS n FROM pts GROUP BY item HAVING count(*) >= 3),
x AS (SELECT item, t, y - shift AS y FROM pts JOIN shifts USING (item)),
g AS (SELECT item, a::DOUBLE / 10 AS phi, b::DOUBLE / 10 AS theta
      FROM shifts, range(-9, 10) AS p(a), range(-9, 10) AS q(b)),
run AS (
  SELECT item, phi, theta, 0 AS t, (1 + 2 * phi * theta + theta * theta) / (1 - phi * phi) AS f,
         0::DOUBLE AS hy, 0::DOUBLE AS h1, 0::DOUBLE AS syy, 0::DOUBLE AS sy1, 0::DOUBLE AS s11,
         0::DOUBLE AS sl
  FROM g
  UNION ALL
  SELECT item, phi, theta, run.t + 1, 1 + theta * theta - theta * (theta / f),
         phi * y + theta / f * (y - hy), phi + theta / f * (1 - h1),
         syy + (y - hy) * (y - hy) / f, sy1 + (y - hy) * (1 - h1) / f,
         s11 + (1 - h1) * (1 - h1) / f, sl + ln(f)
  FROM run JOIN x USING (item) WHERE x.t = run.t + 1),
ends AS (
  SELECT item, n, phi, theta, shift + sy1 / s11 AS mean, greatest(syy - sy1 * (sy1 / s11), 0) / n AS sigma2, sl
  FROM run JOIN shifts USING (item) WHERE t = n),
ll AS (SELECT *, -0.5 * (n * (ln(2 * pi() * sigma2) + 1) + sl) AS loglik FROM ends)
SELECT item, n AS n_points, phi AS ar1, theta AS ma1, round(loglik, 6) AS loglik,
       round(mean, 6) AS mean, round(sigma2, 6) AS sigma2
FROM ll QUALIFY row_number() OVER (PARTITION BY item ORDER BY loglik DESC, phi, theta) = 1""")
def m1_grid_likelihood(spark, sf):
    """The exact likelihood's best pair of coefficients on a grid, where the search
    of ``m1_exact_models`` starts; the twin runs the same filter as a recursion."""
    return rounded(M.grid_models(event_series(spark, sf)))
