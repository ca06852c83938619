"""Hourly demand series and per-item models.

Raw rows are aggregated to ``(item, date, hour)`` first (partial
aggregation absorbs hot items), so everything after A7 works on series whose
length is bounded by the number of hours, not by the number of raw rows.

M1 fits an ARMA(1,1) with constant per item by conditional least squares
(CSS) in numpy: Hannan-Rissanen and lag-regression starts, then Gauss-Newton
steps on the CSS residuals (e_0 = 0), AR and MA coefficients kept inside (-1, 1).
``exact_models`` fits the same model by exact Gaussian likelihood (Kalman filter
innovations). Both run as ``groupBy(item).applyInPandas``: one Python call per
item series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_POINTS = 3

MODEL_SCHEMA = ("item string, n_points long, const double, ar1 double, ma1 double, "
                "sigma2 double, converged boolean")


def parse_time(ts_text) -> "F.Column":
    """ISO text without a zone to TIMESTAMP_NTZ (no session-zone shift)."""
    c = F.col(ts_text) if isinstance(ts_text, str) else ts_text
    return F.to_timestamp_ntz(c)


def ntz_as_utc(ts_ntz) -> "F.Column":
    """ST1 input: a TIMESTAMP_NTZ read as UTC, as a TIMESTAMP (instant).

    Built from calendar fields (days since epoch, hour, minute, seconds with
    fraction), so the result does not depend on the session time zone, as a
    plain cast would.
    """
    c = F.col(ts_ntz) if isinstance(ts_ntz, str) else ts_ntz
    micros = (F.unix_date(F.to_date(c)).cast("long") * 86_400_000_000
              + F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000
              + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long"))
    return F.timestamp_micros(micros)


def hourly_demand(rows: DataFrame, item_col: str = "item", ts_col: str = "ts",
                  qty_col: str = "quantity") -> DataFrame:
    """A7 + X4: total quantity per item, date and hour."""
    ts = F.col(ts_col)
    return (rows.select(F.col(item_col).alias("item"), F.to_date(ts).alias("date"),
                        F.hour(ts).alias("hour"), F.col(qty_col).alias("quantity"))
            .groupBy("item", "date", "hour").agg(F.sum("quantity").alias("quantity")))


def min_length(series: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """Drop items with fewer than ``min_points`` hourly points."""
    n = F.count(F.lit(1)).over(Window.partitionBy("item"))
    return series.withColumn("n_points", n).filter(F.col("n_points") >= min_points)


def ordered(series: DataFrame) -> DataFrame:
    """L4: position of each point in its item's series (date, hour order)."""
    w = Window.partitionBy("item").orderBy("date", "hour")
    return series.withColumn("position", F.row_number().over(w))


def lag_regression(series: DataFrame) -> DataFrame:
    """M2: AR(1) by least squares in SQL: quantity on the previous observed
    hour's quantity, per item (the pure-SQL check on M1)."""
    w = Window.partitionBy("item").orderBy("date", "hour")
    pairs = series.withColumn("prev", F.lag("quantity").over(w)).filter(F.col("prev").isNotNull())
    y, x = F.col("quantity").cast("double"), F.col("prev").cast("double")
    return pairs.groupBy("item").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"))


# --------------------------------------------------------------------------
# M1: ARMA(1,1) + constant by conditional least squares (numpy).
# --------------------------------------------------------------------------

def _css_residuals(y: np.ndarray, c: float, phi: float, theta: float
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Conditional residuals (the first one 0) and their derivatives by constant,
    ar1 and ma1, in one recursion over the points."""
    rows, v = [], y.tolist()
    e = dc = dp = dt = 0.0
    for prev, now in zip(v, v[1:]):
        dc, dp, dt = -1.0 - theta * dc, -prev - theta * dp, -e - theta * dt
        e = now - c - phi * prev - theta * e
        rows.append((e, dc, dp, dt))
    out = np.array(rows)
    return out[:, 0], out[:, 1:]


_LOW, _HIGH = np.array([-np.inf, -0.99, -0.99]), np.array([np.inf, 0.99, 0.99])


def fit_arma11(y: np.ndarray, max_iter: int = 500) -> tuple[float, float, float, float, bool]:
    """(const, ar1, ma1, sigma2, converged) for one series. The residual sum is not
    above that of the lag regression (M2), which is one of the two starts, as long
    as its slope lies inside the bounds."""
    y = np.asarray(y, dtype=float)
    n = len(y)
    if n < MIN_POINTS:
        return (float("nan"),) * 4 + (False,)
    lag, *_ = np.linalg.lstsq(np.column_stack([np.ones(n - 1), y[:-1]]), y[1:], rcond=None)
    starts = [np.array([lag[0], lag[1], 0.0])]
    # Hannan-Rissanen: long AR for residuals, then OLS on [1, y_{t-1}, e_{t-1}].
    p = max(1, min(int(np.sqrt(n)), n // 3))
    if n - p > p + 1:
        X = np.column_stack([np.ones(n - p)] + [y[p - j - 1:n - j - 1] for j in range(p)])
        b, *_ = np.linalg.lstsq(X, y[p:], rcond=None)
        e_hat = np.concatenate([np.zeros(p), y[p:] - X @ b])
        Z = np.column_stack([np.ones(n - 1), y[:-1], e_hat[:-1]])
        starts.append(np.linalg.lstsq(Z, y[1:], rcond=None)[0])

    def at(params):
        e, jac = _css_residuals(y, *params)
        return float(e @ e), e, jac

    params, (sse, e, jac) = min(((q, at(q)) for q in (np.clip(s, _LOW, _HIGH) for s in starts)),
                                key=lambda x: x[1][0])
    converged = False
    for _ in range(max_iter):
        step, *_ = np.linalg.lstsq(jac, -e, rcond=None)
        lam, better = 1.0, None
        while lam > 1e-4 and better is None:
            cand = np.clip(params + lam * step, _LOW, _HIGH)
            got = at(cand)
            if got[0] < sse:
                better = cand, got
            lam /= 2
        if better is None:
            converged = True
            break
        rel = abs(sse - better[1][0]) / max(sse, 1e-12)
        params, (sse, e, jac) = better
        if rel < 1e-9:
            converged = True
            break
    sigma2 = sse / max(n - 1, 1)
    return float(params[0]), float(params[1]), float(params[2]), float(sigma2), converged


def _fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["date", "hour"])
    c, phi, theta, s2, ok = fit_arma11(pdf["quantity"].to_numpy(dtype=float))
    return pd.DataFrame([{"item": pdf["item"].iloc[0], "n_points": len(pdf), "const": c,
                          "ar1": phi, "ma1": theta, "sigma2": s2, "converged": ok}])


def demand_models(series: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """M1: one parameter row per item with at least ``min_points`` points.

    Consecutive observed hours are used as they are (gaps are not filled),
    as in the reference.
    """
    return (_series_of(series, min_points).groupBy("item")
            .applyInPandas(_fit_group, MODEL_SCHEMA))


# --------------------------------------------------------------------------
# M1 by exact likelihood: ARMA(1,1) around a mean in state-space form.
# --------------------------------------------------------------------------

EXACT_SCHEMA = ("item string, n_points long, mean double, const double, ar1 double, ma1 double, "
                "sigma2 double, loglik double, converged boolean")
GRID_STEPS = 10      # the search starts from multiples of 1/10 inside (-1, 1)
EDGE = 0.9999        # bound of both coefficients
FINEST = 1e-8        # step at which the search ends


def exact_likelihood(y: np.ndarray, phi: np.ndarray, theta: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(loglik, mean, sigma2) of a series at each pair of coefficients, with the
    mean and the variance that are best there.

    State (x_t, theta e_t) of x_t = phi x_{t-1} + e_t + theta e_{t-1}, started from
    its stationary covariance; the Kalman filter's innovation of y_t has variance
    sigma2 * f. Innovations are linear in the mean, so the filter runs over the
    series and over a series of ones at once, and the mean is the weighted
    regression of one on the other.
    """
    y = np.asarray(y, float)
    shift = float(y.mean())
    f = (1.0 + 2.0 * phi * theta + theta * theta) / (1.0 - phi * phi)
    ahead_y = np.zeros_like(phi)  # predictions of the series and of the ones
    ahead_1 = np.zeros_like(phi)
    s_yy, s_y1, s_11, s_log = (np.zeros_like(phi) for _ in range(4))
    for value in (y - shift).tolist():
        v, u = value - ahead_y, 1.0 - ahead_1
        s_yy += v * v / f
        s_y1 += v * u / f
        s_11 += u * u / f
        s_log += np.log(f)
        gain = theta / f
        ahead_y = phi * value + gain * v
        ahead_1 = phi + gain * u
        f = 1.0 + theta * theta - theta * gain
    n = len(y)
    mean = s_y1 / s_11
    sigma2 = np.maximum(s_yy - s_y1 * mean, 0.0) / n
    with np.errstate(divide="ignore"):
        loglik = -0.5 * (n * (np.log(2.0 * np.pi * sigma2) + 1.0) + s_log)
    return loglik, mean + shift, sigma2


def _best_on(y: np.ndarray, phis: np.ndarray, thetas: np.ndarray) -> tuple:
    """(phi, theta, loglik, mean, sigma2) of the best pair, the first of equal ones."""
    phi, theta = (g.ravel() for g in np.meshgrid(phis, thetas, indexing="ij"))
    loglik, mean, sigma2 = exact_likelihood(y, phi, theta)
    i = int(np.argmax(loglik))
    return tuple(float(x[i]) for x in (phi, theta, loglik, mean, sigma2))


def coarse_grid() -> np.ndarray:
    return np.arange(1 - GRID_STEPS, GRID_STEPS) / float(GRID_STEPS)


def fit_exact(y: np.ndarray) -> tuple:
    """(mean, const, ar1, ma1, sigma2, loglik, converged): the best pair of a
    coarse grid, then ever finer grids around the best so far. A constant series
    has no likelihood: its coefficients are 0 and ``loglik`` is null."""
    y = np.asarray(y, float)
    if len(y) < MIN_POINTS:
        return (None,) * 6 + (False,)
    if float(y.max()) == float(y.min()):
        return float(y[0]), float(y[0]), 0.0, 0.0, 0.0, None, True
    best = _best_on(y, coarse_grid(), coarse_grid())
    step, moved = 1.0 / GRID_STEPS, 0
    while step > FINEST and moved < 200:
        near = np.arange(-4, 5) * (step / 4)
        found = _best_on(y, *(np.clip(c + near, -EDGE, EDGE) for c in best[:2]))
        if found[2] > best[2]:
            on_rim = max(abs(found[0] - best[0]), abs(found[1] - best[1])) > 0.9 * step
            best, moved = found, moved + 1
            if on_rim:  # the best may lie beyond: look on with the same step
                continue
        step /= 4
    phi, theta, loglik, mean, sigma2 = best
    return mean, mean * (1.0 - phi), phi, theta, sigma2, loglik, step <= FINEST


def _series_of(series: DataFrame, min_points: int) -> DataFrame:
    s = series.select("item", "date", "hour", F.col("quantity").cast("double").alias("quantity"))
    return min_length(s, min_points).drop("n_points")


def exact_models(series: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """M1: one row of coefficients per item by exact maximum likelihood, over
    consecutive observed hours (gaps are not filled)."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(["date", "hour"])["quantity"].to_numpy(float)
        return pd.DataFrame([(pdf["item"].iloc[0], len(y), *fit_exact(y))],
                            columns=[c.split()[0] for c in EXACT_SCHEMA.split(", ")])
    return _series_of(series, min_points).groupBy("item").applyInPandas(fit, EXACT_SCHEMA)


def grid_models(series: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """The best pair of coefficients among multiples of 1/10, per item, with its
    exact likelihood: where ``exact_models`` starts."""
    schema = ("item string, n_points long, ar1 double, ma1 double, loglik double, mean double, "
              "sigma2 double")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(["date", "hour"])["quantity"].to_numpy(float)
        return pd.DataFrame([(pdf["item"].iloc[0], len(y), *_best_on(y, coarse_grid(), coarse_grid()))],
                            columns=[c.split()[0] for c in schema.split(", ")])
    return _series_of(series, min_points).groupBy("item").applyInPandas(fit, schema)


def lag_residuals(series: DataFrame) -> DataFrame:
    """(item, lag_sse): the residual sum of squares of M2."""
    w = Window.partitionBy("item").orderBy("date", "hour")
    pairs = series.withColumn("prev", F.lag("quantity").over(w)).filter(F.col("prev").isNotNull())
    y, x = F.col("quantity").cast("double"), F.col("prev").cast("double")
    fit = pairs.groupBy("item").agg(F.regr_syy(y, x).alias("syy"), F.regr_sxx(y, x).alias("sxx"),
                                    F.regr_sxy(y, x).alias("sxy"))
    return fit.select("item", (F.col("syy") - F.when(F.col("sxx") > 0, F.col("sxy") * F.col("sxy")
                                                     / F.col("sxx")).otherwise(0.0)).alias("lag_sse"))


def save_models(models: DataFrame, path: str) -> None:
    """The parameters table (one row per item), not pickled objects."""
    models.write.mode("overwrite").parquet(path)
