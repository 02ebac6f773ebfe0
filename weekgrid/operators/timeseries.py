"""Series diagnostics. Every function takes the series key columns, so the same
plan serves one network total or a million series; a series is one ordered row
per week and therefore bounded by the calendar."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from weekgrid.functions.columns import log_plus_one
from weekgrid.functions.trailing import centred_mean, series

# MacKinnon (1994) p-value polynomials and (2010) critical values
# for the unit-root test with a constant.
TAU_SMALL = [2.1659, 1.4412, 0.038269]
TAU_LARGE = [1.7339, 0.93202, -0.12745, -0.010368]
TAU_MIN, TAU_SWITCH, TAU_MAX = -18.83, -1.61, 2.74
CRITICAL = {
    "crit_1": [-3.43035, -6.5393, -16.786, -79.433],
    "crit_5": [-2.86154, -2.8903, -4.234, -40.040],
    "crit_10": [-2.56677, -1.5384, -2.809, 0.0],
}


def network_series(df: DataFrame, value: str = "weekly_sales", key: str = "series") -> DataFrame:
    """Total per week and its log, as one series named ``network``."""
    total = df.groupBy("date").agg(F.sum(value).alias("total"))
    return total.select(
        F.lit("network").alias(key), "date", "total", log_plus_one(F.col("total")).alias("total_log")
    )


def decompose(df: DataFrame, keys: list[str], value: str, date: str = "date", period: int = 52) -> DataFrame:
    """Additive trend, seasonal and residual parts."""
    w = series(keys, date)
    observed = F.col(value)
    trended = df.select(
        *keys,
        date,
        observed.alias("observed"),
        centred_mean(observed, w, period).alias("trend"),
        ((F.row_number().over(w) - 1) % period).alias("phase"),
    )
    swing = trended.groupBy(*keys, "phase").agg(F.avg(F.col("observed") - F.col("trend")).alias("raw"))
    centred = swing.select(
        *keys, "phase", (F.col("raw") - F.avg("raw").over(Window.partitionBy(*keys))).alias("seasonal")
    )
    return trended.join(centred, [*keys, "phase"], "left").select(
        *keys,
        date,
        "observed",
        "trend",
        "seasonal",
        (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("resid"),
    )


def autocorrelation(
    df: DataFrame, keys: list[str], value: str, date: str = "date", lags: int = 60
) -> DataFrame:
    """(keys..., lag, acf), biased estimate."""
    return cross_correlation(df, keys, value, value, date, lags).select(
        *keys, "lag", F.col("ccf").alias("acf")
    )


def cross_correlation(
    df: DataFrame, keys: list[str], x: str, y: str, date: str = "date", lags: int = 12
) -> DataFrame:
    """(keys..., lag, ccf, band): correlation of ``x`` with ``y`` of ``lag`` weeks
    before, and the 1.96/sqrt(n) band.

    A series is gathered as one ordered array, a few hundred weeks long, and all
    lags are sums over that array: one shuffle, and no row per week and lag.
    """
    gathered = df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(date, F.col(x).alias("x"), F.col(y).alias("y")))).alias("s"),
        F.avg(x).alias("mx"),
        F.avg(y).alias("my"),
    )
    centred = gathered.selectExpr(
        *keys, "transform(s, e -> e.x - mx) AS xs", "transform(s, e -> e.y - my) AS ys"
    )
    dot = "aggregate(zip_with({a}, {b}, (p, q) -> coalesce(p * q, 0D)), 0D, (t, v) -> t + v)"
    scaled = centred.selectExpr(
        *keys,
        "xs",
        "ys",
        f"sqrt({dot.format(a='xs', b='xs')} * {dot.format(a='ys', b='ys')}) AS scale",
        "1.96D / sqrt(size(xs)) AS band",
    )
    shifted = dot.format(a="slice(xs, k + 1, size(xs))", b="ys")
    return scaled.selectExpr(
        *keys,
        f"inline(transform(sequence(0, {lags}), k -> struct(k AS lag, try_divide({shifted}, scale) AS ccf)))",
        "band",
    ).select(*keys, "lag", "ccf", "band")


def partial_autocorrelation(acf: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., lag, pacf) from the ACF rows by the Levinson-Durbin recursion,
    one small frame of lags per series."""

    def recurse(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("lag")
        r = rows["acf"].to_numpy(float)
        out, phi, error = np.zeros(len(r)), np.zeros(0), 1.0
        out[0] = 1.0
        for k in range(1, len(r)):
            reflection = (r[k] - phi @ r[k - 1 : 0 : -1]) / error if error > 0 else np.nan
            phi = np.append(phi - reflection * phi[::-1], reflection)
            error *= 1.0 - reflection**2
            out[k] = reflection
        return rows.assign(pacf=out)[[*keys, "lag", "pacf"]]

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in acf.schema if f.name in keys)
    return acf.groupBy(*keys).applyInPandas(recurse, f"{types}, lag int, pacf double")


def _fit(y: np.ndarray, lags: int, skip: int) -> tuple[float, float, int]:
    """t-ratio of the level term, AIC and sample size of the lagged regression.

    The constant is taken out by centring, and regressors have unit length: a level
    far from zero would else make the products of the regressors look singular."""
    diff = np.diff(y)
    rows = len(diff) - skip
    columns = [y[skip:-1], *(diff[skip - j : len(diff) - j] for j in range(1, lags + 1))]
    x, target = np.column_stack(columns), diff[skip:]
    x, target = x - x.mean(0), target - target.mean()
    length = np.sqrt((x * x).sum(0))
    x = x / np.where(length > 0, length, 1.0)
    beta = np.linalg.lstsq(x, target, rcond=None)[0]
    sse = float(((target - x @ beta) ** 2).sum())
    terms = lags + 2  # with the constant
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = beta[0] / np.sqrt(sse / (rows - terms) * np.linalg.pinv(x.T @ x)[0, 0])
        aic = rows * (np.log(2 * np.pi * sse / rows) + 1) + 2 * terms
    return float(ratio), float(aic), rows


def unit_root(df: DataFrame, keys: list[str], value: str, date: str = "date", max_lag: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant per series, lag by AIC, of up to
    ``max_lag`` lags or as many as the usual rule by length gives."""
    names = ["statistic", "p_value", "lags", "n", *CRITICAL, "stationary"]

    def test(rows: pd.DataFrame) -> pd.DataFrame:
        from math import erf, sqrt

        y = rows.sort_values(date)[value].dropna().to_numpy(float)
        head = rows[keys].iloc[:1].reset_index(drop=True)
        limit = int(np.ceil(12.0 * (len(y) / 100.0) ** 0.25))
        limit = min(limit, len(y) // 2 - 2, *([] if max_lag is None else [max_lag]))
        if limit < 0 or np.ptp(y) == 0:
            return head.assign(**dict.fromkeys(names))[[*keys, *names]]
        best = min(range(limit + 1), key=lambda p: _fit(y, p, limit)[1])
        stat, _, n = _fit(y, best, best)
        if np.isnan(stat):  # the level of the weeks compared never changes
            return head.assign(**dict.fromkeys(names))[[*keys, *names]]
        if stat > TAU_MAX:
            p = 1.0
        elif stat < TAU_MIN:
            p = 0.0
        else:
            curve = TAU_SMALL if stat <= TAU_SWITCH else TAU_LARGE
            z = sum(c * stat**i for i, c in enumerate(curve))
            p = 0.5 * (1 + erf(z / sqrt(2)))
        critical = {k: sum(c / n**i for i, c in enumerate(v)) for k, v in CRITICAL.items()}
        return head.assign(
            statistic=stat, p_value=p, lags=best, n=n, **critical, stationary=p < 0.05
        )[[*keys, *names]]

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keys)
    out = (
        f"{types}, statistic double, p_value double, lags int, n int, crit_1 double,"
        " crit_5 double, crit_10 double, stationary boolean"
    )
    return df.select(*keys, date, value).groupBy(*keys).applyInPandas(test, out)
