"""Unit-root tests per series.

ADF: regression with constant and trend on trunc((n - 1)^(1/3)) lagged differences.
KPSS: level, Bartlett weights up to trunc(4 (n / 100)^(1/4)) lags. p-values are
interpolated in the published tables and stay within them.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Dickey-Fuller quantiles with constant and trend (Banerjee et al., 1993), by sample size
ADF_SIZES = [25, 50, 100, 250, 500, 100000]
ADF_QUANTILES = {
    0.01: [-4.38, -4.15, -4.04, -3.99, -3.98, -3.96],
    0.025: [-3.95, -3.80, -3.73, -3.69, -3.68, -3.66],
    0.05: [-3.60, -3.50, -3.45, -3.43, -3.42, -3.41],
    0.10: [-3.24, -3.18, -3.15, -3.13, -3.13, -3.12],
    0.90: [-1.14, -1.19, -1.22, -1.23, -1.24, -1.25],
    0.95: [-0.80, -0.87, -0.90, -0.92, -0.93, -0.94],
    0.975: [-0.50, -0.58, -0.62, -0.64, -0.65, -0.66],
    0.99: [-0.15, -0.24, -0.28, -0.31, -0.32, -0.33],
}
# Upper tail of the KPSS statistic for a level (Kwiatkowski et al., 1992)
KPSS_QUANTILES = {0.347: 0.10, 0.463: 0.05, 0.574: 0.025, 0.739: 0.01}
SHORTEST = 12  # weeks; shorter series get nulls


def adf(x):
    """Statistic and p-value; a small p-value speaks for stationarity."""
    n = len(x) - 1
    lags = int(np.trunc((len(x) - 1) ** (1 / 3)))
    steps = np.diff(x)
    target = steps[lags:]
    design = np.column_stack(
        [x[lags:n], np.ones(n - lags), np.arange(lags, n), *[steps[lags - k:n - k] for k in range(1, lags + 1)]]
    )
    coefficients, _, rank, _ = np.linalg.lstsq(design, target, rcond=None)
    residuals = target - design @ coefficients
    freedom = len(target) - design.shape[1]
    if rank < design.shape[1] or freedom <= 0 or residuals @ residuals < 1e-12:
        return float("nan"), 0.01  # constant or exactly fitted: nothing left to difference
    deviation = np.sqrt(residuals @ residuals / freedom * np.linalg.inv(design.T @ design)[0, 0])
    statistic = coefficients[0] / deviation
    quantiles = [np.interp(n, ADF_SIZES, row) for row in ADF_QUANTILES.values()]
    return float(statistic), float(np.interp(statistic, quantiles, list(ADF_QUANTILES)))


def kpss(x):
    """Statistic and p-value; a small p-value speaks against stationarity."""
    n = len(x)
    e = x - x.mean()
    lags = int(np.trunc(4 * (n / 100) ** 0.25))
    spread = e @ e / n
    spread += 2 / n * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))
    if spread <= 1e-12:
        return 0.0, 0.10
    statistic = np.sum(np.cumsum(e) ** 2) / (n**2 * spread)
    return float(statistic), float(np.interp(statistic, list(KPSS_QUANTILES), list(KPSS_QUANTILES.values())))


def _histories(series: DataFrame) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("week_end", "total_price")))
    return series.groupBy("series_id").agg(F.transform(rows, lambda r: r["total_price"]).alias("history"))


def stationarity_tests(series: DataFrame, alpha: float = 0.05) -> DataFrame:
    """(series_id, test, statistic, p_value, stationary, reason) of the ADF and KPSS tests.

    A series of fewer than SHORTEST weeks has nulls, and a reason.
    """
    short = f"fewer than {SHORTEST} weeks"

    def run(batches):
        for pdf in batches:
            found = []
            for row in pdf.itertuples(index=False):
                x = np.asarray(row.history, dtype=float)
                if len(x) < SHORTEST:
                    found.extend((row.series_id, test, None, None, None, short) for test in ("adf", "kpss"))
                    continue
                statistic, p = adf(x)
                found.append((row.series_id, "adf", statistic, p, int(p <= alpha), None))
                statistic, p = kpss(x)
                found.append((row.series_id, "kpss", statistic, p, int(p >= alpha), None))
            frame = pd.DataFrame(found, columns=["series_id", "test", "statistic", "p_value", "stationary", "reason"])
            yield frame.astype({"stationary": "Int32"})

    return _histories(series).mapInPandas(
        run, "series_id string, test string, statistic double, p_value double, stationary int, reason string"
    )


def differencing_order(series: DataFrame, alpha: float = 0.05, most: int = 2) -> DataFrame:
    """Smallest number of differences after which the ADF test rejects a unit root; ``most`` if none does.

    Null for a series of fewer than SHORTEST weeks, which is not tested.
    """

    def run(batches):
        for pdf in batches:
            orders = []
            for history in pdf["history"]:
                x, order = np.asarray(history, dtype=float), 0
                if len(x) < SHORTEST:
                    orders.append(None)
                    continue
                while order < most and adf(x)[1] > alpha:
                    x, order = np.diff(x), order + 1
                orders.append(order)
            yield pd.DataFrame({"series_id": pdf["series_id"], "differences": pd.array(orders, dtype="Int32")})

    return _histories(series).mapInPandas(run, "series_id string, differences int")
