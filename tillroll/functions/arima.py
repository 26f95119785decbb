"""ARIMA orders of one series, fitted by exact likelihood; used inside Spark tasks.

The differenced series is a seasonal ARMA process around a mean: phi(B) Phi(B^m) (w - mean) =
theta(B) Theta(B^m) shock. All orders that share differences and seasonal terms are fitted
together, on all folds.
"""

from itertools import groupby

import numpy as np

from tillroll.functions import kalman
from tillroll.operators.series import BOX_COX_SHIFT, FLAT, GOLDEN, POWER_ZERO, SMALLEST, golden_steps

SPARE_ROWS = 8  # observations wanted beyond the number of coefficients


def effective(order):
    """The order with a season only where a seasonal term needs one: equal ones are the same model."""
    return order if order["P"] or order["D"] or order["Q"] else order | {"m": 0}


def n_coefficients(order):
    return order["p"] + order["q"] + order["P"] + order["Q"]


def weeks_lost(order):
    """Observations used up by differences."""
    return order["d"] + order["D"] * order["m"]


def weeks_wanted(order):
    return weeks_lost(order) + n_coefficients(order) + 1 + SPARE_ROWS


def family(order):
    """Orders of one family differ in p and q only, and are fitted together."""
    order = effective(order)
    return tuple(order[k] for k in ("d", "D", "P", "Q", "m"))


def difference_weights(order):
    """Coefficients of (1 - B)^d (1 - B^m)^D; the first one is 1."""
    weights = np.array([1.0])
    for _ in range(order["d"]):
        weights = np.convolve(weights, [1.0, -1.0])
    for _ in range(order["D"]):
        weights = np.convolve(weights, [1.0, *[0.0] * (order["m"] - 1), -1.0])
    return weights


class Fits:
    """Orders of one family fitted to histories, one order for each history; known ones are not fitted again."""

    def __init__(self, orders, histories, start=None, known=None):
        self.weights = difference_weights(orders[0])
        self.histories = histories
        own = [np.convolve(h, self.weights, mode="valid") for h in histories]
        self.lengths = np.array([len(w) for w in own])
        self.series = np.zeros((len(own), self.lengths.max()))
        for row, w in zip(self.series, own):
            row[: len(w)] = w
        p, q = (max(o[k] for o in orders) for k in ("p", "q"))
        self.shape = kalman.Shape(p, q, orders[0]["P"], orders[0]["Q"], orders[0]["m"])
        if known is not None:
            self.x = np.asarray(known, dtype=float).reshape(len(orders), self.shape.n)
            return
        free = [[*(np.arange(p) < o["p"]), *(np.arange(q) < o["q"]), *[True] * (o["P"] + o["Q"])] for o in orders]
        free = np.array(free, bool).reshape(len(orders), self.shape.n)
        self.x, self.likelihood, self.inverse = kalman.fit(self.shape, free, self.series, self.lengths, *(start or ()))
        # the mean and the scale are parameters too
        self.aic = 2 * (np.array([n_coefficients(o) for o in orders]) + 2) - 2 * self.likelihood

    def coefficients(self):
        """({lag: AR}, {lag: MA}) of each fit, one array for each lag."""
        return self.shape.coefficients(self.x)

    def forecast(self, n_periods):
        """The weeks that follow each history, differences undone."""
        ahead = kalman.forecast(self.shape, self.x, self.series, self.lengths, n_periods)
        out = []
        for history, w in zip(self.histories, ahead):
            z = list(history[len(history) - len(self.weights) + 1 :])
            for value in w:
                z.append(value - sum(c * z[-k] for k, c in enumerate(self.weights) if k))
            out.append(np.array(z[len(self.weights) - 1 :]))
        return out


def fit(history, order):
    return Fits([effective(order)], [np.asarray(history, dtype=float)])


def known(history, order, parameters):
    """A fit that has been stored."""
    return Fits([effective(order)], [np.asarray(history, dtype=float)], known=[parameters])


def search(history, candidates, n_splits, test_size, box_cox=False):
    """(candidate, fold, AIC, RMSE) of numbered orders of one family on expanding folds of a history.

    The last fold, which has the most weeks, is searched first; the others start from its result.
    """
    ends = [len(history) - (n_splits - fold) * test_size for fold in range(n_splits)]
    powers = [box_cox_power(history[:end]) if box_cox else None for end in ends]
    trains = [to_box_cox(history[:end], power) if box_cox else history[:end] for end, power in zip(ends, powers)]
    keyed = sorted(((tuple(effective(o).items()), n) for n, o in candidates))
    alike = [(dict(key), [n for _, n in rows]) for key, rows in groupby(keyed, key=lambda pair: pair[0])]
    orders, found, start = [order for order, _ in alike], [], None
    for folds in ([n_splits - 1], list(range(n_splits - 1))):
        if not folds:
            continue
        fits = Fits([o for o in orders for _ in folds], [trains[fold] for _ in orders for fold in folds], start)
        start = tuple(None if x is None else np.repeat(x, n_splits - 1, axis=0) for x in (fits.x, fits.inverse))
        ahead = fits.forecast(test_size)
        for at, (fold, numbers) in enumerate((fold, numbers) for _, numbers in alike for fold in folds):
            predicted = from_box_cox(ahead[at], powers[fold]) if box_cox else ahead[at]
            actual = history[ends[fold] : ends[fold] + test_size]
            error = float(np.sqrt(np.mean((actual - predicted) ** 2)))
            found += [(n, fold, float(fits.aic[at]), error) for n in numbers]
    return found


def box_cox_power(values, low=-2.0, high=2.0, tolerance=1e-7):
    """As operators.series.box_cox_lambdas, for one history."""
    z = np.log(np.maximum(values + BOX_COX_SHIFT, SMALLEST))
    if not len(z) or np.ptp(z) < FLAT:
        return 1.0
    z = z - z.mean()

    def spread(power):
        return np.log(np.var(z if abs(power) < POWER_ZERO else np.expm1(power * z) / power))

    a, b = low, high
    c, d = b - (b - a) * GOLDEN, a + (b - a) * GOLDEN
    at_c, at_d = spread(c), spread(d)
    for _ in range(golden_steps(high - low, tolerance)):
        if at_c <= at_d:
            b, d, at_d = d, c, at_c
            c = b - (b - a) * GOLDEN
            at_c = spread(c)
        else:
            a, c, at_c = c, d, at_d
            d = a + (b - a) * GOLDEN
            at_d = spread(d)
    return (a + b) / 2


def to_box_cox(values, power):
    x = np.maximum(values + BOX_COX_SHIFT, SMALLEST)
    return np.log(x) if abs(power) < POWER_ZERO else (x**power - 1) / power


def from_box_cox(values, power):
    """As operators.series.inverse_box_cox: NaN where a negative power has no finite value."""
    if abs(power) < POWER_ZERO:
        return np.exp(values) - BOX_COX_SHIFT
    base = values * power + 1
    known = np.power(np.maximum(base, 0.0) if power > 0 else np.where(base > 0, base, np.nan), 1 / power)
    return known - BOX_COX_SHIFT
