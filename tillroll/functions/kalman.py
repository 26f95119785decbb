"""Exact Gaussian likelihood of seasonal ARMA models, for many models of one series at once.

The state-space form of Harvey (state of length r, first element the series), filtered by Kalman's
recursions in the form of Chandrasekhar: from the stationary start the state's covariance changes by
a matrix of rank one at each step, so a step takes work in proportion to r, not r^2. All arrays have
a leading axis for the models, which move in step. Scale and mean are concentrated out: the
filter runs over the series and over a constant, whose innovations give the mean by least squares.

Coefficients come from partial autocorrelations in (-1, 1), so every point is stationary and
invertible. They are found by a quasi-Newton search (BFGS) over all models side by side.
"""

import numpy as np

SMALLEST = 1e-16


def _levinson(partial):
    """Coefficients of the autoregression that has these partial autocorrelations."""
    a = np.zeros_like(partial)
    for k in range(partial.shape[1]):
        own = partial[:, k : k + 1]
        a[:, :k] = a[:, :k] - own * a[:, :k][:, ::-1]
        a[:, k : k + 1] = own
    return a


def _product(short, long, season, sign):
    """Lag coefficients {lag: values} of (1 + sign a(B)) (1 + sign b(B^season)), the leading 1 left out, times sign."""
    found = {}

    def add(lag, value):
        found[lag] = found[lag] + value if lag in found else value

    for i in range(short.shape[1]):
        add(i + 1, short[:, i])
    for j in range(long.shape[1]):
        add((j + 1) * season, long[:, j])
        for i in range(short.shape[1]):
            add((j + 1) * season + i + 1, sign * short[:, i] * long[:, j])
    return found


class Shape:
    """Numbers of coefficients: p, q, P, Q and the season's length."""

    def __init__(self, p, q, seasonal_p, seasonal_q, season):
        self.sizes = (p, q, seasonal_p, seasonal_q)
        self.season = season
        self.n = sum(self.sizes)
        self.r = max(p + seasonal_p * season, q + seasonal_q * season + 1, 1)

    def coefficients(self, x):
        """({lag: AR}, {lag: MA}) of unbounded parameters, one row for each model."""
        partial = x / np.sqrt(1 + x * x)
        ends = np.cumsum((0, *self.sizes))
        p, q, sp, sq = (_levinson(partial[:, ends[i] : ends[i + 1]]) for i in range(4))
        return _product(p, sp, self.season, -1), _product(-q, -sq, self.season, 1)


def _autocovariances(phi, n, r):
    """Autocovariances 0..r of the autoregression with unit shocks: step down to its partials, then up."""
    a = np.zeros((n, r))
    for lag, value in phi.items():
        a[:, lag - 1] = value
    orders, spread = [None] * (r + 1), np.ones(n)
    orders[r] = a
    for k in range(r, 0, -1):
        own = orders[k][:, k - 1 : k]
        left = np.maximum(1 - own[:, 0] ** 2, SMALLEST)
        spread = spread * left
        rest = orders[k][:, : k - 1]
        orders[k - 1] = (rest + own * rest[:, ::-1]) / left[:, None]
    gamma = np.zeros((n, r + 1))
    gamma[:, 0] = 1 / spread
    error = gamma[:, 0].copy()
    for k in range(1, r + 1):
        own = orders[k][:, k - 1]
        gamma[:, k] = np.einsum("ij,ij->i", orders[k - 1], gamma[:, k - 1 : 0 : -1]) + own * error
        error = error * (1 - own**2)
    return gamma


class Models:
    """Models of one shape with their coefficients, ready to be filtered."""

    def __init__(self, shape: Shape, x):
        self.r, n = shape.r, len(x)
        self.phi, self.theta = shape.coefficients(x)
        r, most = self.r, max(self.theta, default=0)
        gamma = _autocovariances(self.phi, n, r)
        for k in range(r + 1, r + most + 1):  # further ones follow the recursion
            gamma = np.column_stack([gamma, sum(value * gamma[:, k - lag] for lag, value in self.phi.items()) + np.zeros(n)])
        moving = {0: np.ones(n), **self.theta}
        cov = np.zeros((n, r + 1))
        for i, x_i in moving.items():
            for j, x_j in moving.items():
                cov += (x_i * x_j)[:, None] * gamma[:, np.abs(np.arange(r + 1) + i - j)]
        psi = [np.ones(n)]
        for k in range(1, most + 1):
            psi.append(self.theta.get(k, 0) + sum(value * psi[k - lag] for lag, value in self.phi.items() if lag <= k))
        # covariance of each state element with the series
        first = np.zeros((n, r))
        for lag, value in self.phi.items():
            first[:, :lag] += value[:, None] * cov[:, lag:0:-1]
        for lag, value in moving.items():
            for i in range(min(lag, r - 1) + 1):
                first[:, i] += value * psi[lag - i]
        self.dense = np.zeros((n, r))
        for lag, value in self.phi.items():
            self.dense[:, lag - 1] = value
        self.spread = first[:, 0]
        self.gain = self.forward(first)

    def forward(self, state):
        """The transition applied to states."""
        out = self.dense * state[..., :1]
        out[..., :-1] += state[..., 1:]
        return out

    def run(self, series, lengths):
        """(mean, scale, log-likelihood, states after the last week) of each model.

        series: (models, weeks), padded behind each model's length.
        """
        n, weeks = series.shape
        states = np.zeros((3, n, self.r))  # of the series, of a constant, and the change of the covariance
        states[2] = self.gain
        gain, spread = self.gain.copy(), self.spread
        weight = -1 / spread
        step, steady = gain / spread[:, None], False
        found = np.empty((3, weeks, n))  # innovations of the series and of the constant, their variance
        ends = np.zeros((2, n, self.r))
        stops = {int(t) - 1: lengths == t for t in np.unique(lengths)}
        for t in range(weeks):
            found[0, t], found[1, t], found[2, t] = series[:, t] - states[0, :, 0], 1.0 - states[1, :, 0], spread
            head = states[-1, :, 0]
            states = self.forward(states)
            states[0] += step * found[0, t][:, None]
            states[1] += step * found[1, t][:, None]
            if t in stops:
                ends[:, stops[t]] = states[:2, stops[t]]
            if not steady:
                rate = weight * head
                wider = spread + head * rate
                gain += states[2] * rate[:, None]
                states[2] -= gain * (head / wider)[:, None]
                weight = weight + rate**2 / spread
                spread = wider
                step = gain / spread[:, None]
                if t % 8 == 7 and np.abs(weight * (states[2] ** 2).max(axis=1)).max(initial=0.0) < 1e-13 * spread.min(initial=1.0):
                    steady, states = True, states[:2]  # the covariance changes no more
        u, v, spread = np.where(lengths > np.arange(weeks)[:, None], np.stack([found[1], found[0], found[2]]), np.array([0.0, 0.0, 1.0])[:, None, None])
        ones, both, own = (u * u / spread).sum(axis=0), (u * v / spread).sum(axis=0), (v * v / spread).sum(axis=0)
        mean = both / np.maximum(ones, SMALLEST)
        rest = np.maximum(own - mean * both, 0.0)
        scale = np.maximum(rest / lengths, SMALLEST)
        likelihood = -0.5 * (lengths * np.log(2 * np.pi * scale) + rest / scale + np.log(spread).sum(axis=0))
        return mean, scale, likelihood, ends[0] - mean[:, None] * ends[1]


def log_likelihoods(shape: Shape, x, series, lengths):
    """Log-likelihood of each model with its best mean and scale."""
    return Models(shape, x).run(series, lengths)[2]


def maximise(function, start, free, inverse=None, rounds=30, least=1e-6):
    """(points, values, inverse curvatures) of the maxima of many functions, found side by side by BFGS.

    function(x, which) gives a value for each row of x, a point of function number which. free marks the
    parameters that a function has; the others stay. A function is left alone once its value stands still.
    """
    x, n, k = start.copy(), *start.shape
    inverse = np.tile(np.eye(k), (n, 1, 1)) if inverse is None else inverse.copy()
    value, gradient = _with_slopes(function, x, np.arange(n), free)
    live = np.flatnonzero(np.abs(gradient).max(axis=1, initial=0.0) > 1e-6)
    for _ in range(rounds):
        if not len(live):
            break
        step = np.einsum("nij,nj->ni", inverse[live], gradient[live])
        uphill = np.einsum("ni,ni->n", step, gradient[live]) > 0
        step = np.where(uphill[:, None], step, gradient[live])
        inverse[live[~uphill]] = np.eye(k)
        step *= np.minimum(1.0, 1.5 / np.maximum(np.abs(step).max(axis=1), SMALLEST))[:, None]
        slope = np.einsum("ni,ni->n", step, gradient[live])
        # the whole step is taken with its slopes at once; where it does not gain, it is cut
        reached, slopes = _with_slopes(function, x[live] + step, live, free[live])
        size, todo = np.ones(len(live)), np.flatnonzero(reached - value[live] < 1e-4 * slope)
        cut = todo
        for _ in range(10):
            if not len(todo):
                break
            size[todo] *= 0.3
            reached[todo] = function(x[live[todo]] + step[todo] * size[todo, None], live[todo])
            todo = todo[reached[todo] - value[live[todo]] < 1e-4 * size[todo] * slope[todo]]
        size[todo] = 0.0
        moved = step * size[:, None]
        if len(cut):
            reached[cut], slopes[cut] = _with_slopes(function, x[live[cut]] + moved[cut], live[cut], free[live[cut]])
        gained = reached - value[live]
        change = gradient[live] - slopes  # a maximum's slope falls
        x[live] += moved
        value[live], gradient[live] = reached, slopes
        curved = np.einsum("ni,ni->n", moved, change)
        fit = curved > 1e-12
        rho = np.where(fit, 1 / np.where(fit, curved, 1.0), 0.0)
        left = np.eye(k) - rho[:, None, None] * moved[:, :, None] * change[:, None, :]
        updated = left @ inverse[live] @ left.transpose(0, 2, 1) + rho[:, None, None] * moved[:, :, None] * moved[:, None, :]
        inverse[live] = np.where(fit[:, None, None], updated, inverse[live])
        live = live[(gained > least * (1 + np.abs(value[live]))) & (np.abs(gradient[live]).max(axis=1, initial=0.0) > 1e-6)]
    return x, value, inverse


def _with_slopes(function, x, which, free, width=1e-6):
    """Values and forward differences in the free parameters, all in one call."""
    row, column = np.nonzero(free)
    moved = x[row].copy()
    moved[np.arange(len(row)), column] += width
    values = function(np.concatenate([x, moved]), np.concatenate([which, which[row]]))
    value, out = values[: len(x)], np.zeros_like(x)
    out[row, column] = (values[len(x) :] - value[row]) / width
    return value, out


def first_guess(shape: Shape, free, series, lengths):
    """Parameters from the autocorrelations at lag 1 and at the season, shrunk; 0 for the others."""
    known = np.arange(series.shape[1]) < lengths[:, None]
    centred = np.where(known, series - (series * known).sum(axis=1, keepdims=True) / lengths[:, None], 0.0)
    power = np.maximum((centred**2).sum(axis=1), SMALLEST)
    start = np.zeros((len(series), shape.n))
    for column, lag, used in ((0, 1, shape.sizes[0]), (sum(shape.sizes[:2]), shape.season, shape.sizes[2])):
        if used and 0 < lag < series.shape[1]:
            start[:, column] = 0.7 * (centred[:, lag:] * centred[:, :-lag]).sum(axis=1) / power
    start = np.clip(start, -0.9, 0.9)
    return np.where(free, start / np.sqrt(1 - start**2), 0.0)


def fit(shape: Shape, free, series, lengths, start=None, inverse=None):
    """(x, log-likelihood, inverse curvature) of each model; free marks its parameters among the shape's.

    series: (models, weeks). start and inverse, of a fit to much the same weeks, save most of the search.
    """
    if start is None:
        start = first_guess(shape, free, series, lengths)
    if not free.any():
        return start, log_likelihoods(shape, start, series, lengths), inverse
    return maximise(lambda x, which: log_likelihoods(shape, x, series[which], lengths[which]), start, free, inverse)


def forecast(shape: Shape, x, series, lengths, n_periods):
    """The weeks that follow each model's series: (models, n_periods)."""
    models = Models(shape, x)
    mean, _, _, state = models.run(series, lengths)
    out = np.zeros((len(series), n_periods))
    for step in range(n_periods):
        out[:, step] = mean + state[:, 0]
        state = models.forward(state)
    return out
