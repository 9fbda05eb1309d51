"""Tail probabilities of the t and F distributions on NumPy arrays.

Both are incomplete beta functions I_x(a, b). Callers state x and y = 1 - x on their own, so
neither loses digits when it is small. Three ways cover all of a and b:

* beyond the mean, for a of 15 and more, the integral itself: with s = x exp(-w / a) the integrand
  falls like exp(-w), whatever a is, and Gauss-Legendre nodes over its support give all digits;
* for smaller a, the continued fraction, which then converges in a few dozen steps;
* before the mean, one less the continued fraction of the other side, which does as well.

A fraction that has not converged gives NaN, never a value of unknown error.
"""

from __future__ import annotations

import numpy as np

STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156)  # fixed values
LARGE = 15.0
STEPS = 10_000
FADED = 46.0  # exp(-46) is below a unit in the last place
NODES, WEIGHTS = np.polynomial.legendre.leggauss(128)


def _stirling(x):
    """What Stirling's formula for log gamma leaves, for x of LARGE and more."""
    inverse = 1.0 / x
    total, power = np.zeros_like(x), inverse
    for c in STIRLING:
        total = total + c * power
        power = power * inverse * inverse
    return total


def _lifted(x):
    """(x raised by whole steps to LARGE or more, log of the product of the steps taken)."""
    up, product = np.array(x, dtype=float), np.ones(np.shape(x))
    while np.any(up < LARGE):
        low = up < LARGE
        product = np.where(low, product * up, product)
        up = np.where(low, up + 1.0, up)
    return up, np.log(product)


def log_gamma(x):
    up, passed = _lifted(np.asarray(x, dtype=float))
    return (up - 0.5) * np.log(up) - up + 0.5 * np.log(2 * np.pi) + _stirling(up) - passed


def log_gamma_step(a, b):
    """log gamma(a + b) - log gamma(a), as a series of differences: no digit is lost however far
    apart a and b are."""
    a, b = np.broadcast_arrays(np.asarray(a, dtype=float), np.asarray(b, dtype=float))
    up, passed = _lifted(a)
    # The same whole steps for both, so that the difference of arguments stays b.
    steps = np.rint(up - a)
    passed_too = np.zeros_like(up)
    for i in range(int(steps.max(initial=0))):
        taken = i < steps
        passed_too = passed_too + np.where(taken, np.log(np.where(taken, a + b + i, 1.0)), 0.0)
    step = b * np.log(up) + (up + b - 0.5) * np.log1p(b / up) - b
    return step + _stirling(up + b) - _stirling(up) + passed - passed_too


def log_beta(a, b):
    a, b = np.broadcast_arrays(np.asarray(a, dtype=float), np.asarray(b, dtype=float))
    small, large = np.minimum(a, b), np.maximum(a, b)
    return log_gamma(small) - log_gamma_step(large, small)


def _fraction(a, b, x):
    """Continued fraction of the incomplete beta function, modified Lentz; NaN unless converged."""
    tiny = 1e-300

    def away(v):
        return np.where(np.abs(v) < tiny, tiny, v)

    c = np.ones_like(x)
    d = 1.0 / away(1.0 - (a + b) * x / (a + 1.0))
    total = d.copy()
    open_ = np.ones(x.shape, bool)
    for m in range(1, STEPS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / away(1.0 + even * d)
        c = away(1.0 + even / c)
        total = np.where(open_, total * d * c, total)
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / away(1.0 + odd * d)
        c = away(1.0 + odd / c)
        step = d * c
        total = np.where(open_, total * step, total)
        open_ &= np.abs(step - 1.0) >= 4e-16
        if not open_.any():
            break
    return np.where(open_, np.nan, total)


def _integral(a, b, x, y):
    """The integral of exp(-w) (1 + x (1 - exp(-w / a)) / y) ** (b - 1) over w from 0 on."""
    c = a * y / x

    def exponent(w):
        return w - (b - 1.0) * np.log1p(w / c)

    high = np.full(a.shape, FADED)
    for _ in range(200):
        short = exponent(high) < FADED
        if not short.any():
            break
        high = np.where(short, high * 2, high)
    low = np.zeros(a.shape)
    for _ in range(60):
        middle = (low + high) / 2
        short = exponent(middle) < FADED
        low, high = np.where(short, middle, low), np.where(short, high, middle)
    w = high[..., None] / 2 * (NODES + 1.0)
    rise = (x / y)[..., None] * -np.expm1(-w / a[..., None])
    return high / 2 * (np.exp(-w + (b[..., None] - 1.0) * np.log1p(rise)) * WEIGHTS).sum(axis=-1)


def incomplete_beta(a, b, x, y=None):
    """Regularised incomplete beta I_x(a, b), elementwise; y is 1 - x, where the caller has it
    with more digits. NaN where no way to it converges."""
    y = 1.0 - np.asarray(x, dtype=float) if y is None else y
    a, b, x, y = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x, y)))
    shape = a.shape
    a, b, x, y = (np.atleast_1d(v).ravel() for v in (a, b, x, y))
    value = np.full(a.shape, np.nan)
    value[x <= 0] = 0.0
    value[y <= 0] = 1.0
    with np.errstate(all="ignore"):
        inside = (x > 0) & (y > 0) & (a > 0) & (b > 0)
        log_x = np.where(x > 0.5, np.log1p(-y), np.log(x))
        log_y = np.where(y > 0.5, np.log1p(-x), np.log(y))
        front = a * log_x + b * log_y - log_beta(np.where(inside, a, 1.0), np.where(inside, b, 1.0))
        before = y * (a + b + 2.0) >= b + 1.0
        for chosen, way in (
            (inside & before & (a >= LARGE), lambda i: np.exp(front[i] - np.log(a[i] * y[i]))
             * _integral(a[i], b[i], x[i], y[i])),
            (inside & before & (a < LARGE), lambda i: np.exp(front[i]) / a[i]
             * _fraction(a[i], b[i], x[i])),
            (inside & ~before, lambda i: 1.0 - np.exp(front[i]) / b[i]
             * _fraction(b[i], a[i], y[i])),
        ):
            at = np.flatnonzero(chosen)
            if len(at):
                value[at] = way(at)
    return value.reshape(shape)


def t_two_sided(t, df):
    """P(|T| >= |t|) for Student's t."""
    t, df = np.broadcast_arrays(np.asarray(t, dtype=float), np.asarray(df, dtype=float))
    with np.errstate(all="ignore"):
        ratio = (t / np.sqrt(df)) ** 2
        x, y = 1.0 / (1.0 + ratio), np.where(np.isinf(ratio), 1.0, ratio / (1.0 + ratio))
        p = incomplete_beta(df / 2.0, 0.5, x, y)
    return np.where(np.isnan(t) | ~(df > 0), np.nan, p)


def f_upper(f, df1, df2):
    """P(F >= f)."""
    f, df1, df2 = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (f, df1, df2)))
    with np.errstate(all="ignore"):
        ratio = np.maximum(f, 0.0) * df1 / df2
        x, y = 1.0 / (1.0 + ratio), np.where(np.isinf(ratio), 1.0, ratio / (1.0 + ratio))
        p = incomplete_beta(df2 / 2.0, df1 / 2.0, x, y)
    return np.where(np.isnan(f), np.nan, p)


def t_critical(df, level=0.95):
    """Two-sided critical value by bisection on the tail probability."""
    df = np.asarray(df, dtype=float)
    low, high = np.zeros_like(df), np.full_like(df, 2.0)
    for _ in range(60):
        beyond = t_two_sided(high, df) > 1 - level
        if not np.any(beyond):
            break
        high = np.where(beyond, high * 2, high)
    for _ in range(70):
        middle = (low + high) / 2
        above = t_two_sided(middle, df) > 1 - level
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2
