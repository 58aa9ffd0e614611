"""Distribution tails in pure Python (no scipy in the environment).

Test statistics are reduced on the executors to a handful of scalars; the
p-value is then a function of those scalars, computed on the driver.
Standard numerical methods: regularized incomplete beta by Lentz's
continued fraction, incomplete gamma by series / continued fraction,
studentized range by Gauss-Legendre quadrature of its integral form.
"""

from __future__ import annotations

import math

_EPS = 1e-15
_FPMIN = 1e-300


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def norm_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    """Inverse normal CDF (Acklam's rational approximation + one Newton step)."""
    if p <= 0:
        return -math.inf
    if p >= 1:
        return math.inf
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00]
    pl = 0.02425
    if p < pl:
        q = math.sqrt(-2 * math.log(p))
        x = (((((c[0]*q+c[1])*q+c[2])*q+c[3])*q+c[4])*q+c[5]) / ((((d[0]*q+d[1])*q+d[2])*q+d[3])*q+1)
    elif p > 1 - pl:
        q = math.sqrt(-2 * math.log(1 - p))
        x = -(((((c[0]*q+c[1])*q+c[2])*q+c[3])*q+c[4])*q+c[5]) / ((((d[0]*q+d[1])*q+d[2])*q+d[3])*q+1)
    else:
        q = p - 0.5
        r = q * q
        x = (((((a[0]*r+a[1])*r+a[2])*r+a[3])*r+a[4])*r+a[5])*q / (((((b[0]*r+b[1])*r+b[2])*r+b[3])*r+b[4])*r+1)
    e = norm_cdf(x) - p
    u = e * math.sqrt(2 * math.pi) * math.exp(x * x / 2)
    return x - u / (1 + x * u / 2)


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _FPMIN else _FPMIN)
    h = d
    for m in range(1, 3000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _FPMIN else _FPMIN)
        c = 1.0 + aa / c
        c = c if abs(c) > _FPMIN else _FPMIN
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _FPMIN else _FPMIN)
        c = 1.0 + aa / c
        c = c if abs(c) > _FPMIN else _FPMIN
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
           + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def gammaincc(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        ap, s = a, 1.0 / a
        d = s
        for _ in range(10000):
            ap += 1.0
            d *= x / ap
            s += d
            if abs(d) < abs(s) * _EPS:
                break
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - math.lgamma(a)))
    b = x + 1.0 - a
    c = 1.0 / _FPMIN
    d = 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _FPMIN else _FPMIN)
        c = b + an / c
        c = c if abs(c) > _FPMIN else _FPMIN
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, df: float) -> float:
    if x != x:
        return math.nan
    return gammaincc(df / 2.0, x / 2.0)


def f_sf(f: float, d1: float, d2: float) -> float:
    if f != f or d1 <= 0 or d2 <= 0:
        return math.nan
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value of a t statistic."""
    if t != t or df <= 0:
        return math.nan
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_ppf(p: float, df: float) -> float:
    """Quantile of Student's t by bisection on the tail (driver-side, rare)."""
    if df > 1e6:
        return norm_ppf(p)
    target = 2 * (1 - p) if p > 0.5 else 2 * p
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        if t_sf2(mid, df) > target:
            lo = mid
        else:
            hi = mid
    v = (lo + hi) / 2
    return v if p > 0.5 else -v


def _gauss_legendre(n: int):
    xs, ws = [], []
    for i in range(1, n + 1):
        x = math.cos(math.pi * (i - 0.25) / (n + 0.5))
        for _ in range(100):
            p0, p1 = 1.0, x
            for k in range(2, n + 1):
                p0, p1 = p1, ((2 * k - 1) * x * p1 - (k - 1) * p0) / k
            dp = n * (x * p1 - p0) / (x * x - 1)
            dx = p1 / dp
            x -= dx
            if abs(dx) < 1e-15:
                break
        xs.append(x)
        ws.append(2 / ((1 - x * x) * dp * dp))
    return xs, ws


_GL = _gauss_legendre(64)


def _integrate(f, a: float, b: float, pieces: int = 8) -> float:
    xs, ws = _GL
    total, h = 0.0, (b - a) / pieces
    for j in range(pieces):
        lo = a + j * h
        mid, half = lo + h / 2, h / 2
        total += half * sum(w * f(mid + half * x) for x, w in zip(xs, ws))
    return total


def _range_cdf(w: float, k: int) -> float:
    """P(range of k standard normals < w)."""
    if w <= 0:
        return 0.0
    f = lambda z: math.exp(-z * z / 2) / math.sqrt(2 * math.pi) * max(
        norm_cdf(z) - norm_cdf(z - w), 0.0) ** (k - 1)
    return min(1.0, k * _integrate(f, -8.0, 8.0 + w, 8))


def _range_cdf_grid(k: int, step: float, size: int):
    """P(range of k standard normals < i * step), i = 0 .. size - 1."""
    import numpy as np

    erf = np.frompyfunc(math.erf, 1, 1)
    xs, ws = (np.array(x) for x in _GL)
    edges = np.linspace(-8.0, 8.0 + step * size, 17)
    z = ((edges[1:] + edges[:-1])[:, None] / 2 + np.diff(edges)[:, None] / 2 * xs).ravel()
    weight = (np.diff(edges)[:, None] / 2 * ws).ravel() * np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    upper = 0.5 * (1 + erf(z / math.sqrt(2)).astype(float))
    out = np.empty(size)
    for i in range(size):
        lower = 0.5 * (1 + erf((z - i * step) / math.sqrt(2)).astype(float))
        out[i] = k * (weight * np.maximum(upper - lower, 0.0) ** (k - 1)).sum()
    return np.minimum(out, 1.0)


def tukey_sf_many(q, k: int, df: float, step: float = 0.01, size: int = 2400):
    """``tukey_sf`` of an array: the range's distribution is tabulated once and
    read by cubic interpolation at all points of the outer quadrature."""
    import numpy as np

    q = np.asarray(q, float)
    out = np.full(len(q), math.nan)
    known = ~np.isnan(q)
    grid = _range_cdf_grid(k, step, size)

    def cdf(w):
        at = np.clip((w / step).astype(int), 1, size - 3)
        t = w / step - at
        a, b, c, d = (grid[at + i] for i in (-1, 0, 1, 2))
        inside = (-t * (t - 1) * (t - 2) / 6 * a + (t + 1) * (t - 1) * (t - 2) / 2 * b - (t + 1) * t * (t - 2) / 2 * c
                  + (t + 1) * t * (t - 1) / 6 * d)
        return np.where(w >= step * (size - 3), 1.0, np.clip(inside, 0.0, 1.0))
    if df > 5000:
        s, weight = np.ones(1), np.ones(1)
    else:
        xs, ws = (np.array(x) for x in _GL)
        edges = np.linspace(1e-9, max(1 + 10 / math.sqrt(df), 3.0), 17)
        s = ((edges[1:] + edges[:-1])[:, None] / 2 + np.diff(edges)[:, None] / 2 * xs).ravel()
        weight = (np.diff(edges)[:, None] / 2 * ws).ravel()
        logc = (df / 2) * math.log(df) - math.lgamma(df / 2) - (df / 2 - 1) * math.log(2)
        weight = weight * np.exp(logc + (df - 1) * np.log(s) - df * s * s / 2)
    for i in range(0, len(q), 512):
        some = np.flatnonzero(known[i:i + 512]) + i
        w = np.minimum(q[some][:, None] * s, step * size)
        out[some] = np.where(q[some] <= 0, 1.0, np.clip(1 - (cdf(w) * weight).sum(1), 0.0, 1.0))
    return out


def tukey_sf(q: float, k: int, df: float) -> float:
    """Upper tail of the studentized range distribution."""
    if q != q:
        return math.nan
    if q <= 0:
        return 1.0
    if df > 5000:
        return 1.0 - _range_cdf(q, k)
    v = df
    logc = (v / 2) * math.log(v) - math.lgamma(v / 2) - (v / 2 - 1) * math.log(2)

    def dens(s):  # density of s = chi_v / sqrt(v)
        if s <= 0:
            return 0.0
        return math.exp(logc + (v - 1) * math.log(s) - v * s * s / 2)
    hi = 1 + 10 / math.sqrt(v)
    cdf = _integrate(lambda s: dens(s) * _range_cdf(q * s, k), 1e-9, max(hi, 3.0), 16)
    return max(0.0, min(1.0, 1.0 - cdf))
