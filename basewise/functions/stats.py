"""Tail functions in plain Python: normal, Student's t, beta."""

from __future__ import annotations

import math


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def beta_cdf(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_cdf(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, f, c, d = 1e-300, 1.0, 1.0, 0.0
    for i in range(1000):
        m = i // 2
        if i == 0:
            step = 1.0
        elif i % 2 == 0:
            step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 + step * d
        d = 1 / (d if abs(d) > tiny else tiny)
        c = 1 + step / c
        c = c if abs(c) > tiny else tiny
        f *= c * d
        if abs(1 - c * d) < 1e-15:
            break
    return front * (f - 1)


def beta_quantile(q: float, a: float, b: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(200):
        mid = (low + high) / 2
        if beta_cdf(mid, a, b) < q:
            low = mid
        else:
            high = mid
        if high - low < 1e-15:
            break
    return (low + high) / 2


def t_two_sided(t: float, df: float) -> float:
    """The chance of a t at least as far from 0."""
    if math.isinf(t):
        return 0.0
    return beta_cdf(df / (df + t * t), df / 2, 0.5)


def welch(m1: float, v1: float, n1: int, m2: float, v2: float, n2: int) -> tuple[float, float] | None:
    """t and its two-sided p for two samples; None where it is undefined."""
    if n1 < 2 or n2 < 2 or v1 / n1 + v2 / n2 == 0:
        return None
    a, b = v1 / n1, v2 / n2
    t = (m1 - m2) / math.sqrt(a + b)
    return t, t_two_sided(t, (a + b) ** 2 / (a * a / (n1 - 1) + b * b / (n2 - 1)))


def one_sample(m: float, v: float, n: int, value: float) -> tuple[float, float] | None:
    if n < 2 or v == 0:
        return None
    t = (m - value) / math.sqrt(v / n)
    return t, t_two_sided(t, n - 1)


def rank_sum(x: list[float], y: list[float]) -> float | None:
    """Mann-Whitney's two-sided p, normal approximation, ties corrected."""
    n, m = len(x), len(y)
    if not n or not m:
        return None
    held = sorted([(v, 0) for v in x] + [(v, 1) for v in y])
    total, ties, at = 0.0, 0.0, 0
    while at < n + m:
        end = at
        while end < n + m and held[end][0] == held[at][0]:
            end += 1
        rank, size = (at + end + 1) / 2, end - at
        ties += size**3 - size
        total += rank * sum(1 for v in held[at:end] if v[1] == 0)
        at = end
    u = total - n * (n + 1) / 2
    spread = n * m / 12 * ((n + m + 1) - ties / ((n + m) * (n + m - 1)))
    if spread <= 0:
        return 1.0
    z = (abs(u - n * m / 2) - 0.5) / math.sqrt(spread)
    return min(1.0, 2 * (1 - normal_cdf(z)))
