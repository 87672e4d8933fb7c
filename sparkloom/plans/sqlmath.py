"""SQL for statistics that the oracle has no function for, by series in lgamma."""


def normal_p(z: str) -> str:
    """Two-sided normal p-value, good to about 1e-8."""
    x = f"least(abs({z}) / sqrt(2), 4.2)"
    return f"greatest(0, 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 90), lambda i: CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END * exp((2 * i + 1) * ln(greatest({x}, 1e-12)) - lgamma(i + 1)) / (2 * i + 1))))"


def chi2_p(x: str, df: str) -> str:
    h = f"(greatest({x}, 1e-9) / 2)"
    return f"greatest(0, 1 - list_sum(list_transform(range(0, 600), lambda i: exp(({df} / 2.0 + i) * ln({h}) - {h} - lgamma({df} / 2.0 + i + 1)))))"


def bh(p: str, scope: str, ties: str) -> str:
    """Benjamini-Hochberg over rows that already carry _m and _k."""
    return f"least(1.0, min({p} * _m / _k) OVER (PARTITION BY {scope} ORDER BY _k DESC))"
