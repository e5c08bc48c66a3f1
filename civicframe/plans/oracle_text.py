"""DuckDB texts for regressions: successive residuals instead of a matrix solve."""

from __future__ import annotations

from collections.abc import Sequence


def last_coefficient(base: str, y: str, xs: Sequence[str], cluster: str | None = None, robust=False,
                     digits: int = 6, with_clause: str = "WITH ") -> str:
    """Estimate and standard error of the last regressor of y on xs (with intercept).

    Each step removes one regressor from the rest; ``lev`` adds up the leverage.
    """
    k = len(xs)
    cols = ", ".join(f"CAST({x} AS DOUBLE) AS x{i}" for i, x in enumerate(xs))
    group = f", {cluster} AS g" if cluster else ""
    steps = [f"r0 AS (SELECT CAST({y} AS DOUBLE) AS y, {cols}{group}, 1.0 / COUNT(*) OVER () AS lev FROM {base})"]
    for i in range(k - 1):
        rest = ["y"] + [f"x{j}" for j in range(i + 1, k)]
        slopes = ", ".join(f"regr_slope({c}, x{i}) AS b_{c}" for c in rest)
        moved = ", ".join(f"{c} - b_{c} * (x{i} - m) AS {c}" for c in rest)
        keep = ", g" if cluster else ""
        steps.append(
            f"r{i + 1} AS (SELECT {moved}{keep}, lev + (x{i} - m) * (x{i} - m) / s AS lev FROM r{i}, "
            f"(SELECT {slopes}, AVG(x{i}) AS m, regr_sxx(x{i}, x{i}) AS s FROM r{i}) AS f{i})")
    last, x = f"r{k - 1}", f"x{k - 1}"
    keep = ", g" if cluster else ""
    steps.append(
        f"e AS (SELECT {x} - mx AS z, y - my - b * ({x} - mx) AS e, b, s, n, lev + ({x} - mx) * ({x} - mx) / s AS lev{keep} FROM {last}, "
        f"(SELECT regr_slope(y, {x}) AS b, AVG({x}) AS mx, AVG(y) AS my, regr_sxx({x}, {x}) AS s, COUNT(*) AS n FROM {last}) AS f)")
    if cluster:
        tail = (f"SELECT ROUND(MAX(b), {digits}) AS estimate, ROUND(SQRT(COUNT(*) * 1.0 / (COUNT(*) - 1) * (MAX(n) - 1.0) / (MAX(n) - {k + 1})"
                f" * SUM(sc * sc)) / MAX(s), {digits}) AS std_error FROM (SELECT g, SUM(z * e) AS sc, MAX(b) AS b, MAX(s) AS s, MAX(n) AS n FROM e GROUP BY g)")
    elif robust:
        tail = f"SELECT ROUND(MAX(b), {digits}) AS estimate, ROUND(SQRT(SUM(z * z * e * e / (1 - lev))) / MAX(s), {digits}) AS std_error FROM e"
    else:
        tail = (f"SELECT ROUND(MAX(b), {digits}) AS estimate, ROUND(SQRT(SUM(e * e) / (MAX(n) - {k + 1}) / MAX(s)), {digits}) AS std_error FROM e")
    return with_clause + ",\n".join(steps) + "\n" + tail


def two_regressors(y: str, a: str, b: str) -> str:
    """Coefficient of ``a`` in y ~ a + b, as one aggregate expression."""
    def s(u, v):
        return f"covar_pop({u}, {v})"

    return (f"((({s(b, b)}) * {s(a, y)} - {s(a, b)} * {s(b, y)}) / ({s(a, a)} * {s(b, b)} - {s(a, b)} * {s(a, b)}))")
