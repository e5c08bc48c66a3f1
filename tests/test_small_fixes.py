"""Panels with gaps, ties, declared relationships, variable profiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicframe.operators import prep
from civicframe.operators import relational as rel
from civicframe.operators import review
from civicframe.operators import timeseries as ts


def test_two_way_effect_with_gaps_equals_dummies(spark):
    rng = np.random.default_rng(8)
    rows = [(u, t, float(u + 0.5 * t + 2.0 * (u % 2 and t > 6) + rng.normal()), float(u % 2 and t > 6))
            for u in range(20) for t in range(12) if rng.random() > 0.3]
    got = ts.two_way_effect(spark.createDataFrame(rows, "u int, t int, y double, d double"), "u", "t", "y", "d").first()
    x = np.zeros((len(rows), 1 + 20 + 11))
    for i, (u, t, _, d) in enumerate(rows):
        x[i, 0], x[i, 1 + u] = d, 1
        if t:
            x[i, 20 + t] = 1
    y = np.array([r[2] for r in rows])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    assert got["estimate"] == pytest.approx(beta[0], abs=1e-8) and got["n_units"] == 20


def test_modal_failure_breaks_ties_by_the_whole_name(spark):
    rows = [(1, "date b")] * 3 + [(0, "date a")] * 3 + [(1, "zone")] * 2 + [(1, None), (1, "")]
    for order in (rows, rows[::-1]):
        out = review.audit_statistics(spark.createDataFrame(order, "ok int, f string"), "ok", "f").first()
        assert out["modal_failure"] == "date a" and out["n_audited"] == 10


def test_declared_relationships(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, x string")
    b = spark.createDataFrame([(1, "p"), (1, "q"), (3, "r")], "k int, y string")
    assert rel.related_join(a, b, ["k"], "many-to-many").count() == 7
    one = b.filter("y <> 'q'")
    assert rel.related_join(a, one, ["k"], "many-to-one", "inner").count() == 2
    assert rel.related_join(one, a, ["k"], "one-to-many", "inner").count() == 2
    for left, right, kind in ((a, b, "many-to-one"), (a, b, "one-to-many"), (a, one, "one-to-one"), (a, b, "some")):
        with pytest.raises(ValueError, match="relationship|more than once"):
            rel.related_join(left, right, ["k"], kind)


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, "x", 0.0), (2, None, -0.0), (2, "y", None), (None, "x", float("nan"))], "a int, b string, c double")
    got = {r["variable"]: tuple(r)[1:] for r in prep.profile(df).collect()}
    assert got == {"a": ("int", 4, 1, 2), "b": ("string", 4, 1, 2), "c": ("double", 4, 1, 2)}
    empty = {r["variable"]: tuple(r)[2:] for r in prep.profile(df.filter(F.lit(False))).collect()}
    assert empty == dict.fromkeys("abc", (0, 0, 0))
