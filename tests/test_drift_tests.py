"""Two-sample tests and their tails against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekgrid.functions.tails import chi_square_tail, kolmogorov_tail
from weekgrid.operators import drift

rng = np.random.default_rng(5)


def chi_density_tail(x, df):
    """The tail by Simpson's rule on the density of sqrt(X), which is smooth."""
    u = np.linspace(math.sqrt(x), math.sqrt(x) + math.sqrt(df) + 40, 800_001)
    log = math.log(2) + (df - 1) * np.log(np.maximum(u, 1e-300)) - u * u / 2 - df / 2 * math.log(2) - math.lgamma(df / 2)
    f = np.exp(log)
    return (u[1] - u[0]) / 3 * (f[0] + f[-1] + 4 * f[1:-1:2].sum() + 2 * f[2:-1:2].sum())


def test_chi_square_tail(spark):
    cases = [(x, df) for df in (1, 2, 3, 4, 7, 10, 99, 1500) for x in (0.001, 0.4 * df, df, df + 3 * math.sqrt(2 * df), 2.5 * df + 20)]
    rows = spark.createDataFrame([(float(x), df) for x, df in cases], "x double, df int")
    got = {(r["x"], r["df"]): r["p"] for r in rows.select("*", chi_square_tail(F.col("x"), F.col("df")).alias("p")).collect()}
    assert got == pytest.approx({(float(x), df): chi_density_tail(x, df) for x, df in cases}, abs=1e-9)
    odd = spark.createDataFrame([(0.0, 3), (5.0, 0), (float("inf"), 2), (1e6, 5)], "x double, df int")
    assert [r["p"] for r in odd.select(chi_square_tail(F.col("x"), F.col("df")).alias("p")).collect()] == [1.0, 1.0, 0.0, 0.0]


def test_kolmogorov_tail(spark):
    """Known values of the limiting distribution."""
    known = {1.2238478702170825: 0.1, 1.3580986393225505: 0.05, 1.6276236115189503: 0.01}
    rows = spark.createDataFrame([(z / math.sqrt(50.0), 100, 100) for z in known], "d double, n long, m long")
    got = [r["p"] for r in rows.select(kolmogorov_tail(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()]
    assert got == pytest.approx(list(known.values()), abs=1e-9)


def test_statistics_and_choice(spark):
    n, m = 300, 200
    ref = {"x": rng.normal(size=n), "few": rng.integers(0, 4, n), "flag": rng.integers(0, 2, n), "kind": rng.choice(list("abc"), n), "one": np.ones(n)}
    cur = {"x": rng.normal(0.4, 1, size=m), "few": rng.integers(0, 4, m), "flag": (rng.random(m) < 0.8).astype(int), "kind": rng.choice(list("abcd"), m), "one": np.ones(m)}
    rows = [(float(s["x"][i]), int(s["few"][i]), int(s["flag"][i]), str(s["kind"][i]), float(s["one"][i]), side) for side, s in enumerate((ref, cur)) for i in range(len(s["x"]))]
    rows += [(None, None, None, None, None, 0), (9.0, 9, 9, "z", 9.0, None)]
    df = spark.createDataFrame(rows, "x double, few int, flag int, kind string, one double, side int")
    got = {r["column"]: r for r in drift.tests(df, ["x", "few", "flag", "one"], ["kind"]).collect()}
    values = np.unique(np.concatenate([ref["x"], cur["x"]]))
    gap = max(abs((ref["x"] <= v).mean() - (cur["x"] <= v).mean()) for v in values)
    assert got["x"]["method"] == "kolmogorov_smirnov" and got["x"]["statistic"] == pytest.approx(gap) and got["x"]["drifted"]
    expected = {k: (ref["few"] == k).sum() * m / n for k in range(4)}
    chi = sum(((cur["few"] == k).sum() - e) ** 2 / e for k, e in expected.items())
    assert got["few"]["method"] == "chi_square" and got["few"]["statistic"] == pytest.approx(chi)
    assert got["few"]["score"] == pytest.approx(chi_density_tail(chi, 3), abs=1e-9)
    p, q, both = ref["flag"].mean(), cur["flag"].mean(), np.concatenate([ref["flag"], cur["flag"]]).mean()
    z2 = (p - q) ** 2 / (both * (1 - both) * (1 / n + 1 / m))
    assert got["flag"]["method"] == "proportion" and got["flag"]["statistic"] == pytest.approx(z2) and got["flag"]["drifted"]
    assert got["kind"]["statistic"] == math.inf and got["kind"]["score"] == 0.0
    assert got["one"]["score"] == 1.0 and not got["one"]["drifted"]

    small = {r["column"]: r["method"] for r in drift.columns_report(df, ["x", "few"], ["kind"]).collect()}
    assert small == {"x": "kolmogorov_smirnov", "few": "chi_square", "kind": "chi_square"}
    large = {r["column"]: r["method"] for r in drift.columns_report(df, ["x", "few"], ["kind"], small=250).collect()}
    assert large == {"x": "wasserstein", "few": "jensen_shannon", "kind": "jensen_shannon"}
