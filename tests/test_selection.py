import numpy as np

from stationcast.operators.selection import f_regression_scores


def test_f_scores_match_numpy_and_constant_is_zero(spark):
    rnd = np.random.default_rng(0)
    y = rnd.normal(size=500)
    x1 = y + rnd.normal(size=500)
    x2 = rnd.normal(size=500)
    rows = [(float(a), float(b), 2024.0, float(c)) for a, b, c in zip(x1, x2, y)]
    df = spark.createDataFrame(rows, "x1 double, x2 double, const double, rides double")
    got = {r.feature: r for r in f_regression_scores(df, k=1).collect()}
    for name, x in (("x1", x1), ("x2", x2)):
        r = np.corrcoef(x, y)[0, 1]
        assert abs(got[name].f_score - r * r / (1 - r * r) * (len(y) - 2)) < 1e-6 * max(1, got[name].f_score)
    assert got["const"].f_score == 0.0
    assert got["x1"].selected == 1 and got["x1"].rank == 1


def test_f_scores_merge_over_tasks_and_leave_out_nulls(spark):
    rnd = np.random.default_rng(1)
    y = rnd.normal(1e7, 1.0, 900)
    x = 1e9 + 3 * y + rnd.normal(size=900)
    rows = [(float(a) if i % 9 else None, 5, float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "`x.1` double, const int, rides double").repartition(7)
    got = {r.feature: r.f_score for r in f_regression_scores(df).collect()}
    keep = np.arange(900) % 9 > 0
    r = np.corrcoef(x[keep], y[keep])[0, 1]
    assert abs(got["x.1"] / (r * r / (1 - r * r) * (keep.sum() - 2)) - 1) < 1e-6 and got["const"] == 0.0
    none = f_regression_scores(df.limit(0)).collect()
    assert [r.f_score for r in none] == [0.0, 0.0]
