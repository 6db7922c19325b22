import numpy as np
import pytest

from stationcast.operators import quantiles as Q
from stationcast.operators import trips as TR


@pytest.mark.parametrize("case", ["skewed", "one", "ends", "even"])
def test_weighted_quantiles_match_numpy(spark, case):
    rnd = np.random.default_rng(1)
    v = {"skewed": np.minimum(rnd.zipf(1.3, 3000), 10 ** 12), "one": np.full(5, 7), "ends": np.array([-2 ** 40, 2 ** 40, 3]),
         "even": np.arange(1000)}[case].astype(np.int64)
    w = rnd.integers(1, 6, len(v))
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(v, w)] + [(None, 3), (5, 0)], "v long, w long")
    shares = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    whole = np.repeat(v, w)
    least, got, largest = Q.weighted_quantiles(df, "v", "w", shares)
    assert (least, largest) == (whole.min(), whole.max())
    assert np.allclose(got, np.quantile(whole, shares), rtol=1e-12)


def test_selection_takes_several_passes_with_few_bins(spark):
    df = spark.range(5000).selectExpr("id * id AS v", "1L AS w")
    got = Q.order_statistics(df, "v", "w", [0, 17, 2500, 4999], 0, 4999 ** 2, bins=8)
    assert got == {0: 0, 17: 289, 2500: 2500 ** 2, 4999: 4999 ** 2}


def test_edges_of_no_trips_are_null_and_too_many_values_are_an_error(spark, monkeypatch):
    none = spark.createDataFrame([], "start_station_id string")
    assert tuple(TR.popularity_edges(none).first()) == (None,) * 5
    monkeypatch.setattr(TR, "MOST_VALUES", 3)
    with pytest.raises(ValueError):
        TR.distinct_values(spark.range(4).selectExpr("cast(id as string) AS k"), ["k"])
