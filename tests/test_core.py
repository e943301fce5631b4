"""Ordering, quantile, rolling and sampling helpers against NumPy and pandas, on skewed data."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rareflow.functions import rowstats
from rareflow.operators import ordering as od
from rareflow.operators import sampling as sm
from rareflow.operators.quantiles import exact_quantiles, grouped_quantiles
from rareflow.operators.rolling import rolling


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value, one time and one user."""
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame(
        {
            "txn_id": np.arange(n),
            "Time": np.round(rng.uniform(0, 500, n), 1),
            "Amount": np.round(rng.lognormal(3, 1, n), 2),
            "user_id": rng.integers(0, 40, n),
            "Class": (rng.random(n) < 0.05).astype(int),
        }
    )
    hot = rng.random(n) < 0.35
    pdf.loc[hot, "Amount"] = 20.0
    pdf.loc[hot, "Time"] = 250.0
    pdf.loc[hot, "user_id"] = 3
    return pdf, spark.createDataFrame(pdf).persist()


PROBS = [0.0, 0.01, 0.25, 0.5, 0.6, 0.9, 0.999, 1.0]


@pytest.mark.parametrize("inside", [5, 40, 10**6])
def test_selected_quantiles_equal_numpy(skewed, inside):
    pdf, df = skewed
    cols = {"a": F.col("Amount"), "t": F.col("Time"), "n": F.when(F.col("Class") == 1, F.col("Amount"))}
    got = exact_quantiles(df, cols, PROBS, small=0, inside_limit=inside, accuracy=50)
    want = {
        "a": pdf.Amount, "t": pdf.Time, "n": pdf.Amount[pdf.Class == 1],
    }
    for c in cols:
        np.testing.assert_allclose(got[c], np.quantile(want[c], PROBS), rtol=1e-12)


def test_small_and_selected_quantiles_agree(skewed):
    _, df = skewed
    cols = {"a": F.col("Amount"), "t": F.col("Time")}
    a = exact_quantiles(df, cols, PROBS)
    b = exact_quantiles(df, cols, PROBS, small=0, inside_limit=10, accuracy=100)
    for c in cols:
        np.testing.assert_allclose(a[c], b[c], rtol=1e-12)


def test_quantiles_of_empty_and_constant(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None)], "x double, y double")
    for small in (0, 100):
        q = exact_quantiles(df, {"x": F.col("x"), "y": F.col("y")}, [0.5], small=small)
        assert q == {"x": [1.0], "y": [None]}


def test_quantiles_skip_nan_on_both_paths(spark):
    values = [float(i) for i in range(101)] + [float("nan")] * 11 + [None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for small in (0, 1000):
        assert exact_quantiles(df, {"x": F.col("x")}, [0.0, 0.5, 1.0], small=small)["x"] == [0.0, 50.0, 100.0]


def test_quantiles_of_many_columns_at_once(spark):
    """Hundreds of wanted ranks, as mutual information over all columns asks for."""
    x = np.random.default_rng(3).normal(size=(2000, 40))
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{i}" for i in range(40)]))
    probs = [i / 10 for i in range(1, 10)]
    got = exact_quantiles(df, {c: F.col(c) for c in df.columns}, probs, small=0, accuracy=50)
    np.testing.assert_allclose([got[c] for c in df.columns], np.quantile(x, probs, axis=0).T, rtol=1e-12)


@pytest.mark.parametrize("small", [0, 10**6])
def test_grouped_quantiles_with_hot_group(skewed, small):
    pdf, df = skewed
    got = grouped_quantiles(df, ["user_id"], "Amount", {"p50": 0.5, "p95": 0.95}, small=small).toPandas()
    want = pdf.groupby("user_id").Amount.quantile([0.5, 0.95]).unstack()
    got = got.set_index("user_id").sort_index()
    np.testing.assert_allclose(got.p50, want[0.5], rtol=1e-12)
    np.testing.assert_allclose(got.p95, want[0.95], rtol=1e-12)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["user_id"]])
def test_prefix_sums_over_cut_ranges(skewed, by, descending):
    pdf, df = skewed
    counts = od.value_counts(df, "Amount", by).withColumn("cum", F.col("n"))
    got = od.prefix_sums(counts, "Amount", {"cum": "cum"}, by, descending, n=5, small=0).toPandas()
    want = pdf.groupby([*by, "Amount"]).size().rename("n").reset_index()
    want = want.sort_values("Amount", ascending=not descending)
    want["cum"] = want.groupby(by).n.cumsum() if by else want.n.cumsum()
    key = [*by, "Amount"]
    pd.testing.assert_frame_equal(
        got[[*key, "n", "cum"]].sort_values(key).reset_index(drop=True),
        want[[*key, "n", "cum"]].sort_values(key).reset_index(drop=True),
        check_dtype=False,
    )


def test_average_ranks_and_hot_lookup(skewed):
    pdf, df = skewed
    ranks = od.average_ranks(df, "Amount", small=0).select("Amount", "n", "rank")
    got = od.lookup_by_value(df, ranks, "Amount", len(pdf), share=20).toPandas().sort_values("txn_id")
    np.testing.assert_allclose(got["rank"], pdf.Amount.rank(method="average"))


def test_ranges_follow_time_and_key(skewed):
    pdf, df = skewed
    got = od.ordered_ranges(df, "Time", "txn_id", 8).toPandas().sort_values(["Time", "txn_id"])
    assert got["_range"].is_monotonic_increasing
    # the single hot time is split, so no range holds a third of the rows
    assert got.groupby("_range").size().max() < len(pdf) / 4


def _pandas_rolling(pdf, size, lag, by):
    s = pdf.sort_values(["Time", "txn_id"])
    groups = s.groupby("user_id") if by else [(0, s)]
    out = []
    for _, g in groups:
        r = g.Amount.rolling(size, min_periods=1)
        label = g.Class.shift(lag) if lag else g.Class
        out.append(
            pd.DataFrame(
                {
                    "txn_id": g.txn_id, "mean": r.mean(), "n": r.count(),
                    "rate": label.rolling(size, min_periods=1).mean(),
                }
            )
        )
    return pd.concat(out).sort_values("txn_id").reset_index(drop=True)


@pytest.mark.parametrize("by", [[], ["user_id"]])
@pytest.mark.parametrize("lag", [0, 1])
@pytest.mark.parametrize("n", [3, 60])
def test_rolling_over_ranges_equals_pandas(skewed, by, lag, n):
    """With 60 ranges some hold fewer rows than the window reaches back."""
    pdf, df = skewed
    got = rolling(df, (4, 90), lag, by, n=n, small=0).toPandas().sort_values("txn_id")
    assert len(got) == len(pdf)
    for size in (4, 90):
        want = _pandas_rolling(pdf, size, lag, by)
        np.testing.assert_allclose(got[f"Amount_rolling_mean_{size}"], want["mean"], rtol=1e-9)
        np.testing.assert_array_equal(got[f"velocity_{size}"], want["n"])
        np.testing.assert_allclose(
            got[f"positive_rate_rolling_{size}"].astype(float), want["rate"], rtol=1e-9
        )


def test_first_rolling_std_is_null(skewed):
    _, df = skewed
    first = rolling(df, (4,), small=0, n=3).orderBy("Time", "txn_id").first()
    assert first["Amount_rolling_std_4"] is None


def test_row_statistics_equal_pandas(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 7)) ** 3
    x[0] = 1.5  # constant row: no skew, no kurtosis
    cols = [f"V{i}" for i in range(1, 8)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols).assign(i=range(200)))
    got = rowstats.add_row_statistics(df, cols).toPandas().sort_values("i").reset_index(drop=True)
    want = pd.DataFrame(x)
    np.testing.assert_allclose(got.V_std, want.std(axis=1), atol=1e-12)
    np.testing.assert_allclose(got.V_median, want.median(axis=1))
    np.testing.assert_allclose(got.V_skew[1:], want.skew(axis=1)[1:], rtol=1e-9)
    np.testing.assert_allclose(got.V_kurt[1:], want.kurt(axis=1)[1:], rtol=1e-9)
    assert np.isnan(got.V_skew[0]) and np.isnan(got.V_kurt[0])
    p = np.abs(x) / (np.abs(x).sum(axis=1, keepdims=True) + 1e-8)
    np.testing.assert_allclose(got.V_entropy, -(p * np.log(p + 1e-8)).sum(axis=1), rtol=1e-9)


def test_split_sizes_are_exact_and_repeatable(skewed):
    pdf, df = skewed
    parts = (("train", 0.6), ("validation", 0.2), ("test", 0.2))
    a = sm.stratified_split(df, parts).toPandas()
    b = sm.stratified_split(df.repartition(5), parts).toPandas()
    assert a.sort_values("txn_id").split.tolist() == b.sort_values("txn_id").split.tolist()
    for c, n in pdf.groupby("Class").size().items():
        got = a[a.Class == c].groupby("split").size()
        assert got["train"] == int(n * 0.6) and got["validation"] == int(n * 0.2)


def test_folds_sample_and_rebalancing(skewed):
    pdf, df = skewed
    folds = sm.stratified_folds(df, 5).toPandas()
    per = folds.groupby(["Class", "fold"]).size().unstack()
    assert (per.max(axis=1) - per.min(axis=1) <= 1).all()
    assert sm.permutation_sample(df, 500).count() == 500
    assert sm.permutation_sample(df, 10**6).count() == len(pdf)
    n1 = int(pdf.Class.sum())
    under = sm.undersample(df).toPandas()
    assert under.groupby("Class").size().tolist() == [n1, n1]
    over = sm.oversample(df).toPandas()
    assert over.groupby("Class").size().nunique() == 1
    assert set(over[over.Class == 1].txn_id) <= set(pdf[pdf.Class == 1].txn_id)
    ranks = sm.class_ranks(df).toPandas()
    assert sorted(ranks["rank"]) == list(range(len(pdf)))


def test_sized_split(skewed):
    pdf, df = skewed
    got = sm.sized_split(df).groupBy("split").count().toPandas().set_index("split")["count"]
    n = len(pdf)
    assert got["test"] == int(n * 0.2)
    assert got["validation"] == int((n - got["test"]) * 0.1)


def test_bootstrap_weights_average_one(spark):
    w = sm.bootstrap_weights(spark.range(20000), 3, key="id").agg(F.avg("weight"), F.variance("weight")).first()
    assert abs(w[0] - 1) < 0.05 and abs(w[1] - 1) < 0.1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=40), st.integers(1, 9))
def test_part_sizes_cover_all_rows(values, k):
    n = len(values)
    sizes = sm.part_sizes(n, [(str(i), 1 / k) for i in range(k)])
    assert sum(s for _, s in sizes) == n and all(s >= 0 for _, s in sizes)
