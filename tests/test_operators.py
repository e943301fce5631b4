"""Closed forms and invariants of the larger operators."""

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rareflow.functions.bands import AMOUNT_BINS_6, confidence, drift_severity, right_closed_bins
from rareflow.functions.keys import normal_draw
from rareflow.operators import anomaly, boosting, drift, neighbours, quality, sampling, scaling
from rareflow.operators import evaluation as ev
from rareflow.operators import models as md
from rareflow.operators import parzen, perceptron
from rareflow.operators import registry as rg
from rareflow.operators import scoring as sc
from rareflow.operators import selection as sel
from rareflow.operators import tuning as tn
from rareflow.operators.information import nearest_mutual_information
from rareflow.plans import models as plans
from rareflow.plans.catalog import QUERIES
from rareflow.session import fresh_path
from rareflow.sources import tables, views
from rareflow.sources.views import labelled_events, transactions
from rareflow.streaming import state


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.2), (0, 0.2), (0, 0.1)]
    return spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(rows)], "txn_id bigint, label int, score double")


def test_areas_with_ties(scored):
    pairs = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.2, 1), (0.2, 0), (0.1, 0)]
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    auc = np.mean([1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg])
    assert math.isclose(ev.roc_auc(scored).first()[0], auc)
    # thresholds .9, .8, .2: precision 1, 2/3, 3/6
    assert math.isclose(ev.average_precision(scored).first()[0], (1 + 2 / 3 + 0.5) / 3)
    r = ev.all_metrics(scored).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (2, 1, 1, 3)
    trap = (1 / 3) * 1 + (1 / 3) * (1 + 2 / 3) / 2 + (1 / 3) * (0.5 + 0.5) / 2
    assert math.isclose(ev.trapezoid_pr_auc(scored).first()[0], trap, rel_tol=1e-9)


def test_sweep_is_monotone_and_best_threshold_breaks_ties_low(scored):
    sweep = ev.threshold_sweep(scored).orderBy("threshold").toPandas()
    assert len(sweep) == 18
    assert sweep.recall.is_monotonic_decreasing
    best = ev.best_threshold(ev.threshold_sweep(scored), "cost").first()
    assert best.value == sweep.total_cost.min()
    assert best.threshold == sweep[sweep.total_cost == best.value].threshold.min()


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    r = ev.basic_metrics(ev.confusion(ev.binarize(df))).first()
    assert (r.precision, r.recall, r.f1_score, r.accuracy) == (0.0, 0.0, 0.0, 1.0)
    assert ev.binarize(df, 0.0).agg(F.sum("pred")).first()[0] == 2  # threshold 0 is a threshold


def test_bins_and_bands(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.01,), (1000.0,), (5000.0,), (None,)], "x double")
    got = [r[0] for r in df.select(right_closed_bins("x", *AMOUNT_BINS_6)).collect()]
    assert got == [None, "very_low", "low", "very_high", "extreme", None]
    df = spark.createDataFrame([(0.1,), (0.11,), (0.25,), (0.26,), (None,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(drift_severity("x")).collect()]
    assert got == ["No drift", "Minor drift", "Minor drift", "Major drift", "Unknown", "Unknown"]
    df = spark.createDataFrame([(0.8,), (0.2,), (0.6,), (0.4,), (0.5,)], "x double")
    assert [r[0] for r in df.select(confidence("x")).collect()] == ["high", "high", "medium", "medium", "low"]


# ---- neighbours ------------------------------------------------------------


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    x[200:400] = x[200]  # a third of all rows are copies
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(txn_id=range(600), Class=(rng.random(600) < 0.1).astype(int))
    return pdf, spark.createDataFrame(pdf).repartition(4).persist()


def _brute(q, p, k):
    out = {}
    for _, a in q.iterrows():
        d = ((p[list("abcd")] - a[list("abcd")]) ** 2).sum(axis=1)
        d = pd.DataFrame({"d": d, "id": p.txn_id})[p.txn_id != a.txn_id]
        out[int(a.txn_id)] = d.sort_values(["d", "id"]).id.head(k).astype(int).tolist()
    return out


@pytest.mark.parametrize("piece", [7, 1000])
def test_nearest_equals_brute_force(cloud, piece, monkeypatch):
    pdf, df = cloud
    monkeypatch.setattr(neighbours, "POINT_PIECE", piece)
    monkeypatch.setattr(neighbours, "QUERY_PIECE", piece)
    monkeypatch.setattr(neighbours, "CELL_POINTS", 40)
    got = neighbours.nearest(df.where("Class = 1"), df, list("abcd"), 3).toPandas()
    want = _brute(pdf[pdf.Class == 1], pdf, 3)
    got = got.sort_values("place").groupby("query_id").point_id.apply(list).to_dict()
    assert got == want


def test_nearest_on_odd_rows(spark):
    schema = "txn_id long, a double, b double, Class int"
    rows = [(1, 0.0, 0.0, 1), (2, 0.0, None, 0), (3, float("nan"), 1.0, 0), (4, 1.0, 1.0, 1), (5, 1.0, 1.0, 0), (6, float("inf"), 0.0, 1)]
    df = spark.createDataFrame(rows, schema)
    got = neighbours.nearest(df.where("Class = 1"), df, ["a", "b"], 5).collect()
    assert sorted((r.query_id, r.place, r.point_id) for r in got) == [(1, 0, 4), (1, 1, 5), (4, 0, 5), (4, 1, 1)]
    assert neighbours.nearest(df.limit(0), df, ["a", "b"], 2).collect() == []
    assert neighbours.nearest(df, df.limit(0), ["a", "b"], 2).collect() == []
    assert neighbours.nearest(df, df, ["a", "b"], 0).collect() == []


def test_visited_pairs_grow_slower_than_all_pairs(spark):
    """Four times the clusters, rows and queries: far fewer than sixteen times the pairs meet."""
    met = []
    for clusters in (60, 240):
        rng = np.random.default_rng(9)
        x = np.repeat(rng.normal(size=(clusters, 4)) * 40, 60, axis=0) + rng.normal(size=(clusters * 60, 4))
        pdf = pd.DataFrame(x, columns=list("abcd")).assign(txn_id=range(len(x)), Class=0)
        df = spark.createDataFrame(pdf)
        pairs: list[int] = []
        asked = df.where("txn_id % 10 = 0")
        got = neighbours.nearest(asked, df, list("abcd"), 2, pairs=pairs)
        assert got.count() == 2 * asked.count() and 1 <= len(pairs) <= 6
        met.append(sum(pairs) / (len(x) * len(x) / 10))
    assert met[1] < 0.6 * met[0] and met[0] < 0.6


def test_points_lie_in_matrices_and_first_visits_are_planned_at_once(spark):
    rng = np.random.default_rng(5)
    rows = [(i if i % 9 else None, int(i % 2), *map(float, rng.normal(size=3).round(1))) for i in range(600)]
    df = spark.createDataFrame(rows, "txn_id bigint, Class int, a double, b double, c double")
    index = neighbours.indexed(df, list("abc"))
    held = index.placed.collect()
    assert len(held) == len({r["group"] for r in held}) <= len(index.sizes)
    got = sorted((str(i), y, *x) for r in held for i, y, x in zip(r["ids"], r["labels"], np.frombuffer(r["x"]).reshape(-1, 3)))
    assert got == sorted((str(i), y, *x) for i, y, *x in rows)
    # many queries at once and one by one, with ties among the bounds
    cells = neighbours.Cells(rng.normal(size=(40, 3)), rng.integers(0, 4, 40), np.zeros(40), rng.choice([0.1, 3.0], 40))
    x, inf, none = rng.normal(size=(50, 3)), np.full(50, np.inf), np.zeros(50, int)
    visits = cells.visits(x, inf, none, 2, 5)
    d = cells.distances(x)
    bounds = cells.bounds(x, d)
    for i, found in enumerate(visits):
        order = [c for c in np.lexsort((d[i], bounds[i])) if np.isfinite(bounds[i, c])]
        assert list(found) == order[: max(2, int(np.searchsorted(np.cumsum(cells.count[order]), 6)) + 1)]
    groups = neighbours.Groups(rng.integers(0, 5, 40), rng.integers(1, 3, 40), rng.integers(0, 62, 40))
    some, masks = groups.of([*visits, np.zeros(0, int)])
    assert len(some) == len(masks) == 51 and not len(some[-1])
    for cs, gs, ms in zip(visits, some, masks):
        want = Counter()
        for c in cs:
            for g in range(groups.first[c], groups.first[c] + groups.number[c]):
                want[g] |= 1 << int(groups.bit[c])
        assert dict(zip(gs.tolist(), ms.tolist())) == dict(want)


def test_synthetic_variants_read_their_train_rows_where_they_were_written(spark, sf_dir, monkeypatch):
    seen = []
    for name in ("smote_rows", "adasyn_rows"):
        make = getattr(neighbours, name)
        monkeypatch.setattr(neighbours, name, lambda df, features, make=make: seen.append(df.inputFiles()) or make(df, features))
    found = QUERIES["IO5_synthetic_variants"](spark, sf_dir).collect()
    assert {r.variant for r in found} == {"smote", "adasyn"} and len(seen) == 2
    assert all("train-rows" in f for files in seen for f in files) and seen[0] == seen[1]


def test_visits_are_planned_in_bounded_memory_and_sent_once_a_group():
    """Thousands of queries and pivots: no task holds all their distances, and near cells share a group."""
    import tracemalloc

    rng = np.random.default_rng(4)
    x = rng.normal(size=(2048, 8))
    cells = neighbours.Cells(x, np.full(2048, 500), np.zeros(2048), np.full(2048, 2.0))
    groups, sizes = neighbours._groups(cells)
    assert sizes.sum() == 2048 * 500 and sizes.max() <= neighbours.POINT_PIECE and len(sizes) < 60
    rows = rng.normal(size=(6000, 8))
    frame = pd.DataFrame({"query_id": range(6000), "x": list(rows), "done": 0, "kth": np.nan})
    tracemalloc.start()
    planned = pd.concat(p.drop(columns="x") for p in neighbours._planner(cells, groups, 128, 5)([frame]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    assert (planned.met == 128 * 500).all() and planned.groups.map(len).mean() < 64
    assert all(sum(bin(m).count("1") for m in ms) == 128 for ms in planned.masks[:50])


def test_tomek_links_equal_brute_force(cloud):
    pdf, df = cloud
    one = {k: v[0] for k, v in _brute(pdf, pdf, 1).items()}
    label = pdf.set_index("txn_id").Class
    want = {(a, b) for a, b in one.items() if label[a] == 1 and label[b] == 0 and one[b] == a}
    got = neighbours.tomek_links(df, list("abcd")).toPandas()
    assert set(zip(got.positive_id, got.negative_id)) == want


def test_synthetic_rows_lie_between_positives(cloud):
    pdf, df = cloud
    made = neighbours.smote_rows(df, list("abcd")).toPandas()
    assert len(made) == (pdf.Class == 0).sum() - (pdf.Class == 1).sum()
    x = pdf.set_index("txn_id")[list("abcd")]
    a, b = x.loc[made.base_id].to_numpy(), x.loc[made.point_id].to_numpy()
    m = made[list("abcd")].to_numpy()
    assert ((m >= np.minimum(a, b) - 1e-9) & (m <= np.maximum(a, b) + 1e-9)).all()
    both = neighbours.with_synthetic(df, neighbours.smote_rows(df, list("abcd")), list("abcd"))
    assert both.select("txn_id").distinct().count() == both.count() == 2 * (pdf.Class == 0).sum()


# ---- quality, drift, scaling ------------------------------------------------


def test_schema_and_rates(spark, sf_dir):
    df = transactions(spark, sf_dir)
    assert quality.validate_schema(df, ["Time", "Amount"]) == (True, [])
    ok, errors = quality.validate_schema(df.drop("Class"), ["Time", "Class"])
    assert not ok and errors == ["missing required column Class"]
    every = df.withColumn("Class", F.lit(1))
    assert "unusually high" in quality.rate_check(every).first().message


def test_fill_and_duplicates(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 3.0)], "txn_id bigint, x double")
    filled = quality.fill_missing(df, quality.fit_fill_values(df, ["x"]))
    assert filled.count() == 4 and filled.where("x IS NULL").count() == 0
    assert quality.drop_duplicate_rows(df, "txn_id").count() == 3
    with pytest.raises(ValueError):
        quality.fit_fill_values(df, ["x"], "mode")


def test_no_drift_between_equal_tables(spark, sf_dir):
    df = transactions(spark, sf_dir)
    report = drift.drift_report(df, df, ["V1", "Amount"]).toPandas()
    assert (report.psi.abs() < 1e-9).all() and (report.ks_stat == 0).all()
    assert not drift.drift_verdict(drift.drift_report(df, df, ["V1"])).first().drift_detected


def test_ks_p_value_against_known_points(spark):
    # Kolmogorov tail: Q(1.3581) = 0.05, Q(1.6276) = 0.01
    n = 20000
    for x, p in ((1.3581, 0.05), (1.6276, 0.01)):
        d = x / math.sqrt(n / 2)
        got = spark.range(1).select(drift.ks_p_value(F.lit(d), F.lit(n), F.lit(n))).first()[0]
        assert abs(got - p) < 1e-4


def test_psi_with_few_values_and_an_empty_bin(spark):
    a = spark.createDataFrame([(1.0,)] * 6 + [(2.0,)] * 4, "x double")
    b = spark.createDataFrame([(1.0,)] * 10, "x double")
    got = drift.psi_equal_width(a, b, ["x"]).first().psi
    e = 1e-10
    assert math.isclose(got, (1 - 0.6) * math.log(1 / 0.6) + (e - 0.4) * math.log(e / 0.4), rel_tol=1e-9)


def test_scaler_reuse_and_schema(spark, sf_dir):
    df = transactions(spark, sf_dir)
    p = scaling.fit_scaler(df, ["V1", "Amount"], "standard")
    again = scaling.params_from_frame(scaling.params_frame(spark, p))
    assert again == dict(p)
    aligned = scaling.align_to_schema(df)
    assert scaling.matches_schema(aligned) and len(aligned.columns) == 50
    constant = scaling.fit_scaler(df.withColumn("k", F.lit(2.0)), ["k"], "minmax")
    assert constant["k"].scale == 1.0


def test_kendall_of_many_values_is_exact(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=6000)
    pdf = pd.DataFrame({"x": x, "y": x + 0.4 * draw.normal(size=6000), "z": draw.integers(0, 40, 6000).astype(float)})
    got = {(r.left, r.right): r.corr for r in sel.kendall_pairs(spark.createDataFrame(pdf).repartition(5), ["x", "y", "z"]).collect()}
    for a, b in (("x", "y"), ("x", "z"), ("y", "z")):
        p, q = pdf[a].to_numpy(), pdf[b].to_numpy()
        dp, dq = np.sign(p[:, None] - p[None, :]).astype(np.int8), np.sign(q[:, None] - q[None, :]).astype(np.int8)
        want = (dp * dq).sum(dtype=np.int64) / np.sqrt(float(np.count_nonzero(dp)) * float(np.count_nonzero(dq)))
        assert abs(got[a, b] - want) < 1e-12


def test_kendall_and_spearman_against_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"x": rng.integers(0, 9, 400).astype(float)})
    pdf["y"] = pdf.x + rng.integers(0, 5, 400)
    pdf["z"] = np.where(rng.random(400) < 0.4, 1.0, rng.normal(size=400))
    df = spark.createDataFrame(pdf)
    for name, fn in (("spearman", sel.spearman_pairs), ("kendall", sel.kendall_pairs)):
        cols = ["x", "y", "z"] if name == "spearman" else ["x", "y"]
        for r in fn(df, cols).collect():
            a, b = pdf[r.left], pdf[r.right]
            if name == "spearman":
                want = a.rank().corr(b.rank())
            else:
                dx, dy = np.sign(np.subtract.outer(a.values, a.values)), np.sign(np.subtract.outer(b.values, b.values))
                want = (dx * dy).sum() / math.sqrt((dx * dx).sum() * (dy * dy).sum())
            assert math.isclose(r.corr, want, abs_tol=1e-9)


def test_greedy_drop_keeps_the_higher_variance():
    corr = [[1, 0.99, 0.1], [0.99, 1, 0.97], [0.1, 0.97, 1]]
    kept = sel.greedy_correlation_drop(["a", "b", "c"], corr, {"a": 1.0, "b": 2.0, "c": 3.0})
    assert kept == ["c"]


def test_greedy_drop_judges_pairs_of_dropped_columns():
    corr = [[1, 0.99, 0.1], [0.99, 1, 0.97], [0.1, 0.97, 1]]
    kept = sel.greedy_correlation_drop(["a", "b", "c"], corr, {"a": 3.0, "b": 2.0, "c": 1.0})
    assert kept == ["a"]


def test_keys_of_two_seeds_are_unrelated(spark):
    from rareflow.functions.keys import perm_key, unit_draw

    ids = spark.range(20_000)
    pdf = ids.select("id", perm_key("id", 42).alias("a"), perm_key("id", 43).alias("b"), unit_draw("id", 42).alias("u"), unit_draw("id", 43).alias("v")).toPandas()
    assert pdf.a.is_unique and pdf.b.is_unique
    first = [set(pdf.nsmallest(4000, c).id) for c in ("a", "b")]
    assert 700 < len(first[0] & first[1]) < 900
    assert abs(pdf.u.corr(pdf.v)) < 0.03 and abs(pdf.u.mean() - 0.5) < 0.01


# ---- models -----------------------------------------------------------------

COLS = ["V1", "V2", "V3", "Amount"]


@pytest.fixture(scope="module")
def separable(spark, sf_dir):
    """Positives moved, so that a working model must rank them high."""
    df = transactions(spark, sf_dir)
    moved = df.withColumn("V1", F.col("V1") + F.col("Class") * 4.0)
    return moved.select("txn_id", "Class", *COLS).persist()


@pytest.mark.parametrize(
    "make", [lambda: md.logistic(1.0, n=1000), lambda: md.forest(10, 4, 1), lambda: md.boosted(5, 3)]
)
def test_models_learn_and_survive_saving(separable, spark, make):
    from pyspark.ml import PipelineModel

    m = md.fit(separable, COLS, make())
    out = md.score(separable, m)
    lo, hi = out.agg(F.min("score"), F.max("score")).first()
    assert 0 <= lo <= hi <= 1
    assert ev.roc_auc(out).first()[0] > 0.9
    path = fresh_path(spark, "model")
    m.write().overwrite().save(path)
    again = md.score(separable, PipelineModel.load(path)).withColumnRenamed("score", "s2")
    diff = out.join(again.select("txn_id", "s2"), "txn_id").agg(F.max(F.abs(F.col("score") - F.col("s2")))).first()[0]
    assert diff == 0


def test_adaboost_and_net(separable):
    boosted = md.fit_adaboost(separable, COLS, rounds=4, every=2)
    out = boosted.transform(separable).select(F.col("Class").alias("label"), "score")
    assert ev.roc_auc(out).first()[0] > 0.85
    net = md.fit(md.rebalanced_for_net(separable), COLS, md.perceptron(len(COLS), (8,), 30), weights=None)
    assert ev.roc_auc(md.score(separable, net)).first()[0] > 0.9


def test_ensembles(separable):
    base = {"a": lambda: md.logistic(1.0, n=1000), "b": lambda: md.forest(5, 3, 1)}
    models = {n: md.fit(separable, COLS, f()) for n, f in base.items()}
    scored = md.member_scores(separable, models).withColumn("label", F.col("Class"))
    w, ap = md.search_weights(scored, ["a", "b"])
    assert math.isclose(sum(w), 1.0) and min(w) >= 0
    rows = scored.select("label", "score_a", "score_b").toPandas()

    def precision(scores):
        order = rows.assign(s=scores).groupby("s").label.agg(["sum", "count"]).sort_index(ascending=False).cumsum()
        recall = order["sum"] / order["sum"].iloc[-1]
        return float((recall.diff().fillna(recall.iloc[0]) * order["sum"] / order["count"]).sum())

    every = [precision(rows.score_a * k / 20 + rows.score_b * (20 - k) / 20) for k in range(0, 21, 2)]
    assert math.isclose(ap, precision(rows.score_a * w[0] + rows.score_b * w[1]), rel_tol=1e-9)
    assert ap >= max(every) - 1e-12
    stacked = md.fit_stacking(separable, COLS, base, folds=3)
    assert ev.roc_auc(md.score(separable, stacked)).first()[0] > 0.9


def test_failing_model_is_skipped(separable):
    makers = {"good": lambda: md.logistic(1.0, n=1000), "bad": lambda: md.forest(0, 3)}
    table, best, models = md.train_several(separable, separable, separable, COLS, makers)
    assert best == "good" and list(models) == ["good"]
    assert table.where("model = 'bad' AND split = 'failed'").count() == 1


def test_searches_and_selection(separable):
    _, grid = tn.grid_search(separable, COLS, md.logistic(1.0), {"regParam": [0.01, 10.0]}, folds=2)
    assert grid.count() == 2 and grid.where("is_best").count() == 1
    a = tn.random_trials(md.boosted(5), tn.BOOSTED_RANGES, 5)
    b = tn.random_trials(md.boosted(5), tn.BOOSTED_RANGES, 5)
    assert [sorted(x.values()) for x in a] == [sorted(x.values()) for x in b]
    kept, history = tn.recursive_elimination(separable, COLS, lambda: md.logistic(1.0, n=1000), least=2, folds=2)
    assert "V1" in kept and history.count() == 3
    assert "V1" in [c for c, _ in tn.select_from_model(separable, COLS, md.forest(5, 3), "mean")]
    freq = tn.stability(separable, COLS, lambda s: md.forest(5, 3, 1, s), rounds=3).toPandas().set_index("feature")
    assert freq.frequency["V1"] == 1.0


def test_perceptron_is_trained_like_sparks_own_and_not_by_it(separable, monkeypatch):
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import StandardScaler

    rows = md.rebalanced_for_net(separable)
    scaler, net = md.perceptron(len(COLS), (8, 3), 12)
    assert isinstance(scaler, StandardScaler)
    own = MultilayerPerceptronClassifier(featuresCol="scaled", layers=[len(COLS), 8, 3, 2], maxIter=12, seed=42)
    want = md.fit(rows, COLS, [scaler, own], weights=None).stages[-1]
    monkeypatch.setattr(perceptron, "AT_ONCE", 100)
    monkeypatch.setattr(perceptron, "MATRIX_ROWS", 256)
    fit, rounds = MultilayerPerceptronClassifier._fit, []
    monkeypatch.setattr(MultilayerPerceptronClassifier, "_fit", lambda self, df: rounds.append((self.getMaxIter(), df.count())) or fit(self, df))
    got = md.fit(rows, COLS, [scaler, net], weights=None).stages[-1]
    assert rounds == [(0, 2), (0, 2)]  # Spark's passes over rows see none of the table
    assert type(got) is type(want) and got.getMaxIter() == 12 and not got.isSet("initialWeights")
    assert np.allclose(got.weights.toArray(), want.weights.toArray(), rtol=1e-7, atol=1e-9)


def test_perceptron_gradient_and_steps():
    rng = np.random.default_rng(3)
    x, y, layers = rng.normal(size=(40, 3)), rng.integers(0, 2, 40), [3, 4, 2]
    w = rng.normal(size=3 * 4 + 4 + 4 * 2 + 2)
    slope = np.zeros(len(w))
    loss = perceptron.gradient(x, y, w, layers, slope)
    for i in range(len(w)):
        near = w.copy()
        near[i] += 1e-6
        assert math.isclose((perceptron.gradient(x, y, near, layers, np.zeros(len(w))) - loss) / 1e-6, slope[i], abs_tol=1e-3)
    bowl = np.array([1.0, 50.0, 3.0])
    least = perceptron.minimized(lambda p: (float(bowl @ np.square(p - 2.0)) + 1.0, 2 * bowl * (p - 2.0)), np.zeros(3), 60, 1e-12)
    assert np.allclose(least, 2.0, atol=1e-4)


def test_permutation_importance_finds_the_moved_column(separable):
    m = md.fit(separable, COLS, md.logistic(1.0, n=1000))
    drop = md.permutation_importance(separable, m, COLS, ["V1", "V2"]).toPandas().set_index("feature").ap_drop
    assert drop["V1"] > drop["V2"]


def test_permutation_importance_covers_every_column_and_row(separable, spark, sf_dir):
    m = md.fit(separable, COLS, md.logistic(1.0, n=1000))
    keyless = separable.withColumn("txn_id", F.when(F.col("txn_id") % 5 != 0, F.col("txn_id")))
    drop = md.permutation_importance(keyless, m, COLS).collect()
    assert [r.feature for r in drop] == list(COLS)
    rows = md._exchanged(keyless, COLS, ["Class", *COLS], "txn_id", 42, 64).toPandas()
    assert len(rows) == separable.count()
    for i, c in enumerate(COLS):  # each value goes to exactly one other row
        assert sorted(rows[f"_new_{i}"]) == sorted(rows[c]) and (rows[f"_new_{i}"] != rows[c]).mean() > 0.9
    # the same exchange, rank by rank in NumPy
    whole = md._exchanged(separable, COLS, ["Class", *COLS], "txn_id", 42, 64)
    ranks = sampling.class_ranks(separable, "txn_id", 42).orderBy("rank").toPandas()
    n = len(ranks)
    for i, c in enumerate(COLS):
        want = ranks[c].to_numpy()[(np.arange(n) - (n // 2 + i * 7 + 1)) % n]
        assert sorted(zip(ranks[c], want)) == sorted(whole.select(c, f"_new_{i}").toPandas().itertuples(index=False, name=None))
    found = plans.COLS
    assert [r.feature for r in QUERIES["M14_permutation_importance"](spark, sf_dir).collect()] == found


def test_anomaly_scores(separable):
    forest = anomaly.fit_isolation_forest(separable, COLS, trees=20, sample=64)
    out = anomaly.score_isolation_forest(separable, forest).toPandas()
    assert out.anomaly_score.between(0, 1).all()
    assert out.is_anomaly.sum() == pytest.approx(0.002 * len(out), abs=1)
    far = separable.limit(1).select(F.lit(-1).cast("bigint").alias("txn_id"), F.lit(0).alias("Class"), *[F.lit(50.0).alias(c) for c in COLS])
    both = anomaly.score_isolation_forest(separable.unionByName(far), forest).toPandas()
    assert both.set_index("txn_id").anomaly_score[-1] > both.anomaly_score.quantile(0.95)
    model = anomaly.fit_reconstruction(separable, COLS, k=2, contamination=0.05)
    rec = anomaly.score_reconstruction(separable, model).toPandas()
    assert rec.anomaly_score.between(0, 1).all() and (rec.reconstruction_error >= 0).all()
    assert rec[rec.Class == 0].is_anomaly.mean() == pytest.approx(0.05, abs=0.01)


# ---- sources, registry, feedback ---------------------------------------------


def test_csv_rules(spark, sf_dir):
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, "/no/such/path")
    path = fresh_path(spark, "bad")
    spark.createDataFrame([("x", "y")], "Time string, Amount string").write.option("header", True).csv(path)
    with pytest.raises(Exception):
        tables.read_csv(spark, path, "Time double, Amount double").collect()


def test_stored_table_is_reused_unless_forced(spark):
    path = fresh_path(spark, "stored")
    calls = []

    def make(n):
        calls.append(n)
        return spark.range(n)

    assert tables.stored_or_created(spark, path, lambda: make(3)).count() == 3
    assert tables.stored_or_created(spark, path, lambda: make(5)).count() == 3
    assert tables.stored_or_created(spark, path, lambda: make(5), force=True).count() == 5
    assert calls == [3, 5]


def test_synthetic_counts(spark):
    df = tables.synthetic(spark, 5000, 0.0137)
    assert df.count() == 5000 and df.agg(F.sum("Class")).first()[0] == int(5000 * 0.0137)
    pdf = df.orderBy("txn_id").toPandas()
    assert pdf.Time.is_monotonic_increasing and pdf.Time.max() < 172800 and (pdf.Amount >= 0).all()


def test_registry_keeps_the_newest(spark):
    def entry(name, date, auc):
        return (f"{name}_1", name, "1", "t", "p", {"test_roc_auc": auc}, 1, date, 0.0, "active", None, {})

    old = spark.createDataFrame([entry("a", "2024-01-01", 0.7), entry("b", "2024-01-01", 0.8)], rg.SCHEMA)
    reg = rg.register(old, spark.createDataFrame([entry("a", "2024-02-01", 0.9)], rg.SCHEMA))
    assert reg.count() == 2
    assert rg.best_model(reg).first().model_id == "a_1"
    assert rg.best_model(rg.deprecate(reg, "a_1")).first().model_id == "b_1"
    assert [r.score for r in rg.ranking(reg, "missing").collect()] == [0.0, 0.0]
    assert [r.model_id for r in rg.list_models(reg).collect()] == ["a_1", "b_1"]


def test_latest_feedback_wins(spark):
    rows = [("1", 0, "2024-01-01 00:00:00"), ("1", 1, "2024-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "transaction_id string, feedback_label int, feedback_at string")
    assert sc.latest_feedback(df).first().feedback_label == 1


def test_scored_batch_equals_streamed_columns(spark, sf_dir):
    from rareflow.streaming import sources as src

    stream = src.run_append(src.event_stream(spark, sf_dir).select("txn_id", "score", "pred"), "same")
    assert stream.count() == labelled_events(spark, sf_dir).count()


def test_late_rows_are_counted(spark, sf_dir):
    import __spark_entry__ as entry

    r = entry.queries()["ST7_late_rows"](spark, sf_dir).first()
    newer = labelled_events(spark, sf_dir).where("ts >= TIMESTAMP_NTZ'2024-01-16 00:00:00'").count()
    assert r.late_groups_dropped > 0
    assert 0 < r.rows_counted <= newer  # no row of the older half is counted


def test_parzen_beats_random_draws_on_a_known_surface():
    def surface(u):
        return -((u[0] - 0.23) ** 2) - 4 * (u[1] - 0.81) ** 2 - 0.5 * abs(u[2] - 0.5)

    guided, random_ = [], []
    for seed in range(12):
        rng, done = np.random.default_rng(seed), []
        while len(done) < 60:
            units = [rng.random(3) if len(done) < 10 else parzen.propose(done, 3, rng) for _ in range(4)]
            done += [(u, surface(u)) for u in units]
        guided.append(max(m for _, m in done))
        random_.append(max(surface(u) for u in np.random.default_rng(100 + seed).random((60, 3))))
    assert np.mean(guided) > 0.5 * np.mean(random_) and sum(g > r for g, r in zip(guided, random_)) >= 9


def test_parzen_densities_and_ranges():
    centres = np.array([0.1, 0.15, 0.9])
    x = np.linspace(0, 1, 20_001)
    assert math.isclose(np.exp(parzen.log_density(x, centres)).mean(), 1.0, rel_tol=1e-3)
    drawn = parzen.draw(centres, np.random.default_rng(1), 4000)
    assert drawn.min() >= 0 and drawn.max() <= 1 and (drawn < 0.4).mean() > 0.5
    whole, log = parzen.Range(3, 10), parzen.Range(0.01, 0.3, log=True)
    assert {whole.value(u) for u in np.linspace(0, 1, 400)} == set(range(3, 11))
    assert math.isclose(log.value(0.5), math.sqrt(0.003)) and math.isclose(log.value(0), 0.01) and math.isclose(log.value(1), 0.3)


def test_parzen_search_on_rows(separable):
    ranges = {"regParam": parzen.Range(1e-5, 1.0, log=True), "elasticNetParam": parzen.Range(0.0, 1.0)}
    best, table = parzen.parzen_search(
        separable, COLS, lambda v: md.logistic(1.0).copy().setParams(**v), ranges, trials=10, startup=4, batch=2, folds=2
    )
    rows = table.orderBy("trial").collect()
    assert [r.trial for r in rows] == list(range(10)) and sum(r.is_best for r in rows) == 1
    assert all(1e-5 <= r.regParam <= 1 and 0 <= r.elasticNetParam <= 1 for r in rows)
    top = next(r for r in rows if r.is_best)
    assert not top.stopped and top.metric == max(r.metric for r in rows if not r.stopped) and best["regParam"] == top.regParam
    assert all(r.folds == 2 or r.stopped for r in rows)


def test_trial_below_the_median_stops():
    others = [parzen.Trial(i, np.zeros(1), [v, v]) for i, v in enumerate((0.1, 0.2, 0.3, 0.4))]
    assert parzen.should_stop(parzen.Trial(9, np.zeros(1), [0.24]), others)
    assert not parzen.should_stop(parzen.Trial(9, np.zeros(1), [0.26]), others)
    assert not parzen.should_stop(parzen.Trial(9, np.zeros(1), [0.0]), others[:3])


def test_spearman_ranks_each_pair_by_itself(spark):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame(rng.integers(0, 40, (400, 3)).astype(float), columns=list("xyz"))
    pdf["y"] += pdf.x
    pdf.loc[rng.random(400) < 0.5, "z"] = None
    pdf.loc[rng.random(400) < 0.2, "x"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, y double, z double")
    want = pdf.corr(method="spearman")
    for r in sel.spearman_pairs(df, list("xyz")).collect():
        assert math.isclose(r.corr, want.loc[r.left, r.right], abs_tol=1e-9)


def test_rolling_values_of_late_history():
    rows = [(1, 1, 2.0, 0), (2, 2, 4.0, 1), (3, 3, None, None), (4, 4, 9.0, 1)]
    got = state.rolling_values(rows, 2, (3,))
    assert got == [[3.0, pytest.approx(2**0.5), 3, 0.5], [6.5, pytest.approx(12.5**0.5), 3, 1.0]]


def test_appended_files_have_the_wanted_size(spark, tmp_path):
    """A busy day is split by its bytes, quiet ones get one file each."""
    rows = spark.range(60_000).select(
        F.col("id").alias("transaction_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") < 58_000, "2024-01-01").otherwise(F.concat(F.lit("2024-01-0"), 2 + F.col("id") % 4)).cast("date").alias("created_date"),
        F.lit("v1").alias("model_version"),
    ).repartition(8)
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "512k")
    try:
        tables.append_predictions(rows, str(tmp_path / "out"))
    finally:
        spark.conf.unset(name)
    files = Counter(f.parent.parent.name for f in (tmp_path / "out").rglob("part-*.parquet"))
    assert files["created_date=2024-01-01"] >= 4 and all(n <= 2 for day, n in files.items() if not day.endswith("01"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60_000


def test_normal_draws_look_normal_and_do_not_depend_on_partitions(spark):
    a, b = (spark.range(20_000).repartition(n).select("id", normal_draw("id", 7).alias("x")).orderBy("id").toPandas().x for n in (1, 6))
    assert (a == b).all() and abs(a.mean()) < 0.03 and abs(a.std() - 1) < 0.03 and abs((a.abs() < 1.96).mean() - 0.95) < 0.01


# ---- boosted trees -----------------------------------------------------------


def _numpy_tree(codes, g, h, s):
    """Plain recursion over passes: every split by trying each feature and cut on the rows themselves."""
    node, feature, cut, value = np.zeros(len(g), int), {}, {}, {}
    open_, leaves = [0], 1
    for _ in range(s.depth):
        found = []
        for n in open_:
            rows, best = node == n, None
            all_g, all_h = g[rows].sum(), h[rows].sum()
            for f in range(codes.shape[1]):
                for c in sorted(set(codes[rows, f]))[:-1]:
                    left = rows & (codes[:, f] <= c)
                    lg, lh = g[left].sum(), h[left].sum()
                    rg, rh = all_g - lg, all_h - lh
                    if min(lh, rh) < s.least_hessian:
                        continue
                    gain = lg**2 / (lh + s.ridge) + rg**2 / (rh + s.ridge) - all_g**2 / (all_h + s.ridge)
                    if gain > s.least_gain and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, c, lg, lh, rg, rh)
            if best:
                found.append((best, n))
        open_ = []
        for (_, f, c, lg, lh, rg, rh), n in sorted(found, key=lambda x: (-x[0][0], x[1])):
            if leaves >= s.leaves:
                break
            leaves += 1
            feature[n], cut[n] = f, c
            value[2 * n + 1], value[2 * n + 2] = -s.rate * lg / (lh + s.ridge), -s.rate * rg / (rh + s.ridge)
            mine = node == n
            node[mine] = 2 * n + 1 + (codes[mine, f] > c)
            open_ += [2 * n + 1, 2 * n + 2]
        if not open_ or leaves >= s.leaves:
            break
    return feature, cut, value, node


def test_boosted_trees_equal_numpy(spark):
    rng = np.random.default_rng(14)
    x = rng.normal(size=(300, 3)).round(1)
    y = ((x[:, 0] * x[:, 1] > 0.2) | (rng.random(300) < 0.1)).astype(int)
    pdf = pd.DataFrame(x, columns=list("abc")).assign(Class=y)
    pdf.loc[::17, "b"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, Class int")
    s = boosting.Settings(rounds=3, depth=3, leaves=6, bins=8, rate=0.3, positive_weight=2.0, least_hessian=0.5)
    model = boosting.fit_boosted(df, list("abc"), s)
    probs = [i / 8 for i in range(1, 8)]
    edges = [np.array(sorted(set(np.quantile(pdf[c].dropna(), probs, method="inverted_cdf")))) for c in "abc"]
    codes = np.stack([np.where(pdf[c].isna(), 0, np.searchsorted(e, pdf[c]) + 1) for c, e in zip("abc", edges)], axis=1)
    margin, weight = np.full(300, model.start), np.where(y == 1, 2.0, 1.0)
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        feature, cut, value, node = _numpy_tree(codes, weight * (p - y), weight * p * (1 - p), s)
        assert {int(n): int(f) for n, f in enumerate(tree.feature) if f >= 0} == feature
        assert {n: int(tree.cut[n]) for n in feature} == {n: int(c) for n, c in cut.items()}
        assert all(math.isclose(tree.value[n], v, rel_tol=1e-9) for n, v in value.items())
        margin = margin + np.array([value.get(n, 0.0) for n in node])
    got = model.score(df.withColumn("i", F.monotonically_increasing_id())).orderBy("i").toPandas()
    assert len(model.trees) == 3 and np.allclose(sorted(got.score), sorted(1 / (1 + np.exp(-margin))))
    assert sum(n for _, n in model.importances()) == sum((t.feature >= 0).sum() for t in model.trees)


def test_boosting_stops_early_and_on_odd_tables(spark, separable):
    df = separable.select("Class", *COLS)
    a, b = df.randomSplit([0.7, 0.3], seed=1)
    noise = b.withColumn("Class", (F.rand(3) < 0.5).cast("int"))
    s = boosting.Settings(rounds=12, depth=2, leaves=4, bins=8, patience=2)
    model = boosting.fit_boosted(a, COLS, s, noise)
    best = min(range(len(model.losses)), key=lambda i: model.losses[i][1])
    assert len(model.trees) == best + 1 and len(model.losses) <= best + 3
    assert model.losses[-1][0] < model.losses[0][0]
    none = boosting.fit_boosted(df.where("Class = 0"), COLS, s)
    assert none.trees == [] and none.score(df.limit(3)).where("score < 0.1").count() == 3
    assert boosting.fit_boosted(df.limit(0), COLS, s).trees == []


# ---- mutual information by neighbours ---------------------------------------


def _psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))


def _neighbour_information(x, y, k=3):
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    terms = []
    for i in range(len(x)):
        mine = np.flatnonzero(y == y[i])
        near = np.sort(np.abs(x[mine[mine != i]] - x[i]))
        k_i = min(k, len(near))
        d = near[k_i - 1]
        inside = ((x > x[i] - d) & (x < x[i] + d)).sum() if d > 0 else (x == x[i]).sum()
        terms.append(_psi(k_i) - _psi(len(mine)) - _psi(inside))
    return max(0.0, _psi(len(x)) + np.mean(terms))


@pytest.mark.parametrize("k", [1, 3, 5])
def test_nearest_mutual_information_equals_brute_force(spark, k):
    rng = np.random.default_rng(15)
    y = (rng.random(300) < 0.2).astype(int)
    y[:4], y[4] = 2, 3  # a class with fewer rows than neighbours, and a single row
    pdf = pd.DataFrame({"a": rng.normal(size=300) + 2 * y, "b": rng.integers(0, 9, 300).astype(float), "c": rng.normal(size=300), "Class": y})
    df = spark.createDataFrame(pdf).repartition(3)
    got = {r.feature: r.mutual_information for r in nearest_mutual_information(df, list("abc"), k=k).collect()}
    assert all(math.isclose(got[c], _neighbour_information(pdf[c].to_numpy(), y, k), abs_tol=1e-8) for c in "abc")
    assert nearest_mutual_information(df.limit(0), ["a"]).collect() == []
    some = df.withColumn("a", F.when(F.col("c") > 0, F.col("a")).when(F.col("c") > -0.5, F.lit(float("nan"))))
    kept = pdf[pdf.c > 0]
    got = nearest_mutual_information(some, ["a"], k=k).first().mutual_information
    assert math.isclose(got, _neighbour_information(kept.a.to_numpy(), kept.Class.to_numpy(), k), abs_tol=1e-8)


def test_preparation_reads_the_cleaned_rows_once_written(spark, sf_dir):
    """The join and the grouping that drops copies are no part of what later jobs run."""
    from rareflow.operators.prepare import prepare

    out = prepare(transactions(spark, sf_dir).limit(300))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    assert out.count() == out.select("txn_id").distinct().count() == 300


def test_parzen_search_reads_each_fold_once_for_a_batch(spark, separable, monkeypatch):
    """Vectors are made once, and one pass scores all models of a batch."""
    made, scored, one = [], [], md.member_scores
    assembled = md.assembler
    monkeypatch.setattr(md, "assembler", lambda cols: made.append(1) or assembled(cols))
    monkeypatch.setattr(md, "member_scores", lambda df, models: scored.append(len(models)) or one(df, models))
    ranges = {"regParam": parzen.Range(1e-5, 1.0, log=True)}
    make = lambda v: md.logistic(1.0).copy().setParams(**v)
    best, table = parzen.parzen_search(separable, COLS, make, ranges, trials=4, startup=4, batch=4, folds=2)
    assert len(made) == 1 and scored == [4, 4]
    rows = sampling.stratified_folds(separable.select("txn_id", "Class", *COLS), 2, "Class")
    for r in table.collect():
        found = []
        for k in range(2):
            m = md.fit(rows.where(F.col("fold") != k), COLS, make({"regParam": r.regParam}))
            found.append(ev.average_precision(md.score(rows.where(F.col("fold") == k), m)).first()[0])
        assert math.isclose(r.metric, sum(found) / 2, rel_tol=1e-6)


def test_parzen_search_ranks_all_models_of_a_batch_together(separable, monkeypatch):
    ranked, one = [], ev.average_precision
    monkeypatch.setattr(ev, "average_precision", lambda df, by=(): ranked.append((list(by), df.select(*by).distinct().count() if by else 1)) or one(df, by))
    make = lambda v: md.logistic(1.0).copy().setParams(**v)
    parzen.parzen_search(separable, COLS, make, {"regParam": parzen.Range(1e-5, 1.0, log=True)}, trials=3, startup=3, batch=3, folds=2)
    assert ranked == [(["candidate"], 3)] * 2


def _links_by_hand(pdf, features):
    x = pdf[features].to_numpy()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    near, label, ids = d.argmin(axis=1), pdf.Class.to_numpy(), pdf.txn_id.to_numpy()
    return {(ids[i], ids[near[i]]) for i in range(len(x)) if label[i] == 1 and label[near[i]] == 0 and near[near[i]] == i}


def test_tomek_links_from_either_class_and_from_fewer_pairs(spark):
    rng = np.random.default_rng(31)
    centres = rng.normal(0, 6, (40, 6))
    negative = centres[rng.integers(0, 40, 900)] + rng.normal(0, 0.05, (900, 6))
    u = rng.random((900, 1))  # as synthetic rows lie: between the clusters
    positive = centres[rng.integers(0, 40, 900)] * u + centres[rng.integers(0, 40, 900)] * (1 - u)
    pdf = pd.DataFrame(np.vstack([negative, positive]), columns=list("abcdef"))
    pdf["txn_id"], pdf["Class"] = np.arange(1800), np.repeat([0, 1], 900)
    df = spark.createDataFrame(pdf)
    want = _links_by_hand(pdf, list("abcdef"))
    for start in (0, 1):
        got = neighbours.tomek_links(df, list("abcdef"), start=start).toPandas()
        assert want and {(r.positive_id, r.negative_id) for r in got.itertuples()} == want
    met = []
    for c in (0, 1):
        pairs = []
        neighbours.nearest(df.where(F.col("Class") == c), df, list("abcdef"), 1, pairs=pairs)
        met.append(sum(pairs))
    assert met[0] < met[1]


def test_a_known_bound_leaves_out_cells_and_changes_no_neighbour(spark):
    rng = np.random.default_rng(32)
    pdf = pd.DataFrame(rng.normal(0, 1, (6000, 3)), columns=list("abc"))
    pdf["txn_id"], pdf["Class"] = np.arange(6000), 0
    df = spark.createDataFrame(pdf)
    index = neighbours.indexed(df, list("abc"))
    free, bound = [], []
    asked = df.where("txn_id < 500")
    near = neighbours.nearest(asked, df, list("abc"), 2, pairs=free, index=index).cache()
    known = asked.join(near.where("place = 1").select(F.col("query_id").alias("txn_id"), F.col("sq_dist").alias("far")), "txn_id")
    again = neighbours.nearest(known, df, list("abc"), 2, pairs=bound, index=index, within="far")
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, again.collect()))
    assert sum(bound) < sum(free)


@pytest.mark.parametrize("limit, join", [(10**6, "BroadcastHashJoin"), (0, "ShuffledHashJoin")])
def test_transactions_never_build_on_the_events(spark, sf_dir, monkeypatch, capsys, limit, join):
    monkeypatch.setattr(views, "BROADCAST_VECTORS", limit)
    df = views.transactions(spark, sf_dir)
    for narrow in (df.select("txn_id", "Class"), df.groupBy("Class").count(), df):
        narrow.explain()
        plan = capsys.readouterr().out
        assert join in plan and "BuildRight" in plan and "BuildLeft" not in plan


def test_cuts_from_a_narrow_copy_equal_cuts_from_the_rows(spark, sf_dir):
    df = views.labelled_events(spark, sf_dir)
    fractions = (("train", 0.6), ("test", 0.4))
    keys = df.select("txn_id", "Class")
    a, b = sampling.stratified_split(df, fractions), sampling.stratified_split(df, fractions, counted=keys)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.select("txn_id", "split").collect())) == sorted(map(tuple, b.select("txn_id", "split").collect()))


@pytest.mark.parametrize("cells", [7, 100_000])
def test_kendall_counts_over_ranges_and_hot_values(spark, monkeypatch, cells):
    monkeypatch.setattr(sel, "CELLS", cells)
    rng = np.random.default_rng(3)
    n = 300
    x = np.where(rng.random(n) < 0.4, 5, rng.integers(0, 200, n))
    y = np.where(rng.random(n) < 0.3, 7, x // 2 + rng.integers(0, 60, n))
    dx, dy = (np.sign(v[:, None] - v[None, :]) for v in (x, y))
    want = (dx * dy).sum() / math.sqrt((dx != 0).sum() * (dy != 0).sum())
    assert sel.pair_counter()(x, y, np.ones(n)) == ((dx < 0) & (dy < 0)).sum()
    df = spark.createDataFrame([(int(a), int(b), int(a) % 3) for a, b in zip(x, y)], "x int, y int, z int")
    got = {(r.left, r.right): r["corr"] for r in sel.kendall_pairs(df, ["x", "y", "z"]).collect()}
    assert len(got) == 3 and math.isclose(got["x", "y"], want, abs_tol=1e-12)


def test_spearman_joins_each_column_once(spark, monkeypatch):
    rows = [(float(i % 7), None if i % 3 == 0 else float(i * i % 11), None if i % 4 == 0 else float(-i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    frame = pd.DataFrame(rows, columns=["a", "b", "c"])
    joined, lookup = [], sel.lookup_by_value
    monkeypatch.setattr(sel, "lookup_by_value", lambda df, of, c, *a: joined.append(c) or lookup(df, of, c, *a))
    for limit in (500, 6):
        monkeypatch.setattr(sel, "BROADCAST_VALUES", limit)
        for r in sel.spearman_pairs(df, ["a", "b", "c"]).collect():
            both = frame[[r.left, r.right]].dropna().rank()
            assert math.isclose(r["corr"], both[r.left].corr(both[r.right]), abs_tol=1e-12)
    assert sorted(joined) == sorted(c for c in "abc" if frame[c].nunique() > 6)


def test_row_statistics_compile_to_short_methods(spark):
    """The JVM interprets methods beyond 8,000 bytes, which made a row ten times as slow."""
    from rareflow.functions import rowstats
    from rareflow.functions.shape import V_COLS

    df = spark.range(10).select("id", *[(F.col("id") * i).cast("double").alias(c) for i, c in enumerate(V_COLS)])
    plan = rowstats.add_row_statistics(df, V_COLS)._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$"), "MODULE$")
    stages = debug.codegenStringSeq(plan)
    assert all(stages.apply(i)._3().maxMethodCodeSize() <= 8000 for i in range(stages.size()))


def test_features_take_rolling_columns_that_are_there(spark, sf_dir):
    from rareflow.operators.chain import ADVANCED, apply_features, fit_features
    from rareflow.operators.rolling import rolling
    from rareflow.sources.views import transactions
    from rareflow.session import stored

    df = transactions(spark, sf_dir)
    once = stored(rolling(df), "rolling-rows")
    fitted = fit_features(once, ADVANCED)
    got, want = apply_features(once, fitted), apply_features(df, fitted)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.columns == want.columns
    assert sorted(map(str, got.select("txn_id", "Amount_rolling_std_50").collect())) == sorted(map(str, want.select("txn_id", "Amount_rolling_std_50").collect()))


def test_rows_of_the_net_are_spread_evenly(spark):
    from rareflow.operators.models import rebalanced_for_net

    df = spark.range(40000).select(F.col("id").alias("txn_id"), (F.col("id") % 50 == 0).cast("int").alias("Class"), F.rand(1).alias("x"))
    got = rebalanced_for_net(df)
    counts = {r["Class"]: r["count"] for r in got.groupBy("Class").count().collect()}
    assert counts == {0: 39200, 1: 39200}
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 1.5 * sum(sizes) / len(sizes)


def test_boosting_adds_up_batches_without_a_row_a_bin(spark):
    rng = np.random.default_rng(5)
    codes, label = rng.integers(0, 300, (500, 3)), rng.integers(0, 2, 500)
    df = spark.createDataFrame([(int(y), False, [int(c) for c in x], 0.5) for x, y in zip(codes, label)], "label int, held boolean, codes array<int>, margin double")
    for bins, mine in ((400, codes), (64, codes % 60)):
        s = boosting.Settings(depth=2, bins=bins, positive_weight=3.0)
        tree = boosting.Tree.empty(2)
        tree.feature[0], tree.cut[0], tree.value[1], tree.value[2] = 1, 20, -0.25, 0.5
        rows = boosting._packed(df.withColumn("codes", F.transform("codes", lambda c: c if bins == 400 else c % 60)), s)
        groups = boosting._groups(rows, tree, [2], s, [tree])
        assert "Generate" not in groups._jdf.queryExecution().optimizedPlan().toString()
        right = mine[:, 1] > 20
        p = 1 / (1 + np.exp(-1.0))
        want = pd.Series(np.where(label == 1, 3.0 * (p - 1), p)[right]).groupby(mine[right, 0]).sum()
        got = groups.where("feature = 0").toPandas().set_index("bin").sort_index()
        assert (got.index == want.index).all() and np.allclose(got.g, want) and (got.node == 2).all()
