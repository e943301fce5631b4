"""Training, tuning, ensembles and model-driven selection (M, F8-F10, F12 rows)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from rareflow.functions.shape import V_COLS
from rareflow.operators import boosting
from rareflow.operators import evaluation as ev
from rareflow.operators import models as md
from rareflow.operators import parzen
from rareflow.operators import selection as sel
from rareflow.operators import tuning as tn
from rareflow.operators.profile import target_correlation
from rareflow.operators.sampling import stratified_split
from rareflow.plans.catalog import R, T, query, rounded
from rareflow.plans.windows import ANOVA
from rareflow.session import fresh_path, stored
from rareflow.sources.views import transactions

COLS = [*V_COLS, "Amount", "Time"]
FEW = ["V1", "V2", "V3", "V4", "V14", "Amount", "Time"]


def base(n):
    """Makers of the models that ensembles combine, for ``n`` training rows."""
    return {
        "logistic": lambda: md.logistic(1.0, n=n),
        "forest": lambda: md.forest(20, 5),
        "boosted": lambda: md.boosted(10, 3),
    }


NAMES = list(base(1))


def parts(spark, sf, fractions=(("train", 0.6), ("validation", 0.2), ("test", 0.2))):
    """Split rows, written once: every pass of a model reads them without joining the vectors again.

    Cuts are found on classes and keys alone, which are written first.
    """
    rows = transactions(spark, sf).select("txn_id", "Class", *COLS)
    keys = stored(rows.select("txn_id", "Class"), "keys")
    df = stored(stratified_split(rows, fractions, counted=keys), "split-rows")
    return {name: df.where(F.col("split") == name) for name, _ in fractions}


def _scores(name, make, **kw):
    @query(name)
    def _(spark, sf):
        p = parts(spark, sf)
        n = p["train"].count()
        return md.score(p["test"], md.fit(p["train"], COLS, make(n), **kw))


_scores("M1_logistic_l2", lambda n: md.logistic(1.0, n=n))
_scores("M1_logistic_l1", lambda n: md.logistic(0.1, l1=True, n=n))
_scores("M2_random_forest", lambda n: md.forest(100, 10, 5))
_scores("M3_boosted_trees", lambda n: md.boosted(20, 5), weights="99")
_scores("M3_boosted_trees_balanced", lambda n: md.boosted(20, 3, cols="sqrt"))


@query("M3_histogram_boosting")
def _(spark, sf):
    """100 rounds at most, positives weighted by the class ratio, ended early by the validation part."""
    p = parts(spark, sf)
    n = {r["Class"]: r["count"] for r in p["train"].groupBy("Class").count().collect()}
    s = boosting.Settings(rounds=100, depth=6, positive_weight=n.get(0, 1) / max(1, n.get(1, 0)))
    model = boosting.fit_boosted(p["train"], COLS, s, p["validation"])
    return model.score(p["test"]).select("txn_id", F.col("Class").alias("label"), "score")


@query("M4_adaboost")
def _(spark, sf):
    p = parts(spark, sf)
    model = md.fit_adaboost(p["train"], COLS, rounds=15)
    scored = model.transform(p["test"]).select("txn_id", F.col("Class").alias("label"), "score")
    return ev.binarize(scored)


def _net(name, hidden):
    @query(name)
    def _(spark, sf):
        p = parts(spark, sf)
        train = md.rebalanced_for_net(p["train"].select("txn_id", "Class", *COLS))
        net = md.perceptron(len(COLS), hidden, rounds=30)
        return md.score(p["test"], md.fit(train, COLS, net, weights=None))


_net("M5_perceptron", (100, 50))
_net("M5_perceptron_deep", (128, 64, 32))


def _makers(p):
    return base(p["train"].count())


def _members(p):
    return {n: md.fit(p["train"], COLS, make()) for n, make in _makers(p).items()}


@query("M6_soft_voting")
def _(spark, sf):
    p = parts(spark, sf)
    voted = md.soft_vote(md.member_scores(p["test"], _members(p)), NAMES, (1.0, 2.0, 2.0))
    return ev.binarize(
        voted.select("txn_id", F.col("Class").alias("label"), "score", *[f"score_{n}" for n in NAMES])
    )


@query("M7_learned_weights")
def _(spark, sf):
    p = parts(spark, sf)
    val = md.member_scores(p["validation"], _members(p)).withColumn("label", F.col("Class"))
    w, ap = md.search_weights(val, NAMES)
    return spark.createDataFrame(
        [(n, float(x), float(ap)) for n, x in zip(NAMES, w)], "model string, weight double, average_precision double"
    )


@query("M8_stacking")
def _(spark, sf):
    p = parts(spark, sf)
    members = {k: _makers(p)[k] for k in ("forest", "boosted")}
    model = md.fit_stacking(p["train"].select("txn_id", "Class", *COLS), COLS, members, folds=3)
    return md.score(p["test"], model)


@query("M9_grid_search")
def _(spark, sf):
    p = parts(spark, sf)
    grid = {"regParam": [0.001, 0.1], "elasticNetParam": [0.0, 1.0]}
    return tn.grid_search(p["train"], COLS, md.logistic(1.0), grid, folds=3)[1]


@query("M10_random_search")
def _(spark, sf):
    p = parts(spark, sf)
    ranges = {**tn.BOOSTED_RANGES, "maxIter": (5, 15), "maxDepth": (3, 5)}
    return tn.random_search(p["train"], COLS, md.boosted(10, 3), ranges, trials=4)[1]


@query("M10_parzen_search")
def _(spark, sf):
    """100 trials over penalties of the logistic model, poor ones stopped after a fold."""
    df = transactions(spark, sf).select("txn_id", "Class", *COLS)
    ranges = {"regParam": parzen.Range(1e-6, 1.0, log=True), "elasticNetParam": parzen.Range(0.0, 1.0)}
    make = lambda v: LogisticRegression(maxIter=50, weightCol="weight", **v)
    return parzen.parzen_search(df, COLS, make, ranges, trials=100)[1]


@query("M11_train_several")
def _(spark, sf):
    p = parts(spark, sf)
    makers = {**_makers(p), "broken": lambda: md.forest(0, 5)}
    return md.train_several(p["train"], p["validation"], p["test"], COLS, makers)[0]


@query("M12_importance_forest")
def _(spark, sf):
    p = parts(spark, sf)
    return md.importance_frame(spark, md.fit(p["train"], COLS, _makers(p)["forest"]()), COLS)


@query("M12_importance_linear")
def _(spark, sf):
    p = parts(spark, sf)
    return md.importance_frame(spark, md.fit(p["train"], COLS, _makers(p)["logistic"]()), COLS)


_ALL = [*V_COLS, "Amount"]


@query(
    "M13_ensemble_importance",
    f"WITH {T}, {ANOVA}, c AS (SELECT feature, ABS(corr(value, Class)) AS a FROM u GROUP BY feature) "
    f"SELECT feature, {R('0.6*f_score + 0.4*a')} AS importance FROM f JOIN c USING (feature)",
)
def _(spark, sf):
    df = transactions(spark, sf)
    frames = {
        "anova": sel.anova_f(df, _ALL).withColumnRenamed("f_score", "importance"),
        "correlation": target_correlation(df, _ALL).select("feature", F.abs("corr").alias("importance")),
    }
    return rounded(md.weighted_importance(frames, {"anova": 0.6, "correlation": 0.4}))


@query("M14_linear_contributions")
def _(spark, sf):
    p = parts(spark, sf)
    m = md.fit(p["train"], COLS, _makers(p)["logistic"]())
    return md.linear_contributions(p["test"], m, COLS).orderBy(F.col("contribution").desc()).limit(10)


@query("M14_permutation_importance")
def _(spark, sf):
    p = parts(spark, sf)
    m = md.fit(p["train"], COLS, _makers(p)["forest"]())
    return md.permutation_importance(p["test"].drop("split"), m, COLS)


@query("M15_save_and_reload")
def _(spark, sf):
    p = parts(spark, sf)
    m = md.fit(p["train"], COLS, _makers(p)["logistic"]())
    path = fresh_path(spark, "model")
    m.write().overwrite().save(path)
    again = PipelineModel.load(path)
    before = md.score(p["test"], m).select("txn_id", F.col("score").alias("score_before"))
    return before.join(
        md.score(p["test"], again).select("txn_id", F.col("score").alias("score_after")), "txn_id"
    )


# ---- selection that trains models -------------------------------------------


@query("F8_recursive_elimination")
def _(spark, sf):
    p = parts(spark, sf)
    n = p["train"].count()
    return tn.recursive_elimination(p["train"], FEW, lambda: md.logistic(1.0, n=n), least=4, folds=3)[1]


def _from_model(name, make, threshold):
    @query(name)
    def _(spark, sf):
        p = parts(spark, sf)
        kept = tn.select_from_model(p["train"], COLS, make(p["train"].count()), threshold)
        return spark.createDataFrame(kept, "feature string, importance double")


_from_model("F9_from_forest_median", lambda n: md.forest(20, 5), "median")
_from_model("F9_from_logistic_mean", lambda n: md.logistic(1.0, n=n), "mean")


@query("F10_stability")
def _(spark, sf):
    p = parts(spark, sf)
    return tn.stability(p["train"], COLS, lambda s: md.forest(10, 4, seed=s), rounds=5)


def _staged(name, method):
    @query(name)
    def _(spark, sf):
        stages = tn.select_features(transactions(spark, sf), COLS, method, k=10)
        rows = [(s, i, c) for s, names in stages.items() for i, c in enumerate(names)]
        return spark.createDataFrame(rows, "stage string, position int, feature string")


_staged("F12_quick_selection", "univariate")
_staged("F12_full_selection", "vote")
