"""Window features and ranks (W rows)."""

from __future__ import annotations

from rareflow.functions.shape import V_COLS
from rareflow.operators import evaluation as ev
from rareflow.operators.rolling import rolling
from rareflow.operators.selection import anova_f, rank_features
from rareflow.plans.catalog import EV, I, R, S, T, V_LIST, query, rounded
from rareflow.sources.views import labelled_events, scored, transactions

SIZES = (10, 50, 100)


def _cols(order, sizes=SIZES, lag=0, partition=""):
    out = []
    for s in sizes:
        w = f"OVER ({partition} ORDER BY {order} ROWS BETWEEN {s - 1} PRECEDING AND CURRENT ROW)"
        lw = w if not lag else f"OVER ({partition} ORDER BY {order} ROWS BETWEEN {s - 1 + lag} PRECEDING AND {lag} PRECEDING)"
        out.append((f"Amount_rolling_mean_{s}", R(f"AVG(Amount) {w}")))
        out.append((f"Amount_rolling_std_{s}", R(f"STDDEV_SAMP(Amount) {w}")))
        out.append((f"velocity_{s}", f"COUNT(*) {w}"))
        out.append((f"positive_rate_rolling_{s}", R(f"AVG(Class) {lw}")))
    return dict(out)


def _sql(names, **kw):
    cols = _cols("Time, txn_id", **kw)
    return f"WITH {EV} SELECT txn_id, " + ", ".join(f"{cols[n]} AS {n}" for n in names) + " FROM ev"


def _register(qid, slug, prefix):
    names = [f"{prefix}_{s}" for s in SIZES]

    @query(f"{qid}_{slug}", _sql(names))
    def _(spark, sf):
        return rounded(rolling(labelled_events(spark, sf), SIZES).select("txn_id", *names))


_register("W1", "rolling_mean", "Amount_rolling_mean")
_register("W2", "rolling_std", "Amount_rolling_std")
_register("W3", "rolling_count", "velocity")
_register("W4", "rolling_positive_rate", "positive_rate_rolling")

_LAGGED = [f"positive_rate_rolling_{s}" for s in SIZES]


@query("W4_rolling_positive_rate_lagged", _sql(_LAGGED, lag=1))
def _(spark, sf):
    return rounded(rolling(labelled_events(spark, sf), SIZES, lag=1).select("txn_id", *_LAGGED))


@query(
    "W5_rolling_over_cut_ranges",
    f"WITH {EV} SELECT txn_id, {R('Time')} AS Time, {R('Amount')} AS Amount, {_cols('Time, txn_id')['Amount_rolling_mean_100']} AS Amount_rolling_mean_100, "
    f"{_cols('Time, txn_id')['positive_rate_rolling_50']} AS positive_rate_rolling_50 FROM ev",
)
def _(spark, sf):
    out = rolling(labelled_events(spark, sf), SIZES, n=7, small=0)
    return rounded(
        out.select("txn_id", "Time", "Amount", "Amount_rolling_mean_100", "positive_rate_rolling_50")
    )


_ENTITY = [f"{p}_{s}" for p in ("Amount_rolling_mean", "Amount_rolling_std", "velocity", "positive_rate_rolling") for s in (3, 10)]


@query("W6_entity_rolling", _sql(_ENTITY, sizes=(3, 10), partition="PARTITION BY user_id"))
def _(spark, sf):
    out = rolling(labelled_events(spark, sf), (3, 10), by=["user_id"])
    return rounded(out.select("txn_id", *_ENTITY))


ANOVA = (
    f"u AS (UNPIVOT (SELECT Class, {V_LIST}, Amount FROM t) ON {V_LIST}, Amount INTO NAME feature VALUE value), "
    "gc AS (SELECT feature, Class, COUNT(*) AS n, AVG(value) AS m, VAR_SAMP(value) AS v FROM u GROUP BY feature, Class), "
    "ga AS (SELECT feature, COUNT(*) AS n, AVG(value) AS m FROM u GROUP BY feature), "
    "f AS (SELECT gc.feature, SUM(gc.n*(gc.m-ga.m)*(gc.m-ga.m)) / (SUM((gc.n-1)*gc.v) / (MAX(ga.n)-2)) AS f_score FROM gc JOIN ga USING (feature) GROUP BY gc.feature)"
)


@query(
    "W7_feature_rank",
    f"WITH {T}, {ANOVA} SELECT feature, {R('f_score')} AS score, ROW_NUMBER() OVER (ORDER BY f_score DESC, feature) AS rank FROM f",
)
def _(spark, sf):
    scores = anova_f(transactions(spark, sf), [*V_COLS, "Amount"]).withColumnRenamed("f_score", "score")
    return rounded(rank_features(scores))


@query(
    "W8_running_counts",
    f"WITH {S}, g AS (SELECT score, SUM(label) AS p, COUNT(*) AS n FROM s GROUP BY score) "
    f"SELECT {R('score')} AS score, {I('SUM(p) OVER w')} AS tp, {I('SUM(n - p) OVER w')} AS fp FROM g "
    "WINDOW w AS (ORDER BY g.score DESC ROWS UNBOUNDED PRECEDING)",
)
def _(spark, sf):
    return rounded(ev.running_counts(scored(spark, sf)).select("score", "tp", "fp"))
