"""Splits, folds and samples (S1-S7, S11-S14 rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.operators import sampling as sm
from rareflow.operators.prepare import prepare
from rareflow.operators.quantiles import exact_quantiles
from rareflow.plans.catalog import EV, R, pk_sql, query, rounded
from rareflow.sources.views import labelled_events, transactions

ORDER = f"ORDER BY {pk_sql()}, txn_id"
RANKED = (
    f"o AS (SELECT txn_id, Class, Amount, Time, ROW_NUMBER() OVER (PARTITION BY Class {ORDER}) - 1 AS rn, "
    f"COUNT(*) OVER (PARTITION BY Class) AS n, ROW_NUMBER() OVER ({ORDER}) - 1 AS arn, COUNT(*) OVER () AS an FROM ev)"
)


def _cut(f):
    return f"CAST(floor(n*{f} + 1e-9) AS BIGINT)"


def _split(name, fractions):
    acc, arms = [], []
    for part, f in fractions[:-1]:
        acc.append(_cut(f))
        arms.append(f"WHEN rn < {' + '.join(acc)} THEN '{part}'")
    sql = f"WITH {EV}, {RANKED} SELECT txn_id, Class, CASE {' '.join(arms)} ELSE '{fractions[-1][0]}' END AS split FROM o"

    @query(name, sql)
    def _(spark, sf):
        return sm.stratified_split(labelled_events(spark, sf), fractions).select("txn_id", "Class", "split")


_split("S1_stratified_60_20_20", (("train", 0.6), ("validation", 0.2), ("test", 0.2)))
_split("S2_stratified_80_20", (("train", 0.8), ("test", 0.2)))
_split("S2_stratified_70_30", (("train", 0.7), ("test", 0.3)))


@query(
    "S3_sized_split",
    f"WITH {EV}, {RANKED}, z AS (SELECT *, CAST(floor(an*0.2) AS BIGINT) AS nt FROM o) SELECT txn_id, CASE WHEN arn < nt THEN 'test' "
    "WHEN arn < nt + CAST(floor((an-nt)*0.1) AS BIGINT) THEN 'validation' ELSE 'train' END AS split FROM z",
)
def _(spark, sf):
    return sm.sized_split(labelled_events(spark, sf)).select("txn_id", "split")


@query(
    "S4_chronological_split",
    f"WITH {EV}, p AS (SELECT quantile_cont(Time, 0.6) a, quantile_cont(Time, 0.8) b FROM ev) "
    "SELECT txn_id, CASE WHEN Time <= a THEN 'train' WHEN Time <= b THEN 'validation' ELSE 'test' END AS split FROM ev, p",
)
def _(spark, sf):
    df = labelled_events(spark, sf)
    a, b = exact_quantiles(df, {"t": F.col("Time")}, [0.6, 0.8])["t"]
    split = F.when(F.col("Time") <= a, "train").when(F.col("Time") <= b, "validation").otherwise("test")
    return df.select("txn_id", split.alias("split"))


@query(
    "S5_undersample",
    f"WITH {EV}, {RANKED} SELECT txn_id, Class, {R('Amount')} AS Amount FROM o WHERE Class = 1 OR rn < (SELECT COUNT(*) FROM ev WHERE Class = 1)",
)
def _(spark, sf):
    return rounded(sm.undersample(labelled_events(spark, sf)).select("txn_id", "Class", "Amount"))


@query(
    "S6_oversample",
    f"WITH {EV}, {RANKED}, c AS (SELECT COUNT(*) FILTER (Class=0) AS n0, COUNT(*) FILTER (Class=1) AS n1 FROM ev), "
    f"d AS (SELECT k AS copy, {pk_sql('k', 43)} % n1 AS rn FROM (SELECT UNNEST(range(n0)) AS k, n1 FROM c) x) "
    f"SELECT txn_id, Class, {R('Amount')} AS Amount, 0 AS copy FROM ev WHERE Class=0 "
    f"UNION ALL SELECT o.txn_id, o.Class, {R('o.Amount')}, d.copy FROM d JOIN o ON o.Class=1 AND o.rn = d.rn",
)
def _(spark, sf):
    return rounded(sm.oversample(labelled_events(spark, sf)).select("txn_id", "Class", "Amount", "copy"))


@query(
    "S7_shuffle",
    f"WITH {EV} SELECT txn_id, {pk_sql()} AS shuffle_key, Class FROM ev {ORDER}",
)
def _(spark, sf):
    return sm.shuffled(labelled_events(spark, sf)).select("txn_id", "shuffle_key", "Class")


@query(
    "S11_random_sample",
    f"WITH {EV} SELECT txn_id, Class, {R('Amount')} AS Amount FROM ev {ORDER} LIMIT 1000",
)
def _(spark, sf):
    return rounded(
        sm.permutation_sample(labelled_events(spark, sf), 1000).select("txn_id", "Class", "Amount")
    )


@query("S12_bootstrap_weights")
def _(spark, sf):
    return sm.bootstrap_weights(labelled_events(spark, sf), seed=42).select("txn_id", "Class", "weight")


def _folds(k):
    arms = " ".join(f"WHEN rn < ({i + 1} * n) // {k} THEN {i}" for i in range(k - 1))

    @query(
        f"S13_stratified_{k}_folds",
        f"WITH {EV}, {RANKED} SELECT txn_id, Class, CASE {arms} ELSE {k - 1} END AS fold FROM o",
    )
    def _(spark, sf):
        return sm.stratified_folds(labelled_events(spark, sf), k).select("txn_id", "Class", "fold")


_folds(3)
_folds(5)


@query("S14_full_preparation")
def _(spark, sf):
    return prepare(transactions(spark, sf), imbalance="undersample")


@query("S14_full_preparation_oversampled")
def _(spark, sf):
    return prepare(transactions(spark, sf), imbalance="oversample")
