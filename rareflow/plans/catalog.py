"""Registry of queries and their oracle SQL, and the shared oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.functions.keys import ANGLE, KEY_SPACE, ROUNDS, SEED_STEP
from rareflow.functions.shape import V_COLS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(name)
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(c: Column | str) -> Column:
    """Doubles are compared at six decimals; adding zero folds -0.0 into 0.0."""
    return F.round(c, 6) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        *[f"round(`{c}`, 6) + 0D AS `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes]
    )


# ---- oracle text -----------------------------------------------------------

_VS = ", ".join(f"8.0*CAST(v.embedding[{i}] AS DOUBLE) AS V{i}" for i in range(1, 29))
V_LIST = ", ".join(V_COLS)
V_ARRAY = f"[{V_LIST}]"

EV = (
    "ev AS (SELECT event_id AS txn_id, user_id, ts, "
    "date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts)/1000000.0 AS Time, "
    "value AS Amount, CASE WHEN event_type='error' AND user_id % 10 = 0 THEN 1 ELSE 0 END AS Class, "
    "event_type FROM events)"
)
T = (
    EV + ", t AS (SELECT e.txn_id, e.user_id, e.ts, e.Time, " + _VS + ", e.Amount, e.Class "
    "FROM (SELECT x.*, x.txn_id % c.n AS vkey FROM ev x CROSS JOIN "
    "(SELECT COUNT(*) AS n FROM embeddings) c) e JOIN embeddings v ON v.vec_id = e.vkey)"
)


def score_sql(mult: int = 7919, label: str = "Class") -> str:
    return (
        f"CAST(LEAST(999, ((txn_id*{mult})%1000) - ((txn_id*{mult})%5) + 200*{label}) AS DOUBLE)/1000.0"
    )


S = EV + f", s AS (SELECT txn_id, Class AS label, {score_sql()} AS score, Amount, ts, user_id FROM ev)"


def R(expr: str) -> str:
    return f"(ROUND(CAST({expr} AS DOUBLE), 6) + CAST(0 AS DOUBLE))"


def I(expr: str) -> str:  # noqa: E743
    return f"CAST({expr} AS BIGINT)"


def pk_sql(col: str = "txn_id", seed: int = 42) -> str:
    """The arithmetic of ``functions.keys.perm_key``."""
    key = f"((CAST({col} AS BIGINT) + {seed * SEED_STEP}) % {KEY_SPACE})"
    for factor, shift in ROUNDS:
        key = f"(({key} * {factor} + {seed * SEED_STEP % KEY_SPACE}) % {KEY_SPACE})"
        key = f"xor({key}, {key} >> {shift})"
    return key


def normal_sql(col: str = "txn_id", seed: int = 42) -> str:
    """The arithmetic of ``functions.keys.normal_draw``."""
    radius = f"sqrt(-2.0 * ln(({pk_sql(col, seed)} + 0.5) / {KEY_SPACE}.0))"
    return f"({radius} * cos(2.0 * pi() * ({pk_sql(col, seed + ANGLE)} / {KEY_SPACE}.0)))"
