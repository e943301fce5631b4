"""Structured Streaming (ST rows). Finished windows are compared with their batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.functions.shape import V_COLS
from rareflow.operators import drift
from rareflow.operators import models as md
from rareflow.operators import scoring as sc
from rareflow.operators.quantiles import grouped_quantiles
from rareflow.plans.catalog import EV, R, query, rounded, score_sql
from rareflow.plans.windows import _ENTITY, _cols
from rareflow.sources.views import reference_and_current, table, transactions, v_columns
from rareflow.streaming import jobs
from rareflow.streaming import sources as src

# events with the score, and the watermark the stream ends with (millisecond precision)
E = (
    f"{EV}, e AS (SELECT *, {score_sql()} AS score, CASE WHEN {score_sql()} >= 0.5 THEN 1 ELSE 0 END AS pred, epoch_us(ts) AS us FROM ev), "
    "wm AS (SELECT (MAX(us) // 1000) * 1000 - 600000000 AS wm FROM e)"
)


def _bucket(seconds):
    return f"(us // {seconds}000000) * {seconds}"


@query("ST1_score_stream")
def _(spark, sf):
    df = transactions(spark, sf)
    model = md.fit(df, [*V_COLS, "Amount"], md.logistic(1.0, n=df.count()))
    emb = table(spark, sf, "embeddings")
    n = emb.count()
    stream = src.event_stream(spark, sf).drop("score", "pred").withColumn("vkey", F.col("txn_id") % n)
    joined = stream.join(v_columns(emb), "vkey").drop("vkey")
    scored = md.probability(joined, model).select("txn_id", "event_time", "score")
    return src.run_append(sc.with_bands(scored), "scored")


@query(
    "ST2_hourly_predictions",
    f"WITH {E} SELECT {_bucket(3600)} AS window_start, COUNT(*) AS n, CAST(SUM(pred) AS BIGINT) AS flagged FROM e, wm "
    f"WHERE ({_bucket(3600)} + 3600)*1000000 <= wm GROUP BY 1",
)
def _(spark, sf):
    return src.run_append(jobs.hourly_counts(src.event_stream(spark, sf)), "hourly")


@query(
    "ST3_flagged_rate",
    f"WITH {E}, x AS (SELECT {_bucket(60)} - 60*i AS window_start, pred FROM e, (SELECT UNNEST(range(0, 5)) AS i) k) "
    f"SELECT window_start, COUNT(*) AS n, {R('100.0*AVG(pred)')} AS flagged_pct FROM x, wm WHERE (window_start + 300)*1000000 <= wm GROUP BY 1",
)
def _(spark, sf):
    return rounded(src.run_append(jobs.flagged_rate(src.event_stream(spark, sf)), "rate"))


@query(
    "ST4_windowed_quality",
    f"WITH {E}, c AS (SELECT {_bucket(86400)} AS window_start, COUNT(*) AS n, SUM(CASE WHEN Class=pred THEN 1 ELSE 0 END) AS ok, "
    "SUM(Class*pred) AS tp, SUM(pred) AS pp, SUM(Class) AS p FROM e GROUP BY 1) "
    f"SELECT window_start, n, {R('ok*1.0/n')} AS accuracy, {R('CASE WHEN pp=0 THEN 0 ELSE tp*1.0/pp END')} AS precision, {R('CASE WHEN p=0 THEN 0 ELSE tp*1.0/p END')} AS recall "
    "FROM c, wm WHERE (window_start + 86400)*1000000 <= wm",
)
def _(spark, sf):
    return rounded(src.run_append(jobs.windowed_quality(src.event_stream(spark, sf)), "quality"))


@query(
    "ST5_latency_percentiles",
    f"WITH {E} SELECT {_bucket(86400)} AS window_start, COUNT(*) AS n, {R('quantile_cont(Amount, 0.5)')} AS p50, "
    f"{R('quantile_cont(Amount, 0.95)')} AS p95, {R('quantile_cont(Amount, 0.99)')} AS p99 FROM e GROUP BY 1",
)
def _(spark, sf):
    df = table(spark, sf, "events")
    events = src.derive(df).withColumn(
        "window_start", F.unix_seconds(F.window("event_time", "1 day")["start"])
    )
    q = grouped_quantiles(events, ["window_start"], "Amount", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return rounded(q)


@query(
    "ST5_latency_stream",
    f"WITH {E} SELECT {_bucket(86400)} AS window_start, COUNT(*) AS n, TRUE AS p50_within, TRUE AS p95_within, TRUE AS p99_within "
    f"FROM e, wm WHERE ({_bucket(3600)} + 3600)*1000000 <= wm GROUP BY 1",
)
def _(spark, sf):
    """Hourly sketches merged to days; whether each quantile's exact rank is within the bound of the wanted one."""
    hours = src.run_append(jobs.latency_sketches(src.event_stream(spark, sf)), "latency")
    days = jobs.merged_latency(hours)
    second = F.unix_seconds("event_time")
    rows = src.derive(table(spark, sf, "events")).select(
        (second - second % 86400).alias("window_start"), (second - second % 3600).alias("hour"), "Amount"
    )
    known = rows.join(hours.select(F.col("window_start").alias("hour")), "hour").join(days, "window_start")
    names = list(jobs.QUANTILES)
    counts = known.groupBy("window_start", "n").agg(
        *[F.avg((F.col("Amount") < F.col(c)).cast("double")).alias(f"{c}_below") for c in names],
        *[F.avg((F.col("Amount") <= F.col(c)).cast("double")).alias(f"{c}_upto") for c in names],
    )

    def within(name, p):
        near = (F.col(f"{name}_below") - jobs.RANK_ERROR <= p) & (F.col(f"{name}_upto") + jobs.RANK_ERROR >= p)
        return near.alias(f"{name}_within")

    return counts.select("window_start", "n", *[within(c, p) for c, p in jobs.QUANTILES.items()])


@query(
    "ST6_windowed_drift",
    f"WITH {E}, u AS (SELECT us, ts, 'Amount' AS feature, Amount AS value FROM e UNION ALL SELECT us, ts, 'score', score FROM e), "
    "b AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi FROM u GROUP BY feature), "
    "w AS (SELECT u.*, CAST(LEAST(9, floor((value-lo)/((hi-lo)/10))) AS INT) AS bin FROM u JOIN b USING (feature)), "
    "r AS (SELECT feature, bin, COUNT(*)*1.0/(SELECT COUNT(*) FROM e WHERE ts < TIMESTAMP '2024-01-16') AS share FROM w WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1, 2), "
    f"c AS (SELECT {_bucket(86400)} AS window_start, feature, bin, COUNT(*) AS n FROM w GROUP BY ALL), "
    f"t AS (SELECT {_bucket(86400)} AS window_start, COUNT(*) AS n FROM e GROUP BY 1), "
    "g AS (SELECT t.window_start, b.feature, i.bin, t.n FROM t, b, (SELECT UNNEST(range(0, 10)) AS bin) i), "
    "s AS (SELECT g.window_start, g.feature, GREATEST(COALESCE(c.n, 0)*1.0/g.n, 1e-10) AS c, GREATEST(COALESCE(r.share, 0), 1e-10) AS r FROM g "
    "LEFT JOIN c ON c.window_start=g.window_start AND c.feature=g.feature AND c.bin=g.bin LEFT JOIN r ON r.feature=g.feature AND r.bin=g.bin) "
    f"SELECT window_start, feature, {R('SUM((c-r)*ln(c/r))')} AS psi FROM s, wm WHERE (window_start + 86400)*1000000 <= wm GROUP BY 1, 2",
)
def _(spark, sf):
    cols = ["Amount", "score"]
    events = src.derive(table(spark, sf, "events"))
    cut = F.expr("timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-16 00:00:00'))")
    ref = events.where(F.col("event_time") < cut)
    bins = drift.fit_bins(ref, events, cols)
    counts = drift.bin_counts(ref, {c: b.of(F.col(c)) for c, b in bins.items()}).collect()
    total = ref.count()
    shares = {c: [0.0] * b.count for c, b in bins.items()}
    for r in counts:
        shares[r.feature][r.bin] = r.n / total
    out = jobs.windowed_psi(src.event_stream(spark, sf), bins, shares)
    return rounded(src.run_append(out, "drift"))


@query("ST7_late_rows")
def _(spark, sf):
    """The newer half arrives first, in two parts; the older half is then behind the watermark.

    Rows are judged by the watermark of the micro-batch before, hence two parts. The
    dropped count is of partial window counts, which is what reaches the state.
    """
    ref, cur = reference_and_current(src.raw_events(spark, sf))
    middle = F.expr("TIMESTAMP_NTZ'2024-01-23 00:00:00'")
    parts = [cur.where(F.col("ts") < middle), cur.where(F.col("ts") >= middle), ref]
    progress: list = []
    counts = src.run_append(jobs.hourly_counts(src.replay_stream(spark, parts)), "late", progress)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    return counts.agg(
        F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_counted")
    ).withColumn("late_groups_dropped", F.lit(int(dropped)).cast("bigint"))


def _user_rolling_sql(rows="TRUE"):
    cols = _cols("us, txn_id", sizes=(3, 10), partition="PARTITION BY user_id")
    some = ", ".join(f"{cols[n]} AS {n}" for n in _ENTITY)
    return (
        f"WITH {E}, x AS (SELECT * FROM e WHERE {rows}), r AS (SELECT txn_id, us, {some} FROM x) "
        f"SELECT txn_id, {', '.join(_ENTITY)} FROM r, wm WHERE us <= wm"
    )


@query("ST8_user_rolling", _user_rolling_sql())
def _(spark, sf):
    ref, cur = reference_and_current(src.raw_events(spark, sf))
    with src.keyed_state(spark):
        out = src.run_append(jobs.user_rolling(src.replay_stream(spark, [ref, cur]), (3, 10)), "user-rolling")
    return rounded(out.select("txn_id", *_ENTITY))


@query("ST8_user_rolling_late", _user_rolling_sql("ts >= TIMESTAMP '2024-01-16'"))
def _(spark, sf):
    """The older half comes last and lies behind the watermark, so that it is in no window."""
    ref, cur = reference_and_current(src.raw_events(spark, sf))
    middle = F.expr("TIMESTAMP_NTZ'2024-01-23 00:00:00'")
    parts = [cur.where(F.col("ts") < middle), cur.where(F.col("ts") >= middle), ref]
    with src.keyed_state(spark):
        out = src.run_append(jobs.user_rolling(src.replay_stream(spark, parts), (3, 10)), "user-rolling")
    return rounded(out.select("txn_id", *_ENTITY))


@query(
    "ST9_sessions",
    f"WITH {E}, l AS (SELECT *, us - LAG(us) OVER (PARTITION BY user_id ORDER BY us) AS gap FROM e), "
    "n AS (SELECT *, SUM(CASE WHEN gap IS NULL OR gap > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us) AS sid FROM l) "
    f"SELECT user_id, MIN(us) AS start_us, MAX(us) + 1800000000 AS end_us, COUNT(*) AS n, {R('SUM(Amount)')} AS amount FROM n, wm "
    "GROUP BY user_id, sid, wm HAVING MAX(us) + 1800000000 <= wm",
)
def _(spark, sf):
    return rounded(src.run_append(jobs.sessions(src.event_stream(spark, sf)), "sessions"))


@query("ST10_deduplicated", f"WITH {EV} SELECT txn_id, user_id, {R('Amount')} AS Amount FROM ev")
def _(spark, sf):
    raw = src.raw_events(spark, sf)
    again = raw.where(F.col("event_id") % 7 == 0)
    stream = src.replay_stream(spark, [raw.unionByName(again)])
    out = src.run_append(jobs.deduplicated(stream).select("txn_id", "user_id", "Amount"), "dedup")
    return rounded(out)
