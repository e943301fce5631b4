"""Feature selection (F rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.functions.shape import V_COLS
from rareflow.operators import selection as sel
from rareflow.operators.information import nearest_mutual_information
from rareflow.plans.catalog import R, T, query, rounded
from rareflow.plans.windows import ANOVA
from rareflow.sources.views import table, transactions

ALL = [*V_COLS, "Amount"]
# V1 to V4, a constant, a shrunken copy of V1, an exact combination, and a chain: chain_b is
# close to chain_a and to chain_c, which are not close to each other
MIXED = ["V1", "V2", "V3", "V4", "almost_constant", "half_v1", "v2_plus", "chain_a", "chain_b", "chain_c"]
_MIX = (
    "mx AS (SELECT Class, V1, V2, V3, V4, 1.0 + V5*0.001 AS almost_constant, V1*0.5 AS half_v1, V2 + V3*0.01 AS v2_plus, 2.0*V6 AS chain_a, 1.5*V6 + 0.42*V7 AS chain_b, 0.9*V6 + 0.51*V7 AS chain_c FROM t)"
)


def _mixed(spark, sf):
    return transactions(spark, sf).select(
        "txn_id", "Class", "V1", "V2", "V3", "V4",
        (F.lit(1.0) + F.col("V5") * 0.001).alias("almost_constant"),
        (F.col("V1") * 0.5).alias("half_v1"),
        (F.col("V2") + F.col("V3") * 0.01).alias("v2_plus"),
        (F.col("V6") * 2.0).alias("chain_a"),
        (F.col("V6") * 1.5 + F.col("V7") * 0.42).alias("chain_b"),
        (F.col("V6") * 0.9 + F.col("V7") * 0.51).alias("chain_c"),
    )


@query(
    "F1_low_variance",
    f"WITH {T}, {_MIX} " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {R(f'VAR_POP({c})')} AS variance, VAR_POP({c}) > 0.01 AS kept FROM mx" for c in MIXED
    ),
)
def _(spark, sf):
    return rounded(sel.low_variance_filter(_mixed(spark, sf), MIXED))


def _greedy_sql(pairs, cols):
    """Unrolled pair loop: one CTE per pair, carrying the list of dropped columns."""
    ctes, prev = [], "d0"
    ctes.append("d0 AS (SELECT CAST([] AS VARCHAR[]) AS dropped)")
    i = 0
    for a_i, a in enumerate(cols):
        for b in cols[a_i + 1 :]:
            i += 1
            cur = f"d{i}"
            ctes.append(
                f"{cur} AS (SELECT CASE WHEN ABS({pairs(a, b)}) > 0.95 THEN list_append(dropped, CASE WHEN vr.v_{a} < vr.v_{b} THEN '{a}' ELSE '{b}' END) ELSE dropped END AS dropped FROM {prev}, cr, vr)"
            )
            prev = cur
    kept = ", ".join(f"('{c}')" for c in cols)
    return ", ".join(ctes) + f" SELECT feature FROM (VALUES {kept}) k(feature), {prev} WHERE NOT list_contains(dropped, feature)"


def _corr_cte(cols, fn="corr", source="mx"):
    out = [
        f"{fn}({a}, {b}) AS c_{a}_{b}" for i, a in enumerate(cols) for b in cols[i + 1 :]
    ]
    return f"cr AS (SELECT {', '.join(out)} FROM {source})"


_VR = "vr AS (SELECT " + ", ".join(f"VAR_POP({c}) AS v_{c}" for c in MIXED) + " FROM mx)"
_FILTERED = ["V1", "V2", "V3", "half_v1", "v2_plus", "chain_a", "chain_b", "chain_c"]


@query(
    "F2_correlation_filter",
    f"WITH {T}, {_MIX}, {_corr_cte(_FILTERED)}, {_VR}, " + _greedy_sql(lambda a, b: f"cr.c_{a}_{b}", _FILTERED),
)
def _(spark, sf):
    kept = sel.correlation_filter(_mixed(spark, sf), _FILTERED)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_AVG_RANK = ", ".join(
    f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1)/2.0 AS {c}" for c in WIDE
)
_PAIRS = [(a, b) for i, a in enumerate(WIDE) for b in WIDE[i + 1 :]]


@query(
    "F3_spearman",
    f"WITH mx AS (SELECT {_AVG_RANK} FROM lineitem) " + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {R(f'corr({a}, {b})')} AS corr FROM mx" for a, b in _PAIRS
    ),
)
def _(spark, sf):
    return rounded(sel.spearman_pairs(table(spark, sf, "lineitem"), WIDE))


_RANKED = ", ".join(
    f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1)/2.0 AS {c}" for c in _FILTERED
)


@query(
    "F3_spearman_filter",
    f"WITH {T}, {_MIX}, rk AS (SELECT {_RANKED} FROM mx), {_corr_cte(_FILTERED, source='rk')}, {_VR}, "
    + _greedy_sql(lambda a, b: f"cr.c_{a}_{b}", _FILTERED),
)
def _(spark, sf):
    kept = sel.correlation_filter(_mixed(spark, sf), _FILTERED, method="spearman")
    return spark.createDataFrame([(c,) for c in kept], "feature string")


# a null wherever one column says so, so that pairs share fewer rows than each column has
_HOLES = (
    "SELECT CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity END AS qty, l_extendedprice AS price, "
    "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_discount END AS discount, l_tax AS tax FROM lineitem"
)
_HOLEY = ["qty", "price", "discount", "tax"]


def _pairwise_sql(a, b):
    rank = "RANK() OVER (ORDER BY {0}) + (COUNT(*) OVER (PARTITION BY {0}) - 1)/2.0"
    return (
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {R('corr(x, y)')} AS corr FROM "
        f"(SELECT {rank.format(a)} AS x, {rank.format(b)} AS y FROM h WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    )


@query(
    "F3_spearman_with_nulls",
    f"WITH h AS ({_HOLES}) " + " UNION ALL ".join(_pairwise_sql(a, b) for i, a in enumerate(_HOLEY) for b in _HOLEY[i + 1 :]),
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity END AS qty", "l_extendedprice AS price",
        "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_discount END AS discount", "l_tax AS tax",
    )
    return rounded(sel.spearman_pairs(rows, _HOLEY))


_FEW = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _kendall_sql(cols, source="lineitem"):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1 :]:
            parts.append(
                f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {R('tau')} AS corr FROM (WITH c AS (SELECT {a} AS x, {b} AS y, COUNT(*) AS n FROM {source} GROUP BY 1, 2), "
                "m AS (SELECT SUM(CASE WHEN (p.x-q.x)*(p.y-q.y) > 0 THEN p.n*1.0*q.n ELSE 0 END)/2 AS con, SUM(CASE WHEN (p.x-q.x)*(p.y-q.y) < 0 THEN p.n*1.0*q.n ELSE 0 END)/2 AS dis FROM c p, c q), "
                "tt AS (SELECT SUM(n)*(SUM(n)-1.0)/2 AS n0 FROM c), tx AS (SELECT SUM(s*(s-1.0)/2) AS t FROM (SELECT SUM(n) AS s FROM c GROUP BY x)), ty AS (SELECT SUM(s*(s-1.0)/2) AS t FROM (SELECT SUM(n) AS s FROM c GROUP BY y)) "
                "SELECT (con-dis)/sqrt((n0-tx.t)*(n0-ty.t)) AS tau FROM m, tt, tx, ty)"
            )
    return " UNION ALL ".join(parts)


@query("F4_kendall", _kendall_sql(_FEW))
def _(spark, sf):
    return rounded(sel.kendall_pairs(table(spark, sf, "lineitem"), _FEW))


_STEPS = ["l_quantity", "half_quantity", "l_discount", "l_tax"]
_STEPPED = "SELECT l_quantity, floor(l_quantity / 2) AS half_quantity, l_discount, l_tax FROM lineitem"


@query(
    "F4_kendall_filter",
    f"WITH st AS ({_STEPPED}), kt AS ({_kendall_sql(_STEPS, 'st')}), "
    "cr AS (SELECT 1 AS one), vr AS (SELECT " + ", ".join(f"VAR_POP({c}) AS v_{c}" for c in _STEPS) + " FROM st), "
    + _greedy_sql(lambda a, b: f"(SELECT corr FROM kt WHERE \"left\" = '{a}' AND \"right\" = '{b}')", _STEPS),
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_quantity", "floor(l_quantity / 2) AS half_quantity", "l_discount", "l_tax")
    kept = sel.correlation_filter(rows, _STEPS, method="kendall")
    return spark.createDataFrame([(c,) for c in kept], "feature string")


_MANY = ["o_totalprice", "o_custkey"]


@query("F4_kendall_many_values", _kendall_sql(_MANY, "orders"))
def _(spark, sf):
    return rounded(sel.kendall_pairs(table(spark, sf, "orders"), _MANY))


@query("F5_anova_f", f"WITH {T}, {ANOVA} SELECT feature, {R('f_score')} AS f_score FROM f")
def _(spark, sf):
    return rounded(sel.anova_f(transactions(spark, sf), ALL))


@query(
    "F5_anova_f_labels",
    "WITH d AS (SELECT l.quality AS Class, CAST(d.n_chars AS DOUBLE) AS value FROM labels l JOIN documents d USING (doc_id)), "
    "gc AS (SELECT Class, COUNT(*) AS n, AVG(value) AS m, VAR_SAMP(value) AS v FROM d GROUP BY Class), ga AS (SELECT COUNT(*) AS n, AVG(value) AS m FROM d) "
    f"SELECT 'n_chars' AS feature, {R('SUM(gc.n*(gc.m-ga.m)*(gc.m-ga.m))/(SUM((gc.n-1)*gc.v)/(MAX(ga.n)-2))')} AS f_score FROM gc, ga",
)
def _(spark, sf):
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return rounded(sel.anova_f(d.withColumn("n_chars", F.col("n_chars").cast("double")), ["n_chars"], "quality"))


_DEC = ", ".join(f"quantile_cont(value, {i / 10})" for i in range(1, 10))


@query(
    "F6_mutual_information",
    f"WITH {T}, u AS (UNPIVOT (SELECT Class, {', '.join(ALL)} FROM t) ON {', '.join(ALL)} INTO NAME feature VALUE value), "
    f"e AS (SELECT feature, list_distinct([{_DEC}]) AS e FROM u GROUP BY feature), "
    "b AS (SELECT u.feature, Class, len(list_filter(e.e, lambda x: x < value)) AS bin FROM u JOIN e USING (feature)), "
    "c AS (SELECT feature, bin, Class, COUNT(*)*1.0 AS n FROM b GROUP BY ALL), "
    "m AS (SELECT feature, n, SUM(n) OVER (PARTITION BY feature) AS tot, SUM(n) OVER (PARTITION BY feature, bin) AS nb, SUM(n) OVER (PARTITION BY feature, Class) AS nc FROM c) "
    f"SELECT feature, {R('SUM(n/tot*ln(n*tot/(nb*nc)))')} AS mutual_information FROM m GROUP BY feature",
)
def _(spark, sf):
    return rounded(sel.mutual_information(transactions(spark, sf), ALL))


def _psi_sql(x):
    y = f"({x} + 10.0)"
    series = f"ln({y}) - 1/(2*{y}) - 1/(12*{y}*{y}) + 1/(120*{y}*{y}*{y}*{y}) - 1/(252*{y}*{y}*{y}*{y}*{y}*{y})"
    return f"({series} - (" + " + ".join(f"1/({x} + {i}.0)" for i in range(10)) + "))"


# the distance to the third nearest row on a line: j rows to the left and 3 - j to the right, for the best j
_SIDES = [("0.0", "LEAD(value, 3) OVER w - value"), ("value - LAG(value, 1) OVER w", "LEAD(value, 2) OVER w - value"),
          ("value - LAG(value, 2) OVER w", "LEAD(value, 1) OVER w - value"), ("value - LAG(value, 3) OVER w", "0.0")]
_THIRD = "LEAST(" + ", ".join(f"CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN 1e300 ELSE GREATEST({a}, {b}) END" for a, b in _SIDES) + ")"


@query(
    "F6_nearest",
    f"WITH {T}, u AS (UNPIVOT (SELECT Class, {', '.join(ALL)} FROM t) ON {', '.join(ALL)} INTO NAME feature VALUE value), "
    f"r AS (SELECT feature, Class, value, {_THIRD} AS d, COUNT(*) OVER (PARTITION BY feature, Class) AS nc FROM u WINDOW w AS (PARTITION BY feature, Class ORDER BY value)), "
    "e AS (SELECT feature, value, 1 AS n FROM u UNION ALL SELECT feature, value - d, 0 FROM r UNION ALL SELECT feature, value + d, 0 FROM r), "
    "c AS (SELECT feature, value, SUM(n) AS n, SUM(SUM(n)) OVER (PARTITION BY feature ORDER BY value) AS upto FROM e GROUP BY feature, value), "
    "m AS (SELECT r.feature, nc, CASE WHEN d > 0 THEN hi.upto - hi.n - lo.upto ELSE lo.n END AS m FROM r "
    "JOIN c lo ON lo.feature = r.feature AND lo.value = r.value - d JOIN c hi ON hi.feature = r.feature AND hi.value = r.value + d), "
    f"s AS (SELECT feature, {_psi_sql('COUNT(*)')} + {_psi_sql('3.0')} - AVG({_psi_sql('CAST(nc AS DOUBLE)')}) - AVG({_psi_sql('CAST(m AS DOUBLE)')}) AS mi FROM m GROUP BY feature) "
    f"SELECT feature, {R('GREATEST(mi, 0.0)')} AS mutual_information FROM s",
)
def _(spark, sf):
    return rounded(nearest_mutual_information(transactions(spark, sf), ALL))


@query(
    "F7_select_k_best",
    f"WITH {T}, {ANOVA} SELECT feature, {R('f_score')} AS f_score FROM f ORDER BY f_score DESC, feature LIMIT 10",
)
def _(spark, sf):
    scores = sel.anova_f(transactions(spark, sf), ALL)
    return rounded(sel.select_k_best(scores, "f_score", min(10, len(ALL))))


@query(
    "F11_vote",
    f"WITH {T}, {ANOVA}, a AS (SELECT feature FROM f ORDER BY f_score DESC, feature LIMIT 12), "
    f"u2 AS (UNPIVOT (SELECT {', '.join(ALL)} FROM t) ON {', '.join(ALL)} INTO NAME feature VALUE value), "
    "b AS (SELECT feature FROM u2 GROUP BY feature ORDER BY VAR_POP(value) DESC, feature LIMIT 12), "
    "c AS (SELECT feature FROM u GROUP BY feature ORDER BY ABS(corr(value, Class)) DESC, feature LIMIT 12), "
    "z AS (SELECT feature FROM a UNION ALL SELECT feature FROM b UNION ALL SELECT feature FROM c) "
    "SELECT feature, COUNT(*) AS votes FROM z GROUP BY feature HAVING COUNT(*) >= 1",
)
def _(spark, sf):
    from rareflow.operators.profile import target_correlation

    df = transactions(spark, sf)

    def top(scores, name):
        return [r.feature for r in sel.select_k_best(scores, name, 12).collect()]

    corr = target_correlation(df, ALL).withColumn("corr", F.abs("corr"))
    chosen = {
        "anova": top(sel.anova_f(df, ALL), "f_score"),
        "variance": top(sel.variances(df, ALL), "variance"),
        "correlation": top(corr, "corr"),
    }
    return sel.vote(chosen, spark, 0.5)


@query(
    "F13_apply_selection",
    f"WITH {T} SELECT txn_id, Class, " + ", ".join(f"{R(c)} AS {c}" for c in ("V3", "V1", "Amount")) + " FROM t",
)
def _(spark, sf):
    from rareflow.session import fresh_path
    from rareflow.sources.reports import read_selection, write_selection

    path = fresh_path(spark, "selection")
    write_selection(spark, path, ["V3", "V1", "Amount"], {"V3": 3.0, "V1": 2.0, "Amount": 1.0})
    names = read_selection(spark, path)
    return rounded(transactions(spark, sf).select("txn_id", "Class", *names))


@query(
    "F13_fitted_selection",
    f"WITH {T}, {ANOVA}, o AS (SELECT feature FROM f ORDER BY f_score DESC, feature LIMIT 10), "
    f"v AS (UNPIVOT (SELECT txn_id, Class, {', '.join(ALL)} FROM t) ON {', '.join(ALL)} INTO NAME feature VALUE value) "
    f"SELECT txn_id, Class, feature, {R('value')} AS value FROM v JOIN o USING (feature)",
)
def _(spark, sf):
    """The ten best columns by F score, saved, read back and applied to the table."""
    from rareflow.session import fresh_path
    from rareflow.sources.reports import read_selection, write_selection

    df = transactions(spark, sf)
    best = sel.select_k_best(sel.anova_f(df, ALL), "f_score", 10).collect()
    path = fresh_path(spark, "selection")
    write_selection(spark, path, [r.feature for r in best], {r.feature: r.f_score for r in best})
    names = read_selection(spark, path)
    return rounded(df.select("txn_id", "Class", *names).unpivot(["txn_id", "Class"], names, "feature", "value"))
