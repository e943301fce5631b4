"""Mutual information of a column and the class by nearest neighbours on the line, without bins.

For each row the distance to its k-th nearest row of the same class is a radius; the
fewer rows of any class lie within it, the more the column tells about the class.
Values fold to counts first. A value's neighbours are found by its position among the
values of its class, so no window is needed, and rows within a radius are counted by
running totals at the radius's two ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.functions.shape import unpivot
from rareflow.operators.ordering import prefix_sums
from rareflow.session import stored

#: By so much an argument is raised before the series for the digamma function is used.
RAISE = 10


def digamma(x: Column) -> Column:
    """The digamma function of a positive number, to about 1e-11."""
    y = x + F.lit(float(RAISE))
    series = F.ln(y) - 1 / (2 * y) - 1 / (12 * y * y) + 1 / (120 * y * y * y * y) - 1 / (252 * y * y * y * y * y * y)
    return series - sum((1 / (x + F.lit(float(i))) for i in range(RAISE)), F.lit(0.0))


def class_radii(values: DataFrame, k: int) -> DataFrame:
    """(feature, cls, value, n, k, members, radius) of value counts (feature, cls, value, n).

    ``radius`` is the distance to the k-th nearest other row of the class, fewer if the
    class is smaller.
    """
    by = ["feature", "cls"]
    sizes = values.groupBy(*by).agg(F.sum("n").alias("members"))
    placed = prefix_sums(values.withColumn("one", F.lit(1).cast("bigint")), "value", {"pos": "one"}, by).drop("one")
    placed = stored(placed.join(sizes, by), "values-in-order")
    steps = F.array(*[F.lit(s).cast("bigint") for s in range(-k, k + 1) if s])
    wanted = placed.select(*by, "value", F.explode(F.transform(steps, lambda s: s + F.col("pos"))).alias("pos"))
    other = placed.select(*by, "pos", F.col("value").alias("_v"), F.col("n").alias("_n"))
    near = wanted.join(other, [*by, "pos"]).groupBy(*by, "value").agg(
        F.sort_array(F.collect_list(F.struct(F.abs(F.col("_v") - F.col("value")).alias("d"), F.col("_n").alias("n")))).alias("near")
    )
    # at most 2k neighbours: the nearest are used up until k rows are found
    k_of = F.least(F.lit(k).cast("bigint"), F.col("members") - 1)
    start = F.struct((k_of - (F.col("n") - 1)).alias("left"), F.lit(0.0).alias("d"))
    found = F.aggregate(
        F.coalesce(F.col("near"), F.array().cast("array<struct<d:double,n:bigint>>")), start,
        lambda a, x: F.when(
            a["left"] > 0, F.struct((a["left"] - x["n"]).alias("left"), x["d"].alias("d"))
        ).otherwise(a),
    )
    return placed.join(near, [*by, "value"], "left").select(
        *by, "value", "n", k_of.alias("k"), "members", found["d"].alias("radius")
    )


def nearest_mutual_information(df: DataFrame, cols: Sequence[str], target: str = "Class", k: int = 3) -> DataFrame:
    """(feature, mutual_information) in nats, never below zero.

    Null and NaN values are left out, and so are classes of a single row. Within a
    radius means nearer than it; at radius zero, equal. An empty table gives no rows.
    """
    long = unpivot(df.where(F.col(target).isNotNull()), [target], cols).where(~F.isnan("value"))
    values = long.groupBy("feature", F.col(target).alias("cls"), "value").agg(F.count(F.lit(1)).alias("n"))
    values = stored(values, "value-counts")
    large = values.groupBy("feature", "cls").agg(F.sum("n").alias("members")).where("members > 1").drop("members")
    values = values.join(large, ["feature", "cls"])
    radii = stored(class_radii(values, k), "radii")
    ends = radii.withColumns({"low": F.col("value") - F.col("radius"), "high": F.col("value") + F.col("radius")})
    marks = values.select("feature", "value", "n")
    for end in ("low", "high"):
        marks = marks.unionByName(ends.select("feature", F.col(end).alias("value"), F.lit(0).cast("bigint").alias("n")))
    marks = marks.groupBy("feature", "value").agg(F.sum("n").alias("n")).withColumn("upto", F.col("n"))
    line = stored(prefix_sums(marks, "value", {"upto": "upto"}, ["feature"]), "running-counts")

    def at(name: str) -> DataFrame:
        return line.select("feature", F.col("value").alias(name), F.col("n").alias(f"{name}_n"), F.col("upto").alias(f"{name}_upto"))

    both = ends.join(at("low"), ["feature", "low"]).join(at("high"), ["feature", "high"])
    inside = F.when(F.col("radius") > 0, F.col("high_upto") - F.col("high_n") - F.col("low_upto")).otherwise(F.col("low_n"))
    n = F.col("n").cast("double")
    terms = n * (digamma(F.col("k").cast("double")) - digamma(F.col("members").cast("double")) - digamma(inside.cast("double")))
    total = both.groupBy("feature").agg(F.sum("n").cast("double").alias("rows"), F.sum(terms).alias("terms"))
    found = digamma(F.col("rows")) + F.col("terms") / F.col("rows")
    return total.select("feature", F.greatest(found, F.lit(0.0)).alias("mutual_information"))
