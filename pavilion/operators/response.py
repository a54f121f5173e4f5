"""How the response varies with one feature: bucket means, shapes, trends, categories."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.functions.columns import to_long
from pavilion.functions.sizing import broadcast_if_small
from pavilion.functions.staging import stage
from pavilion.operators.buckets import WIDTH_BUCKETS, equal_width_long

# Histogram bin width and number of density points.
BIN_WIDTH = 0.2
DENSITY_POINTS = 500
# Beyond this many bandwidths exp(-u * u / 2) is 0 in double arithmetic: nothing is cut.
DENSITY_REACH = 39.0
# Moments of a box; the terms left out are below 1e-15.
DENSITY_TERMS = 20


def population(df: DataFrame, response: str) -> DataFrame:
    """One row, one struct: response rate and number of rows."""
    return df.agg(
        F.struct(F.avg(response).alias("rate"), F.count(F.lit(1)).alias("rows")).alias("all")
    )


def squared_differences(
    stats: DataFrame, keys: Sequence[str], whole: Column, mean: str = "bin_mean"
) -> DataFrame:
    """Sum over the bins of (bin mean - response rate)^2, plain and weighted by bin share."""
    sized = stats.withColumn("all", whole)
    gap = F.pow(F.col(mean) - F.col("all")["rate"], F.lit(2.0))
    return (
        sized.withColumn("gap", gap)
        .groupBy(*keys)
        .agg(
            F.sum("gap").alias("mean_sq_diff"),
            F.sum(F.col("gap") * F.col("bin_count") / F.col("all")["rows"]).alias(
                "mean_sq_diff_weighted"
            ),
        )
    )


def bucket_stats(
    df: DataFrame, columns: Sequence[str], response: str, n: int = WIDTH_BUCKETS
) -> DataFrame:
    """Count, response mean and feature mean per (feature, equal-width bucket)."""
    return (
        equal_width_long(df, columns, [response], n)
        .groupBy("feature", "bucket")
        .agg(
            F.count(response).alias("bin_count"),
            F.avg(response).alias("bin_mean"),
            F.avg("x").alias("x_mean"),
        )
    )


def feature_msd(
    df: DataFrame, columns: Sequence[str], response: str, n: int = WIDTH_BUCKETS
) -> DataFrame:
    """Mean squared difference of the response per feature, plain and weighted."""
    whole = population(df, response).scalar()
    return squared_differences(bucket_stats(df, columns, response, n), ["feature"], whole)


def category_stats(df: DataFrame, category: str, response: str) -> DataFrame:
    return df.groupBy(F.col(category).alias("category")).agg(
        F.count(response).alias("bin_count"), F.avg(response).alias("bin_mean")
    )


def category_msd(df: DataFrame, category: str, response: str) -> DataFrame:
    """Mean squared difference of the response with each category as a bin."""
    whole = population(df, response).scalar()
    stats = category_stats(df.where(F.col(category).isNotNull()), category, response)
    return squared_differences(
        stats.withColumn("feature", F.lit(category)), ["feature"], whole
    )


def category_counts(
    df: DataFrame, category: str, response: str, values: Sequence[int] = (0, 1)
) -> DataFrame:
    """Rows per category (down) and response value (across)."""
    return df.groupBy(F.col(category).alias("category")).agg(
        *[F.count_if(F.col(response) == v).alias(f"response_{v}") for v in values]
    )


def _class_bounds(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (feature, class), written, so that its size is known where it is joined."""
    found = long.groupBy(*keys).agg(
        F.count("x").alias("rows"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.stddev_samp("x").alias("sd"),
    )
    return stage(found, "class-bounds")


def _with_class_bounds(long: DataFrame, bounds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long rows with the bounds of their (feature, class), broadcast if they are small."""
    return long.join(broadcast_if_small(bounds), list(keys))


def class_histogram(
    df: DataFrame, columns: Sequence[str], response: str, width: float = BIN_WIDTH
) -> DataFrame:
    """Counts and densities per (feature, class, bin); bins start at the class minimum."""
    long = to_long(df, [response], columns).where(F.col("x").isNotNull())
    keys = ["feature", response]
    located = _with_class_bounds(long, _class_bounds(long, keys), keys)
    bin_no = F.floor((F.col("x") - F.col("low")) / F.lit(width)).cast("long")
    return (
        located.groupBy(*keys, bin_no.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("bin_count"),
            F.first("low").alias("low"),
            F.first("rows").alias("rows"),
        )
        .select(
            *keys,
            "bin",
            (F.col("low") + F.col("bin") * width).alias("bin_start"),
            "bin_count",
            (F.col("bin_count") / (F.col("rows") * F.lit(width))).alias("density"),
        )
    )


def _hermite(moments: Sequence[Column]) -> list[Column]:
    """Coefficients by power of the sum of moments times Hermite polynomials.

    The polynomials follow He(k + 1) = t * He(k) - k * He(k - 1); their coefficients are whole
    numbers. Higher powers have fewer terms.
    """
    polynomials = [[1], [0, 1]]
    for k in range(1, len(moments) - 1):
        longer = [0, *polynomials[k]]
        for i, c in enumerate(polynomials[k - 1]):
            longer[i] -= k * c
        polynomials.append(longer)
    out = []
    for power in range(len(moments)):
        terms = [
            moments[k] * F.lit(float(polynomials[k][power]))
            for k in range(power, len(moments), 2)
            if polynomials[k][power]
        ]
        out.append(reduce(lambda x, y: x + y, terms))
    return out


def class_density(
    df: DataFrame, columns: Sequence[str], response: str, points: int = DENSITY_POINTS
) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth) on a grid per (feature, class).

    A fast Gauss transform: values fall into boxes one bandwidth wide, and one aggregate
    gives each box its first ``DENSITY_TERMS`` moments about its centre. With u the distance
    of a value and t that of a grid point from the centre, in bandwidths, the kernel is
    exp(-t * t / 2) times the sum of He(k, t) * u ** k / k!, and as u is at most a half, the
    terms left out add up to less than 1e-15 of a row's largest contribution. A box reaches
    all grid points at which it is not exactly 0 in double arithmetic. Rows are never
    multiplied; boxes grow with the range in bandwidths.
    """
    long = to_long(df, [response], columns).where(F.col("x").isNotNull())
    keys = ["feature", response]
    bounds = (
        _class_bounds(long, keys)
        .where(F.col("sd") > 0)
        .withColumn("bandwidth", F.col("sd") * F.pow(F.col("rows"), F.lit(-0.2)))
        .withColumn("step", (F.col("high") - F.col("low")) / F.lit(float(points)))
    )
    width = F.col("bandwidth")
    box = F.floor((F.col("x") - F.col("low")) / width)
    u = (F.col("x") - F.col("low")) / width - F.col("box") - 0.5
    located = _with_class_bounds(long, bounds.select(*keys, "low", "bandwidth"), keys)
    powers = located.withColumn("box", box).select(*keys, "box", F.lit(1.0).alias("u0"), u.alias("u1"))
    for k in range(2, DENSITY_TERMS):
        half = k // 2
        powers = powers.withColumn(f"u{k}", F.col(f"u{half}") * F.col(f"u{k - half}"))
    moments = [(F.sum(f"u{k}") / F.lit(float(math.factorial(k)))).alias(f"m{k}") for k in range(DENSITY_TERMS)]
    boxes = powers.groupBy(*keys, "box").agg(*moments)
    # the density of a box at a grid point: a polynomial in t, times exp(-t * t / 2)
    terms = _hermite([F.col(f"m{k}") for k in range(DENSITY_TERMS)])
    boxes = boxes.select(*keys, "box", *[c.alias(f"c{i}") for i, c in enumerate(terms)])
    placed = boxes.join(broadcast_if_small(bounds), keys)
    centre = (F.col("box") + 0.5) * width
    reach = width * DENSITY_REACH
    first = F.greatest(F.ceil((centre - reach) / F.col("step")), F.lit(0))
    last = F.least(F.floor((centre + reach) / F.col("step")), F.lit(points - 1))
    # The class maximum lies one step behind the last grid point.
    touched = F.when(first <= last, F.sequence(first, last))
    t = (F.col("point") * F.col("step") - centre) / width
    value = reduce(lambda acc, i: acc * F.col("t") + F.col(f"c{i}"), range(DENSITY_TERMS - 2, -1, -1), F.col(f"c{DENSITY_TERMS - 1}"))
    sums = (
        placed.select("*", F.explode(touched).alias("point"))
        .withColumn("t", t)
        .groupBy(*keys, "point")
        .agg(F.sum(F.exp(F.col("t") * F.col("t") * F.lit(-0.5)) * value).alias("mass"))
    )
    grid = bounds.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    grid = grid.withColumn("point", F.col("point").cast("long"))
    scale = F.col("rows") * F.col("bandwidth") * F.lit(math.sqrt(2 * math.pi))
    return grid.join(sums, [*keys, "point"], "left").select(
        *keys,
        "point",
        (F.col("low") + F.col("point") * F.col("step")).alias("x"),
        (F.greatest(F.coalesce(F.col("mass"), F.lit(0.0)), F.lit(0.0)) / scale).alias("density"),
    )


def linear_trend(df: DataFrame, columns: Sequence[str], response: str) -> DataFrame:
    """Least-squares line of the response on each feature; NULL for a constant feature."""
    y = F.col(response).cast("double")

    def line(name: str) -> Column:
        x = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("feature"),
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.regr_r2(y, x).alias("r2"),
        )

    return df.agg(F.array(*[line(c) for c in columns]).alias("lines")).select(F.inline("lines"))
