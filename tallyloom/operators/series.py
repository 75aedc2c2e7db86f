"""Trend forecasts and anomaly scores for keyed time series (one row per key and period)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numbers import rounded
from tallyloom.sources.tables import union_padded


def forecast(series: DataFrame, keys: list[str], month: str, value: str, periods: int) -> DataFrame:
    """Least-squares trend continued for ``periods`` months, with 95 % bounds, after the history.

    The line is fitted on month numbers; the band is 1.96 residual standard
    deviations (n - 2 degrees of freedom) around it.
    """
    x = (F.year(month) * 12 + F.month(month)).cast("double")
    y = F.col(value).cast("double")
    fit = series.groupBy(*keys).agg(
        F.max(month).alias("_last"), F.max(x).alias("_x"), F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"),
        F.sqrt(F.greatest(F.regr_syy(y, x) - F.regr_slope(y, x) * F.regr_sxy(y, x), F.lit(0.0)) / F.nullif(F.regr_count(y, x) - 2, F.lit(0))).alias("_s"),
    )
    ahead = fit.withColumn("_h", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    line = F.col("_a") + F.col("_b") * (F.col("_x") + F.col("_h"))
    future = ahead.select(
        *keys, F.add_months("_last", F.col("_h")).alias(month), rounded(line, 2).alias("forecast"),
        rounded(line - 1.96 * F.col("_s"), 2).alias("lower_bound"), rounded(line + 1.96 * F.col("_s"), 2).alias("upper_bound"),
    )
    return union_padded(series.select(*keys, month, y.alias("actual")), future)


def anomalies(series: DataFrame, keys: list[str], at: str, value: str, trailing: int = 14, limit: float = 2.0) -> DataFrame:
    """Each point against the mean and deviation of its trailing window."""
    y = F.col(value).cast("double")
    by = Window.partitionBy(*keys).orderBy(at)
    past = by.rowsBetween(-trailing, -1)
    spread = F.stddev_samp(y).over(past)
    expected = F.avg(y).over(past)
    distance = (y - expected) / F.nullif(spread, F.lit(0.0))
    rank = F.percent_rank().over(Window.partitionBy(*keys).orderBy(y))
    return series.select(
        *keys, at, y.alias("y"), rounded(expected, 4).alias("forecast"), rounded(distance, 4).alias("distance"), rounded(rank, 4).alias("percentile"),
        F.coalesce(F.abs(distance) > limit, F.lit(False)).alias("is_anomaly"),
    )
