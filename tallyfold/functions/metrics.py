"""Metrics over small or large score tables, all as DataFrame aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the 97.5 % quantile of the normal distribution.
Z = 1.959964


def cramers_v(df: DataFrame, a: str, b: str, n: str) -> DataFrame:
    """One row `cramers_v` of a long contingency table; 0 when a side has one value only."""
    cells = df.groupBy(a, b).agg(F.sum(n).alias("n")).where("n > 0")
    wa, wb = Window.partitionBy(a), Window.partitionBy(b)
    parts = cells.withColumns({"ra": F.sum("n").over(wa), "rb": F.sum("n").over(wb)})
    agg = parts.agg(F.sum(F.col("n").cast("double") * F.col("n") / (F.col("ra").cast("double") * F.col("rb"))).alias("s"), F.count_distinct(a).alias("ka"), F.count_distinct(b).alias("kb"))
    k = F.least("ka", "kb") - 1
    return agg.select(F.when(k > 0, F.sqrt(F.greatest(F.lit(0.0), F.col("s") - 1) / k)).otherwise(0.0).alias("cramers_v"))


def auc(df: DataFrame, score: str, positive: str, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve with ties as halves, by average ranks; null without both classes.

    Scores are first counted, so that the ranking works on distinct scores and ties never meet in one task.
    """
    by = by or []
    counts = df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(F.count_if(F.col(positive)).alias("__p"), F.count_if(~F.col(positive)).alias("__n"))
    below = Window.partitionBy(*by).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("__under", F.coalesce(F.sum("__n").over(below), F.lit(0)))
    sums = ranked.groupBy(*by).agg(F.sum(F.col("__p") * (F.col("__under") + F.col("__n") / 2.0)).alias("__u"), F.sum("__p").alias("__p"), F.sum("__n").alias("__n"))
    return sums.select(*by, F.when((F.col("__p") > 0) & (F.col("__n") > 0), F.col("__u") / (F.col("__p").cast("double") * F.col("__n"))).alias("auc"))


def wilson(k: Column, n: Column) -> tuple[Column, Column]:
    """The 95 % interval of k of n, clamped to 0..1; nulls for n = 0."""
    p, m = k / n, n.cast("double")
    z2 = Z * Z
    half = F.sqrt(p * (1 - p) / m + z2 / (4 * m * m)) * Z
    low, high = ((p + z2 / (2 * m) + s * half) / (1 + z2 / m) for s in (-1, 1))
    return F.when(n > 0, F.greatest(F.lit(0.0), low)), F.when(n > 0, F.least(F.lit(1.0), high))


def confusion(df: DataFrame, score: str, positive: str, threshold: float, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn at score >= threshold, with recall and false-alarm intervals."""
    flagged = F.col(score) >= threshold
    agg = df.groupBy(*(by or [])).agg(
        F.count_if(flagged & F.col(positive)).alias("tp"), F.count_if(flagged & ~F.col(positive)).alias("fp"),
        F.count_if(~flagged & F.col(positive)).alias("fn"), F.count_if(~flagged & ~F.col(positive)).alias("tn"),
    )
    rl, rh = wilson(F.col("tp"), F.nullif(F.col("tp") + F.col("fn"), F.lit(0)))
    fl, fh = wilson(F.col("fp"), F.nullif(F.col("fp") + F.col("tn"), F.lit(0)))
    return agg.select(*(by or []), "tp", "fp", "fn", "tn", rl.alias("recall_low"), rh.alias("recall_high"), fl.alias("false_low"), fh.alias("false_high"))


def choose_threshold(df: DataFrame, score: str, positive: str, target: float) -> float:
    """The largest threshold whose recall reaches `target`: the k-th largest positive score."""
    if not 0 < target <= 1:
        raise ValueError("the target recall must be in (0, 1]")
    counts = df.where(F.col(positive) & F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        raise ValueError("no positives to choose a threshold from")
    k = math.ceil(target * total - 1e-9)
    reach = F.sum("n").over(Window.orderBy(F.col(score).desc()))
    return counts.withColumn("reach", reach).where(F.col("reach") >= k).agg(F.max(score)).first()[0]


def histogram(df: DataFrame, score: str, bins: int = 50, width: float = 0.01) -> DataFrame:
    """(bin, n) of scores; the last bin takes everything above."""
    return df.groupBy(F.least(F.lit(bins - 1), F.floor(F.col(score) / width + 1e-9)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
