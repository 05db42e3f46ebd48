"""Ordered and interval computations: runs, range joins, windows, weighted regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def runs(df: DataFrame, by: list[str], order: list[str], value: str, first: Column, last: Column) -> DataFrame:
    """by, run, value, start, end, n: maximal runs of equal values (nulls are equal) in order, the last one included."""
    w = W.partitionBy(*by).orderBy(*order)
    new = F.when(F.row_number().over(w) == 1, 1).when(F.lag(value).over(w).eqNullSafe(F.col(value)), 0).otherwise(1)
    run = df.withColumn("_new", new).withColumn("run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return run.groupBy(*by, "run", value).agg(F.min(first).alias("start"), F.max(last).alias("end"), F.count("*").alias("n"))


def range_join(points: DataFrame, ranges: DataFrame, key: list[str], point: str, start: str, end: str, width: int) -> DataFrame:
    """Points inside [start, end] of ranges with equal keys: ranges are put into every bin of ``width`` that they touch, so the join is on key and bin."""
    r = ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width)))).where(F.col(start) <= F.col(end))
    p = points.withColumn("_bin", F.floor(F.col(point) / width))
    return p.join(r, [*key, "_bin"]).where((F.col(point) >= F.col(start)) & (F.col(point) <= F.col(end))).drop("_bin")


def relative_place(point: Column, start: Column, end: Column, strand: Column) -> Column:
    """Place inside a range from 1, counted from its end on the minus strand."""
    return F.when(strand == "-", end - point + 1).otherwise(point - start + 1)


def mean_depth(depth: DataFrame, genes: DataFrame, key: list[str], gene: str, width: int = 1000) -> DataFrame:
    """key, gene, value: depth over [start, end], which counts end - start + 1 places. depth: key, pos, depth; genes: key, gene, start, end."""
    j = range_join(depth, genes, key, "pos", "start", "end", width)
    return j.groupBy(*key, gene, "start", "end").agg(F.sum("depth").alias("_s")).select(*key, gene, (F.col("_s") / (F.col("end") - F.col("start") + 1)).alias("value"))


def rolling_mean(df: DataFrame, by: list[str], order: list[str], value: str, before: int, after: int, name: str = "mean", digits: int = 2) -> DataFrame:
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(-before, after)
    return df.withColumn(name, F.round(F.avg(value).over(w), digits))


def weighted_regions(df: DataFrame, by: list[str], order: list[str], weight: str, parts: int) -> DataFrame:
    """Adds region (from 0): consecutive rows of about equal weight; running sums within by, so by bounds what one task orders."""
    w = W.partitionBy(*by).orderBy(*order)
    run = F.sum(weight).over(w.rowsBetween(W.unboundedPreceding, 0)) - F.col(weight)
    total = F.sum(weight).over(W.partitionBy(*by))
    return df.withColumn("region", F.when(total == 0, 0).otherwise(F.least(F.floor(run * parts / total), F.lit(parts - 1))).cast("int"))


def windows(df: DataFrame, key: list[str], pos: str, value: str, size: int, sample: str, samples: list) -> DataFrame:
    """key, window, and the mean of each sample (0 where absent)."""
    return df.groupBy(*key, F.floor(F.col(pos) / size).alias("window")).pivot(sample, samples).agg(F.avg(value)).fillna(0)
