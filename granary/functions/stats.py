"""Statistics on arrays and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def index_quantile(v: Column, q: float, empty: float = 1.0) -> Column:
    """The sorted array's element at int(n * q), the last one at most; empty arrays give ``empty``."""
    s = F.array_sort(v)
    i = F.least(F.floor(F.size(v) * F.lit(q)).cast("int"), F.size(v) - 1)
    return F.when(F.size(v) == 0, F.lit(empty)).otherwise(F.get(s, i))


def index_quantile_rounded(v: Column, q: float) -> Column:
    """The sorted array's element at int((n - 1) * q + 0.5)."""
    return F.when(F.size(v) > 0, F.get(F.array_sort(v), F.floor((F.size(v) - 1) * F.lit(q) + 0.5).cast("int")))


def non_zero(v: Column) -> Column:
    return F.size(F.filter(v, lambda x: x > 0))


def elementwise(df: DataFrame, keys: list[str], vector: str, how=F.avg, name: str = "profile") -> DataFrame:
    """One array a group: ``how`` over the members' components."""
    each = df.select(*keys, F.posexplode(vector).alias("_i", "_x")).groupBy(*keys, "_i").agg(how("_x").alias("_v"))
    return each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_v"))), lambda s: s["_v"]).alias(name))


def pearson(df: DataFrame, keys: list[str], x: str, y: str, digits: int = 4, name: str = "r") -> DataFrame:
    """Correlation by group, 0 where it is not defined."""
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return df.groupBy(*keys).agg(F.round(F.coalesce(F.nanvl(r, F.lit(0.0)), F.lit(0.0)), digits).alias(name))


def average_rank(df: DataFrame, keys: list[str], x: str, name: str) -> DataFrame:
    low = F.rank().over(W.partitionBy(*keys).orderBy(x))
    ties = F.count("*").over(W.partitionBy(*keys, x))
    return df.withColumn(name, low + (ties - 1) / 2.0)


def spearman(df: DataFrame, keys: list[str], x: str, y: str, digits: int = 4, name: str = "rho") -> DataFrame:
    """1 - 6 sum d^2 / (n (n^2 - 1)) with average ranks of ties; 0 below two rows."""
    ranked = average_rank(average_rank(df, keys, x, "_rx"), keys, y, "_ry")
    n = F.count("*")
    d2 = F.sum((F.col("_rx") - F.col("_ry")) * (F.col("_rx") - F.col("_ry")))
    return ranked.groupBy(*keys).agg(F.round(F.when(n < 2, 0.0).otherwise(1.0 - 6.0 * d2 / F.greatest(n * (n * n - 1), F.lit(1))), digits).alias(name))
