"""Exact quantiles of groups of any size, by selection over sorted ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut

#: Distinct values of all groups up to which one aggregation holds them, and distinct values of a range beyond.
SMALL = 1 << 20


def ranges(counted: DataFrame, group: list[str], value: str, parts: int) -> DataFrame:
    """group, value, n of ``counted``, with the rows of the group before it (``_from``) and in all (``_all``).

    Values are sorted over ``parts`` ranges, whatever their group; places within a
    range are running sums, and only the sums of (group, range) are added up in
    order.
    """
    placed = counted.repartitionByRange(parts, *group, value)
    fixed = cut(placed.withColumn("_part", F.spark_partition_id()), "ranges")
    sums = fixed.groupBy(*group, "_part").agg(F.sum("n").alias("_n"))
    whole = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(*group, "_part", before.alias("_before"), F.sum("_n").over(whole).alias("_all"))
    run = Window.partitionBy(*group, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    own = fixed.withColumn("_own", F.coalesce(F.sum("n").over(run), F.lit(0)))
    return own.join(offsets, [*group, "_part"]).withColumn("_from", F.col("_own") + F.col("_before")).drop("_own", "_before")


def quantiles(df: DataFrame, group: list[str], value: str, points: Sequence[float], small: int = SMALL) -> DataFrame:
    """group, n, q: rows with a value, and the exact quantiles of ``value`` (double) at ``points``, interpolated linearly.

    Rows are counted by value first. Up to ``small`` distinct values are held by
    one aggregation; beyond, the two rows on either side of each quantile are
    picked from sorted ranges, so that no group is one task's. Both give the
    same. A group without values has no row.
    """
    keys = group or ["_every"]
    rows = df if group else df.withColumn("_every", F.lit(0))
    held = rows.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    counted = cut(held.groupBy(*keys, "_v").agg(F.count("*").alias("n")), "counted")
    distinct = counted.count()
    if distinct <= small:
        found = counted.groupBy(*keys).agg(F.sum("n").alias("_n"), F.percentile("_v", F.array(*map(F.lit, map(float, points))), F.col("n")).alias("q"))
        return found.select(*group, F.col("_n").alias("n"), "q")
    placed = ranges(counted.withColumnRenamed("_v", "_value"), keys, "_value", -(-distinct // max(small, 1)))
    at = lambda p: F.lit(float(p)) * (F.col("_all") - 1)
    holds = lambda rank: (F.col("_from") <= rank) & (rank < F.col("_from") + F.col("n"))
    sides = [(F.floor(at(p)), F.ceil(at(p))) for p in points]
    near = placed.filter(sum((holds(r).cast("int") for side in sides for r in side), F.lit(0)) > 0)
    picked = [F.max(F.when(holds(r), F.col("_value"))) for side in sides for r in side]
    met = near.groupBy(*keys).agg(F.first("_all").alias("_all"), F.array(*picked).alias("_p"))
    values = [F.col("_p")[2 * i] + (F.col("_p")[2 * i + 1] - F.col("_p")[2 * i]) * (at(p) - F.floor(at(p))) for i, p in enumerate(points)]
    return met.select(*group, F.col("_all").alias("n"), F.array(*values).alias("q"))
