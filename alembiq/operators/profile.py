"""Reports over a whole table: the commonest values of columns, and the spread of numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut
from .quantiles import quantiles

POINTS = (10, 25, 50, 75, 90)


def usage(df: DataFrame, columns: dict[str, Column], limit: int = 5) -> DataFrame:
    """(name, value, n, n_distinct): the ``limit`` commonest values of each column, ties by value.

    Elements of an array count one by one, and a null array has none; null is
    a value of any other column. All columns are counted in one aggregation.
    """
    named = df.select(*[c.alias(name) for name, c in columns.items()])
    kinds = dict(named.dtypes)
    none = F.array().cast("array<struct<name:string,value:string>>")

    def pair(name: str, x: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), x.cast("string").alias("value"))

    def pairs(name: str) -> Column:
        if kinds[name].startswith("array"):
            return F.coalesce(F.transform(name, lambda x: pair(name, x)), none)
        return F.array(pair(name, F.col(name)))

    counted = cut(named.select(F.explode(F.concat(*map(pairs, columns))).alias("x")).groupBy("x.name", "x.value").agg(F.count("*").alias("n")), "usage")
    distinct = counted.groupBy("name").agg(F.count("*").alias("n_distinct"))  # a row per column
    order = Window.partitionBy("name").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    best = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit).drop("place")
    return best.join(F.broadcast(distinct), "name").select("name", "value", "n", "n_distinct")


def spread(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(name, n, mean, low, high, p10, p25, p50, p75, p90) of each value, nulls left out, exact and interpolated.

    A value without rows has no row.
    """
    stacked = F.array(*[F.struct(F.lit(name).alias("name"), v.cast("double").alias("v")) for name, v in values.items()])
    rows = cut(df.select(F.explode(stacked).alias("x")).select("x.name", "x.v").filter("v is not null"), "spread")
    moments = rows.groupBy("name").agg(F.round(F.avg("v"), 6).alias("mean"), F.min("v").alias("low"), F.max("v").alias("high"))
    found = quantiles(rows, ["name"], "v", [p / 100 for p in POINTS]).join(F.broadcast(moments), "name")  # a row for each name
    return found.select("name", "n", "mean", "low", "high", *[F.round(F.col("q")[i], 6).alias(f"p{p}") for i, p in enumerate(POINTS)])
