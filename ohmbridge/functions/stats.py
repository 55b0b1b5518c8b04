"""Order statistics by group that have no built-in of the same definition, for groups of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmbridge.storage import materialize


def order_statistics(rows: DataFrame, by: str, value: str, places: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(by, n, a column for each place): the values that stand at given places, from 0, of a group's values in order.

    ``places`` takes a group's size. Equal values are counted first; distinct ones
    are dealt by ranges of group and value, so that a large group lies in several
    tasks, and running sums within a task and of the tasks before it give places.
    Nulls do not count.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(F.col(by).alias("__g"), F.col(value).alias("__v")).agg(F.count("*").alias("__c"))
    ranged = materialize(counts.repartitionByRange("__g", "__v").withColumn("__p", F.spark_partition_id()), "ranked")
    # a row for each group and task
    sums = ranged.groupBy(F.col("__g").alias("__h"), F.col("__p").alias("__q")).agg(F.sum("__c").alias("__s"))
    of = Window.partitionBy("__h")
    sums = sums.withColumns({"__b": F.sum("__s").over(of.orderBy("__q")) - F.col("__s"), "__n": F.sum("__s").over(of)}).drop("__s")
    upto = F.sum("__c").over(Window.partitionBy("__g", "__p").orderBy("__v"))
    placed = ranged.withColumn("__u", upto).join(sums, F.col("__g").eqNullSafe(F.col("__h")) & (F.col("__p") == F.col("__q")))
    end = F.col("__b") + F.col("__u")
    here = lambda at: F.max(F.when((at >= end - F.col("__c")) & (at < end), F.col("__v")))
    return placed.groupBy(F.col("__g").alias(by)).agg(F.max("__n").alias("n"), *(here(f(F.col("__n"))).alias(name) for name, f in places.items()))


def nearest_rank(percent: float) -> Callable[[Column], Column]:
    """The place of the element at rank p * n rounded half to even, from 1 to n."""
    return lambda n: F.greatest(F.lit(1), F.least(n, F.rint(F.lit(percent / 100.0) * n).cast("long"))) - 1


def upper_fences(rows: DataFrame, by: str, value: str, spread: float = 3.0, robust_z: float = 5.0, scale: float = 1.4826, least: int = 5) -> DataFrame:
    """(by, fence): the upper quartile plus ``spread`` interquartile ranges, by element place.

    Without any interquartile range: the median plus ``robust_z`` scaled median
    absolute deviations. Groups of fewer than ``least`` values or without any
    spread have no row.
    """
    at = {"q1": lambda n: F.floor(n / 4), "q3": lambda n: F.floor(3 * n / 4), "median": lambda n: F.floor(n / 2)}
    found = order_statistics(rows, by, value, at).where(F.col("n") >= least)
    found = materialize(found, "quartiles")
    wide = found.where("q3 > q1").select(by, (F.col("q3") + spread * (F.col("q3") - F.col("q1"))).alias("fence"))
    flat = found.where("q3 <= q1").select(F.col(by).alias("__f"), "median")
    if flat.isEmpty():
        return wide
    off = rows.select(by, value).join(flat, F.col(by).eqNullSafe(F.col("__f"))).select(by, "median", F.abs(F.col(value) - F.col("median")).alias("__d"))
    mad = order_statistics(off, by, "__d", {"mad": lambda n: F.floor(n / 2)}).where("mad > 0").select(F.col(by).alias("__m"), "mad")
    low = flat.join(mad, F.col("__f").eqNullSafe(F.col("__m"))).select(F.col("__f").alias(by), (F.col("median") + robust_z * scale * F.col("mad")).alias("fence"))
    return wide.unionByName(low)


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their places from 0 in ``order``, which must leave no ties to matter.

    Rows are numbered within sorted ranges, so no single task orders all of them.
    """
    keys = [f"__o{i}" for i in range(len(order))]
    ranged = rows.withColumns(dict(zip(keys, order, strict=True))).repartitionByRange(*keys).withColumn("__p", F.spark_partition_id())
    ranged = materialize(ranged, "numbered")
    # a row for each task
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("__m"))
    before = sizes.select("__p", (F.sum("__m").over(Window.orderBy("__p")) - F.col("__m")).alias("__b"))
    n = F.row_number().over(Window.partitionBy("__p").orderBy(*keys))
    return ranged.join(F.broadcast(before), "__p").withColumn(name, (F.col("__b") + n - 1).cast("long")).drop("__p", "__b", *keys)
