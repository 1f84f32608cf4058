"""The n smallest by a whole number, found by counting: no task sorts or holds them, whatever n is.

The span of the values is cut into a few thousand buckets and the rows are counted by bucket; the bucket that holds the n-th is
cut again, until it is one value. At most six rounds cover all 64 bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import written

FAN = 4096


def nth_smallest(df: DataFrame, value: str, n: int, fan: int = FAN) -> tuple[int, int] | None:
    """The n-th smallest ``value`` and how many of the rows that have it are among the first n; None if all rows are.

    A round brings one row of a count per bucket to the driver.
    """
    found = df.agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("rows")).first()
    if found["rows"] <= n:
        return None
    low, span, wanted = found["low"], found["high"] - found["low"] + 1, n
    while span > 1:
        step = -(-span // fan)
        inside = df.where(F.col(value).between(F.lit(low), F.lit(low + span - 1)))
        bucket = F.floor((F.col(value) - F.lit(low)) / step) if span < 1 << 52 else F.expr(f"({value} - {low}L) div {step}L")
        counts = inside.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.orderBy("bucket"))
        at = counts.withColumn("upto", upto).where(F.col("upto") >= wanted).orderBy("bucket").first()  # of ``fan`` rows at most
        wanted -= at["upto"] - at["n"]
        low, span = low + at["bucket"] * step, min(step, span - at["bucket"] * step)
    return low, wanted


def smallest(df: DataFrame, value: str, n: int) -> DataFrame:
    """The n rows with the smallest ``value``; rows that tie for the last places are taken in the order of all columns."""
    if n <= 0:
        return df.limit(0)
    cut = nth_smallest(df, value, n)
    if cut is None:
        return df
    at, wanted = cut
    tied = df.where(F.col(value) == F.lit(at)).orderBy(*df.columns).limit(wanted)
    return df.where(F.col(value) < F.lit(at)).unionByName(tied)


def nth_by_group(df: DataFrame, group: str, value: str, n: int, fan: int = FAN) -> DataFrame:
    """(group, cut): per group the n-th smallest ``value``; groups of no more than n rows are absent.

    The state has a row per group, and a round counts rows by group and bucket before the shuffle.
    """
    per = df.groupBy(group).agg(F.min(value).alias("low"), (F.max(value) - F.min(value) + 1).alias("span"), F.count("*").alias("rows"))
    state = written(per.where(F.col("rows") > n).select(group, "low", "span", F.lit(n).cast("bigint").alias("wanted")), "nth")
    while not state.where("span > 1").isEmpty():
        step = F.ceil(F.col("span") / fan)
        inside = df.select(group, value).join(state.where("span > 1"), group).where(
            (F.col(value) >= F.col("low")) & (F.col(value) - F.col("low") < F.col("span")))
        counts = inside.groupBy(group, "low", "span", "wanted", step.alias("step"), F.floor((F.col(value) - F.col("low")) / step).alias("bucket")) \
            .agg(F.count("*").alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy(group).orderBy("bucket")))
        at = upto.where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted"))).select(
            group, (F.col("low") + F.col("bucket") * F.col("step")).alias("low"),
            F.least("step", F.col("span") - F.col("bucket") * F.col("step")).alias("span"),
            (F.col("wanted") - F.col("upto") + F.col("n")).alias("wanted"))
        state = written(at.unionByName(state.where("span <= 1")), "nth")
    return state.select(group, F.col("low").alias("cut"))
