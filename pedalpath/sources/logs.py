"""Match logs kept as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Log line form (fixed value).
LOG_LINE = r"bike=(\d+)\s+end=(\d+)\s+lenA=(\d+)"


def parse_match_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """bike, end_station and length of every line that has all three; other lines are skipped."""
    def part(i):
        return F.regexp_extract(column, LOG_LINE, i).try_cast("bigint")

    return lines.where(F.col(column).rlike(LOG_LINE)).select(
        part(1).alias("bike"), part(2).alias("end_station"), part(3).alias("len_a"))


def read_match_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_match_log(spark.read.text(path))
