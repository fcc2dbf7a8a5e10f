"""Global numeric statistics (max, min, average, population standard deviation)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stats_global(df: DataFrame, col: str = "value") -> DataFrame:
    """One row: max, min, avg, std_dev (population, divides by n) and count.

    A single global aggregate: every task folds its partition into a partial
    buffer, so only one small row per task crosses the shuffle.  Empty input
    gives one row of nulls with count 0.
    """
    x = F.col(col).cast("double")
    return df.agg(F.max(x).alias("max"), F.min(x).alias("min"), F.avg(x).alias("avg"),
                  F.stddev_pop(x).alias("std_dev"), F.count(x).alias("n"))


def stats_report(stats: DataFrame, digits: int | None = None, leading_tab: bool = False) -> DataFrame:
    """The labelled report line ``Max: ..\tMin: ..\tAvg: ..\tStdDev: ..``.

    ``digits=None`` prints each value the way the JVM prints a double
    (shortest form, as the reference's line does); an integer prints fixed
    decimals.  ``leading_tab`` adds the TAB of the reference's key/value
    output line, whose key is empty.
    """
    def r(c):
        return F.col(c).cast("string") if digits is None else F.format_string(f"%.{digits}f", F.col(c))
    line = F.concat(F.lit("Max: "), r("max"), F.lit("\tMin: "), r("min"),
                    F.lit("\tAvg: "), r("avg"), F.lit("\tStdDev: "), r("std_dev"))
    if leading_tab:
        line = F.concat(F.lit("\t"), line)
    return stats.select(line.alias("report"))
