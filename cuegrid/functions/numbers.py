"""Rounding and quantiles of doubles, as SQL engines compute them: a number is scaled, rounded to a whole one and scaled back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def half_up(value: Column | str, digits: int) -> Column:
    """A double rounded to so many decimals, halves away from zero."""
    return F.round((F.col(value) if isinstance(value, str) else value) * 10.0**digits) / 10.0**digits


def half_even(value: Column | str, digits: int) -> Column:
    """A double rounded to so many decimals, halves to even."""
    return F.rint((F.col(value) if isinstance(value, str) else value) * 10.0**digits) / 10.0**digits


def with_quantile(rows: DataFrame, key: str, value: str, share: float, name: str) -> DataFrame:
    """Adds the continuous quantile of a column among the rows of one key, null where all are null.

    The two values about its place are weighed with one rounding of the sum (a fused multiply-add), as SQL does it: the last
    bit decides where a share of the quantile is a half.
    """
    own = Window.partitionBy(key)
    nth = F.row_number().over(own.orderBy(F.col(value).asc_nulls_last())) - 1
    placed = rows.withColumns({"_nth": nth, "_place": (F.count(value).over(own) - 1) * F.lit(share)})
    low, high = (F.max(F.when(F.col("_nth") == at("_place"), F.col(value))).over(own) for at in (F.floor, F.ceil))
    placed = placed.withColumns({"_low": low, "_high": high, "_part": F.col("_place") - F.floor("_place")})
    fused = F.java_method(F.lit("java.lang.Math"), F.lit("fma"), F.col("_low"), 1 - F.col("_part"), F.col("_high") * F.col("_part")).cast("double")
    return placed.withColumn(name, F.when(F.col("_low").isNotNull() & F.col("_high").isNotNull(), fused)).drop("_nth", "_place", "_low", "_high", "_part")
