"""Motion activity on a regular grid.

Tables: ``samples(title_id, time_s, motion)`` with null for "no measurement", and
``media(title_id, duration_s)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.functions.numbers import with_quantile

GLYPHS = " ▁▂▃▄▅▆▇█"


def bucket_count(duration_s: Column, interval_s: float) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.greatest(duration_s, F.lit(0.0)) / interval_s).cast("int"))


def bucket_values(samples: DataFrame, media: DataFrame, interval_s: float) -> DataFrame:
    """(title_id, bucket, value): the mean of each bucket's samples.

    Null samples and those before 0 are left out; samples past the end fall in the last bucket.  A
    bucket without samples repeats the value before it, or is 0 at the head.
    """
    if interval_s <= 0:
        raise ValueError("interval_s must be positive")
    sizes = media.select("title_id", bucket_count(F.col("duration_s"), interval_s).alias("n"))
    grid = sizes.select("title_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("bucket"))
    # Sums are rounded to a millionth so that they don't depend on the order of addition.
    means = (
        samples.where("motion is not null and not isnan(motion) and time_s >= 0")
        .join(sizes, "title_id")
        .groupBy("title_id", F.least(F.col("n") - 1, F.floor(F.col("time_s") / interval_s).cast("int")).alias("bucket"))
        .agg((F.sum(F.round(F.col("motion") * 1e6).cast("decimal(38,0)")).cast("double") / F.count("*") / 1e6).alias("mean"))
    )
    held = Window.partitionBy("title_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    value = F.coalesce(F.last("mean", ignorenulls=True).over(held), F.lit(0.0))
    return grid.join(means, ["title_id", "bucket"], "left").select("title_id", "bucket", value.alias("value"))


def normalise(values: DataFrame, percentile: float = 0.95) -> DataFrame:
    """Adds level (0 to 100, halves to even) and top, the title's percentile; a flat title is all 0."""
    top = F.col("top")
    usable = (top > 1e-9) & ~F.isnan(top)
    share = F.least(F.greatest(F.col("value") / top, F.lit(0.0)), F.lit(1.0))
    return with_quantile(values, "title_id", "value", percentile, "top").withColumn("top", F.when(usable, top).otherwise(0.0)).withColumn(
        "level", F.when(F.col("top") > 0, F.bround(share * 100)).otherwise(0.0).cast("int")
    )


def idle_fraction(track: DataFrame, threshold: int = 20) -> DataFrame:
    """(title_id, idle): the share of levels strictly below the threshold."""
    return track.groupBy("title_id").agg(F.coalesce(F.avg((F.col("level") < threshold).cast("double")), F.lit(0.0)).alias("idle"))


def level_at(track: DataFrame, positions: DataFrame, interval_ms: int) -> DataFrame:
    """As-of lookup ``positions(title_id, position_ms)`` on the grid: floor, clamped to both ends."""
    ends = track.groupBy("title_id").agg(F.max("bucket").alias("last"))
    bucket = F.least(F.greatest(F.floor(F.col("position_ms") / interval_ms).cast("int"), F.lit(0)), F.col("last"))
    keyed = positions.join(ends, "title_id").withColumn("bucket", bucket)
    return keyed.join(track.select("title_id", "bucket", "level"), ["title_id", "bucket"]).select(
        "title_id", "position_ms", "bucket", "level"
    )


def sparkline_columns(track: DataFrame, width: int = 80) -> DataFrame:
    """(title_id, column, mean, glyph): the track in at most ``width`` columns."""
    n = F.count("*").over(Window.partitionBy("title_id"))
    wide = track.withColumn("n", n)
    # column c spans buckets floor(c * n / width) to floor((c + 1) * n / width) - 1
    column = F.when(F.col("n") <= width, F.col("bucket")).otherwise(
        F.floor(((F.col("bucket") + 1) * F.lit(width) - 1) / F.col("n"))
    )
    out = wide.groupBy("title_id", column.cast("int").alias("column")).agg(F.avg(F.col("level").cast("double")).alias("mean"))
    place = F.bround(F.col("mean") / 100 * (len(GLYPHS) - 1)).cast("int") + 1
    return out.withColumn("glyph", F.substring(F.lit(GLYPHS), place, F.lit(1)))


def measure_activity(samples: DataFrame, media: DataFrame, interval_ms: int) -> DataFrame:
    """The track of every title: title_id, bucket, value, top, level and its number of samples."""
    last = samples.groupBy("title_id").agg(F.max("time_s").alias("last_s"), F.count("motion").alias("samples"))
    known = last.join(media, "title_id", "left").select(
        "title_id", F.coalesce(F.when(F.col("duration_s") > 0, F.col("duration_s")), "last_s").alias("duration_s"), "samples"
    )
    track = normalise(bucket_values(samples, known, interval_ms / 1000))
    return track.join(known.select("title_id", "samples"), "title_id")
