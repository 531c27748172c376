"""Work that is done once: results keyed by what they were made from.

A result table holds a row for each key with the digest of its input.  A run computes only keys that are new or whose digest has
changed, and rewrites only the buckets (by the key's hash) that these fall into.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stored(rows: DataFrame, path: str) -> DataFrame | None:
    try:
        return rows.sparkSession.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def outdated(rows: DataFrame, key: str, digest: Column, path: str) -> DataFrame:
    """The ``rows`` whose result is missing at ``path`` or was made from something else, with their ``digest``."""
    now = rows.withColumn("digest", digest)
    was = _stored(rows, path)
    return now if was is None else now.join(was.select(key, "digest"), [key, "digest"], "left_anti")


def update_results(
    rows: DataFrame, compute: Callable[[DataFrame], DataFrame], key: str, digest: Column, path: str, buckets: int = 64
) -> int:
    """Bring the result table at ``path`` up to date with ``rows``; the number of keys that were computed.

    ``compute`` takes the outdated rows and returns one row a key (its key column included).  What it makes is written to a
    folder beside the table first, together with the rows that stay in the same buckets; then these buckets are replaced in one job.
    Keys that ``rows`` no longer has keep their results; keys are unique and not null.
    """
    todo = outdated(rows, key, digest, path)
    spark, beside = rows.sparkSession, f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    made = compute(todo.drop("digest")).join(todo.select(key, "digest"), key)
    made = made.withColumn("bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))
    made.write.partitionBy("bucket").parquet(f"{beside}/new")
    new = _stored(rows, f"{beside}/new")
    number = 0 if new is None else new.count()
    if number:
        was = _stored(rows, path)
        whole = new
        if was is not None:
            touched = was.join(F.broadcast(new.select("bucket").distinct()), "bucket", "left_semi")
            whole = new.unionByName(touched.join(new.select(key), key, "left_anti"))
        whole.write.partitionBy("bucket").parquet(f"{beside}/whole")
        merged = spark.read.parquet(f"{beside}/whole")
        merged.write.partitionBy("bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return number
