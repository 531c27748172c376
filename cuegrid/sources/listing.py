"""Source lists and blocked hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REQUIRED = ("title", "url", "publisher", "licence", "attribution")
OPTIONAL = ("production_credit", "acquisition_route", "local_path", "media", "captions", "official_report", "layout", "notes")


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def is_blocked(url: Column, hosts: tuple[str, ...]) -> Column:
    """Whether the host is one of ``hosts`` or under one."""
    host = url_host(url)
    hit = F.lit(False)
    for h in hosts:
        hit = hit | (host == h) | F.endswith(host, F.lit("." + h))
    return hit


def repeated(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The second and later rows of each key, in order, with their number."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("nth", nth).where("nth > 1")


def with_repeat_faults(sources: DataFrame) -> DataFrame:
    """``sources(id, faults)`` with a fault at every entry whose id another one has too."""
    n = F.count("*").over(Window.partitionBy("id"))
    twice = F.when((n > 1) & F.col("id").isNotNull(), F.array(F.lit("id occurs twice"))).otherwise(F.array().cast("array<string>"))
    return sources.withColumn("faults", F.concat("faults", twice))


def with_defaults(sources: DataFrame) -> DataFrame:
    """Trimmed source entries with defaults, and their faults as an array of strings."""
    clean = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) if c in sources.columns else F.lit(None).cast("string")
    has_crop = F.col("crop_rect").isNotNull() if "crop_rect" in sources.columns else F.lit(False)
    has_main = F.col("main_rect").isNotNull() if "main_rect" in sources.columns else F.lit(False)
    out = sources.withColumns({c: clean(c) for c in ("id", *REQUIRED, *OPTIONAL)})
    out = out.withColumns(
        {
            "caption_language": F.coalesce(clean("caption_language"), F.lit("en")),
            "sign_language": F.coalesce(clean("sign_language"), F.lit("ase")),
            "language_label": F.coalesce(clean("language_label"), F.lit("American Sign Language")),
            "media": F.coalesce("media", "url"),
        }
    )
    faults = [F.when(~F.coalesce(F.col("id").rlike("^[a-z0-9][a-z0-9-]{1,63}$"), F.lit(False)), "bad id")]
    faults += [F.when(F.col(c).isNull(), f"{c} is missing") for c in REQUIRED]
    faults += [
        F.when(has_crop & F.col("layout").isNull(), "crop_rect needs layout"),
        F.when(has_main & ~F.coalesce(F.col("layout") == "side-panel", F.lit(False)), "main_rect needs a side panel"),
    ]
    return out.withColumn("faults", F.filter(F.array(*faults), lambda x: x.isNotNull()))


def read_yaml_list(spark: SparkSession, path: str, key: str = "sources") -> DataFrame:
    """Small configuration files: one JSON string a list item, (path, pos, item)."""
    import json

    import pandas as pd
    import yaml

    def parse(batches):
        for pdf in batches:
            rows = []
            for p, text in zip(pdf.path, pdf.value, strict=True):
                items = (yaml.safe_load(text) or {}).get(key) or []
                if not isinstance(items, list):
                    raise ValueError(f"{p}: {key} must be a list")
                rows += [(p, i, json.dumps(x, default=str)) for i, x in enumerate(items)]
            yield pd.DataFrame(rows, columns=["path", "pos", "item"])

    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return files.mapInPandas(parse, "path string, pos long, item string")
