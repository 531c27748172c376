"""Source lists and ground truth in YAML files as a data source, a task a file.

    spark.dataSource.register(ListFiles)
    spark.read.format("cue-lists").option("kind", "sources").load("/lists/*.yaml")

A ``sources`` file must have its list, and no id twice; a ``clips`` file may lack it, and clips without an absolute place
lie beside the file.
"""

from __future__ import annotations

import glob
import posixpath
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cuegrid.sources.listing import OPTIONAL, REQUIRED

RECT = "struct<x:int,y:int,w:int,h:int>"
_TEXTS = ("id", *REQUIRED, *OPTIONAL, "caption_language", "sign_language", "language_label")
SCHEMAS = {
    "sources": "file string, pos int, " + ", ".join(f"{c} string" for c in _TEXTS) + f", crop_rect {RECT}, main_rect {RECT}",
    "clips": f"file string, pos int, clip string, rect {RECT}, face {RECT}, notes string",
}


def _rect(item: dict, key: str, where: str) -> tuple[int, int, int, int] | None:
    value = item.get(key)
    if not isinstance(value, dict):
        return None
    try:
        return tuple(int(value[k]) for k in "xywh")
    except (KeyError, TypeError, ValueError) as e:
        raise ValueError(f"{where}: {key} needs whole numbers x, y, w and h") from e


def rows_of(text: str, file: str, kind: str) -> Iterator[tuple]:
    """The rows of one file's text, in the order of SCHEMAS."""
    import yaml

    data = yaml.safe_load(text) or {}
    items = data.get(kind) if isinstance(data, dict) else None
    if items is None and kind == "clips":
        return
    if not isinstance(items, list):
        raise ValueError(f"{file}: '{kind}' must be a list")
    said = lambda v: None if v is None else str(v)
    seen: set[str] = set()
    for pos, item in enumerate(items):
        where = f"{file}: {kind} {pos}"
        if not isinstance(item, dict):
            raise ValueError(f"{where} must be a mapping")
        if kind == "clips":
            if not item.get("clip") or (rect := _rect(item, "rect", where)) is None:
                raise ValueError(f"{where} needs clip and rect")
            clip = posixpath.join(posixpath.dirname(file), str(item["clip"]))
            yield file, pos, clip, rect, _rect(item, "face", where), said(item.get("notes"))
            continue
        name = said(item.get("id"))
        if name in seen:
            raise ValueError(f"{file}: id {name} occurs twice")
        seen.update({name} - {None})
        yield (file, pos, *(said(item.get(c)) for c in _TEXTS), _rect(item, "crop_rect", where), _rect(item, "main_rect", where))


class _File(InputPartition):
    def __init__(self, file: str) -> None:
        self.file = file


class _Reader(DataSourceReader):
    def __init__(self, path: str, kind: str) -> None:
        self.path, self.kind = path, kind

    def partitions(self) -> list[InputPartition]:
        if "://" in self.path:
            return [_File(self.path)]
        files = sorted(glob.glob(self.path)) or [self.path]
        return [_File(f) for f in files]

    def read(self, partition: _File) -> Iterator[tuple]:
        from pyarrow import fs

        at = partition.file
        system, path = fs.FileSystem.from_uri(at) if "://" in at else (fs.LocalFileSystem(), at)
        with system.open_input_stream(path) as stream:
            text = stream.read().decode("utf-8")
        yield from rows_of(text, at, self.kind)


class ListFiles(DataSource):
    """Options: path (a file, a pattern of local files, or an address that Arrow's file systems know) and kind (sources or clips)."""

    @classmethod
    def name(cls) -> str:
        return "cue-lists"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "sources")]

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("kind", "sources"))


def parse_lists(texts: DataFrame, kind: str = "sources") -> DataFrame:
    """The rows of ``texts(file, text)``: for lists that Spark has read already."""
    names = [f.split()[0] for f in SCHEMAS[kind].replace(RECT, "rect").split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for file, text in zip(batch.file, batch.text, strict=True) for r in rows_of(text or "", file, kind)]
            made = pd.DataFrame(rows, columns=names)
            for c in ("crop_rect", "main_rect", "rect", "face"):
                if c in made:
                    made[c] = [dict(zip("xywh", r, strict=True)) if isinstance(r, tuple) else None for r in made[c]]
            yield made

    return texts.select("file", "text").mapInPandas(parse, SCHEMAS[kind])
