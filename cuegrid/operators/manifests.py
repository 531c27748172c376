"""Manifests: building, indexing, validating and publishing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuegrid.functions.json_text import json_document
from cuegrid.functions.text import absolute_url, let
from cuegrid.operators import checks as c

RECT = "struct<x:int,y:int,w:int,h:int>"
TITLE = (
    "struct<stmVersion:string,id:string,title:string,durationMs:int,"
    "source:struct<publisher:string,url:string,licence:string,attribution:string,productionCredit:string,acquisitionRoute:string>,"
    "video:struct<main:struct<url:string,width:int,height:int,codec:string>,poster:string>,"
    "signLanguage:array<struct<language:string,languageLabel:string,provenance:string,"
    f"extraction:struct<method:string,sourceLayout:string,confidence:double,cropRect:{RECT},fillMethod:string>,"
    "generatedBy:string,track:struct<url:string,width:int,height:int,codec:string,syncOffsetMs:int>,"
    "activity:struct<intervalMs:int,scale:string,values:array<int>>>>,"
    "captions:array<struct<kind:string,language:string,url:string,format:string,generatedBy:string,reviewed:boolean,reviewedBy:string>>>"
)

# Fixed values of the wire format.
VERSIONS = ["0.1", "0.2"]
CODECS = ["h264", "hevc", "vp9", "av1"]
PROVENANCES = ["human-interpreter", "synthesised"]
METHODS = ["detected-crop", "manual-crop"]
LAYOUTS = ["corner-inset", "side-panel"]
FILLS = ["none", "interpolated-surround", "blurred-surround"]
KINDS = ["verbatim", "simplified"]
ID = "^[a-z0-9][a-z0-9-]{1,63}$"
SIGN_LANGUAGE = "^[a-z]{3}$"
LANGUAGE = "^[a-z]{2,3}(-[A-Za-z0-9]{2,8})*$"
LEAST_CONFIDENCE, MOST_OFFSET = 0.7, 5000


def parse_manifests(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, json)`` with the typed manifest as ``m`` (all members null if it isn't JSON)."""
    return documents.withColumn("m", F.from_json("json", TITLE))


_HUMAN, _MADE = (("equals", "provenance", p) for p in PROVENANCES)
#: Who signs decides what else a track has; without a provenance both rules hold.
_TRACK_RULES = [
    c.Condition(*_HUMAN, "needs", "extraction", "an interpreter's track has an extraction"),
    c.Condition(*_HUMAN, "forbids", "generatedBy", "an interpreter's track has no generator"),
    c.Condition(*_MADE, "needs", "generatedBy", "a synthesised track has a generator"),
    c.Condition(*_MADE, "forbids", "extraction", "a synthesised track has no extraction"),
]
_CAPTION_RULES = [
    c.Condition("has", "generatedBy", None, "needs", "reviewed", "generated captions say whether they are reviewed"),
    c.Condition("true", "reviewed", None, "needs", "reviewedBy", "a review has a reviewer"),
    c.Condition("has", "reviewedBy", None, "needs", "reviewed", "a reviewer has reviewed"),
    c.Condition("has", "reviewedBy", None, "true", "reviewed", "a reviewer has reviewed"),
]
#: Activity belongs to version 0.2; a missing version counts as the old one.
_TITLE_RULES = [c.Condition("equals", "stmVersion", "0.1", "forbids each", "signLanguage/activity", "activity needs version 0.2")]


URL = c.text(least=1)
_ASSET = {"url": URL, "width": c.number(1), "height": c.number(1), "codec": c.text(among=CODECS)}
_RECT = c.record({"x": c.number(0), "y": c.number(0), "w": c.number(1), "h": c.number(1)}, ["x", "y", "w", "h"])
_EXTRACTION = {
    "method": c.text(among=METHODS),
    "sourceLayout": c.text(among=LAYOUTS),
    "confidence": c.number(0, 1, whole=False),
    "cropRect": _RECT,
    "fillMethod": c.text(among=FILLS),
}
_ACTIVITY = {"intervalMs": c.number(200, 5000), "scale": c.text(among=["title-p95"]), "values": c.listing(c.number(0, 100), least=1)}
_TRACK = {
    "language": c.text(like=SIGN_LANGUAGE),
    "languageLabel": c.text(least=1),
    "provenance": c.text(among=PROVENANCES),
    "extraction": c.record(_EXTRACTION, list(_EXTRACTION)),
    "generatedBy": c.text(least=1),
    "track": c.record(_ASSET | {"syncOffsetMs": c.number()}, [*_ASSET, "syncOffsetMs"]),
    "activity": c.record(_ACTIVITY, list(_ACTIVITY)),
}
_CAPTION = {
    "kind": c.text(among=KINDS),
    "language": c.text(like=LANGUAGE),
    "url": URL,
    "format": c.text(among=["webvtt"]),
    "generatedBy": c.text(least=1),
    "reviewed": c.flag(),
    "reviewedBy": c.text(least=1),
}
_SOURCE = {k: c.text(least=1) for k in ("publisher", "url", "licence", "attribution")} | {"productionCredit": c.text(), "acquisitionRoute": c.text()}
_TITLE = {
    "stmVersion": c.text(among=VERSIONS),
    "id": c.text(like=ID),
    "title": c.text(least=1),
    "durationMs": c.number(0),
    "source": c.record(_SOURCE, ["publisher", "url", "licence", "attribution"]),
    "video": c.record({"main": c.record(_ASSET, list(_ASSET)), "poster": URL}, ["main", "poster"]),
    "signLanguage": c.listing(c.record(_TRACK, ["language", "languageLabel", "provenance", "track"], _TRACK_RULES)),
    "captions": c.listing(c.record(_CAPTION, ["kind", "language", "url", "format"], _CAPTION_RULES)),
}
#: The shape of a title's manifest and of a catalogue.
TITLE_SHAPE = c.record(_TITLE, list(_TITLE), _TITLE_RULES)
_ENTRY = {
    "id": c.text(like=ID),
    "title": c.text(least=1),
    "durationMs": c.number(0),
    "poster": URL,
    "manifestUrl": URL,
    "signLanguages": c.listing(c.text(like=SIGN_LANGUAGE)),
    "confidence": c.number(0, 1, whole=False),
}
CATALOGUE_SHAPE = c.record(
    {"stmVersion": c.text(among=VERSIONS), "titles": c.listing(c.record(_ENTRY, [k for k in _ENTRY if k != "confidence"]))}, ["stmVersion", "titles"]
)


def _repeated(values: Column, i: Column) -> Column:
    return F.array_position(values, F.get(values, i)) <= i


def title_semantics(v: Column) -> Column:
    """Issues of a manifest whose shape is right: repeated tracks and captions, low confidence, large offsets."""
    tracks, captions = (F.try_variant_get(v, f"$.{k}", "array<variant>") for k in ("signLanguage", "captions"))
    of = lambda xs, path, type_: F.transform(xs, lambda x: F.coalesce(F.try_variant_get(x, path, type_), F.lit(None).cast(type_)))

    def judged(x: Column) -> Column:
        at = lambda head, i, *keys: F.array(F.lit(head), i.cast("string"), *map(F.lit, keys))
        by_track = F.transform(
            F.sequence(F.lit(0), F.size(x["languages"]) - 1),
            lambda i: F.concat(
                c.issue_if(_repeated(x["languages"], i), at("signLanguage", i, "language"), "language occurs twice"),
                c.issue_if(F.get(x["confidence"], i) < LEAST_CONFIDENCE, at("signLanguage", i, "extraction", "confidence"), "low confidence", "warning"),
                c.issue_if(F.abs(F.get(x["offset"], i)) > MOST_OFFSET, at("signLanguage", i, "track", "syncOffsetMs"), "large offset", "warning"),
            ),
        )
        by_caption = F.transform(
            F.sequence(F.lit(0), F.size(x["kinds"]) - 1),
            lambda i: c.issue_if(_repeated(x["kinds"], i), at("captions", i), "kind and language occur twice"),
        )
        flat = lambda xs, part: F.when(F.size(xs) > 0, F.flatten(part)).otherwise(c.none())
        return F.concat(flat(x["languages"], by_track), flat(x["kinds"], by_caption))

    members = F.struct(
        of(tracks, "$.language", "string").alias("languages"),
        of(tracks, "$.extraction.confidence", "double").alias("confidence"),
        of(tracks, "$.track.syncOffsetMs", "double").alias("offset"),
        F.transform(captions, lambda x: F.concat_ws(" ", F.try_variant_get(x, "$.kind", "string"), F.try_variant_get(x, "$.language", "string"))).alias("kinds"),
    )
    return let(members, judged)


def catalogue_semantics(v: Column) -> Column:
    """Issues of a catalogue whose shape is right: ids that occur twice."""
    ids = F.transform(F.try_variant_get(v, "$.titles", "array<variant>"), lambda x: F.try_variant_get(x, "$.id", "string"))

    def judged(ids: Column) -> Column:
        at = lambda i: F.array(F.lit("titles"), i.cast("string"), F.lit("id"))
        found = F.transform(F.sequence(F.lit(0), F.size(ids) - 1), lambda i: c.issue_if(_repeated(ids, i), at(i), "id occurs twice"))
        return F.when(F.size(ids) > 0, F.flatten(found)).otherwise(c.none())

    return let(ids, judged)


def _validated(documents: DataFrame, shape: c.Shape, semantics: Callable[[Column], Column]) -> DataFrame:
    """Issues of the shape, and of documents without any those of ``semantics``."""
    root, v = F.array().cast("array<string>"), F.col("v")
    rows = documents.select("doc_id", F.try_parse_json("json").alias("v"))
    early = F.when(v.isNull(), F.array(c.issue(root, "not JSON"))).otherwise(F.coalesce(c.issues("v", shape), c.none()))
    found = let(early, lambda x: F.array_sort(F.when(F.size(x) > 0, x).otherwise(semantics(v))))
    rows = rows.select("doc_id", F.posexplode(found).alias("nth", "i"))
    path = F.when(F.size("i.at") == 0, "$").otherwise(F.array_join("i.at", "/"))
    return rows.select("doc_id", "nth", path.alias("path"), "i.message", "i.severity")


def validate(documents: DataFrame) -> DataFrame:
    """(doc_id, nth, path, message, severity) of ``documents(doc_id, json)``, manifests of titles.

    Issues of the shape come in the order of their paths; documents whose shape is right are asked for
    more (:func:`title_semantics`).  A text that isn't JSON, and a null one, is one issue at ``$``.
    """
    return _validated(documents, TITLE_SHAPE, title_semantics)


def validate_catalogues(documents: DataFrame) -> DataFrame:
    """As :func:`validate`, of catalogues."""
    return _validated(documents, CATALOGUE_SHAPE, catalogue_semantics)


def validity(documents: DataFrame, issues: DataFrame, strict: bool = False) -> DataFrame:
    """(doc_id, errors, warnings, valid) of every document."""
    n = issues.groupBy("doc_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    rows = documents.select("doc_id").join(n, "doc_id", "left").na.fill(0, ["errors", "warnings"])
    return rows.withColumn("valid", (F.col("errors") == 0) & ((F.col("warnings") == 0) if strict else F.lit(True)))


def build_manifests(titles: DataFrame, tracks: DataFrame, captions: DataFrame | None = None, version: str = "0.2") -> DataFrame:
    """(title_id, json) of ``titles(title_id, id, title, durationMs, source, video)`` with ``tracks(title_id, nth, track)``
    and ``captions(title_id, nth, caption)`` in the order of nth; members without a value are left out.
    """
    in_order = lambda df, c: df.groupBy("title_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("nth", c))), lambda x: x[c]).alias(f"{c}s")
    )
    rows = titles.join(in_order(tracks, "track"), "title_id", "left")
    rows = rows.join(in_order(captions, "caption"), "title_id", "left") if captions is not None else rows.withColumn("captions", F.array())
    members = [F.lit(version).alias("stmVersion"), "id", "title", "durationMs", "source", "video", F.coalesce("tracks", F.array()).alias("signLanguage")]
    return rows.select("title_id", F.to_json(F.struct(*members, F.coalesce("captions", F.array()).alias("captions"))).alias("json"))


def catalogue_entries(manifests: DataFrame, base: str = "") -> DataFrame:
    """One index row a manifest ``(title_id, m, manifest_url)``; confidence is the least extraction's."""
    confidence = F.array_min(F.transform(F.filter("m.signLanguage", lambda t: t["extraction"].isNotNull()), lambda t: t["extraction"]["confidence"]))
    link = lambda u: absolute_url(u, base) if base else u
    return manifests.select(
        F.col("m.id").alias("id"),
        F.col("m.title").alias("title"),
        F.col("m.durationMs").alias("duration_ms"),
        link(F.col("m.video.poster")).alias("poster"),
        link(F.col("manifest_url")).alias("manifest_url"),
        F.array_distinct(F.transform("m.signLanguage", lambda t: t["language"])).alias("sign_languages"),
        F.bround(confidence, 4).alias("confidence"),
    )


ENTRY = "struct<id:string,title:string,durationMs:int,poster:string,manifestUrl:string,signLanguages:array<string>,confidence:double>"


def manifest_text(m: Column) -> Column:
    """The file of a typed manifest."""
    return json_document(m, _type(TITLE))


def catalogue_documents(entries: DataFrame, key: str, version: str = VERSIONS[-1]) -> DataFrame:
    """(key, json): the file of each catalogue, its ``entries`` (see :func:`catalogue_entries`) in the order of their ids."""
    entry = F.struct(
        "id", "title", F.col("duration_ms").alias("durationMs"), "poster", F.col("manifest_url").alias("manifestUrl"),
        F.col("sign_languages").alias("signLanguages"), "confidence",
    ).cast(ENTRY)
    titles = F.array_sort(F.collect_list(entry))
    whole = F.struct(F.lit(version).alias("stmVersion"), titles.alias("titles"))
    kind = _type(f"struct<stmVersion:string,titles:array<{ENTRY}>>")
    return entries.groupBy(key).agg(whole.alias("c")).select(key, json_document(F.col("c"), kind).alias("json"))


def _type(ddl: str) -> T.DataType:
    return T.DataType.fromDDL(ddl)


def absolutise(manifests: DataFrame, base: str) -> DataFrame:
    """Manifests with their media, poster, track and caption URLs under ``base``."""
    m = F.col("m")
    video = m["video"].withField("main.url", absolute_url(m["video"]["main"]["url"], base)).withField("poster", absolute_url(m["video"]["poster"], base))
    tracks = F.transform(m["signLanguage"], lambda t: t.withField("track.url", absolute_url(t["track"]["url"], base)))
    captions = F.transform(m["captions"], lambda x: x.withField("url", absolute_url(x["url"], base)))
    return manifests.withColumn("m", m.withField("video", video).withField("signLanguage", tracks).withField("captions", captions))


#: Content types by suffix (fixed values).
CONTENT_TYPES = {
    ".mp4": "video/mp4",
    ".m4v": "video/mp4",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
    ".vtt": "text/vtt",
    ".srt": "application/x-subrip",
    ".json": "application/json",
    ".m3u8": "application/vnd.apple.mpegurl",
}


def content_type(path: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))), F.lit("application/octet-stream"))


def upload_plan(files: DataFrame, prefix: str = "") -> DataFrame:
    """``files(title_id, rel_path)`` to (title_id, key, content_type, position), analysis caches left out."""
    rows = files.where(~F.col("rel_path").rlike(r"(^|/)analysis\.json$"))
    key = F.concat(F.lit(prefix), F.col("title_id").cast("string"), F.lit("/"), F.col("rel_path"))
    order = Window.partitionBy("title_id").orderBy("rel_path")
    return rows.select("title_id", key.alias("key"), content_type(F.col("rel_path")).alias("content_type"), F.row_number().over(order).alias("position"))


def generated_caption(kind: Column, language: Column, url: Column, generator: Column) -> Column:
    """A machine-made caption: its generator must be named, and it is never reviewed."""
    named = F.when(F.trim(generator) != "", generator).otherwise(F.raise_error(F.lit("a generated caption names its generator")))
    return F.struct(
        kind.alias("kind"), language.alias("language"), url.alias("url"), F.lit("webvtt").alias("format"), named.alias("generatedBy"),
        F.lit(False).alias("reviewed"), F.lit(None).cast("string").alias("reviewedBy"),
    )


def mark_reviewed(caption: Column, reviewer: str) -> Column:
    if not reviewer.strip():
        raise ValueError("a review needs a reviewer's name")
    return caption.withField("reviewed", F.lit(True)).withField("reviewedBy", F.lit(reviewer))
