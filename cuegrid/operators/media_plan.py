"""Plans of external encoder calls as argument lists; nothing is run here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuegrid.functions.geometry import even, inset_rect

def _encoder(crf: int, preset: str = "medium") -> list[str]:
    return ["-c:v", "libx264", "-preset", preset, "-crf", str(crf), "-pix_fmt", "yuv420p"]


FAST_START = ["-movflags", "+faststart"]


def _argv(*parts: list[str] | Column) -> Column:
    """One argument list of literal lists and single arguments."""
    return F.concat(*[F.array(*map(F.lit, p)) if isinstance(p, list) else F.array(p) for p in parts])


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def crop_filter(r: Column, max_height: int = 540) -> Column:
    cut = _text("crop=", even(r["w"]), ":", even(r["h"]), ":", r["x"], ":", r["y"])
    return F.when(r["h"] > max_height, F.concat(cut, F.lit(f",scale=-2:{max_height - max_height % 2}"))).otherwise(cut)


def crop_argv(src: Column, r: Column, dst: Column, max_height: int = 540, crf: int = 23, keep_audio: bool = False) -> Column:
    """The call that cuts a rectangle out of a video, with its sound re-encoded or left out."""
    sound = ["-c:a", "aac", "-b:a", "96k"] if keep_audio else ["-an"]
    return _argv(["-i"], src, ["-vf"], crop_filter(r, max_height), [*_encoder(crf), *FAST_START, *sound], dst)


def fill_graph(r: Column, method: Column, frame_w: Column, frame_h: Column, sigma: float = 6.0) -> Column:
    """The filter graph that patches a rectangle; null for ``none``.

    Interpolation takes the rectangle out before its patch is softened; blurring alone softens three
    times as much, in place.
    """
    safe = inset_rect(r, frame_w, frame_h)
    logo = _text("delogo=x=", safe["x"], ":y=", safe["y"], ":w=", safe["w"], ":h=", safe["h"], ",")
    cut = _text("crop=", safe["w"], ":", safe["h"], ":", safe["x"], ":", safe["y"])
    lay = _text("overlay=", safe["x"], ":", safe["y"])
    graph = lambda first, blur: _text("[0:v]", first, "split[whole][part];[part]", cut, f",gblur=sigma={blur:.1f}[patch];[whole][patch]", lay, "[v]")
    return F.when(method == "interpolated-surround", graph(logo, sigma)).when(method == "blurred-surround", graph("", sigma * 3))


def fill_argv(src: Column, r: Column, method: Column, frame_w: Column, frame_h: Column, dst: Column, crf: int = 20) -> Column:
    """The call that patches a video; with method ``none`` the streams are copied as they are."""
    copied = _argv(["-i"], src, ["-c", "copy", *FAST_START], dst)
    graph = fill_graph(r, method, frame_w, frame_h)
    patched = _argv(["-i"], src, ["-filter_complex"], graph, ["-map", "[v]", "-map", "0:a?", *_encoder(crf), "-c:a", "copy", *FAST_START], dst)
    return F.when(graph.isNull(), copied).otherwise(patched)


def crop_away_argv(src: Column, keep: Column, dst: Column, crf: int = 20) -> Column:
    """The call that leaves only a rectangle of a video, in its own size."""
    cut = _text("crop=", even(keep["w"]), ":", even(keep["h"]), ":", keep["x"], ":", keep["y"])
    return _argv(["-i"], src, ["-vf"], cut, [*_encoder(crf), "-c:a", "copy", *FAST_START], dst)


def poster_argv(src: Column, at_s: Column, dst: Column) -> Column:
    """The call that writes one frame as an image."""
    return _argv(["-ss"], F.format_string("%.3f", F.bround(at_s, 3)), ["-i"], src, ["-frames:v", "1", "-q:v", "2"], dst)


def drawbox_argv(src: Column, boxes: Column, dst: Column) -> Column:
    """The call that draws outlines ``array<struct<rect, colour, thickness>>``; null for none."""
    r = lambda b: b["rect"]
    one = lambda b: _text("drawbox=x=", r(b)["x"], ":y=", r(b)["y"], ":w=", r(b)["w"], ":h=", r(b)["h"], ":color=", b["colour"], "@1:t=", b["thickness"])
    call = _argv(["-i"], src, ["-vf"], F.array_join(F.transform(boxes, one), ","), [*_encoder(23, "veryfast"), "-c:a", "copy"], dst)
    return F.when(F.size(boxes) > 0, call)
