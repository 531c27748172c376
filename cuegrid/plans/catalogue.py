"""All registered queries of the library, each beside its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuegrid.functions import geometry as g
from cuegrid.functions import text as tx
from cuegrid.functions.numbers import half_up
from cuegrid.operators import activity, align, analysis, captions, decide, detections, harness, manifests, media_plan, pixels, reports, transcript
from cuegrid.plans import adapters as ad
from cuegrid.sources import listing, lists

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def _track(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ad.samples(spark, sf_dir)
    return activity.normalise(activity.bucket_values(s, ad.media(s), ad.DAY))


# Activity -----------------------------------------------------------------------------------------


@register(f"with {ad.TRACK} select title_id, bucket, round(value, 6) as value, round(top, 6) as top, level from track")
def activity_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _track(spark, sf_dir).select("title_id", "bucket", half_up("value", 6).alias("value"), half_up("top", 6).alias("top"), "level")


@register(f"with {ad.TRACK} select title_id, round(avg(case when level < 20 then 1.0 else 0.0 end), 6) as idle from track group by 1")
def activity_idle_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.idle_fraction(_track(spark, sf_dir)).withColumn("idle", F.round("idle", 6))


@register(
    f"with {ad.TRACK}, p as (select event_id, user_id as title_id, (event_id % 4000) * 1000000 - 5000000 as position_ms from events) "
    f"select p.title_id, p.position_ms, t.bucket, t.level from p join track t on t.title_id = p.title_id and "
    f"t.bucket = least(greatest(floor(p.position_ms / {ad.DAY * 1000}), 0), {ad.DAYS - 1})"
)
def activity_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ad.table(spark, sf_dir, "events")
    p = e.select(F.col("user_id").alias("title_id"), (F.col("event_id") % 4000 * 1_000_000 - 5_000_000).alias("position_ms"))
    return activity.level_at(_track(spark, sf_dir), p, ad.DAY * 1000)


@register(
    f"with {ad.TRACK}, c as (select title_id, cast(floor(((bucket + 1) * 12 - 1) / {ad.DAYS}) as int) as col, avg(level) as mean from track group by 1, 2) "
    "select title_id, col as \"column\", round(mean, 6) as mean, substr(' ▁▂▃▄▅▆▇█', cast(round_even(mean / 100 * 8, 0) as int) + 1, 1) as glyph from c"
)
def activity_sparkline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.sparkline_columns(_track(spark, sf_dir), 12).withColumn("mean", F.round("mean", 6))


@register("select event_id, user_id from events where event_id % 5 = 0")
def frame_stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections.sample_frames(ad.table(spark, sf_dir, "events"), 5, "event_id").select("event_id", "user_id")


# Detections ---------------------------------------------------------------------------------------

W, H = ad.FRAME
def _features_sql(tables: str, w: int, h: int) -> str:
    """Features of clusters named by box_no, of the tables detections and frames."""
    return f"""{tables},
n as (select title_id, count(*) as n_frames from frames group by 1),
b as (select d.title_id, box_no as cluster_id, count(*) as n_boxes, stddev_pop((x1 + x2) / 2) as sx, stddev_pop((y1 + y2) / 2) as sy,
  median(x2 - x1) as w, avg(d.motion) as bm, avg(f.frame_motion) as fm from detections d join frames f using (title_id, frame_idx) group by 1, 2),
f0 as (select b.title_id, cluster_id, n_boxes, n_boxes / n_frames as persistence,
  case when n_boxes > 1 then sqrt(sx * sx + sy * sy) / sqrt({w}.0 * {w} + {h}.0 * {h}) else 0.0 end as centre_std, w / {w} as size_frac,
  bm / greatest(fm, 0.001) as motion_ratio from b join n using (title_id)),
f1 as (select *, least(greatest(1 - (centre_std - 0.01) / 0.05, 0), 1) as stability, least(greatest(1 - size_frac / 0.45, 0), 1) as size_score,
  coalesce(least(greatest(motion_ratio / 3, 0), 1), 0) as motion_score from f0),
features as (select *, 0.4 * motion_score + 0.25 * persistence + 0.25 * stability + 0.1 * size_score as score,
  least(greatest(0.4 * persistence + 0.3 * stability + 0.3 * motion_score, 0), 1) as confidence,
  persistence >= 0.5 and size_frac <= 0.45 as eligible from f1)"""


_FEATURES = _features_sql(ad.DETECTIONS, W, H)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = ad.detections(spark, sf_dir)
    clustered = d.drop("frame_motion").withColumn("cluster_id", F.col("box_no"))
    return detections.cluster_features(clustered, ad.frames(d), W, H)


_NUMBERS = ("persistence", "centre_std", "size_frac", "motion_ratio", "stability", "motion_score", "score", "confidence")


@register(f"with {_FEATURES} select title_id, cluster_id, n_boxes, {', '.join(f'round({c}, 6) as {c}' for c in _NUMBERS)}, eligible from features")
def cluster_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _features(spark, sf_dir)
    return f.select("title_id", "cluster_id", "n_boxes", *(half_up(c, 6).alias(c) for c in _NUMBERS), "eligible")


@register(
    f"with {_FEATURES} select title_id, case when eligible then cluster_id end as cluster_id, case when eligible then round(confidence, 6) end as confidence, "
    "case when not eligible then 'no eligible person' end as error from (select *, row_number() over (partition by title_id "
    "order by eligible desc, round(score, 9) desc, cluster_id) as rank from features) where rank = 1"
)
def signer_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _features(spark, sf_dir).withColumn("score", half_up("score", 9))
    return detections.choose_signer(f).withColumn("confidence", half_up("confidence", 6))


def _rect_sql(w: int, h: int) -> str:
    """The constant rectangle of the table detections."""
    return f"""edges as (select title_id, quantile_cont(x1, 0.05) as x1, quantile_cont(y1, 0.05) as y1, quantile_cont(x2, 0.95) as x2, quantile_cont(y2, 0.95) as y2 from detections group by 1),
p as (select title_id, cast(floor(x1 - greatest(x2 - x1, 1) * 0.08) as int) as xa, cast(floor(y1 - greatest(y2 - y1, 1) * 0.08) as int) as ya,
  least({w}, cast(ceil(x2 + greatest(x2 - x1, 1) * 0.08) as int)) as xb, least({h}, cast(ceil(y2 + greatest(y2 - y1, 1) * 0.08) as int)) as yb from edges),
q as (select title_id, greatest(xa - ((xa % 2) + 2) % 2, 0) as x, greatest(ya - ((ya % 2) + 2) % 2, 0) as y, xb, yb from p),
s as (select title_id, x, y, greatest((xb - x) - (((xb - x) % 2) + 2) % 2, 2) as w, greatest((yb - y) - (((yb - y) % 2) + 2) % 2, 2) as h from q),
rects as (select title_id, x, y, greatest(case when x + w > {w} then ({w} - x) - (({w} - x) % 2) else w end, 2) as w,
  greatest(case when y + h > {h} then ({h} - y) - (({h} - y) % 2) else h end, 2) as h from s)"""


_RECT = f"{ad.DETECTIONS}, {_rect_sql(W, H)}"


def _rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections.fixed_rect(ad.detections(spark, sf_dir), W, H)


@register(f"with {_RECT} select title_id, x, y, w, h from rects")
def fixed_crop_rect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rects(spark, sf_dir).select("title_id", "rect.x", "rect.y", "rect.w", "rect.h")


_PART = f"""r as (select p_partkey as k, p_partkey % {W - 80} as x, p_size * 4 as y, 2 + p_partkey % 77 as w, 3 + p_size as h from part)"""


def _part_rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    return ad.table(spark, sf_dir, "part").select(k.alias("k"), g.rect(k % (W - 80), s * 4, k % 77 + 2, s + 3).alias("r"))


def _even_sql(e: str) -> str:
    return f"(({e}) - ((({e}) % 2) + 2) % 2)"


_PADX, _PADY = _even_sql("x - cast(ceil(w * 0.03) as int)"), _even_sql("y - cast(ceil(h * 0.03) as int)")


@register(
    f"""with {_PART}, a as (select *, greatest({_PADX}, 0) as px, greatest({_PADY}, 0) as py, least({W}, x + w + cast(ceil(w * 0.03) as int)) as px2,
    least({H}, y + h + cast(ceil(h * 0.03) as int)) as py2, {_even_sql("cast(floor(x * 1.5) as int)")} as sx, {_even_sql("cast(floor(y * 1.5) as int)")} as sy,
    least({W * 2}, cast(ceil((x + w) * 1.5) as int)) as sx2, least({H * 2}, cast(ceil((y + h) * 1.5) as int)) as sy2 from r)
    select k, px, py, greatest({_even_sql("px2 - px")}, 2) as pw, greatest({_even_sql("py2 - py")}, 2) as ph,
    sx, sy, greatest({_even_sql("sx2 - sx")}, 2) as sw, greatest({_even_sql("sy2 - sy")}, 2) as sh,
    greatest(x, 2) as ix, greatest(y, 2) as iy, greatest(least(x + w, {W - 2}) - greatest(x, 2), 1) as iw, greatest(least(y + h, {H - 2}) - greatest(y, 2), 1) as ih from a"""
)
def rect_pad_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, w, h = F.col("r"), F.lit(W), F.lit(H)
    made = {"p": g.pad_rect(r, 0.03, w, h), "s": g.scale_rect(r, 1.5, w * 2, h * 2), "i": g.inset_rect(r, w, h)}
    rows = _part_rects(spark, sf_dir).withColumns(made)
    return rows.select("k", *(F.col(f"{c}.{d}").alias(c + d) for c in made for d in "xywh"))


@register(
    f"""with {_PART}, a as (select *, x + 5 as ox, y + 2 as oy, w + 1 as ow, h as oh, greatest(2, w // 4) as dx, greatest(2, h // 4) as dy from r),
    b as (select *, greatest(0, least(x + w, ox + ow) - greatest(x, ox)) * greatest(0, least(y + h, oy + oh) - greatest(y, oy)) as common from a)
    select k, x + w as far, y + h as low, w * h as area, common as shared, round(common / (w * h + ow * oh - common), 6) as iou,
    greatest(0, x - dx) as rx, greatest(0, y - dy) as ry, greatest(1, least({W}, x + w + dx) - greatest(0, x - dx)) as rw, greatest(1, least({H}, y + h + dy) - greatest(0, y - dy)) as rh,
    case when k % 2 = 0 then x + w else 0 end as mx, case when k % 2 = 0 then {W} - x - w else x end as mw,
    cast(round_even((x + 0.25) * 1.5, 0) as int) as bx, greatest(1, cast(round_even(w * 1.5, 0) as int)) as bw from b"""
)
def rect_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges, areas, overlap with a shifted rectangle, surroundings, what a panel leaves, and boxes as rectangles."""
    r, w, h = F.col("r"), F.lit(W), F.lit(H)
    other = g.rect(r["x"] + 5, r["y"] + 2, r["w"] + 1, r["h"])
    box = F.struct(*((r[a] + 0.25 + (r[b] if b else 0)).alias(n) for n, a, b in (("x1", "x", None), ("y1", "y", None), ("x2", "x", "w"), ("y2", "y", "h"))))
    rows = _part_rects(spark, sf_dir).withColumns(
        {"ring": g.ring(r, w, h), "main": g.panel_complement(r, F.when(F.col("k") % 2 == 0, "left").otherwise("right"), w, h), "box": g.box_to_rect(box, 1.5)}
    )
    return rows.select(
        "k", g.right(r).alias("far"), g.bottom(r).alias("low"), g.area(r).alias("area"), g.overlap(r, other).alias("shared"), F.round(g.iou(r, other), 6).alias("iou"),
        *(F.col(f"ring.{c}").alias(f"r{c}") for c in "xywh"), F.col("main.x").alias("mx"), F.col("main.w").alias("mw"), F.col("box.x").alias("bx"), F.col("box.w").alias("bw"),
    )


# Anchors over the grids of a 64-pixel image: 8x8 cells of 8, 4x4 of 16, 2x2 of 32.
_ANCHORS = """a as (select cast(label as bigint) as title_id, vec_id as frame_idx, vec_id % 90 as anchor, list_transform(embedding[1:6], lambda v: cast(v as double)) as p from embeddings),
cells as (select *, case when anchor < 64 then 8 when anchor < 80 then 16 else 32 end as stride, case when anchor < 64 then anchor when anchor < 80 then anchor - 64 else anchor - 80 end as cell from a where anchor < 84),
centres as (select title_id, frame_idx, anchor, (p[1] + cell % (64 // stride)) * stride as cx, (p[2] + cell // (64 // stride)) * stride as cy, exp(p[3]) * stride as w, exp(p[4]) * stride as h, p[5] * p[6] as score from cells),
found as (select title_id, frame_idx, anchor as box_no, least(greatest((cx - w / 2) / 0.5, 0), 120) as x1, least(greatest((cy - h / 2) / 0.5, 0), 100) as y1,
  least(greatest((cx + w / 2) / 0.5, 0), 120) as x2, least(greatest((cy + h / 2) / 0.5, 0), 100) as y2, score from centres where score > 0.01)"""


@register(
    f"with {_ANCHORS} select title_id, frame_idx, box_no, round(x1, 4) as x1, round(y1, 4) as y1, round(x2, 4) as x2, round(y2, 4) as y2, round(score, 6) as score from found where x2 - x1 >= 2 and y2 - y1 >= 2"
)
def anchor_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw predictions (an embedding's first six numbers each) to boxes of a 120 by 100 frame at half size."""
    e = ad.table(spark, sf_dir, "embeddings")
    anchors = e.select(F.col("label").cast("long").alias("title_id"), F.col("vec_id").alias("frame_idx"), (F.col("vec_id") % 90).alias("anchor"), F.slice("embedding", 1, 6).alias("p"))
    boxes = detections.boxes_of(detections.decode_anchors(anchors, 64), 0.5, 120, 100, 0.01)
    return boxes.select("title_id", "frame_idx", "box_no", *(F.round(c, 4).alias(c) for c in ("x1", "y1", "x2", "y2")), F.round("score", 6).alias("score"))


_IOU = "greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0)"


@register(
    f"""with {ad.DETECTIONS}, p as (select a.title_id, a.frame_idx, a.box_no as a, b.box_no as b, {_IOU} as o,
    (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) as t from detections a join detections b
    on a.title_id = b.title_id and a.frame_idx = b.frame_idx and a.box_no < b.box_no)
    select title_id, frame_idx, a, b, round(o / (t - o), 6) as iou from p where o / (t - o) >= 0.3"""
)
def pairwise_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections.iou_candidates(ad.detections(spark, sf_dir)).withColumn("iou", F.round("iou", 6))


@register(
    f"with {_PART} select a.k as outer_k, b.k as inner_k from r a join r b on b.k = a.k + 1 "
    "where b.x >= a.x and b.y >= a.y and b.x + b.w <= a.x + a.w + 1 and b.y + b.h <= a.y + a.h + 40"
)
def rect_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _part_rects(spark, sf_dir)
    a = r.select(F.col("k").alias("outer_k"), g.rect(F.col("r.x"), F.col("r.y"), F.col("r.w") + 1, F.col("r.h") + 40).alias("o"))
    b = r.select(F.col("k").alias("inner_k"), F.col("r").alias("i"))
    return a.join(b, F.col("inner_k") == F.col("outer_k") + 1).where(g.contains(F.col("o"), F.col("i"))).select("outer_k", "inner_k")


_SHAPES = f"""shapes as (select p_partkey as title_id, (p_partkey * 37) % {W - 20} as x, least(20 + p_partkey % 77, {W} - (p_partkey * 37) % {W - 20}) as w, p_size * 8 as h from part)"""


@register(
    f"with {_RECT}, c as (select title_id, x, w, x <= 16 as l, x + w >= {W - 16} as r, h >= 0.85 * {H} as tall from rects) "
    "select title_id, case when (l or r) and tall then 'side-panel' else 'corner-inset' end as kind, "
    f"case when (l or r) and tall then case when l then 'left' else 'right' end end as edge, case when (l or r) and tall then case when l then x + w else {W} - x end end as panel_w from c"
)
def layout_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layouts of the titles' constant rectangles, from all their detections."""
    return pixels.classify_layout(_rects(spark, sf_dir), None, W, H).select("title_id", "kind", "edge", F.col("panel.w").alias("panel_w"))


@register(
    f"with {_SHAPES}, c as (select title_id, x, w, x <= 16 as l, x + w >= {W - 16} as r, h >= 0.85 * {H} as tall from shapes) "
    "select title_id, case when (l or r) and tall then 'side-panel' else 'corner-inset' end as kind, "
    f"case when (l or r) and tall then case when l then 'left' else 'right' end end as edge, case when (l or r) and tall then case when l then x + w else {W} - x end end as panel_w from c"
)
def layout_of_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles of many places and heights; what is above and below them isn't known."""
    k, s = F.col("p_partkey"), F.col("p_size")
    x = (k * 37 % (W - 20)).cast("int")
    shapes = ad.table(spark, sf_dir, "part").select(k.alias("title_id"), g.rect(x, F.lit(0), F.least((k % 77 + 20).cast("int"), W - x), s * 8).alias("rect"))
    return pixels.classify_layout(shapes, None, W, H).select("title_id", "kind", "edge", F.col("panel.w").alias("panel_w"))


@register()
def track_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy tracking (sequential within a title): held against a plain twin in the tests."""
    return detections.cluster_detections(ad.detections(spark, sf_dir)).select("title_id", "frame_idx", "box_no", "cluster_id")


@register()
def nms_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy suppression: held against a plain twin in the tests."""
    d = ad.detections(spark, sf_dir).withColumn("score", F.col("motion") / 100)
    return detections.suppress_overlaps(d).select("title_id", "frame_idx", "box_no", F.round("score", 6).alias("score"))


# Pixels -------------------------------------------------------------------------------------------


@register(
    f"with {ad.GREY} select title_id, y, x, round(avg(v), 6) as mean_grey, round(coalesce(var_samp(v), 0), 6) as temporal_var, count(*) as frames from grey group by 1, 2, 3"
)
def pixel_welford(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = pixels.pixel_stats(ad.grey(spark, sf_dir))
    return s.select("title_id", "y", "x", F.round("mean_grey", 6).alias("mean_grey"), F.round("temporal_var", 6).alias("temporal_var"), "frames")


_DIFF = f"{ad.GREY}, diffs as (select *, abs(v - lag(v) over (partition by title_id, y, x order by frame_idx)) as diff from grey)"


@register(f"with {_DIFF} select title_id, frame_idx, round(avg(diff), 6) as motion from diffs group by 1, 2")
def frame_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.frame_motion(ad.grey(spark, sf_dir)).withColumn("motion", F.round("motion", 6))


@register(
    f"with {_DIFF} select title_id, frame_idx, cast(1 as bigint) as box_no, round(avg(diff) filter (y >= 1 and y < 5 and x >= 2 and x < 7), 6) as motion from diffs group by 1, 2"
)
def box_motion_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = ad.grey(spark, sf_dir)
    boxes = px.select("title_id", "frame_idx").distinct().select(
        "title_id", "frame_idx", F.lit(1).cast("long").alias("box_no"), *(F.lit(v).alias(c) for c, v in (("x1", 2.2), ("y1", 1.4), ("x2", 6.1), ("y2", 7.4)))
    )
    return pixels.box_motion(px, boxes).withColumn("motion", F.round("motion", 6))


_STATS = f"{ad.GREY}, stats as (select title_id, y, x, avg(v) as mean_grey, coalesce(var_samp(v), 0) as temporal_var from grey group by 1, 2, 3)"


@register(
    f"with {_STATS}, b as (select unnest(range(5)) as band) select title_id, cast(band as int) as band, round(avg(temporal_var) filter (x >= band and x < band + 2), 5) as variance, "
    "round(avg(mean_grey) filter (x >= band and x < band + 2), 6) as grey from stats, b group by 1, 2"
)
def band_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = pixels.pixel_stats(ad.grey(spark, sf_dir))
    bands = s.select("title_id").distinct().select("title_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("band"))
    bands = bands.select("title_id", "band", F.col("band").alias("x"), F.lit(0).alias("y"), F.lit(2).alias("w"), F.lit(8).alias("h"))
    return pixels.band_stats(s, bands).select("title_id", "band", F.round("variance", 5).alias("variance"), F.round("grey", 6).alias("grey"))


@register(
    f"""with {ad.GREY}, s as (select title_id, y, x, sum(v) as v from grey group by 1, 2, 3),
    t as (select * from (values (-1,-1,-1,-1),(-1,0,-2,0),(-1,1,-1,1),(0,-1,0,-2),(0,1,0,2),(1,-1,1,-1),(1,0,2,0),(1,1,1,1)) t(dx, dy, gx, gy)),
    n as (select s.title_id, s.x, s.y, gx, gy, case when x + dx < 0 then -(x + dx) when x + dx > 7 then 14 - x - dx else x + dx end as fx,
    case when y + dy < 0 then -(y + dy) when y + dy > 7 then 14 - y - dy else y + dy end as fy from s, t)
    select n.title_id, n.x, n.y, round(sqrt(sum(gx * f.v) ** 2 + sum(gy * f.v) ** 2), 4) as gradient from n join s f on f.title_id = n.title_id and f.x = n.fx and f.y = n.fy group by 1, 2, 3"""
)
def sobel_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ad.grey(spark, sf_dir).groupBy("title_id", "y", "x").agg(F.sum("v").alias("mean_grey"))
    return pixels.sobel_detail(s).withColumn("gradient", F.round("gradient", 4))


# A rectangle of 8x8 frames: at the left edge of odd titles, 2 pixels in on even ones.
_SMALL = "(case when title_id % 2 = 0 then 2 else 0 end)"
_STILL = f"{ad.GREY}, stats as (select title_id, y, x, avg(v) as mean_grey, coalesce(var_samp(v), 0) / 200 as temporal_var from grey group by 1, 2, 3)"
_STRIP = f"""{_STILL}, strips as (select title_id, avg(temporal_var) as variance, stddev_pop(mean_grey) as spread from stats
  where title_id % 2 = 1 and x < 3 and (y < 2 or y >= 6) group by 1),
layouts as (select t.title_id, coalesce(t.title_id % 2 = 1 and variance <= 40 and spread <= 12, false) as side from (select distinct title_id from stats) t left join strips using (title_id))"""


def _still(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Statistics of 8x8 frames and a rectangle a title."""
    s = pixels.pixel_stats(ad.grey(spark, sf_dir)).withColumn("temporal_var", F.col("temporal_var") / 200)
    x = F.when(F.col("title_id") % 2 == 0, 2).otherwise(0)
    return s, s.select("title_id").distinct().select("title_id", g.rect(x, F.lit(2), F.lit(3), F.lit(4)).alias("rect"))


@register(f"with {_STRIP} select title_id, case when side then 'side-panel' else 'corner-inset' end as kind, case when side then 'left' end as edge from layouts")
def layout_of_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, rects = _still(spark, sf_dir)
    return pixels.classify_layout(rects, s, 8, 8).select("title_id", "kind", "edge")


# The ring is 2 wider on every side, within the frame: x from max(0, x - 2) to min(8, x + 5), y from 0 to 8.
_RING = f"""{_STILL}, ring as (select title_id, x - greatest(0, {_SMALL} - 2) as x, y, least(8, {_SMALL} + 5) - greatest(0, {_SMALL} - 2) as w, mean_grey, temporal_var,
  not (x >= {_SMALL} and x < {_SMALL} + 3 and y >= 2 and y < 6) as outside from stats where x >= greatest(0, {_SMALL} - 2) and x < least(8, {_SMALL} + 5)),
taps as (select * from (values (-1,-1,-1,-1),(-1,0,-2,0),(-1,1,-1,1),(0,-1,0,-2),(0,1,0,2),(1,-1,1,-1),(1,0,2,0),(1,1,1,1)) t(dx, dy, gx, gy)),
near as (select r.title_id, r.x, r.y, gx, gy, case when x + dx < 0 then -(x + dx) when x + dx >= w then 2 * w - 2 - x - dx else x + dx end as fx,
  case when y + dy < 0 then -(y + dy) when y + dy > 7 then 14 - y - dy else y + dy end as fy from ring r, taps where outside),
steep as (select n.title_id, n.x, n.y, sqrt(sum(gx * f.mean_grey) ** 2 + sum(gy * f.mean_grey) ** 2) as gradient from near n join ring f on f.title_id = n.title_id and f.x = n.fx and f.y = n.fy group by 1, 2, 3),
background as (select title_id, avg(gradient) as detail, avg(temporal_var) as motion from steep join ring using (title_id, x, y) group by 1),
hard as (select *, 0.6 * least(greatest((detail - 12) / 24, 0), 1) + 0.4 * least(greatest((motion - 8) / 52, 0), 1) as difficulty from background)"""


@register(f"with {_RING} select title_id, round(detail, 4) as detail, round(motion, 4) as motion, round(difficulty, 4) as difficulty from hard")
def background_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, rects = _still(spark, sf_dir)
    b = pixels.measure_background(rects, s, 8, 8)
    return b.select("title_id", *(F.round(c, 4).alias(c) for c in ("detail", "motion", "difficulty")))


@register(
    f"with {_RING}, {_STRIP[len(_STILL) + 2 :]}, d as (select title_id, title_id % 9 = 0 as broken, side, (title_id % 10) / 10.0 as confidence, case when side then 0.0 else difficulty end as difficulty from hard join layouts using (title_id)), "
    "v as (select title_id, case when not broken then round(difficulty, 4) end as difficulty, case when broken then 'unusable' when side then 'excellent' when confidence < 0.7 then 'marginal' when difficulty < 0.35 then 'good' "
    "when difficulty < 0.65 then 'marginal' else 'poor' end as verdict from d) select title_id, verdict, difficulty, list_position(['excellent', 'good', 'marginal', 'poor', 'unusable'], verdict) as rank from v"
)
def triage_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Background, layout and confidence of a rectangle a title to a verdict; every ninth title failed."""
    s, rects = _still(spark, sf_dir)
    clips = pixels.measure_background(rects, s, 8, 8).join(pixels.classify_layout(rects, s, 8, 8), "title_id")
    k = F.col("title_id")
    clips = clips.select(k.alias("clip"), F.when(k % 9 == 0, "unreadable").alias("error"), F.col("kind").alias("layout"), (k % 10 / 10).alias("confidence"), "detail", "motion")
    return harness.triage(clips).select(F.col("clip").alias("title_id"), "verdict", F.round("difficulty", 4).alias("difficulty"), "rank")


def _videos(frames: DataFrame) -> DataFrame:
    return frames.select("title_id").distinct().select("title_id", F.lit(ad.SIDE * 20).alias("width"), F.lit(ad.SIDE * 20).alias("height"))


_DECIDED = f"""{_features_sql(ad.SCENES_SQL, ad.SIDE, ad.SIDE)},
best as (select *, row_number() over (partition by title_id order by eligible desc, round(score, 9) desc, cluster_id) as rank from features),
chosen as (select t.title_id, case when eligible then cluster_id end as cluster_id, case when eligible then confidence end as confidence,
  case when cluster_id is null then 'no person' when not eligible then 'no eligible person' end as error
  from (select distinct title_id from e) t left join best on best.title_id = t.title_id and rank = 1),
own as (select d.* from detections d join chosen c on c.title_id = d.title_id and c.cluster_id = d.box_no)"""
_STILL_RECT = f"""{_DECIDED}, {_rect_sql(ad.SIDE, ad.SIDE).replace('from detections', 'from own')},
stats as (select title_id, y, x, avg(v) as mean_grey, coalesce(var_samp(v), 0) as temporal_var from grey group by 1, 2, 3),
places as (select *, case when x <= 1 then 'left' when x + w >= {ad.SIDE - 1} then 'right' end as edge from rects),
strips as (select p.title_id, avg(temporal_var) as variance, stddev_pop(mean_grey) as spread from places p join stats s on s.title_id = p.title_id
  and s.x >= (case when edge = 'left' then 0 else p.x end) and s.x < (case when edge = 'left' then p.x + p.w else {ad.SIDE} end) and (s.y < p.y or s.y >= p.y + p.h) where edge is not null group by 1),
layouts as (select p.*, edge is not null and (h >= 0.85 * {ad.SIDE} or ({ad.SIDE} - h >= 0.05 * {ad.SIDE} and coalesce(variance <= 40 and spread <= 12, false))) as side from places p left join strips using (title_id))"""


@register()
def decide_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames and boxes to decisions, windows grown: held against plain twins of each step and known scenes in the tests."""
    frames, boxes = ad.scenes(spark, sf_dir)
    out = decide.analyse_and_decide(frames, boxes, _videos(frames), ad.SIDE, ad.SIDE)
    return out.select("title_id", "rect", "kind", "edge", "panel", "method", F.round("confidence", 6).alias("confidence"), "error")


@register(
    f"with {_STILL_RECT} select c.title_id, x, y, w, h, case when side then 'side-panel' when x is not null then 'corner-inset' end as kind, "
    "case when side then edge end as edge, round(confidence, 6) as confidence, error from chosen c left join layouts l using (title_id)"
)
def decide_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without growth: tracks, features, choice, constant rectangle and layout."""
    frames, boxes = ad.scenes(spark, sf_dir)
    out = decide.analyse_and_decide(frames, boxes, _videos(frames), ad.SIDE, ad.SIDE, grow=False)
    r = F.col("rect_sample")
    return out.select("title_id", *(r[c].alias(c) for c in "xywh"), "kind", "edge", F.round("confidence", 6).alias("confidence"), "error")


@register(
    f"with {ad.SCENES_SQL} select title_id, 'pixel' as kind, null::bigint as frame_idx, null::bigint as box_no, y, x, count(*) as n, round(avg(v), 6) as mean, round(sqrt(var_pop(v) * count(*)), 5) as deviation from grey group by all "
    "union all select title_id, 'frame', frame_idx, null, null, null, count(diff), round(avg(diff), 6), round(sqrt(var_pop(diff) * count(diff)), 5) from moves group by title_id, frame_idx "
    "union all select title_id, 'box', frame_idx, box_no, null, null, n, round(motion, 6), round(sqrt(m2), 5) from box_moves"
)
def one_pass_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel statistics, motion of frames and in boxes from one aggregate over the frames."""
    found = analysis.analyse(*ad.scenes(spark, sf_dir))
    return found.withColumns({"mean": F.round("mean", 6), "deviation": F.round(F.sqrt("m2"), 5)}).drop("m2")


@register(
    f"with {_DECIDED} select count(*) as titles, count(cluster_id) as published, count(cluster_id) filter (round(confidence, 4) < 0.7) as warned, cast(0 as bigint) as errors from chosen"
)
def publish_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From frames to manifests: decisions with growth, manifests of the titles that have a window, and what validation says of them."""
    frames, boxes = ad.scenes(spark, sf_dir)
    videos = _videos(frames)
    decided = decide.analyse_and_decide(frames, boxes, videos, ad.SIDE, ad.SIDE)
    source = F.struct(*(F.lit(v).alias(k) for k, v in (("publisher", "p"), ("url", "https://example.org/"), ("licence", "CC"), ("attribution", "them"))))
    asset = F.struct(F.lit("main.mp4").alias("url"), F.col("width"), F.col("height"), F.lit("h264").alias("codec"))
    titles = videos.select(
        "title_id", F.concat(F.lit("title-"), "title_id").alias("id"), F.lit("Title").alias("title"), F.lit(60_000).alias("durationMs"), source.alias("source"),
        F.struct(asset.alias("main"), F.lit("poster.jpg").alias("poster")).alias("video"),
    )
    made = decide.publish(decided, titles, "ase", "Sign", F.lit("sign.mp4")).withColumnRenamed("title_id", "doc_id")
    judged = manifests.validity(made, manifests.validate(made)).select(F.col("doc_id").alias("title_id"), "errors", "warnings")
    rows = videos.select("title_id").join(judged, "title_id", "left")
    total = lambda c, n: F.coalesce(F.sum(c), F.lit(0)).alias(n)
    return rows.agg(F.count("*").alias("titles"), F.count("errors").alias("published"), total("warnings", "warned"), total("errors", "errors"))


@register()
def grow_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window growth to a fixpoint: held against known images in the tests."""
    s = pixels.pixel_stats(ad.grey(spark, sf_dir)).withColumn("temporal_var", F.col("temporal_var") / 100)
    rects = s.select("title_id").distinct().select("title_id", *(F.lit(v).alias(c) for c, v in (("x", 3), ("y", 3), ("w", 2), ("h", 2))))
    return pixels.grow_windows(rects, s)


# Text ---------------------------------------------------------------------------------------------

_WORDS = r"""w as (select conv_id, turn, unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) as word from conversations)"""
_NORM = """trim(regexp_replace(lower(translate(word, '‘’', '''''')), '[^a-z0-9'']+', '', 'g'), '''')"""


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(tx.words(F.col("text"))).alias("word"))


@register(f"with {_WORDS} select conv_id, turn, {_NORM} as norm, count(*) as n from w group by 1, 2, 3")
def token_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _said(spark, sf_dir).groupBy("conv_id", "turn", tx.normal_word(F.col("word")).alias("norm")).agg(F.count("*").alias("n"))


@register(
    rf"""with {ad.CONTRIBUTIONS}, p as (select title_id, ci, unnest(paragraphs) as t from contributions),
    x as (select title_id, ci, unnest(list_filter(regexp_split_to_array(replace(t, '[Applause and noise.]', ' ' || chr(1) || ' '), '\s+'), lambda w: w <> '')) as w from p)
    select title_id, ci, count(*) as tokens, count(*) filter (w = chr(1)) as events, sum(case when w = chr(1) then 12 else length(w) end)::bigint as weight from x group by 1, 2"""
)
def tokenise_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = transcript.report_words(ad.contributions(spark, sf_dir))
    return w.groupBy("title_id", "ci").agg(F.count("*").alias("tokens"), F.count_if("is_event").alias("events"), F.sum("weight").alias("weight"))


@register(f"with {ad.CUES}, t as (select title_id, index, {ad.BREAK} as broken from cues) select title_id, index, broken, len(string_split(broken, chr(10))) <= 2 and not exists(select 1 from (select unnest(string_split(broken, chr(10))) as l) where length(l) > 42) as fits from t")
def cue_line_break(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ad.cues(spark, sf_dir)
    return c.select("title_id", "index", tx.break_line(F.col("text")).alias("broken"), tx.fits(F.col("text")).alias("fits"))


@register(
    f"""with {_WORDS} select conv_id, turn, count(*) filter (regexp_matches(word, '[.!?]["''”’)\\]]*$')) as sentences,
    count(*) filter (regexp_matches(word, '[,;:—–]["''”’)\\]]*$')) as clauses from w group by 1, 2"""
)
def sentence_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("word")
    return _said(spark, sf_dir).groupBy("conv_id", "turn").agg(F.count_if(w.rlike(tx.SENTENCE_END)).alias("sentences"), F.count_if(w.rlike(tx.CLAUSE_END)).alias("clauses"))


_TIMING = f"{ad.STAMP.format('start_s')} || ' --> ' || {ad.STAMP.format('end_s')} || case when settings = '' then '' else ' ' || settings end"


@register(
    f"with {ad.CUES} select title_id, 'WEBVTT' || chr(10) || chr(10) || string_agg(case when identifier is null then '' else identifier || chr(10) end || {_TIMING} || chr(10) || text || chr(10), chr(10) order by index) as text from cues group by 1"
)
def vtt_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.build_vtt(ad.cues(spark, sf_dir))


@register(f"with {ad.CUES} select title_id, cast(row_number() over (partition by title_id order by index) as int) as index, start_s, end_s, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as text, identifier, settings from cues")
def vtt_parse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.parse_vtt(captions.build_vtt(ad.cues(spark, sf_dir)))


@register(f"with {ad.SAMPLES} select title_id, {ad.STAMP.format('(time_s / 7)')} as stamp, count(*) as n from samples group by 1, 2")
def timestamp_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ad.samples(spark, sf_dir).withColumn("stamp", tx.format_timestamp(F.col("time_s") / 7))
    return s.groupBy("title_id", "stamp").agg(F.count("*").alias("n"))


@register(f"with {ad.CUES} select title_id, index, cast(floor((index - 1) / 3) as int) as chunk, '[' || index || '] (<=' || greatest(3, cast(floor((end_s - start_s) * 2) as int)) || ' words) ' || trim(regexp_replace(text, '\\s+', ' ', 'g')) as line from cues")
def word_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.chunks(ad.cues(spark, sf_dir), 3).select("title_id", "index", "chunk", "line")


_SRT = "index || chr(10) || replace({a}, '.', ',') || ' --> ' || replace({b}, '.', ',') || chr(10) || 'line ' || index || chr(10)".format(a=ad.STAMP.format("start_s"), b=ad.STAMP.format("end_s"))


@register(
    f"with {ad.CUES} select title_id, index, 'WEBVTT' || chr(10) || chr(10) || {ad.STAMP.format('start_s')} || ' --> ' || {ad.STAMP.format('end_s')} || chr(10) || 'line ' || index || chr(10) as vtt from cues"
)
def srt_to_vtt(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ad.cues(spark, sf_dir)
    comma = lambda s: F.replace(tx.format_timestamp(F.col(s)), F.lit("."), F.lit(","))
    n = F.col("index").cast("string")
    srt = F.concat(n, F.lit("\n"), comma("start_s"), F.lit(" --> "), comma("end_s"), F.lit("\nline "), n, F.lit("\n"))
    return c.select("title_id", "index", tx.srt_to_vtt(srt).alias("vtt"))


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply a title and chunk that leaves out every fourth cue and wraps every third."""
    c = captions.chunks(ad.cues(spark, sf_dir), 3).where("index % 4 <> 0")
    n = F.col("index").cast("string")
    line = F.concat(F.lit("["), n, F.lit("] new "), n, F.when(F.col("index") % 3 == 0, "\n and more").otherwise(""))
    ordered = F.array_sort(F.collect_list(F.struct("index", line.alias("l"))))
    # in front, a line of no cue; behind, a cue of another chunk with a further line
    text = F.concat(F.lit("Here:\n"), F.array_join(F.transform(ordered, lambda x: x["l"]), "\n"), F.lit("\n["), (F.min("index") + 4).cast("string"), F.lit("] not asked\nfor"))
    return c.groupBy("title_id", "chunk").agg(text.alias("reply"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.parse_replies(_replies(spark, sf_dir), captions.chunks(ad.cues(spark, sf_dir), 3))


_PARSED = "'new ' || index || case when index % 3 = 0 then ' and more' else '' end"


@register(f"with {ad.CUES} select title_id, cast(floor((index - 1) / 3) as int) as chunk, index, {_PARSED} as text from cues where index % 4 <> 0")
def parse_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir)


@register(f"with {ad.CUES} select title_id, index, start_s, end_s, case when index % 4 <> 0 then {_PARSED} else text end as text, index % 4 <> 0 as rewritten from cues")
def rewrite_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = captions.merge_rewrites(ad.cues(spark, sf_dir), _parsed(spark, sf_dir))
    return merged.select("title_id", "index", "start_s", "end_s", "text", "rewritten")


@register(f"with {ad.CUES} select title_id, count(*) as cues, count(*) filter (index % 4 <> 0) as rewritten, round(count(*) filter (index % 4 <> 0) / count(*), 6) as coverage from cues group by 1")
def rewrite_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = captions.merge_rewrites(ad.cues(spark, sf_dir), _parsed(spark, sf_dir))
    return captions.rewrite_stats(merged).withColumn("coverage", F.round("coverage", 6))


@register(f"with {ad.CUES} select title_id, index from cues where index % 4 = 0")
def rewrite_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.missing(ad.cues(spark, sf_dir), _parsed(spark, sf_dir)).select("title_id", "index")


# Whole turns with notes, other line ends, replies of several lines and chunks of the usual size.


@register()
def whole_cue_line_break(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without SQL: the balanced break is quadratic there; the tests hold it against brute force."""
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    return ad.whole_cues(spark, sf_dir).select("title_id", "index", tx.break_line(text).alias("broken"), tx.fits(text).alias("fits"))


@register(
    f"with {ad.CUES} select title_id, 'WEBVTT' || chr(10) || chr(10) || 'NOTE Written by a machine' || chr(10) || chr(10) || string_agg(case when identifier is null then '' else identifier || chr(10) end || {_TIMING} || chr(10) || text || chr(10), chr(10) order by index) as text from cues group by 1"
)
def whole_vtt_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a note in front."""
    return captions.build_vtt(ad.cues(spark, sf_dir), "Written by a machine")


@register(f"with {ad.CUES} select title_id, cast(row_number() over (partition by title_id order by index) as int) as index, start_s, end_s, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as text, identifier, settings from cues")
def whole_vtt_parse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a note and carriage returns."""
    made = captions.build_vtt(ad.cues(spark, sf_dir), "Written by a machine")
    return captions.parse_vtt(made.withColumn("text", F.replace("text", F.lit("\n"), F.lit("\r\n"))))


@register(f"with {ad.CUES} select title_id, index, cast(floor((index - 1) / 40) as int) as chunk, '[' || index || '] (<=' || greatest(3, cast(floor((end_s - start_s) * 2) as int)) || ' words) ' || trim(regexp_replace(text, '\\s+', ' ', 'g')) as line from cues")
def whole_word_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is asked of a rewriter, at most forty cues a request."""
    return captions.chunks(ad.cues(spark, sf_dir)).select("title_id", "index", "chunk", "line")


_SAID = r"array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), lambda l: l <> ''), ' ')"


@register(f"with {ad.CUES}, s as (select *, {_SAID} as said from cues) select title_id, index, start_s, end_s, case when index % 4 <> 0 then case when said = '' then '-' else said end else text end as text, index % 4 <> 0 as rewritten from s")
def whole_rewrite_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that give cues back whole, in as many lines as they have (a dash for a blank one)."""
    cues = captions.chunks(ad.cues(spark, sf_dir))
    line = F.concat(F.lit("["), F.col("index").cast("string"), F.lit("] "), F.when(tx.stripped(F.col("text")) == "", "-").otherwise(F.col("text")))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("index", line.alias("l")))), lambda x: x["l"])
    replies = cues.where("index % 4 <> 0").groupBy("title_id", "chunk").agg(F.array_join(ordered, "\n").alias("reply"))
    merged = captions.merge_rewrites(cues, captions.parse_replies(replies, cues))
    return merged.select("title_id", "index", "start_s", "end_s", "text", "rewritten")


@register(
    r"""with b as (select page_id, regexp_replace(html, '(?is)<(script|style)\b.*?</(script|style)>', '', 'g') as h from pages),
    p as (select page_id, h, unnest(regexp_extract_all(h, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1)) as inner_ from b)
    select page_id, count(*) as paragraphs, sum(length(trim(regexp_replace(replace(replace(replace(inner_, '&copy;', '©'), '&quot;', '"'), '&amp;', '&'), '<[^>]+>', '', 'g'))))::bigint as chars from p group by 1"""
)
def html_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = transcript.paragraphs(ad.table(spark, sf_dir, "pages"))
    return p.groupBy("page_id").agg(F.count("*").alias("paragraphs"), F.sum(F.length(tx.clean_html(F.col("inner")))).alias("chars"))


_PLAIN = r"regexp_replace(regexp_replace(regexp_replace(translate(line, '©' || chr(160), '  '), '^\s+|\s+$', '', 'g'), '^[: ]+', ''), '^\s+|\s+$', '', 'g')"


@register(
    f"""with t as (select conv_id, turn, min(role) as role, min(coalesce(text, '')) as text from conversations group by 1, 2),
    n as (select *, row_number() over (partition by conv_id order by turn) as ci from t),
    p as (select conv_id, ci, min(role) as role, min(turn) as turn, list(line order by i) as lines from (select conv_id, ci, role, turn, i, {_PLAIN} as line from
      (select conv_id, ci, role, turn, generate_subscripts(string_split(text, chr(10)), 1) as i, unnest(string_split(text, chr(10))) as line from n)) where line <> '' group by 1, 2)
    select conv_id as page_id, ci, role as speaker, case when turn % 3 = 0 then '14:0' || (turn % 10) end as clock, cast(len(lines) as int) as n, sha256(array_to_string(lines, chr(10))) as said from p"""
)
def page_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report pages made of conversations, with clocks, headings and page furniture, back to contributions."""
    t = ad.table(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.min("role").alias("role"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
    turn = F.col("turn").cast("string")
    plain = F.translate("text", "©", " ")  # a footer's mark
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&#62;"), ("'", "&apos;")):
        plain = F.replace(plain, F.lit(char), F.lit(name))
    clock = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("<p> 14:0"), (F.col("turn") % 10).cast("string"), F.lit("</p>"))).otherwise("")
    body = F.concat(F.lit("<p>"), F.array_join(F.split(plain, "\n"), "</p><p>"), F.lit("</p><p class=\"x lead\">Heading</p>"))
    one = F.concat(clock, F.lit('<p id="orscontributions_'), turn, F.lit('"><strong>'), "role", F.lit("</strong>share</p>"), body)
    ordered = F.array_sort(F.collect_list(F.struct("turn", one.alias("h"))))
    html = F.concat(F.lit("<p>menu</p>"), F.array_join(F.transform(ordered, lambda x: x["h"]), "\n"), F.lit("<!-- Previous/Next navigation --><p>next</p>"))
    # the page begins at its first opener, so a clock in front of all openers is lost: an opener without a speaker goes first
    html = F.concat(F.lit('<p id="orscontributions_"></p>'), html)
    pages = t.groupBy(F.col("conv_id").alias("page_id")).agg(html.alias("html"))
    c = transcript.contributions(pages)
    return c.select("page_id", (F.col("ci") - 1).alias("ci"), "speaker", "clock", F.size("paragraphs").alias("n"), F.sha2(F.array_join("paragraphs", "\n"), 256).alias("said"))


def _recognised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recogniser result a conversation: a word a turn, a full stop after every third."""
    t = ad.table(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    item = lambda kind, at, content: F.struct(
        F.lit(kind).alias("type"), at.cast("string").alias("start_time"), (at + 0.5).cast("string").alias("end_time"),
        F.array(F.struct(F.lit("0.9").alias("confidence"), content.alias("content"))).alias("alternatives"),
    )
    at = F.col("turn").cast("double")
    word = item("pronunciation", at, F.concat("role", F.col("turn").cast("string")))
    stop = item("punctuation", at, F.lit("."))
    items = F.when(F.col("turn") % 3 == 0, F.array(word, stop)).otherwise(F.array(word))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", items.alias("i")))), lambda x: x["i"])
    doc = F.struct(F.struct(F.flatten(ordered).alias("items")).alias("results"))
    return t.groupBy(F.col("conv_id").alias("title_id")).agg(F.to_json(doc).alias("json"))


@register(
    "with t as (select conv_id, turn, min(role) as role from conversations group by 1, 2) select conv_id as title_id, row_number() over (partition by conv_id order by turn) as pos, "
    "role || turn || case when turn % 3 = 0 then '.' else '' end as text, cast(turn as double) as start, turn + 0.5::double as \"end\" from t"
)
def punctuation_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcript.recognised_words(_recognised(spark, sf_dir)).select("title_id", "pos", "text", "start", "end")


@register(
    r"""with w as (select title_id, ci, generate_subscripts(l, 1) as i, unnest(l) as word from (select conv_id as title_id, turn as ci,
    list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') as l from conversations)),
    o as (select title_id, row_number() over (partition by title_id order by ci, i, word) - 1 as pos from w),
    t as (select title_id, pos, pos % 6 < 2 as anchored, pos * 0.1 as s, pos * 0.1 + 0.05 as e from o),
    r as (select *, sum(case when anchored then 1 else 0 end) over (partition by title_id order by pos) as island from t),
    g as (select title_id, island, count(*) as n, max(e) - min(s) as span from r where not anchored group by 1, 2)
    select title_id, cast(sum(case when n >= 3 and n / greatest(span, 0.001) > 8 then n else 0 end) as bigint) as unheard from g group by 1"""
)
def anchored_islands_unheard(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ad.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("title_id"), "turn", F.posexplode(tx.words(F.col("text"))).alias("i", "word"))
    order = Window.partitionBy("title_id").orderBy("turn", "i", "word")
    t = w.select("title_id", (F.row_number().over(order) - 1).alias("pos"), F.lit(False).alias("is_event"))
    t = t.select("title_id", "pos", "is_event", (F.col("pos") % 6 < 2).alias("anchored"), (F.col("pos") * 0.1).alias("start"), (F.col("pos") * 0.1 + 0.05).alias("end"))
    return align.unheard_words(t)


def _alignment(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    c = ad.contributions(spark, sf_dir)
    report = transcript.report_words(c)
    spoken = report.where("not is_event and pos % 7 <> 3").select(
        "title_id", "pos", "text", (F.col("pos") * 0.4).alias("start"), (F.col("pos") * 0.4 + 0.35).alias("end"), "norm"
    )
    return c, report, spoken


@register()
def lcs_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchored words a title (a longest common subsequence): held against dynamic programming in the tests."""
    _, report, spoken = _alignment(spark, sf_dir)
    return align.alignment_report(align.timed_words(report, spoken))


@register()
def caption_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, report, spoken = _alignment(spark, sf_dir)
    names = c.select("title_id", "ci", tx.display_name(F.col("speaker")).alias("name")).distinct()
    return align.caption_cues(align.timed_words(report, spoken), names).drop("identifier", "settings")


@register()
def machine_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.machine_cues(_alignment(spark, sf_dir)[2]).drop("identifier", "settings")


_ROWS = ", ".join(f"round_even({c}, {d}) as \"{n}\"" for c, (n, d) in reports.CLUSTER.items())


@register(
    f"with {_FEATURES}, mb as (select title_id, box_no as cluster_id, round_even(avg(x1), 1) as x1, round_even(avg(y1), 1) as y1 from detections group by 1, 2) "
    f"select title_id, cluster_id as \"clusterId\", n_boxes as frames, {_ROWS}, eligible, case when persistence < 0.5 and size_frac > 0.45 then 'too brief; too large' when persistence < 0.5 then 'too brief' when size_frac > 0.45 then 'too large' else 'ok' end as reason, "
    "mb.x1 as x1, mb.y1 as y1 from features join mb using (title_id, cluster_id)"
)
def cluster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.cluster_rows(_features(spark, sf_dir))
    return rows.withColumns({"x1": F.get("meanBox", F.lit(0)), "y1": F.get("meanBox", F.lit(1))}).drop("meanBox")


def _cell(value: str, digits: int, width: int) -> str:
    return f"lpad(round_even({value}, {digits})::decimal(18,{digits})::varchar, {width}, ' ')"


@register(
    f"with {_FEATURES}, ranked as (select *, cast(row_number() over (partition by title_id order by eligible desc, round(score, 9) desc, cluster_id) as int) as rank from features) "
    "select title_id, rank, case when rank = 1 and eligible then '* ' else '  ' end || lpad(cluster_id::varchar, 3, ' ') || ' ' || lpad(n_boxes::varchar, 6, ' ') || ' ' || "
    f"{_cell('persistence', 2, 7)} || ' ' || {_cell('stability', 2, 6)} || ' ' || {_cell('size_frac', 2, 5)} || ' ' || {_cell('motion_ratio', 2, 7)} || ' ' || {_cell('score', 2, 5)} || '  ' || "
    "case when persistence < 0.5 and size_frac > 0.45 then 'too brief; too large' when persistence < 0.5 then 'too brief' when size_frac > 0.45 then 'too large' else 'ok' end as line from ranked"
)
def cluster_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters rank by their scores to nine decimals; lines have the scores themselves."""
    f = _features(spark, sf_dir).withColumns({"written": F.col("score"), "score": half_up("score", 9)})
    return reports.cluster_lines(detections.rank_clusters(f).withColumn("score", F.col("written")), detections.choose_signer(f))


# Sources, manifests, reports ----------------------------------------------------------------------

BLOCKED = ("spam-farm.example.org", "casino-win.example.net", "example.com")
_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"


@register(f"select page_id, {_HOST} as host, {' or '.join(f'''{_HOST} = '{b}' or {_HOST} like '%.{b}' ''' for b in BLOCKED)} as blocked from pages")
def blocked_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return ad.table(spark, sf_dir, "pages").select("page_id", listing.url_host(u).alias("host"), listing.is_blocked(u, BLOCKED).alias("blocked"))


@register(f"select host, page_id, nth from (select {_HOST} as host, page_id, cast(row_number() over (partition by {_HOST} order by page_id) as int) as nth from pages) where nth > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = ad.table(spark, sf_dir, "pages").select(listing.url_host(F.col("url")).alias("host"), "page_id")
    return listing.repeated(p, "host", "page_id")


@register(
    "select cast(s_suppkey as varchar) as id, case when s_suppkey % 3 = 0 then 'de' else 'en' end as caption_language, 'https://x.org/' || s_suppkey as media, "
    "case when s_suppkey % 4 = 0 then 2 else 1 end as faults from supplier"
)
def source_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = ad.table(spark, sf_dir, "supplier").select(
        k.cast("string").alias("id"), F.col("s_name").alias("title"), F.concat(F.lit(" https://x.org/"), k.cast("string")).alias("url"), F.lit("p").alias("publisher"),
        F.when(k % 4 == 0, "  ").otherwise("CC").alias("licence"), F.lit(" ").alias("attribution"), F.when(k % 3 == 0, " de ").alias("caption_language"),
    )
    s = s.withColumn("id", F.concat(F.lit("s-"), "id"))
    out = listing.with_defaults(s)
    return out.select(F.substring("id", 3, 20).alias("id"), "caption_language", "media", F.size("faults").alias("faults"))


@register(
    "select 'lists/' || n_nationkey || '.yaml' as file, cast(row_number() over (partition by s_nationkey order by s_suppkey) - 1 as int) as pos, 's-' || s_suppkey as id, s_name as title, "
    "case when s_suppkey % 3 = 0 then 'de' else 'en' end as caption_language, case when s_suppkey % 2 = 0 then s_suppkey % 100 end as x, cast(len(case when s_suppkey % 4 = 0 then ['a'] else [] end) as int) as faults "
    "from supplier join nation on s_nationkey = n_nationkey"
)
def source_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source lists in YAML, one a nation, with defaults and faults."""
    k = F.col("s_suppkey")
    text = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))
    entry = text(
        "- id: s-", k, "\n  title: ", F.col("s_name"), "\n  url: https://x.org/", k, "\n  publisher: p\n  licence: CC", F.when(k % 4 != 0, "\n  attribution: them").otherwise(""),
        F.when(k % 3 == 0, "\n  caption_language: de").otherwise(""), F.when(k % 2 == 0, text("\n  layout: corner-inset\n  crop_rect: {x: ", k % 100, ", y: 0, w: 4, h: 4}")).otherwise(""), "\n",
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", entry.alias("e")))), lambda x: x["e"])
    lists_ = ad.table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.concat(F.lit("sources:\n"), F.array_join(ordered, "")).alias("text"))
    out = listing.with_defaults(lists.parse_lists(lists_.select(text("lists/", F.col("s_nationkey"), ".yaml").alias("file"), "text")))
    return out.select("file", "pos", "id", "title", "caption_language", F.col("crop_rect.x").alias("x"), F.size("faults").alias("faults"))


_DOCS = """o as (select o_orderkey as k, min(round(o_totalprice * 100)::bigint) as cents, min(o_orderpriority) as p, min(o_custkey) as c from orders group by 1)"""
_EACH = "(select unnest([0, 1]) as i) where k % 23 <> 7 and (i = 0 or k % 5 = 1)"
_ISSUES = f"""{_DOCS}, shape as (
  select k, '$' as path, 'error' as severity from o where k % 23 = 7
  union all select k, 'stmVersion', 'error' from o where k % 17 = 4 and k % 23 <> 7
  union all select k, 'source', 'error' from o where k % 7 = 2 and k % 23 <> 7
  union all select k, '$', 'error' from o where k % 19 = 6 and k % 23 <> 7
  union all select k, 'title', 'error' from o where k % 29 = 8 and k % 23 <> 7
  union all select k, 'captions/0', 'error' from o where k % 43 = 12 and k % 23 <> 7
  union all select k, 'captions/0', 'error' from o where k % 47 = 13 and k % 23 <> 7
  union all select k, 'signLanguage/' || i || '/language', 'error' from o, {_EACH} and k % 11 = 3
  union all select k, 'signLanguage/' || i, 'error' from o, {_EACH} and k % 13 = 5
  union all select k, 'signLanguage/' || i, 'error' from o, {_EACH} and k % 13 = 5
  union all select k, 'signLanguage/' || i, 'error' from o, {_EACH} and k % 13 = 5
  union all select k, 'signLanguage/' || i || '/track/syncOffsetMs', 'error' from o, {_EACH} and k % 31 = 9
  union all select k, 'signLanguage/' || i || '/track/width', 'error' from o, {_EACH} and k % 37 = 10
  union all select k, 'signLanguage/' || i || '/track/codec', 'error' from o, {_EACH} and k % 41 = 11
  union all select k, 'signLanguage/' || i || '/extraction', 'error' from o, {_EACH} and k % 53 = 14),
sound as (select * from o where k not in (select k from shape)),
issues as (select * from shape
  union all select k, 'signLanguage/1/language', 'error' from sound where k % 5 = 1
  union all select k, 'signLanguage/' || i || '/extraction/confidence', 'warning' from sound, {_EACH} and (cents % 100) / 100 < 0.7
  union all select k, 'signLanguage/' || i || '/track/syncOffsetMs', 'warning' from sound, {_EACH} and k % 59 = 15)"""


@register(f"with {_ISSUES} select k as doc_id, path, severity from issues")
def validate_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.validate(ad.manifests(spark, sf_dir)).select("doc_id", "path", "severity")


@register(
    f"with {_ISSUES} select o.k as doc_id, count(*) filter (severity = 'error') as errors, count(*) filter (severity = 'warning') as warnings, "
    "count(*) filter (severity = 'error') = 0 as valid from o left join issues i on i.k = o.k group by 1"
)
def validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = ad.manifests(spark, sf_dir)
    return manifests.validity(d, manifests.validate(d))


@register(
    f"with {_DOCS}, x as (select *, k % 23 <> 7 as ok from o) select case when ok then 'title-' || k end as id, "
    "case when ok then case when k % 29 = 8 then '7' else 'Title ' || p end end as title, case when ok then cast(cents % 100000 as int) end as duration_ms, case when ok then 'https://cdn.example.org/t/poster.jpg' end as poster, "
    "'https://cdn.example.org/t/' || k || '/manifest.json' as manifest_url, case when ok then case when k % 11 = 3 then 'xx' else 'ase' end end as languages, case when ok then (cents % 100) / 100 end as confidence from x"
)
def catalogue_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = manifests.parse_manifests(ad.manifests(spark, sf_dir))
    m = m.withColumn("manifest_url", F.concat(F.col("doc_id").cast("string"), F.lit("/manifest.json")))
    c = manifests.catalogue_entries(m, "https://cdn.example.org/t/")
    return c.withColumn("languages", F.array_join("sign_languages", ",")).drop("sign_languages")


@register(
    f"with {_DOCS}, x as (select *, k % 23 <> 7 as ok from o) select k as doc_id, case when ok then 'https://b.org/main.mp4' end as main, case when ok then 'https://b.org/poster.jpg' end as poster, "
    "case when ok then 'https://b.org/sign.mp4' end as track, case when ok then 'https://b.org/cap/en.vtt' end as caption from x"
)
def absolutise_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = manifests.absolutise(manifests.parse_manifests(ad.manifests(spark, sf_dir)), "https://b.org/")
    return m.select(
        "doc_id", F.col("m.video.main.url").alias("main"), F.col("m.video.poster").alias("poster"),
        F.get(F.col("m.signLanguage"), F.lit(0))["track"]["url"].alias("track"), F.get(F.col("m.captions"), F.lit(0))["url"].alias("caption"),
    )


def _catalogues(spark: SparkSession, sf_dir: str, same: int | None = None) -> DataFrame:
    """A catalogue a customer of the manifests that are JSON; ``same`` leaves that many different ids."""
    made = ad.manifests(spark, sf_dir).join(ad.table(spark, sf_dir, "orders").groupBy(F.col("o_orderkey").alias("doc_id")).agg(F.min("o_custkey").alias("customer")), "doc_id")
    m = manifests.parse_manifests(made).where("m.id is not null").withColumn("manifest_url", F.concat(F.col("doc_id").cast("string"), F.lit("/manifest.json")))
    entries = manifests.catalogue_entries(m.select("m", "manifest_url")).select("*", F.substring("id", 7, 20).cast("long").alias("k"))
    owners = made.select(F.col("doc_id").alias("k"), "customer")
    entries = entries.join(owners, "k")
    if same:
        entries = entries.withColumn("id", F.concat(F.lit("title-"), (F.col("k") % same).cast("string")))
    return manifests.catalogue_documents(entries.drop("k"), "customer")


_ENTRY_SQL = r"""'    {' || n || '      "id": "title-' || k || '",' || n || '      "title": "' || case when k % 29 = 8 then '7' else 'Title ' || p end || '",' || n || '      "durationMs": ' || (cents % 100000) || ',' || n ||
  '      "poster": "poster.jpg",' || n || '      "manifestUrl": "' || k || '/manifest.json",' || n || '      "signLanguages": [' || n || '        "' || case when k % 11 = 3 then 'xx' else 'ase' end || '"' || n || '      ],' || n ||
  '      "confidence": ' || case when cents % 10 = 0 then '0.' || (cents % 100 // 10) else '0.' || lpad((cents % 100)::varchar, 2, '0') end || n || '    }'"""


@register(
    f"with {_DOCS}, x as (select *, chr(10) as n from o where k % 23 <> 7) select c as customer, count(*) as titles, "
    f"sha256('{{' || chr(10) || '  \"stmVersion\": \"0.2\",' || chr(10) || '  \"titles\": [' || chr(10) || string_agg({_ENTRY_SQL}, ',' || chr(10) order by 'title-' || k) || chr(10) || '  ]' || chr(10) || '}}' || chr(10)) as digest from x group by 1"
)
def catalogue_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of catalogue files, by their digest."""
    c = _catalogues(spark, sf_dir)
    titles = F.size(F.from_json("json", "titles array<string>")["titles"]).cast("long")
    return c.select("customer", titles.alias("titles"), tx.content_sha256(F.col("json")).alias("digest"))


def _lines_sql(*lines: str) -> str:
    """Lines of a file; each is an SQL expression, null where it is left out."""
    return f"array_to_string(list_filter([{', '.join(lines)}], lambda l: l is not null), chr(10))"


def _member_sql(indent: int, name: str, value: str, last: bool = False) -> str:
    return f"""'{' ' * indent}"{name}": ' || {value}{'' if last else " || ','"}"""


_CONFIDENCE = "case when cents % 10 = 0 then '0.' || (cents % 100 // 10) else '0.' || lpad((cents % 100)::varchar, 2, '0') end"
_TRACK_SQL = _lines_sql(
    "'    {'", _member_sql(6, "language", "case when k % 11 = 3 then '\"xx\"' else '\"ase\"' end"), _member_sql(6, "languageLabel", "'\"Sign\"'"),
    "case when k % 13 <> 5 then " + _member_sql(6, "provenance", "'\"human-interpreter\"'") + " end", "'      \"extraction\": {'", _member_sql(8, "method", "'\"detected-crop\"'"),
    _member_sql(8, "sourceLayout", "'\"corner-inset\"'"), _member_sql(8, "confidence", _CONFIDENCE), "'        \"cropRect\": {'",
    *(_member_sql(10, c, f"'{v}'", c == "h") for c, v in (("x", 0), ("y", 2), ("w", 4), ("h", 6))), "'        },'", _member_sql(8, "fillMethod", "'\"none\"'", True), "'      },'",
    "'      \"track\": {'", _member_sql(8, "url", "'\"sign.mp4\"'"), _member_sql(8, "width", "case when k % 37 = 10 then '-4' else '4' end"), _member_sql(8, "height", "'6'"),
    "'        \"codec\": ' || case when k % 41 = 11 then '\"nope\"' else '\"h264\"' end || case when k % 31 = 9 then '' else ',' end",
    "case when k % 31 <> 9 then " + _member_sql(8, "syncOffsetMs", "case when k % 59 = 15 then '6000' else '0' end", True) + " end", "'      }'", "'    }'",
)
_MANIFEST_SQL = _lines_sql(
    "'{'", _member_sql(2, "stmVersion", "case when k % 17 = 4 then '\"0.9\"' else '\"0.2\"' end"), _member_sql(2, "id", "'\"title-' || k || '\"'"),
    _member_sql(2, "title", "case when k % 29 = 8 then '\"7\"' else '\"Title ' || p || '\"' end"), _member_sql(2, "durationMs", "(cents % 100000)"), "'  \"source\": {'",
    _member_sql(4, "publisher", "'\"c' || c || '\"'"), _member_sql(4, "url", "'\"https://example.org/x\"'"), "'    \"licence\": \"CC\"' || case when k % 7 = 2 then '' else ',' end",
    "case when k % 7 <> 2 then " + _member_sql(4, "attribution", "'\"them\"'", True) + " end", "'  },'", "'  \"video\": {'", "'    \"main\": {'", _member_sql(6, "url", "'\"main.mp4\"'"),
    _member_sql(6, "width", "'640'"), _member_sql(6, "height", "'360'"), _member_sql(6, "codec", "'\"h264\"'", True), "'    },'", _member_sql(4, "poster", "'\"poster.jpg\"'", True), "'  },'",
    "'  \"signLanguage\": ['", "track || case when k % 5 = 1 then ',' || chr(10) || track else '' end", "'  ],'", "'  \"captions\": ['", "'    {'", _member_sql(6, "kind", "'\"verbatim\"'"),
    _member_sql(6, "language", "'\"en\"'"), _member_sql(6, "url", "'\"/cap/en.vtt\"'"), "'      \"format\": \"webvtt\"' || case when k % 47 = 13 then ',' else '' end",
    "case when k % 47 = 13 then " + _member_sql(6, "reviewedBy", "'\"Ann\"'", True) + " end", "'    }'", "'  ]'", "'}'",
)


@register(
    f"with {_DOCS}, t as (select *, {_TRACK_SQL} as track from o) select k as doc_id, sha256(case when k % 23 = 7 then '{{}}' else {_MANIFEST_SQL} end || chr(10)) as digest from t"
)
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of manifests' files, by their digest; what isn't JSON is an empty manifest."""
    m = manifests.parse_manifests(ad.manifests(spark, sf_dir))
    return m.select("doc_id", tx.content_sha256(manifests.manifest_text(F.col("m"))).alias("digest"))


@register(
    f"with {_DOCS}, x as (select *, 'title-' || (k % 40) as id, case when k % 29 = 8 then '7' else 'Title ' || p end as title from o where k % 23 <> 7), "
    "e as (select *, row_number() over (partition by c order by id, title, cents % 100000, k || '/manifest.json') - 1 as i from x), "
    "shape as (select c, 'titles/' || i || '/signLanguages/0' as path from e where k % 11 = 3), "
    "twice as (select c, 'titles/' || i || '/id' as path from (select *, row_number() over (partition by c, id order by i) as nth from e) where nth > 1 and c not in (select c from shape)) "
    "select c as doc_id, path, 'error' as severity from shape union all select c, path, 'error' from twice"
)
def catalogue_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What validation says of catalogues in which ids occur twice and languages have two letters."""
    c = _catalogues(spark, sf_dir, same=40).withColumnRenamed("customer", "doc_id")
    return manifests.validate_catalogues(c).select("doc_id", "path", "severity")


_FILES = ["main.mp4", "poster.JPG", "captions/verbatim.en.vtt", "analysis.json", "manifest.json", "notes.bin", "clip.m4v", "still.jpeg", "logo.png", "captions/verbatim.en.srt", "play/list.m3u8"]


@register(
    f"select c_custkey as title_id, 'base/' || c_custkey || '/' || f as key, case when f = 'main.mp4' or f = 'clip.m4v' then 'video/mp4' when f = 'poster.JPG' or f = 'still.jpeg' then 'image/jpeg' "
    f"when f = 'captions/verbatim.en.vtt' then 'text/vtt' when f = 'manifest.json' then 'application/json' when f = 'logo.png' then 'image/png' when f = 'captions/verbatim.en.srt' then 'application/x-subrip' "
    f"when f = 'play/list.m3u8' then 'application/vnd.apple.mpegurl' else 'application/octet-stream' end as content_type, "
    f"cast(row_number() over (partition by c_custkey order by f) as int) as position from customer, (select unnest({_FILES}) as f) where f <> 'analysis.json'"
)
def upload_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = ad.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("title_id"), F.explode(F.array(*map(F.lit, _FILES))).alias("rel_path"))
    return manifests.upload_plan(files, "base/")


_SAFE = f"""safe as (select *, greatest(x, 2) as sx, greatest(y, 2) as sy, greatest(least(x + w, {W - 2}) - greatest(x, 2), 1) as sw, greatest(least(y + h, {H - 2}) - greatest(y, 2), 1) as sh from r)"""


@register(
    f"with {_PART}, {_SAFE} select k, 'crop=' || (w - w % 2) || ':' || (h - h % 2) || ':' || x || ':' || y || case when h > 40 then ',scale=-2:40' else '' end as crop, "
    "case k % 3 when 0 then 'none' when 1 then 'interpolated-surround' else 'blurred-surround' end as method, "
    "case when k % 3 > 0 then '[0:v]' || case when k % 3 = 1 then 'delogo=x=' || sx || ':y=' || sy || ':w=' || sw || ':h=' || sh || ',' else '' end || 'split[whole][part];[part]crop=' || sw || ':' || sh || ':' || sx || ':' || sy || "
    "',gblur=sigma=' || case when k % 3 = 1 then '6.0' else '18.0' end || '[patch];[whole][patch]overlay=' || sx || ':' || sy || '[v]' end as graph, "
    "case when k % 3 = 0 then '-i in.mp4 -c copy -movflags +faststart out.mp4' end as copied from safe"
)
def media_plan_argv(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, size = F.col("r"), (F.lit(W), F.lit(H))
    method = F.when(F.col("k") % 3 == 0, "none").when(F.col("k") % 3 == 1, "interpolated-surround").otherwise("blurred-surround")
    rows = _part_rects(spark, sf_dir).withColumn("method", method)
    argv = media_plan.fill_argv(F.lit("in.mp4"), r, F.col("method"), *size, F.lit("out.mp4"))
    return rows.select(
        "k", media_plan.crop_filter(r, 40).alias("crop"), "method", F.when(F.col("method") != "none", F.get(argv, F.lit(3))).alias("graph"),
        F.when(F.col("method") == "none", F.array_join(argv, " ")).alias("copied"),
    )


@register(
    "with t as (select doc_id as clip, doc_id % 50 as x, doc_id % 30 as y, 20 + doc_id % 7 as w, doc_id % 3 = 0 as faced from labels), "
    "d as (select doc_id as clip, doc_id % 50 + n_chars % 5 as x, doc_id % 30 as y, 20 + doc_id % 7 as w, n_chars % 11 = 0 as broken from documents where lang <> 'de'), "
    "j as (select t.clip, t.faced, d.clip is not null and not d.broken as ok, greatest(0, least(t.x + t.w, d.x + d.w) - greatest(t.x, d.x)) * 40 as common, t.w * 40 * 2 as total, d.x <= t.x + 2 as inside from t left join d using (clip)), "
    "s as (select case when ok then common / (total - common) else 0.0 end as iou, case when ok and faced then inside end as face from j) "
    "select count(*) as clips, count(*) filter (iou >= 0.85 and coalesce(face, true)) as passed, round(avg(iou), 6) as mean_iou from s"
)
def harness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth of the labelled documents against decisions: a missing or failed one scores 0."""
    return harness.summary(_scored(spark, sf_dir)).withColumn("mean_iou", F.round("mean_iou", 6))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id").cast("int")
    wide = lambda x: g.rect(x, k % 30, 20 + k % 7, F.lit(40))
    truth = ad.table(spark, sf_dir, "labels").select(
        k.alias("clip"), wide(k % 50).alias("rect"), F.when(k % 3 == 0, g.rect(k % 50 + 2, k % 30 + 2, F.lit(3), F.lit(3))).alias("face")
    )
    d = ad.table(spark, sf_dir, "documents").where("lang <> 'de'")
    found = wide(k % 50 + (F.col("n_chars") % 5).cast("int")).alias("found")
    decisions = d.select(k.alias("clip"), found, F.lit(0.9).alias("confidence"), F.when(F.col("n_chars") % 11 == 0, "no signer").alias("error"))
    return harness.score_clips(truth, decisions)


@register(
    "with t as (select doc_id as clip, doc_id % 50 as x, doc_id % 30 as y, 20 + doc_id % 7 as w, doc_id % 3 = 0 as faced from labels), "
    "d as (select doc_id as clip, doc_id % 50 + n_chars % 5 as x, doc_id % 30 as y, 20 + doc_id % 7 as w, n_chars % 11 = 0 as broken from documents where lang <> 'de'), "
    "j as (select t.clip, t.faced, d.clip is not null as there, coalesce(d.broken, false) as broken, d.clip is not null and not d.broken as ok, greatest(0, least(t.x + t.w, d.x + d.w) - greatest(t.x, d.x)) * 40 as common, t.w * 40 * 2 as total, d.x <= t.x + 2 as inside from t left join d using (clip)), "
    "s as (select *, case when ok then common / (total - common) else 0.0 end as iou, case when ok and faced then inside end as face from j) "
    f"select clip, rpad(clip::varchar, 40, ' ') || ' ' || {_cell('iou', 3, 6)} || ' ' || lpad(case when iou >= 0.85 and coalesce(face, true) then 'ok' else 'FAIL' end, 5, ' ') || ' ' || lpad(case when face is null then '-' when face then 'yes' else 'NO' end, 5, ' ') "
    "|| ' ' || case when there then ' 0.90' else '    -' end || ' ' || rpad('-', 13, ' ') || ' ' || lpad(((clip % 40) / 5)::decimal(18,1)::varchar, 6, ' ') || case when broken then '  no signer' else '' end as line from s"
)
def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = {"layout": F.lit(None).cast("string"), "seconds": F.col("clip") % 40 / 5}
    return reports.score_lines(_scored(spark, sf_dir).withColumns(extra))


@register("select doc_id, sha256(text) as sha256 from documents")
def content_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "documents").select("doc_id", tx.content_sha256(F.col("text")).alias("sha256"))


# Written rows of triage and activity, labels replaced, entries for the source list.

_EASE = "0.6 * least(greatest((detail - 12) / 24, 0), 1) + 0.4 * least(greatest((motion - 8) / 52, 0), 1)"
_CLIPS = (
    "clips as (select doc_id as clip, case when n_chars % 9 = 0 then 'unreadable' end as error, case doc_id % 3 when 0 then 'side-panel' else 'corner-inset' end as layout, "
    "case when doc_id % 3 = 0 then 'left' end as edge, (n_chars % 101) / 100 as confidence, n_chars % 23 / 0.7 as detail, n_chars % 31 / 1.7 as motion, doc_id % 5 as width, n_chars / 24.0 as duration_s, (doc_id % 47) / 90 as size_frac from documents), "
    f"eased as (select *, case when error is null then case when layout = 'side-panel' then 0.0 else {_EASE} end end as difficulty from clips), "
    "judged as (select *, case when error is not null then 'unusable' when layout = 'side-panel' then 'excellent' when confidence < 0.7 then 'marginal' when difficulty < 0.35 then 'good' when difficulty < 0.65 then 'marginal' else 'poor' end as verdict from eased)"
)


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("doc_id"), F.col("n_chars")
    clips = ad.table(spark, sf_dir, "documents").select(
        k.alias("clip"), F.when(n % 9 == 0, "unreadable").alias("error"), F.when(k % 3 == 0, "side-panel").otherwise("corner-inset").alias("layout"), F.when(k % 3 == 0, "left").alias("edge"),
        (n % 101 / 100).alias("confidence"), (n % 23 / F.lit(0.7)).alias("detail"), (n % 31 / F.lit(1.7)).alias("motion"), (k % 5).alias("width"), F.lit(360).alias("height"),
        (n / F.lit(24.0)).alias("duration_s"), (k % 47 / 90).alias("size_frac"), F.lit(None).cast("string").alias("rect"),
    )
    return harness.triage(clips)


@register(
    f"with {_CLIPS} select clip, verdict, layout, edge, case when width > 0 then width || 'x360' end as resolution, round_even(duration_s, 1) as \"durationS\", round_even(confidence, 3) as confidence, "
    "round_even(size_frac, 3) as \"sizeFrac\", round_even(detail, 1) as \"backgroundDetail\", round_even(motion, 1) as \"backgroundMotion\", round_even(difficulty, 3) as \"fillDifficulty\", error from judged"
)
def triage_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written row of each clip; a failed one has no difficulty, one without a width no resolution."""
    return reports.triage_rows(_clips(spark, sf_dir)).drop("rect")


@register(f"with {_CLIPS} select count(*) filter (verdict in ('excellent', 'good')) as useful, count(*) as clips from judged")
def triage_useful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harness.useful(_clips(spark, sf_dir))


@register(
    f"with {ad.TRACK} select title_id, cast({ad.DAY * 1000} as int) as \"intervalMs\", 'title-p95' as scale, count(*) as length, round_even(round(max(top), 6), 3) as p95, "
    "round_even(avg(case when level < 20 then 1.0 else 0.0 end), 3) as \"idleFraction\" from track group by 1"
)
def activity_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engines' percentiles differ in the last bits, which decides where a half is; six decimals don't."""
    return reports.activity_rows(_track(spark, sf_dir).withColumn("top", half_up("top", 6)), ad.DAY * 1000)


@register(
    "select doc_id, 'old' as origin from labels where doc_id not in (select doc_id from documents where n_chars % 4 = 0) "
    "union all select doc_id, coalesce(source, 'none') from documents where n_chars % 4 = 0"
)
def label_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels replaced or added by the newer ones of a quarter of the documents."""
    old = ad.table(spark, sf_dir, "labels").select("doc_id", F.lit("old").alias("origin"))
    new = ad.table(spark, sf_dir, "documents").where("n_chars % 4 = 0").select("doc_id", F.coalesce("source", F.lit("none")).alias("origin"))
    return harness.upsert(old, new, "doc_id")


@register(
    r"select page_id, '- id: ' || substr(regexp_replace(lower(regexp_extract(url, '([^/]+?)(\.[^./]*)?$', 1)), '[ _]', '-', 'g'), 1, 60) || chr(10) || '  title: ' || chr(10) || '  url: ' || chr(10) || '  publisher: ' || chr(10) || "
    r"'  licence: ' || chr(10) || '  attribution: ' || chr(10) || '  notes: ' || case when page_id % 100 < 35 then 'easy' when page_id % 100 < 65 then 'medium' else 'hard' end as entry from pages"
)
def source_skeletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entry for the source list a page, named by the last part of its address."""
    return ad.table(spark, sf_dir, "pages").select("page_id", harness.source_skeleton(F.col("url"), F.col("page_id") % 100 / 100).alias("entry"))
