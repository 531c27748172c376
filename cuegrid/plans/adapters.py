"""The driver's tables as the engine's tables, in Spark and as DuckDB common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = 86_400
START_US = 1_704_067_200_000_000  # 2024-01-01
DAYS = 30
FRAME = (800, 400)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (title_id, time_s, motion)."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - START_US
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("title_id"), (micros / 1e6).alias("time_s"), F.col("value").alias("motion"))


def media(samples_: DataFrame) -> DataFrame:
    return samples_.select("title_id").distinct().withColumn("duration_s", F.lit(float(DAY * DAYS)))


SAMPLES = f"samples as (select user_id as title_id, (epoch_us(ts) - {START_US}) / 1e6 as time_s, value as motion from events)"
TRACK = f"""{SAMPLES},
grid as (select title_id, unnest(range({DAYS})) as bucket from (select distinct title_id from samples)),
means as (select title_id, cast(least({DAYS - 1}, floor(time_s / {DAY})) as int) as bucket,
          cast(sum(cast(round(motion * 1e6) as decimal(38,0))) as double) / count(*) / 1e6 as mean
          from samples where motion is not null and time_s >= 0 group by 1, 2),
vals as (select g.title_id, g.bucket, coalesce(last_value(mean ignore nulls) over (partition by g.title_id order by g.bucket
         rows between unbounded preceding and current row), 0.0) as value from grid g left join means m using (title_id, bucket)),
tops as (select title_id, quantile_cont(value, 0.95) as top from vals group by 1),
track as (select v.title_id, v.bucket, v.value, case when top > 1e-9 then top else 0.0 end as top,
          cast(case when top > 1e-9 then round_even(least(greatest(value / top, 0), 1) * 100, 0) else 0 end as int) as level
          from vals v join tops using (title_id))"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> (title_id, frame_idx, box_no, x1, y1, x2, y2, motion, frame_motion)."""
    li = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("title_id"), F.col("l_orderkey").alias("frame_idx"), F.col("l_linenumber").cast("long").alias("box_no")
    ).agg(
        F.pmod(F.max("l_partkey"), F.lit(400)).cast("double").alias("x1"),
        (F.max("l_quantity") + 20).alias("w"),
        F.round(F.max("l_discount") * 100).alias("motion"),
        (F.round(F.max("l_tax") * 100) + 1).alias("frame_motion"),
    )
    y1 = F.pmod("frame_idx", F.lit(200)).cast("double")
    return li.select(
        "title_id", "frame_idx", "box_no", "x1", y1.alias("y1"), (F.col("x1") + F.col("w")).alias("x2"),
        (y1 + 2 * F.col("w")).alias("y2"), (F.col("motion") + 0.0).alias("motion"), "frame_motion",
    )


def frames(detections_: DataFrame) -> DataFrame:
    return detections_.groupBy("title_id", "frame_idx").agg(F.max("frame_motion").alias("frame_motion"))


DETECTIONS = """li as (select l_suppkey as title_id, l_orderkey as frame_idx, cast(l_linenumber as bigint) as box_no,
  cast(max(l_partkey) % 400 as double) as x1, max(l_quantity) + 20 as w, round(max(l_discount) * 100) + 0.0 as motion,
  round(max(l_tax) * 100) + 1 as frame_motion from lineitem group by 1, 2, 3),
detections as (select title_id, frame_idx, box_no, x1, cast(frame_idx % 200 as double) as y1, x1 + w as x2,
  cast(frame_idx % 200 as double) + 2 * w as y2, motion, frame_motion from li),
frames as (select title_id, frame_idx, max(frame_motion) as frame_motion from detections group by 1, 2)"""


def grey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> (title_id, frame_idx, y, x, v): 8x8 frames of whole greys."""
    e = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("long").alias("title_id"), F.col("vec_id").alias("frame_idx"), F.posexplode("embedding").alias("p", "e")
    )
    v = F.bround((F.col("e").cast("double") + 1) * 127.5).cast("long")
    return e.select("title_id", "frame_idx", F.floor(F.col("p") / 8).cast("int").alias("y"), (F.col("p") % 8).alias("x"), v.alias("v"))


GREY = """px as (select cast(label as bigint) as title_id, vec_id as frame_idx, unnest(range(64)) as p, unnest(embedding) as e from embeddings),
grey as (select title_id, frame_idx, cast(p // 8 as int) as y, cast(p % 8 as int) as x,
         cast(round_even((cast(e as double) + 1) * 127.5, 0) as bigint) as v from px)"""


#: Side of the scenes' square frames, and titles.
SIDE, SCENES = 32, 40


def scenes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """embeddings -> (frames with pixels, boxes): forty titles, frames of 32x32 greys enlarged from 8x8 numbers.

    By the title's number modulo 8: 0 has no person, 1 a person as large as half the frame, 2 and 3 a signer at the right edge,
    others one in the frame; from 5 on a large presenter stands on the left.  The signer moves a pixel in every other frame.
    Left of 14 and behind the signer pixels change, elsewhere they are still.
    """
    e = table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % SCENES).alias("title_id"), F.floor(F.col("vec_id") / SCENES).cast("long").alias("frame_idx"), "embedding"
    )
    kind = F.col("title_id") % 8
    at_edge = kind.isin(2, 3)

    def pixel(p: Column) -> Column:
        x, y = p % SIDE, F.floor(p / SIDE)
        number = F.get("embedding", (F.floor(p / 128) * 8 + F.floor(x / 4)).cast("int")).cast("double")
        loud = (x < 14) | F.when(at_edge, (x >= 24) & (y >= 10) & (y < 30)).otherwise((x >= 20) & (x < 27) & (y >= 18) & (y < 29))
        return F.when(loud, F.bround((number + 1) * 127.5)).otherwise(F.bround(number) + 80).cast("int")

    frames_ = e.select("title_id", "frame_idx", F.lit(SIDE).alias("width"), F.transform(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1)), pixel).alias("pixels"))
    step = (F.col("frame_idx") % 2).cast("double")
    box = lambda no, x1, y1, x2, y2: F.struct(F.lit(no).cast("long").alias("box_no"), *((v if isinstance(v, Column) else F.lit(float(v))).alias(c) for c, v in zip(("x1", "y1", "x2", "y2"), (x1, y1, x2, y2), strict=True)))
    signer = F.when(at_edge, box(0, 24, 10, 31, 30)).otherwise(box(0, step + 20, 18, step + 26, 28))
    large = box(1, 0, 2, 16, 30)
    found = F.when(kind == 1, F.array(large)).when(kind >= 5, F.array(signer, large)).when(kind > 1, F.array(signer))
    return frames_, e.select("title_id", "frame_idx", F.inline(found))


SCENES_SQL = f"""e as (select vec_id % {SCENES} as title_id, vec_id // {SCENES} as frame_idx, embedding from embeddings),
cells as (select title_id, frame_idx, embedding, title_id % 8 in (2, 3) as edge, cast(p % {SIDE} as int) as x, cast(p // {SIDE} as int) as y from e, (select unnest(range({SIDE * SIDE})) as p)),
grey as (select title_id, frame_idx, y, x, case when x < 14 or case when edge then x >= 24 and y >= 10 and y < 30 else x >= 20 and x < 27 and y >= 18 and y < 29 end
  then cast(round_even((cast(n as double) + 1) * 127.5, 0) as int) else cast(round_even(cast(n as double), 0) as int) + 80 end as v
  from (select *, embedding[(y // 4) * 8 + x // 4 + 1] as n from cells)),
boxes as (select title_id, frame_idx, cast(0 as bigint) as box_no, case when title_id % 8 < 4 then 24.0 else 20.0 + frame_idx % 2 end as x1, case when title_id % 8 < 4 then 10.0 else 18.0 end as y1,
    case when title_id % 8 < 4 then 31.0 else 26.0 + frame_idx % 2 end as x2, case when title_id % 8 < 4 then 30.0 else 28.0 end as y2 from e where title_id % 8 > 1
  union all select title_id, frame_idx, 1, 0.0, 2.0, 16.0, 30.0 from e where title_id % 8 = 1 or title_id % 8 >= 5),
moves as (select *, abs(v - lag(v) over (partition by title_id, y, x order by frame_idx)) as diff from grey),
frames as (select title_id, frame_idx, avg(diff) as frame_motion from moves group by 1, 2),
box_moves as (select b.title_id, b.frame_idx, box_no, count(diff) as n, avg(diff) as motion, var_pop(diff) * count(diff) as m2 from boxes b join moves m
  on m.title_id = b.title_id and m.frame_idx = b.frame_idx and x >= floor(x1) and x < ceil(x2) and y >= floor(y1) and y < ceil(y1 + 0.6 * (y2 - y1)) group by 1, 2, 3),
detections as (select b.title_id, b.frame_idx, case when title_id % 8 = 1 then 0 else box_no end as box_no, x1, y1, x2, y2, motion from boxes b left join box_moves using (title_id, frame_idx, box_no))"""


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> (title_id, ci, speaker, clock, paragraphs); every fifth turn opens with an event."""
    event = F.when(F.col("turn") % 5 == 0, "[Applause and noise.] ").otherwise("")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("title_id"), F.col("turn").alias("ci"), F.col("role").alias("speaker"), F.lit(None).cast("string").alias("clock"),
        F.split(F.concat(event, F.coalesce("text", F.lit(""))), "\n").alias("paragraphs"),
    )


WORD_SQL = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')"
CONTRIBUTIONS = """contributions as (select conv_id as title_id, turn as ci, role as speaker,
  string_split(case when turn % 5 = 0 then '[Applause and noise.] ' else '' end || coalesce(text, ''), chr(10)) as paragraphs from conversations)"""


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> cues: one a turn, 2 s apart, with all lines of the turn except blank ones."""
    return whole_cues(spark, sf_dir)


def whole_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> cues, each with all lines of its turn except blank ones; rows that repeat a turn are one cue."""
    lines = F.split(F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n"), "\n")
    return _turns(spark, sf_dir, F.array_join(F.filter(lines, lambda x: ~x.rlike(r"^[ \t]*$")), "\n"))


def _turns(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    t = table(spark, sf_dir, "conversations")
    first = t.groupBy("conv_id", "turn").agg(F.min(text).alias("text"), F.min("role").alias("role"))
    start = F.col("turn") * 2.5
    return first.select(
        F.col("conv_id").alias("title_id"), (F.col("turn") + 1).cast("int").alias("index"), start.cast("double").alias("start_s"),
        (start + 2.125).cast("double").alias("end_s"), "text", F.when(F.col("role") == "user", F.concat(F.lit("id-"), F.col("turn").cast("string"))).alias("identifier"),
        F.when(F.col("role") == "system", "align:start").otherwise("").alias("settings"),
    )


WHOLE_CUES = r"""cues as (select conv_id as title_id, cast(turn + 1 as int) as index, cast(turn * 2.5 as double) as start_s,
  cast(turn * 2.5 + 2.125 as double) as end_s,
  min(array_to_string(list_filter(string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)), lambda l: not regexp_full_match(l, '[ \t]*')), chr(10))) as text,
  case when min(role) = 'user' then 'id-' || turn end as identifier, case when min(role) = 'system' then 'align:start' else '' end as settings
  from conversations group by conv_id, turn)"""
CUES = WHOLE_CUES
STAMP = (
    "printf('%02d:%02d:%02d.%03d', cast(floor(round_even({0} * 1000, 0) / 3600000) as int), "
    "cast(floor(round_even({0} * 1000, 0) / 60000) as int) % 60, cast(floor(round_even({0} * 1000, 0) / 1000) as int) % 60, "
    "cast(round_even({0} * 1000, 0) as bigint) % 1000)"
)
#: Of the spaces on either side of the middle only the nearest can be the most balanced break.
BREAK = r"""case when length(text) <= 42 then text else coalesce((select regexp_replace(substr(text, 1, b.at), '\s+$', '') || chr(10) || regexp_replace(substr(text, b.at + 2), '^\s+', '')
  from (select list_sort(list_filter([case when l > 0 then {'m': greatest(h + 1 - l, n - h - 2 + l), 'o': abs(h + 1 - l - n // 2), 'at': h + 1 - l} end,
    case when r > 0 then {'m': greatest(h + r, n - h - r - 1), 'o': abs(h + r - n // 2), 'at': h + r} end], lambda s: s is not null))[1].at as at
    from (select length(text) as n, (length(text) - 1) // 2 as h, instr(reverse(substr(text, 1, (length(text) - 1) // 2 + 1)), ' ') as l,
      instr(substr(text, (length(text) - 1) // 2 + 2), ' ') as r)) b where b.at is not null), text) end"""


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> (doc_id, json): manifests, some with a fault by the order's number."""
    o = table(spark, sf_dir, "orders").groupBy("o_orderkey").agg(F.min("o_custkey").alias("c"), F.min("o_orderpriority").alias("p"), F.min(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    k = F.col("o_orderkey")

    def by(modulus: int, rest: int, fault: str, right: str | Column = "") -> Column:
        """The fault in orders whose number has this remainder."""
        return F.when(k % modulus == rest, F.lit(fault)).otherwise(F.lit(right) if isinstance(right, str) else right)

    def text(*parts: str | Column) -> Column:
        return F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))

    codec = by(41, 11, '"codec":"nope",', '"codec":"h264",')
    offset = by(31, 9, '"syncOffsetMs":0.5', by(59, 15, '"syncOffsetMs":6000', '"syncOffsetMs":0'))
    track = text(
        '{"language":"', by(11, 3, "xx", "ase"), '","languageLabel":"Sign",', by(13, 5, "", '"provenance":"human-interpreter",'),
        '"extraction":{"method":"detected-crop","sourceLayout":"corner-inset","confidence":', (F.col("cents") % 100) / 100,
        ',"cropRect":{"x":0,"y":2,"w":4,"h":6},"fillMethod":"none"', by(53, 14, ',"x":[]'), '},"track":{"url":"sign.mp4",', by(37, 10, '"width":-4,', '"width":4,'),
        '"height":6,', codec, offset, "}}",
    )
    json = text(
        '{"stmVersion":"', by(17, 4, "0.9", "0.2"), '","id":"title-', k, '","title":', by(29, 8, "7", text('"Title ', F.col("p"), '"')), ',"durationMs":', F.col("cents") % 100_000,
        ',"source":{"publisher":"c', F.col("c"), '","url":"https://example.org/x","licence":"CC"', by(7, 2, "", ',"attribution":"them"'),
        '},"video":{"main":{"url":"main.mp4","width":640,"height":360,"codec":"h264"},"poster":"poster.jpg"},"signLanguage":[', by(5, 1, "", track),
        F.when(k % 5 == 1, text(track, ",", track)).otherwise(""), '],"captions":[{"kind":"verbatim"', by(47, 13, ',"reviewedBy":"Ann"'),
        ',"language":"en","url":"/cap/en.vtt","format":"webvtt"', by(43, 12, ',"more":1'), "}]", by(19, 6, ',"extraKey":1'), "}",
    )
    return o.select(k.alias("doc_id"), by(23, 7, "{broken", json).alias("json"))
