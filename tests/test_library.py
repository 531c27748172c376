"""Operators against small cases and plain twins."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cuegrid.functions import geometry as g
from cuegrid.functions import text as tx
from cuegrid.operators import activity, align, captions, decide, detections, manifests, media_plan, pixels, transcript
from cuegrid.plans import catalogue
from cuegrid.sources import listing


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def rect(x, y, w, h):
    return g.rect(F.lit(x), F.lit(y), F.lit(w), F.lit(h))


def test_rectangles(spark):
    assert one(spark, g.iou(rect(0, 0, 10, 10), rect(5, 0, 10, 10))) == pytest.approx(50 / 150)
    assert one(spark, g.iou(rect(0, 0, 1, 1), rect(5, 5, 1, 1))) == 0
    assert one(spark, g.contains(rect(0, 0, 10, 10), rect(0, 0, 10, 10)))
    assert one(spark, g.pad_rect(rect(11, 11, 20, 20), 0.1, F.lit(100), F.lit(100))).asDict() == {"x": 8, "y": 8, "w": 24, "h": 24}
    assert one(spark, g.clamp01(F.lit(None).cast("double"))) is None


def test_activity_buckets(spark):
    s = spark.createDataFrame([(1, 1.0, 4.0), (1, 25.0, 8.0), (1, 99.0, 2.0), (1, 3.0, None), (1, -1.0, 9.0)], "title_id long, time_s double, motion double")
    m = spark.createDataFrame([(1, 50.0)], "title_id long, duration_s double")
    got = [r.value for r in activity.bucket_values(s, m, 10.0).orderBy("bucket").collect()]
    assert got == [4.0, 4.0, 8.0, 8.0, 2.0]
    with pytest.raises(ValueError):
        activity.bucket_values(s, m, 0)


def test_flat_activity_is_zero(spark):
    v = spark.createDataFrame([(1, i, 0.0) for i in range(4)], "title_id long, bucket int, value double")
    assert {(r.level, r.top) for r in activity.normalise(v).collect()} == {(0, 0.0)}


def test_tops_and_written_values_are_those_of_sql(spark):
    import duckdb

    from cuegrid.functions.numbers import half_up

    rng = random.Random(5)
    rows = [(t, b, rng.choice([rng.randrange(10_000) / 100, rng.randrange(10**9) / 1e7, 12.5])) for t in range(300) for b in range(30)]
    values = spark.createDataFrame(rows, "title_id long, bucket int, value double")
    got = activity.normalise(values).select("title_id", "bucket", "value", "top", half_up("value", 6).alias("written")).toPandas()
    with duckdb.connect() as db:
        db.register("got", got)
        wrong = "select count(*) from got join (select title_id, quantile_cont(value, 0.95) as q from got group by 1) using (title_id) where q <> top or written <> round(value, 6)"
        assert db.execute(wrong).fetchone()[0] == 0


def test_numbers_of_lines_next_to_a_half(spark):
    from cuegrid.operators import reports

    # 0.935 less one bit: a hundred times it is 93.5, which goes to the even 94
    assert one(spark, reports.fixed(F.lit(0.9349999999999999), 2, 7)) == "   0.94"
    assert one(spark, reports.fixed(F.lit(None).cast("double"), 2, 3)) == "  -"


def test_lines_have_scores_that_are_rounded_once(spark, tmp_path):
    import duckdb

    # a score of 0.245 and one bit: 0.25, but 0.24 if it is rounded to nine decimals before
    rows = [(1, k, 1, k % 2 * 300, 23.0, 0.05 if k < 42 else 0.04, 0.04 if k < 64 else 0.03) for k in range(80)]
    rows += [(1, k, 2, k % 2 * 300, 30.0, 0.05, 0.04) for k in range(80, 640)]
    columns = "l_suppkey long, l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_discount double, l_tax double"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = sorted(tuple(r) for r in catalogue.queries()["cluster_table"](spark, str(tmp_path)).collect())
    with duckdb.connect() as db:
        db.execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
        assert got == sorted(db.execute(catalogue.oracle_sql()["cluster_table"]).fetchall())
    assert any(" 0.25  too brief" in line for *_, line in got)


def test_layouts_are_those_of_detected_rectangles(spark, tmp_path):
    rows = [(title, k, 1, 1, (title * 90 + k) % 400, 10.0, 0.02, 0.01) for title in (1, 4) for k in range(200)]
    columns = "l_suppkey long, l_orderkey long, l_linenumber int, n int, l_partkey long, l_quantity double, l_discount double, l_tax double"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.title_id: (r.kind, r.edge) for r in catalogue.queries()["layout_classify"](spark, str(tmp_path)).collect()}
    assert got.keys() == {1, 4}


def test_a_text_of_a_document_is_escaped_by_one_small_expression(spark):
    from cuegrid.functions import json_text

    odd = 'a"b\\c\n\x01\u00e9'
    assert one(spark, json_text.quoted(F.lit(odd))) == '"a\\"b\\\\c\\n\\u0001\u00e9"'
    assert str(json_text.quoted(F.col("x"))).lower().count("replace(") <= 1


def naive_tracks(rows, min_iou=0.3, a=0.2):
    """rows: (frame, box, (x1, y1, x2, y2)) -> cluster of each row."""

    def iou(p, q):
        w, h = min(p[2], q[2]) - max(p[0], q[0]), min(p[3], q[3]) - max(p[1], q[1])
        o = max(0, w) * max(0, h)
        u = (p[2] - p[0]) * (p[3] - p[1]) + (q[2] - q[0]) * (q[3] - q[1]) - o
        return o / u if u > 0 else 0

    means, out = [], {}
    for f in sorted({r[0] for r in rows}):
        boxes = sorted((r[1], r[2]) for r in rows if r[0] == f)
        options = sorted(((iou(b[1], m), i, c) for i, b in enumerate(boxes) for c, m in enumerate(means) if iou(b[1], m) >= min_iou), reverse=True)
        used, taken = {}, set()
        for _, i, c in options:
            if i not in used and c not in taken:
                used[i] = c
                taken.add(c)
        for i, (box, b) in enumerate(boxes):
            if i in used:
                c = used[i]
                means[c] = tuple(m + a * (v - m) for m, v in zip(means[c], b, strict=True))
            else:
                c = len(means)
                means.append(b)
            out[f, box] = c
    return out


def test_tracking_equals_its_plain_twin(spark):
    rng = random.Random(3)
    rows = []
    for f in range(25):
        for b in range(rng.randrange(4)):
            x, y = rng.randrange(60), rng.randrange(60)
            rows.append((f, b, (float(x), float(y), float(x + 30 + rng.randrange(20)), float(y + 40))))
    df = spark.createDataFrame([(7, f, b, *box, 1.0) for f, b, box in rows], "title_id long, frame_idx long, box_no long, x1 double, y1 double, x2 double, y2 double, motion double")
    got = {(r.frame_idx, r.box_no): r.cluster_id for r in detections.cluster_detections(df).collect()}
    assert got == naive_tracks(rows)


def test_signer_is_chosen_and_missing_ones_are_errors(spark):
    det = [(1, f, 0, 150.0, 40.0, 450.0, 350.0, 1.5) for f in range(40)] + [(1, f, 1, 480.0 + f % 2, 220.0, 600.0 + f % 2, 350.0, 12.0) for f in range(40)]
    det += [(2, 0, 0, 0.0, 0.0, 600.0, 300.0, 1.0)]
    d = spark.createDataFrame(det, "title_id long, frame_idx long, box_no long, x1 double, y1 double, x2 double, y2 double, motion double")
    frames = spark.createDataFrame([(t, f, None if f == 0 else 3.0) for t in (1, 2) for f in range(40)], "title_id long, frame_idx long, frame_motion double")
    chosen = {r.title_id: r for r in detections.choose_signer(detections.cluster_features(detections.cluster_detections(d), frames, 640, 360)).collect()}
    assert chosen[1].cluster_id == 1 and chosen[1].confidence > 0.7
    assert chosen[2].cluster_id is None and chosen[2].error


def test_suppression(spark):
    rows = [(1, 0, 0, 0.0, 0.0, 10.0, 10.0, 0.9), (1, 0, 1, 1.0, 1.0, 11.0, 11.0, 0.8), (1, 0, 2, 50.0, 50.0, 60.0, 60.0, 0.7)]
    d = spark.createDataFrame(rows, "title_id long, frame_idx long, box_no long, x1 double, y1 double, x2 double, y2 double, score double")
    assert sorted(r.box_no for r in detections.suppress_overlaps(d).collect()) == [0, 2]


def test_anchor_decoding(spark):
    a = spark.createDataFrame([(1, 0, i, [0.0] * 4 + [1.0, 1.0]) for i in (0, 3, 2704, 3380)], "title_id long, frame_idx long, anchor int, p array<float>")
    got = {r.anchor: (r.cx, r.cy, r.w) for r in detections.decode_anchors(a, 416).collect()}
    assert got == {0: (0.0, 0.0, 8.0), 3: (24.0, 0.0, 8.0), 2704: (0.0, 0.0, 16.0), 3380: (0.0, 0.0, 32.0)}


def test_window_growth_stops_at_a_moving_border(spark):
    px = [(1, y, x, 100.0, 1.0 if 10 <= x < 40 and 10 <= y < 40 else 500.0) for y in range(60) for x in range(100)]
    stats = spark.createDataFrame(px, "title_id long, y int, x int, mean_grey double, temporal_var double")
    r = spark.createDataFrame([(1, 20, 20, 10, 10)], "title_id long, x int, y int, w int, h int")
    got = pixels.grow_windows(r, stats).first()
    assert (got.x, got.y, got.w, got.h) == (10, 10, 30, 30)


def test_text_functions(spark):
    assert one(spark, tx.normal_word(F.lit("‘Don’t!’"))) == "don't"
    assert one(spark, tx.tokens(F.lit("a foo[bar baz]qux [x"))) == ["a", "foo", "[bar baz]", "qux", "[x"]
    assert one(spark, tx.format_timestamp(F.lit(3661.0005))) == "01:01:01.000"
    assert one(spark, tx.parse_timestamp(F.lit("01:02,500"))) == 62.5
    assert one(spark, tx.parse_timestamp(F.lit("nonsense"))) is None
    assert one(spark, tx.clean_html(F.lit("<b>a&nbsp;&#x2019;&#233; &amp;amp; b</b> "))) == "a ’é &amp; b"
    assert one(spark, tx.display_name(F.lit("3. Ann Other (Somewhere) (X)"))) == "Ann Other"
    long = "one two three four five six seven eight nine ten eleven"
    assert max(map(len, one(spark, tx.break_line(F.lit(long))).split("\n"))) <= 42
    assert one(spark, tx.break_line(F.lit(long))) == "one two three four five six\nseven eight nine ten eleven"
    assert one(spark, tx.break_line(F.lit("a" * 30 + " \u2003 " + "b" * 30))) == "a" * 30 + "\n" + "b" * 30


def test_captions_round_trip(spark):
    text = "WEBVTT\n\nNOTE hello\n\nfirst\n00:01.000 --> 00:02.500 align:start\nA line\nand more\n\n00:00:03.000 --> 00:00:04.000\nB\n"
    cues = captions.parse_vtt(spark.createDataFrame([(1, text)], "title_id long, text string"))
    rows = cues.orderBy("index").collect()
    assert [(r.start_s, r.end_s, r.text, r.identifier, r.settings) for r in rows] == [(1.0, 2.5, "A line\nand more", "first", "align:start"), (3.0, 4.0, "B", None, "")]
    again = captions.parse_vtt(captions.build_vtt(cues, "n"))
    assert again.orderBy("index").collect() == rows


def test_replies(spark):
    reply = "intro\n[1] one\n  more\n[2]\n[3] x\n[3] y"
    got = captions.parse_replies(spark.createDataFrame([(1, 0, reply)], "title_id long, chunk int, reply string"))
    assert sorted((r["index"], r.text) for r in got.collect()) == [(1, "one more"), (3, "y")]
    replies = spark.createDataFrame([(1, 0, "[1] one\r\n[7] other\nits rest\n[2] two"), (1, 1, "[1] wrong\n[7]  seven \n")], "title_id long, chunk int, reply string")
    asked = spark.createDataFrame([(1, 0, 1), (1, 0, 2), (1, 1, 7)], "title_id long, chunk int, index int")
    assert sorted((r["index"], r.text) for r in captions.parse_replies(replies, asked).collect()) == [(1, "one"), (2, "two"), (7, "seven")]


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = align.longest_common(a, b)
        assert len(pairs) == lcs_length(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_alignment_and_cues(spark):
    paragraphs = ["Good morning everyone and welcome to the hall. [Applause] We begin with item one, which is long.", "Second part here."]
    c = spark.createDataFrame([(1, 0, "Ann (X)", paragraphs), (1, 1, "Bob", ["Thank you all."]), (2, 0, "Cy", ["Nothing heard."])], "title_id long, ci long, speaker string, paragraphs array<string>")
    report = transcript.report_words(c)
    spoken = report.where("title_id = 1 and not is_event and pos % 4 <> 2").select("title_id", "pos", "text", (F.col("pos") * 0.5).alias("start"), (F.col("pos") * 0.5 + 0.4).alias("end"), "norm")
    timed = align.timed_words(report, spoken)
    rows = timed.where("title_id = 1").orderBy("pos").collect()
    assert len(rows) == report.where("title_id = 1").count() and all(r.end >= r.start >= 0 for r in rows)
    assert timed.where("title_id = 2 and anchored").count() == 0
    cues = align.caption_cues(timed, c.select("title_id", "ci", tx.display_name(F.col("speaker")).alias("name"))).where("title_id = 1").orderBy("index").collect()
    assert cues[0].text.startswith("Ann: Good morning") and any(q.text == "[Applause]" for q in cues)
    assert any(q.text.startswith("Bob: ") for q in cues)
    for p, q in zip(cues, cues[1:], strict=False):
        assert p.end_s <= q.start_s + 1e-9
    assert all(0 < q.end_s - q.start_s <= 7.001 and len(q.text.split("\n")) <= 2 for q in cues)
    said = " ".join(q.text.replace("\n", " ") for q in cues).replace("Ann: ", "").replace("Bob: ", "").split()
    assert said == " ".join([*paragraphs, "Thank you all."]).split()
    r = {x.title_id: x for x in align.alignment_report(timed).collect()}
    assert r[1].events == 1 and r[2].anchored_fraction == 0.0


REPORT = "title_id long, pos long, text string, ci long, pi long, is_event boolean, norm string, weight long"


def timed_run(spark, run, heard, last_ci=0):
    """Times of the words between an anchor at 0.0-0.4 and one at ``heard``; run: words, events in brackets, a pair (word, ci)."""
    words = [("first", 0), *((w if isinstance(w, tuple) else (w, 0)) for w in run), ("final", last_ci)]
    rows = [(1, k, w, ci, 0, w[0] == "[", None if w[0] == "[" else w, 12 if w[0] == "[" else len(w)) for k, (w, ci) in enumerate(words)]
    spoken = [(1, 0, "first", 0.0, 0.4, "first"), (1, 1, "final", heard, heard + 8.0, "final")]
    report = spark.createDataFrame(rows, REPORT)
    got = align.timed_words(report, spark.createDataFrame(spoken, "title_id long, pos long, text string, start double, end double, norm string"))
    rows = got.orderBy("pos").collect()
    assert rows[-1].end == pytest.approx(heard + 1.0) and rows[0].anchored and rows[-1].anchored  # an anchored word takes a second at most
    return [(round(r.start, 6), round(r.end, 6)) for r in rows[1:-1]]


def test_times_of_unheard_words(spark):
    assert timed_run(spark, ["fiver", "words"], 10.0) == [(0.4, 0.8), (0.8, 1.2)]  # cling to the left
    assert timed_run(spark, ["fiver", "words"], 2.0) == [(0.4, 1.2), (1.2, 2.0)]  # fill the gap
    assert timed_run(spark, ["[Applause]"], 20.4) == [(0.8, 5.8)]
    assert timed_run(spark, ["[A]", "[B]"], 20.4) == [(0.8, 5.8), (5.8, 10.8)]
    assert timed_run(spark, ["[A]", "[B]"], 3.4) == [(0.8, 2.3), (2.3, 3.4)]
    assert timed_run(spark, ["[A]", "[B]", "[C]"], 3.4) == [(0.8, 1.8), (1.8, 2.8), (2.8, 3.8)]
    assert timed_run(spark, ["fiver", "[A]", "words"], 10.0) == [(0.4, 0.8), (1.2, 6.2), (9.6, 10.0)]
    assert timed_run(spark, ["fiver", ("words", 1)], 10.0, 1) == [(0.4, 0.8), (9.6, 10.0)]
    assert timed_run(spark, ["fiver", "[A]", "words"], 1.5) == [(0.4, 0.65), (0.65, 1.25), (1.25, 1.5)]  # cramped
    # between late words an event is timed like any other, and late words leave it room
    assert timed_run(spark, ["[A]", "fiver", "[B]", "words"], 12.0) == [(0.8, 5.8), (11.2, round(11.2 + 0.8 * 5 / 22, 6)), (5.8, 10.8), (round(11.2 + 0.8 * 17 / 22, 6), 12.0)]


def test_times_without_anchors_on_a_side(spark):
    rows = [(1, k, w, 0, 0, False, w, 5) for k, w in enumerate(["aaaaa", "bbbbb", "heard", "ddddd"])]
    said = spark.createDataFrame([(1, 0, "heard", 0.5, 0.9, "heard")], "title_id long, pos long, text string, start double, end double, norm string")
    report = spark.createDataFrame(rows, REPORT)
    got = [(round(r.start, 6), round(r.end, 6)) for r in align.timed_words(report, said).orderBy("pos").collect()]
    assert got == [(0.0, 0.25), (0.25, 0.5), (0.5, 0.9), (0.9, 1.3)]
    got = [(round(r.start, 6), round(r.end, 6)) for r in align.timed_words(report, said.limit(0)).orderBy("pos").collect()]
    assert got == [(0.0, 0.4), (0.4, 0.8), (0.8, 1.2), (1.2, 1.6)]


def cue_texts(spark, words, name="Ann", step=0.3):
    """words: text, or (text, ci, pi), or (text, ci, pi, start)."""
    rows, at = [], 0.0
    for k, w in enumerate(words):
        text, ci, pi, *start = w if isinstance(w, tuple) else (w, 0, 1)
        at = start[0] if start else at
        rows.append((1, k, text, ci, pi, text[0] == "[", at, at + step, True))
        at += step
    timed = spark.createDataFrame(rows, "title_id long, pos long, text string, ci long, pi long, is_event boolean, start double, end double, anchored boolean")
    names = spark.createDataFrame([(1, 0, name)], "title_id long, ci long, name string")
    return [r.text for r in align.caption_cues(timed, names).orderBy("index").collect()]


def test_cues_are_cut_by_reason(spark):
    nine = "abcdefghi"
    sizes = lambda *w, **k: [len(t.split()) for t in cue_texts(spark, list(w), **k)]
    assert sizes(*[nine] * 12) == [8, 4]  # eight words fill two lines
    assert sizes(*[nine] * 9) == [7, 2]  # the last word of the paragraph takes one along
    assert sizes(*[nine] * 8, "abcdefgh,", *[nine] * 3) == [8, 4]  # a clause's end takes none along
    assert sizes(*[nine] * 8, "abcdefgh.", *[nine] * 3) == [7, 5]  # a sentence's end does: 19 characters don't close the cue
    assert sizes(*[nine] * 7, "of", "abcdefghij") == [6, 3]  # a short word comes along too
    assert sizes(*[nine] * 8, "[Applause]", nine) == [8, 1, 1]
    assert sizes(*[nine] * 8, (nine, 0, 2)) == [8, 1]
    assert sizes("one", "two", ("three", 0, 1, 4.0)) == [2, 1]  # a pause
    assert sizes("one", ("two", 0, 1, 4.0)) == [2]  # not after one word
    assert sizes("one", ("two", 0, 1, 7.0)) == [1, 1]  # unless it is too slow
    assert sizes("Yes.", "This", "is", "a", "sentence.", "And", "more") == [5, 2]  # 4 characters don't close a cue
    assert sizes(*[nine] * 5, "ab,", nine) == [6, 1] and sizes(*[nine] * 4, "ab,", nine) == [6]  # a clause of 53 characters does, one of 43 doesn't
    event = "[" + "long event " * 5 + "]"
    assert cue_texts(spark, [("Good", 0, 0), ("day.", 0, 0), (event, 0, 0), ("More", 0, 1)]) == ["Ann: Good day.", event, "More"]
    assert cue_texts(spark, [(event, 0, 0), ("Good", 0, 0)], name="") == [event, "Good"]
    assert cue_texts(spark, [(event, 0, 0), ("Good", 0, 1)]) == [event, "Good"]  # named in the first paragraph only


def test_tidy_cues(spark):
    rows = [(1, 0, 0.0, 0.5, "a"), (1, 1, 1.1, 20.0, "b"), (1, 2, 30.0, 32.0, "c"), (1, 3, 32.1, 32.2, "d"), (1, 4, 32.15, 34.0, "e"), (1, 5, 32.05, 33.0, "f"), (1, 6, 33.3, 33.5, "g")]
    got = align.tidy(spark.createDataFrame(rows, "title_id long, pos long, start double, end double, text string")).orderBy("index").collect()
    assert [(r.start_s, r.end_s) for r in got] == [
        (0.0, 1.1),  # at least a second, and the small gap closed
        (1.1, 8.1),  # at most seven
        (30.0, 32.1),
        (32.1, 32.15),  # up to the next one's start
        (32.15, 32.2),  # which is before: a twentieth of a second
        (32.2, 33.3),
        (33.3, 34.3),
    ]


def test_machine_cues_break_at_pauses(spark):
    words = [("one", 0.0, 0.4), ("two.", 0.5, 0.9), ("three", 4.0, 4.5), ("four", 5.4, 5.6), *((f"w{i:08d}", 6.0 + i / 2, 6.4 + i / 2) for i in range(14)), ("end.", 13.1, 13.2), ("last", 13.3, 13.5)]
    rows = [(1, k, *w) for k, w in enumerate(words)]
    got = align.machine_cues(spark.createDataFrame(rows, "title_id long, pos long, text string, start double, end double")).orderBy("index").collect()
    texts = [r.text.replace("\n", " ").split() for r in got]
    assert texts[0] == ["one", "two."] and texts[1][:2] == ["three", "four"] and texts[-1] == ["last"] and texts[-2][-1] == "end."
    assert [w for t in texts for w in t] == [w[0] for w in words]
    assert all(len(x) <= 42 for r in got for x in r.text.split("\n"))


def test_transcript_page(spark):
    html = (
        '<p>menu</p><p id="orscontributions_a"></p><p id="orscontributions_b"><strong>1. Ann Other (Y)</strong></p><p>: Hello&nbsp;there.</p>'
        '<p class="lead">skip</p><p>14:01</p><p id="orscontributions_c"><strong>Bob</strong></p><p>Yes.</p><p>Back to Official Report</p><p>tail</p>'
    )
    got = transcript.contributions(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("ci").collect()
    assert [(r.speaker, r.clock, r.paragraphs) for r in got] == [("1. Ann Other (Y)", None, ["Hello there."]), ("Bob", "14:01", ["Yes."])]


def test_transcript_page_ends(spark):
    page = (
        '<p class="h5">menu</p><p id="orscontributions_a"><strong>1. Ann © (Y)</strong></p><p>One.</p>{}<p>Two.</p><p id="orscontributions_b"><strong>Bob</strong></p><p>Yes.</p>'
    )
    rows = [(1, page.format("")), (2, page.format("<!-- Previous/Next navigation -->")), (3, page.format('<p class="h5">x</p>')), (4, page.format("<p>all &copy; here</p>")), (5, page.format("<p><!-- © -->kept</p>"))]
    got = transcript.contributions(spark.createDataFrame(rows, "page_id long, html string")).orderBy("page_id", "ci").collect()
    said = {}
    for r in got:
        said.setdefault(r.page_id, []).append((r.speaker, r.paragraphs))
    whole, cut = [("1. Ann © (Y)", ["One.", "Two."]), ("Bob", ["Yes."])], [("1. Ann © (Y)", ["One."])]
    assert said == {1: whole, 2: cut, 3: cut, 4: cut, 5: [("1. Ann © (Y)", ["One.", "kept", "Two."]), whole[1]]}


def test_word_lists(spark):
    text = '[{"text": "a", "start": 0.5, "end": 1.0, "probability": 0.25}, {"text": "b", "start": 1, "end": 2}]'
    words = transcript.load_words(spark.createDataFrame([(1, text), (2, "[]")], "title_id long, json string"))
    assert [tuple(r) for r in words.orderBy("pos").collect()] == [(1, 0, "a", 0.5, 1.0, 0.25), (1, 1, "b", 1.0, 2.0, 1.0)]
    assert transcript.load_words(transcript.save_words(words)).orderBy("pos").collect() == words.orderBy("pos").collect()


def test_subtitle_files(spark):
    srt = "\ufeff1\r\n00:00:01,000 --> 00:00:02,500 \r\nAt 00:00:09,111 sharp  \r\n\r\n 12\r\n"
    assert one(spark, tx.srt_to_vtt(F.lit(srt))) == "WEBVTT\n\n00:00:01.000 --> 00:00:02.500\nAt 00:00:09.111 sharp\n\n 12\n"
    assert one(spark, tx.as_vtt(F.lit("a.SRT"), F.lit("x"))) == "WEBVTT\n\nx\n"
    assert one(spark, tx.as_vtt(F.lit("a.vtt"), F.lit("\ufeff\n WEBVTT\n"))) == "\n WEBVTT\n"
    assert one(spark, tx.as_vtt(F.lit("a.vtt"), F.lit("nothing"))) is None
    text = "WEBVTT - t\n\nNOTE hello\nthere\n\nSTYLE\n::cue {}\n\n1\n00:01.000-->00:02.500 align:start\nA\n  \nline\n\n\nREGION\nid:x\n"
    files = spark.createDataFrame([(1, text)], "title_id long, text string")
    blocks = captions.vtt_preamble(files)
    assert blocks.first().blocks == ["NOTE hello\nthere", "STYLE\n::cue {}", "REGION\nid:x"]
    cues = captions.parse_vtt(files)
    assert [(r.start_s, r.end_s, r.text, r.identifier, r.settings) for r in cues.collect()] == [(1.0, 2.5, "A\n  \nline", "1", "align:start")]
    again = captions.build_vtt(cues, "made", blocks)
    assert again.first().text.startswith("WEBVTT\n\nNOTE made\n\nNOTE hello\nthere\n\nSTYLE")
    assert captions.vtt_preamble(again).first().blocks == ["NOTE made", *blocks.first().blocks] and captions.parse_vtt(again).collect() == cues.collect()


def test_encoder_calls(spark):
    r, size = rect(0, 10, 101, 50), (F.lit(200), F.lit(100))
    call = lambda c: " ".join(one(spark, c))
    x264 = "-c:v libx264 -preset medium -crf {} -pix_fmt yuv420p"
    src, dst = F.lit("a"), F.lit("b")
    assert call(media_plan.crop_argv(src, r, dst)) == f"-i a -vf crop=100:50:0:10 {x264.format(23)} -movflags +faststart -an b"
    assert call(media_plan.crop_argv(src, r, dst, 41, 20, True)) == f"-i a -vf crop=100:50:0:10,scale=-2:40 {x264.format(20)} -movflags +faststart -c:a aac -b:a 96k b"
    tail = f"-map [v] -map 0:a? {x264.format(20)} -c:a copy -movflags +faststart b"
    cut = "crop=99:50:2:10"
    graph = "[0:v]{}split[whole][part];[part]" + cut + ",gblur=sigma={}[patch];[whole][patch]overlay=2:10[v]"
    fill = lambda m: call(media_plan.fill_argv(src, r, F.lit(m), *size, dst))
    assert fill("none") == "-i a -c copy -movflags +faststart b"
    assert fill("blurred-surround") == f"-i a -filter_complex {graph.format('', '18.0')} {tail}"
    assert fill("interpolated-surround") == f"-i a -filter_complex {graph.format('delogo=x=2:y=10:w=99:h=50,', '6.0')} {tail}"
    assert call(media_plan.crop_away_argv(src, r, dst)) == f"-i a -vf crop=100:50:0:10 {x264.format(20)} -c:a copy -movflags +faststart b"
    assert call(media_plan.poster_argv(src, F.lit(1.25), dst)) == "-ss 1.250 -i a -frames:v 1 -q:v 2 b"
    boxes = F.array(F.struct(r.alias("rect"), F.lit("red").alias("colour"), F.lit(3).alias("thickness")))
    assert call(media_plan.drawbox_argv(src, boxes, dst)) == "-i a -vf drawbox=x=0:y=10:w=101:h=50:color=red@1:t=3 -c:v libx264 -preset veryfast -crf 23 -pix_fmt yuv420p -c:a copy b"
    assert one(spark, media_plan.drawbox_argv(src, F.slice(boxes, 1, 0), dst)) is None


def test_background_of_a_window(spark):
    rng = np.random.default_rng(7)
    grey, var = rng.integers(0, 255, (20, 30)).astype(float), rng.integers(0, 90, (20, 30)).astype(float)
    stats = spark.createDataFrame([(t, y, x, float(grey[y, x]), float(var[y, x])) for t in (1, 2) for y in range(20) for x in range(30)], "title_id long, y int, x int, mean_grey double, temporal_var double")
    rects = {1: (8, 6, 8, 4), 2: (0, 0, 30, 20), 3: (1, 1, 2, 2)}
    table = spark.createDataFrame([(t, dict(zip("xywh", r, strict=True))) for t, r in rects.items()], "title_id long, rect struct<x:int,y:int,w:int,h:int>")
    got = {r.title_id: r for r in pixels.measure_background(table, stats, 30, 20).collect()}
    part = np.pad(grey[4:12, 6:18], 1, mode="reflect")  # the ring: 2 more on every side
    gx = sum(k * (part[i : i + 8, 2:] - part[i : i + 8, :-2]) for i, k in enumerate((1, 2, 1)))
    gy = sum(k * (part[2:, i : i + 12] - part[:-2, i : i + 12]) for i, k in enumerate((1, 2, 1)))
    keep = np.ones((8, 12), bool)
    keep[2:6, 2:10] = False
    detail, motion = np.hypot(gx, gy)[keep].mean(), var[4:12, 6:18][keep].mean()
    hard = 0.6 * min(1, max(0, (detail - 12) / 24)) + 0.4 * min(1, max(0, (motion - 8) / 52))
    assert (got[1].detail, got[1].motion, got[1].difficulty) == pytest.approx((detail, motion, hard))
    assert all((got[t].detail, got[t].motion, got[t].difficulty) == (0.0, 0.0, 0.5) for t in (2, 3))


def scene(spark):
    """Title 1: a still large person, a signer who moves in place, somebody passing; title 2: nobody; title 3: the large person only."""
    boxes, frames = [], []
    for f in range(40):
        frames += [(t, f, None if f == 0 else 3.0) for t in (1, 2, 3)]
        boxes += [(t, f, 0, 150.0, 40.0, 450.0, 350.0, 1.5) for t in (1, 3)]
        jitter = f % 3
        boxes.append((1, f, 1, 480.0 + jitter, 220.0, 600.0 + jitter, 350.0, 12.0))
        if 10 <= f <= 15:
            boxes.append((1, f, 2, 20.0 + 20 * f, 100.0, 90.0 + 20 * f, 340.0, 6.0))
    videos = [(t, 1280, 720) for t in (1, 2, 3)]
    return (
        spark.createDataFrame(frames, "title_id long, frame_idx long, frame_motion double"),
        spark.createDataFrame(boxes, "title_id long, frame_idx long, box_no long, x1 double, y1 double, x2 double, y2 double, motion double"),
        spark.createDataFrame(videos, "title_id long, width int, height int"),
    )


def test_decisions_from_detections(spark):
    frames, boxes, videos = scene(spark)
    y, x = np.mgrid[0:360, 0:640]
    still = (x >= 470) & (x < 632) & (y >= 210)  # an inset of one grey round the signer
    px = pd.DataFrame({"title_id": 1, "y": y.ravel(), "x": x.ravel(), "mean_grey": np.where(still, 80.0, 200.0).ravel(), "temporal_var": np.where(still, 1.0, 500.0).ravel()})
    stats = spark.createDataFrame(px)
    got = {r.title_id: r for r in decide.decide(frames, boxes, stats, videos, 640, 360).collect()}
    plain = {r.title_id: r for r in decide.decide(frames, boxes, stats, videos, 640, 360, grow=False).collect()}
    assert got[2].error == "no person" and got[3].error == "no eligible person" and got[2].rect is None and got[3].kind is None
    a, b = plain[1].rect_sample, got[1].rect_sample
    assert a.x <= 480 and a.x + a.w >= 601 and a.y <= 220 and a.y + a.h >= 350
    assert b.x <= a.x and b.y <= a.y and b.x + b.w >= a.x + a.w and b.y + b.h >= a.y + a.h and b.w * b.h > a.w * a.h
    assert b.x >= 470 - 2 - 0.03 * b.w - 2 and got[1].method == "detected-crop" and got[1].confidence > 0.7
    assert all(abs(got[1].rect[c] - 2 * b[c]) <= 2 for c in "xywh") and got[1].kind == "corner-inset" and got[1].edge is None


def test_measured_windows(spark):
    rows = [(1, (0, 10, 100, 50), "side-panel"), (2, (500, 0, 140, 360), "side-panel"), (3, (500, 0, 10, 10), None), (4, (200, 0, 240, 360), "side-panel")]
    entries = spark.createDataFrame([(t, dict(zip("xywh", r, strict=True)), k, 640, 360) for t, r, k in rows], "title_id long, rect struct<x:int,y:int,w:int,h:int>, layout string, width int, height int")
    got = {r.title_id: r for r in decide.manual_decisions(entries).collect()}
    assert [(got[t].kind, got[t].edge, got[t].panel and tuple(got[t].panel)) for t in (1, 2, 3, 4)] == [
        ("side-panel", "left", (0, 0, 100, 360)), ("side-panel", "right", (500, 0, 140, 360)), ("corner-inset", None, None), ("side-panel", "left", (0, 0, 440, 360)),
    ]
    assert got[1].confidence == 1.0 and got[1].method == "manual-crop"
    none, size = F.lit(None).cast("struct<x:int,y:int,w:int,h:int>"), (F.lit(640), F.lit(360))
    main = lambda measured: one(spark, decide.main_picture(measured, rect(100, 0, 540, 360), rect(0, 0, 100, 360), *size))
    assert tuple(main(none).rect) == (100, 0, 540, 360) and tuple(main(rect(120, 0, 400, 300)).rect) == (120, 0, 400, 300)
    assert "outside" in main(rect(120, 0, 521, 300)).error and "overlaps" in main(rect(99, 0, 100, 300)).error and main(rect(99, 0, 1, 1)).rect is None
    grey = spark.createDataFrame([(1, f, y, x, (f * (10 if y < 2 else 90)) if x < 4 else 0) for f in range(3) for y in range(6) for x in range(8)], "title_id long, frame_idx long, y int, x int, v int")
    window = spark.createDataFrame([(1, {"x": 0, "y": 0, "w": 16, "h": 8})], "title_id long, rect struct<x:int,y:int,w:int,h:int>")
    motion = [r.motion for r in decide.crop_motion(grey, window, 0.5, 0.5).orderBy("frame_idx").collect()]
    assert motion == [None, 5.0, 5.0]  # half of the window's upper half moves by 10


def test_manifests_from_decisions(spark):
    import json

    frames, boxes, videos = scene(spark)
    stats = spark.createDataFrame([(1, 0, 0, 1.0, 999.0)], "title_id long, y int, x int, mean_grey double, temporal_var double")
    decided = decide.decide(frames, boxes, stats, videos, 640, 360).where("error is null")
    track = decide.signed_track(F.lit("ase"), F.lit("Sign"), F.lit("sign.mp4"), F.lit("none"))
    tracks = decided.select("title_id", F.lit(0).alias("nth"), track.alias("track"))
    named = {"publisher": "p", "url": "u", "licence": "l", "attribution": "a"}
    source = F.struct(*(F.lit(v).alias(k) for k, v in named.items()))
    asset = F.struct(F.lit("m.mp4").alias("url"), F.col("width"), F.col("height"), F.lit("h264").alias("codec"))
    titles = videos.select("title_id", F.concat(F.lit("title-"), "title_id").alias("id"), F.lit("T").alias("title"), F.lit(5).alias("durationMs"), source.alias("source"), F.struct(asset.alias("main"), F.lit("p.jpg").alias("poster")).alias("video"))
    caption = manifests.generated_caption(F.lit("verbatim"), F.lit("en"), F.lit("c.vtt"), F.lit("m"))
    made = manifests.build_manifests(titles, tracks, titles.select("title_id", F.lit(0).alias("nth"), caption.alias("caption")))
    rows = {r.title_id: json.loads(r.json) for r in made.collect()}
    assert list(rows[1]) == ["stmVersion", "id", "title", "durationMs", "source", "video", "signLanguage", "captions"]
    assert rows[1]["signLanguage"][0]["extraction"]["method"] == "detected-crop" and rows[2]["signLanguage"] == []
    assert "reviewedBy" not in rows[1]["captions"][0]
    assert manifests.validate(made.withColumnRenamed("title_id", "doc_id")).count() == 0


def test_sources(spark):
    s = spark.createDataFrame([("ok-id", " T ", "https://a.spam.org/x", "p", "l", "a"), ("Bad", "", "u", "p", "l", "a")], "id string, title string, url string, publisher string, licence string, attribution string")
    rows = {r.id: r for r in listing.with_defaults(s).collect()}
    assert rows["ok-id"].faults == [] and rows["ok-id"].title == "T" and rows["ok-id"].sign_language == "ase"
    assert len(rows["Bad"].faults) == 2
    assert [r.b for r in s.select(listing.is_blocked(F.col("url"), ("spam.org",)).alias("b")).collect()] == [True, False]


def test_addresses_durations_and_repeated_ids(spark):
    urls = ["s3://bucket/some/key.mp4", "s3://bucket", "s3://bucket//k", "s3:///key", "https://x.org/a", None]
    got = [r.v and tuple(r.v) for r in spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").select("i", tx.split_s3(F.col("u")).alias("v")).orderBy("i").collect()]
    assert got == [("bucket", "some/key.mp4"), ("bucket", ""), ("bucket", "k"), None, None, None]
    assert one(spark, tx.duration_ms(F.lit(1.0005))) == 1000 and one(spark, tx.duration_ms(F.lit(2.0))) == 2000
    entries = spark.createDataFrame([("a", []), ("b", ["x"]), ("a", ["y"]), (None, []), (None, [])], "id string, faults array<string>")
    rows = sorted((r.id or "", r.faults) for r in listing.with_repeat_faults(entries).collect())
    assert rows == [("", []), ("", []), ("a", ["id occurs twice"]), ("a", ["y", "id occurs twice"]), ("b", ["x"])]


def test_manifest_rules(spark):
    import json

    good = {
        "stmVersion": "0.2", "id": "a-title", "title": "T", "durationMs": 5,
        "source": {"publisher": "p", "url": "u", "licence": "l", "attribution": "a"},
        "video": {"main": {"url": "m.mp4", "width": 4, "height": 2, "codec": "h264"}, "poster": "p.jpg"},
        "signLanguage": [{"language": "ase", "languageLabel": "A", "provenance": "synthesised", "generatedBy": "g", "track": {"url": "t", "width": 1, "height": 1, "codec": "h264", "syncOffsetMs": 9000}}],
        "captions": [{"kind": "verbatim", "language": "en", "url": "c.vtt", "format": "webvtt", "generatedBy": "g", "reviewed": False}],
    }
    human = json.loads(json.dumps(good["signLanguage"][0])) | {
        "provenance": "human-interpreter",
        "extraction": {"method": "manual-crop", "sourceLayout": "side-panel", "confidence": 1, "cropRect": {"x": 0, "y": 0, "w": 1, "h": 5.0}, "fillMethod": "none"},
        "activity": {"intervalMs": 200, "scale": "title-p95", "values": [0, 100]},
    }
    del human["generatedBy"]
    human["track"]["syncOffsetMs"] = 0
    docs, expected = [], {}

    def case(paths, **changes):
        """A good document with members (by path, ``__`` between keys) replaced, or deleted (None)."""
        doc = json.loads(json.dumps(good | {"signLanguage": [human]}))
        for path, value in changes.items():
            *way, last = [int(k) if k.isdigit() else k for k in path.split("__")]
            at = doc
            for k in way:
                at = at[k]
            if value is None:
                del at[last]
            else:
                at[last] = value
        docs.append((len(docs), json.dumps(doc)))
        expected[len(docs) - 1] = paths

    case([])
    case(["$"], unknown=1)
    case(["$"], title=None)
    case(["title"], title=7)
    case(["stmVersion", "stmVersion"], stmVersion=0.2)
    case(["signLanguage/0"], stmVersion="0.1")
    case(["id"], id="A")
    case(["durationMs"], durationMs=50.5)
    case([], durationMs=5.0)
    case(["durationMs"], durationMs=True)
    case(["source", "source"], source__licence=None, source__x=1)
    case(["source/licence"], source__licence="")
    case(["source"], source="text")
    case(["video/main/codec", "video/main/width"], video__main__codec="nope", video__main__width=0)
    case(["signLanguage/0/track", "signLanguage/0/track/codec", "signLanguage/0/track/codec", "signLanguage/0/track/width"], signLanguage__0__track__more=1, signLanguage__0__track__codec=1, signLanguage__0__track__width=-4)
    case(["signLanguage/0/track"], signLanguage__0__track__syncOffsetMs=None)
    case(["signLanguage/0", "signLanguage/0", "signLanguage/0"], signLanguage__0__provenance=None)
    case(["signLanguage/0"], signLanguage__0__generatedBy="g")
    case(["signLanguage/0", "signLanguage/0"], signLanguage__0__provenance="synthesised")
    case(["signLanguage/0/extraction/confidence"], signLanguage__0__extraction__confidence=1.5)
    case(["signLanguage/0/extraction/cropRect/h", "signLanguage/0/extraction/cropRect/x"], signLanguage__0__extraction__cropRect__h=0, signLanguage__0__extraction__cropRect__x=-1)
    case(["signLanguage/0/activity/intervalMs", "signLanguage/0/activity/scale", "signLanguage/0/activity/values/1"], signLanguage__0__activity={"intervalMs": 100, "scale": "x", "values": [1, 101]})
    case(["signLanguage/0/activity/values"], signLanguage__0__activity__values=[])
    case(["signLanguage/0/activity", "signLanguage/0/activity/values/0"], signLanguage__0__activity={"intervalMs": 200, "values": ["7"]})
    case(["signLanguage"], signLanguage={"a": 1})
    case(["signLanguage/0"] * 3, signLanguage__0=5)
    case(["captions/0"], captions__0__reviewed=None)
    case(["captions/0"], captions__0__reviewed=True)
    case(["captions/0/reviewed"], captions__0__reviewedBy="Ann")
    case([], captions__0__reviewed=True, captions__0__reviewedBy="Ann")
    case(["captions/0/format", "captions/0/language"], captions__0__format="srt", captions__0__language="e")
    case(["signLanguage/1/language"], signLanguage=[human, human])
    case(["captions/1"], captions=[good["captions"][0]] * 2)
    case(["signLanguage/0/extraction/confidence", "signLanguage/0/track/syncOffsetMs"], signLanguage__0__extraction__confidence=0.5, signLanguage__0__track__syncOffsetMs=-5001)
    for text in ("{", None, "[1]", "7"):
        docs.append((len(docs), text))
        expected[len(docs) - 1] = ["$"]
    table = spark.createDataFrame(docs, "doc_id long, json string")
    issues = manifests.validate(table)
    got = {i: [] for i in expected}
    for r in issues.orderBy("doc_id", "nth").collect():
        got[r.doc_id].append(r.path)
    assert got == expected
    valid = {r.doc_id: (r.valid, r.warnings) for r in manifests.validity(table, issues).collect()}
    warned = 33
    assert valid == {i: (not p or i == warned, 2 * (i == warned)) for i, p in expected.items()}
    assert not manifests.validity(table, issues, strict=True).where(f"doc_id = {warned}").first().valid
    assert manifests.validate(table.limit(0)).count() == 0


def test_manifests_are_judged_in_their_rows(spark):
    """No row a node, nothing shuffled or joined; a key with a dot is not another place's."""
    table = spark.createDataFrame([(1, '{"titles": [], "stmVersion": "0.2", "titles[]": 5}'), (2, '{"stmVersion": "0.2", "titles": [], "it\'s": 1}')], "doc_id long, json string")
    found = manifests.validate_catalogues(table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert sorted((r.doc_id, r.path, r.message) for r in found.collect()) == [(1, "$", "unknown keys"), (2, "$", "unknown keys")]


def test_catalogue_rules(spark):
    import json

    entry = {"id": "a-title", "title": "T", "durationMs": 1, "poster": "p", "manifestUrl": "u", "signLanguages": ["ase"], "confidence": 0.5}
    rows = [
        {"stmVersion": "0.2", "titles": [entry]},
        {"stmVersion": "0.2", "titles": [entry, entry | {"id": "b-title"}, entry]},
        {"stmVersion": "0.3", "titles": [entry | {"poster": "", "x": 1, "signLanguages": ["as"], "confidence": 2}]},
        {"titles": []},
    ]
    docs = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "doc_id long, json string")
    got = [(r.doc_id, r.path) for r in manifests.validate_catalogues(docs).orderBy("doc_id", "nth").collect()]
    assert got == [(1, "titles/2/id"), (2, "stmVersion"), (2, "titles/0"), (2, "titles/0/confidence"), (2, "titles/0/poster"), (2, "titles/0/signLanguages/0"), (3, "$")]


def test_generated_captions_are_never_reviewed(spark):
    c = manifests.generated_caption(F.lit("verbatim"), F.lit("en"), F.lit("u"), F.lit("m"))
    assert one(spark, c).reviewed is False
    assert one(spark, manifests.mark_reviewed(c, "Ann")).reviewedBy == "Ann"
    with pytest.raises(Exception, match="names its generator"):
        one(spark, manifests.generated_caption(F.lit("verbatim"), F.lit("en"), F.lit("u"), F.lit(" ")))


def test_sobel_against_numpy(spark):
    rng = np.random.default_rng(1)
    image = rng.integers(0, 255, (5, 6))
    df = spark.createDataFrame(pd.DataFrame([(1, y, x, float(image[y, x])) for y in range(5) for x in range(6)], columns=["title_id", "y", "x", "mean_grey"]))
    p = np.pad(image.astype(float), 1, mode="reflect")
    k = np.array([[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]])
    for r in pixels.sobel_detail(df).collect():
        w = p[r.y : r.y + 3, r.x : r.x + 3]
        assert r.gradient == pytest.approx(np.hypot((w * k).sum(), (w * k.T).sum()))


def test_scores_and_triage(spark):
    from cuegrid.operators import harness

    r = "struct<x:int,y:int,w:int,h:int>"
    truth = spark.createDataFrame([("a", (0, 0, 10, 10), None), ("b", (0, 0, 10, 10), (8, 8, 4, 4)), ("c", (0, 0, 4, 4), None)], f"clip string, rect {r}, face {r}")
    found = spark.createDataFrame([("a", (0, 0, 10, 10), 0.9, None), ("b", (0, 0, 10, 10), 0.9, None)], f"clip string, found {r}, confidence double, error string")
    scores = harness.score_clips(truth, found)
    assert {x.clip: (x.iou, x.passed) for x in scores.collect()} == {"a": (1.0, True), "b": (1.0, False), "c": (0.0, False)}
    s = harness.summary(scores).first()
    assert (s.clips, s.passed) == (3, 1) and s.mean_iou == pytest.approx(2 / 3)
    again = harness.upsert(truth, truth.where("clip = 'a'").withColumn("face", F.col("rect")), "clip")
    assert again.count() == 3 and again.where("clip = 'a' and face is not null").count() == 1
    clips = spark.createDataFrame(
        [("p", None, "side-panel", 0.1, 99.0, 99.0), ("q", None, "corner-inset", 0.9, 12.0, 8.0), ("r", None, "corner-inset", 0.9, 36.0, 60.0), ("s", "boom", None, None, None, None)],
        "clip string, error string, layout string, confidence double, detail double, motion double",
    )
    t = harness.triage(clips)
    assert {x.clip: x.verdict for x in t.collect()} == {"p": "excellent", "q": "good", "r": "poor", "s": "unusable"}
    assert harness.useful(t).first().useful == 2
    assert all(len(x.line) == 28 + 1 + 10 + 1 + 6 + 1 + 6 for x in t.select(harness.triage_line().alias("line")).collect())
    assert one(spark, harness.source_skeleton(F.lit("a/My Clip_1.mp4"), F.lit(0.5))).startswith("- id: my-clip-1\n")


def test_cues_of_whole_turns(spark, tmp_path):
    rng = random.Random(4)
    line = lambda: " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(1, 40)))
    turns = [(1, i, "user", "\n".join(line() for _ in range(rng.randrange(1, 5)))) for i in range(8)]
    turns += [(2, 0, "system", "a\n\n \t\nb\r\nc --> d"), (2, 1, "user", None)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    whole = {(c, t + 1): x for c, t, _, x in turns} | {(2, 1): "a\nb\nc --> d", (2, 2): ""}
    assert max(map(len, whole.values())) > 300
    got = lambda name: {(r.title_id, r["index"]): r for r in catalogue.queries()[name](spark, str(tmp_path)).collect()}

    def broken(t):
        at = min((max(i, len(t) - i - 1), abs(i - len(t) // 2), i) for i, c in enumerate(t) if c == " ")[2] if len(t) > 42 and " " in t else None
        return t if at is None else t[:at] + "\n" + t[at + 1 :]

    flat = {k: x.replace("\n", " ") for k, x in whole.items()}
    breaks = got("whole_cue_line_break")
    assert {k: r.broken for k, r in breaks.items()} == {k: broken(x) for k, x in flat.items()}
    assert {k: r.fits for k, r in breaks.items()} == {k: all(len(y) <= 42 for y in broken(x).split("\n")) for k, x in flat.items()}
    assert {k: r.text for k, r in got("whole_vtt_parse_roundtrip").items()} == whole
    assert {k: r.line.split("words) ", 1)[1] for k, r in got("whole_word_budget").items()} == {k: x.strip() for k, x in flat.items()}
    assert {k: r.text for k, r in got("whole_rewrite_merge").items() if not r.rewritten} == {k: x for k, x in whole.items() if k[1] % 4 == 0}
    files = {r.title_id: r.text for r in catalogue.queries()["whole_vtt_build"](spark, str(tmp_path)).collect()}
    assert all(x in files[k[0]] for k, x in whole.items())


def said_of(words, rng, loss=0.15):
    """What a recogniser makes of words: some lost, some other words, some repeated."""
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < loss / 2 else [rng.choice("abcdefgh")] if x < loss else [w, w] if x < loss * 1.2 else [w]
    return out


def word_tables(spark, titles):
    report = [(t, i, e, n) for t, (a, _) in titles.items() for i, (e, n) in enumerate(a)]
    heard = [(t, i, n, i * 0.5, i * 0.5 + 0.4, n) for t, (_, b) in titles.items() for i, n in enumerate(b)]
    return (
        spark.createDataFrame(report, "title_id long, pos long, is_event boolean, norm string"),
        spark.createDataFrame(heard, "title_id long, pos long, text string, start double, end double, norm string"),
    )


def test_increasing_chain():
    rng = random.Random(3)
    for _ in range(200):
        xs, ys = rng.sample(range(12), 6), rng.sample(range(12), 6)
        points = list(zip(xs, ys, strict=True))
        best = {}
        for x, y in sorted(points):
            best[x, y] = 1 + max((n for (a, b), n in best.items() if a < x and b < y), default=0)
        got = align.increasing_chain(points)
        assert len(got) == max(best.values()) and all(p in points for p in got)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:], strict=False))
    assert align.increasing_chain([]) == []


def test_long_titles_are_matched_in_segments(spark):
    rng = random.Random(12)
    titles = {}
    for t in range(4):
        words = [f"w{min(rng.randint(0, 300), rng.randint(0, 300))}" for _ in range(rng.randint(400, 900))]
        report = [(rng.random() < 0.02, "" if rng.random() < 0.03 else w) for w in words]
        titles[t] = (report, said_of(words, rng))
    titles[7] = ([(False, "only")] * 700, ["only"] * 500)  # nothing stands alone: one segment
    titles[8] = ([(False, f"u{i}") for i in range(300)], [])
    report, heard = word_tables(spark, titles)
    whole = align.match_words(report, heard)
    cut = align.match_words(report, heard, 40)
    places = align.cuts(report, heard.selectExpr("title_id said_title", "pos at", "norm said_norm"), 40).where("cut is not null and side = 0")
    per_title = {r.title_id: r.n for r in places.groupBy("title_id").agg(F.count("*").alias("n")).collect()}
    assert set(per_title) == {0, 1, 2, 3} and min(per_title.values()) >= 4
    count = lambda df: {r.title_id: r.n for r in df.groupBy("title_id").agg(F.count("*").alias("n")).collect()}
    best, got = count(whole), count(cut)
    assert set(best) == {0, 1, 2, 3, 7} and best[7] == 500 == got[7]
    assert all(0.99 * best[t] <= got[t] <= best[t] for t in best)
    for t, (mine, theirs) in titles.items():
        pairs = sorted((r.pos, round(r.said_start / 0.5)) for r in cut.where(F.col("title_id") == t).collect())
        assert all(not mine[i][0] and mine[i][1] == theirs[j] != "" for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:], strict=False))


def test_a_title_of_many_words(spark):
    """200,000 words, of which one task meets a segment at a time."""
    n = 200_000
    word = lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64(k), F.lit(5000)).cast("string"))
    report = spark.range(n).select(F.lit(1).cast("long").alias("title_id"), F.col("id").alias("pos"), F.lit(False).alias("is_event"), word(F.col("id")).alias("norm"))
    heard = spark.range(n).where("id % 10 <> 3").select("id", word(F.col("id")).alias("norm"))
    at = F.col("id") - F.floor((F.col("id") + 6) / 10)
    heard = heard.select(F.lit(1).cast("long").alias("title_id"), at.alias("pos"), F.col("norm").alias("text"), F.col("id").cast("double").alias("start"), (F.col("id") + 0.5).alias("end"), "norm")
    found = align.match_words(report, heard)
    assert found.count() == n * 9 // 10
    assert found.where("pos = said_start").count() > 0.998 * n * 9 // 10


def grown_on_a_dense_image(rect, px, size, band=2, max_var=40.0, max_step=6.0):
    """The plain twin of window growth: means over the pixels of each band."""
    fw, fh = size
    var, grey = np.full((fh, fw), np.inf), np.zeros((fh, fw))
    for yy, xx, v, m in px:
        var[yy, xx], grey[yy, xx] = v, m
    x, y, w, h = rect
    edges = [x, x + w, y, y + h]
    reach_x, reach_y = min(int(w * 1.5), int(max(0.0, 0.6 * fw - w) / 2)), int(h * 1.5)
    ends = [max(0, x - reach_x), min(fw, x + w + reach_x), max(0, y - reach_y), min(fh, y + h + reach_y)]
    last, moved = [None] * 4, True
    while moved:
        moved = False
        for e in range(4):
            way = -1 if e % 2 == 0 else 1
            to = edges[e] + way * band
            if (to < ends[e]) if way < 0 else (to > ends[e]):
                continue
            lo, hi = sorted((edges[e], to))
            part = (slice(edges[2], edges[3]), slice(lo, hi)) if e < 2 else (slice(lo, hi), slice(edges[0], edges[1]))
            v, g_ = var[part], grey[part]
            if not v.size or v.mean() > max_var or (last[e] is not None and abs(g_.mean() - last[e]) > max_step):
                continue
            last[e], edges[e], moved = float(g_.mean()), to, True
    x0, y0 = edges[0] - edges[0] % 2, edges[2] - edges[2] % 2
    w0, h0 = edges[1] - x0, edges[3] - y0
    return (x0, y0, max(2, w0 - w0 % 2), max(2, h0 - h0 % 2))


@pytest.mark.parametrize("band,sized", [(2, False), (3, True)])
def test_window_growth_equals_a_dense_image(spark, band, sized):
    rng = random.Random(band)
    rects, px, want = [], [], {}
    for t in range(40):
        fw, fh = rng.randint(12, 40), rng.randint(10, 30)
        noisy = [(rng.randint(0, fw), rng.randint(0, fh), rng.randint(1, 8), rng.randint(1, 8)) for _ in range(3)]
        own = []
        for yy in range(fh):
            for xx in range(fw):
                loud = any(a <= xx < a + c and b <= yy < b + d for a, b, c, d in noisy)
                own.append((yy, xx, 300.0 if loud else float(rng.randint(0, 30)), float(80 + xx // 9 * 4 + (yy > fh - 4) * 30)))
        w, h = rng.randint(1, 10), rng.randint(1, 8)
        r = (rng.randint(0, fw - w), rng.randint(0, fh - h), w, h)
        size = (44, 32) if sized else (fw, fh)
        want[t] = grown_on_a_dense_image(r, own, size, band)
        rects.append((t, *r))
        px += [(t, *p) for p in own]
    rects.append((99, 1, 2, 4, 4))  # no pixels
    want[99] = grown_on_a_dense_image((1, 2, 4, 4), [], (44, 32) if sized else (0, 0), band)
    found = pixels.grow_windows(
        spark.createDataFrame(rects, "title_id long, x int, y int, w int, h int"),
        spark.createDataFrame(px, "title_id long, y int, x int, temporal_var double, mean_grey double"), band, size=(44, 32) if sized else None,
    )
    assert {r.title_id: (r.x, r.y, r.w, r.h) for r in found.collect()} == want
    assert len({(w[2], w[3]) for w in want.values()}) > 5


def test_bands_by_corner_sums(spark):
    rng = np.random.default_rng(4)
    v, m = rng.integers(0, 50, (6, 9)).astype(float), rng.integers(0, 255, (6, 9)).astype(float)
    px = [(1, y, x, float(v[y, x]), float(m[y, x])) for y in range(6) for x in range(9)]
    stats = spark.createDataFrame(px, "title_id long, y int, x int, temporal_var double, mean_grey double")
    bands = [(1, 0, 0, 0, 2, 6), (1, 1, 3, 2, 4, 3), (1, 2, -2, -3, 5, 5), (1, 3, 7, 4, 9, 9), (1, 4, 2, 2, 0, 3), (1, 5, 20, 20, 3, 3), (2, 6, 0, 0, 2, 2)]
    got = {r.band: (r.variance, r.grey) for r in pixels.band_stats(stats, spark.createDataFrame(bands, "title_id long, band int, x int, y int, w int, h int")).collect()}
    for t, b, x, y, w, h in bands:
        part = (slice(max(0, y), max(0, y + h)), slice(max(0, x), max(0, x + w)))
        if t == 2 or not v[part].size:
            assert got[b] == (None, None)
        else:
            assert got[b] == pytest.approx((v[part].mean(), m[part].mean()))
    accepts = lambda a, b, c: one(spark, pixels.accepts_band(*(F.lit(x).cast("double") for x in (a, b, c))))
    assert accepts(40, 5, None) and accepts(1, 5, 11) and not accepts(41, 5, 5) and not accepts(1, 5, 11.5) and not accepts(None, 5, 5)


def test_one_pass_analysis(spark):
    from cuegrid.operators import analysis

    rng = np.random.default_rng(8)
    images = {(t, f * 3): rng.integers(0, 255, (6, 8)) for t in (1, 2) for f in range(5)}
    images[3, 7] = rng.integers(0, 255, (6, 8))
    frames = spark.createDataFrame([(t, f, 8, i.ravel().tolist()) for (t, f), i in images.items()], "title_id long, frame_idx long, width int, pixels array<int>")
    listed = [(1, f * 3, b, 1.2 + b, 0.5, 5.5 + b, 5.0) for f in range(5) for b in range(2)] + [(2, 3, 0, -3.0, -2.0, 2.5, 3.0), (2, 3, 1, 4.0, 4.0, 4.0, 9.0), (3, 7, 0, 0.0, 0.0, 4.0, 4.0), (9, 0, 0, 0.0, 0.0, 1.0, 1.0)]
    boxes = spark.createDataFrame(listed, "title_id long, frame_idx long, box_no long, x1 double, y1 double, x2 double, y2 double")
    made = analysis.analyse(frames, boxes)
    got = {(r.title_id, r.y, r.x): (r.mean_grey, r.temporal_var, r.frames) for r in analysis.pixel_table(made).collect()}
    assert len(got) == 3 * 48
    for t in (1, 2):
        stack = np.array([images[t, f * 3] for f in range(5)])
        for y in range(6):
            for x in range(8):
                assert got[t, y, x] == pytest.approx((stack[:, y, x].mean(), stack[:, y, x].var(ddof=1), 5))
    assert got[3, 0, 0] == (images[3, 7][0, 0], 0.0, 1)
    moved = {(t, f): np.abs(i - images[t, f - 3]) for (t, f), i in images.items() if (t, f - 3) in images}
    motion = {(r.title_id, r.frame_idx): r.frame_motion for r in analysis.frame_table(made).collect()}
    assert set(motion) == set(images) and all(motion[k] == (pytest.approx(moved[k].mean()) if k in moved else None) for k in images)
    rows = analysis.with_box_motion(boxes, made).collect()
    assert len(rows) == len(listed)
    for r in rows:
        d = moved.get((r.title_id, r.frame_idx))
        y1, y2, x1, x2 = int(np.floor(r.y1)), int(np.ceil(r.y1 + 0.6 * (r.y2 - r.y1))), int(np.floor(r.x1)), int(np.ceil(r.x2))
        part = d[max(y1, 0) : max(y2, 0), max(x1, 0) : max(x2, 0)] if d is not None else np.empty(0)
        assert r.motion == (pytest.approx(part.mean()) if part.size else None)
    # states of parts merge to those of the whole
    early, late = (analysis.analyse(frames.where(c), boxes).where("kind = 'pixel'") for c in ("frame_idx < 6", "frame_idx >= 6"))
    both = {tuple(r[:3]): r[3:] for r in analysis.merge_states(early.union(late), ["title_id", "y", "x"]).collect()}
    assert all(both[r.title_id, r.y, r.x] == pytest.approx((r.n, r["mean"], r.m2), abs=1e-6) for r in made.where("kind = 'pixel'").collect())
    assert analysis.analyse(frames.limit(0), boxes).count() == 0


def test_scenes_are_decided_and_published(spark, tmp_path):
    """Titles from frames to manifests, on scenes of known kinds."""
    from cuegrid.plans import adapters as ad

    rng = np.random.default_rng(3)
    rows = [(i, int(i % 10), rng.uniform(-1, 1, 64).astype(float).tolist()) for i in range(40 * 9)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    run = lambda name: catalogue.queries()[name](spark, str(tmp_path))
    fixed = {r.title_id: r for r in run("decide_fixed").collect()}
    grown = {r.title_id: r for r in run("decide_titles").collect()}
    assert set(fixed) == set(grown) == set(range(40))
    larger = 0
    for t in range(40):
        a, b = fixed[t], grown[t]
        assert a.error == b.error == {0: "no person", 1: "no eligible person"}.get(t % 8)
        if a.error:
            assert a.x is None and b.rect is None and b.kind is None
            continue
        assert (a.kind, a.edge) == (("side-panel", "right") if t % 8 in (2, 3) else ("corner-inset", None))
        assert b.rect.x <= 20 * a.x and b.rect.x + b.rect.w >= 20 * (a.x + a.w) and b.rect.y <= 20 * a.y
        larger += b.rect.w * b.rect.h > 1.2 * 400 * a.w * a.h
        assert b.kind != "side-panel" or b.panel.h == 20 * ad.SIDE
    assert larger >= 25
    made = run("publish_titles").first()
    assert (made.titles, made.published, made.errors) == (40, 30, 0)


def test_character_references(spark):
    import html
    import html.entities

    rng = random.Random(1)
    bits = ["&", "&#", "&#x", ";", "amp", "lt", "&notit;", "&amp;lt;", "&#x2019;", "&#233;", "&#128;", "&#0;", "&#xD800;", "&#99999999999;", "&#x110000;", "&#13;", "&#1;", "&#xFFFE;", " ", "a", "é", "#", "&copy", "&COPY;x", "&#x1F600;", "\n", "&#000065;"]
    names = list(html.entities.html5)
    texts = ["".join(rng.choice(bits) if rng.random() < 0.7 else "&" + rng.choice(names) for _ in range(rng.randint(0, 8))) for _ in range(1500)] + ["&" + n + "x" for n in names]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.unescape(F.col("t")).alias("u")).collect()
    assert all(r.u == html.unescape(r.t) for r in got)
    assert one(spark, tx.unescape(F.lit(None).cast("string"))) is None
    assert one(spark, tx.clean_html(F.lit("<p>a &lt;b&gt;&nbsp;&rarr;&Eacute;&nbsp;</p>"))) == "a <b> →É"


def test_json_files(spark):
    import json

    from pyspark.sql import types as T

    from cuegrid.functions.json_text import json_document

    schema = "id string, n int, f double, ok boolean, empty array<int>, list array<string>, inner struct<a: string, b: struct<c: bigint>>, rows array<struct<x: int, y: double>>"
    rows = [
        {"id": 'q"\\/\n\t\x01\x1f\x7fé日😀 ', "n": -3, "f": 0.12346, "ok": True, "empty": [], "list": ["a", None, ""], "inner": {"a": None, "b": {"c": 2**40}}, "rows": [{"x": 1, "y": 1.0}, {"x": None, "y": 0.0001}]},
        {"id": None, "n": None, "f": 100.0, "ok": False, "empty": None, "list": None, "inner": {"a": None, "b": None}, "rows": [{"x": None, "y": None}]},
    ]

    def plain(v):
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items() if x is not None}
        return [plain(x) for x in v] if isinstance(v, list) else round(v, 4) if isinstance(v, float) else v

    table = spark.createDataFrame(rows, schema)
    kind = T.DataType.fromDDL(schema)
    got = [r.j for r in table.select(json_document(F.struct("*"), kind).alias("j")).collect()]
    assert got == [json.dumps(plain(r), indent=2, ensure_ascii=False) + "\n" for r in rows]


def test_manifest_files(spark):
    import json

    doc = {
        "stmVersion": "0.2", "id": "a-title", "title": "Ä \"quoted\"", "durationMs": 5,
        "source": {"publisher": "p", "url": "u", "licence": "l", "attribution": "a"},
        "video": {"main": {"url": "m.mp4", "width": 4, "height": 2, "codec": "h264"}, "poster": "p.jpg"},
        "signLanguage": [{"language": "ase", "languageLabel": "A", "provenance": "human-interpreter",
                          "extraction": {"method": "detected-crop", "sourceLayout": "corner-inset", "confidence": 0.87654321, "cropRect": {"x": 0, "y": 0, "w": 2, "h": 2}, "fillMethod": "none"},
                          "track": {"url": "t", "width": 1, "height": 1, "codec": "h264", "syncOffsetMs": 0}, "activity": {"intervalMs": 200, "scale": "title-p95", "values": [0, 100]}}],
        "captions": [],
    }
    parsed = manifests.parse_manifests(spark.createDataFrame([(1, json.dumps(doc))], "doc_id long, json string"))
    text = parsed.select(manifests.manifest_text(F.col("m")).alias("t")).first().t
    doc["signLanguage"][0]["extraction"]["confidence"] = 0.8765
    assert text == json.dumps(doc, indent=2, ensure_ascii=False) + "\n"
    again = manifests.validate(spark.createDataFrame([(1, text)], "doc_id long, json string"))
    assert again.count() == 0


def test_written_rows_and_tables(spark):
    from cuegrid.operators import reports

    rect_ = {"x": 0, "y": 0, "w": 2, "h": 4}
    clips = spark.createDataFrame(
        [("a/very/long/" + "n" * 40 + ".mp4", None, "side-panel", "right", 0.75, 15.26, 3592.46, 0.0, "excellent", 1, 640, 360, 61.5, 0.2, rect_), ("b.mp4", "OSError: no", None, None, None, None, None, None, "unusable", 5, 0, 0, None, None, None), ("c.mp4", None, "corner-inset", None, 0.125, 1.0, 2.0, 0.12345, "good", 2, 64, 36, 5.0, 0.25, rect_)],
        "clip string, error string, layout string, edge string, confidence double, detail double, motion double, difficulty double, verdict string, rank int, width int, height int, duration_s double, size_frac double, rect struct<x:int,y:int,w:int,h:int>",
    )
    lines = [r.line for r in reports.triage_lines(clips).orderBy("place").collect()]
    want = [
        f"{'n' * 30:30} {'excellent':10} {'side-panel/right':13} {0.0:5.2f} {0.75:5.2f} {0.2:5.2f} {15.26:7.1f} {3592.46:7.1f} {61.5:6.0f}s",
        f"{'c.mp4':30} {'good':10} {'corner-inset':13} {0.12345:5.2f} {0.125:5.2f} {0.25:5.2f} {1:7.1f} {2:7.1f} {5:6.0f}s",
        f"{'b.mp4':30} {'unusable':10} OSError: no",
    ]
    assert lines == want
    rows = {r.clip: r for r in reports.triage_rows(clips).collect()}
    assert rows["c.mp4"].fillDifficulty == 0.123 and rows["c.mp4"].resolution == "64x36" and rows["b.mp4"].resolution is None
    scores = spark.createDataFrame([("x" * 45, 0.98765, True, None, None, None, 2.06, None), ("y", 0.0, False, False, 0.9, "side-panel", 1.0, "gone")], "clip string, iou double, passed boolean, face_contained boolean, confidence double, layout string, seconds double, error string")
    got = {r.clip[0]: r.line for r in reports.score_lines(scores).collect()}
    assert got["x"] == f"{'…' + 'x' * 39:40} {0.98765:6.3f} {'ok':>5} {'-':>5} {'-':>5} {'-':13} {2.06:6.1f}"
    assert got["y"] == f"{'y':40} {0.0:6.3f} {'FAIL':>5} {'NO':>5} 0.90 {'side-panel':13} {1.0:6.1f}  gone".replace(" 0.90", f" {'0.90':>5}")
    assert {r.iou for r in reports.score_rows(scores).collect()} == {0.9876, 0.0} or {r.iou for r in reports.score_rows(scores).collect()} == {0.9877, 0.0}
    features = spark.createDataFrame(
        [(1, 0, 7, [1.25, 2.0, 3.04, 4.0], 0.56789, 0.012345, 0.5, 0.1, None, 0.0, 0.61, True, "ok"), (1, 1, 2, [0.0] * 4, 0.1, 0.0, 1.0, 0.6, 12.3456, 1.0, 0.3, False, "too brief; too large")],
        "title_id long, cluster_id int, n_boxes long, mean_box array<double>, persistence double, centre_std double, stability double, size_frac double, motion_ratio double, motion_score double, score double, eligible boolean, reason string",
    )
    ranked = detections.rank_clusters(features)
    lines = [r.line for r in reports.cluster_lines(ranked, detections.choose_signer(features.withColumn("confidence", F.lit(1.0)))).orderBy("rank").collect()]
    assert lines == [f"{'*':2}{0:>3} {7:>6} {0.56789:7.2f} {0.5:6.2f} {0.1:5.2f}    n/a {0.61:5.2f}  ok", f"{' ':2}{1:>3} {2:>6} {0.1:7.2f} {1.0:6.2f} {0.6:5.2f} {12.3456:7.2f} {0.3:5.2f}  too brief; too large"]
    assert reports.cluster_rows(features).orderBy("clusterId").first().meanBox == [1.2, 2.0, 3.0, 4.0]
    track = spark.createDataFrame([(1, b, 10 * b, 1.23456) for b in range(4)], "title_id long, bucket int, level int, top double")
    assert tuple(reports.activity_rows(track, 500).first()) == (1, 500, "title-p95", 4, 1.235, 0.5)
    assert one(spark, reports.generated_by("speech", F.lit("small"))) == "faster-whisper-small" and one(spark, reports.generated_by("rewrite", F.lit("m"))) == "amazon-bedrock:m"


def test_an_empty_strong_element_is_no_speaker(spark):
    page = '<p id="orscontributions_1"><strong> </strong>Not a name</p><p>lost</p><p id="orscontributions_2"><strong>Ann</strong></p><p>kept</p><p id="orscontributions_3">Bob</p><p>too</p>'
    got = transcript.contributions(spark.createDataFrame([(1, page)], "page_id long, html string")).collect()
    assert sorted((r.speaker, tuple(r.paragraphs)) for r in got) == [("Ann", ("kept",)), ("Bob", ("too",))]


def test_list_files(spark, tmp_path):
    from cuegrid.sources.lists import ListFiles

    spark.dataSource.register(ListFiles)
    entry = "- {id: %s, title: T, url: u, publisher: p, licence: l, attribution: a, crop_rect: {x: 1, y: 2, w: 3, h: 4}, layout: side-panel}\n"
    (tmp_path / "a.yaml").write_text("sources:\n" + entry % "one" + entry % "two")
    (tmp_path / "b.yaml").write_text("sources:\n" + entry % "one")
    read = lambda name, kind="sources": spark.read.format("cue-lists").option("kind", kind).load(str(tmp_path / name))
    both = read("*.yaml")
    assert both.rdd.getNumPartitions() == 2
    rows = sorted((r.file[-6:], r.pos, r.id, r.title, tuple(r.crop_rect), r.main_rect) for r in both.collect())
    assert rows == [("a.yaml", 0, "one", "T", (1, 2, 3, 4), None), ("a.yaml", 1, "two", "T", (1, 2, 3, 4), None), ("b.yaml", 0, "one", "T", (1, 2, 3, 4), None)]
    assert all(not r.faults for r in listing.with_defaults(both).collect())
    (tmp_path / "c.yml").write_text("sources:\n" + entry % "two" + entry % "two")
    (tmp_path / "d.yml").write_text("sources: {id: x}")
    (tmp_path / "e.yml").write_text("clips:\n- {clip: sub/x.mp4, rect: {x: 0, y: 0, w: 2, h: 2}, face: {x: 0, y: 0, w: 1, h: 1}, notes: 7}\n- {clip: /abs/y.mp4, rect: {x: 0, y: 0, w: 2, h: 2}}")
    (tmp_path / "f.yml").write_text("other: 1")
    for name, message in (("c.yml", "two occurs twice"), ("d.yml", "must be a list"), ("f.yml", "must be a list")):
        with pytest.raises(Exception, match=message):
            read(name).collect()
    clips = read("e.yml", "clips").orderBy("pos").collect()
    assert [(r.clip, r.face and tuple(r.face), r.notes) for r in clips] == [(f"{tmp_path}/sub/x.mp4", (0, 0, 1, 1), "7"), ("/abs/y.mp4", None, None)]
    assert read("f.yml", "clips").count() == 0


def test_results_are_computed_once(spark, tmp_path):
    from cuegrid.operators.incremental import outdated, update_results

    path, computed = str(tmp_path / "results"), []

    def compute(rows):
        computed.append(sorted(r.id for r in rows.collect()))
        return rows.select("id", F.upper("text").alias("made"))

    table = lambda rows: spark.createDataFrame(rows, "id long, text string")
    run = lambda rows: update_results(table(rows), compute, "id", F.sha2("text", 256), path, buckets=4)
    held = lambda: {r.id: r.made for r in spark.read.parquet(path).collect()}
    first = [(i, f"t{i}") for i in range(20)]
    assert run(first) == 20 and held() == {i: f"T{i}" for i in range(20)}
    files = set((tmp_path / "results").rglob("*.parquet"))
    assert run(first) == 0 and set((tmp_path / "results").rglob("*.parquet")) == files
    assert outdated(table(first), "id", F.sha2("text", 256), path).count() == 0
    assert run([(3, "new"), (4, "t4"), (99, "more")]) == 2 and computed[-1] == [3, 99]
    assert held() == {i: f"T{i}" for i in range(20)} | {3: "NEW", 99: "MORE"}
    kept = files & set((tmp_path / "results").rglob("*.parquet"))
    assert kept and len({f.parent for f in kept}) >= 2  # untouched buckets stay as they are
    assert [p.name for p in tmp_path.iterdir()] == ["results"]


def test_parts_are_tracked_apart(spark):
    rng, rows = random.Random(14), []
    spots = [(x, y) for x in (0, 100, 200) for y in (0, 150)] + [(230, 170)]
    for f in range(30):
        for b, (x, y) in enumerate(rng.sample(spots, rng.randint(0, len(spots)))):
            x, y = x + rng.uniform(0, 30), y + rng.uniform(0, 30)
            rows.append((f, b, (x, y, x + rng.uniform(20, 40), y + rng.uniform(20, 50))))
    df = spark.createDataFrame([(t, f, b, *box, 1.0) for t in (7, 8) for f, b, box in rows], "title_id long, frame_idx long, box_no long, x1 double, y1 double, x2 double, y2 double, motion double")
    parts = detections.overlap_groups(df)
    assert parts.select("title_id", "part").distinct().count() == 2 * 6
    want = naive_tracks(rows)
    for t in (7, 8):
        assert {(r.frame_idx, r.box_no): r.cluster_id for r in detections.cluster_detections(df).where(F.col("title_id") == t).collect()} == want


def test_a_frame_of_one_box_is_taken_like_any_frame():
    rng = np.random.default_rng(5)
    boxes = rng.integers(0, 30, (400, 4)) / 4  # ties, empty and turned boxes
    boxes[:, 2:] += boxes[:, :2] * (rng.random((400, 1)) < 0.9)
    boxes[7, 0], boxes[30] = np.nan, boxes[29]
    whole, one = detections.OpenClusters(), detections.OpenClusters()
    for box in boxes:
        assert whole.take(box[None], 0.3, 0.2)[0] == one.take_one(box, 0.3, 0.2)
    assert 64 < one.n < 400 and np.array_equal(whole.boxes, one.boxes, equal_nan=True)


@pytest.mark.parametrize("block, abreast, crowd, batch", [(1 << 17, 512, 8, 10_000), (60, 3, 1, 7), (7, 512, 2, 1000)])
def test_tracks_side_by_side_equal_tracks_alone(monkeypatch, block, abreast, crowd, batch):
    import pyarrow as pa

    for name, value in (("BLOCK", block), ("ABREAST", abreast), ("CROWD", crowd)):
        monkeypatch.setattr(detections, name, value)
    rng = np.random.default_rng(4)
    rows = [(t // 2, t % 2, f, b) for t in range(14) for f in range((1, 5, 90, 30)[t % 4]) for b in range(1 if f % 6 else rng.integers(1, 12))]
    pdf = pd.DataFrame(rows, columns=["title_id", "cut", "frame_idx", "box_no"])
    boxes = rng.integers(0, 40, (len(pdf), 4)) / 4  # ties, empty and turned boxes
    boxes[:, 2:] += boxes[:, :2] * (rng.random((len(pdf), 1)) < 0.9)
    boxes[7, 0], boxes[30] = np.nan, boxes[29]
    pdf = pdf.assign(**dict(zip(("x1", "y1", "x2", "y2"), boxes.T, strict=True)))
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    got = pa.Table.from_batches(detections.track_sorted(table.to_batches(max_chunksize=batch), ("title_id", "cut"), 0.3, 0.2)).to_pandas()
    assert got[["title_id", "cut", "frame_idx", "box_no"]].equals(pdf[["title_id", "cut", "frame_idx", "box_no"]])
    for _, track in got.groupby(["title_id", "cut"]):
        alone = detections.track_frames(track.drop(columns="own"), detections.OpenClusters(), 0.3, 0.2)
        assert track.own.tolist() == alone.cluster_id.tolist()
        opened = alone.groupby("cluster_id")[["frame_idx", "box_no"]].transform("first")
        assert track[["first_frame", "first_box"]].to_numpy().tolist() == opened.to_numpy().tolist()


def test_frames_of_one_box_are_not_taken_one_by_one(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(detections.OpenClusters, "take_one", None)
    table = pa.table({"title_id": np.repeat(np.arange(30), 40), "frame_idx": np.tile(np.arange(40), 30), "box_no": np.zeros(1200, int), **{c: np.full(1200, v) for c, v in (("x1", 0.0), ("y1", 0.0), ("x2", 9.0), ("y2", 9.0))}})
    (made,) = detections.track_sorted(table.to_batches(), ("title_id",), 0.3, 0.2)
    assert made.num_rows == 1200 and set(made["own"].to_pylist()) == {0}


def test_tracking_makes_no_group_a_title(spark):
    frame = spark.createDataFrame([(None if t == 2 else t, f, 0, 1.0 * f, 0.0, f + 9.0, 9.0, None) for t in range(3) for f in range(5)], "title_id long, frame_idx long, box_no long, x1 double, y1 double, x2 double, y2 double, motion double")
    made = detections.cluster_detections(frame)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan and "Join" not in plan
    assert made.count() == 15 and made.schema["cluster_id"].dataType.simpleString() == "int"


def test_cuts_are_folded_once(spark):
    """A filter that Spark makes from the rows' array would fold the words again."""
    rows = [(1, i, "word", i * 0.4, i * 0.4 + 0.35) for i in range(60)]
    cues = align.machine_cues(spark.createDataFrame(rows, "title_id long, pos long, text string, start double, end double"))
    plan = cues._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("struct(held") == 1 and sum(r.text.count("word") for r in cues.collect()) == 60
