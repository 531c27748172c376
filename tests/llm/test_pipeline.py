"""The corpus pipeline: each stage against brute force on its own input."""

import re
from pathlib import Path

from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from cuegrid.llm.common import checkpoint_dir, read_table
from cuegrid.llm.queries import PIECE_MODEL
from tests.llm.test_operators import base_secrets, brute_components, shingles

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "pieces"]
    docs = read_table(spark, SF, "documents")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    items = [shingles(r.text, 5) for r in read_table(spark, SF, "benchmark").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        rows = {r.doc_id: r for r in docs.collect()}
        if name == "quality":
            assert all(labels.get(i, 1) == 1 for i in rows)
            assert sum(i in rows for i, q in labels.items() if q == 1) >= 0.95 * sum(labels.values())
        elif name == "near_duplicates":
            assert set(rows) == {c for _, c in brute_components(before, 5, 80).values()}
        elif name == "decontamination":
            held = {i for i, t in before.items() if any(s and 100 * len(s & shingles(t, 5)) >= 80 * len(s) for s in items)}
            assert set(rows) == set(before) - held and held
        elif name == "secrets":
            assert set(rows) == set(before)
            assert all(base_secrets(r.text) == "" for r in rows.values())
            assert all(rows[i].text == t for i, t in before.items() if not re.search("[0-9a-f]{24}|AKIA|[A-Za-z0-9+/_=-]{20}", t) and base_secrets(t) == "")
            assert all(r.n_chars == len(r.text) for r in rows.values() if r.text != before[r.doc_id])
        else:
            assert set(rows) == set(before) and all(r.round_trip for r in rows.values())
            before_last = before
            break
        assert docs.columns == columns
        before = {i: r.text for i, r in rows.items()}
    where = Path(checkpoint_dir(spark))
    before = set(where.iterdir())
    library = SentencePieceProcessor(model_file=PIECE_MODEL)
    # run() gives what the stages gave one by one, each of which brute force has confirmed
    assert {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()} == {i: library.encode(t or "") for i, t in before_last.items()}
    left = set(where.iterdir()) - before
    assert len(left) == 1 and left.pop().name.startswith("pipeline-")


ODD = "doc_id long, text string, row string, __length int, found string, __base int, part int, length_bucket int, _metadata string"


def odd_rows(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1, "f", 2, 3, 4, "m") for i, t in rows], ODD)


def written(spark, tmp_path, df, name):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_near_duplicates_judge_rows(spark, tmp_path):
    a, b = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30))
    rows = [(3, a), (5, a), (5, b), (9, "one two three four five six"), (9, "one two three four five six"), (None, a), (None, "x y"), (None, None), (7, ""), (7, " \n")]
    expected = sorted([(3, a), (5, b), (9, rows[3][1]), (None, "x y"), (None, None), (7, ""), (7, " \n")], key=str)
    for docs in (odd_rows(spark, rows), written(spark, tmp_path, odd_rows(spark, rows).repartition(3), "docs")):
        got = corpus_pipeline.near_duplicates(spark, docs, SF)
        assert got.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == expected
    only_nulls = corpus_pipeline.near_duplicates(spark, odd_rows(spark, [(None, a), (None, a)]), SF)
    assert [(r.doc_id, r.text) for r in only_nulls.collect()] == [(None, a)]


def test_decontamination_judges_rows(spark):
    item = read_table(spark, SF, "benchmark").first().text
    long_ = " ".join(f"w{i}" for i in range(30_000))
    rows = [(4, "clean words only here today"), (4, f"{long_} {item}"), (None, item.upper()), (None, "clean"), (5, None), (5, ""), (6, long_), (6, long_)]
    got = corpus_pipeline.decontamination(spark, odd_rows(spark, rows), SF)
    left = [rows[0], rows[3], *rows[4:]]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(left, key=str)


def test_stages_on_odd_and_empty_tables(spark):
    rows = [(1, None), (None, ""), (2, "x " * 50_000), (2, "token = 'abcdef123456' y"), (2, "token = 'abcdef123456' y")]
    for name, stage in corpus_pipeline.STAGES:
        docs = odd_rows(spark, rows)
        got = stage(spark, docs, SF)
        count, none = len(got.collect()), stage(spark, docs.limit(0), SF)
        assert none.count() == 0 and none.columns == got.columns
        if name == "pieces":
            assert count == len(rows)
        else:
            assert got.columns == docs.columns and 0 < count <= len(rows)
        if name == "secrets":
            assert sorted(r.text or "" for r in got.collect())[-1] == rows[2][1] and sum("[secret]" in (r.text or "") for r in got.collect()) == 2


def test_quality_of_very_long_texts(spark):
    """Batches are bounded by bytes, so long texts come one by one."""
    docs = read_table(spark, SF, "documents")
    long = docs.where("doc_id < 3").withColumn("text", F.repeat(F.concat("text", F.lit(" ")), F.ceil(F.lit(6_000_000) / F.length("text")).cast("int")))
    long = long.withColumn("doc_id", F.col("doc_id") + 10_000_000)
    got = corpus_pipeline.quality(spark, docs.unionByName(long), SF)
    assert got.columns == docs.columns and got.count() > 0.5 * docs.count()
    assert all(r.n >= 6_000_000 for r in got.where("doc_id >= 10000000").select(F.length("text").alias("n")).collect())
