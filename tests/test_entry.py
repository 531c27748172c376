"""The driver contract."""

import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 50


def test_flagship_runs(spark):
    df = entry.queries()["activity_track"](spark, "/root/testdata/sf0.001")
    assert df.count() > 0
    assert df.columns == ["title_id", "bucket", "value", "top", "level"]
