"""Streaming buckets equal the batch result."""

from pyspark.sql import functions as F

from cuegrid.streaming.activity import bucket_means


def test_stream_equals_batch(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = source.select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("title_id"), F.col("value").alias("motion"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = bucket_means(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("buckets").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    key = lambda df: sorted((r.title_id, r.start, round(r.mean, 6), r.samples) for r in df.collect())
    assert key(spark.table("buckets")) == key(bucket_means(rows))


def test_tracks_of_a_stream_equal_the_batch(spark, tmp_path):
    import random

    from cuegrid.operators.detections import cluster_detections
    from cuegrid.streaming.tracking import PROVIDER, track_stream

    rng, rows = random.Random(2), []
    for title in range(3):
        spots = [(rng.uniform(0, 200), rng.uniform(0, 100)) for _ in range(4)]
        for frame in range(30):
            for box, (x, y) in enumerate(rng.sample(spots, rng.randint(0, 4))):
                x, y = x + rng.uniform(-9, 9), y + rng.uniform(-9, 9)
                rows.append((title, frame, box, x, y, x + 30, y + 40, 1.0))
    table = spark.createDataFrame(rows, "title_id long, frame_idx long, box_no long, x1 double, y1 double, x2 double, y2 double, motion double")
    for k, part in enumerate(("frame_idx < 11", "frame_idx between 11 and 19", "frame_idx > 19", "frame_idx = 5 and title_id = 0")):
        table.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/part={k}"))
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        out = str(tmp_path / "out")
        for k in range(4):  # a batch a part: the state goes on from the checkpoint
            (tmp_path / "stream").mkdir(exist_ok=True)
            for f in (tmp_path / f"in/part={k}").glob("*.parquet"):
                (tmp_path / "stream" / f"{k}-{f.name}").write_bytes(f.read_bytes())
            stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "stream"))
            query = track_stream(stream).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
            query.awaitTermination()
        got = {(r.title_id, r.frame_idx, r.box_no): r.cluster_id for r in spark.read.parquet(out).where("cluster_id >= 0").collect()}
        late = spark.read.parquet(out).where("cluster_id < 0").count()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)
    want = {(r.title_id, r.frame_idx, r.box_no): r.cluster_id for r in cluster_detections(table).collect()}
    assert got == want and len(set(want.values())) >= 4
    assert late == sum(r[0] == 0 and r[1] == 5 for r in rows)
