from lodestone.streaming import batches as S


def test_width_batches_carry_over(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(10 * k + i, 96) for i in range(3)], "id long, width long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = S.read_stream(spark, str(tmp_path / "in"), "id long, width long")
    q = S.width_batches(stream, 4).writeStream.format("memory").queryName("width_batches").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT batch, size(ids) AS n FROM width_batches").collect()
    assert sorted((r.batch, r.n) for r in got) == [(0, 4), (1, 4)]


def test_event_windows(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = S.read_stream(spark, str(tmp_path / "in"), events.schema)
    q = S.event_windows(stream).writeStream.format("memory").queryName("event_windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT sum(n) FROM event_windows").first()[0] == events.count()
