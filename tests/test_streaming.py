import datetime as dt

from brookflow.streaming.replay import windowed


def test_stream_equals_batch(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1 + i // 5, i % 24), "a" if i % 2 else "b", float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "ts timestamp, event_type string, value double")
    df.write.parquet(str(tmp_path / "in"))
    stream = windowed(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("out_windows").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("out_windows").collect())) == sorted(map(tuple, windowed(df).collect()))
