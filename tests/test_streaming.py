from helixframe.operators.kmer import count
from helixframe.streaming import kmers


def test_stream_counts_like_a_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    df = spark.createDataFrame([(1, "ACGTACGT"), (2, "TTTTACG"), (3, "GGNAC")], "id long, seq string")
    df.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = kmers.running_counts(stream, 3).writeStream.outputMode("complete").format("memory").queryName("kmer_counts").option("checkpointLocation", str(tmp_path / "state")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("kmer_counts").collect())) == sorted(map(tuple, count(df, 3).collect()))


def test_windows_close(spark, tmp_path):
    path = str(tmp_path / "events")
    df = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int)) as ts, 'x' as kind from range(0, 180, 10)")
    df.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    q = kmers.windowed_counts(stream, "ts", "kind", "1 hour", "10 minutes").writeStream.outputMode("append").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "state")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.n for r in spark.table("windows").orderBy("window_start").collect()] == [6, 6]
