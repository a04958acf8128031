"""Sessions on a stream of files: late rows within the watermark count, closed sessions come out once."""

from pyspark.sql import functions as F

from orthoskein.streaming import sessions


def test_sessions_on_a_stream(spark, tmp_path):
    schema = "k long, m long"
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    timed = stream.withColumn("ts", F.timestamp_seconds(F.col("m") * 60))
    found = sessions.capture_sessions(timed, "ts", "k", "30 minutes", "1 hour")

    def feed(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        found.writeStream.format("parquet").option("checkpointLocation", check).outputMode("append").trigger(availableNow=True).start(out).awaitTermination()

    feed([(1, 0), (1, 20), (2, 5)])
    feed([(1, 45), (1, 200)])  # goes on with the first session; a later one begins
    feed([(1, 2000), (2, 2000)])  # moves the watermark past all of them
    feed([(1, 10), (1, 4000)])  # too late, and another step of the watermark
    got = sorted((r.k, r.n) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1), (1, 1), (1, 3), (2, 1), (2, 1)]
