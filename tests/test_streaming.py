"""A stream gives what the same table gives at once."""

from pyspark.sql import functions as F

from millrace.streaming.events import read_events, windowed_counts


def test_stream_and_table_agree(spark, tmp_path):
    rows = spark.createDataFrame([("2026-01-01 00:10:00", "a", 1.0), ("2026-01-01 00:50:00", "a", 2.0), ("2026-01-01 01:10:00", "b", 3.0), ("2026-01-02 00:00:00", "z", 0.0)], "t string, event_type string, value double").select(F.to_timestamp("t").alias("ts"), "event_type", "value")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(read_events(spark, str(tmp_path / "in"), "ts timestamp, event_type string, value double"))
    run = stream.writeStream.format("memory").queryName("counted").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = {tuple(r) for r in spark.table("counted").collect()}
    want = {tuple(r) for r in windowed_counts(rows).where("event_type <> 'z'").collect()}
    assert got == want and len(got) == 2
