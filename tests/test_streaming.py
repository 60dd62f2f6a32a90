from notecode.streaming.jobs import event_rates, run_available


def test_stream_processes_each_row_once(spark, tmp_path):
    src, out, check = (f"{tmp_path}/{x}" for x in ("src", "out", "check"))
    schema = "ts timestamp, event_type string, value double"
    data = lambda *v: spark.sql("select * from values " + ", ".join(f"(timestamp'2025-01-01 00:00:00', 'a', {x}d)" for x in v) + " t(ts, event_type, value)")
    data(1, 2).write.mode("append").parquet(src)
    go = lambda: run_available(spark.readStream.schema(schema).parquet(src), event_rates, out, check).awaitTermination(60)
    go()
    data(3).write.mode("append").parquet(src)
    go()
    assert sorted(r.total for r in spark.read.parquet(out).collect()) == [3.0, 3.0]
    go()
    assert spark.read.parquet(out).count() == 2
