import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.sources.durable import scratch
from tidewater.sources.snapshots import SnapshotTable
from tidewater.streaming import jobs
from tidewater.streaming import jobs as J

SCHEMA = "id int, ts timestamp, k string, v int"


def land(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(minute, hour=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def test_rows_behind_the_watermark_are_dropped(spark):
    source, out, state = (scratch(spark, n) for n in ("src", "out", "state"))

    def run():
        stream = jobs.windowed(jobs.file_stream(spark, source, SCHEMA, "parquet"), "ts", ["k"], "10 minutes", delay="5 minutes", n=F.count("*"))
        jobs.drain(stream, state, jobs.idempotent_sink(out))

    land(spark, source, [(1, at(1), "a", 1), (2, at(2), "a", 1), (3, at(40), "a", 1)])
    run()
    land(spark, source, [(4, at(3), "a", 1), (5, at(36), "a", 1), (6, at(0, 5), "a", 1)])       # 4 is late, 5 is not
    run()
    got = spark.read.parquet(out).select(F.date_format("start", "HH:mm").alias("s"), "n")
    assert rows(got) == [("00:00", 2), ("00:30", 1), ("00:40", 1)]


def test_session_gap_in_stream_equals_batch(spark):
    source, out = scratch(spark, "src"), scratch(spark, "out")
    land(spark, source, [(1, at(0), "a", 1), (2, at(30), "a", 1), (3, at(1, 1), "a", 1), (4, at(0, 9), "z", 1)])
    batch = jobs.sessions(spark.read.parquet(source), "ts", ["k"])
    jobs.drain(jobs.sessions(jobs.file_stream(spark, source, SCHEMA, "parquet"), "ts", ["k"], delay="1 minute"), scratch(spark, "state"), jobs.idempotent_sink(out))
    assert rows(batch.filter("k = 'a'"), "events") == [(1,), (2,)]         # a gap of exactly 30 minutes stays together
    assert rows(spark.read.parquet(out), "k", "start", "end", "events") == rows(batch.filter("k = 'a'"), "k", "start", "end", "events")


def test_restart_continues_and_replay_is_harmless(spark):
    source, out, state = (scratch(spark, n) for n in ("src", "out", "state"))
    sink = jobs.idempotent_sink(out)
    for part in ([(1, at(1), "a", 1)], [(2, at(2), "a", 5)]):
        land(spark, source, part)
        totals = jobs.file_stream(spark, source, SCHEMA, "parquet").groupBy("k").agg(F.sum("v").alias("v"))
        jobs.drain(totals, state, lambda b, i: (sink(b, i), sink(b, i)), mode="update")
    assert rows(jobs.read_latest(spark, out, ["k"])) == [("a", 6)]


def test_change_sink_and_decode(spark):
    path = scratch(spark, "messages")
    body = ['{"id": 1, "v": 5, "op": "insert", "seq": 1}', '{"id": 1, "v": 7, "op": "update", "seq": 2}', '{"id": 2, "v": 1, "op": "insert", "seq": 1}', '{"id": 2, "op": "delete", "seq": 2}']
    spark.createDataFrame([(b,) for b in body], "value string").select(F.col("value").cast("binary").alias("value"), F.lit(at(0)).alias("timestamp")).write.parquet(path)
    messages = jobs.file_stream(spark, path, spark.read.parquet(path).schema, "parquet")
    table = SnapshotTable(spark, scratch(spark, "t"))
    table.write(spark.createDataFrame([], "id int, v int"))
    jobs.drain(jobs.decode_json(messages, "id int, v int, op string, seq int", keep=()), scratch(spark, "state"), jobs.change_sink(table, ["id"], "op", "seq"))
    assert rows(table.read()) == [(1, 7)]


def test_late_flag_compares_arrival_with_window_end(spark):
    df = spark.createDataFrame([(1, at(10), at(59, 2)), (2, at(10), at(1, 3))], "id int, ts timestamp, arrival timestamp")
    assert rows(jobs.late_rows(df, "ts", "arrival", "1 hour", 7200), "id", "late") == [(1, False), (2, True)]


def test_unreadable_messages_keep_their_text(spark):
    df = spark.createDataFrame([(b'{"id": 1}',), (b"{oops",)], "value binary")
    assert rows(jobs.decode_json(df, "id int", keep=())) == [(1, None), (None, "{oops")]


def test_new_columns_join_the_stored_schema(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    run = lambda: J.ingest_evolving(spark, at("in"), at("out"), at("state"), at("schema"), max_files=1).names
    read = lambda names: {tuple(r[n] for n in ("id", "a", "b") if n in names) for r in spark.read.option("mergeSchema", "true").parquet(at("out")).collect()}
    spark.createDataFrame([(1,)], "id long").coalesce(1).write.mode("append").parquet(at("in"))
    assert run() == ["id"]
    spark.createDataFrame([(2, "x")], "id long, a string").coalesce(1).write.mode("append").parquet(at("in"))
    spark.createDataFrame([(3, 0.5, "y")], "id long, b double, a string").coalesce(1).write.mode("append").parquet(at("in"))
    assert run() == ["id", "a", "b"]
    assert run() == ["id", "a", "b"]                 # nothing new
    assert read(["id", "a", "b"]) == {(1, None, None), (2, "x", None), (3, "y", 0.5)}
    spark.createDataFrame([("four",)], "id string").coalesce(1).write.mode("append").parquet(at("in"))
    with pytest.raises(Exception, match="bigint"):
        run()
    assert read(["id", "a", "b"]) == {(1, None, None), (2, "x", None), (3, "y", 0.5)}


def test_late_rows_are_counted_and_kept_aside(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    stamp = "id long, ts timestamp"
    stream = lambda: J.file_stream(spark, at("in"), stamp, "parquet")
    deliveries = [[(1, "2024-01-01 10:00:00"), (2, "2024-01-01 12:00:00")], [(3, "2024-01-01 10:59:59"), (4, "2024-01-01 11:00:00"), (5, "2024-01-01 11:00:01"), (2, "2024-01-01 12:00:00")]]
    seen = []
    for rows_ in deliveries:
        spark.createDataFrame(rows_, "id long, t string").selectExpr("id", "cast(t as timestamp) as ts").coalesce(1).write.mode("append").parquet(at("in"))
        seen.append(J.drain(J.once_per_event(stream(), "ts", ["id"], "1 hour"), at("s1"), path=at("once")))
        J.drain(stream(), at("s2"), J.divert_late(at("rows"), at("late"), at("times"), "ts", 3600))
    assert [s["rows"] for s in seen] == [2, 4] and [s["late_dedupe"] for s in seen] == [0, 2]
    ids = lambda name: sorted(r.id for r in spark.read.parquet(at(name)).collect())
    assert ids("once") == [1, 2, 5] and ids("late") == [3, 4] and ids("rows") == [1, 2, 2, 5]


def test_alert_is_raised_once_and_state_ends(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    deliveries = [[("a", "10:05", 3.0), ("b", "10:10", 20.0)], [("a", "10:50", 8.0), ("b", "10:20", 5.0), ("a", "11:01", 1.0)], [("a", "10:55", 50.0), ("a", "11:59", None)], [("a", "15:00", 11.0)]]
    for rows_ in deliveries:
        spark.createDataFrame([(k, f"2024-01-01 {t}", v) for k, t, v in rows_], "k string, t string, v double").selectExpr("k", "cast(t as timestamp) as ts", "v").coalesce(1).write.mode("append").parquet(at("in"))
        stream = J.file_stream(spark, at("in"), "k string, ts timestamp, v double", "parquet")
        J.drain(J.alerts_once(stream, "ts", ["k"], "1 hour", None, "v", 10.0, "1 hour"), at("state"), J.idempotent_sink(at("out")))
    got = sorted((r.k, str(r.start)[11:16], r.total) for r in spark.read.parquet(at("out")).collect())
    assert got == [("a", "10:00", 11.0), ("a", "15:00", 11.0), ("b", "10:00", 20.0)]


def test_pause_of_exactly_the_gap(spark):
    df = spark.createDataFrame([("u", "2024-01-01 10:00:00"), ("u", "2024-01-01 10:30:00"), ("u", "2024-01-01 11:00:01")], "u string, t string").selectExpr("u", "cast(t as timestamp) as ts")
    got = sorted((str(r.start)[11:], str(r.end)[11:], r.events) for r in J.sessions(df, "ts", ["u"], "30 minutes").collect())
    assert got == [("10:00:00", "11:00:00", 2), ("11:00:01", "11:30:01", 1)]
