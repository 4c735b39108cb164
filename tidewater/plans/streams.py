"""T: streaming jobs over the events table, each compared with the batch result."""

import uuid

from pyspark.sql import functions as F

from tidewater.operators.quality import tag
from tidewater.plans.registry import query
from tidewater.sources import io
from tidewater.sources.durable import scratch
from tidewater.sources.keyed import KeyedTable
from tidewater.streaming import jobs as J

stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm").alias(c)
TEXT = "strftime({0}, '%Y-%m-%d %H:%M')"


def _stream(t):
    """The whole events file as a stream."""
    return J.file_stream(t.spark, t.folder, t.events.schema, "parquet", pathGlobFilter="events.parquet")


def _messages(t):
    """Events as JSON message files, as a queue would deliver them."""
    path = scratch(t.spark, "messages")
    body = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    t.events.repartition("event_id").select(body.cast("binary").alias("value"), F.col("ts").alias("timestamp")).write.parquet(path)
    return path


def _collect(t, stream, keys, mode="update"):
    path = scratch(t.spark, "out")
    J.drain(stream, scratch(t.spark, "state"), J.idempotent_sink(path), mode=mode)
    return J.read_latest(t.spark, path, keys) if keys else t.spark.read.parquet(path)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def t01_file_stream(t):
    path = scratch(t.spark, "json")
    t.events.repartition("event_id").write.json(path)
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    rows = _collect(t, J.file_stream(t.spark, path, schema, "json", 2), None, "append")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def t02_message_decode(t):
    path = _messages(t)
    messages = J.file_stream(t.spark, path, t.spark.read.parquet(path).schema, "parquet")
    rows = _collect(t, J.decode_json(messages, "event_id long, user_id long, event_type string, value double"), None, "append")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS ids, true AS tracked FROM events")
def t03_incremental_ingest(t):
    source, out, state = scratch(t.spark, "landing"), scratch(t.spark, "bronze"), scratch(t.spark, "state")
    for part in (0, 1):       # the second run must read only the new files
        t.events.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(source)
        stream = io.with_ingest_columns(J.file_stream(t.spark, source, t.events.schema, "parquet"))
        J.drain(stream, state, J.drift_guard(t.events.schema, J.idempotent_sink(out)))
    rows = t.spark.read.parquet(out)
    return rows.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), (F.count("source_file") == F.count("*")).alias("tracked"))


@query("""SELECT count(*) AS n, count(CASE WHEN event_id % 2 = 1 THEN props END) AS props, count(CASE WHEN event_id % 2 = 1 THEN 1 END) AS flags, 7 AS columns FROM events""")
def t03_evolving_ingest(t):
    """Three deliveries: the second brings a column, the third another one; old rows have nulls there."""
    source, out, state, kept = (scratch(t.spark, x) for x in ("landing", "bronze", "state", "schema"))
    rows = t.events.withColumn("flag", F.col("value") > 0)
    for part, gone in ((F.col("event_id") % 4 == 0, ["props", "flag"]), (F.col("event_id") % 4 == 2, ["props", "flag"]), (F.col("event_id") % 4 == 1, ["flag"]), (F.col("event_id") % 4 == 3, [])):
        rows.filter(part).drop(*gone).coalesce(1).write.mode("append").parquet(source)
        schema = J.ingest_evolving(t.spark, source, out, state, kept, max_files=1)
    got = t.spark.read.schema(schema).parquet(f"{out}/batch_id=*")
    return got.agg(F.count("*").alias("n"), F.count("props").alias("props"), (F.count("flag") + F.count_if(F.col("flag").isNull() & (F.col("event_id") % 4 == 1))).alias("flags"), F.lit(len(schema.names)).alias("columns"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def t04_table_stream(t):
    name = io.save_table(t.events, "events_stream")
    rows = t.spark.readStream.table(name).groupBy("user_id").agg(F.count("*").alias("n"))
    return _collect(t, rows, ["user_id"])


@query(f"""WITH w AS (SELECT date_trunc('hour', ts) AS s, event_type, count(*) AS n FROM events GROUP BY 1, 2)
          SELECT {TEXT.format('s')} AS "start", event_type, n FROM w WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def t05_watermark(t):
    rows = J.windowed(_stream(t), "ts", ["event_type"], "1 hour", delay="2 hours", n=F.count("*"))
    return _collect(t, rows, None, "append").select(stamp("start"), "event_type", "n")


@query(f"""SELECT {TEXT.format("time_bucket(INTERVAL 5 MINUTE, ts)")} AS "start", event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def t06_tumbling_window(t):
    rows = J.windowed(_stream(t), "ts", ["event_type"], "5 minutes", delay="2 hours", n=F.count("*"), total=F.round(F.sum("value"), 2))
    return _collect(t, rows, ["start", "event_type"]).select(stamp("start"), "event_type", "n", "total")


SLIDING = """WITH s AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * k AS s, event_type, value FROM events, range(2) r(k))"""


@query(f"""{SLIDING} SELECT {TEXT.format('s')} AS "start", event_type, count(*) AS n FROM s GROUP BY 1, 2""")
def t07_sliding_window(t):
    rows = J.windowed(_stream(t), "ts", ["event_type"], "1 hour", "30 minutes", delay="2 hours", n=F.count("*"))
    return _collect(t, rows, ["start", "event_type"]).select(stamp("start"), "event_type", "n")


@query(f"""{SLIDING} SELECT {TEXT.format('s')} AS "start", event_type, round(sum(value), 2) AS total FROM s GROUP BY 1, 2 HAVING sum(value) > 400""")
def t08_threshold_alerts(t):
    rows = J.windowed(_stream(t), "ts", ["event_type"], "1 hour", "30 minutes", delay="2 hours", total=F.round(F.sum("value"), 2)).filter("total > 400")
    return _collect(t, rows, ["start", "event_type"]).select(stamp("start"), "event_type", "total")


@query("""SELECT epoch(ts + INTERVAL 1 HOUR * (event_id % 6)) - epoch(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR) > 7200 AS late, count(*) AS n FROM
          (SELECT event_id, date_trunc('second', ts) AS ts FROM events) GROUP BY 1""")
def t09_late_flag(t):
    rows = t.events.withColumn("arrival", F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 6).cast("int")))
    return J.late_rows(rows, "ts", "arrival", "1 hour", 7200).groupBy("late").agg(F.count("*").alias("n"))


@query(f"""{SLIDING} SELECT {TEXT.format('s')} AS "start", event_type, 1 AS alerts, true AS over FROM s GROUP BY 1, 2 HAVING sum(value) > 400""")
def t08_alerts_once(t):
    """Windows over 400, each reported once, when its running total passes the limit; events come in three deliveries."""
    source, out, state = scratch(t.spark, "landing"), scratch(t.spark, "alerts"), scratch(t.spark, "state")
    for part in range(3):
        t.events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(source)
        stream = J.file_stream(t.spark, source, t.events.schema, "parquet")
        J.drain(J.alerts_once(stream, "ts", ["event_type"], "1 hour", "30 minutes", "value", 400.0, delay="400 days"), state, J.idempotent_sink(out))
    alerts = t.spark.read.parquet(f"{out}/batch_id=*")
    return alerts.groupBy("start", "event_type").agg(F.count("*").cast("int").alias("alerts"), (F.min("total") > 400).alias("over")).select(stamp("start"), "event_type", "alerts", "over")


LATE_HOURS = 48


@query(f"""WITH e AS (SELECT event_id, ts, event_id % 10 = 0 AS held FROM events), w AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL {LATE_HOURS} HOUR AS mark FROM e WHERE NOT held)
          SELECT count(*) AS read, count(CASE WHEN held AND ts <= mark THEN 1 END) AS dropped, count(CASE WHEN held AND ts <= mark THEN 1 END) AS diverted,
                 count(CASE WHEN NOT (held AND ts <= mark) THEN 1 END) AS on_time FROM e, w""")
def t09_late_rows_in_a_stream(t):
    """Two deliveries, the second with a tenth of the events after all others: rows that the watermark drops, and the same rows kept aside."""
    source, state, other = scratch(t.spark, "landing"), scratch(t.spark, "state"), scratch(t.spark, "state")
    late, on_time, times = (scratch(t.spark, x) for x in ("late", "on-time", "times"))
    read = dropped = 0
    for held in (False, True):
        t.events.filter((F.col("event_id") % 10 == 0) == held).write.mode("append").parquet(source)
        stream = J.file_stream(t.spark, source, t.events.schema, "parquet", 1000)
        seen = J.drain(J.once_per_event(stream, "ts", ["event_id"], f"{LATE_HOURS} hours"), state, path=scratch(t.spark, "rows"))
        read, dropped = read + seen["rows"], dropped + seen["late_dedupe"]
        J.drain(stream, other, J.divert_late(on_time, late, times, "ts", LATE_HOURS * 3600))
    sizes = [t.spark.read.schema(t.events.schema).parquet(f"{p}/batch_id=*").agg(F.count("*").alias(n)) for p, n in ((late, "diverted"), (on_time, "on_time"))]
    return sizes[0].crossJoin(sizes[1]).select(F.lit(read).alias("read"), F.lit(dropped).alias("dropped"), "diverted", "on_time")


@query("SELECT event_id, event_type FROM events")
def t10_append_path_sink(t):
    path = scratch(t.spark, "sink")
    J.drain(_stream(t).select("event_id", "event_type"), scratch(t.spark, "state"), path=path)
    return t.spark.read.parquet(path)


@query("SELECT event_id, user_id, value FROM events")
def t10_table_sink(t):
    """The table's files are read by path, so the catalog entry can go again."""
    path, name = scratch(t.spark, "sink"), f"sink_{uuid.uuid4().hex[:12]}"
    J.drain(_stream(t).select("event_id", "user_id", "value"), scratch(t.spark, "state"), path=path, table=name)
    rows = t.spark.table(name).count()
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(path).filter(F.lit(rows) > 0)


@query("SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def t11_checkpoint_recovery(t):
    source, out, state = scratch(t.spark, "landing"), scratch(t.spark, "out"), scratch(t.spark, "state")
    for part in (0, 1):       # state and read position survive the restart between the two runs
        t.events.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(source)
        stream = J.file_stream(t.spark, source, t.events.schema, "parquet").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
        J.drain(stream, state, J.idempotent_sink(out), mode="update")
    return J.read_latest(t.spark, out, ["user_id"])


@query("""WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1) SELECT * FROM l WHERE last_type <> 'error'""")
def t12_change_apply(t):
    table = KeyedTable(t.spark, scratch(t.spark, "state_table"), ["user_id"], parts=16)
    changes = _stream(t).select("user_id", F.col("event_type").alias("last_type"), "value", F.when(F.col("event_type") == "error", "delete").otherwise("update").alias("op"), "ts", "event_id")
    table.write(t.spark.createDataFrame([], "user_id long, last_type string, value double"), "struct<ts: timestamp_ntz, event_id: bigint>")
    J.drain(changes, scratch(t.spark, "state"), J.change_sink(table, ["user_id"], "op", "ts", "event_id"))
    return table.read()


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def t13_idempotent_batches(t):
    path = scratch(t.spark, "batches")
    sink = J.idempotent_sink(path)

    def twice(batch, batch_id):     # a retry of the same batch
        sink(batch, batch_id)
        sink(batch, batch_id)

    J.drain(_stream(t), scratch(t.spark, "state"), twice)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN value >= 1 AND event_type <> 'error' THEN 'VALID' ELSE 'INVALID' END AS quality, count(*) AS n FROM events GROUP BY 1")
def t14_quality_tag(t):
    rules = {"value": F.col("value") >= 1, "type": F.col("event_type") != "error"}
    tagged = tag(_stream(t), rules).select(F.when(F.col("failed") == "", "VALID").otherwise("INVALID").alias("quality"))
    return _collect(t, tagged.groupBy("quality").agg(F.count("*").alias("n")), ["quality"])


@query("""SELECT 'batch' AS side, user_id, round(sum(value) * 1.1, 4) AS total FROM events WHERE event_type = 'purchase' GROUP BY 2
          UNION ALL SELECT 'stream', user_id, round(sum(value) * 1.1, 4) FROM events WHERE event_type = 'purchase' GROUP BY 2""")
def t15_shared_transform(t):
    def purchases(df):
        return df.filter("event_type = 'purchase'").groupBy("user_id").agg(F.round(F.sum("value") * 1.1, 4).alias("total"))

    streamed = _collect(t, _stream(t).transform(purchases), ["user_id"])
    return (t.events.transform(purchases).select(F.lit("batch").alias("side"), "user_id", "total")
            .unionByName(streamed.select(F.lit("stream").alias("side"), "user_id", "total")))


@query(f"""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS f FROM events),
          s AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g), a AS (SELECT user_id, sid, min(ts) AS s, max(ts) AS e, count(*) AS events FROM s GROUP BY 1, 2)
          SELECT user_id, {TEXT.format('s')} AS "start", events FROM a WHERE e + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def t16_stream_sessions(t):
    rows = J.sessions(_stream(t), "ts", ["user_id"], "30 minutes", "10 minutes")
    return _collect(t, rows, None, "append").select("user_id", stamp("start"), "events")
