"""Structured Streaming building blocks; the batch operators are reused unchanged."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewater.sources.keyed import KeyedTable
from tidewater.sources.snapshots import SnapshotTable, latest_changes


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json",
                max_files: int = 100, **options) -> DataFrame:
    """New files of a folder as a stream; the schema is fixed by the caller."""
    return (spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
            .options(**options).load(path))


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest", fmt: str = "kafka", fail_on_data_loss: bool = True) -> DataFrame:
    """Kafka topic as (key, value, timestamp); needs the connector on the class path. Lost offsets raise unless allowed."""
    return (spark.readStream.format(fmt).option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_data_loss).lower()).load())


def decode_json(messages: DataFrame, schema: str, keep: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """Binary message value to columns; rows that do not parse have nulls, and their text in ``_corrupt_record``."""
    parsed = F.from_json(F.col("value").cast("string"), f"{schema}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    return messages.select(parsed.alias("_v"), *[c for c in keep if c in messages.columns]).select("_v.*", *[c for c in keep if c in messages.columns])


def _watermarked(df: DataFrame, time: str, delay: str | None) -> DataFrame:
    """Watermarks need the zoned timestamp type."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay) if delay else df


def windowed(df: DataFrame, time: str, keys: list[str], size: str, slide: str | None = None,
             delay: str | None = None, **aggs: Column) -> DataFrame:
    """Tumbling or sliding event-time aggregate: start, end, keys, measures."""
    rows = _watermarked(df, time, delay)
    win = F.window(time, size, slide) if slide else F.window(time, size)
    out = rows.groupBy(win.alias("_w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *keys, *aggs)


def sessions(df: DataFrame, time: str, keys: list[str], gap: str = "30 minutes", delay: str | None = None) -> DataFrame:
    """Session windows; only a pause longer than ``gap`` parts two sessions. The same call serves batch and stream."""
    rows = _watermarked(df, time, delay)
    out = rows.groupBy(F.session_window(time, gap).alias("_w"), *keys).agg(F.count("*").alias("events"))
    return out.select(*keys, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "events")


def late_rows(df: DataFrame, event_time: str, arrival: str, size: str, tolerance_seconds: int) -> DataFrame:
    """Flag rows that arrive more than the tolerance after their window closed."""
    end = F.window(event_time, size)["end"]
    return df.withColumn("late", F.unix_timestamp(arrival) - F.unix_timestamp(end) > tolerance_seconds)


def alerts_once(df: DataFrame, time: str, keys: list[str], size: str, slide: str | None, value: str, limit: float, delay: str) -> DataFrame:
    """(start, end, keys, total): one row for each window, as soon as its sum of ``value`` passes ``limit``, and never again.

    A window and key hold their sum and whether they have reported in keyed state, which a timer removes once the
    watermark has passed the window's end. Null values add nothing. Values may come in any order; with negative ones the
    report stands even if the sum falls again.
    """
    win = F.window(time, size, slide) if slide else F.window(time, size)
    rows = _watermarked(df, time, delay).select(*keys, F.col(time), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("_value"), win.alias("_w"))
    rows = rows.select(*keys, time, "_value", F.col("_w.start").alias("start"), F.col("_w.end").alias("end"))
    fields = ["start", "end", *keys, "total"]
    shape = T.StructType([*[f for f in rows.select("start", "end", *keys).schema], T.StructField("total", T.DoubleType())])

    def follow(key, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        before, told = state.get if state.exists else (0.0, False)
        total = before + sum(float(b["_value"].sum()) for b in batches)
        state.update((total, told or total > limit))
        end = int(key[1].timestamp() * 1000)
        if end > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(end)
        else:
            state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + 1)
        if total > limit and not told:
            yield pd.DataFrame([[*key, total]], columns=fields)

    return rows.groupBy("start", "end", *keys).applyInPandasWithState(follow, shape, "total double, told boolean", "append", GroupStateTimeout.EventTimeTimeout)


def once_per_event(df: DataFrame, time: str, keys: list[str], delay: str) -> DataFrame:
    """Each event once; state and late rows end at the watermark, counted by row in the query's progress."""
    return _watermarked(df, time, delay).dropDuplicates([*keys, time])


def divert_late(rows_path: str, late_path: str, times_path: str, time: str, delay_seconds: int) -> Callable[[DataFrame, int], None]:
    """Batch sink: rows behind the watermark go to a side table, the others to ``rows_path``, one folder a batch.

    The watermark is the greatest time of all earlier batches less the delay. Each batch leaves its greatest time in
    ``times_path``, so a replayed or restarted batch finds the same one, and replaces its own folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        # the folder of an earlier batch always exists but before the first one
        top = batch.agg(F.max(time).cast("timestamp").alias("top")).withColumn("batch", F.lit(batch_id))
        top.coalesce(1).write.mode("overwrite").parquet(f"{times_path}/batch_id={batch_id}")
        seen = spark.read.schema("top timestamp, batch int").parquet(f"{times_path}/batch_id=*").filter(F.col("batch") < batch_id)
        mark = seen.agg((F.unix_micros(F.max("top")) - delay_seconds * 1_000_000).alias("mark")).first().mark
        late = F.unix_micros(F.col(time).cast("timestamp")) <= F.lit(mark).cast("long")
        late = F.coalesce(late, F.lit(False))
        batch.filter(late).write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
        batch.filter(~late).write.mode("overwrite").parquet(f"{rows_path}/batch_id={batch_id}")

    return write


class _Widened(Exception):
    """A file brought columns that the stored schema lacks."""


def ingest_evolving(spark: SparkSession, source: str, out: str, checkpoint: str, schema_path: str, fmt: str = "parquet", max_files: int = 100) -> T.StructType:
    """Drain new files of a folder whose columns grow; returns the schema in force.

    The schema is kept as text below ``schema_path``. A batch that meets a new column stops before it writes anything;
    the column joins the stored schema and the stream goes on from its checkpoint with the same files. Rows of
    older files have nulls there. A column that comes with another type, or a folder without any file, is refused.
    """

    def stored() -> T.StructType | None:
        texts = [r[0] for r in spark.read.text(f"{schema_path}/*").collect()] if versions() else []
        return T.StructType.fromJson(json.loads(max(texts, key=len))) if texts else None

    def versions() -> bool:
        place = spark._jvm.org.apache.hadoop.fs.Path(schema_path)
        return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def store(schema: T.StructType) -> None:
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{schema_path}/columns={len(schema.names)}")

    def write(batch: DataFrame, batch_id: int) -> None:
        files = [r[0] for r in batch.select(F.input_file_name()).distinct().collect()]       # at most max_files
        if not files:
            return
        met = spark.read.format(fmt).option("mergeSchema", "true").load(files).schema
        for field in met:
            if field.name in known.names and known[field.name].dataType != field.dataType:
                raise ValueError(f"column {field.name} changed from {known[field.name].dataType.simpleString()} to {field.dataType.simpleString()}")
        if fresh := [f for f in met if f.name not in known.names]:
            wider.append(T.StructType([*known.fields, *[T.StructField(f.name, f.dataType) for f in fresh]]))
            raise _Widened(str([f.name for f in fresh]))
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    known = stored()
    if known is None:
        known = T.StructType([T.StructField(f.name, f.dataType) for f in spark.read.format(fmt).load(source).schema])
        store(known)
    while True:
        wider: list[T.StructType] = []
        try:
            drain(file_stream(spark, source, known, fmt, max_files), checkpoint, write)
            return known
        except StreamingQueryException:
            if not wider:
                raise
            known = wider[0]
            store(known)


def drain(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None,
          path: str | None = None, mode: str = "append", timeout: int | None = None, table: str | None = None) -> dict[str, int]:
    """Process everything available, then stop; a restart with the same checkpoint continues. No time limit unless given.

    Returns the rows read, and those that each kind of stateful operator dropped behind the watermark.

    Rows go to ``sink`` by batches, to Parquet files below ``path``, or to the catalog table ``table`` (its files below ``path``, if given).
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if sink:
        run = writer.foreachBatch(sink).start()
    else:
        files = writer.format("parquet").option("path", path) if path else writer.format("parquet")
        run = files.toTable(table) if table else files.start()
    try:
        if run.awaitTermination(timeout) is False:
            raise TimeoutError("stream did not finish")
        return _progress(run)
    finally:
        run.stop()


def _progress(run) -> dict[str, int]:
    """Totals over the batches whose progress the session still holds (``spark.sql.streaming.numRecentProgressUpdates``)."""
    total: dict[str, int] = {"rows": 0}
    for batch in run.recentProgress:
        total["rows"] += max(0, int(batch["numInputRows"]))
        for state in batch["stateOperators"]:
            name = f"late_{state['operatorName']}"
            total[name] = total.get(name, 0) + int(state["numRowsDroppedByWatermark"])
    return total


def idempotent_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Each micro-batch owns one directory, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Result table of an update-mode stream: the newest batch's row per key wins."""
    return latest_changes(spark.read.parquet(path), keys, "batch_id").drop("batch_id")


def merge_sink(table: SnapshotTable | KeyedTable, keys: list[str], *recency: str) -> Callable[[DataFrame, int], None]:
    """Upsert every micro-batch into a table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.merge(latest_changes(batch, keys, *recency), keys)

    return write


def change_sink(table: SnapshotTable | KeyedTable, keys: list[str], op: str, *recency: str) -> Callable[[DataFrame, int], None]:
    """Apply insert / update / delete records of every micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.apply_changes(batch, keys, op, *recency)

    return write


def drift_guard(expected: T.StructType, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Stop on columns that vanished; new columns pass through."""

    def write(batch: DataFrame, batch_id: int) -> None:
        missing = set(expected.names) - set(batch.columns)
        if missing:
            raise ValueError(f"columns disappeared: {sorted(missing)}")
        sink(batch, batch_id)

    return write
