"""Structured Streaming sources, sinks and the event-time clock (SRC-3,
SNK-1, SNK-3, S-1, S-2, S-3, S-14).

Every started query has a checkpoint location below the shared checkpoint
folder (``spark.checkpoint.dir``) unless one is given: a restarted or
re-scheduled query resumes from its offsets and state instead of starting
over. Event time must be ``TIMESTAMP`` (not ``TIMESTAMP_NTZ``) for
``withWatermark``; ``event_time`` casts it (UTC session).

A finite input leaves windows open that no later row closes. ``EndOfInput``
closes them (S-14): behind the input's files, a single row far in the
future is added to a folder that the source reads too, so the watermark
passes every open window and timer. The source reads files in order of their times of
writing, so that row comes last, in the same run: a query started again would load all its state anew.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, NumericType, StructField, StructType

from eventide.session import scratch_path, use_utc
from eventide.sources.sinks import print_rows

#: Event time of the row that ends an input: later than any real row, and within the
#: range of nanosecond timestamps, which pandas frames hold.
FAR = "2200-01-01 00:00:00"
_DONE = "epochs-done"
#: A commit writes the changes of a state partition, not a snapshot of it.
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


class EndOfInput:
    """The end of a drained input, for sources whose event time is ``time_col``.

    The other columns of the row that ends it are 0, empty or false rather than
    NULL: joins drop NULL keys in front of the watermark, where they would drop the row unseen.
    Its windows and timers are never reached, so it shows in no result."""

    def __init__(self, spark: SparkSession, schema, time_col: str):
        self.spark, self.schema, self.time_col = spark, schema, time_col
        self.folder = scratch_path(spark, "end-of-input")

    def write(self) -> None:
        def value(field):
            if field.name == self.time_col:
                return F.lit(FAR)
            kind = field.dataType.typeName()
            return F.lit({"string": "", "boolean": False}.get(kind, 0 if isinstance(field.dataType, NumericType) else None))

        row = [value(f).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        self.spark.range(1).select(*row).coalesce(1).write.parquet(self.folder)


def or_end(pred: Column, time_col: str) -> Column:
    """``pred``, or the row that ends an input. Spark moves a filter that does not look
    at the event time in front of the watermark, where it would drop that row
    unseen; use this for filters of a stream that is ended."""
    return pred | (F.col(time_col) >= F.lit(FAR).cast("timestamp"))


def _location(spark: SparkSession, path: str) -> tuple[str, str]:
    """File system and absolute path; a path without one is on the default."""
    m = re.match(r"^([A-Za-z][\w+.-]*:(?://[^/]*)?)?(/.*)$", path)
    if not m:
        raise ValueError(f"an absolute path is needed: {path}")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    return re.sub(r"/*$", "", m[1] or default), m[2].rstrip("/")


def read_parquet_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                        end: EndOfInput | None = None) -> DataFrame:
    """SRC-3: files arriving in a folder (or one file), read as an unbounded
    stream; with ``end`` also the row that ends it. The path is given to
    Spark as a pattern, so it may be a file, and the driver never looks at it."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    system, place = _location(spark, path)
    parts = [place]
    if end is not None:
        other, folder = _location(spark, end.folder)
        if other != system:
            raise ValueError("the checkpoint folder must be in the input's file system to end the input")
        parts.append(folder)
    inner = ",".join(p.lstrip("/") for p in parts)
    return reader.parquet(f"{system}/{{{inner}}}")


def event_time(df: DataFrame, col: str, delay_ms: int | None) -> DataFrame:
    """S-1 / S-3: ``col`` as the event-time column with a bounded
    out-of-orderness watermark of ``delay_ms`` (S-2: ``None`` = no
    watermark, arrival order)."""
    use_utc(df.sparkSession)
    out = df.withColumn(col, F.col(col).cast("timestamp"))
    return out if delay_ms is None else out.withWatermark(col, f"{int(delay_ms)} milliseconds")


def start(df: DataFrame, name: str, sink: str = "parquet", path: str | None = None,
          output_mode: str = "append", checkpoint: str | None = None,
          available_now: bool = False, processing_time: str | None = None,
          state_partitions: int | None = None) -> StreamingQuery:
    """Start a streaming query with a mandatory checkpoint location.

    ``state_partitions`` fixes the number of state-store partitions of a new
    query (Spark records it in the checkpoint at the first start); the
    session setting is restored right after the start. Default: the
    cluster's default parallelism."""
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"stream-ckpt-{name}")
    writer = (df.writeStream.format(sink).outputMode(output_mode)
              .option("checkpointLocation", checkpoint))
    if sink == "memory":
        writer = writer.queryName(name)
    elif path is not None:
        writer = writer.option("path", path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    parts = state_partitions or spark.sparkContext.defaultParallelism
    with _settings(spark, {"spark.sql.shuffle.partitions": str(parts), _CHANGELOG: "true"}):
        return writer.start()


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]):
    """Settings that a query takes over when it starts; the session's own ones afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_to_table(df: DataFrame, name: str, output_mode: str = "append",
                 ends: tuple[EndOfInput, ...] = ()) -> DataFrame:
    """Drain all available input (``availableNow``) into a parquet folder in
    the shared checkpoint folder and return it as a batch DataFrame. With
    ``ends`` the inputs, whose files must all be there, are ended, which brings out what is still open (S-14).
    In ``complete`` mode the result is that of the last micro-batch."""
    spark = df.sparkSession
    out, checkpoint = scratch_path(spark, f"stream-out-{name}"), scratch_path(spark, f"stream-ckpt-{name}")

    def drain() -> None:
        if output_mode == "append":
            query = start(df, name, "parquet", out, checkpoint=checkpoint, available_now=True)
        else:
            query = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
                     .foreachBatch(lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}"))
                     .trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()

    for end in ends:
        end.write()
    drain()
    if output_mode == "append":
        return spark.read.schema(df.schema).parquet(out)
    rows = spark.read.schema(df.schema.add("epoch", "long")).parquet(out)
    return rows.filter(F.col("epoch") == rows.agg(F.max("epoch")).first()[0]).drop("epoch")


def drain_when_quiet(df: DataFrame, name: str, trigger_ms: int = 500, timeout_s: float = 300) -> DataFrame:
    """S-8: run a stream with processing-time timers until its input is drained and no state is left, that is, until
    every timer has fired; its rows as a batch DataFrame."""
    spark, out = df.sparkSession, scratch_path(df.sparkSession, f"stream-out-{name}")
    query = start(df, name, "parquet", out, processing_time=f"{trigger_ms} milliseconds")
    until = time.monotonic() + timeout_s
    try:
        # such a query runs a micro-batch at every trigger: one without rows found no more input
        while not _is_quiet(query.lastProgress):
            if not query.isActive or time.monotonic() > until:
                raise query.exception() or TimeoutError(f"{name}: input or state is left after {timeout_s} s")
            time.sleep(trigger_ms / 1000)
    finally:
        query.stop()
    return spark.read.schema(df.schema).parquet(out)


def _is_quiet(progress) -> bool:
    return bool(progress) and not progress["numInputRows"] and not any(op["numRowsTotal"] for op in progress["stateOperators"])


def fan_out_tables(df: DataFrame, name: str, root: str, outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
                   checkpoint: str | None = None) -> StreamingQuery:
    """SNK-3, exactly once: several tables from one stream, one read of the source per micro-batch.

    A micro-batch writes each output into a folder of its epoch, replacing what an earlier try left
    there, and then marks the epoch as done; ``read_fan_out`` reads epochs that are done. If a writer
    fails, the query started again with the same ``checkpoint`` and ``root`` repeats the epoch with the same rows, so
    no row is lost, doubled, or seen in one output only. Runs until the input is drained."""
    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for out, rows_of in outputs.items():
                rows_of(batch).write.mode("overwrite").parquet(f"{root}/{out}/epoch={epoch}")
            batch.sparkSession.range(1).write.mode("overwrite").parquet(f"{root}/{_DONE}/epoch={epoch}")
        finally:
            batch.unpersist()

    return (df.writeStream.foreachBatch(each).queryName(name)
            .option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, f"stream-ckpt-{name}"))
            .trigger(availableNow=True).start())


def read_fan_out(spark: SparkSession, root: str, output: str, schema) -> DataFrame:
    """The rows of one output of ``fan_out_tables``, with their ``epoch``."""
    done = spark.read.schema("id long, epoch long").parquet(f"{root}/{_DONE}").select("epoch").distinct()
    rows = spark.read.schema(StructType([*schema.fields, StructField("epoch", LongType())])).parquet(f"{root}/{output}")
    return rows.join(done, "epoch", "left_semi")


def print_stream(df: DataFrame, name: str, available_now: bool = False) -> StreamingQuery:
    """SNK-1 for a stream: print each row of each micro-batch, untruncated."""
    return fan_out_batches(df, name, lambda batch, _epoch: print_rows(batch), available_now=available_now)


def fan_out_batches(df: DataFrame, name: str, *writers: Callable[[DataFrame, int], None],
                    available_now: bool = False) -> StreamingQuery:
    """SNK-3: several outputs from one stream and one source read per
    micro-batch (``foreachBatch`` with a persisted batch)."""
    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for w in writers:
                w(batch, epoch)
        finally:
            batch.unpersist()

    spark = df.sparkSession
    writer = (df.writeStream.foreachBatch(each)
              .option("checkpointLocation", scratch_path(spark, f"stream-ckpt-{name}")))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
