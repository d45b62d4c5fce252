"""A table replayed as files that arrive one after another.

``replay`` writes the rows of a table as one file per stretch of time and gives them back as a
stream that reads one file per micro-batch, in order, so that the watermark moves with the data
and what has been passed leaves the state. ``held_up`` rows come some files after
their own stretch; whether they are still taken depends on the watermark at that time, as it
does for a real source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.timefn import epoch_us
from eventide.session import scratch_path
from eventide.streaming import io as sio

#: Out-of-orderness bound of the comment job, the longest of the jobs.
DELAY_MS = 10_000
#: Rows that one file of a replayed table holds about, and the least number of files.
FILE_ROWS = 2_000_000
LEAST_FILES = 4


def stretch_ms(df: DataFrame, time_col: str, file_rows: int = FILE_ROWS, least: int = LEAST_FILES) -> int:
    """Length of the stretches of time that hold about ``file_rows`` rows each (at least ``least``
    stretches over the span of the table)."""
    us = epoch_us(time_col)
    low, high, rows = df.agg(F.min(us), F.max(us), F.count(F.lit(1))).first()
    files = max(least, -(-rows // file_rows))
    return max(1, ((high or 0) - (low or 0)) // 1000 // files + 1)


def write_in_order(df: DataFrame, slot: Column, folder: str) -> str:
    """One Parquet file per value of ``slot``, whose times of writing are in the order of the slots: the file
    source reads them in that order. Returns the pattern of the files' folders."""
    spark = df.sparkSession
    (df.withColumn("_slot", slot.cast("long")).repartition("_slot").write.partitionBy("_slot")
     .option("maxRecordsPerFile", 0).parquet(folder))
    _stamp(spark, folder)
    return f"{folder}/_slot=*"


def _stamp(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for f in system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/_slot=*/part-*")) or ():
        found.append((int(f.getPath().getParent().getName().split("=")[1]), f.getPath(), f.getModificationTime()))
    found.sort(key=lambda x: x[0])
    first = max((t for _, _, t in found), default=0) - 2000 * len(found)
    for i, (_, place, _) in enumerate(found):
        system.setTimes(place, first + 2000 * i, -1)


def replay(df: DataFrame, time_col: str, delay_ms: int = DELAY_MS, stretch: int | None = None,
           held_up: tuple[Column, int] | None = None, copies: tuple[Column, int] | None = None):
    """``(stream, end)``: ``df`` as a stream of files in order of ``time_col`` with a watermark of ``delay_ms``,
    and the end of that input. ``stretch`` is the length of a file's time in ms (default: by the table's size).
    Rows for which ``held_up[0]`` holds come ``held_up[1]`` files later than their time says; rows for which
    ``copies[0]`` holds come a second time, after ``copies[1]`` ms. Rows without a time are left out."""
    spark = df.sparkSession
    df = df.filter(F.col(time_col).isNotNull())
    stretch = stretch or stretch_ms(df, time_col)
    us = epoch_us(time_col)
    slot = F.floor(us / F.lit(stretch * 1000))
    if held_up:
        slot = slot + F.when(F.coalesce(held_up[0], F.lit(False)), F.lit(held_up[1])).otherwise(F.lit(0))
    rows = df.withColumn("_slot", slot.cast("long"))
    if copies:
        again = df.filter(copies[0]).withColumn("_slot", F.floor((us + F.lit(copies[1] * 1000)) / F.lit(stretch * 1000)).cast("long"))
        rows = rows.unionByName(again)
    pattern = write_in_order(rows, F.col("_slot"), scratch_path(spark, "stream-in"))
    end = sio.EndOfInput(spark, df.schema, time_col)
    return sio.event_time(sio.read_parquet_stream(spark, pattern, df.schema, 1, end), time_col, delay_ms), end


def late_sql(table: str, time_col: str, stretch: int, held_up: str, files: int, delay_ms: int = DELAY_MS) -> str:
    """SQL of the replayed rows: CTE ``arrived`` holds ``table`` with ``wm``, the watermark (ms) by which a stateful
    operator judges whether a row is late. That is the one of the micro-batch before: the latest time of all
    files up to the last but one, less ``delay_ms``. A row of a window is late if the window ends at or before it."""
    return f"""
WITH slotted AS (
  SELECT *, epoch_us({time_col}) // {stretch * 1000} + CASE WHEN {held_up} THEN {files} ELSE 0 END AS slot FROM {table} WHERE {time_col} IS NOT NULL),
files AS (
  SELECT slot, row_number() OVER (ORDER BY slot) AS nr, max(epoch_us({time_col}) // 1000) AS top FROM slotted GROUP BY slot),
marks AS (
  SELECT f.slot, coalesce(max(g.top) - {delay_ms}, 0) AS wm FROM files f LEFT JOIN files g ON g.nr <= f.nr - 2 GROUP BY f.slot),
arrived AS (SELECT s.*, m.wm FROM slotted s JOIN marks m ON m.slot = s.slot)"""
